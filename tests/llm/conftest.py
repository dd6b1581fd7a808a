import random

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, item bigint, h bigint, spans string, node string"


def rows(texts, lang="en", source="s"):
    """documents rows from {id or (id, n): text}, with extra columns whose names the operators use inside."""
    return [(k[0] if isinstance(k, tuple) else k, t, lang, source, len(t) if t else None, 1, 2, "x", "y") for k, t in texts.items()]


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ba", "do", "ri", "ku", "me", "lo", "ta", "ne"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    return lambda texts, **k: spark.createDataFrame(rows(texts, **k), DOC)
