import random

import numpy as np
import pytest
import xxhash

from barframe.llm import simhash_dedup as S

from .conftest import sentence


def plain(text):
    """The fingerprint by definition, one bit at a time."""
    import re
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(p.encode("utf-8"), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(prints):
    """Component of each place: pairs within two bits, all compared."""
    label = list(range(len(prints)))
    while True:
        new = [min(label[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 2) for i in range(len(prints))]
        if new == label:
            return label
        label = new


def test_words_two_bits_apart_share_a_codeword():
    rng = np.random.default_rng(1)
    words = np.concatenate((rng.integers(0, 1 << 23, 400), np.array([0, (1 << 23) - 1])))
    flips = [0] + [1 << i for i in range(23)] + [1 << i | 1 << j for i in range(23) for j in range(i)]
    index, n = S.fuzzy(words)
    assert set(n.tolist()) <= {1, 6}
    mine = [set(a[:k]) for a, k in zip(index.tolist(), n.tolist())]
    for f in flips:
        other, m = S.fuzzy(words ^ f)
        for a, b, k in zip(mine, other.tolist(), m.tolist()):
            assert a & set(b[:k])


def test_fingerprints_within_two_bits_share_a_key():
    rng = random.Random(2)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 2)):
            y ^= 1 << b
        at, key = S.keys(np.array([x, y], np.uint64))
        assert set(key[at == 0].tolist()) & set(key[at == 1].tolist())
        assert len(key) <= 36


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "a b c d e a b c", "Größe ÄÖ x y z\x0bw q", "x " * 3000])
def test_fingerprint_by_definition(text):
    assert S.fingerprint(text) == plain(text)


def test_long_text_in_parts(monkeypatch):
    text = sentence(5, 3000)
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "PART", 97)
    assert S.fingerprint(text) == whole == plain(text)


def _close(rng, n, hot):
    """Fingerprints in clouds of close ones, one cloud of ``hot``."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(1, 3)):
            x ^= 1 << b
        out.append(x)
    centre = rng.getrandbits(64)
    for _ in range(hot):
        x = centre
        for b in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << b
        out.append(x)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("small", [128, 3])
def test_links_join_what_all_pairs_join(spark, monkeypatch, small):
    monkeypatch.setattr(S, "SMALL", small)
    prints = _close(random.Random(3), 60, 250)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in S.links(spark.createDataFrame([(p,) for p in signed], "print bigint")).collect()]
    assert all((a ^ b).bit_count() <= 64 and a != b for a, b in got)
    place = {p: i for i, p in enumerate(prints)}
    want, label = brute(prints), list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a, b in got:
            i, j = place[a], place[b]
            low = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = low
    assert label == want


def test_components_of_documents(spark, documents):
    long = sentence(8, 400)
    texts = {5: long, 3: long.upper(), 9: long + " end", 4: None, 8: "", 2: "only one", 1: sentence(9, 60), (7, 1): "same id one", (7, 2): "same id other",
             11: "tie tie tie tie", 12: "tie tie tie", None: long, (None, 2): "alone without an id"}
    rows = [r.asDict() for r in S.simhash_components(documents(texts)).collect()]
    assert len(rows) == len(texts)
    pairs = [(k[0] if isinstance(k, tuple) else k, plain(t)) for k, t in texts.items()]
    label = brute([p for _, p in pairs])
    want = sorted((str(i), f"{p:016x}", str(min((j for (j, _), m in zip(pairs, label) if m == l and j is not None), default=None))) for (i, p), l in zip(pairs, label))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in rows) == want
    by_id = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] in (3, 4, 5, 8)}
    assert by_id == {3: 3, 5: 3, 4: 4, 8: 4}


def test_empty_table(spark, documents):
    assert S.simhash_components(documents({1: "x"}).limit(0)).collect() == []
