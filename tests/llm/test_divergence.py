import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from barframe.llm import source_divergence as D

from .conftest import DOC


def plain(rows, least, top):
    """The contract term by term. rows: (lang, source, text)."""
    rows = [(a or "", b or "", c or "") for a, b, c in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (of, s), c in counts.items() if of == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(found, 1) if part == "pair" or r <= top]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(1, t, l, s, 3, 4, 5, "x", "y") for l, s, t in rows], DOC)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["Ä", "straße", "the", "THE", "of", "Zug", "x1y", "日本", "a-b"] + [f"w{chr(97 + i)}" for i in range(20)]
    return [(rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", "ß", None]),
             rng.choice([None, "", " 12 !"]) if rng.random() < 0.1 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for _ in range(n)]


@pytest.mark.parametrize("least,top", [(1, 3), (8, 50), (1000, 50)])
def test_equals_the_contract(spark, least, top):
    rows = corpus(least, 150) + [("fr", "only", "un deux")] * 3 + [("it", "a", "9"), ("it", "b", None)]
    got = sorted(tuple(r) for r in D.source_divergence(frame(spark, rows), least, top).collect())
    assert got == plain(rows, least, top)


def test_blocks_and_shards_add_up(monkeypatch):
    rows = corpus(5, 300)
    batch = pa.RecordBatch.from_pylist([{"lang": a or "", "source": b or "", "text": c} for a, b, c in rows])
    whole = pa.Table.from_batches(D._index(iter([batch])))
    monkeypatch.setattr(D, "POSTINGS", 40)
    monkeypatch.setattr(D, "CHUNK", 300)
    monkeypatch.setattr(D, "CELLS", 12)
    cut = pa.Table.from_batches(D._index(iter([batch])))
    assert cut.num_rows > 2 * whole.num_rows
    for run in (whole, cut):
        keys = list(zip(run["lang"].to_pylist(), run["term"].to_pylist()))
        assert run is cut or keys == sorted(keys)

    def merged(run):
        docs, counts = Counter(), defaultdict(Counter)
        for r in run.to_pylist():
            docs[r["lang"], r["term"]] += r["docs"]
            counts[r["lang"], r["term"]][r["source"]] += r["n"]
        return [{"lang": k[0], "term": k[1], "sources": sorted(c), "counts": [c[s] for s in sorted(c)]} for k, c in sorted(counts.items()) if docs[k] >= 3]
    assert merged(cut) == merged(whole)

    # three shards, each after the heads of its groups, in windows of a few terms
    kept, total, size = merged(cut), Counter(), Counter()
    for r in kept:
        size[r["lang"]] += 1
        for s, n in zip(r["sources"], r["counts"]):
            total[r["lang"], s] += n
    stream = []
    for shard in range(3):
        for (lang, s), n in total.items():
            stream.append({"shard": shard, "lang": lang, "term": None, "sources": [s], "counts": [n], "kept": size[lang]})
        stream += [{"shard": shard, "lang": r["lang"], "term": r["term"], "sources": r["sources"], "counts": r["counts"], "kept": None}
                   for i, r in enumerate(kept) if i % 3 == shard]
    stream.sort(key=lambda r: (r["shard"], r["lang"], r["term"] or b""))
    schema = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("term", pa.binary()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("kept", pa.int64())])
    parts = pa.Table.from_batches(D._corrections(iter(pa.Table.from_pylist(stream, schema).to_batches(max_chunksize=5)))).to_pylist()
    sums = Counter()
    for r in parts:
        if r["part"] == "pair":
            sums[r["lang"], *sorted((r["source"], r["item"].decode()))] += r["value"]
    want = {(lang, s, i): v for lang, s, part, i, v, _ in plain(rows, 3, 50) if part == "pair"}
    for (lang, s, other), value in want.items():
        p0 = [D.share(0, total[lang, x], size[lang]) for x in (s, other)]
        assert value == size[lang] * abs(p0[0] - p0[1]) + sums[lang, *sorted((s, other))] // 2


def test_wide_counts_are_exact():
    counts, totals = np.array([10 ** 13, 7]), np.array([10 ** 13 + 11, 10 ** 13 + 11])
    assert D.shares(counts, totals, 4).tolist() == [1 + 10 ** 9 * (10 ** 13 + 5) // (10 ** 13 + 31), 1 + 10 ** 9 * 12 // (10 ** 13 + 31)]


def test_long_text_and_empty_table(spark):
    rows = [("en", "s", "Word " * 40_000), ("en", "t", "word other")]
    assert sorted(tuple(r) for r in D.source_divergence(frame(spark, rows), 1).collect()) == plain(rows, 1, 50)
    assert D.source_divergence(frame(spark, rows).limit(0)).collect() == []
