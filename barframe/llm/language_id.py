"""Language identification by hyperdimensional n-gram profiles.

Each letter has a random vector of +1 and -1. An n-gram is bound as the
product of its letters' vectors, each rotated by its place; a text is the
bundle (sum) of its n-gram vectors; a language is the bundle of all its
training texts. A text gets the language whose prototype has the largest
cosine with the text's vector.

Bundling is linear, so prototypes come from exact n-gram counts of every
training text, summed by Spark; nothing is sampled and no text is cut.

Defined cases: text null or without letters gives ``und`` with score 0; null
``lang`` rows don't train; with no training rows all texts are ``und``; equal
cosines go to the smaller language name; repeated rows count each; a null
``doc_id`` is a training row (its remainder is null); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm.common import chunks, python_batches, read

DIM = 1024
GRAM = 3
SEED = 20240607
#: n-grams bound at a time, and UTF-8 bytes of text handled at a time.
SLICE, CHUNK = 8192, 1 << 20
UNKNOWN = "und"
BITS = 21  # of a code point; three fit into a long


@lru_cache(1)
def _symbols() -> np.ndarray:
    """Code point -> itself for letters, a blank for all else."""
    return np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x110000)), np.uint32, 0x110000)


def _letter_vector(cp: int) -> np.ndarray:
    """+1/-1 vector of a letter, from a hash of code point and place."""
    with np.errstate(over="ignore"):
        x = np.arange(DIM, dtype=np.uint64) + np.uint64(cp) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (((x >> np.uint64(40)) & np.uint64(1)).astype(np.float32) * 2 - 1)


_letters = lru_cache(20_000)(_letter_vector)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of packed n-grams: letter j from the end is rotated j times."""
    out = np.ones((len(grams), DIM), np.float32)
    for j in range(GRAM):
        cps, inv = np.unique((grams >> (BITS * j)) & ((1 << BITS) - 1), return_inverse=True)
        out *= np.stack([np.roll(_letters(int(c)), j) for c in cps])[inv]
    return out


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, packed n-gram, count) of every n-gram; words are padded by one blank."""
    rows, grams, counts = [], [], []
    for i, t in enumerate(texts):
        if not t:
            continue
        s = _symbols()[np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = s == 32
        s = s[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.int64)
        if len(s) < GRAM:
            continue
        n = len(s) - GRAM + 1
        g = np.sort(sum(s[j:j + n] << (BITS * (GRAM - 1 - j)) for j in range(GRAM)))
        first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        rows.append(np.full(len(first), i, np.int64))
        grams.append(g[first])
        counts.append(np.diff(np.append(first, n)))
    if not rows:
        z = np.zeros(0, np.int64)
        return z, z, z
    return np.concatenate(rows), np.concatenate(grams), np.concatenate(counts)


def _sum_by(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    k = keys[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[first], np.add.reduceat(n[order], first)


COUNT_SCHEMA = "lang string, gram bigint, n bigint"


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> n-gram counts of each language, summed within the task."""
    held: dict[str, list] = {}
    pending = 0

    def out():
        for lang, parts in held.items():
            g, n = _sum_by(*(np.concatenate(x) for x in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g), pa.array(n)],
                                             names=["lang", "gram", "n"])

    for batch in chunks(batches, "text", CHUNK):
        texts = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            texts.setdefault(lang, []).append(text)
        for lang, ts in texts.items():
            _, g, n = gram_counts(ts)
            if len(g):
                held.setdefault(lang, []).append(_sum_by(g, n))
                pending += len(held[lang][-1][0])
        if pending > 1_000_000:
            held = {x: [_sum_by(*(np.concatenate(y) for y in zip(*p)))] for x, p in held.items()}
            pending = sum(len(p[0][0]) for p in held.values())
            if pending > 500_000:  # a very large alphabet: hand on what there is
                yield from out()
                held, pending = {}, 0
    yield from out()


def _partial_prototypes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        lang = np.array(batch.column("lang").to_pylist(), object)
        gram, n = (batch.column(c).to_numpy() for c in ("gram", "n"))
        for at in range(0, len(gram), SLICE):
            v = gram_vectors(gram[at:at + SLICE]).astype(np.float64) * n[at:at + SLICE, None]
            for x in set(lang[at:at + SLICE]):
                sums[x] = sums.get(x, 0) + v[lang[at:at + SLICE] == x].sum(0)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])],
                                         names=["lang", "vector"])


def prototypes(training: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototype of each language of (lang, text) rows. Only one vector per language reaches the driver."""
    python_batches(training)
    counts = training.mapInArrow(count_grams, COUNT_SCHEMA).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    parts = counts.mapInArrow(_partial_prototypes, "lang string, vector array<double>")
    dims = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in dims.collect():
        out.setdefault(r["lang"], np.zeros(DIM))[r["at"]] = r["x"]
    return {x: v / (np.linalg.norm(v) or 1.0) for x, v in sorted(out.items())}


def document_vectors(texts: list[str | None]) -> np.ndarray:
    """Bundle of each text's n-grams; a zero row where there are no letters."""
    rows, grams, counts = gram_counts(texts)
    out = np.zeros((len(texts), DIM), np.float32)
    if not len(rows):
        return out
    order = np.argsort(grams, kind="stable")
    rows, grams, counts = rows[order], grams[order], counts[order]
    first = np.concatenate(([True], grams[1:] != grams[:-1]))
    distinct, at = grams[first], np.cumsum(first) - 1
    for s in range(0, len(distinct), SLICE):
        lo, hi = np.searchsorted(at, (s, s + SLICE))
        dense = np.zeros((len(texts), min(SLICE, len(distinct) - s)), np.float32)
        dense[rows[lo:hi], at[lo:hi] - s] = counts[lo:hi]
        out += dense @ gram_vectors(distinct[s:s + SLICE])
    return out


def _predictor(protos: dict[str, np.ndarray]):
    names = np.array(list(protos), object)
    matrix = np.stack(list(protos.values())).astype(np.float32) if protos else np.zeros((0, DIM), np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            texts = batch.column("text").to_pylist()
            v = document_vectors(texts)
            norm = np.linalg.norm(v, axis=1)
            langs, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if len(names):
                cos = (v @ matrix.T) / np.maximum(norm, 1e-9)[:, None]
                best = cos.argmax(1)
                some = norm > 0
                langs[some] = names[best[some]]
                score[some] = np.clip(cos[np.arange(len(texts)), best][some], 0.0, 1.0)
            kept = [i for i, n in enumerate(batch.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(langs, pa.string()), pa.array(score)],
                                             names=[*(batch.schema.names[i] for i in kept), "lang_pred", "score"])
    return predict


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of (doc_id, text), learned from (lang, text) rows."""
    training = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    predict = _predictor(prototypes(training))
    return docs.select("doc_id", "text").mapInArrow(predict, "doc_id bigint, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = identify(docs, docs.where(~held_out(F.col("doc_id"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Cosines of unrelated hypervectors spread by 1 / sqrt(DIM) = 0.031 about 0. A
#: text below this one resembles no learned language; a clean text of one or two
#: words lies above it.
MIN_SCORE = 0.04


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in no learned language go; columns stay.

    The prototypes are learned from the given documents' own ``lang`` labels.
    The training texts are read once, the documents once more for prediction."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = docs.select(*columns)
    training = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    predict = _predictor(prototypes(training))

    def keep(batches):
        for batch in chunks(batches, "text", CHUNK):
            said = next(predict(iter([batch.select(["text"])])))
            ok = pc.and_(pc.not_equal(said.column("lang_pred"), UNKNOWN),
                                 pc.greater_equal(said.column("score"), MIN_SCORE))
            yield batch.filter(ok)

    return docs.mapInArrow(keep, docs.schema)
