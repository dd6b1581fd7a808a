"""SimHash near-duplicates, linked by Golay-code fuzzy hashing.

A document's fingerprint has 64 bits: bit i is 1 if it is set in over half the
XXH64 hashes of its 3-word shingles, repeats included. Equal fingerprints go on
as one; two fingerprints link where they differ in at most two bits.

*Fuzzy keys.* The fingerprint is cut into three segments of 22, 21 and 21 bits,
each read as a word of 23. The binary Golay code has one codeword within three
bits of every such word. A word's keys are the indices of all codewords within
four bits: one for a word up to two bits off its codeword, six for a word three
bits off. Two words that differ in at most two bits always share a key (a test
compares all such pairs of many words).

*Pigeonhole.* Of two differing bits in three segments, at least one segment has
none, and the segment after it at most two. So a fingerprint gives, for each of its
three segments, that segment's value with each fuzzy key of the next: at most 18
keys of 33 bits or more, and every linked pair shares one of them.

*Join.* A key met by up to ``SMALL`` fingerprints is a small bucket; buckets are
sorted next to each other, their pairs compared by the bits that differ, and a
bucket hands out one link per fingerprint, to the least of its local component.
A larger bucket (many close fingerprints) is never compared in one place: two
fingerprints within two bits have a word within one bit of both, so its
fingerprints are dealt to the 65 words of that radius. A word can have no more
than 65 of them, all of which are linked. Both ways are exact; no pair is
lost or emitted twice over. The links' components give the result.

Defined cases: a text that is null or has no words has fingerprint zero, linked
like any other; a text of fewer than three words is one shingle; each row is judged
by its own text, also where it repeats a ``doc_id``; a row with a null id is
returned and links others, and its component is the smallest id reached, null if
there is none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.llm.common import chunks, materialise, python_batches, read
from barframe.llm.linking import CHUNK, LOWER, components

SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 2
#: Bits of the segments, lowest first.
SEGMENTS = (22, 21, 21)
#: Largest bucket whose pairs are compared one by one.
SMALL = 128
#: Shingles hashed at a time.
PART = 1 << 18
#: Generator polynomial of the binary Golay code of length 23, and its data bits.
GENERATOR, LENGTH, DATA = 0b110001110101, 23, 12


def shingle_hashes(text: str | None) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of a text, in parts."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        if words:
            yield np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first, last = np.concatenate(([0], ends[:-SHINGLE])), ends[SHINGLE - 1:] - 1
    digest = xxhash.xxh64_intdigest
    for s in range(0, len(first), PART):
        a, b = first[s:s + PART].tolist(), last[s:s + PART].tolist()
        yield np.fromiter((digest(joined[i:j], SEED) for i, j in zip(a, b)), np.uint64, len(a))


def fingerprint(text: str | None) -> int:
    counts, n = np.zeros(BITS, np.int64), 0
    for h in shingle_hashes(text):
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little") if n else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", CHUNK):
        prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], names=["doc_id", "print"])


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(check bits by data bits, errors (2048 x 6) by syndrome, their number): the error
    patterns of up to four bits that turn a word of that syndrome into a codeword."""
    check = np.arange(1 << DATA, dtype=np.int64) << (LENGTH - DATA)
    for bit in range(LENGTH - 1, LENGTH - DATA - 1, -1):
        check = np.where(check >> bit & 1, check ^ (GENERATOR << (bit - (LENGTH - DATA))), check)
    low = (1 << (LENGTH - DATA)) - 1
    errors, n = np.zeros((low + 1, 6), np.int64), np.zeros(low + 1, np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            e = sum(1 << p for p in places)
            s = int(check[e >> (LENGTH - DATA)]) ^ (e & low)
            errors[s, n[s]] = e
            n[s] += 1
    return check, errors, n


def fuzzy(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index (n x 6) of the codewords within four bits of each word, number of them)."""
    check, errors, n = golay()
    syndrome = check[word >> (LENGTH - DATA)] ^ (word & ((1 << (LENGTH - DATA)) - 1))
    return (word[:, None] ^ errors[syndrome]) >> (LENGTH - DATA), n[syndrome]


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in prints, key) of all keys of unsigned fingerprints."""
    cuts = np.concatenate(([0], np.cumsum(SEGMENTS)))
    parts = [((prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
    at, out = [], []
    for i, exact in enumerate(parts):
        index, n = fuzzy(parts[(i + 1) % len(parts)])
        row, col = np.nonzero(np.arange(index.shape[1])[None, :] < n[:, None])
        at.append(row)
        out.append(index[row, col] | exact[row] << DATA | i << 40)
    return np.concatenate(at), np.concatenate(out)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, key = keys(batch.column("print").to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("print").take(pa.array(at))], names=["key", "print"])


def _balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words within one bit of each fingerprint."""
    flips = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << np.arange(BITS, dtype=np.uint64)))
    for batch in batches:
        p = batch.column("print").to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((p[:, None] ^ flips[None, :]).ravel().view(np.int64)), pa.array(np.repeat(p, len(flips)).view(np.int64))], names=["word", "print"])


def _local_links(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    """Rows of whole small buckets in order -> a link from each fingerprint to the least of its component in the bucket."""
    left, right = [], []
    for d in range(1, len(key)):
        same = key[:-d] == key[d:]
        if not same.any():
            break
        i = np.flatnonzero(same)
        i = i[np.bitwise_count((prints[i] ^ prints[i + d]).view(np.uint64)) <= RADIUS]
        left.append(i)
        right.append(i + d)
    label = np.arange(len(key))
    if left:
        i, j = np.concatenate(left), np.concatenate(right)
        while True:
            before = label.copy()
            np.minimum.at(label, j, label[i])
            np.minimum.at(label, i, label[j])
            label = label[label]
            if (label == before).all():
                break
    at = np.flatnonzero(label != np.arange(len(key)))
    return pa.RecordBatch.from_arrays([pa.array(prints[at]), pa.array(prints[label[at]])], names=["a", "b"])


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.concatenate((key, batch.column("key").to_numpy()))
        prints = np.concatenate((prints, batch.column("print").to_numpy()))
        cut = np.searchsorted(key, key[-1])  # the last bucket may go on
        yield _local_links(key[:cut], prints[:cut])
        key, prints = key[cut:], prints[cut:]
    yield _local_links(key, prints)


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links that join all of the distinct fingerprints (print) that lie within two bits, directly or over others."""
    keyed = materialise(prints.mapInArrow(_keys, "key bigint, print bigint"), "keys")
    shared = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = materialise(keyed.join(shared, "key"), "met")
    near = (met.where(F.col("n") <= SMALL).select("key", "print").repartition("key").sortWithinPartitions("key", "print")
            .mapInArrow(_bucket_links, "a bigint, b bigint"))
    words = (met.where(F.col("n") > SMALL).select("print").distinct().mapInArrow(_balls, "word bigint, print bigint")
             .groupBy("word").agg(F.collect_list("print").alias("all")).where(F.size("all") > 1)  # 65 at most
             .select(F.array_min("all").alias("b"), F.explode("all").alias("a")).select("a", "b").where("a <> b"))
    return near.unionByName(words).distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of (doc_id, text)."""
    python_batches(docs)
    rows = materialise(docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id bigint, print bigint"), "prints")
    least = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "least")
    comps = materialise(components(links(least.select("print"))), "comps")
    # only fingerprints on a link can have another one's id
    linked = least.join(comps.withColumnRenamed("item", "print"), "print")
    smallest = linked.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = materialise(least.join(linked.join(smallest, "comp").select("print", "component_id"), "print", "left")
                        .select("print", F.coalesce("component_id", "least").alias("component_id")), "found")
    return (rows.join(found, "print")
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    return simhash_components(read(spark, sf_dir, "documents", "doc_id", "text"))
