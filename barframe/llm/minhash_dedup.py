"""Near-duplicate documents by a chosen-path similarity join.

Each document is the set of its distinct 5-word shingles. Equal sets fall into
one class by fingerprint and go on as one item, the smallest id. The items are
branched in ``TREES`` independent trees, each with places of the minwise sketch of its
own: a path starts ``DEPTH`` chosen tokens deep. Two sets of similarity s share a
path with a chance of s ** DEPTH, so a pair at the limit of 0.75 has no common path
with a chance of 4e-10, and dissimilar items part at once.

Nodes of one item or one component are dropped, small nodes are compared
exhaustively, larger ones branch on (see ``linking``); if all nodes of a pair at the
limit stay large, it is lost with a chance of 2e-4 after seven branchings (measured), and
less before. Each candidate pair is confirmed on the full sets. Branching ends when no
large mixed node is left; a node that stays large and mixed below ``LEVELS`` levels
(many items that are similar but not enough) is cut into rows of items by a second hash
and each of them is compared with all of the node, so no candidate of that node is
dropped.

Defined cases: documents without words have an empty set and link with nothing;
fewer than five words are one shingle; each row is judged by its own text, also
where it repeats a ``doc_id`` (texts of one id that aren't similar are in separate
groups of items, which may bear the same smallest id); rows with a null id are
returned alone, not kept, with a null component; the pipeline's stage keeps every
row with a null id, and of each group the first row by (doc_id, MD5 of the text),
of rows without words one per id; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.llm.common import chunks, materialise, python_batches, read
from barframe.llm.linking import CHUNK, SKETCH, branched, code, fingerprint, link, parity, paths, shingle_sets, sketch
from barframe.session import discard

SHINGLE, PERCENT = 5, 75
TREES, DEPTH = 40, 3
LEVELS = 8


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", CHUNK):
        sets = shingle_sets([t.encode("utf-8", "surrogatepass") if t else None for t in batch.column("text").to_pylist()], SHINGLE)
        made = np.stack([sketch(s) if len(s) else np.zeros(SKETCH, np.uint32) for s in sets]) if sets else np.zeros((0, SKETCH), np.uint32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) for s in sets], pa.binary()),
             pa.array([x.tobytes() if len(s) else None for s, x in zip(sets, made)], pa.binary()),
             pa.array([x.tobytes() + parity(s) if len(s) else None for s, x in zip(sets, code(made))], pa.binary())], names=["doc_id", "mark", "n_shingles", "print", "sketch", "code"])


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, sketch) -> the first nodes of every tree."""
    for batch in batches:
        nodes = paths(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH), TREES, DEPTH)
        yield pa.RecordBatch.from_arrays([pa.array(nodes.ravel().view(np.int64)), pa.array(np.repeat(batch.column("item").to_numpy(), TREES))], names=["node", "item"])


def marked(docs: DataFrame) -> DataFrame:
    """With ``mark``, which tells the texts of one id apart."""
    return docs.withColumn("mark", F.unhex(F.md5(F.coalesce("text", F.lit("")))))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, mark, n_shingles, comp, component_id) of every row of (doc_id, text).

    An item is a class of equal sets. It has the class's smallest id as its number,
    or a hash of the set if several classes have the same smallest id; comp is the
    smallest item of a group, component_id its smallest id."""
    python_batches(docs)
    docs = marked(docs.select("doc_id", "text"))
    prints = materialise(docs.mapInArrow(_sketches, "doc_id bigint, mark binary, n_shingles bigint, print binary, sketch binary, code binary"), "prints")
    real = prints.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialise(real.groupBy("print").agg(F.min(F.struct("doc_id", "mark")).alias("at"), F.first("sketch").alias("sketch"), F.first("code").alias("code"))
                          .select("print", F.col("at.doc_id").alias("least"), F.col("at.mark").alias("mark"), F.col("least").alias("item"), "sketch", "code"), "classes")
    rows = materialise(prints.drop("sketch", "code"), "rows")
    discard(prints)
    shared = materialise(classes.groupBy("least").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("least", F.lit(True).alias("several")), "shared")
    several = not shared.isEmpty()
    if several:
        classes = classes.join(shared, "least", "left").withColumn("item", F.when(F.col("several"), F.xxhash64("print")).otherwise(F.col("least"))).drop("several")
        classes = materialise(classes, "classes")

    def texts_of(ids: DataFrame) -> DataFrame:
        wanted = materialise(ids.join(classes.select("item", F.col("least").alias("doc_id"), "mark"), "item"), "wanted")
        # a class's (doc_id, mark) names one text; rows that repeat it meet where the join has dealt them
        return materialise(docs.join(wanted, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).select("item", "text"), "texts")

    items = classes.select("item", "sketch", "code")
    comps = link(items, items.select("item", "sketch").mapInArrow(_roots, "node bigint, item bigint"), branched, texts_of, percent, LEVELS)
    ends = classes.select("print", "item", "least")
    if comps is not None:
        ends = ends.join(comps, "item", "left").select("print", "least", F.coalesce("comp", "item").alias("comp"))
    else:
        ends = ends.select("print", "least", F.col("item").alias("comp"))
    if several:
        ends = materialise(ends, "ends")
        ends = ends.join(ends.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").drop("least")
    else:
        ends = ends.select("print", "comp", F.col("comp").alias("component_id"))
    found = rows.join(ends, "print", "left")
    return found.select("doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("comp")).alias("comp"),
                        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text)."""
    return _grouped(docs, percent).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(False)).alias("kept"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of near duplicates stays, and every row with a null id."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    found = materialise(_grouped(docs, PERCENT).where("doc_id IS NOT NULL").select("doc_id", "mark", "comp"), "grouped")
    # a group's first row; rows without words are in no group and stay, one per id
    kept = (found.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct("doc_id", "mark")).alias("x"))
            .unionByName(found.where("comp IS NULL").groupBy("doc_id").agg(F.min("mark").alias("mark")).select(F.lit(None).cast("bigint").alias("comp"), F.struct("doc_id", "mark").alias("x"))))
    kept = materialise(kept.select("x.doc_id", "x.mark").distinct(), "kept")
    first = Window.partitionBy("doc_id", "mark").orderBy("text", "lang", "source", "n_chars")
    real = marked(docs.where("doc_id IS NOT NULL")).join(kept, ["doc_id", "mark"], "left_semi")
    return (real.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth", "mark")
            .unionByName(docs.where("doc_id IS NULL")))
