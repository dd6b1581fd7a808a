"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds documents that hold a test item: at least ``CONTAINMENT`` of the item's
distinct 5-word shingles. The item's sketch is its ``SKETCH`` smallest shingle
hashes (bottom-k MinHash). Each is in a matching document with a chance of its
containment, so all of them miss with a chance below 0.25 ** 8 = 1.5e-5; an item
with fewer shingles is sketched by all of them, and nothing is missed.

Items are partitioned by size in powers of two. A partition has one hash
ceiling, the largest hash in its sketches; a document offers each partition only
its shingles up to the ceiling, so long documents meet long items with a small
part of their shingles. Documents too small to hold the share of the item are
pruned before the candidates are told apart. Candidates are verified by the
exact count of common distinct shingles.

Only DataFrame functions. The documents are read twice: once to offer
shingles, once, for candidates alone, to verify. What is broadcast is counted
first; beyond ``BROADCAST_ROWS`` rows the same join is left to Spark.

Defined cases: null or blank item or document texts match nothing; an item of
fewer than five words matches only documents that are that word sequence; a
null ``doc_id`` or ``item_id`` names nothing and is left out; rows repeating an
id count as one with the shingles of all of them, for documents as long as one
row alone holds the item; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.llm.common import ascii_lower, materialise, read, shingle_hashes, small, words

SHINGLE, CONTAINMENT, SKETCH = 5, 0.75, 8


def _shingles(text: str):
    return F.array_distinct(shingle_hashes(words(ascii_lower(F.col(text))), SHINGLE))


def find_leaks(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_item, n_common, containment) from (doc_id, text) and (item_id, text) rows; doc_id of any type."""
    docs = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    item_shingles = (items.where(F.col("item_id").isNotNull()).select("item_id", F.explode(_shingles("text")).alias("h")).distinct())
    whole = Window.partitionBy("item_id")
    item_shingles = materialise(item_shingles.withColumn("n_item", F.count(F.lit(1)).over(whole))
                                .withColumn("place", F.row_number().over(whole.orderBy("h"))), "items")
    sketch = item_shingles.where(F.col("place") <= SKETCH).withColumn("size_class", F.floor(F.log2("n_item")).cast("int"))
    # one row per power of two of item sizes
    ceilings = sketch.groupBy("size_class").agg(F.max("h").alias("ceiling"), F.min("n_item").alias("least")).collect()
    if not ceilings:
        none = F.lit(0).cast("bigint")
        return docs.select("doc_id", none.alias("item_id"), none.alias("n_item"), none.alias("n_common"), F.lit(0.0).alias("containment")).limit(0)

    offered = docs.select("doc_id", _shingles("text").alias("s")).withColumn("n_doc", F.size("s"))

    def offer(size_class: int, ceiling: int, least: int):
        made = F.transform(F.filter("s", lambda h: h <= ceiling), lambda h: F.struct(F.lit(size_class).alias("size_class"), h.alias("h")))
        return F.when(F.col("n_doc") >= containment * least, made).otherwise(F.array().cast("array<struct<size_class:int,h:bigint>>"))

    by_class = F.concat(*[offer(*r) for r in ceilings])
    offered = offered.select("doc_id", "n_doc", F.inline(by_class))
    pairs = (offered.join(small(sketch.select("size_class", "h", "item_id", "n_item")), ["size_class", "h"])
             .where(F.col("n_doc") >= F.col("n_item") * containment).select("doc_id", "item_id").distinct())
    pairs = materialise(pairs, "candidates")

    whole_items = item_shingles.groupBy("item_id", "n_item").agg(F.collect_list("h").alias("b"))
    found = (docs.join(small(pairs), "doc_id").withColumn("a", _shingles("text")).drop("text").join(whole_items, "item_id")
             .withColumn("n_common", F.size(F.array_intersect("a", "b")).cast("bigint"))
             .where(F.col("n_common") >= F.col("n_item") * containment))
    return (found.groupBy("doc_id", "item_id").agg(F.max("n_item").cast("bigint").alias("n_item"), F.max("n_common").alias("n_common"))
            .withColumn("containment", F.round(F.col("n_common") / F.col("n_item"), 6)))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return find_leaks(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go.

    A row is judged by its own text, known by its MD5: also a row without an id, and of
    rows that repeat an id only those whose text holds an item go."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("mark", F.unhex(F.md5("text")))
    texts = docs.select(F.col("mark").alias("doc_id"), "text")
    leaks = materialise(find_leaks(texts, read(spark, sf_dir, "benchmark", "item_id", "text")).select(F.col("doc_id").alias("mark")).distinct(), "leaks")
    return docs.join(leaks, "mark", "left_anti").select("doc_id", "text", "lang", "source", "n_chars")


OP7_SQL = f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
i AS (SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
items AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM i),
n AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id)
SELECT doc_id, item_id, n_item::BIGINT AS n_item, count(*)::BIGINT AS n_common, round(count(*) / n_item, 6) AS containment
FROM ds JOIN items USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) >= {CONTAINMENT} * n_item
"""
