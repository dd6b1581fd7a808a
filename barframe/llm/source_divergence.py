"""Divergence audit of sources: how far a source's term distribution lies from its language's other sources.

1. *Blocks.* A task indexes its documents in memory: by (lang, source), the occurrences of
   each term and the documents that hold it. When ``POSTINGS`` postings are held, the block is
   spilled as a run of rows (lang, term, source, occurrences, documents) sorted by (lang, term),
   and memory starts empty again. So the memory of a task is bounded, and a frequent term
   leaves a block as one row a source.
2. *Runs.* The runs are dealt to hash shards of (lang, term) and merged there in that order
   (by Spark's external sort, which merges sorted runs by a heap); along the order
   neighbours are added up to a term's documents and, if they are enough, its frequencies.
3. *Corrections.* A group is a (lang, source). A term that neither of two groups has differs
   by the same amount in every such pair of shares, |p0 - p0'|, so a pair starts from
   V * |p0 - p0'|. Each shard streams its terms past the groups of its language (which are
   sorted in front of them) and adds, for every term that a group holds, the correction
   against every other group; terms that both hold are counted in both directions and
   taken off once. The work is (postings x sources of a language), the output of a task
   (pairs of groups), which are then summed.

All arithmetic is on integers; shares are computed from exact sums, wide ones in Python integers.

Defined cases: null text, lang and source are '' (a text without terms still makes its
group occur); repeated ids and rows count as often as they occur; one document is one
row; a language without kept terms gives its pairs of sources with value 0; a group without
kept terms has equal shares; a language of one source has no pairs; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.llm.common import chunks, materialise, python_batches, read

MIN_DOCS, TOP, SCALE, SMOOTH = 30, 50, 1_000_000_000, 5
#: Postings that a block holds before it is spilled (some 250 bytes each).
POSTINGS = 500_000
#: Postings of kept terms that a shard of the corrections has, about.
SHARD = 50_000
#: Cells of the shares (terms x sources) held at a time, and of the pairs of groups before they are handed out.
CELLS = 1 << 20
#: Bytes of text handled at a time.
CHUNK = 1 << 22

#: Bytes of UTF-8 text: A-Z become a-z, ASCII that is no letter a blank, all others stay.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RUN = "lang string, term binary, source string, n bigint, docs bigint"


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split() if text else []


class _Block:
    """Postings of the documents since the last spill: by (lang, source), the occurrences and the documents of each term."""

    def __init__(self):
        self.groups = defaultdict(lambda: (Counter(), Counter()))

    def add(self, lang: str, source: str, found: list[bytes]) -> None:
        counts, docs = self.groups[lang, source]
        counts.update(found)
        docs.update(set(found))

    def full(self) -> bool:
        return sum(len(counts) for counts, _ in self.groups.values()) >= POSTINGS

    def run(self) -> Iterator[pa.RecordBatch]:
        """The block as rows sorted by (lang, term); memory is empty afterwards."""
        for lang in sorted({of for of, _ in self.groups}):
            parts = []
            for of, source in sorted(k for k in self.groups if k[0] == lang):
                counts, docs = self.groups.pop((of, source))
                parts.append(pa.table([pa.array(counts.keys(), pa.binary()), pa.array([source] * len(counts), pa.string()), pa.array(counts.values(), pa.int64()),
                                       pa.array(map(docs.__getitem__, counts), pa.int64())], names=["term", "source", "n", "docs"]))
            rows = pa.concat_tables(parts)
            rows = rows.take(pc.sort_indices(rows, [("term", "ascending"), ("source", "ascending")]))
            yield from rows.add_column(0, "lang", pa.repeat(lang, rows.num_rows)).to_batches(max_chunksize=50_000)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block()
    for batch in batches:
        for part in chunks(iter([batch]), "text", CHUNK):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
                found = terms(text)
                if found:
                    block.add(lang, source, found)
            if block.full():
                yield from block.run()
    yield from block.run()


def share(count: int, total: int, kept: int) -> int:
    """Share of a term with ``count`` of ``total`` occurrences among ``kept`` terms, in parts of SCALE."""
    return 1 + SCALE * (count + SMOOTH) // (total + SMOOTH * kept)


def shares(counts: np.ndarray, totals: np.ndarray, kept: int) -> np.ndarray:
    if len(counts) and int(counts.max()) + SMOOTH < 2 ** 63 // SCALE:
        return 1 + SCALE * (counts + SMOOTH) // (totals + SMOOTH * kept)
    return np.array([share(c, t, kept) for c, t in zip(counts.tolist(), totals.tolist())], np.int64)


class _Lang:
    """The groups of one language in a shard, and what their terms add to the pairs."""

    def __init__(self, lang: str, sources: list[str], totals: list[int], kept: int):
        self.lang, self.sources, self.kept = lang, sources, kept
        self.place = {s: i for i, s in enumerate(sources)}
        self.totals = np.array(totals, np.int64)
        self.none = np.array([share(0, t, kept) for t in totals], np.int64)
        self.total = sum(totals)
        self.terms, self.pairs = [], {}
        self.step = max(1, CELLS // len(sources))

    def add(self, term: bytes, sources: list[str], counts: list[int]) -> Iterator[pa.RecordBatch]:
        self.terms.append((term, [self.place[s] for s in sources], counts))
        if len(self.terms) >= self.step:
            yield from self.work()

    def work(self) -> Iterator[pa.RecordBatch]:
        if not self.terms:
            return
        names = [t for t, _, _ in self.terms]
        row = np.repeat(np.arange(len(names)), [len(p) for _, p, _ in self.terms])
        col = np.array([i for _, p, _ in self.terms for i in p], np.int64)
        count = np.array([n for _, _, c in self.terms for n in c], np.int64)
        p = shares(count, self.totals[col], self.kept)
        q = np.array([share(sum(c), self.total, self.kept) for _, _, c in self.terms], np.int64)
        grid, held = np.tile(self.none, (len(names), 1)), np.zeros((len(names), len(self.none)), bool)
        grid[row, col], held[row, col] = p, True
        order = np.argsort(col, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(col[order])) + 1):
            g, rows = int(col[part[0]]), row[part]
            more = np.abs(grid[rows] - p[part][:, None]) - np.abs(self.none - self.none[g])[None, :]
            # a term that both hold comes once from either side: each takes half of twice the amount
            twice = 2 * more.sum(0) - np.where(held[rows], more, 0).sum(0)
            if g not in self.pairs:
                self.pairs[g] = np.zeros(len(self.none), np.int64)
            self.pairs[g] += twice
        value = p - q[row]
        over = np.flatnonzero(value > 0)
        over = over[np.lexsort((row[over], -value[over], col[over]))]
        nth = np.arange(len(over)) - np.searchsorted(col[over], col[over])
        yield self._rows("term", [(self.sources[col[i]], names[row[i]], int(value[i])) for i in over[nth < TOP]])
        self.terms = []
        if len(self.pairs) * len(self.none) >= CELLS:
            yield self.sums()

    def sums(self) -> pa.RecordBatch:
        rows = [(self.sources[g], self.sources[h].encode("utf-8", "surrogatepass"), int(v))
                for g, line in self.pairs.items() for h, v in enumerate(line) if h != g and v]
        self.pairs = {}
        return self._rows("pair", rows)

    def _rows(self, part: str, rows: list[tuple[str, bytes, int]]) -> pa.RecordBatch:
        source, item, value = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array([self.lang] * len(rows), pa.string()), pa.array([part] * len(rows), pa.string()), pa.array(source, pa.string()),
                                           pa.array(item, pa.binary()), pa.array(value, pa.int64())], names=["lang", "part", "source", "item", "value"])


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (shard, lang, term), a language's groups (term null) before its terms -> parts of the values."""
    key, now, groups = None, None, []
    for batch in batches:
        for shard, lang, term, sources, counts, kept in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "term", "sources", "counts", "kept"))):
            if (shard, lang) != key:
                if now is not None:
                    yield from now.work()
                    yield now.sums()
                key, now, groups = (shard, lang), None, []
            if term is None:
                groups.append((sources[0], counts[0], kept))
                continue
            if now is None:
                names, totals, sizes = zip(*sorted(groups))
                now = _Lang(lang, list(names), list(totals), sizes[0])
            yield from now.add(term, sources, counts)
    if now is not None:
        yield from now.work()
        yield now.sums()


def source_divergence(docs: DataFrame, least: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of (lang, source, text) rows."""
    python_batches(docs)
    spark = docs.sparkSession
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.mapInArrow(_index, RUN).repartition(partitions, "lang", "term")
    # a shard is in the order of (lang, term): what follows needs no further exchange
    known = runs.withColumn("all_docs", F.sum("docs").over(Window.partitionBy("lang", "term"))).where(F.col("all_docs") >= least)
    kept = materialise(known.groupBy("lang", "term", "source").agg(F.sum("n").alias("n")).groupBy("lang", "term")
                       .agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("x"))  # as many as there are sources
                       .select("lang", "term", F.col("x.source").alias("sources"), F.col("x.n").alias("counts")), "frequencies")

    totals = (kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
              .groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("total")))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = materialise(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
                         .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")), "groups")

    # each shard sees the groups of all languages in front of its terms
    postings = kept.agg(F.sum(F.size("sources"))).first()[0] or 0
    shards = -(-postings // SHARD) or 1
    shard = F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int")
    heads = groups.select("lang", F.lit(None).cast("binary").alias("term"), F.array("source").alias("sources"), F.array("total").alias("counts"), "kept",
                          F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    rows = heads.unionByName(kept.select("lang", "term", "sources", "counts", F.lit(None).cast("bigint").alias("kept"), shard.alias("shard")))
    parts = materialise(rows.repartition(partitions, "shard").sortWithinPartitions("shard", "lang", "term")
                        .mapInArrow(_corrections, "lang string, part string, source string, item binary, value bigint"), "parts")

    # a pair's corrections come from both groups, each as twice its share
    pair_sum = (parts.where("part = 'pair'").select("lang", F.least(F.encode("source", "utf-8"), "item").alias("a"), F.greatest(F.encode("source", "utf-8"), "item").alias("b"), "value")
                .groupBy("lang", "a", "b").agg(F.sum("value").alias("twice")))
    p0 = F.expr(f"1 + cast({SCALE * SMOOTH} div greatest(total + {SMOOTH} * kept, 1) as bigint)")
    sides = groups.select("lang", F.encode("source", "utf-8").alias("s"), F.col("kept"), p0.alias("p0"))
    both = (sides.select("lang", F.col("s").alias("g"), F.col("p0").alias("gp"), "kept")
            .join(sides.select("lang", F.col("s").alias("h"), F.col("p0").alias("hp")), "lang").where("g <> h")
            .withColumn("a", F.least("g", "h")).withColumn("b", F.greatest("g", "h")))
    pairs = (both.join(pair_sum, ["lang", "a", "b"], "left")
             .select("lang", F.decode("g", "utf-8").alias("source"), F.lit("pair").alias("part"), F.col("h").alias("item"),
                     (F.col("kept") * F.abs(F.col("gp") - F.col("hp")) + F.expr("coalesce(twice, 0) div 2")).alias("value")))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    terms_ = parts.where("part = 'term'").select("lang", "source", "part", "item", "value")
    ranked = (pairs.withColumn("rank", F.row_number().over(best))
              .unionByName(terms_.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)))
    return ranked.select("lang", "source", "part", F.decode("item", "utf-8").alias("item"), "value", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from its language's others, and its 50 most overused terms."""
    return source_divergence(read(spark, sf_dir, "documents", "lang", "source", "text"))


#: The same over every pair of sources and every kept term.
OP13_SQL = f"""WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents),
occ AS MATERIALIZED (SELECT lang, source, r, term, count(*) AS n FROM (SELECT lang, source, r, unnest(ts) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term FROM occ GROUP BY ALL HAVING count(*) >= {MIN_DOCS}),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, sum(n)::BIGINT AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS MATERIALIZED (SELECT lang, source, coalesce(sum(n), 0) AS n_all FROM groups LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH})) // (t.n_all + {SMOOTH} * s.v) AS p
  FROM total t JOIN kept k ON t.lang = k.lang JOIN size s ON s.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
q AS (
  SELECT lang, term, 1 + ({SCALE}::HUGEINT * (sum(n) + {SMOOTH})) // (any_value(n_all) + {SMOOTH} * any_value(v)) AS q
  FROM p JOIN (SELECT lang, sum(n_all) AS n_all FROM total GROUP BY lang) USING (lang) JOIN size USING (lang) GROUP BY lang, term),
differ AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN differ x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= {TOP}"""
