"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down a tree domain -> language -> source. At each node the
budget is split among the children by their weights; a child never gets more
than its subtree can supply (its tokens times ``max_epochs``), and what it
lacks is shared among its siblings by weight until the node's budget is placed.
As a node's own supply is the sum of its children's, only a shortage that the
siblings can't cover reaches the parent, where it is shared at the level above.

A leaf's budget is met from seeded epochs: whole passes over the leaf, then the
token-prefix of one more pass, whose order is a hash of seed, epoch and id. The
document on the edge of the prefix is taken in part.

All amounts are integers, so results don't depend on the order of summing. The
split of a node is closed-form: children in order of supply per weight, running
sums, and the first child that can't be exhausted fixes the share of the rest.

Scale: documents are reduced to (id, leaf, tokens, order) before any shuffle.
Orders are cut into 4096 equal hash ranges, so the running sum over a leaf is a
window over one range of one leaf, plus the total of the ranges before it; a
leaf with a third of all rows spreads over 4096 groups. The tree itself has one
row per leaf and one window per parent.

Defined cases: a null ``source`` or ``lang`` is the empty name; null or blank
text has 0 tokens and is taken 0 times; equal orders go by id; repeated rows
count each; a node whose children all have weight 0 passes nothing on; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.llm.common import materialise, read, words

# Production parameters: relative weights in whole numbers.
DOMAIN_WEIGHTS = {"d0": 40, "d1": 30, "d2": 20, "d3": 10}
LANG_WEIGHTS = {"en": 50, "de": 20, "fr": 20, "es": 10}
OTHER_WEIGHT = 5
#: Budget as a percentage of the tokens there are; most passes over a document.
BUDGET_PERCENT, MAX_EPOCHS = 60, 2
SEED = 17
#: Hex digits of the order that name its range.
RANGE_DIGITS = 3
LEVELS = ["domain", "lang", "source"]


def token_count(text: Column) -> Column:
    """Number of words."""
    return F.size(words(text)).cast("bigint")


def domain_of(source: Column) -> Column:
    """``documents`` has no domain column; a source's domain is one of four by its hash."""
    digit = F.conv(F.substring(F.md5(source), 1, 1), 16, 10).cast("int")
    return F.concat(F.lit("d"), (digit % 4).cast("string"))


def _weight(column: str, weights: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, w).otherwise(out)
    return out.cast("bigint")


def _split(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``budget`` to rows with ``supply``, ``weight`` and the parent's ``parent_budget``.

    Exact: products of amounts and weights are compared as decimals."""
    wide = lambda c: c.cast("decimal(38,0)")
    name = LEVELS[len(parent)]
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.when(F.col("weight") > 0, F.col("supply") / F.col("weight")).asc_nulls_last(), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    x = (children.withColumn("s0", F.coalesce(F.sum("supply").over(before), zero))
         .withColumn("w0", F.coalesce(F.sum("weight").over(before), zero))
         .withColumn("w_all", F.sum("weight").over(group)))
    x = x.withColumn("full", (F.col("weight") > 0) & (
        wide(F.col("parent_budget") - F.col("s0")) * wide(F.col("weight")) >= wide(F.col("supply")) * wide(F.col("w_all") - F.col("w0"))))
    x = (x.withColumn("s_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(group), zero))
         .withColumn("w_rest", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(group), zero))
         .withColumn("left", F.greatest(F.col("parent_budget") - F.col("s_full"), zero)))
    # whole tokens; the remainder goes one by one to the first children of the rest
    share = F.when(F.col("w_rest") > 0, F.floor(wide(F.col("left")) * wide(F.col("weight")) / wide(F.col("w_rest"))).cast("bigint")).otherwise(zero)
    x = x.withColumn("share", F.when(F.col("full"), zero).otherwise(share))
    x = (x.withColumn("spare", F.when(F.col("w_rest") > 0, F.col("left") - F.sum("share").over(group)).otherwise(zero))
         .withColumn("place", F.sum(F.when(~F.col("full") & (F.col("weight") > 0), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))))
    extra = F.when(~F.col("full") & (F.col("weight") > 0) & (F.col("place") <= F.col("spare")), 1).otherwise(0)
    return x.withColumn("budget", F.when(F.col("full"), F.col("supply")).otherwise(F.col("share") + extra).cast("bigint"))


def allocate(leaves: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS,
             domain_weights: dict[str, int] | None = None, lang_weights: dict[str, int] | None = None) -> DataFrame:
    """(domain, lang, source, tokens, budget) of the leaves, from (domain, lang, source, tokens) rows."""
    leaves = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    domains = leaves.groupBy("domain").agg(F.sum("supply").alias("supply"), F.sum("tokens").alias("tokens"))
    domains = domains.withColumn("weight", _weight("domain", DOMAIN_WEIGHTS if domain_weights is None else domain_weights, OTHER_WEIGHT))
    everything = Window.partitionBy(F.lit(0))  # one row per domain
    domains = domains.withColumn("parent_budget", F.floor(F.sum("tokens").over(everything) * F.lit(budget_percent) / 100).cast("bigint"))
    domains = _split(domains, []).select("domain", F.col("budget").alias("parent_budget"))

    langs = leaves.groupBy("domain", "lang").agg(F.sum("supply").alias("supply"))
    langs = langs.withColumn("weight", _weight("lang", LANG_WEIGHTS if lang_weights is None else lang_weights, OTHER_WEIGHT)).join(domains, "domain")
    langs = _split(langs, ["domain"]).select("domain", "lang", F.col("budget").alias("parent_budget"))

    sources = leaves.withColumn("weight", F.lit(1).cast("bigint")).join(langs, ["domain", "lang"])
    return _split(sources, ["domain", "lang"]).select(*LEVELS, "tokens", "budget")


def _order(doc_id: Column, epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def select_tokens(docs: DataFrame, carried: tuple[str, ...] = (), **options) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epochs, tokens_taken) of every row of (doc_id, text, lang, source), with the carried columns.

    ``epochs`` counts whole passes; ``tokens_taken`` includes the prefix of the last."""
    slim = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                       token_count(F.col("text")).alias("n_tokens"), *carried)
    slim = materialise(slim.withColumn("domain", domain_of(F.col("source"))), "mix_docs")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = materialise(allocate(leaves, **options), "mix_plan")

    plan = (plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("bigint"))
            .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")))
    dealt = slim.join(plan.select(*LEVELS, "epochs", "rest"), LEVELS).withColumn("ord", _order(F.col("doc_id"), F.col("epochs")))
    dealt = dealt.withColumn("part", F.substring("ord", 1, RANGE_DIGITS))
    parts = dealt.groupBy(*LEVELS, "part").agg(F.sum("n_tokens").alias("in_part"))
    up_to = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before_part", F.coalesce(F.sum("in_part").over(up_to), F.lit(0))).drop("in_part")
    within = Window.partitionBy(*LEVELS, "part").orderBy("ord", "doc_id", "n_tokens", *carried).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, [*LEVELS, "part"])
    last = F.least(F.greatest(F.col("rest") - F.col("before_part") - F.col("before"), F.lit(0)), F.col("n_tokens"))
    return placed.select("doc_id", *LEVELS, "n_tokens", "epochs", (F.col("epochs") * F.col("n_tokens") + last).alias("tokens_taken"), *carried)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return select_tokens(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the documents that the mix takes from, with how much it takes.

    ``epochs`` whole passes and the prefix of one more make ``tokens_taken``. Every row
    keeps its own figures: rows are known by id, text (its MD5), language and source, and rows
    that repeat all of these share out their figures, a row each."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    mark = F.md5(F.concat_ws("|", *[F.coalesce(F.md5(F.col(c).cast("string")), F.lit("-")) for c in ("doc_id", "text", "lang", "source")]))
    docs = docs.withColumn("mark", F.unhex(mark))
    taken = select_tokens(docs, ("mark",)).where(F.col("tokens_taken") > 0).select("mark", "domain", "n_tokens", "epochs", "tokens_taken")
    # of equal rows the first ones get what is taken; one row's figures differ by the edge of a prefix only
    nth = Window.partitionBy("mark")
    taken = materialise(taken.withColumn("nth", F.row_number().over(nth.orderBy(F.col("tokens_taken").desc()))), "mix_taken")
    repeated = materialise(docs.groupBy("mark").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("mark", F.lit(True).alias("repeated")), "mix_repeated")
    if repeated.isEmpty():
        return docs.join(taken.drop("nth"), "mark").drop("mark")
    numbered = docs.join(repeated, "mark", "left").withColumn("again", F.coalesce("repeated", F.lit(False))).drop("repeated")
    several = numbered.where("again").withColumn("nth", F.row_number().over(nth.orderBy("n_chars")))
    single = numbered.where("NOT again").withColumn("nth", F.lit(1))
    return single.unionByName(several).join(taken, ["mark", "nth"]).drop("mark", "nth", "again")


def _case(column: str, weights: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{n}' THEN {w}" for n, w in weights.items()) + f" ELSE {OTHER_WEIGHT} END"


def _split_sql(name: str, rows: str, parent: str, key: str) -> str:
    over = f"PARTITION BY {parent}" if parent else ""
    order = f"{over} ORDER BY CASE WHEN weight > 0 THEN supply / weight::DOUBLE END NULLS LAST, {key}"
    return f"""
{name}_a AS (SELECT *, coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS s0,
    coalesce(sum(weight) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS w0, sum(weight) OVER ({over}) AS w_all FROM ({rows})),
{name}_b AS (SELECT *, weight > 0 AND (parent_budget - s0) * weight >= supply::HUGEINT * (w_all - w0) AS is_full FROM {name}_a),
{name}_c AS (SELECT *, greatest(parent_budget - coalesce(sum(CASE WHEN is_full THEN supply END) OVER ({over}), 0), 0)::HUGEINT AS amount,
    coalesce(sum(CASE WHEN NOT is_full THEN weight END) OVER ({over}), 0)::HUGEINT AS w_rest FROM {name}_b),
{name}_d AS (SELECT *, CASE WHEN is_full OR w_rest = 0 THEN 0 ELSE (amount * weight) // w_rest END AS share FROM {name}_c),
{name}_e AS (SELECT *, CASE WHEN w_rest > 0 THEN amount - sum(share) OVER ({over}) ELSE 0 END AS spare,
    sum(CASE WHEN NOT is_full AND weight > 0 THEN 1 ELSE 0 END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place FROM {name}_d),
{name} AS (SELECT *, CASE WHEN is_full THEN supply ELSE share + CASE WHEN NOT is_full AND weight > 0 AND place <= spare THEN 1 ELSE 0 END END AS budget FROM {name}_e)"""


OP5_SQL = f"""
WITH slim AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS n_tokens,
    'd' || (('0x' || substr(md5(coalesce(source, '')), 1, 1))::INT % 4)::VARCHAR AS domain FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {MAX_EPOCHS})::BIGINT AS supply FROM slim GROUP BY ALL),
{_split_sql("dom", f'''SELECT domain, sum(supply) AS supply, {_case("domain", DOMAIN_WEIGHTS)} AS weight,
    (SELECT sum(tokens) * {BUDGET_PERCENT} // 100 FROM leaves) AS parent_budget FROM leaves GROUP BY domain''', "", "domain").strip()},
{_split_sql("lan", f'''SELECT l.domain, l.lang, sum(l.supply) AS supply, {_case("l.lang", LANG_WEIGHTS)} AS weight,
    any_value(d.budget) AS parent_budget FROM leaves l JOIN dom d USING (domain) GROUP BY l.domain, l.lang''', "domain", "lang").strip()},
{_split_sql("src", '''SELECT l.domain, l.lang, l.source, l.tokens, l.supply, 1 AS weight, b.budget AS parent_budget
    FROM leaves l JOIN lan b USING (domain, lang)''', "domain, lang", "source").strip()},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
    budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens AS rest FROM src),
dealt AS (SELECT s.*, p.epochs, p.rest, md5('{SEED}|' || p.epochs::BIGINT || '|' || coalesce(doc_id::VARCHAR, '')) AS ord
    FROM slim s JOIN plan p USING (domain, lang, source)),
placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_ FROM dealt)
SELECT doc_id, domain, lang, source, n_tokens, epochs::BIGINT AS epochs,
  (epochs * n_tokens + least(greatest(rest - before_, 0), n_tokens))::BIGINT AS tokens_taken FROM placed
"""
