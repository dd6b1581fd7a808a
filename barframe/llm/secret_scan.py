"""Secret scan: fixed patterns, and a randomness battery over token-like runs.

Base kinds are matches of three fixed patterns. The battery adds ``random``
spans: every maximal run of 20+ token characters gets an inferred encoding
(hex, base32, base64) and three tests of its symbol sequence against a uniform
random source: chi-squared uniformity over the encoding's alphabet, the
Wald-Wolfowitz runs test about the alphabet's middle, and lag-1 serial
correlation. A run that one of them rejects is not random.

What passes may still be an ordinary word that is too short to be told apart,
so each run also has a p-value under ordinary text, which depends on length:
the chance of so few repeated symbols (or, for hex, of meeting only hex
symbols). Benjamini-Hochberg over the runs of all documents, by length class,
keeps the expected share of ordinary runs among the reported ones below ``FDR``.
The sorted list it needs is replaced by counts in fine bins of log p, so no
rows are ranked in one place; a bin counts as its largest p (conservative).

Only DataFrame functions; spans are code points, end exclusive. Positions come
from the lengths of the pieces between matches.

Defined cases: null or empty text has no spans; every input row gives one
result row, also with a null or repeated ``doc_id``; overlapping base spans of
different kinds all count; random runs that touch a base span are dropped, as
the base span already has them; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barframe.llm.common import let, materialise, read

# Kinds in their order, and their patterns. For access and hex a
# shorter run holds no match, so the least length can stand in the pattern; the
# assign pattern consumes text that a longer one would not, so its length is
# tested after matching.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

RUN = r"[A-Za-z0-9+/_-]{20,}"
# Alphabets in value order. base64 takes both of its common variants.
HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

#: A test rejects randomness beyond this many standard deviations (p about 0.001).
Z_LIMIT = 3.3
#: Chance that two letters of ordinary text are equal, and that a letter is a hex symbol.
TEXT_REPEAT, TEXT_IS_HEX = 0.06, 0.3
FDR = 0.01
#: Bins of -ln p are this wide; values beyond the last bin count as the last.
BIN, LAST_BIN = 0.05, 4000
#: Lower ends of the length classes.
LENGTHS = [20, 24, 32, 48, 64, 128]


def _placed(text: Column, pattern: str, keep=None) -> Column:
    """array<struct<s,e,t>> of the matches of a pattern that passes ``keep(match, group 2)``."""
    kind = "array<struct<s:int,e:int,t:string,v:string>>"
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep else hits

    def run(x: Column) -> Column:
        steps = F.transform(x["hits"], lambda h, i: F.struct(F.length(F.get(x["gaps"], i)).alias("gap"), F.length(h).alias("n"),
                                                            h.alias("t"), F.get(x["values"], i).alias("v")))
        return F.aggregate(
            steps, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
            lambda a, y: F.struct((a["at"] + y["gap"] + y["n"]).alias("at"), F.concat(a["out"], F.array(F.struct(
                (a["at"] + y["gap"]).alias("s"), (a["at"] + y["gap"] + y["n"]).alias("e"), y["t"].alias("t"), y["v"].alias("v")))).alias("out")),
            lambda a: a["out"])

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), hits.alias("hits"), values.alias("values"))
    found = F.when(F.regexp_like(text, F.lit(pattern)), let(parts, run)).otherwise(F.array().cast(kind))
    return F.filter(found, keep) if keep else found


def _normal_tail(z: Column) -> Column:
    """-ln of the lower tail of the normal law at z, by its asymptotic bound; 0 above the mean."""
    return F.when(z >= 0, F.lit(0.0)).otherwise(z * z / 2 + F.log(1.0 - z))


def battery(token: Column) -> Column:
    """struct<random boolean, score double>: whether no test rejects randomness; -ln p under ordinary text."""
    is_hex = F.regexp_like(token, F.lit("^([0-9a-f]+|[0-9A-F]+)$"))
    is_32 = F.regexp_like(token, F.lit("^[A-Z2-7]+$")) & ~is_hex
    plain = F.when(is_hex, F.lower(token)).when(is_32, token).otherwise(F.translate(token, "-_", "+/"))
    alphabet = F.when(is_hex, F.lit(HEX_DIGITS)).when(is_32, F.lit(BASE32)).otherwise(F.lit(BASE64))

    def coded(v: Column) -> Column:
        return F.struct(F.transform(F.filter(F.split(v["plain"], ""), lambda c: c != ""), lambda c: F.instr(v["alphabet"], c) - 1).alias("x"),
                        F.length(v["alphabet"]).cast("double").alias("k"), v["hexed"].alias("hexed"))

    def counted(v: Column) -> Column:
        x, k = v["x"], v["k"]
        number = F.aggregate(F.transform(F.sequence(F.lit(0), k.cast("int") - 1), lambda s: F.size(F.filter(x, lambda y: y == s)).cast("double")),
                             F.lit(0.0), lambda a, c: a + c * c)
        return F.struct(x.alias("x"), k.alias("k"), v["hexed"].alias("hexed"), F.size(x).cast("double").alias("n"), number.alias("squares"),
                        F.aggregate(x, F.lit(0.0), lambda a, y: a + (y >= k / 2).cast("double")).alias("high"),
                        (F.aggregate(x, F.lit(0.0), lambda a, y: a + y) / F.size(x)).alias("mean"),
                        F.arrays_zip(F.slice(x, F.lit(1), F.size(x) - 1).alias("a"), F.slice(x, F.lit(2), F.size(x) - 1).alias("b")).alias("pairs"))

    def judge(v: Column) -> Column:
        x, k, n, squares, high, mean = (v[c] for c in ("x", "k", "n", "squares", "high", "mean"))
        chi, df = squares * k / n - n, k - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        runs = 1 + F.aggregate(v["pairs"], F.lit(0.0), lambda a, p: a + ((p["a"] >= k / 2) != (p["b"] >= k / 2)).cast("double"))
        mean_runs = 2 * high * (n - high) / n + 1
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        z_runs = F.when(var_runs > 0, (runs - mean_runs) / F.sqrt(var_runs)).otherwise(F.lit(99.0))
        var = F.aggregate(x, F.lit(0.0), lambda a, y: a + (y - mean) * (y - mean))
        cov = F.aggregate(v["pairs"], F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean))
        z_serial = F.when(var > 0, cov / var * F.sqrt(n) + 1 / F.sqrt(n)).otherwise(F.lit(99.0))
        random = (z_chi < Z_LIMIT) & (F.abs(z_runs) < Z_LIMIT) & (F.abs(z_serial) < Z_LIMIT)
        repeats, expected = (squares - n) / 2, n * (n - 1) / 2 * TEXT_REPEAT
        score = (F.when(v["hexed"], -n * F.log(F.lit(TEXT_IS_HEX)))
                 .otherwise(_normal_tail((repeats + 0.5 - expected) / F.sqrt(expected))))
        return F.struct(random.alias("random"), score.alias("score"))

    made = F.struct(plain.alias("plain"), alphabet.alias("alphabet"), is_hex.alias("hexed"))
    return let(let(let(made, coded), counted), judge)


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(LENGTHS):
        out = F.when(n >= least, F.lit(i)).otherwise(out)
    return out


def _as_span(kind: int):
    return lambda m: F.struct(m["s"].alias("s"), F.lit(kind).alias("k"), m["e"].alias("e"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` (sorted base spans) and ``runs`` (token-like runs with their tests) to the rows."""
    whole = F.coalesce(F.col(text), F.lit(""))
    docs = (docs.withColumn("assign_", _placed(whole, ASSIGN, lambda m: F.length(m["v"]) >= ASSIGN_LEAST))
            .withColumn("access_", _placed(whole, ACCESS)).withColumn("hex_", _placed(whole, HEX))
            .withColumn("runs_", _placed(whole, RUN)))
    kinds = [F.transform(F.col(f"{kind}_"), _as_span(i)) for i, kind in enumerate(KINDS[:3])]
    docs = docs.withColumn("base", F.array_sort(F.concat(*kinds)))
    free = F.filter("runs_", lambda r: ~F.exists("base", lambda b: (b["s"] < r["e"]) & (r["s"] < b["e"])))
    tested = F.transform(free, lambda r: F.struct(r["s"].alias("s"), r["e"].alias("e"), battery(r["t"]).alias("b")))
    return (docs.withColumn("runs", F.transform(tested, lambda r: F.struct(
        r["s"].alias("s"), r["e"].alias("e"), r["b"]["random"].alias("random"), _length_class(r["e"] - r["s"]).alias("class"),
        F.least(F.floor(F.coalesce(r["b"]["score"], F.lit(0.0)) / BIN).cast("int"), F.lit(LAST_BIN)).alias("bin"))))
        .drop("assign_", "access_", "hex_", "runs_"))


def discovery_cuts(runs: DataFrame) -> DataFrame:
    """(class, cut): least bin that Benjamini-Hochberg at ``FDR`` reports, from (class, bin) rows.

    All tested runs of a length class count as tests. At most
    len(LENGTHS) * (LAST_BIN + 1) counts meet in the window."""
    counts = runs.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    total = Window.partitionBy("class")
    above = total.orderBy(F.col("bin").desc())
    return (counts.withColumn("m", F.sum("n").over(total)).withColumn("k", F.sum("n").over(above))
            .where(F.exp(-F.col("bin") * BIN) <= F.col("k") * FDR / F.col("m"))
            .groupBy("class").agg(F.min("bin").alias("cut")))


def _cut_array(cuts: DataFrame) -> Column:
    """The cuts by class as a literal: one number per length class reaches the driver."""
    found = {r["class"]: r["cut"] for r in cuts.collect()}
    return F.array(*[F.lit(found.get(i, LAST_BIN + 1)) for i in range(len(LENGTHS))])


def with_spans(scanned: DataFrame, cuts: DataFrame) -> DataFrame:
    """``scan`` rows with ``spans``: base spans and reported random runs, by start and kind."""
    cut = _cut_array(cuts)
    added = F.transform(F.filter("runs", lambda r: r["random"] & (r["bin"] >= F.get(cut, r["class"]))),
                        lambda r: F.struct(r["s"].alias("s"), F.lit(3).alias("k"), r["e"].alias("e")))
    return scanned.withColumn("spans", F.array_sort(F.concat("base", added))).drop("runs")


def _digest(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts by kind, digest of base spans, all spans."""
    scanned = materialise(scan(read(spark, sf_dir, "documents", "doc_id", "text")).drop("text"), "secrets")
    cuts = discovery_cuts(scanned.select(F.inline("runs")))
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("bigint")
    return with_spans(scanned, cuts).select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_digest(F.col("base")), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"))


MASK = "[secret]"


def mask(text: Column, spans: Column) -> Column:
    """Text with every span, or run of overlapping spans, replaced by ``MASK``."""
    done = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(F.greatest(a["at"], x["e"]).alias("at"),
                              F.when(x["s"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, x["s"] - a["at"]), F.lit(MASK)))
                              .otherwise(a["out"]).alias("out")))
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every secret is masked; all documents and columns stay."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    cuts = discovery_cuts(scan(docs.select("text")).select(F.inline("runs")))
    found = with_spans(scan(docs), cuts)
    return (found.withColumn("masked", mask(F.col("text"), F.col("spans")))
            .select("doc_id", F.col("masked").alias("text"), "lang", "source",
                    F.when(F.size("spans") > 0, F.length("masked").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")))
