"""Secret scans: fixed patterns, and a battery of randomness tests with length-aware false-discovery control.

All in DataFrame and SQL functions. Patterns give the base spans (kinds assign, access, hex). Other candidates are whole
runs of at least 20 of ``A-Za-z0-9+/_-`` with the ``=`` that pad them; an inner ``=`` ends a run, so the value of NAME=value is a run
of its own. Their encoding follows from the characters in use: hex, upper-case letters and digits, lower-case letters and digits
(of base32, or all), or base64 with both cases and digits. Three tests ask whether the symbols look random: chi-squared of a uniform
alphabet (Wilson-Hilferty), runs above and below the alphabet's middle, and serial correlation of neighbours. A candidate stays
if the smallest of the three p-values, corrected for being the smallest, is at least ``LEAST_RANDOM``.

Short text passes such tests by chance, so each candidate also has a p-value under the opposite hypothesis, symbols as uneven as in text: the
number of equal pairs of symbols against its mean and variance there. Its power grows with the length. Candidates of one encoding and
length class form a family, and the step-up rule keeps the false discoveries of each family to ``FALSE_DISCOVERIES``. It
needs counts of p-values by class only, so nothing is sorted as a whole. What is found becomes a span of kind random,
unless a base span overlaps it.

Positions are code points and ends exclusive, of the whole match. They follow from the lengths of matches and of what
is between them, added up by document, so the text is read once and not shuffled.

Cases: null is empty and has no spans. Very long texts and many matches take linear time. Rows that repeat are kept
apart. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import read_table, stored

KINDS = ["assign", "access", "hex", "random"]
# The patterns of the base spans
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}+"  # runs are whole, so a shorter one never hides a longer
LEAST = {"assign": 12, "access": 18, "hex": 16, "random": 20}
PADDING = r"={1,6}(?![A-Za-z0-9+/_=-])"  # at the end only
RANDOM = rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{{20,}}+(?:{PADDING})?|[A-Za-z0-9+/_-]{{16,19}}+{PADDING})"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": RANDOM}

ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "234567abcdefghijklmnopqrstuvwxyz",
    "lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/",
}
# Sums of squares and cubes of the symbols' shares where symbols are as uneven as in text: by rank for hex digits, as in
# written language otherwise
UNEVEN = {"hex": (0.138, 0.0311), "upper": (0.0667, 0.0055), "base32": (0.0667, 0.0055), "lower": (0.0667, 0.0055), "base64": (0.0667, 0.0055)}
LEAST_RANDOM = 0.001
FALSE_DISCOVERIES = 0.05
MATCHES = "array<struct<kind:string,n:int,before:int,length:int,tested:int,value:string>>"
STEPS = 20  # classes of p-values for each power of ten
LAST_STEP = 400


def _at_or_below(z: Column) -> Column:
    """Standard normal distribution function, by a polynomial with an error below 1e-7."""
    x = F.abs(z)
    t = F.lit(1.0) / (1 + 0.2316419 * x)
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z > 0, 1 - tail).otherwise(tail)


def _both_sides(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _at_or_below(-F.abs(z)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _matches(text: Column, kind: str) -> Column:
    """For each match of a kind: its place, the length before it since the last match, its length, the tested length."""
    pattern = F.lit(PATTERNS[kind])
    between = F.transform(F.split(text, PATTERNS[kind], -1), lambda p: F.length(p))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else found
    rows = F.transform(
        F.arrays_zip(between.alias("b"), found.alias("f"), tested.alias("t")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("n"), x["b"].alias("before"), F.length(x["f"]).alias("length"), F.length(x["t"]).alias("tested"), (x["f"] if kind == "random" else F.lit(None).cast("string")).alias("value")),
    )
    return F.when(text.rlike(PATTERNS[kind]), F.filter(rows, lambda r: r["length"].isNotNull())).otherwise(F.array().cast(MATCHES))


def matches(docs: DataFrame) -> DataFrame:
    """row, doc_id, kind, start, end, value: all matches long enough, and one row without a kind for every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    none = F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (("kind", "string"), ("n", "int"), ("before", "int"), ("length", "int"), ("tested", "int"), ("value", "string"))])
    rows = rows.select("row", "doc_id", F.explode(F.concat(F.array(none), *[_matches(F.col("text"), k) for k in KINDS])).alias("m")).select("row", "doc_id", "m.*")
    rows = stored(rows, "matches")
    reached = F.sum(F.col("before") + F.col("length")).over(Window.partitionBy("row", "kind").orderBy("n"))
    least = F.coalesce(*[F.when(F.col("kind") == k, F.lit(n)) for k, n in LEAST.items()])
    found = rows.where("kind IS NOT NULL").withColumn("end", reached.cast("int")).where(F.col("tested") >= least)
    found = found.select("row", "doc_id", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value")
    return found.unionByName(rows.where("kind IS NULL").select("row", "doc_id", "kind", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), "value"))


def tested(candidates: DataFrame) -> DataFrame:
    """Adds encoding, randomness (p-value of the battery) and uneven (p-value where symbols are uneven) to ``value``."""
    value = F.col("value")
    encoding = (
        F.when(value.rlike("^[0-9]+$"), None)
        .when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(value.rlike("^[A-Z0-9]+=*$") & value.rlike("[0-9]") & value.rlike("[A-Z]"), "upper")
        .when(value.rlike("^[a-z2-7]+=*$") & value.rlike("[0-9]") & value.rlike("[a-z]"), "base32")
        .when(value.rlike("^[a-z0-9]+=*$") & value.rlike("[0-9]") & value.rlike("[a-z]"), "lower")
        .when(value.rlike("^[A-Za-z0-9+/_-]+=*$") & value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]"), "base64")
    )
    symbols = F.translate(F.regexp_replace(value, "=+$", ""), "-_", "+/")
    rows = candidates.withColumn("encoding", encoding).where("encoding IS NOT NULL").withColumn("symbols", F.when(F.col("encoding") == "hex", F.lower(symbols)).otherwise(symbols))

    def by_encoding(values: dict[str, object]) -> Column:
        return F.coalesce(*[F.when(F.col("encoding") == e, F.lit(v)) for e, v in values.items()])

    rows = rows.withColumn("alphabet", by_encoding(ALPHABETS)).withColumn("k", F.length("alphabet").cast("double")).withColumn("n", F.length("symbols").cast("double"))
    rows = rows.where("n >= 16").withColumn("x", F.transform(F.split("symbols", ""), lambda c: (F.call_function("instr", F.col("alphabet"), c) - 1).cast("double")))
    counts = F.transform(F.split("alphabet", ""), lambda c: F.length("symbols") - F.length(F.call_function("replace", F.col("symbols"), c, F.lit(""))))
    rows = rows.withColumn("squares", _total(F.transform(counts, lambda o: (o * o).cast("double")))).withColumn("mean", _total(F.col("x")) / F.col("n"))
    kept = [c for c in candidates.columns if c != "value"]
    rows = stored(rows.select(*kept, "encoding", "k", "n", "x", "squares", "mean"), "symbols")  # else each use computes them again
    n, k = F.col("n"), F.col("k")
    chi, df = k / n * F.col("squares") - n, k - 1
    uniform = 1 - _at_or_below((F.cbrt(F.greatest(chi, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    neighbours = F.arrays_zip(F.slice("x", F.lit(1), F.size("x") - 1).alias("a"), F.slice("x", F.lit(2), F.size("x") - 1).alias("b"))
    middle = F.col("k") / 2
    high = _total(F.transform("x", lambda v: F.when(v >= middle, 1.0).otherwise(0.0)))
    turns = _total(F.transform(neighbours, lambda p: F.when((p["a"] >= middle) != (p["b"] >= middle), 1.0).otherwise(0.0)))
    spread = _total(F.transform("x", lambda v: (v - F.col("mean")) * (v - F.col("mean"))))
    together = _total(F.transform(neighbours, lambda p: (p["a"] - F.col("mean")) * (p["b"] - F.col("mean"))))
    rows = rows.select(*kept, "encoding", "k", "n", "squares", high.alias("high"), (turns + 1).alias("runs"), spread.alias("spread"), together.alias("together"))
    rows = stored(rows, "statistics")
    both = 2 * F.col("high") * (n - F.col("high"))
    deviation = F.sqrt(F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(0.0)))
    runs = F.when(deviation > 0, _both_sides((F.col("runs") - both / n - 1) / deviation)).otherwise(0.0)
    serial = F.when(F.col("spread") > 0, _both_sides((F.col("together") / F.col("spread") + 1 / n) * F.sqrt(n))).otherwise(0.0)
    smallest = F.least(uniform, runs, serial)
    s2, s3 = by_encoding({e: v[0] for e, v in UNEVEN.items()}), by_encoding({e: v[1] for e, v in UNEVEN.items()})
    pairs = n * (n - 1)
    variance = 2 * pairs * (s2 + 2 * (n - 2) * s3 - (2 * n - 3) * s2 * s2)
    uneven = _at_or_below((F.col("squares") - n - pairs * s2) / F.sqrt(variance))
    rows = rows.withColumn("randomness", 1 - F.pow(1 - smallest, F.lit(3.0))).withColumn("uneven", uneven)
    return rows.select(*kept, "encoding", "n", "randomness", "uneven")


def discoveries(rows: DataFrame) -> DataFrame:
    """Rows of :func:`tested` that are random, and not uneven with the false discoveries of each family bounded."""
    step = F.least(F.lit(LAST_STEP), F.floor(-F.log10(F.greatest("uneven", F.lit(1e-30))) * STEPS)).cast("int")
    rows = rows.withColumn("step", step).withColumn("size_class", F.floor(2 * F.log2("n")).cast("int"))
    family = ["encoding", "size_class"]
    counts = rows.groupBy(*family, "step").agg(F.count(F.lit(1)).alias("c"))  # at most LAST_STEP + 1 rows a family
    over, all_rows = Window.partitionBy(*family).orderBy(F.desc("step")), Window.partitionBy(*family)
    counts = counts.withColumn("smaller", F.sum("c").over(over)).withColumn("tests", F.sum("c").over(all_rows))
    bound = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    limits = counts.where(bound <= FALSE_DISCOVERIES * F.col("smaller") / F.col("tests")).groupBy(*family).agg(F.min("step").alias("limit"))
    return rows.join(limits, family).where((F.col("step") >= F.col("limit")) & (F.col("randomness") >= LEAST_RANDOM))


def secrets(docs: DataFrame) -> DataFrame:
    """Per document: row, doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    found = matches(docs)
    names = ["row", "doc_id", "kind", "start", "end"]
    random = discoveries(tested(found.where("kind = 'random'"))).select(*names)
    spans = found.where("kind IS NULL OR kind <> 'random'").select(*names).unionByName(random)
    base = F.col("kind") != "random"
    before = F.max(F.when(base, F.col("end"))).over(Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(base, F.col("start"))).over(Window.partitionBy("row").orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing))
    overlaps = (F.coalesce(before, F.lit(-1)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))
    spans = spans.withColumn("overlaps", overlaps).where(F.col("kind").isNull() | base | ~F.col("overlaps"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = spans.withColumn("span", F.when(F.col("kind").isNotNull(), F.struct("start", order.alias("order"), "end", "kind")))
    rows = spans.groupBy("row", "doc_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list("span")).alias("all"),
    )

    def text(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return rows.select("row", "doc_id", "n_assign", "n_access", "n_hex", F.sha2(text(F.filter("all", lambda s: s["kind"] != "random")), 256).alias("base_sha256"), text(F.col("all")).alias("spans"), "n_random")


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets(read_table(spark, folder, "documents")).drop("row")
