"""Quality rules with thresholds that adapt to language and source, JVM-side only.

Each rule value of a document falls into a logarithmic bucket; the counts per bucket are a
quantile sketch with a fixed relative error that merges by addition. So one partial
aggregation over all documents gives the sketches of every (language, source), and adding
those up gives languages and the whole corpus, which stand in for groups with few
documents. Fences at a multiple of the interquartile range above (and, for word length,
below) the quartiles replace fixed cutoffs, and documents are filtered by a join.

Defined results: a null text is empty; a text without words has zero counts, fails the
base rule and enters no sketch. Null languages and sources are groups of their own.
Windows are compared by two 32- and 64-bit hashes, so a chance of about 1e-20 per pair of
windows of one document remains that different windows count as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WORD, durable

WINDOW = 8
MIN_WORDS = 20
GAMMA = 1.02
MIN_GROUP = 200
NO_VALUE = -(2**31)
#: rule: (multiples of the spread allowed, least spread)
FENCES = {
    "symbol_share": (6, 0.02),
    "dup_line_share": (6, 0.05),
    "repeat_share": (6, 0.05),
    "word_length": (8, 0.3),
}
TWO_SIDED = ("word_length",)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(docs: DataFrame) -> DataFrame:
    """The given columns but the text, and the counts that the rules use."""
    kept = [c for c in docs.columns if c != "text" and c not in (*MEASURES, "n_lines")]
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    first = docs.select(
        *kept,
        F.regexp_extract_all(text, F.lit(f"({WORD})"), 1).alias("_words"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    number = F.size("_words")
    windows = F.transform(
        F.sequence(F.lit(0), number - WINDOW),
        lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
    )
    second = first.select(
        *kept,
        number.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "_words",
        F.when(number >= WINDOW, windows).alias("_windows"),
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    check = F.transform(
        "_windows", lambda _, i: F.hash(*[F.get("_words", i + k) for k in range(WINDOW)])
    )
    at = F.sequence(F.lit(0), F.size("_windows") - 1)
    third = second.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.when(
            repeated,
            F.sort_array(
                F.zip_with(
                    F.arrays_zip(F.col("_windows").alias("a"), check.alias("b")),
                    at,
                    lambda h, i: F.struct(h["a"].alias("a"), h["b"].alias("b"), i.alias("at")),
                )
            ),
        ).alias("_sorted"),
    )
    fourth = third.withColumn("_marked", _repeated_positions("_sorted"))
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("_marked") - 1),
        F.lit(WINDOW).cast("long"),
        lambda sum_, i: sum_
        + F.least(F.lit(WINDOW), F.get("_marked", i) - F.get("_marked", i - 1)).cast("long"),
    )
    words = (
        F.when(F.coalesce(F.size("_marked"), F.lit(0)) <= 0, F.lit(0).cast("long"))
        .when(F.size("_marked") == 1, F.lit(WINDOW).cast("long"))
        .otherwise(covered)
    )
    return fourth.withColumn("n_repeat_words", words).drop("_sorted", "_marked")


def _repeated_positions(name: str) -> Column:
    """Positions of the windows that equal a neighbour in hash order, ascending."""

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    equal = F.filter(
        name, lambda x, i: same(x, F.get(name, i - 1)) | same(x, F.get(name, i + 1))
    )
    return F.sort_array(F.transform(equal, lambda x: x["at"]))


def rule_values() -> dict[str, Column]:
    has = F.col("n_words") > 0
    return {
        "symbol_share": F.when(has, F.col("n_symbols") / F.col("word_chars")),
        "dup_line_share": F.when(has, F.col("n_dup_lines") / F.col("n_lines")),
        "repeat_share": F.when(has, F.col("n_repeat_words") / F.col("n_words")),
        "word_length": F.when(has, F.col("word_chars") / F.col("n_words")),
    }


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rule, bucket, n: the quantile sketch of each group and rule."""
    values = [
        F.struct(F.lit(rule).alias("rule"), value.alias("value"))
        for rule, value in rule_values().items()
    ]
    long = measured.select("lang", "source", F.inline(F.array(*values))).filter("value is not null")
    bucket = F.when(
        F.col("value") > 0, F.ceil(F.log("value") / F.lit(GAMMA_LOG)).cast("int")
    ).otherwise(NO_VALUE)
    return long.groupBy("lang", "source", "rule", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


GAMMA_LOG = 0.01980262729617973  # natural logarithm of GAMMA


def fences(sketch: DataFrame) -> DataFrame:
    """lang, source and, per rule, the bounds ``low_<rule>`` and ``high_<rule>``.

    A group with fewer than ``MIN_GROUP`` documents takes the bounds of its language, and
    those of all documents where the language has too few as well.
    """
    levels = {"own": ["lang", "source"], "lang": ["lang"], "all": []}
    bounds = {level: _bounds(sketch, keys) for level, keys in levels.items()}
    own = bounds["own"].alias("own")
    by_lang = bounds["lang"].alias("by_lang")
    of_all = bounds["all"].alias("of_all")
    joined = own.join(
        by_lang,
        F.col("own.lang").eqNullSafe(F.col("by_lang.lang"))
        & (F.col("own.rule") == F.col("by_lang.rule")),
    ).join(of_all, F.col("own.rule") == F.col("of_all.rule"))

    def chosen(bound: str) -> Column:
        return (
            F.when(F.col("own.n") >= MIN_GROUP, F.col(f"own.{bound}"))
            .when(F.col("by_lang.n") >= MIN_GROUP, F.col(f"by_lang.{bound}"))
            .otherwise(F.col(f"of_all.{bound}"))
        )

    flat = joined.select(
        F.col("own.lang").alias("lang"),
        F.col("own.source").alias("source"),
        F.col("own.rule").alias("rule"),
        chosen("low").alias("low"),
        chosen("high").alias("high"),
    )
    return flat.groupBy("lang", "source").agg(
        *[
            F.max(F.when(F.col("rule") == rule, F.col(bound))).alias(f"{bound}_{rule}")
            for rule in FENCES
            for bound in ("low", "high")
        ]
    )


def _bounds(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the sketches of a level and read the quartiles.

    A sketch has some thousand buckets at most, and the quartiles are found by a running
    sum inside one merged sketch.
    """
    from pyspark.sql import Window

    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    ranked = merged.select(
        *keys,
        "rule",
        "bucket",
        F.sum("n").over(group.orderBy("bucket")).alias("up_to"),
        F.sum("n").over(group).alias("total"),
    )

    def quartile(k: int) -> Column:
        b = F.min(F.when(4 * F.col("up_to") >= k * F.col("total"), F.col("bucket")))
        return F.when(b == NO_VALUE, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), b))

    times = F.lit(None).cast("double")
    least = F.lit(None).cast("double")
    for rule, (k, spread) in FENCES.items():
        times = F.when(F.col("rule") == rule, F.lit(float(k))).otherwise(times)
        least = F.when(F.col("rule") == rule, F.lit(float(spread))).otherwise(least)
    found = ranked.groupBy(*keys, "rule").agg(
        F.max("total").alias("n"), quartile(1).alias("q1"), quartile(3).alias("q3")
    )
    reach = times * F.greatest(F.col("q3") - F.col("q1"), least)
    low = F.when(F.col("rule").isin(*TWO_SIDED), F.col("q1") - reach)
    return found.select(*keys, "rule", "n", low.alias("low"), (F.col("q3") + reach).alias("high"))


def judge(measured: DataFrame) -> DataFrame:
    """Measured documents with ``base_failed`` and ``kept``.

    ``measured`` is read twice: pass a stored table. The join is on the group; the table
    of bounds has one row a group and Spark broadcasts it while it is small.
    """
    bounds = fences(sketches(measured))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    )
    inside = F.lit(True)
    for rule, value in rule_values().items():
        inside = inside & (value <= F.col(f"high_{rule}"))
        if rule in TWO_SIDED:
            inside = inside & (value >= F.col(f"low_{rule}"))
    limits = bounds.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(
        limits,
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    )
    return joined.select(
        *measured.columns,
        base_failed.alias("base_failed"),
        (~base_failed & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, ``base_failed`` and ``kept`` of every document."""
    measured = durable(measures(docs.select("doc_id", "text", "lang", "source")))
    return judge(measured).select("doc_id", *MEASURES, "base_failed", "kept")
