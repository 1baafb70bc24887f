"""URL filters: dated list entries as validity intervals, joined as of the fetch time.

A list is a history of entries (pattern, action, since): ``block``, ``allow`` or ``lift``
(from then on the pattern says nothing). Each entry is valid until the next one of its
pattern. A capture matches the host, every parent domain of it, and each of those that is
its own host followed by leading path segments. The most specific active entry decides.

Intervals are cut at month borders into the months that have captures, so the join is an
equality on pattern and month with the interval as a residual condition. A host that holds a third of all captures meets only
the entries of its own patterns that are valid in one month, and adaptive execution splits
the captures of a hot pattern.

Defined results: a null or unparsable URL or a null fetch date matches nothing and is
kept. Entries without pattern or date are ignored; of entries of one pattern and date the
greatest action in the order allow, block, lift counts. Repeated captures are judged once
each.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import durable

OPEN_END = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host without port, user or a leading ``www.``; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def path_segments(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def candidates(captures: DataFrame, depths: list[int]) -> DataFrame:
    """capture_id, fetched, pattern, specificity of every pattern a capture can match.

    One a domain level, and one for each of ``depths`` that its path has segments for.
    """
    labels = F.split("host", r"\.")
    found = captures.select(
        "capture_id", "fetched", host_of(F.col("url")).alias("host"),
        path_segments(F.col("url")).alias("path"),
    ).filter(F.col("host").isNotNull() & F.col("fetched").isNotNull())
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(
            F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern"),
            (F.size(labels) - i + 1).alias("specificity"),
        ),
    )
    paths = F.transform(
        F.filter(
            F.array(*map(F.lit, depths)).cast("array<int>"), lambda i: i <= F.size("path")
        ),
        lambda i: F.struct(
            F.concat("host", F.lit("/"), F.array_join(F.slice("path", F.lit(1), i), "/")).alias(
                "pattern"
            ),
            (F.size(labels) + i).alias("specificity"),
        ),
    )
    return found.select("capture_id", "fetched", F.inline(F.concat(domains, paths)))


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, action, since, until (exclusive) of entries that say something."""
    valid = entries.filter(F.col("pattern").isNotNull() & F.col("since").isNotNull())
    one = valid.groupBy("pattern", "since").agg(F.max("action").alias("action"))
    # One pattern's history is bounded by the calendar after the step above.
    order = Window.partitionBy("pattern").orderBy("since")
    until = F.coalesce(F.lead("since").over(order), F.lit(OPEN_END).cast("date"))
    return one.select("pattern", "action", "since", until.alias("until")).filter("action != 'lift'")


def fetch_months(captures: DataFrame) -> list[date]:
    """First days of the months that have captures: as many as the calendar has, at most."""
    found = captures.select(F.trunc("fetched", "month").alias("month")).distinct()
    return sorted(r["month"] for r in found.filter("month is not null").collect())


def path_depths(valid: DataFrame) -> list[int]:
    """Numbers of path segments that patterns have, without 0."""
    found = valid.select((F.size(F.split("pattern", "/")) - 1).alias("depth")).distinct()
    return sorted(r["depth"] for r in found.filter("depth > 0").collect())


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """capture_id, n_active, decided_by, action, blocked of every capture.

    ``captures`` has capture_id, url and fetched (date); identifiers are unique or repeated
    rows are equal.
    """
    listed = durable(intervals(entries))
    tried = candidates(captures, path_depths(listed)).withColumn(
        "month", F.trunc("fetched", "month")
    )
    months = fetch_months(captures)
    valid = listed.select(
        "pattern", "action", "since", "until",
        F.explode(
            F.filter(
                F.array(*map(F.lit, months)).cast("array<date>"),
                lambda m: (m >= F.trunc("since", "month")) & (m < F.col("until")),
            )
        ).alias("month"),
    )
    active = tried.join(valid, ["pattern", "month"]).filter(
        (F.col("since") <= F.col("fetched")) & (F.col("fetched") < F.col("until"))
    )
    best = active.groupBy("capture_id").agg(
        F.count_distinct("pattern").alias("n_active"),
        F.max(F.struct("specificity", "pattern", "action")).alias("best"),
    )
    return captures.select("capture_id").join(best, "capture_id", "left").select(
        "capture_id",
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("best.pattern").alias("decided_by"),
        F.col("best.action").alias("action"),
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
    )


def digit(text: Column, at: int, width: int) -> Column:
    """Some hexadecimal digits of the MD5 of a text as a number."""
    return F.conv(F.substring(F.md5(text), at, width), 16, 10).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures from pages, which carry no fetch time: a day of 2024 from the identifier."""
    day = F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")
    return pages.select(
        F.col("page_id").alias("capture_id"),
        "url",
        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched"),
    )


def list_of(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts and paths that the pages have.

    The digits of a pattern's MD5 fix its history: listed on some day, and for most
    patterns changed or lifted on a later one. A quarter of the paths are listed.
    """
    found = pages.select(host_of(F.col("url")).alias("host"), path_segments(F.col("url")).alias("p"))
    hosts = found.filter("host is not null").select(F.col("host").alias("pattern"))
    paths = found.filter("host is not null and size(p) > 0").select(
        F.concat("host", F.lit("/"), F.get("p", F.lit(0))).alias("pattern")
    )
    patterns = hosts.distinct().unionByName(
        paths.distinct().filter(digit(F.col("pattern"), 1, 1) < 4)
    )
    first = F.when(digit(F.col("pattern"), 2, 1) < 10, "block").otherwise("allow")
    second = (
        F.when(digit(F.col("pattern"), 3, 1) < 6, "lift")
        .when(digit(F.col("pattern"), 3, 1) < 11, "allow")
        .otherwise("block")
    )
    start = F.date_add(F.lit("2023-10-01").cast("date"), digit(F.col("pattern"), 4, 2))
    later = F.date_add(start, 1 + digit(F.col("pattern"), 6, 2))
    return patterns.select(
        "pattern",
        F.inline(
            F.array(
                F.struct(first.alias("action"), start.alias("since")),
                F.struct(second.alias("action"), later.alias("since")),
            )
        ),
    )
