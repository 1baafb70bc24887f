import datetime

import micro
from pyspark.sql import functions as F

from barloom.sources.tables import merge_rows

ROWS = "symbol string, price_date date, v int"


def plain_merge(stored, incoming):
    kept = stored.join(incoming.select("symbol", "price_date"), ["symbol", "price_date"], "left_anti")
    return kept.unionByName(incoming)


def test_merge_equals_the_plain_join_with_nulls_and_copies(spark):
    days = [None, *[micro.day(n) for n in range(1, 9)]]
    stored = [(s, d, n) for n, d in enumerate(days) for s in ("A", "B", "C", None)] * 2
    changes = [("A", micro.day(3), 90), ("A", micro.day(5), 91), ("A", micro.day(5), 92)]
    changes += [("B", None, 93), (None, micro.day(2), 94), ("D", micro.day(1), 95)]
    stored = spark.createDataFrame(stored, ROWS)
    for rows in (changes, []):
        incoming = spark.createDataFrame(rows, ROWS)
        got, want = merge_rows(stored, incoming), plain_merge(stored, incoming)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_merge_passes_rows_outside_the_incoming_days_without_a_shuffle(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.concat(F.lit("S"), (F.col("id") % 10).cast("string")).alias("symbol"),
        F.date_add(F.lit(datetime.date(1990, 1, 1)), (F.col("id") / 10).cast("int")).alias("price_date"),
        F.col("id").cast("int").alias("v"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    cut = F.lit(datetime.date(1994, 1, 1))
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "10000")
    try:
        merged = merge_rows(rows.filter(F.col("price_date") <= cut), rows.filter(F.col("price_date") > cut))
        plan = merged._jdf.queryExecution().executedPlan()
        while plan.nodeName() != "Union":
            plan = plan.children().apply(0)
        assert "hashpartitioning" not in plan.children().apply(0).toString()
        assert merged.count() == 20_000
    finally:
        for key, value in zip(keys, before, strict=True):
            spark.conf.set(key, value)
