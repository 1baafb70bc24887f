"""Increments and refreshes that keep less on disk give the same rows."""

import datetime
import os

import micro
import pytest
from pyspark.sql import functions as F

from barloom.operators import incremental, mart
from barloom.operators.features import ml_features
from barloom.operators.indicators import technical_indicators
from barloom.plans import queries
from barloom.plans.refresh import Warehouse
from barloom.scratch import durable
from barloom.sources import star_bars, tables
from barloom.sources.tables import KeyedTable, merge_rows

DAY = datetime.timedelta(days=1)


def same(a, b):
    return a.exceptAll(b.select(a.columns)).isEmpty() and b.exceptAll(a.select(b.columns)).isEmpty()


@pytest.fixture(scope="module")
def staged(spark):
    """A long, a short and an ended series, and one that begins late."""
    wave = [100 + (7 * i % 31) / 3 for i in range(600)]
    table = micro.bars(
        spark, micro.series("A", wave), micro.series("B", wave[:40]), micro.series("C", wave[300:])
    )
    late = micro.bars(spark, micro.series("D", wave)).filter(F.col("price_date") > F.lit(micro.day(560)))
    return durable(table.unionByName(late).withColumn("extraction_timestamp", F.lit("x")))


@pytest.fixture(scope="module")
def full(staged):
    return durable(ml_features(technical_indicators(staged, keep=["sector"])))


def test_rows_since_are_the_last_of_every_symbol_and_all_newer(full):
    until = micro.day(570)
    got = incremental.rows_since(full, 21, until).collect()
    assert full.columns == incremental.rows_since(full, 21, until).columns
    for name in "ABCD":
        past = [r["price_date"] for r in full.filter(F.col("symbol") == name).collect()]
        past = sorted(d for d in past)
        want = [d for d in past if d <= until][-21:] + [d for d in past if d > until]
        assert sorted(r["price_date"] for r in got if r["symbol"] == name) == want


@pytest.mark.parametrize("day", [45, 570, 598])
def test_increments_from_these_rows_equal_those_from_all(staged, full, day):
    until = micro.day(day)
    ti = durable(technical_indicators(staged))
    stored = ti.filter(F.col("price_date") <= F.lit(until))
    lean = incremental.rows_since(stored, incremental.INDICATOR_ROWS, until)
    want = incremental.incremental_indicators(stored, staged, until)
    assert same(incremental.incremental_indicators(lean, staged, until), want)
    want = incremental.incremental_features(ti, staged, until)
    lean = incremental.rows_since(ti, incremental.FEATURE_ROWS, until)
    assert same(incremental.incremental_features(lean, staged, until), want)
    want = incremental.incremental_mart(full, until)
    lean = incremental.rows_since(full, incremental.TARGET_ROWS, until)
    assert same(incremental.incremental_mart(lean, until), want)


def test_merging_newer_rows_joins_nothing(staged):
    until = micro.day(500)
    old = staged.filter(F.col("price_date") <= F.lit(until))
    new = staged.filter(F.col("price_date") > F.lit(until))
    merged = merge_rows(old, new)
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()
    assert same(merged, staged)
    again = merge_rows(merged, new.withColumn("volume", F.lit(7).cast("bigint")))
    assert same(again.drop("volume"), staged.drop("volume"))
    assert again.filter("volume = 7").count() == new.count()


def test_rows_in_order_are_written_without_a_shuffle(spark, tmp_path, staged, monkeypatch):
    rows = technical_indicators(staged)
    shuffled = KeyedTable(str(tmp_path / "a"), rows.schema, grain="year")
    direct = KeyedTable(str(tmp_path / "b"), rows.schema, grain="year")
    hints = []
    plain = type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda df, *a: hints.append(a) or plain(df, *a))
    monkeypatch.setattr(tables, "OPEN_FILES", 1)
    shuffled.replace(rows)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    direct.replace(rows, in_order=True)
    assert hints == [("rebalance", "bucket")]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert same(direct.read(spark), shuffled.read(spark))
    assert direct.newest(spark) == shuffled.newest(spark) == micro.day(599)
    # By month a file per task and bucket would be too many.
    KeyedTable(str(tmp_path / "c"), rows.schema).replace(rows, in_order=True)
    assert len(hints) == 2


def test_bars_are_joined_with_one_dimension_after_the_other(spark, tmp_path):
    day = "timestamp'2020-01-02 00:00:00'"
    lines = [(1, 1, 1, 2.0, 10.0), (2, 1, 1, 1.0, 7.0), (3, 1, 2, 1.0, 9.0), (4, 1, 3, 1.0, 5.0)]
    spark.createDataFrame(
        lines,
        "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_quantity double, "
        "l_extendedprice double",
    ).withColumn("l_shipdate", F.expr(day)).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name, columns, rows in (
        ("supplier", "s_suppkey bigint, s_nationkey int", [(1, 5), (2, None), (3, 6)]),
        ("nation", "n_nationkey int, n_regionkey int", [(5, 8), (6, 9)]),
        ("region", "r_regionkey int, r_name string", [(8, "ASIA")]),
    ):
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    bars = star_bars.star_bars(spark, str(tmp_path))
    plan = bars._jdf.queryExecution().executedPlan().toString()
    # One exchange adds up the lines; the bars are in no shuffled join.
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in bars.collect()] == [
        ("S1", "asia", micro.datetime.date(2020, 1, 2), 5.0, 7.0, 5.0, 7.0, 3)
    ]


def raw(spark, staged):
    return staged.select(
        F.col("price_date").cast("timestamp_ntz").alias("date"), "symbol", "sector", "open_price",
        "high_price", "low_price", "close_price", "volume", "extraction_timestamp",
    )


def test_sole_reader_keeps_no_replaced_files(spark, tmp_path, staged):
    records = durable(raw(spark, staged))
    cut = F.col("date") < F.lit(micro.day(500)).cast("timestamp_ntz")
    houses = []
    for sole in (False, True):
        house = Warehouse(str(tmp_path / str(sole)), "year", mart.MartSettings(), sole)
        house.full_refresh(records.filter(cut))
        house.incremental_refresh(spark, records.filter(~cut))
        houses.append(house)
    kept, lean = houses
    assert same(kept.mart.read(spark), lean.mart.read(spark))
    assert same(kept.features.read(spark), lean.features.read(spark))

    def folders(table):
        path = table.path
        return [v for v in os.listdir(path) if v.startswith("version=") for _ in os.listdir(f"{path}/{v}")]

    live = len(lean.mart._state(spark)[1]["buckets"])
    # Of each version only live buckets are left, besides what Spark says about its job.
    buckets = [
        p for v in os.listdir(lean.mart.path) if v.startswith("version=")
        for p in os.listdir(f"{lean.mart.path}/{v}") if p.startswith("bucket=")
    ]
    assert len(buckets) == live and len(folders(kept.mart)) > len(folders(lean.mart))
    lean.delete_sources(spark)
    assert not os.path.exists(lean.features.path) and lean.mart.read(spark).count()


def test_wide_relations_are_not_stored_where_bars_suffice(spark, monkeypatch):
    kept = []
    for name in ("durable", "passing"):
        plain = getattr(queries, name)
        monkeypatch.setattr(queries, name, lambda df, f=plain: kept.append(df.columns) or f(df))
    found = queries.all_queries()
    for name in ("quality_report", "ti_incremental_rows"):
        kept.clear()
        found[name](spark, "/root/testdata/sf0.001")
        wide = [c for c in kept if "sma_200" in c]
        assert len(kept) >= 1 and len(wide) == (name == "ti_incremental_rows")
