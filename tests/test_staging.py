import datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators.staging import stage_prices
from barloom.schemas import INDICATORS, RAW, STAGED, SchemaDrift, conform
from barloom.sources import prices

AT = datetime.datetime(2020, 1, 2)


def raw(spark, *rows):
    return spark.createDataFrame(
        [
            (r[0], r[1], "GOLD", 1.0, 3.0, 0.5, r[2], 10, r[3])
            for r in rows
        ],
        RAW,
    )


def test_latest_extraction_wins_over_case_and_missing_stamps(spark):
    staged = stage_prices(
        raw(
            spark,
            (AT, "abc", 1.0, "2020-01-03T00:00:00"),
            (AT, "ABC", 2.0, "2020-01-04T00:00:00"),
            (AT, "Abc", 9.0, None),
            (AT, "ABC", None, "2020-01-05T00:00:00"),
            (AT, None, 5.0, "2020-01-05T00:00:00"),
            (None, "ABC", 5.0, "2020-01-05T00:00:00"),
            (AT, "XYZ", 7.0, None),
        )
    )
    rows = {r["symbol"]: r for r in staged.collect()}
    assert set(rows) == {"ABC", "XYZ"}
    assert rows["ABC"]["close_price"] == 2.0
    assert rows["ABC"]["sector"] == "gold"
    assert rows["ABC"]["daily_range"] == 2.5
    assert rows["XYZ"]["close_price"] == 7.0
    assert staged.schema.simpleString() == STAGED.simpleString()


def test_many_copies_of_one_key_combine_before_the_shuffle(spark):
    copies = raw(spark, (AT, "ABC", 1.0, "2020-01-03T00:00:00")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(50_000))).alias("copy")
    )
    stamped = copies.withColumn(
        "extraction_timestamp", F.concat(F.lit("2020-"), F.lpad(F.col("copy"), 6, "0"))
    ).withColumn("close_price", F.col("copy").cast("double"))
    staged = stage_prices(stamped.select(*RAW.fieldNames()))
    assert [r["close_price"] for r in staged.collect()] == [50_000.0]
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_late_policy(spark):
    source = raw(
        spark,
        (AT, "ABC", 1.0, "a"),
        (AT + datetime.timedelta(days=1), "ABC", 2.0, "a"),
    )
    assert stage_prices(source, AT.date()).count() == 1
    assert stage_prices(source, AT.date(), late="merge").count() == 2
    with pytest.raises(ValueError):
        stage_prices(source, AT.date(), late="maybe")


def test_watermark_reaches_the_scan(spark, tmp_path):
    raw(spark, (AT, "ABC", 1.0, "a")).write.parquet(str(tmp_path / "raw"))
    staged = stage_prices(prices.read_raw(spark, str(tmp_path / "raw")), AT.date())
    plan = staged._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(date" in pushed and "IsNotNull(symbol)" in pushed


def test_schema_drift_is_refused(spark):
    staged = stage_prices(raw(spark, (AT, "ABC", 1.0, "a")))
    assert conform(staged.select(*reversed(STAGED.fieldNames())), STAGED).columns == (
        STAGED.fieldNames()
    )
    with pytest.raises(SchemaDrift, match="unexpected extra"):
        conform(staged.withColumn("extra", F.lit(1)), STAGED)
    with pytest.raises(SchemaDrift, match="missing volume"):
        conform(staged.drop("volume"), STAGED)
    with pytest.raises(SchemaDrift, match="volume is int"):
        conform(staged.withColumn("volume", F.col("volume").cast("int")), STAGED)
    with pytest.raises(SchemaDrift):
        conform(staged, INDICATORS)


def test_bad_records_are_rejected_and_the_rest_goes_on(spark, tmp_path):
    lines = [
        '{"Date": "2024-01-02T00:00:00+11:00", "Symbol": "A", "Open": "1", "High": "2",'
        ' "Low": "0.5", "Close": "1.5", "Volume": "100.0"}',
        '{"Date": "2024-01-03", "Symbol": "B", "Open": "x", "High": "2", "Low": "1",'
        ' "Close": "1", "Volume": "1"}',
        '{"Date": "soon", "Symbol": "A", "Open": "1", "High": "2", "Low": "1", "Close": "1",'
        ' "Volume": "1"}',
        "{broken",
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    (tmp_path / "empty.json").write_text("")
    delivered = prices.read_delivered(spark, str(tmp_path))
    dim = prices.sector_dim(spark, {"gold": ["A"]})
    good = prices.normalise(delivered, dim, "2024-02-01T00:00:00").collect()
    assert len(good) == 1
    # the wall clock is kept, not shifted to another zone
    assert good[0]["date"] == datetime.datetime(2024, 1, 2)
    assert good[0]["sector"] == "gold" and good[0]["volume"] == 100
    reasons = sorted(r["reason"] for r in prices.rejects(delivered).collect())
    assert reasons == ["invalid date", "invalid open_price", "unreadable record"]


def test_fetch_start():
    now, cursor = datetime.date(2024, 3, 1), datetime.date(2024, 2, 10)
    assert prices.fetch_start(None, now) == datetime.date(2024, 1, 31)
    assert prices.fetch_start(cursor, now) == datetime.date(2024, 2, 9)
    assert prices.fetch_start(cursor, now, datetime.date(2020, 1, 1)) == datetime.date(2020, 1, 1)


def test_unknown_sector(spark):
    dim = prices.sector_dim(spark, {"gold": ["A"], "oil": []})
    tagged = prices.tag_sector(spark.createDataFrame([("A",), ("Z",)], "symbol string"), dim)
    assert {tuple(r) for r in tagged.select("symbol", "sector").collect()} == {
        ("A", "gold"),
        ("Z", "unknown"),
    }
