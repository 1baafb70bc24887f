import datetime

import micro
import pytest
from pyspark.sql import functions as F

from barloom.operators import incremental, indicators, mart, staging
from barloom.operators.features import ml_features
from barloom.operators.mart import MartSettings
from barloom.plans.queries import StoppedRun, failing_at
from barloom.plans.refresh import Warehouse
from barloom.schemas import RAW, STAGED, SchemaDrift
from barloom.scratch import durable
from barloom.sources.pointer import ChangedMeanwhile
from barloom.sources.star_bars import raw_prices
from barloom.sources.tables import KeyedTable, merge_rows, save_bucketed, watermark
from barloom.streaming import ingest

SF = "/root/testdata/sf0.001"
W = datetime.date(2001, 1, 1)


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def digits(df, places=8):
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


@pytest.fixture(scope="module")
def staged(spark):
    return durable(staging.stage_prices(raw_prices(spark, SF)))


@pytest.mark.parametrize("grain", ["month", "year"])
def test_upsert_replaces_adds_and_can_be_replayed(spark, tmp_path, staged, grain):
    table = KeyedTable(str(tmp_path / "t"), STAGED, grain=grain)
    assert table.read(spark).count() == 0
    base = staged.filter(F.col("price_date") <= F.lit(W))
    changes = staged.filter(F.col("price_date") > F.lit(datetime.date(2000, 11, 10))).withColumn(
        "volume", F.col("volume") + 1
    )
    table.upsert(base)
    assert same(table.read(spark), base)
    want = merge_rows(base, changes)
    for _ in range(2):
        table.upsert(changes)
        assert same(table.read(spark), want)
    recent = table.read(spark, since=W)
    assert recent.count() == want.filter(F.col("price_date") >= F.lit(W)).count()
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert watermark(table.read(spark)) == watermark(staged)
    table.upsert(changes.limit(0))
    assert table.read(spark).count() == want.count()
    with pytest.raises(SchemaDrift):
        table.upsert(changes.drop("sector"))


def test_untouched_partitions_keep_their_files(spark, tmp_path, staged):
    table = KeyedTable(str(tmp_path / "t"), STAGED, grain="year")
    table.replace(staged)

    def files():
        return {(p.parent.name, p.name) for p in (tmp_path / "t").rglob("*.parquet")}

    before = files()
    table.upsert(staged.filter(F.year("price_date") == 2000))
    # readers of the old state may still be at work
    assert before <= files()
    table.vacuum(spark)
    assert {bucket for bucket, _ in before - files()} == {"bucket=2000-01-01"}
    assert same(table.read(spark), staged)


@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_a_write_that_dies_leaves_the_table_as_it_was(spark, tmp_path, staged, monkeypatch, step):
    table = KeyedTable(str(tmp_path / "t"), STAGED, grain="year")
    old = durable(staged.filter(F.year("price_date") <= 2000))
    changes = durable(
        staged.filter(F.year("price_date") >= 2000).withColumn("volume", F.col("volume") + 1)
    )
    table.replace(old)
    held = table.read(spark)
    plain = getattr(KeyedTable, step)

    def dies(self, *args):
        if step == "_write":  # all files are there, but the state still names the old ones
            plain(self, *args)
        raise StoppedRun

    for change in (lambda: table.upsert(changes), lambda: table.replace(changes)):
        monkeypatch.setattr(KeyedTable, step, dies)
        with pytest.raises(StoppedRun):
            change()
        monkeypatch.undo()
        assert same(table.read(spark), old) and table.newest(spark) == watermark(old)
    table.upsert(changes)
    assert same(table.read(spark), merge_rows(old, changes))
    assert table.newest(spark) == watermark(staged)
    # a reader that planned before the write still finds its files
    assert same(held, old)
    table.vacuum(spark)
    assert same(table.read(spark), merge_rows(old, changes))
    live = {p.parent.parent.name for p in (tmp_path / "t").rglob("*.parquet")}
    assert len(live) == 2 and not list((tmp_path / "t").glob("_fresh-*"))


def test_two_writers_of_one_state(spark, tmp_path, staged, monkeypatch):
    table = KeyedTable(str(tmp_path / "t"), STAGED, grain="year")
    table.replace(staged.limit(10))
    plain = KeyedTable._write

    def slow(self, df):
        monkeypatch.undo()
        table.replace(staged)
        return plain(self, df)

    monkeypatch.setattr(KeyedTable, "_write", slow)
    with pytest.raises(ChangedMeanwhile):
        table.upsert(staged.limit(5))
    assert same(table.read(spark), staged)


def test_the_watermark_and_a_range_need_no_scan_of_the_table(spark, tmp_path, staged):
    table = KeyedTable(str(tmp_path / "t"), STAGED, grain="month")
    table.replace(staged)
    want = watermark(staged)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    newest = table.newest(spark)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    assert newest == want
    assert {f.split("bucket=")[1][:7] for f in table.read(spark, since=newest).inputFiles()} == {
        newest.isoformat()[:7]
    }
    table.clear(spark)
    assert table.newest(spark) is None and table.read(spark).isEmpty()


def test_one_hot_bucket_is_split_over_files(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.lit(micro.day(1)).alias("price_date"),
        F.format_string("S%d", F.col("id")).alias("symbol"),
        F.sha2(F.col("id").cast("string"), 512).alias("note"),
    )
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        table = KeyedTable(str(tmp_path / "t"), rows.schema, grain="day")
        table.replace(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) > 1
    assert table.read(spark).count() == 200_000


def test_bucketed_table_needs_no_shuffle_for_windows(spark, tmp_path, staged):
    save_bucketed(staged, "staged_by_symbol", str(tmp_path / "b"), 4)
    try:
        df = indicators.technical_indicators(spark.table("staged_by_symbol"))
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == staged.count()
    finally:
        spark.sql("DROP TABLE staged_by_symbol")


def test_rows_lookback_finds_old_rows_beyond_the_horizon(spark):
    """One symbol paused for years: its context lies before the recent partitions."""
    old = micro.series("PAUSED", range(1, 31))
    live = micro.series("LIVE", range(1, 1201))
    resumed = [("PAUSED", micro.day(1199), "gold", 9.0, 9.0, 9.0, 9.0, 100, 0.0)]
    table = micro.bars(spark, old, live, resumed)
    until = micro.day(1198)
    stored = indicators.technical_indicators(table.filter(F.col("price_date") <= F.lit(until)))
    fresh = table.filter(F.col("price_date") > F.lit(until))
    for horizon in (1, 50, 5000):
        added = incremental.incremental_indicators(stored, fresh, until, horizon)
        full = indicators.technical_indicators(table).filter(F.col("price_date") > F.lit(until))
        assert added.count() == 2 and same(digits(added), digits(full)), horizon


def test_new_symbol_without_history(spark):
    table = micro.bars(
        spark,
        micro.series("OLD", range(1, 20)),
        [("NEW", micro.day(18), "oil", 1.0, 1.0, 1.0, 1.0, 5, 0.0)],
    )
    until = micro.day(15)
    stored = indicators.technical_indicators(table.filter(F.col("price_date") <= F.lit(until)))
    added = incremental.incremental_indicators(stored, table, until)
    full = indicators.technical_indicators(table).filter(F.col("price_date") > F.lit(until))
    assert same(digits(added), digits(full))


def test_daily_increments_end_like_one_full_run(spark):
    table = durable(micro.bars(spark, micro.series("A", [50 + (i * 7) % 13 for i in range(60)])))
    full = ml_features(indicators.technical_indicators(table), table)
    stored = mart.training_mart(full.filter(F.col("price_date") <= F.lit(micro.day(54))))
    for n in range(54, 59):
        seen = full.filter(F.col("price_date") <= F.lit(micro.day(n + 1)))
        stored = durable(merge_rows(stored, incremental.incremental_mart(seen, micro.day(n))))
    assert same(digits(stored), digits(mart.training_mart(full)))


def test_only_real_corrections_count_as_changes(spark):
    stored = micro.bars(spark, micro.series("A", [1, 2, 3]), micro.series("B", [1, 2, 3]))
    again = stored.withColumn("extraction_timestamp", F.lit("newer"))
    assert incremental.changed_rows(again, stored).isEmpty()
    fixed = again.withColumn(
        "close_price",
        F.when(
            (F.col("symbol") == "B") & (F.col("price_date") == F.lit(micro.day(1))), 9.0
        ).otherwise(F.col("close_price")),
    ).withColumn("sector", F.when(F.col("symbol") == "B", F.col("sector")))
    stored = stored.withColumn("sector", F.when(F.col("symbol") == "B", F.col("sector")))
    changed = incremental.changed_rows(fixed, stored).collect()
    assert [(r["symbol"], r["price_date"]) for r in changed] == [("B", micro.day(1))]
    assert incremental.changed_rows(fixed, stored.limit(0)).count() == 6


@pytest.mark.parametrize("late", ["drop", "merge"])
def test_warehouse_increments_equal_a_full_refresh(spark, tmp_path, late):
    raw = durable(raw_prices(spark, SF))
    cuts = [datetime.date(2000, 7, 1), datetime.date(2000, 8, 15)]
    day = F.to_date("date")
    # europe's records of June arrive after the first run
    june = (F.upper("sector") == "EUROPE") & (day.between("2000-06-01", "2000-06-30"))
    first = raw.filter((day < F.lit(cuts[0])) & ~june | day.isNull())
    second = raw.filter((day >= F.lit(cuts[0])) & (day < F.lit(cuts[1])) | june)
    third = raw.filter(day >= F.lit(cuts[1]))
    house = Warehouse(str(tmp_path / "inc"), "year", MartSettings())
    house.full_refresh(first)
    for records in (second, third, third):
        house.incremental_refresh(spark, records, late)
    known = raw if late == "merge" else raw.filter(~F.coalesce(june, F.lit(False)))
    full = Warehouse(str(tmp_path / "full"), "year", MartSettings())
    full.full_refresh(known)
    for name in ("staged", "indicators", "features", "mart"):
        got, want = getattr(house, name).read(spark), getattr(full, name).read(spark)
        assert same(digits(got, 6), digits(want, 6)), name


def test_stream_restarts_replays_and_takes_late_corrections(spark, tmp_path):
    raw = durable(raw_prices(spark, SF))
    (tmp_path / "landing").mkdir()
    landing, log = str(tmp_path / "landing"), str(tmp_path / "log")
    table = KeyedTable(str(tmp_path / "t"), STAGED, grain="year")
    dated = raw.withColumn("y", F.coalesce(F.year("date"), F.lit(0)))
    stream = ingest.price_stream(spark, landing, files_per_trigger=3)

    def land(condition):
        rows = dated.filter(condition).drop("y").select(*RAW.fieldNames())
        rows.coalesce(2).write.mode("append").parquet(landing)
        ingest.ingest_available(stream, table, log)

    land(F.col("y") >= 1999)
    first = table.read(spark).count()
    land(F.col("y") < 1999)
    assert table.read(spark).count() > first
    want = staging.stage_prices(raw)
    assert same(table.read(spark), want)
    # the same files delivered again, and a checkpoint that was lost
    ingest.ingest_available(stream, table, str(tmp_path / "log2"))
    assert same(table.read(spark), want)
    stale = raw.filter(F.col("date") < F.lit(W)).withColumn("extraction_timestamp", F.lit("1999"))
    stale.coalesce(1).write.mode("append").parquet(landing)
    ingest.ingest_available(stream, table, log)
    assert same(table.read(spark), want)


def test_first_seen_drops_rows_behind_the_watermark(spark, tmp_path):
    def rows(*days):
        return spark.createDataFrame(
            [
                (datetime.datetime.combine(micro.day(d), datetime.time()), "A", "g", 1.0, 1.0,
                 1.0, float(d), 1, "x")
                for d in days
            ],
            RAW,
        ).coalesce(1)

    landing, out, log = (str(tmp_path / n) for n in ("landing", "out", "log"))
    (tmp_path / "landing").mkdir()
    first = ingest.first_seen(ingest.price_stream(spark, landing, 1), "2 days")
    for days in ((10, 11, 11), (11, 12, 2), (20,), (3, 21)):
        rows(*days).write.mode("append").parquet(landing)
        ingest.append_available(first, out, log)
    got = sorted(r["price_date"] for r in spark.read.parquet(out).collect())
    # day 2 and day 3 come after the watermark has passed them
    assert got == [micro.day(d) for d in (10, 11, 12, 20, 21)]


@pytest.mark.parametrize("table", ["raw", "staged", "indicators", "features", "mart"])
def test_late_corrections_survive_a_failed_run(spark, tmp_path, table):
    """The run that brought them dies before a table; the next one has the new days only."""
    raw = durable(raw_prices(spark, SF).filter(F.upper("sector") == "ASIA"))
    raw = raw.filter(F.col("date").isNotNull())
    cut = F.lit(datetime.date(2000, 7, 1)).cast("timestamp_ntz")
    early = raw.filter((F.col("date") < cut) & F.col("close_price").isNotNull())
    fixed = early.orderBy(F.desc("date"), "symbol").limit(1)
    fixed = fixed.withColumn("close_price", F.col("close_price") * 2)
    fixed = durable(fixed.withColumn("extraction_timestamp", F.lit("9999")))
    assert fixed.count() == 1
    later = raw.filter(F.col("date") >= cut)
    house = Warehouse(str(tmp_path / "inc"), "year", MartSettings())
    house.full_refresh(raw.filter(F.col("date") < cut))
    with pytest.raises(StoppedRun), failing_at(getattr(house, table).path):
        house.incremental_refresh(spark, later.unionByName(fixed), "merge")
    house.incremental_refresh(spark, later, "drop")
    full = Warehouse(str(tmp_path / "full"), "year", MartSettings())
    full.full_refresh(raw.unionByName(fixed))
    for name in ("staged", "indicators", "features", "mart"):
        got, want = getattr(house, name).read(spark), getattr(full, name).read(spark)
        assert same(digits(got, 6), digits(want, 6)), name
    key = ["date", "symbol", "close_price"]
    assert house.raw.read(spark).join(fixed.select(*key), key).count() == 1
    assert house.journal.read(spark).isEmpty()


@pytest.mark.parametrize(
    ("late", "table"),
    [("merge", "staged"), ("merge", "indicators"), ("drop", "features"), ("merge", "mart")],
)
def test_a_run_after_a_failed_one_completes_every_table(spark, tmp_path, late, table):
    raw = durable(raw_prices(spark, SF).filter(F.upper("sector") == "ASIA"))
    cut = F.lit(datetime.date(2000, 7, 1)).cast("timestamp_ntz")
    early = raw.filter((F.col("date") < cut) & F.col("close_price").isNotNull())
    fixed = early.orderBy(F.desc("date"), "symbol").limit(1)
    fixed = fixed.withColumn("close_price", F.col("close_price") + 1)
    fixed = durable(fixed.withColumn("extraction_timestamp", F.lit("9999")))
    assert fixed.count() == 1
    later = durable(raw.filter(F.col("date") >= cut).unionByName(fixed))
    house = Warehouse(str(tmp_path / "inc"), "year", MartSettings())
    house.full_refresh(raw.filter(F.col("date") < cut))
    with pytest.raises(StoppedRun), failing_at(getattr(house, table).path):
        house.incremental_refresh(spark, later, late)
    house.incremental_refresh(spark, later, late)
    full = Warehouse(str(tmp_path / "full"), "year", MartSettings())
    known = raw.filter(F.col("date").isNotNull())
    full.full_refresh(known.unionByName(fixed) if late == "merge" else known)
    for name in ("staged", "indicators", "features", "mart"):
        got, want = getattr(house, name).read(spark), getattr(full, name).read(spark)
        assert same(digits(got, 6), digits(want, 6)), name


def test_an_increment_without_staged_rows_keeps_the_stored_raw_records(spark, tmp_path):
    raw = durable(raw_prices(spark, SF).filter(F.upper("sector") == "ASIA"))
    house = Warehouse(str(tmp_path / "w"), "year", MartSettings())
    early = F.col("date") < F.lit(W).cast("timestamp_ntz")
    house.raw.replace(raw.filter(early))
    house.incremental_refresh(spark, raw.filter(F.col("date") >= F.lit(W).cast("timestamp_ntz")))
    keys = raw.filter(F.col("date").isNotNull()).select("date", "symbol").distinct()
    assert house.raw.read(spark).select("date", "symbol").distinct().count() == keys.count()
    assert house.mart.newest(spark) is not None
