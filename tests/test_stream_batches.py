import datetime

import micro
import pytest

from barloom.plans import queries
from barloom.schemas import RAW, STAGED
from barloom.sources.tables import KeyedTable
from barloom.streaming import ingest


def landed(spark, landing, *records):
    rows = [
        (datetime.datetime.combine(micro.day(d), datetime.time()), "A", "g", 1.0, 1.0, 1.0, close, 1, at)
        for d, close, at in records
    ]
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(landing)


def test_a_run_of_many_batches_writes_every_bucket_once(spark, tmp_path, monkeypatch):
    landing, log = str(tmp_path / "landing"), str(tmp_path / "log")
    for n in range(1, 5):
        landed(spark, landing, (n, float(n), "2001"), (1, 10.0 - n, f"200{n}"))
    table, writes, plain = KeyedTable(str(tmp_path / "t"), STAGED, grain="year"), [], KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, df: writes.append(1) or plain(self, df))
    stream = ingest.price_stream(spark, landing, files_per_trigger=1)
    ingest.ingest_available(stream, table, log)
    assert len(writes) == 1
    got = {r["price_date"]: r["close_price"] for r in table.read(spark).collect()}
    assert got == {micro.day(1): 6.0, **{micro.day(n): float(n) for n in (2, 3, 4)}}
    ingest.ingest_available(stream, table, log)
    assert len(writes) == 1


def test_batches_of_a_run_that_died_before_the_merge_are_merged_by_the_next(
    spark, tmp_path, monkeypatch
):
    landing, log = str(tmp_path / "landing"), str(tmp_path / "log")
    table = KeyedTable(str(tmp_path / "t"), STAGED, grain="year")
    (tmp_path / "landing").mkdir()
    stream = ingest.price_stream(spark, landing, files_per_trigger=1)

    def dies(*args, **kwargs):
        raise queries.StoppedRun

    landed(spark, landing, (1, 1.0, "2001"))
    landed(spark, landing, (2, 2.0, "2001"))
    with monkeypatch.context() as patched:
        patched.setattr(KeyedTable, "upsert", dies)
        with pytest.raises(queries.StoppedRun):
            ingest.ingest_available(stream, table, log)
    landed(spark, landing, (2, 5.0, "2003"))
    ingest.ingest_available(stream, table, log)
    got = sorted((r["price_date"], r["close_price"]) for r in table.read(spark).collect())
    assert got == [(micro.day(1), 1.0), (micro.day(2), 5.0)]
