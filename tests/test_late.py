"""Late records of a stream go to a table of their own, none is lost, batches can be repeated."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from barloom.schemas import RAW
from barloom.sources.pointer import Folder
from barloom.streaming import late as late_module
from barloom.streaming.ingest import price_stream
from barloom.streaming.late import LateSplit

DAY = datetime.datetime(2000, 1, 1)


def records(seed, count):
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        date = None if rng.random() < 0.05 else DAY + datetime.timedelta(days=rng.randrange(40))
        symbol = None if rng.random() < 0.05 else rng.choice(["HOT", "HOT", "HOT", "B", "C"])
        rows.append((date, symbol, "X", 1.0, 2.0, 0.5, float(n), seed, f"{seed}-{n}"))
    return rows + rows[:3]


def parted_by_hand(arrivals, delay):
    marks, kept, late = {}, [], []
    for rows in arrivals:
        before = dict(marks)
        for r in rows:
            date, symbol = r[0], r[1]
            mark = before.get(symbol) if symbol is not None else None
            behind = mark and date and date < mark - datetime.timedelta(days=delay)
            (late if behind else kept).append(r)
            if date and symbol is not None:
                marks[symbol] = max(marks.get(symbol, date), date)
    return kept, late, marks


def key(row):
    return tuple(str(x) for x in row)


def check(spark, split, arrivals, delay):
    kept, late, marks = parted_by_hand(arrivals, delay)
    assert sorted(map(key, split.kept(spark).collect())) == sorted(map(key, kept))
    assert sorted(map(key, split.late(spark).collect())) == sorted(map(key, late))
    assert {r.symbol: r.mark for r in split.marks(spark).collect()} == {
        s: d.date() for s, d in marks.items()
    }
    return late


def land(spark, folder, rows):
    spark.createDataFrame(rows, RAW).coalesce(2).write.mode("append").parquet(folder)


def test_kept_and_late_are_the_input(spark, tmp_path):
    landing, split = str(tmp_path / "in"), LateSplit(str(tmp_path / "out"), RAW, delay_days=5)
    arrivals = [records(n, 60) for n in range(3)]
    for n, rows in enumerate(arrivals):
        land(spark, landing, rows)
        split.run_available(price_stream(spark, landing))
        late = check(spark, split, arrivals[: n + 1], 5)
    assert len(late) > 20
    split.run_available(price_stream(spark, landing))
    check(spark, split, arrivals, 5)
    assert len(Folder(spark, f"{split.path}/marks").names()) <= 2


@pytest.mark.parametrize("dies", ["rows", "marks"])
def test_batch_that_died_is_repeated(spark, tmp_path, monkeypatch, dies):
    landing, split = str(tmp_path / "in"), LateSplit(str(tmp_path / "out"), RAW, delay_days=5)
    arrivals = [records(n, 40) for n in (10, 11)]
    land(spark, landing, arrivals[0])
    split.run_available(price_stream(spark, landing))
    land(spark, landing, arrivals[1])
    plain = LateSplit._marks_of

    def dying(self, number):
        if number == 1:
            raise RuntimeError("stopped")
        return plain(self, number)

    def no_day(name):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if dies == "marks":
            m.setattr(LateSplit, "_marks_of", dying)
        else:
            m.setattr(late_module.F, "to_date", no_day)
        with pytest.raises(Exception, match="stopped"):
            split.run_available(price_stream(spark, landing))
    split.run_available(price_stream(spark, landing))
    check(spark, split, arrivals, 5)


def test_nothing_has_come_yet(spark, tmp_path):
    split = LateSplit(str(tmp_path / "out"), RAW)
    assert split.kept(spark).isEmpty() and split.late(spark).isEmpty()
    assert split.marks(spark).isEmpty()
    assert split.kept(spark).schema.fieldNames() == RAW.fieldNames()


def test_late_side_is_pruned_by_folder(spark, tmp_path):
    landing, split = str(tmp_path / "in"), LateSplit(str(tmp_path / "out"), RAW, delay_days=5)
    land(spark, landing, records(1, 30))
    split.run_available(price_stream(spark, landing))
    plan = split.late(spark).select(F.count("symbol"))._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(late" in plan.toString()
