"""Stored steps leave neither their shuffle files nor copies that were only passing."""

import os
import time

from pyspark.sql import functions as F

from barloom import scratch
from barloom.sources.tables import KeyedTable


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_after(spark, step):
    """Shuffle files that the step adds and that stay; removal may take a moment."""
    before = shuffle_files(spark)
    kept = step()
    until = time.time() + 5
    while (found := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return kept, found


def counted(spark):
    days = spark.range(2000).withColumn("price_date", F.expr("date_add(date'2020-01-01', cast(id % 900 AS int))"))
    return days.groupBy("price_date").agg(F.count(F.lit(1)).alias("rows"))


def test_stored_rows_leave_no_shuffle(spark):
    rows, left = left_after(spark, lambda: scratch.durable(counted(spark)))
    assert not left
    assert rows.count() == 900 and rows.agg(F.sum("rows")).first()[0] == 2000


def test_upsert_leaves_the_table_only(spark, tmp_path):
    rows = counted(spark)
    table = KeyedTable(str(tmp_path / "table"), rows.schema, grain="year")
    table.replace(rows)
    shared = scratch.shared_folder(spark)
    before = set(os.listdir(shared))

    def merge(stored, incoming):
        return stored.join(incoming.select("price_date"), "price_date", "left_anti").unionByName(incoming)

    newer = rows.filter("price_date >= date'2021-06-01'").withColumn("rows", F.lit(7).cast("bigint"))
    _, left = left_after(spark, lambda: table.upsert(newer, merge))
    assert not left and set(os.listdir(shared)) == before
    want = rows.withColumn("rows", F.expr("IF(price_date >= date'2021-06-01', 7, rows)"))
    got = table.read(spark)
    assert got.count() == 900 and got.exceptAll(want).isEmpty()


def test_passing_rows_are_deleted(spark):
    shared = scratch.shared_folder(spark)
    before = set(os.listdir(shared))
    with scratch.passing(counted(spark)) as rows:
        assert rows.count() == 900
        assert len(set(os.listdir(shared)) - before) == 1
    assert set(os.listdir(shared)) == before
