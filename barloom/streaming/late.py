"""Streams parted into records in time and late ones, without losing either.

Every key has a mark, the newest day seen in earlier batches. A record more than ``delay_days``
behind the mark of its key is late. Spark's own watermark drops such records; here they go
to a table of their own. The marks after a batch are stored under its number, so a batch that
is repeated after a failure meets the same marks and replaces its own rows.

Marks are the only state: one row a key, made by partial maxima, joined to the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.pointer import Folder


@dataclass(frozen=True)
class LateSplit:
    """A folder with the parted rows, the marks and the checkpoint of one stream.

    A record without day is in time, as nothing tells its age; so is one without key, and
    the first records of a key. Records of one batch do not make each other late.
    """

    path: str
    schema: T.StructType
    delay_days: int = 1
    key: str = "symbol"
    date_column: str = "date"

    def run_available(self, stream: DataFrame) -> None:
        """Part everything that has landed since the last run."""
        query = (
            stream.writeStream.foreachBatch(self._part)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def kept(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).filter("not late").drop("late", "batch")

    def late(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).filter("late").drop("late", "batch")

    def marks(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """key, mark: the newest day of every key in all batches, or in those before one."""
        found = [n for n in self._marked(spark) if before is None or n < before]
        schema = T.StructType([self.schema[self.key], T.StructField("mark", T.DateType())])
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._marks_of(max(found)))

    def _part(self, batch: DataFrame, number: int) -> None:
        spark, day = batch.sparkSession, F.to_date(self.date_column)
        before = self.marks(spark, number)
        fields = [F.col(c) for c in self.schema.fieldNames()]
        late = F.coalesce(day < F.date_sub("mark", self.delay_days), F.lit(False))
        (
            batch.select(*fields)
            .join(before, self.key, "left")
            .select(*fields, late.alias("late"))
            .write.mode("overwrite")
            .partitionBy("late")
            .parquet(f"{self.path}/rows/batch={number}")
        )
        seen = batch.groupBy(self.key).agg(F.max(day).alias("mark")).dropna()
        merged = before.unionByName(seen).groupBy(self.key).agg(F.max("mark").alias("mark"))
        merged.write.mode("overwrite").parquet(self._marks_of(number))
        for old in self._marked(spark):
            if old < number - 1:
                Folder(spark, f"{self.path}/marks").delete(f"after={old:012d}")

    def _marked(self, spark: SparkSession) -> list[int]:
        """Batches whose marks are complete."""
        folder = Folder(spark, f"{self.path}/marks")
        return [
            int(name.removeprefix("after="))
            for name in folder.names()
            if "_SUCCESS" in folder.names(name)
        ]

    def _marks_of(self, number: int) -> str:
        return f"{self.path}/marks/after={number:012d}"

    def _rows(self, spark: SparkSession) -> DataFrame:
        parts = [T.StructField("batch", T.LongType()), T.StructField("late", T.BooleanType())]
        stored = T.StructType([*self.schema.fields, *parts])
        if not Folder(spark, f"{self.path}/rows").names():
            return spark.createDataFrame([], stored)
        return spark.read.schema(stored).parquet(f"{self.path}/rows")
