"""Tables kept by month, of which only what their commit log names is part.

Each write goes to a folder of its own (an attempt). When its rows are there, one record for each
of its months is appended to the log, all in a single file, which the writer's commit moves into
place in one step. A month's latest record says which attempt holds it; a folder without a record, such
as a killed run leaves, is never read. A record also says what the month was made from, so that a
month is made anew when that changes, and only then.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

_RECORD = "month string, attempt string, n_rows long, made_from string, number long"


class MonthlyTable:
    """A Parquet table by month. What reaches the driver is one record for each month."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, month: str = "yymm"):
        self.spark, self.path, self.schema, self.month = spark, path.rstrip("/"), schema, month

    def records(self) -> dict:
        """The latest record of each month that is held, by month."""
        try:
            log = self.spark.read.schema(_RECORD).parquet(f"{self.path}/_log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        last = log.groupBy("month").agg(
            F.max_by(F.struct("attempt", "n_rows", "made_from", "number"), F.struct("number", "attempt")).alias("last"))
        return {r["month"]: r["last"] for r in last.collect() if r["last"]["attempt"] is not None}

    def write(self, rows: DataFrame, made_from: dict | None = None, gone=()) -> None:
        """Store rows and list their months, which replaces what was held of them.

        made_from  what each month is made from; months without rows are listed as well. If it is
        left out, the months of the rows are listed.
        gone  months that are held no more.
        """
        folder = self._store(rows.select(*self.schema.fieldNames()), uuid.uuid4().hex)
        attempt = folder.rpartition("attempt=")[2]
        counts = self.spark.read.schema(self.schema).parquet(folder).groupBy(self.month).agg(
            F.count(F.lit(1)).alias("n")).collect()
        found = {r[0]: r["n"] for r in counts}
        number = 1 + max((r["number"] for r in self.records().values()), default=0)
        listed = [(m, attempt, found.get(m, 0), (made_from or {}).get(m), number) for m in (made_from or found)]
        listed += [(m, None, 0, None, number) for m in gone]
        if listed:
            self.spark.createDataFrame(listed, _RECORD).coalesce(1).write.mode("append").parquet(f"{self.path}/_log")

    def _store(self, rows: DataFrame, attempt: str) -> str:
        """Write the rows of an attempt, by month; the folder they lie in."""
        folder = f"{self.path}/rows/attempt={attempt}"
        rows.write.partitionBy(self.month).parquet(folder)
        return folder

    def stale(self, made_from: dict) -> tuple[dict, list]:
        """Of the months and what they would be made from: those to make anew; and the months that are
        held but not among them."""
        held = self.records()
        return ({m: f for m, f in made_from.items() if m not in held or held[m]["made_from"] != f},
                sorted(m for m in held if m not in made_from))

    def read(self, months=None) -> DataFrame:
        """The rows of all months that are held, or of those named."""
        paths = [f"{self.path}/rows/attempt={r['attempt']}/{self.month}={m}"
                 for m, r in sorted(self.records().items()) if r["n_rows"] and (months is None or m in months)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", f"{self.path}/rows").parquet(*paths).select(
            *self.schema.fieldNames())


def extend_dictionary(names: DataFrame, path: str) -> DataFrame:
    """(name, id): a number for every name, dense from 0; names that are new get the next ones.

    Numbers never change, so what is kept of them can be merged with what comes later. New names are
    numbered in hashed parts, each after the names of the parts before it.
    """
    spark = names.sparkSession
    table = MonthlyTable(spark, path, StructType.fromDDL("name string, id long, batch string"), "batch")
    held = table.records()
    known = table.read().select("name", "id")
    fresh = names.toDF("name").filter("name IS NOT NULL").distinct().join(known, "name", "left_anti")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fresh = fresh.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(width)))
    sizes = fresh.groupBy("part").agg(F.count(F.lit(1)).alias("n"))   # at most `width` rows
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = fresh.join(bases, "part").withColumn("at", F.expr(
        "row_number() OVER (PARTITION BY part ORDER BY name)"))
    first = sum(r["n_rows"] for r in held.values())
    batch = f"{len(held):08d}"
    table.write(numbered.select("name", (F.lit(first - 1) + F.col("base") + F.col("at")).cast("long").alias("id"),
                                F.lit(batch).alias("batch")))
    return table.read().select("name", "id")
