"""Tables that lie by key, so that joins on it, however often they are repeated, don't shuffle them."""

import hashlib
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.enrich import hot_keys, salt_of
from .monthly import MonthlyTable

SALT = "bucket_salt"
PARTS = 64   # in which the hot keys of a write are listed


class BucketedTable(MonthlyTable):
    """A table by month whose rows are dealt into buckets by `keys`.

    A task of a write or a join takes one bucket, so their number follows the rows: `buckets` at least,
    and twice as many as often as the held and the new rows ask for, to be no more than `bucket_rows` to
    a bucket. Writes of the same number of buckets lie together and are joined together; there is
    one such level for each doubling of the table. The attempts of higher levels end in their number.

    The rows of a hot key, one with over `hot_rows` rows in a write, would all meet in one bucket. They
    get a salt, one for every `hot_rows` of them, and the buckets go by key and salt. How many salts a
    key has is kept beside the rows, one entry at most for every `hot_rows` rows.

    Spark learns of buckets through its catalog only, so a session declares the stored folder of a level as
    a table when it first reads it. Which of its folders count is told by the commit log, as ever. A
    table of another least number of buckets, or of other keys, needs a folder of its own.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys, buckets: int,
                 hot_rows: int = 1_000_000, month: str = "yymm", bucket_rows: int = 2_000_000):
        super().__init__(spark, path, schema, month)
        self.keys, self.buckets, self.hot_rows, self.bucket_rows = list(keys), buckets, hot_rows, bucket_rows
        self._stored = StructType([f for f in schema.fields if f.name != month] + [StructField(SALT, IntegerType())])
        self._hot = StructType([schema[k] for k in self.keys] + [StructField("salts", IntegerType())])

    def _level(self, attempt: str) -> int:
        """The number of buckets of an attempt."""
        return int(attempt.partition("-")[2] or self.buckets)

    def _place(self, buckets: int) -> tuple[str, str]:
        """The folder of a level, and its name in the catalog."""
        named = f"{self.path} {self.keys} {buckets} {self.schema.simpleString()}"
        folder = f"{self.path}/rows" + (f"-{buckets}" if buckets != self.buckets else "")
        return folder, "bucketed_" + hashlib.sha256(named.encode()).hexdigest()[:24]

    def _store(self, rows: DataFrame, attempt: str) -> str:
        hot, counted = (f"{self.path}/{name}/attempt={attempt}" for name in ("hot", "counted"))
        # The pass that finds hot keys counts all rows as well, those with a NULL key too.
        named = F.struct(*self.keys, F.ceil(F.col("n") / self.hot_rows).cast("int").alias("salts"))
        is_hot = reduce(and_, (F.col(k).isNotNull() for k in self.keys), F.col("n") >= self.hot_rows)
        hot_keys(rows, self.keys, 0).groupBy(F.pmod(F.xxhash64(*self.keys), F.lit(PARTS)).alias("part")).agg(
            F.sum("n").alias("n"), F.collect_list(F.when(is_hot, named)).alias("hot")).write.parquet(counted)
        counts = self.spark.read.parquet(counted)
        counts.select(F.inline("hot")).write.parquet(hot)
        n = (counts.agg(F.sum("n")).first()[0] or 0) + sum(r["n_rows"] for r in self.records().values())
        buckets = self.buckets
        while n > buckets * self.bucket_rows:
            buckets *= 2
        place, name = self._place(buckets)
        attempt += f"-{buckets}" if buckets != self.buckets else ""
        folder = f"{place}/attempt={attempt}"
        salts = F.broadcast(self.spark.read.schema(self._hot).parquet(hot))
        salted = rows.join(salts, self.keys, "left").withColumn(SALT, salt_of(rows, self.keys)).select(
            *self._stored.fieldNames(), self.month)
        # Dealt as the buckets are, so a task writes one file of a month and bucket.
        written = f"{name}_{attempt}".replace("-", "_")
        salted.repartition(buckets, *self.keys, SALT).write.partitionBy(self.month).bucketBy(
            buckets, *self.keys, SALT).option("path", folder).format("parquet").saveAsTable(written)
        self.spark.sql(f"DROP TABLE {written}")   # forgets the name; the files stay
        return folder

    def _levels(self, months=None) -> list[DataFrame]:
        """The rows that are held, with their salts, those of each level by themselves."""
        levels = {}
        for m, r in sorted(self.records().items()):
            if r["n_rows"] and (months is None or m in months):
                levels.setdefault(self._level(r["attempt"]), {}).setdefault(r["attempt"], []).append(m)
        if not levels:
            return [self.spark.createDataFrame([], StructType(self.schema.fields + [StructField(SALT, IntegerType())]))]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._stored)
        by = ", ".join(f"`{k}`" for k in (*self.keys, SALT))
        found = []
        for buckets, attempts in sorted(levels.items()):
            folder, name = self._place(buckets)
            place = folder.replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}, attempt string, `{self.month}` string) USING parquet "
                f"PARTITIONED BY (attempt, `{self.month}`) CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'")
            self.spark.catalog.recoverPartitions(name)   # the catalog's list of folders, which grows with the writes
            held = F.lit(False)
            for attempt, own in attempts.items():
                held = held | ((F.col("attempt") == attempt) & F.col(self.month).isin(own))
            found.append(self.spark.table(name).filter(held).select(*self.schema.fieldNames(), SALT))
        return found

    def _rows(self, months=None) -> DataFrame:
        """The rows that are held, with their salts."""
        return reduce(DataFrame.unionByName, self._levels(months))

    def read(self, months=None) -> DataFrame:
        """The rows of all months that are held, or of those named."""
        return self._rows(months).drop(SALT)

    def salts(self) -> DataFrame:
        """How many salts each hot key has: (keys, salts)."""
        attempts = sorted({r["attempt"].partition("-")[0] for r in self.records().values()})
        if not attempts:
            return self.spark.createDataFrame([], self._hot)
        hot = self.spark.read.schema(self._hot).parquet(*(f"{self.path}/hot/attempt={a}" for a in attempts))
        return hot.groupBy(*self.keys).agg(F.max("salts").alias("salts"))

    def join(self, other: DataFrame, how: str = "left", months=None) -> DataFrame:
        """The stored rows joined with `other` on the keys; only `other` is shuffled. Its rows of a hot
        key are copied, one for each salt; every stored row has one salt, so the result is the plain
        join's. `how`: left, inner, left_semi or left_anti."""
        copies = other.join(F.broadcast(self.salts()), self.keys, "left").withColumn(
            SALT, F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
        return reduce(DataFrame.unionByName, (
            rows.join(copies, [*self.keys, SALT], how) for rows in self._levels(months))).drop(SALT)
