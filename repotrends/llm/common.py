"""Helpers that several operators share."""

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..sources.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: its lineage ends there, so a
    lost executor costs no recomputation, and it can be read several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20


def small_batches(batches):
    """Arrow batches cut to about BATCH_BYTES, one row at least, so that rows turned into Python
    objects stay few however long they are."""
    for batch in batches:
        step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def text_blocks(batches, size: int):
    """(ids, texts) of batches with these two columns, in lists of about `size` bytes of text; a
    longer text is one by itself."""
    ids, texts, held = [], [], 0
    for batch in small_batches(batches):
        for id_, text in zip(*(c.to_pylist() for c in batch.columns)):
            ids.append(id_), texts.append(text)
            held += len(text)
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def records_of(schema: str):
    """A function that makes an Arrow batch of columns (lists or arrays) in the order of a schema.
    Call this on the driver; the function works in tasks."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return lambda columns: pa.RecordBatch.from_arrays(
        [pa.array(v, type=f.type) for v, f in zip(columns, arrow, strict=True)], schema=arrow)


def map_rows(df: DataFrame, rows, schema: str) -> DataFrame:
    """Apply `rows` in Arrow batches. It takes the columns of a batch as lists, in the order of
    `df`, and yields or returns tuples of lists (or arrays), one for each output column."""
    record = records_of(schema)

    def run(batches):
        for part in small_batches(batches):
            for out in rows(*(c.to_pylist() for c in part.columns)):
                yield record(out)

    return df.mapInArrow(run, schema)


def pack(values) -> bytes:
    """Non-negative numbers as planes of bytes, lowest first, as many as the largest needs: small
    numbers, such as the steps of rising ones, are then easily compressed."""
    values = np.ascontiguousarray(values, "<u8")
    wide = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([wide]) + values.view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes()


def unpack(data: bytes):
    """What `pack` was given, as unsigned 64-bit numbers."""
    wide = data[0]
    size = (len(data) - 1) // wide
    out = np.zeros((size, 8), np.uint8)
    out[:, :wide] = np.frombuffer(data, np.uint8, offset=1).reshape(wide, size).T
    return out.view("<u8")[:, 0]


def pack_rising(values) -> bytes:
    """Rising 64-bit numbers, by their steps."""
    return pack(np.diff(np.asarray(values, np.int64), prepend=0).view(np.uint64))


def unpack_rising(data: bytes):
    return np.cumsum(unpack(data)).view(np.int64)


def worker_cache(name: str) -> dict:
    """A dict that outlives a task, because Python workers are reused. It only saves time."""
    holder = sys.modules.setdefault("repotrends_worker_cache", types.ModuleType("cache"))
    return holder.__dict__.setdefault(name, {})


def as_bytes(name: str = "text"):
    """UTF-8 bytes of a text column; empty for null."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary").alias(name)


def wide_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of `df` has: the given ones, with underscores where they are taken."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def columns_of(df: DataFrame, names=None) -> str:
    """DDL of columns of `df`, for the schema of a map over it."""
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in names or df.columns)


def text_keys():
    """Two hashes, 96 bits together, that name a row by its doc_id and text; null-safe."""
    return F.xxhash64("doc_id", "text"), F.hash(F.col("doc_id").isNull(), F.col("text"))
