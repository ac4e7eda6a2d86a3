"""Key and row-count checks."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate key over {', '.join(keys)}")
    return df


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row per named table with its number of rows."""
    counts = [
        df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
