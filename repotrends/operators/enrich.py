"""Metadata joins and per-repository language choice."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from ..schemas import ENRICHED, METADATA, OTHER_LANGUAGE, TARGET_LANGUAGES

def one_row_per_key(df: DataFrame, keys) -> DataFrame:
    """One row per key, the smallest in column order, so every run keeps the same one."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row")).select(*keys, "row.*")


def matching_rows(df: DataFrame, other: DataFrame, keys, bits: int = 1 << 22) -> DataFrame:
    """The rows of `df` that may have a partner in `other`, told where they are read, before any shuffle.

    The keys of `other` set one bit each, by hash, in an array of `bits` bits (half a megabyte), which goes
    to the tasks as a constant. Rows whose bit is not set have no partner; a few others pass as well: a
    share of the rows of at most the number of the keys divided by `bits`. So a join must follow, and
    gives the same as without this step. Worth its pass over the keys of `other` if they are
    few beside those of `df`. Rows with a NULL key have no partner.
    """
    def place(rows):
        return F.pmod(F.xxhash64(*(rows[k].cast("string") for k in keys)), F.lit(bits))

    spark = df.sparkSession
    held = other.dropna(subset=list(keys)).select(place(other).alias("at"))
    words = held.groupBy(F.floor(F.col("at") / 64).cast("long").alias("id")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").cast("int") % 64)).alias("word"))
    every = spark.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    array = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "word"))), lambda w: w["word"]).alias("words"))
    at = place(df)
    word = F.get(array.scalar(), F.floor(at / 64).cast("int"))
    return df.dropna(subset=list(keys)).filter(F.call_function("bit_get", word, at.cast("int") % 64) == 1)


def hot_keys(df: DataFrame, keys, min_rows: int) -> DataFrame:
    """The keys with at least `min_rows` rows, and their rows `n`."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)


def salt_of(rows: DataFrame, keys):
    """A row's salt, drawn from all columns of `rows`, beside a column `salts` with the number that its key
    has (NULL for one). Rows with a NULL key match nothing and are spread as well."""
    nulls = reduce(or_, (F.col(k).isNull() for k in keys))
    drawn = F.xxhash64(*rows.columns)
    return F.when(nulls, F.pmod(drawn, F.lit(1 << 30))).otherwise(
        F.pmod(drawn, F.coalesce("salts", F.lit(1)))).cast("int")


def _salted_join(left, right, keys, min_rows):
    """Left join that spreads each hot key of `left`, one salt for every `min_rows` rows of it.

    Only the rows of hot keys are copied on the right, once per salt. Every left row has
    one salt and meets all right rows of its key, so the result is the plain join's.
    The list of hot keys is broadcast: it has at most one key for every `min_rows` rows, so a
    million for 10^12 rows at the default. Joined by a shuffle on the key, it would gather the
    very rows that the salt is to spread.
    """
    salts = F.broadcast(hot_keys(left, keys, min_rows).select(
        *keys, F.ceil(F.col("n") / min_rows).cast("int").alias("salts")))
    salt = salt_of(left, keys)
    copies = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    left = left.join(salts, keys, "left").withColumn("salt", salt)
    right = right.join(salts, keys, "left").withColumn("salt", F.explode(copies))
    return left.drop("salts").join(right.drop("salts"), [*keys, "salt"], "left").drop("salt")


def metadata_side(meta: DataFrame, match: str, dedupe: bool):
    """The keys that a match joins on, and the metadata as it meets the pushes."""
    keys = ["repo_name", "head_sha"] if match == "head" else ["repo_name"]
    if match == "repo":
        meta = meta.drop("head_sha")
    meta = meta.select(*[c for c in METADATA.fieldNames() if c in meta.columns])
    return keys, one_row_per_key(meta, keys) if dedupe else meta


def attach_metadata(pushes: DataFrame, meta: DataFrame, match: str = "repo", dedupe: bool = False,
                    skew: str = "adaptive", hot_rows: int = 1_000_000, keep=()) -> DataFrame:
    """Every push with its repository's metadata; unmatched pushes keep NULL metadata.

    match   "repo": by repository name, so a repository sampled in k months gives k rows
            per push. "head": by name and head commit.
    dedupe  keep one metadata row per key first.
    skew    "adaptive": one left join. Catalyst broadcasts the metadata if its measured
            size allows; else the adaptive skew join splits a hot repository's pushes.
            "salted": spread hot repositories explicitly, `hot_rows` pushes to a salt,
            whatever the session's settings. Costs one more pass over the pushes' keys, so pass a stored table.
            "both": also for metadata with a hot key. A left join cannot split its right
            side, so matches come from an inner join, which may split both, and the
            unmatched pushes from an anti join against the distinct keys.
    keep    columns of the pushes that come along beside the usual ones.
    """
    keys, meta = metadata_side(meta, match, dedupe)
    if skew == "salted":
        joined = _salted_join(pushes, meta, keys, hot_rows)
    elif skew == "both":
        unmatched = pushes.join(meta.select(*keys).distinct(), keys, "left_anti")
        joined = pushes.join(meta, keys).unionByName(unmatched, allowMissingColumns=True)
    else:
        joined = pushes.join(meta, keys, "left")
    return joined.select(*ENRICHED.fieldNames(), *keep)


def language_rows(breakdown: DataFrame, col: str = "breakdown") -> DataFrame:
    """A map of language to bytes per repository, as one row per language."""
    return breakdown.select("repo_name", F.explode(col).alias("language", "bytes"))


def dominant_category(rows: DataFrame, key: str = "repo_name", category: str = "language",
                      weight: str = "bytes", allowed=TARGET_LANGUAGES,
                      name: str = "primary_language") -> DataFrame:
    """Per key the allowed category with the most weight; ties go to the first name, rows
    without a weight count nothing."""
    return rows.filter(F.col(category).isin(*allowed) & F.col(weight).isNotNull()).groupBy(key).agg(
        F.min_by(category, F.struct(-F.col(weight), F.col(category))).alias(name)
    )


def attach_dominant(df: DataFrame, dominant: DataFrame, key: str = "repo_name",
                    name: str = "primary_language", fallback: str = OTHER_LANGUAGE) -> DataFrame:
    """Add the dominant category to each row, `fallback` where there is none."""
    return df.join(dominant, key, "left").withColumn(name, F.coalesce(name, F.lit(fallback)))
