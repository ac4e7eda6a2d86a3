"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into so few segments that, of two fingerprints within the allowed
distance, one segment differs by at most one bit. Every segment is indexed whole and with each of
its bits replaced by a wildcard; fingerprints that meet in an equality join are verified.
"""

from functools import reduce
from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, columns_of, fresh, map_rows, stored, text_keys
from .components import components

BITS = 64


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included.

    Words are runs of other than ASCII white space, with A-Z in lower case. A bit is set if over
    half of the shingles' XXH64 values have it. Fewer words than `size` are one shingle; a text
    without words has fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < size else list(
        map(b" ".join, zip(*(words[i:] for i in range(size)))))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        part = shingles[at:at + (1 << 16)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(seed)), "<u8", len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, size: int = 3, keep=("doc_id",)) -> DataFrame:
    """The columns of `keep` and `fp`, one row for each row of `docs` (null text: no words)."""
    def rows(*columns):
        yield *columns[:-1], [fingerprint(t, size) for t in columns[-1]]

    return map_rows(docs.select(*keep, as_bytes()), rows, f"{columns_of(docs, keep)}, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment: with k // 2 + 1 of them, one differs by at most one bit."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _variants(value: str, width: int) -> str:
    """SQL array of (place of the wildcard, value without that bit, the bit); -1: no wildcard."""
    return (
        f"concat(array(named_struct('place', -1, 'rest', {value}, 'bit', 0L)), "
        f"transform(sequence(0, {width - 1}), i -> named_struct('place', i, "
        f"'rest', {value} & ~shiftleft(1L, i), 'bit', shiftrightunsigned({value}, i) & 1L)))"
    )


def _index(prints: DataFrame, segments) -> DataFrame:
    parts = []
    for number, (shift, width) in enumerate(segments):
        value = f"(shiftrightunsigned(fp, {shift}) & {(1 << width) - 1 if width < 64 else -1}L)"
        parts.append(prints.select("fp", F.expr(f"explode({_variants(value, width)})").alias("v"))
                     .select("fp", F.lit(number).alias("segment"), "v.*"))
    return reduce(DataFrame.union, parts)


def _crowded(prints: DataFrame, segments, limit: int) -> DataFrame:
    """Segment values that more than `limit` fingerprints share, as index keys."""
    parts = []
    for number, (shift, width) in enumerate(segments):
        value = f"(shiftrightunsigned(fp, {shift}) & {(1 << width) - 1 if width < 64 else -1}L)"
        busy = prints.groupBy(F.expr(value).alias("value")).agg(F.count(F.lit(1)).alias("n")).filter(
            F.col("n") > limit)
        parts.append(busy.select(F.expr(f"explode({_variants('value', width)})").alias("v"))
                     .select(F.lit(number).alias("segment"), "v.place", "v.rest"))
    return reduce(DataFrame.union, parts).distinct()


def _finer(crowd: DataFrame, segments) -> DataFrame:
    """Give the rows of crowded keys finer keys, by the same method on the other bits.

    The other bits are again cut in two. Two rows that share a whole segment differ by at most two
    of them, so in one half by at most one bit: whole halves and one-wildcard halves will do. Rows
    that meet under a wildcard differ by at most one of them, so one half is the same.
    """
    parts = []
    for number, (shift, width) in enumerate(segments):
        others = [p for p in range(BITS) if not shift <= p < shift + width]
        for half in (others[:len(others) // 2], others[len(others) // 2:]):
            mask = sum(1 << p for p in half)
            own = f"(fp & {mask - (1 << BITS) if mask >> 63 else mask}L)"
            whole = f"array(named_struct('place2', -1, 'rest2', {own}, 'bit2', 0L))"
            variants = (
                f"transform(array({', '.join(map(str, half))}), i -> named_struct('place2', i, "
                f"'rest2', {own} & ~shiftleft(1L, i), 'bit2', shiftrightunsigned(fp, i) & 1L))")
            parts.append(crowd.filter(F.col("segment") == number).select(
                "*", F.lit(half[0]).alias("half"),
                F.expr(f"explode(if(place < 0, concat({whole}, {variants}), {whole}))").alias("w"))
                .select("fp", "segment", "place", "rest", "bit", "half", "w.*"))
    return reduce(DataFrame.union, parts)


def _meet(index: DataFrame, keys, wildcards, distance: int) -> DataFrame:
    """Verified pairs of an index. Under a wildcard, rows meet those with the opposite bit; the
    others meet under the whole segment. `wildcards` has (place, bit) columns."""
    def side(name):
        return index.select(
            *keys, F.col("fp").alias(name), *(F.col(bit).alias(f"{bit}_{name}") for _, bit in wildcards))

    met = (F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    for place, bit in wildcards:
        met = met & ((F.col(place) < 0) | (F.col(f"{bit}_a") != F.col(f"{bit}_b")))
    return side("a").join(side("b"), list(keys)).filter(met).select("a", "b")


def links(prints: DataFrame, distance: int = 2, crowd: int = 512) -> DataFrame:
    """Pairs `(a, b)`, a > b, of different fingerprints that differ by at most `distance` bits.

    `prints` has distinct values of `fp`. Keys that more than `crowd` fingerprints share get finer
    keys, so no key's fingerprints are all compared with each other; `crowd` moves work only.
    """
    segments = _segments(distance)
    index = _index(prints, segments)
    keys, wildcard = ["segment", "place", "rest"], ("place", "bit")
    # Finer keys rest on at most two differing bits; a longer distance is compared key by key.
    busy = stored(_crowded(prints, segments, crowd), "crowded") if 0 < distance <= 2 else None
    if busy is None or busy.isEmpty():
        return _meet(index, keys, [wildcard], distance).distinct()
    calm = _meet(index.join(busy, keys, "left_anti"), keys, [wildcard], distance)
    fine = _meet(_finer(index.join(busy, keys, "left_semi"), segments),
                 [*keys, "half", "place2", "rest2"], [wildcard, ("place2", "bit2")], distance)
    return calm.union(fine).distinct()


def linked_fingerprints(prints: DataFrame, distance: int = 2) -> DataFrame:
    """`(fp, root)`: root is the smallest fingerprint reachable by links."""
    found = components(links(prints, distance))
    return prints.join(found, prints["fp"] == found["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def _members(prints: DataFrame, distance: int) -> DataFrame:
    """`(fp, root, component_id)` of fingerprinted documents."""
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-groups")
    members = stored(
        groups.join(linked_fingerprints(groups.select("fp"), distance), "fp"), "members")
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    return members.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = 2) -> DataFrame:
    """One row for each row of `docs`: doc_id, fp, component_id.

    Fingerprints link at `distance` or fewer differing bits; `component_id` is the smallest doc_id
    of the documents reachable by links. Null and empty texts have fingerprint 0. A null doc_id is
    never the smallest; a component of such rows has a null id. Repeated rows stay. Other columns
    of `docs` are not read.
    """
    prints = stored(with_fingerprints(docs.select("doc_id", "text"), size), "fingerprints")
    return prints.join(_members(prints, distance), "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(col="fp"):
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def drop_near_duplicates(docs: DataFrame, size: int = 3, distance: int = 2) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component one row with the smallest
    doc_id stays. Where several rows have it, any one text and its least row stay."""
    by_id, by_text = text_keys()
    keyed = docs.select("doc_id", "text", by_id.alias("k1"), by_text.alias("k2"))
    prints = stored(with_fingerprints(keyed, size, ("doc_id", "k1", "k2")), "fingerprints")
    first = prints.join(_members(prints, distance), "fp").filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min(F.struct("k1", "k2")).alias("least")).select("least.*")
    k1, k2 = fresh(docs, "k1", "k2")
    named = docs.select(F.struct(*docs.columns).alias("row"), by_id.alias(k1), by_text.alias(k2))
    kept = named.join(first.toDF(k1, k2), [k1, k2], "left_semi")
    return kept.groupBy(k1, k2).agg(F.min("row").alias("row")).select("row.*")
