"""Best-fit packing of tokenized documents by large-item matching.

The plan depends on the number of pieces of each length only, so it is made from at most
`capacity` counts; pieces are then dealt to its places by their rank among those of their length.
"""

import gc
import os
from itertools import chain
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import as_bytes, map_rows, records_of, stored, text_blocks, worker_cache

KEPT_WORDS = 700_000   # different words that a worker keeps, about 200 bytes each
TOGETHER = 500         # words that are encoded as one text
BLOCK = 2 << 20        # bytes of text that are encoded together, about
LONG = 64              # bytes of a word that is kept
SIGN = b"~"
BUCKET = 4096


class Encoder:
    """Token ids of texts. White space separates tokens in every case, so words are encoded alone, and
    a worker keeps those it has seen, up to a bound, for its next tasks as well. It starts anew once it is
    full and does not know most of a block's words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        cache = worker_cache("tokenizers")
        if path not in cache:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            cache[path] = Tokenizer.from_file(path)
        self.tokenizer, self.known = cache[path], worker_cache("encoded words").setdefault(path, {})
        ids = self.tokenizer.encode(SIGN.decode(), add_special_tokens=False).ids
        self.sign = ids[0] if len(ids) == 1 else None

    def __call__(self, texts) -> list[bytes]:
        """Little-endian 32-bit token ids of each text, then id 0."""
        gc.disable()   # words are many small objects without cycles
        split = [t.lower().split() for t in texts]   # A-Z, which the tokenizer lower-cases in any case
        known = self.known
        words = set().union(*split)
        new = list(words.difference(known))
        if len(known) >= KEPT_WORDS and 2 * len(new) > len(words):
            known.clear()
            new = list(words)
        known.update(self._encode([w for w in new if SIGN not in w], True))
        known.update(self._encode([w for w in new if SIGN in w], False))
        out = [b"".join(map(known.__getitem__, words)) + bytes(4) for words in split]
        room = KEPT_WORDS - (len(known) - len(new))
        for n, word in enumerate(new):
            if n >= room or len(word) > LONG:
                del known[word]
        gc.enable()
        return out

    def _encode(self, words, together: bool):
        """(word, ids) of words. Many are encoded as one text, with a sign between them that none has."""
        size = TOGETHER if together and self.sign else 1
        parts = [words[at:at + size] for at in range(0, len(words), size)]
        joined = self.tokenizer.encode_batch_fast(
            [(b" " + SIGN + b" ").join(p).decode() for p in parts], add_special_tokens=False)
        for part, found in zip(parts, joined):
            ids = np.array(found.ids, "<u4")
            if len(part) == 1:
                yield part[0], ids.tobytes()
                continue
            ends = np.flatnonzero(ids == self.sign)
            if len(ends) + 1 != len(part):   # a word has the sign's id for another reason
                yield from self._encode(part, False)
                continue
            data, stops = ids.tobytes(), (4 * ends).tolist()
            yield from ((w, data[lo:hi]) for w, lo, hi in zip(part, [0, *(e + 4 for e in stops)], [*stops, len(data)]))


def token_ids(texts, path: str) -> list[bytes]:
    return Encoder(path)(texts)


def pieces(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids of all documents cut at `capacity` tokens."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    record = records_of(schema)

    def run(batches):
        encode = Encoder(path)
        for ids, texts in text_blocks(batches, BLOCK):
            out = [[] for _ in range(6)]
            for doc_id, tokens in zip(ids, encode(texts)):
                for piece, start in enumerate(range(0, len(tokens) // 4, capacity)):
                    part = tokens[4 * start:4 * (start + capacity)]
                    for column, value in zip(out, (doc_id, piece, start, len(part) // 4, crc32(part), part)):
                        column.append(value)
            yield record(out)

    return docs.select("doc_id", as_bytes()).mapInArrow(run, schema)


def plan(counts: dict, capacity: int) -> list[tuple]:
    """Steps `(length, first rank, items, first bin, items in a bin, offset in the bin)`.

    Items over a third of the capacity: from the longest down, each pairs with the longest other
    that fits. The smaller ones, from the longest down, go where the least room is left that holds
    them, else to new bins. Bins with the same contents form ranges, so the work and the number of
    steps depend on the capacity, not on the number of items.
    """
    left = {size: n for size, n in counts.items() if n}
    used, steps, bins = dict.fromkeys(left, 0), [], 0
    room = [[] for _ in range(capacity + 1)]   # by free space: ranges (first bin, number of bins)
    open_sizes = 0                             # bit mask of the free spaces that have ranges

    def put(size, n, first_bin, copies, offset):
        steps.append((size, used[size], n, first_bin, copies, offset))
        used[size] += n
        left[size] -= n

    def add(free, first_bin, n):
        nonlocal open_sizes
        if n:
            room[free].append((first_bin, n))
            open_sizes |= 1 << free

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for size in large:
        for mate in large:
            if left[size] and mate <= min(size, capacity - size) and left[mate]:
                pairs = left[size] // 2 if mate == size else min(left[size], left[mate])
                if pairs and mate == size:
                    put(size, 2 * pairs, bins, 2, 0)
                elif pairs:
                    put(size, pairs, bins, 1, 0)
                    put(mate, pairs, bins, 1, size)
                add(capacity - size - mate, bins, pairs)
                bins += pairs
        if left[size]:
            add(capacity - size, bins, left[size])
            bins += left[size]
            put(size, left[size], bins - left[size], 1, 0)
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            fitting = open_sizes >> size
            if fitting:
                free = size + (fitting & -fitting).bit_length() - 1
                first, n = room[free].pop()
                if not room[free]:
                    open_sizes &= ~(1 << free)
            else:
                free, first, n = capacity, bins, -(-left[size] // (capacity // size))
                bins += n
            copies = free // size
            full = min(n, left[size] // copies)
            if not full:
                full, copies = 1, left[size]
            put(size, full * copies, first, copies, capacity - free)
            add(free - copies * size, first, full)
            add(free, first + full, n - full)
    return steps


def _ranked(cut: DataFrame, n: int) -> tuple[DataFrame, dict]:
    """Number the pieces of each length from 0, and count them.

    A length's pieces are dealt to buckets by hash, counted, and numbered within their bucket after
    the buckets before it, so that a frequent length is no single task.
    """
    buckets = max(16, -(-n // BUCKET))
    key = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    sizes = stored(dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*key)) - 1
    ranked = dealt.withColumn("inside", inside).join(bases, ["length", "bucket"]).withColumn(
        "rank", F.col("base") + F.col("inside"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    return ranked.select(*cut.columns, "rank"), counts


def pack(docs: DataFrame, path: str, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids
    (bytes) if asked for.

    Null and empty texts are the single id 0. Rows that repeat a doc_id are packed each by itself.
    An empty table gives no rows. Other columns are not read.
    """
    cut = pieces(docs, path, capacity)
    cut = stored(cut if keep_ids else cut.drop("ids"), "pieces")
    ranked, counts = _ranked(cut, cut.count())
    steps = np.array(sorted(plan(counts, capacity)) or np.zeros((0, 6)), np.int64).reshape(-1, 6)
    place = (steps[:, 0] << 42) + steps[:, 1]

    def rows(*columns):
        *own, lengths, ranks = columns
        size, rank = np.array(lengths, np.int64), np.array(ranks, np.int64)
        step = steps[np.searchsorted(place, (size << 42) + rank, "right") - 1]
        item = rank - step[:, 1]
        yield *own, step[:, 3] + item // step[:, 4], step[:, 5] + item % step[:, 4] * size

    kept = [c for c in cut.columns]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return map_rows(ranked.select(*kept, F.col("length").alias("size"), "rank"), rows,
                    f"{schema}, sequence_id long, offset long")
