"""Alignment of two tokenizers over the same bytes.

Both cut a text's bytes, a space before it; offsets where both cut end a group, and tokens that
overlap are linked. An array that gives for each id of A the id of B with the same bytes is made
first. Links of such pairs, so those of all plain one-to-one groups, are counted in vectors as long
as A's vocabulary; only the other pairs are shuffled.

Both tokenizers start anew at a single space between words, so a word is aligned once and its groups
and links serve wherever it comes again. Texts are taken in blocks. A block keeps its different pairs and, for each text, which of them it
links how often; the pairs of irregular groups go to groups by hash with their counts, are added up
there, and the sums come back to the block.
"""

import gc
import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import records_of, small_batches, stored, text_blocks, wide_partitions, worker_cache

BLOCK = 2 << 20       # bytes of text in a block, about; a longer text is one by itself
BATCH = 256 << 10     # characters that are tokenized at once
KEPT = 150_000        # different units that a worker keeps for its next blocks, about 300 bytes each
LONG = 64             # characters of a unit that is kept for the next blocks
GROUP = 4_000_000     # pairs of a group, about 40 bytes each in memory
_BLANKS, _SINGLE_SPACE = re.compile(r" \s|\s |^ | $"), re.compile(r"(?<=\S) (?=\S)")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _byte_of_character() -> dict:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Vocabularies:
    """Two tokenizers, the bytes of their ids, and which ids have the same bytes."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte = _byte_of_character()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, id_ in self.a.get_vocab().items():
            known = all(c in byte for c in token)
            self.bytes_a[id_] = bytes(byte[c] for c in token) if known else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.cuts_at_spaces = not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(len(self.bytes_b)))
        self.size_a, self.size_b = (np.array([len(t) for t in side], np.int64)
                                    for side in (self.bytes_a, self.bytes_b))
        # Where two ids of B have the same bytes, the piece goes before the byte.
        ids = {t: i for i, t in reversed(list(enumerate(self.bytes_b)))}
        ids |= {self.bytes_b[i]: i for i in reversed(range(len(self.bytes_b))) if not self.b.is_byte(i)}
        self.same = np.array([ids.get(t, -1) if t else -1 for t in self.bytes_a], np.int64)
        #: Alignments of units that are kept, and their numbers, each once.
        self.known, self.numbers = {}, {}
        #: An id as text with the sign after it: A's `,` or `|`, then B's `,` or `;`.
        self.printed = np.array([b"%d%c" % (i, s) for i in range(len(self.bytes_a)) for s in b",|"]
                                + [b"%d%c" % (i, s) for i in range(len(self.bytes_b)) for s in b",;"], object)

    def _piece(self, id_: int) -> bytes:
        piece = self.b.id_to_piece(id_)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(id_) else piece.replace("▁", " ").encode()

    def identity(self, codes):
        """Whether pairs, as codes, have the same bytes by the identity map."""
        return self.same[codes // len(self.bytes_b)] == codes % len(self.bytes_b)

    def units(self, text: str) -> list[str]:
        """A text cut at single spaces between other characters. Both sides start a token at such a
        space (A by its rule, B if none of its pieces goes on after a word), so what follows up to the
        next one is cut alike in every text; the space itself is left out."""
        if not self.cuts_at_spaces:
            return [text] if text else []
        if _BLANKS.search(text):
            return _SINGLE_SPACE.split(text)
        return text.split(" ") if text else []

    def tokens(self, units):
        """Of all units: ids of A, ids of B, both in one list, and how many each unit has. A unit has
        none where the ids' bytes are not a space and the unit."""
        cut_a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        cut_b = self.b.encode(units, num_threads=1)
        whole = [b" " + u.encode() for u in units]
        if not (self._spell(0, cut_a, whole) and self._spell(1, cut_b, whole)):
            spelled = [self._spell(0, [x], [t]) and self._spell(1, [y], [t]) for x, y, t in zip(cut_a, cut_b, whole)]
            cut_a, cut_b = ([x if ok else [] for x, ok in zip(cut, spelled)] for cut in (cut_a, cut_b))
        return (*(np.fromiter(chain.from_iterable(cut), np.int64) for cut in (cut_a, cut_b)),
                *(np.fromiter(map(len, cut), np.int64, len(units)) for cut in (cut_a, cut_b)))

    def _spell(self, side: int, cut, whole) -> bool:
        """Whether the ids of each unit spell its bytes."""
        of_id, size = ((self.bytes_a, self.size_a), (self.bytes_b, self.size_b))[side]
        ids = list(chain.from_iterable(cut))
        if b"".join(map(of_id.__getitem__, ids)) != b"".join(whole):
            return False
        ends = np.append(0, np.cumsum(size[ids]))[np.cumsum(np.fromiter(map(len, cut), np.int64))]
        return bool((ends == np.cumsum(np.fromiter(map(len, whole), np.int64))).all())


def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    """Loaded once in a worker; their size is that of the vocabularies."""
    cache = worker_cache("alignment")
    if (path_a, path_b) not in cache:
        cache[path_a, path_b] = Vocabularies(path_a, path_b)
    return cache[path_a, path_b]


def _align(vocabulary: Vocabularies, units):
    """For each unit: its numbers (n_a, n_b, n_groups, n_links, 1 if it isn't spelled) as 32-bit
    bytes, its groups in print, and its links' pair codes as 32-bit bytes."""
    a, b, n_a, n_b = vocabulary.tokens(units)
    numbers = np.zeros((len(units), 5), "<u4")
    numbers[:, 0], numbers[:, 1], numbers[:, 4] = n_a, n_b, n_a == 0
    if not len(a):
        return [(row.tobytes(), b"", b"") for row in numbers]
    end_a, end_b = np.cumsum(vocabulary.size_a[a]), np.cumsum(vocabulary.size_b[b])
    ends_a, ends_b = np.zeros(end_a[-1] + 1, bool), np.zeros(end_a[-1] + 1, bool)
    ends_a[end_a], ends_b[end_b] = True, True
    # Between two neighbouring ends of either side lies the overlap of exactly one pair of tokens.
    link_ends = np.flatnonzero(ends_a | ends_b)
    of_a = np.cumsum(ends_a, dtype=np.int32)[link_ends - 1]
    of_b = np.cumsum(ends_b, dtype=np.int32)[link_ends - 1]
    codes = (a[of_a] * len(vocabulary.bytes_b) + b[of_b]).astype("<u4").tobytes()
    unit_of_a = np.repeat(np.arange(len(units)), n_a)
    last_a, last_b = ends_b[end_a], ends_a[end_b]
    numbers[:, 2] = np.bincount(unit_of_a[last_a], minlength=len(units))
    numbers[:, 3] = np.bincount(unit_of_a[of_a], minlength=len(units))
    # Print each group's ids of A, then its ids of B.
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    in_a, in_b = np.bincount(group_a), np.bincount(group_b)
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = 2 * a + last_a
    order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = 2 * (len(vocabulary.bytes_a) + b) + last_b
    printed = vocabulary.printed[order].tolist()
    prints = np.append(0, np.cumsum(n_a + n_b)).tolist()
    links = np.append(0, 4 * np.cumsum(numbers[:, 3], dtype=np.int64)).tolist()
    rows = numbers.tobytes()
    return [(rows[20 * n:20 * n + 20], b"".join(printed[prints[n]:prints[n + 1]]), codes[links[n]:links[n + 1]])
            for n in range(len(units))]


class Aligner:
    """Alignments of texts, put together from those of their units, which a worker keeps up to a bound. It
    starts anew once that is reached and it knows less than a quarter of a block's units."""

    def __init__(self, vocabulary: Vocabularies):
        self.vocabulary = vocabulary

    def __call__(self, texts):
        """For each text n_a, n_b, n_groups, n_links, the digest and the links' pair codes."""
        cut = [self.vocabulary.units(text) for text in texts]
        known, numbers = self.vocabulary.known, self.vocabulary.numbers
        different = set().union(*cut)
        new = list(different.difference(known))
        if len(known) >= KEPT and 4 * len(new) > 3 * len(different):
            known.clear()
            numbers.clear()
            new = list(different)
        for part in _batches(new, BATCH):
            known.update((u, (numbers.setdefault(n, n) if len(u) <= LONG else n, *rest))
                         for u, (n, *rest) in zip(part, _align(self.vocabulary, part)))
        for units in cut:
            found = [known[u] for u in units]
            sums = np.frombuffer(b"".join([f[0] for f in found]), "<u4").reshape(-1, 5).sum(0, np.int64).tolist()
            if sums[4] or not units:
                yield 0, 0, 0, 0, "", b""
            else:
                digest = hashlib.sha256(b"".join([f[1] for f in found])[:-1]).hexdigest()
                yield *sums[:4], digest, b"".join([f[2] for f in found])
        room = KEPT - (len(known) - len(new))
        for n, unit in enumerate(new):
            if n >= room or len(unit) > LONG:
                del known[unit]


def _planes(values) -> bytes:
    """Small numbers as four planes of bytes, lowest first, which are easily compressed."""
    return np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes):
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


def _group_of(codes, groups: int):
    return ((codes.astype(np.uint64) * _MULTIPLY) >> np.uint64(20)) % np.uint64(groups)


def _sums(keys, counts):
    """Different keys, their added counts, and the place of each key among them."""
    found, place = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, place, counts)
    return found, sums, place


_BLOCK_SCHEMA = ("ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
                 "digests array<string>, pairs binary, counts binary, n_pairs array<int>, steps binary, times binary")


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each block of texts: its columns for each text; its different pairs, the most
    frequent first, with their counts; and for each text the pairs it links (as steps from one
    place in that list to the next) and how often."""
    record = records_of(_BLOCK_SCHEMA)

    def run(batches):
        aligned = Aligner(vocabularies(path_a, path_b))
        for ids, texts in text_blocks(batches, BLOCK):
            gc.disable()   # units are many small objects without cycles
            *columns, linked = zip(*aligned(texts))
            number = np.repeat(np.arange(len(texts)), [len(codes) // 4 for codes in linked])
            code = np.frombuffer(b"".join(linked), "<u4").astype(np.int64)
            gc.enable()
            found, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(found), np.int64)
            place[order] = np.arange(len(found))
            wide = max(1, len(found))
            linked, times = np.unique(number * wide + place[inverse], return_counts=True)
            text, place = linked // wide, linked % wide
            fresh = np.ones(len(text), bool)
            fresh[1:] = text[1:] != text[:-1]
            steps = np.where(fresh, place, np.diff(place, prepend=0))
            one = (ids, *columns, found[order].astype("<u4").tobytes(), counts[order].astype("<u4").tobytes(),
                   np.bincount(text, minlength=len(ids)).tolist(), _planes(steps), _planes(times))
            yield record([v] for v in one)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, _BLOCK_SCHEMA)


def _batches(texts, size: int):
    """Neighbouring texts of about `size` characters together; one at least."""
    part, chars = [], 0
    for text in texts:
        part.append(text)
        chars += len(text)
        if chars >= size:
            yield part
            part, chars = [], 0
    if part:
        yield part


def _identity_counts(filed: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a, n): links of each id of A with the id of B that has the same bytes. Each task adds up one
    vector."""
    def run(batches):
        vocabulary = vocabularies(path_a, path_b)
        vector = np.zeros(len(vocabulary.bytes_a), np.int64)
        for batch in small_batches(batches):
            for pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                codes, counts = np.frombuffer(pairs, "<u4").astype(np.int64), np.frombuffer(counts, "<u4")
                same = vocabulary.identity(codes)
                np.add.at(vector, codes[same] // len(vocabulary.bytes_b), counts[same])
        found = np.flatnonzero(vector)
        yield pa.RecordBatch.from_pydict({"a": pa.array(found, pa.int32()), "n": pa.array(vector[found], pa.int64())})

    return filed.select("pairs", "counts").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))


_SUM_SCHEMA = "block long, group int, sums binary, b array<int>, most array<long>"


def _pair_sums(filed: DataFrame, path_a: str, path_b: str, groups: int) -> DataFrame:
    """Sums of the irregular pairs. Rows with a block: the sums of its pairs in a group, in the
    block's order. The others: per group the highest sum of each id of B."""
    record = records_of(_SUM_SCHEMA)

    def file(batches):
        vocabulary = vocabularies(path_a, path_b)
        for batch in small_batches(batches):
            for block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                codes, counts = np.frombuffer(pairs, "<u4").astype(np.int64), np.frombuffer(counts, "<u4")
                irregular = ~vocabulary.identity(codes)
                codes, counts = codes[irregular], counts[irregular]
                group = _group_of(codes, groups)
                order = np.argsort(group, kind="stable")
                edges = np.flatnonzero(np.diff(group[order].astype(np.int64), prepend=-1))
                rows = [order[lo:hi] for lo, hi in zip(edges, np.append(edges[1:], len(order)))]
                yield pa.RecordBatch.from_pydict({
                    "group": pa.array([int(group[r[0]]) for r in rows], pa.int32()),
                    "block": pa.array([block] * len(rows), pa.int64()),
                    "pairs": pa.array([_planes(codes[r]) for r in rows], pa.binary()),
                    "counts": pa.array([_planes(counts[r]) for r in rows], pa.binary())})

    def total(batches):
        now, parts = None, []
        for batch in small_batches(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if parts and row[0] != now:
                    yield add_up(now, parts)
                    parts = []
                now = row[0]
                parts.append(row[1:])
        if parts:
            yield add_up(now, parts)

    def add_up(group, parts):
        codes = np.concatenate([_numbers(p[1]) for p in parts])
        found, sums, place = _sums(codes, np.concatenate([_numbers(p[2]) for p in parts]))
        b = found % len(vocabularies(path_a, path_b).bytes_b)
        order = np.lexsort((sums, b))
        last = np.append(b[order][1:] != b[order][:-1], True)
        stops = np.cumsum([len(p[1]) // 4 for p in parts])
        replies = [sums[part].astype("<i8").tobytes() for part in np.split(place, stops[:-1])]
        none = [None] * len(parts)
        rows = ([*(p[0] for p in parts), None], [group] * (len(parts) + 1), [*replies, None],
                [*none, b[order][last].tolist()], [*none, sums[order][last].tolist()])
        return record(rows)

    asked = filed.select("block", "pairs", "counts").mapInArrow(
        file, "group int, block long, pairs binary, counts binary")
    wide = min(groups, max(wide_partitions(filed.sparkSession), groups // 8))
    return asked.repartition(wide, "group").sortWithinPartitions("group").mapInArrow(total, _SUM_SCHEMA)


_RESULT_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                  "groups_sha256 string")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    A encodes a space and the text, B the text, before which it puts a space itself; special tokens'
    strings are plain text. Null and empty texts, and texts that either side's tokens don't spell,
    have no tokens: zeros and ''. n_best counts links whose pair is as frequent as any of its id of
    B; count_sum adds up the counts of the links' pairs. Rows that repeat a doc_id count each by
    itself, as do rows without one. An empty table gives no rows. Other columns are not read.

    The vectors that reach the driver are as long as the two vocabularies; pairs never do.
    """
    filed = stored(blocks(docs, path_a, path_b).withColumn("block", F.monotonically_increasing_id()), "aligned")
    pairs = filed.agg(F.coalesce(F.sum(F.octet_length("pairs")) / 4, F.lit(0.0)).cast("long")).first()[0]
    groups = max(wide_partitions(docs.sparkSession), -(-pairs // GROUP))
    sums = stored(_pair_sums(filed, path_a, path_b, groups), "pair-sums")
    identity = {r["a"]: r["n"] for r in _identity_counts(filed, path_a, path_b).collect()}
    most = {r["b"]: r["n"] for r in sums.filter("block IS NULL").select(
        F.explode(F.arrays_zip("b", "most")).alias("x")).groupBy("x.b").agg(F.max("x.most").alias("n")).collect()}
    answers = sums.filter("block IS NOT NULL").groupBy(F.col("block").alias("of")).agg(
        F.collect_list(F.struct("group", "sums")).alias("sums"))
    record = records_of(_RESULT_SCHEMA)

    def run(batches):
        vocabulary = vocabularies(path_a, path_b)
        vocabulary.known, vocabulary.numbers = {}, {}   # not needed any more
        vector = np.zeros(len(vocabulary.bytes_a), np.int64)
        vector[list(identity)] = list(identity.values())
        best = np.zeros(len(vocabulary.bytes_b), np.int64)
        best[list(most)] = list(most.values())
        known = vocabulary.same >= 0
        np.maximum.at(best, vocabulary.same[known], vector[known])
        for batch in small_batches(batches):
            for ids, *own, digests, found, n_pairs, steps, times, answer in zip(*(c.to_pylist() for c in batch.columns)):
                codes = np.frombuffer(found, "<u4").astype(np.int64)
                same = vocabulary.identity(codes)
                counts = np.where(same, vector[codes // len(vocabulary.bytes_b)], 0)
                irregular = np.flatnonzero(~same)
                if len(irregular):
                    order = irregular[np.argsort(_group_of(codes[irregular], groups), kind="stable")]
                    parts = sorted(answer, key=lambda x: x["group"])
                    counts[order] = np.concatenate([np.frombuffer(p["sums"], "<i8") for p in parts])
                is_best = counts == best[codes % len(vocabulary.bytes_b)]
                n_pairs = np.array(n_pairs, np.int64)
                stops = np.cumsum(n_pairs)
                step, times = _numbers(steps), _numbers(times)
                before = np.append(0, np.cumsum(step))
                place = before[1:] - np.repeat(before[stops - n_pairs], n_pairs)
                add = lambda values: np.diff(np.append(0, np.cumsum(values))[np.append(0, stops)])
                yield record((ids, *own, add(times * is_best[place]), add(times * counts[place]), digests))

    columns = ["ids", "n_a", "n_b", "n_groups", "n_links", "digests", "pairs", "n_pairs", "steps", "times"]
    return filed.join(answers, filed["block"] == answers["of"], "left").select(
        *(filed[c] for c in columns), "sums").mapInArrow(run, _RESULT_SCHEMA)
