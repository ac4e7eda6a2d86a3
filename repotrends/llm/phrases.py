"""Phrase collocations by mergeable Misra-Gries summaries.

Texts are dealt to buckets that fit in memory. First pass: each bucket's n-grams of one to four words
are counted by hash, and the hashes go to parts by range. A part merges what it gets into one
Misra-Gries summary, of more counters than its mass divided by the threshold, so every n-gram as
frequent as the threshold survives it; buckets are told which of their hashes survived. Second pass:
each bucket counts the survivors by their words, and these exact counts are added up.

Hashes are cut to so few bits that sorted ones lie close together and their steps take two or three
bytes each. N-grams whose hashes meet can only survive wrongly, and the second pass tells them apart.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import records_of, stored, wide_partitions

LONGEST = 4            # words of a phrase
BUCKET = 5 << 20       # bytes of text in a bucket, about
MASS = 100_000_000     # n-grams of a part, about: 16 bytes for every `least` of them in memory
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TO_PIECES = bytes.maketrans(_SEPARATORS, b"\n" * len(_SEPARATORS))
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class _Words:
    """The words of some texts: `vocabulary` of bytes, and for each word of the texts its place there,
    its piece and its language."""

    def __init__(self, langs, texts):
        ids, sizes, lang_of_piece, known, names = [], [], [], {}, {}
        for lang, text in zip(langs, texts):
            lang = names.setdefault(lang, len(names))
            for piece in text.encode().lower().translate(_TO_PIECES).split(b"\n"):
                words = piece.split()
                if words:
                    ids += [known.setdefault(w, len(known)) for w in words]
                    sizes.append(len(words))
                    lang_of_piece.append(lang)
        self.vocabulary, self.langs = list(known), list(names)
        self.ids = np.array(ids, np.int64)
        self.piece = np.repeat(np.arange(len(sizes)), sizes)
        self.lang = np.repeat(np.array(lang_of_piece, np.int64), sizes)

    def starts(self, n: int):
        """Places where a phrase of `n` words starts."""
        size = max(0, len(self.ids) - n + 1)
        return np.flatnonzero(self.piece[:size] == self.piece[n - 1:n - 1 + size])

    def hashes(self, bits: int):
        """For 1 to LONGEST words: places of the phrases and their hashes of `bits` bits."""
        own = np.array([xxhash.xxh64_intdigest(w) for w in self.vocabulary], np.uint64)
        seed = np.array([xxhash.xxh64_intdigest(name.encode(), 1) for name in self.langs], np.uint64)
        word = own[self.ids] if len(self.ids) else own
        value = word ^ seed[self.lang] if len(self.ids) else own
        for n in range(1, LONGEST + 1):
            if n > 1:
                value = value[:-1] * _MULTIPLY + word[n - 1:] if len(value) else value
                value = value ^ (value >> np.uint64(32))
            at = self.starts(n)
            mixed = value[at] * _MULTIPLY
            yield n, at, (mixed ^ (mixed >> np.uint64(29))) * _MULTIPLY >> np.uint64(64 - bits)

    def counts(self, n: int, at):
        """(languages, phrases, counts) of the phrases of `n` words at some places, told apart by
        their words."""
        code = self.lang[at]
        for step in range(n):
            code = np.unique(code * max(1, len(self.vocabulary)) + self.ids[at + step], return_inverse=True)[1]
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        words = self.vocabulary
        phrases = [b" ".join([words[i] for i in row]).decode()
                   for row in self.ids[at[first][:, None] + np.arange(n)].tolist()]
        return [self.langs[i] for i in self.lang[at[first]]], phrases, counts


def _packed(values, counts) -> bytes:
    """Rising values as steps and their counts, in planes of bytes, lowest first."""
    steps = np.diff(values, prepend=np.uint64(0))
    wide = max(1, -(-int(steps.max()).bit_length() // 8))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes()
    often = counts >= 255
    return (np.array([len(values), wide], "<u4").tobytes() + planes
            + np.where(often, 255, counts).astype(np.uint8).tobytes() + counts[often].astype("<u8").tobytes())


def _unpacked(data: bytes):
    size, wide = np.frombuffer(data, "<u4", 2).tolist()
    steps = np.zeros((size, 8), np.uint8)
    steps[:, :wide] = np.frombuffer(data, np.uint8, size * wide, 8).reshape(wide, size).T
    counts = np.frombuffer(data, np.uint8, size, 8 + size * wide).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=8 + size * (wide + 1))
    return np.cumsum(steps.view("<u8")[:, 0]), counts


class Summary:
    """A Misra-Gries summary: after any merges, a key as frequent as `least` has a counter, if the
    counters are more than the whole mass divided by `least`."""

    def __init__(self, mass: int, least: int):
        self.least, self.capacity = least, mass // least + 1
        self.keys, self.counts, self.cut = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        self.waiting, self.held = [], 0

    def add(self, keys, counts):
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > self.capacity:
            self.merge()

    def merge(self):
        keys = np.concatenate([self.keys, *(w[0] for w in self.waiting)])
        counts = np.concatenate([self.counts, *(w[1] for w in self.waiting)])
        self.waiting, self.held = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys, self.counts = keys[first], np.add.reduceat(counts[order], first)
        if len(self.keys) > self.capacity:
            most = np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1]
            self.cut += int(most)
            left = self.counts > most
            self.keys, self.counts = self.keys[left], self.counts[left] - most

    def survivors(self):
        """Rising keys that may be as frequent as `least`: what a counter has and what was ever
        cut from it come to as much."""
        self.merge()
        return self.keys[self.counts + self.cut >= self.least]


def _edges(parts: int, bits: int):
    """The least hash of each part."""
    return np.array([-(-(p << bits) // parts) for p in range(parts)], np.uint64)


def _hashed(words: _Words, bits: int):
    values = [found for _, _, found in words.hashes(bits)]
    return np.unique(np.concatenate(values), return_counts=True)


def _columns(table, *names):
    return [table.column(n).to_pylist() for n in names]


def count_phrases(docs: DataFrame, least: int = 30) -> DataFrame:
    """(lang, phrase, words, f): how often each phrase of 1 to LONGEST words occurs, if `least` times or more;
    and with phrase null, words 0, the number of all words of the language.

    `docs` has lang and text without nulls, and columns that name a row: `key`.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wide = wide_partitions(spark)
    buckets, mass = max(1, -(-size // BUCKET)), max(1, size * LONGEST // 5)
    parts, bits = max(4 * wide, -(-mass // MASS)), min(60, max(32, mass.bit_length() + 6))
    dealt = docs.select(F.pmod("key", F.lit(buckets)).alias("bucket"), "lang", "text").repartition(wide, "bucket")
    part_record = records_of(_PART_SCHEMA)
    found_record = records_of(_FOUND_SCHEMA)

    def summarise(key, table):
        edges = _edges(parts, bits)
        values, counts = _hashed(_Words(*_columns(table, "lang", "text")), bits)
        stops = np.append(np.searchsorted(values, edges), len(values))
        rows = [[], [], [], [], []]
        for part in np.flatnonzero(np.diff(stops)).tolist():
            own = slice(stops[part], stops[part + 1])
            packed = _packed(values[own] - edges[part], counts[own])
            for row in ((part, 0, None, int(counts[own].sum()), None), (part, 1, None, None, packed),
                        (part, 2, key[0].as_py(), None, packed)):
                for column, value in zip(rows, row):
                    column.append(value)
        return pa.Table.from_batches([part_record(rows)])

    def survive(batches):
        """Rows come by part, its masses first, then its hashes, then the same with their buckets."""
        now, mass, summary, kept = None, 0, None, None
        for batch in batches:
            for at in range(batch.num_rows):
                part, turn, bucket, own, packed = (c[at].as_py() for c in batch.columns)
                if part != now:
                    now, mass, summary, kept = part, 0, None, None
                if turn == 0:
                    mass += own
                    continue
                summary = summary or Summary(mass, least)
                keys, counts = _unpacked(packed)
                if turn == 1:
                    summary.add(keys, counts)
                    continue
                if kept is None:
                    kept = summary.survivors()
                place = np.minimum(np.searchsorted(kept, keys), max(0, len(kept) - 1))
                same = kept[place] == keys if len(kept) else np.zeros(len(keys), bool)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket], pa.int64()), "part": pa.array([part], pa.int32()),
                    "kept": pa.array([np.packbits(same).tobytes()], pa.binary())})

    def count(key, table, answers):
        words = _Words(*_columns(table, "lang", "text"))
        values, _ = _hashed(words, bits)
        stops = np.append(np.searchsorted(values, _edges(parts, bits)), len(values))
        kept = np.zeros(len(values), bool)
        for part, mask in zip(*_columns(answers, "part", "kept")):
            own = slice(stops[part], stops[part + 1])
            kept[own] = np.unpackbits(np.frombuffer(mask, np.uint8), count=own.stop - own.start)
        values = values[kept]
        totals = np.bincount(words.lang, minlength=len(words.langs))
        out = [(words.langs, [None] * len(words.langs), totals, [0] * len(words.langs))]
        for n, at, found in words.hashes(bits):
            place = np.minimum(np.searchsorted(values, found), max(0, len(values) - 1))
            at = at[values[place] == found] if len(values) else at[:0]
            langs, phrases, counts = words.counts(n, at)
            out.append((langs, phrases, counts, [n] * len(phrases)))
        return pa.Table.from_batches([found_record((o[0], o[1], o[3], o[2])) for o in out])

    filed = dealt.groupBy("bucket").applyInArrow(summarise, _PART_SCHEMA)
    answers = filed.repartition(wide, "part").sortWithinPartitions("part", "turn").mapInArrow(
        survive, "bucket long, part int, kept binary")
    counted = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(count, _FOUND_SCHEMA)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).filter(
        (F.col("f") >= least) | F.col("phrase").isNull())


_PART_SCHEMA = "part int, turn int, bucket long, mass long, packed binary"
_FOUND_SCHEMA = "lang string, phrase string, words int, n long"


def _exact(name):
    return F.col(name).cast("decimal(38,0)")


def _cut(first: int, last):
    """Words `first` to `last` of a phrase, from 1."""
    words = F.split("phrase", " ", -1)
    return F.array_join(F.slice(words, first, last - first + 1), " ")


def collocations(docs: DataFrame, least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """The `top` phrases of 2 to LONGEST words of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z is lower-cased; texts are cut at `[.,;:!?]` and line ends into pieces, these at spaces and tabs into
    words. a is how often a phrase occurs in pieces, `least` times or more; l and r that of the two parts
    of its weakest cut; n is the language's number of words; score is 2,000,000 a / (l + r), rounded
    down. A phrase goes if a longer one that holds it is `covered` percent as frequent. Best score first,
    then most frequent, then the phrase in order of bytes. Null texts are empty, a null language is
    `und`. Repeated rows count as often as they come; an empty table gives no rows. Other columns are
    not read.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64("doc_id", "text", "lang").alias("key"))
    counts = stored(count_phrases(rows, least), "phrases")
    totals = counts.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    phrases = counts.filter("phrase IS NOT NULL")
    candidates = phrases.filter("words > 1").withColumnRenamed("f", "a")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns({
        "left": _cut(1, F.col("k")), "right": _cut(F.col("k") + 1, F.col("words"))})
    known = phrases.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "f")
    for side, name in (("left", "l"), ("right", "r")):
        own = known.withColumnRenamed("f", name)
        cuts = cuts.join(own, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).drop("of", "part")
    score = F.expr("CAST(2000000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(19,0)) div "
                   "(CAST(l AS DECIMAL(38,0)) + CAST(r AS DECIMAL(38,0)))")
    best = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k"))
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(best.alias("cut"))

    span = F.expr("filter(transform(sequence(0, words * words - 1), x -> struct(x div words AS lo, x % words AS hi)), "
                  "x -> x.hi > x.lo AND x.hi - x.lo < words - 1)")
    inner = candidates.filter("words > 2").withColumn("span", F.explode(span)).select(
        "lang", _cut(F.col("span.lo") + 1, F.col("span.hi") + 1).alias("phrase"), F.col("a").alias("longer"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longest, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * covered))

    order = [F.desc("cut.score"), F.desc("a"), "phrase"]
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(wide_partitions(docs.sparkSession))))
    for keys in (["lang", "part"], ["lang"]):
        dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
            F.col("rank") <= top)
    return dealt.join(totals, "lang").select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))
