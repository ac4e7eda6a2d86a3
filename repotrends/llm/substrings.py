"""Exact substring deduplication by prefix-partitioned suffix trees.

Words are the alphabet, and a tree is only needed down to the depth of a window, so a suffix is cut
after `window` words. Suffixes are filed by prefix: each under the prefix, `GRAM` words long, that
is least by hash among those inside its window, so that neighbouring suffixes are filed together.
Crowded prefixes, found by counting all of them, are lengthened to the whole window. Prefixes are
dealt to groups that fit in memory; sorting a group's suffixes by path label gives the internal
nodes at the depth of a window, which are the repeats. Adjoining nodes of a document make its
maximal repeated spans.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, columns_of, fresh, map_rows, stored, wide_partitions

GRAM = 5
GROUP = 500_000       # suffixes in a group, about 50 bytes each in memory
BLOCK = 1_000_000     # suffixes that a map task holds before it hands them on
CROWDED = 1 << 14     # a prefix is crowded if it has over one in so many suffixes
_MULTIPLY = 0x9E3779B97F4A7C15


def _mix(x):
    """Scramble 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _polynomial(values, size: int):
    """A hash of each run of `size` values."""
    out, factor = np.zeros(len(values) - size + 1, np.uint64), 1
    for at in range(size):
        out += values[at:at + len(out)] * np.uint64(factor)
        factor = factor * _MULTIPLY % (1 << 64)
    return _mix(out)


def _suffixes(texts, window: int):
    """Of all texts: (text number, first word, path label, prefix) of every window, as arrays."""
    words, sizes = [], np.zeros(len(texts), np.int64)
    for n, text in enumerate(texts):
        own = text.split()
        if len(own) >= window:
            sizes[n] = len(own)
            words += own
    gram = min(GRAM, window)
    empty = np.zeros(0, np.int64)
    if not words:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    label, grams = _polynomial(hashes, window), _polynomial(hashes, gram)
    prefix = grams[:len(label)].copy()
    for at in range(1, window - gram + 1):
        np.minimum(prefix, grams[at:at + len(label)], out=prefix)
    ends = np.cumsum(sizes)
    number = np.repeat(np.arange(len(texts)), sizes)[:len(label)]
    first = np.arange(len(label)) - (ends - sizes)[number]
    whole = first + window <= sizes[number]
    return number[whole], first[whole], label[whole], prefix[whole]


def _blocks(batches):
    """(ids, tags, texts) of Arrow batches, in blocks of about BLOCK words."""
    ids, tags, texts, size = [], [], [], 0
    for batch in batches:
        for i, g, t in zip(*(c.to_pylist() for c in batch.columns)):
            ids.append(i), tags.append(g), texts.append(t)
            size += len(t) // 6
            if size > BLOCK:
                yield np.array(ids, np.int64), np.array(tags, np.int32), texts
                ids, tags, texts, size = [], [], [], 0
    if ids:
        yield np.array(ids, np.int64), np.array(tags, np.int32), texts


def _later(label, ids):
    """For each suffix whether a smaller document has the same label: the nodes of a sorted group."""
    order = np.argsort(label, kind="stable")
    fresh = np.ones(len(label), bool)
    fresh[1:] = label[order[1:]] != label[order[:-1]]
    starts = np.flatnonzero(fresh)
    least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids[:0]
    out = np.empty(len(label), bool)
    out[order] = ids[order] > least[np.cumsum(fresh) - 1]
    return out


def _runs(ids, tags, first):
    """Starts and lengths of the stretches in which the same document's suffixes follow each other."""
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]) | (first[1:] != first[:-1] + 1)
    at = np.flatnonzero(fresh)
    return at, np.diff(np.append(at, len(ids)))


_BLOCK_SCHEMA = "group long, labels binary, ids binary, tags binary, first binary, length binary"
_SPAN_SCHEMA = "doc_id long, tag int, first int, length int"


def _census(docs: DataFrame, window: int):
    """Number of suffixes, and the crowded prefixes. No prefix is left out of the count; a block
    reports those of which it has a noticeable share, at most `4 * CROWDED`."""
    def run(batches):
        for _, _, texts in _blocks(batches):
            prefix = _suffixes(texts, window)[3]
            found, n = np.unique(prefix, return_counts=True)
            big = n * (4 * CROWDED) >= len(prefix) + 64 * CROWDED
            yield pa.RecordBatch.from_pydict({
                "prefix": pa.array([None, *found[big].view(np.int64).tolist()], pa.int64()),
                "n": pa.array([len(prefix), *n[big].tolist()], pa.int64())})

    counts = stored(docs.mapInArrow(run, "prefix long, n long").groupBy("prefix").agg(
        F.sum("n").alias("n")), "prefixes")
    total = counts.filter("prefix IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # By their definition there are at most CROWDED of them.
    crowded = counts.filter(F.col("prefix").isNotNull() & (F.col("n") * CROWDED > total))
    return total, sorted(row["prefix"] for row in crowded.collect())


def repeated_spans(docs: DataFrame, window: int = 13, group_size: int = GROUP) -> DataFrame:
    """`(doc_id, tag, first, length)`: runs of window starts whose words also start in a document
    with a smaller doc_id. `docs` has doc_id, tag (which text, if a doc_id is repeated) and text
    as bytes. Rows without doc_id neither have nor give repeats.

    Within a map task's block, suffixes that repeat are resolved at once, and only those of the
    smallest document go on: a passage that very many documents share reaches its group once for
    each block. Two different windows are taken for one if they share their group and a 64-bit
    label, by chance in fewer than n * group_size / 2^64 cases.
    """
    docs = docs.filter("doc_id IS NOT NULL")
    total, crowded = _census(docs, window)
    groups = max(1, -(-total // group_size))
    crowded = np.array(crowded, np.int64).view(np.uint64)

    def file(batches):
        for ids, tags, texts in _blocks(batches):
            number, first, label, prefix = _suffixes(texts, window)
            ids, tags = ids[number], tags[number]
            known = _later(label, ids)
            group = (_mix(np.where(np.isin(prefix, crowded), label, prefix)) % np.uint64(groups)).astype(np.int64)
            out = {f: [] for f in ("group", "labels", "ids", "tags", "first", "length")}

            def add(number, labels, ids, tags, first):
                at, length = _runs(ids, tags, first)
                for key, value in zip(out, (number, labels.tobytes(), ids[at].tobytes(), tags[at].tobytes(),
                                            first[at].astype("<i4").tobytes(), length.astype("<i4").tobytes())):
                    out[key].append(value)

            sent = np.flatnonzero(~known)
            sent = sent[np.argsort(group[sent], kind="stable")]
            edges = np.flatnonzero(np.diff(group[sent], prepend=-1))
            for lo, hi in zip(edges, np.append(edges[1:], len(sent))):
                part = sent[lo:hi]
                add(int(group[part[0]]), label[part], ids[part], tags[part], first[part])
            if known.any():  # already resolved; a group of its own kind takes them along
                add(-1 - int(ids[known][0] % groups), label[:0], ids[known], tags[known], first[known])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("group", pa.int64()), *((f, pa.binary()) for f in list(out)[1:])]))

    def spans(ids, tags, first):
        at, length = _runs(ids, tags, first)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids[at], pa.int64()), "tag": pa.array(tags[at], pa.int32()),
            "first": pa.array(first[at].astype(np.int32)), "length": pa.array(length.astype(np.int32))})

    def nodes(parts):
        """The repeats of one group."""
        labels, ids, tags, first, length = (
            np.concatenate([np.frombuffer(p[n], kind) for p in parts])
            for n, kind in enumerate(("<u8", "<i8", "<i4", "<i4", "<i4")))
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        ids, tags, first = np.repeat(ids, length), np.repeat(tags, length), np.repeat(first, length) + step
        found = _later(labels, ids) if len(labels) else np.ones(len(ids), bool)
        return spans(ids[found], tags[found], first[found])

    def build(batches):
        now, parts = None, []
        for batch in batches:
            for key, *part in zip(*(c.to_pylist() for c in batch.columns)):
                if parts and (key != now or key < 0):
                    yield nodes(parts)
                    parts = []
                now = key
                parts.append(part)
        if parts:
            yield nodes(parts)

    filed = docs.mapInArrow(file, _BLOCK_SCHEMA)
    width = min(groups * 2, max(wide_partitions(docs.sparkSession), groups // 8))
    return (
        filed.repartition(max(1, width), "group").sortWithinPartitions("group")
        .mapInArrow(build, _SPAN_SCHEMA)
    )


def _kept(words: list, spans, window: int) -> list:
    """Words that no repeated window covers."""
    if not spans:
        return words
    cover = np.zeros(len(words) + 1, np.int32)
    for span in spans:
        cover[span["first"]] += 1
        cover[span["first"] + span["length"] + window - 1] -= 1
    return [words[n] for n in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def _with_spans(docs: DataFrame, window: int, columns) -> DataFrame:
    """`columns`, the text as bytes, and its repeated spans (null: none)."""
    id_, tag, content, spans = fresh(docs, "own_id", "own_tag", "content", "spans")
    tagged = docs.withColumn(tag, F.hash("text")).withColumn(content, as_bytes())
    found = repeated_spans(
        tagged.select("doc_id", F.col(tag).alias("tag"), F.col(content).alias("text")), window)
    per_text = found.groupBy(F.col("doc_id").alias(id_), F.col("tag").alias(tag)).agg(
        F.collect_list(F.struct("first", "length")).alias(spans))
    joined = tagged.join(per_text, (tagged["doc_id"] == per_text[id_]) & (tagged[tag] == per_text[tag]), "left")
    return joined.select(*(tagged[c] for c in columns), tagged[content], spans)


def deduplicate(docs: DataFrame, window: int = 13) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, n_removed, kept_sha256, kept.

    Words are runs of other than ASCII white space; null and empty texts have none. Every word is
    removed that is covered by a window of `window` words which also starts in a document with a
    smaller doc_id. Rows that repeat a doc_id don't count as smaller; rows without one neither give
    nor lose words. `kept` has the words left, joined by one space. Other columns are not read.
    """
    def rows(ids, texts, spans):
        counts, removed, digests, kept = [], [], [], []
        for text, found in zip(texts, spans):
            words = text.split()
            left = _kept(words, found, window)
            joined = b" ".join(left)
            counts.append(len(words))
            removed.append(len(words) - len(left))
            digests.append(hashlib.sha256(joined).hexdigest())
            kept.append(joined.decode())
        yield ids, counts, removed, digests, kept

    return map_rows(_with_spans(docs.select("doc_id", "text"), window, ["doc_id"]), rows,
                    "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def cut_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """`docs` with repeated words cut out. Texts without repeats stay as they are; the others are
    their words left, joined by one space, with `n_chars` to match; rows of which no word is left
    go."""
    columns = docs.columns
    text_at = columns.index("text")
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def rows(*values):
        *own, texts, spans = values
        keep = []
        for n, (text, found) in enumerate(zip(texts, spans)):
            if found:
                own[text_at][n] = b" ".join(_kept(text.split(), found, window)).decode()
                if chars_at is not None:
                    own[chars_at][n] = len(own[text_at][n])
            if not found or own[text_at][n]:
                keep.append(n)
        yield tuple([v[n] for n in keep] for v in own)

    return map_rows(_with_spans(docs, window, columns), rows, columns_of(docs))
