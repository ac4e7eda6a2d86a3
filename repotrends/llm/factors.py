"""Byte-exact substring deduplication by longest-previous-factor arrays.

A byte goes if a string of `window` bytes that covers it also starts earlier. Texts are cut into
chunks at anchors: the anchor of a window is the first run of `GRAM` bytes in it with the least hash, and
a chunk holds the neighbouring windows of one anchor. Equal windows have equal anchors at the same
place in them, so they are in different chunks with the same anchor hash.

First anchor hashes alone are shuffled, to find those that come again. Only their chunks are shuffled
as bytes, to groups by anchor. A group sorts its windows as suffixes, to the depth of a window; previous
and next smaller positions in that order give each one's longest previous factor.
"""

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, map_rows, pack, pack_rising, records_of, small_batches, stored, unpack, unpack_rising, wide_partitions

GRAM = 24
BLOCK = 4 << 20        # bytes of text that a map task cuts at once, about
STRETCH = 1 << 15      # windows whose anchors are found at once
GROUP = 1 << 19        # windows of a group, about
ANCHORS = 1 << 24      # bytes of text whose anchors make a group, about
CROWDED = 1 << 14      # occurrences of an anchor, from which on its windows are filed by their own bytes
MOST_CROWDED = 1 << 22 # anchors that may be crowded, about, 8 bytes each: above, CROWDED rises with the input
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x):
    high = x >> np.uint64(31)
    high ^= x
    high *= np.uint64(0xBF58476D1CE4E5B9)
    high ^= high >> np.uint64(29)
    return high


def _run_hashes(data, size: int):
    """A hash of each run of `size` bytes, put together from runs of 1, 2, 4, ... bytes."""
    power = _mix(data.astype(np.uint64) + np.uint64(1)) * _ODD
    out, done, width = None, 0, 1
    while True:
        if size & width:
            n = len(data) - done - width + 1
            out = power[:n] if out is None else _mix(out[:n] * _ODD + power[done:done + n])
            done += width
        if done == size:
            return out
        n = len(data) - 2 * width + 1
        power = power[:n] * np.uint64(0xD1342543DE82EF95) + power[width:width + n]
        power ^= power >> np.uint64(32)
        width *= 2


def _least(values, width: int):
    """The least of each run of `width` values."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _anchors(data, window: int, gram: int):
    """The hash of each run of `gram` bytes, and for each window the place of its anchor. Computed in
    stretches that stay in a processor's cache."""
    hashes, anchor = np.empty(len(data) - gram + 1, np.uint64), np.empty(len(data) - window + 1, np.int64)
    # Half of a hash and the place make a value whose least is the first place of the least hash.
    low = np.uint64(0xFFFFFFFF)
    for lo in range(0, len(anchor), STRETCH):
        found = _run_hashes(data[lo:lo + STRETCH + window - 1], gram)
        hashes[lo:lo + len(found)] = found
        found &= ~low
        found |= np.arange(len(found), dtype=np.uint64)
        least = _least(found, window - gram + 1)
        least &= low
        np.add(least.view(np.int64), lo, out=anchor[lo:lo + STRETCH])
    return hashes, anchor


def _chunks(texts, window: int):
    """Of all texts, joined: their bytes, and for each chunk its text's number, first window (in the
    joined bytes), number of windows and anchor hash."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return data, none, none, none, none.astype(np.uint64)
    gram = min(GRAM, window)
    hashes, anchor = _anchors(data, window, gram)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    whole = np.zeros(len(data) + 1, np.int32)   # 1 where a window lies in one text
    long = sizes >= window
    np.add.at(whole, (ends - sizes)[long], 1)
    np.add.at(whole, (ends - window + 1)[long], -1)
    whole = np.cumsum(whole[:len(anchor)]) > 0
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    fresh &= whole
    edges = np.flatnonzero(fresh | ~whole)
    at = np.flatnonzero(fresh)
    following = np.append(edges, len(anchor))[np.searchsorted(edges, at, "right")]
    return data, np.searchsorted(ends, at, "right"), at, following - at, hashes[anchor[at]]


def _blocks(batches):
    """Columns of Arrow batches (ids, tags, texts, more) as lists, in blocks of about BLOCK bytes."""
    held, size = None, 0
    for batch in small_batches(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held = held or [[] for _ in row]
            for column, value in zip(held, row):
                column.append(value)
            size += len(row[2])
            if size >= BLOCK:
                yield held
                held, size = None, 0
    if held:
        yield held


def _tags(data):
    return np.frombuffer(data, "<i4")


def _rows_by_group(anchors, sent, groups: int):
    """(group, chunks) of the chunks `sent`, by their anchor hash."""
    group = (_mix(anchors[sent] >> np.uint64(16)) % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[order], prepend=-1))
    return [(int(group[order[lo]]), sent[order[lo:hi]]) for lo, hi in zip(edges, np.append(edges[1:], len(order)))]


def _sorted_blocks(batches):
    """The same with rows in the order of ids and tags, which are arrays."""
    for ids, tags, *more in _blocks(batches):
        ids, tags = np.array(ids, np.int64), np.array(tags, "<i4")
        order = np.lexsort((tags, ids))
        yield ids[order], tags[order], *([c[n] for n in order] for c in more)


def _repeated_anchors(docs: DataFrame, window: int, groups: int, crowd: int) -> DataFrame:
    """Rows (doc_id, tag, starts): chunks, by first window, whose anchor hash comes again somewhere.
    Rows (hash): those of anchors with `crowd` occurrences, without doc_id. `docs` has doc_id, tag, text.

    A block sends each anchor hash once, so a frequent one comes to its group once for each block.
    """
    schema = "group long, hashes binary, ids binary, tags binary, starts binary, times binary"
    record = records_of(schema)
    out_record = records_of("doc_id long, tag int, starts binary, hash long")

    def file(batches):
        for ids, tags, texts in _sorted_blocks(batches):
            _, number, at, _, anchors = _chunks(texts, window)
            if not len(at):
                continue
            sizes = np.array([len(t) for t in texts], np.int64)
            start = at - (np.cumsum(sizes) - sizes)[number]
            ids, tags = ids[number], tags[number]
            order = np.argsort(anchors, kind="stable")
            hashes = anchors[order]
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            times = np.diff(np.append(first, len(order)))
            often = np.zeros(len(anchors), np.int64)
            often[order[first]] = times
            sent = np.flatnonzero(often)
            rows = _rows_by_group(anchors, sent, groups)
            again = np.repeat(times > 1, times)
            again[first] = False
            again = np.sort(order[again])
            if len(again):   # known to come again already: they pass by the groups
                rows.append((-1 - int(_mix(anchors[again[:1]])[0] % np.uint64(groups)), again))
            # Six bytes of a hash are enough to tell that an anchor may come again.
            columns = ([g for g, _ in rows], [pack(anchors[r] >> np.uint64(16)) for _, r in rows],
                       [pack_rising(ids[r]) for _, r in rows], [tags[r].tobytes() for _, r in rows],
                       [pack(start[r]) for _, r in rows], [pack(often[r]) for _, r in rows])
            yield record(columns)

    def listed(ids, tags, starts, hashes=()):
        """A row for each text with its chunks, and one for each hash."""
        order = np.lexsort((starts, tags, ids))
        ids, tags, starts = ids[order], tags[order], starts[order]
        edges = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))) if len(ids) else []
        stops = np.append(edges[1:], len(ids)) if len(ids) else []
        n, m = len(edges), len(hashes)
        return out_record((
            [*ids[edges].tolist(), *[None] * m] if n else [None] * m,
            [*tags[edges].tolist(), *[None] * m] if n else [None] * m,
            [*(pack_rising(starts[lo:hi]) for lo, hi in zip(edges, stops)), *[None] * m],
            [*[None] * n, *hashes]))

    def find(now, parts):
        hashes, ids, tags, starts, times = (np.concatenate([read(p[n]) for p in parts]) for n, read in enumerate(
            (unpack, unpack_rising, _tags, unpack, unpack)))
        if now < 0:
            return listed(ids, tags, starts)
        found, place = np.unique(hashes, return_inverse=True)
        total = np.bincount(place, weights=times)
        again = total[place] > 1
        return listed(ids[again], tags[again], starts[again], found[total >= crowd].view(np.int64).tolist())

    def build(batches):
        yield from _by_group(batches, find)

    wide = min(groups * 2, max(wide_partitions(docs.sparkSession), groups // 8))
    return docs.mapInArrow(file, schema).repartition(wide, "group").sortWithinPartitions("group").mapInArrow(
        build, "doc_id long, tag int, starts binary, hash long")


def _by_group(batches, run):
    """`run(group, rows)` for each group of sorted rows; rows of negative groups each by itself."""
    now, parts = None, []
    for batch in small_batches(batches):
        for key, *part in zip(*(c.to_pylist() for c in batch.columns)):
            if parts and (key != now or key < 0):
                yield run(now, parts)
                parts = []
            now = key
            parts.append(part)
    if parts:
        yield run(now, parts)


def suffix_order(data, at, depth: int):
    """Suffixes of `data` that start at `at`, sorted by their first `depth` bytes: their places in
    `at`, and whether each is alike, to that depth, with the one before. Suffixes that differ from all
    others are left out. `data` goes on for `depth` + 8 bytes after each.

    Eight bytes are compared at a time; only where the suffixes of a node differ are they sorted.
    """
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    order, same = np.arange(len(at)), np.arange(len(at)) > 0
    for step in range(0, depth, 8):
        if not len(order):
            break
        word = np.ascontiguousarray(words[at[order] + step]).view(">u8")[:, 0].astype(np.uint64)
        word >>= np.uint64(8 * max(0, step + 8 - depth))
        node = np.cumsum(~same) - 1
        head = word[np.flatnonzero(~same)]
        split = np.zeros(len(head), bool)
        split[node[word != head[node]]] = True
        if not split.any():
            continue
        moved = np.flatnonzero(split[node])
        sort = moved[np.lexsort((word[moved], node[moved])) if step else np.argsort(word)]
        order[moved], word[moved] = order[sort], word[sort]
        same[1:] &= word[1:] == word[:-1]
        shared = same | np.append(same[1:], False)
        order, same = order[shared], same[shared]
    return order, same


def previous_smaller(values, reach: int):
    """For each value the place of the nearest smaller one before it, if it is at most `reach` places
    back; else a place farther back or -1. Minima of runs of 1, 2, 4, ... values are kept, and a place
    goes back by the longest run that has no smaller value."""
    n = len(values)
    levels, width = [values], 1
    while 2 * width <= min(n, 2 * reach):
        low = levels[-1].copy()
        low[width:] = np.minimum(low[width:], levels[-1][:-width])
        levels.append(low)
        width *= 2
    place = np.arange(n) - 1
    for level in reversed(range(len(levels))):
        skip = (place >= 0) & (levels[level][np.maximum(place, 0)] >= values) & (place - (1 << level) + 1 >= 0)
        place = np.where(skip, place - (1 << level), place)
    return place


def earlier_matches(order, same, position):
    """Places in suffix order whose longest previous factor reaches the whole depth: their previous
    or next smaller position lies in the same node of the suffix tree at that depth."""
    if not len(order):
        return order
    node, value, n = np.cumsum(~same), position[order].astype(np.int32), len(order)
    reach = int(np.bincount(node).max())
    before = previous_smaller(value, reach)
    after = n - 1 - previous_smaller(value[::-1], reach)[::-1]
    in_node = lambda place: (place >= 0) & (place < n) & (node[np.clip(place, 0, n - 1)] == node)
    return order[in_node(before) | in_node(after)]


_SPAN_SCHEMA = "doc_id long, tag int, first int, length int"


def repeated_spans(docs: DataFrame, texts: DataFrame, window: int, size: int) -> DataFrame:
    """`(doc_id, tag, first, length)`: runs of window starts whose bytes also start earlier. `docs` has
    doc_id, tag and text as bytes, `size` bytes in all; `texts` the same, dealt by doc_id and tag."""
    # An anchor takes over 20 bytes, so no more than MOST_CROWDED can be as frequent.
    crowd = max(CROWDED, size // (20 * MOST_CROWDED))
    found = stored(_repeated_anchors(docs, window, max(1, -(-size // ANCHORS)), crowd), "anchors")
    crowded = np.array([r["hash"] for r in found.filter("hash IS NOT NULL").select("hash").collect()],
                       np.int64).view(np.uint64)
    groups = max(1, -(-size // GROUP))
    starts = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("own_id"), F.col("tag").alias(
        "own_tag")).agg(F.collect_list("starts").alias("starts"))
    asked = texts.join(starts, (texts["doc_id"] == starts["own_id"]) & (texts["tag"] == starts["own_tag"])).select(
        "doc_id", "tag", "text", "starts")
    schema = "group long, data binary, ids binary, tags binary, first binary, length binary"
    record, span_record = records_of(schema), records_of(_SPAN_SCHEMA)

    def file(batches):
        for ids, tags, texts, asked in _sorted_blocks(batches):
            data, number, at, length, anchors = _chunks(texts, window)
            sizes = np.array([len(t) for t in texts], np.int64)
            offset = np.cumsum(sizes) - sizes
            wanted = np.zeros(len(data) + 1, bool)
            for n, parts in enumerate(asked):
                for part in parts:
                    wanted[offset[n] + unpack_rising(part)] = True
            keep = wanted[at] if len(at) else np.zeros(0, bool)
            number, at, length, anchors = number[keep], at[keep], length[keep], anchors[keep]
            # Windows of a crowded anchor are filed each by itself.
            split = np.isin(anchors >> np.uint64(16), crowded)
            times = np.where(split, length, 1)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            number, at, anchors, length, split = (np.repeat(v, times) for v in (number, at, anchors, length, split))
            at, length = at + step, np.where(split, 1, length)
            if split.any():
                anchors = np.where(split, _run_hashes(data, window)[at], anchors)
            raw, first_of = data.tobytes(), {}
            earliest = np.array([first_of.setdefault(raw[lo:lo + size], n) for n, (lo, size) in enumerate(zip(
                at.tolist(), (length + window - 1).tolist()))], np.int64)
            ids, tags = ids[number], tags[number]
            first = at - offset[number]
            # The same text twice under one doc_id starts no earlier than itself.
            known = ((ids != ids[earliest]) | (tags != tags[earliest]) | (first != first[earliest]))
            sent = np.flatnonzero(earliest == np.arange(len(at)))
            rows = _rows_by_group(anchors, sent, groups)
            contents = [b"".join([raw[at[n]:at[n] + length[n] + window - 1] for n in r]) for _, r in rows]
            if known.any():
                rows.append((-1 - int(ids[known][0] % groups), np.flatnonzero(known)))
                contents.append(b"")
            yield record(([g for g, _ in rows], contents, [pack_rising(ids[r]) for _, r in rows],
                          [tags[r].tobytes() for _, r in rows], [pack(first[r]) for _, r in rows],
                          [pack(length[r]) for _, r in rows]))

    def spans(ids, tags, first, length=None):
        if length is None and len(ids):
            order = np.lexsort((first, tags, ids))
            ids, tags, first = ids[order], tags[order], first[order]
            fresh = np.ones(len(ids), bool)
            fresh[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]) | (first[1:] > first[:-1] + 1)
            begin = np.flatnonzero(fresh)
            last = np.append(begin[1:], len(ids)) - 1
            length = first[last] - first[begin] + 1
            ids, tags, first = ids[begin], tags[begin], first[begin]
        return span_record((ids, tags, first, first if length is None else length))

    def match(now, parts):
        data = b"".join([p[0] for p in parts]) + bytes(window + 16)
        ids, tags, first, length = (np.concatenate([read(p[n]) for p in parts]).astype(np.int64) for n, read in (
            (1, unpack_rising), (2, _tags), (3, unpack), (4, unpack)))
        if now < 0:
            return spans(ids, tags, first, length)
        begin = np.cumsum(length + window - 1) - (length + window - 1)
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        chunk = np.repeat(np.arange(len(length)), length)
        at, ids, tags, first = begin[chunk] + step, ids[chunk], tags[chunk], first[chunk] + step
        text_order = np.lexsort((first, tags, ids))
        fresh = np.ones(len(at), bool)
        x, y, z = ids[text_order], tags[text_order], first[text_order]
        fresh[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])
        position = np.empty(len(at), np.int64)
        position[text_order] = np.cumsum(fresh)
        gone = earlier_matches(*suffix_order(np.frombuffer(data, np.uint8), at, window), position)
        return spans(ids[gone], tags[gone], first[gone])

    def build(batches):
        yield from _by_group(batches, match)

    wide = min(groups * 2, max(wide_partitions(docs.sparkSession), groups // 8))
    return asked.mapInArrow(file, schema).repartition(wide, "group").sortWithinPartitions("group").mapInArrow(
        build, _SPAN_SCHEMA)


def _removed(size: int, spans, window: int):
    """(first, last + 1) of the stretches of a text that are removed."""
    if not spans:
        return np.zeros((0, 2), np.int64)
    first = np.array([s["first"] for s in spans], np.int64)
    last = first + np.array([s["length"] for s in spans], np.int64) + window - 1
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    fresh = np.append(True, first[1:] > reach[:-1])
    begin = np.flatnonzero(fresh)
    return np.stack([first[begin], reach[np.append(begin[1:], len(first)) - 1]], 1)


def deduplicate(docs: DataFrame, window: int = 100, keep: bool = True) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (bytes) if
    asked for.

    A text is its UTF-8 bytes; a null text is empty. Every byte goes that is covered by a string of
    `window` bytes which also starts earlier: in a smaller doc_id, or before in the same text. Texts
    under one doc_id are taken in the order of a hash, and the same text twice is one. Rows
    without doc_id neither lose bytes nor make others lose any. n_spans counts the stretches removed.
    An empty table gives no rows. Other columns are not read.
    """
    tagged = docs.select("doc_id", F.hash("text").alias("tag"), as_bytes())
    size = tagged.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # Dealt once for both joins; text without doc_id is spread by its hash.
    texts = tagged.repartition(wide_partitions(docs.sparkSession), "doc_id", "tag")
    found = repeated_spans(tagged.filter("doc_id IS NOT NULL"), texts, window, size)
    per_text = found.groupBy(F.col("doc_id").alias("own_id"), F.col("tag").alias("own_tag")).agg(
        F.collect_list(F.struct("first", "length")).alias("spans"))
    joined = texts.join(per_text, (texts["doc_id"] == per_text["own_id"]) & (texts["tag"] == per_text["own_tag"]), "left")

    def rows(ids, texts, spans):
        sizes, removed, counts, digests, kept = [], [], [], [], []
        for text, found in zip(texts, spans):
            cut, left, at = _removed(len(text), found, window), [], 0
            for lo, hi in cut.tolist():
                left.append(text[at:lo])
                at = hi
            left = b"".join([*left, text[at:]])
            sizes.append(len(text)), removed.append(len(text) - len(left)), counts.append(len(cut))
            digests.append(hashlib.sha256(left).hexdigest()), kept.append(left)
        yield ids, sizes, removed, counts, digests, *([kept] if keep else [])

    return map_rows(joined.select(texts["doc_id"], texts["text"], "spans"), rows,
                    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                    + ", kept binary" * keep)
