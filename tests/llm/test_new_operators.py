"""Operators 11 to 13 against brute force, and cases of the others that were found wrong."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from repotrends.llm import alignment, factors, html, licenses, mixing, neighbours, packing, phrases, quality, queries, toxicity

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, lang string, source string, `group` string"


def slow_alignment(vocabulary, texts):
    """Per text: links and the other columns, by walking over both sides' tokens of the whole text."""
    out = []
    for text in texts:
        text = text or ""
        a = vocabulary.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = vocabulary.b.encode(text) if text else []
        own_a, own_b = [vocabulary.bytes_a[i] for i in a], [vocabulary.bytes_b[i] for i in b]
        whole = (" " + text).encode()
        if not text or b"".join(own_a) != whole or b"".join(own_b) != whole:
            out.append(([], 0, 0, 0, ""))
            continue
        ends_a, ends_b = np.cumsum([len(t) for t in own_a]), np.cumsum([len(t) for t in own_b])
        links, i, j = [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            step_a, step_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
            i, j = i + step_a, j + step_b
        groups, lo_a, lo_b = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            hi_a, hi_b = int((ends_a <= end).sum()), int((ends_b <= end).sum())
            groups.append(",".join(map(str, a[lo_a:hi_a])) + "|" + ",".join(map(str, b[lo_b:hi_b])))
            lo_a, lo_b = hi_a, hi_b
        out.append((links, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def test_alignment(spark, monkeypatch):
    random.seed(3)
    parts = ["the", "Straße", "naïve", " ", "  ", "\n", "\t", " ", "▁", "<s>", "<|endoftext|>", "don't", "aaaaaaa",
             "日本", "x" * 70, "1234", "\x00", "\x1c", "-"]
    texts = [None, "", " ", "a", " a", "a ", "\n", "a\n b", "aa  aa", "the the the"]
    texts += ["".join(random.choice(parts) + random.choice(["", " ", " "]) for _ in range(random.randrange(1, 40)))
              for _ in range(150)]
    texts += [texts[20]] * 3
    rows = [(n if n != 5 else None, t, "en", "s", "g") for n, t in enumerate(texts)]
    monkeypatch.setattr(alignment, "BLOCK", 600)
    monkeypatch.setattr(alignment, "GROUP", 50)
    got = alignment.align(spark.createDataFrame(rows, DOCS).repartition(3), A, B).collect()
    want = slow_alignment(alignment.Vocabularies(A, B), texts)
    count = Counter(link for links, *_ in want for link in links)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    assert len(got) == len(rows) and any(w[0] for w in want)
    for row in got:
        links, n_a, n_b, n_groups, digest = want[5 if row["doc_id"] is None else row["doc_id"]]
        assert tuple(row)[1:] == (n_a, n_b, n_groups, len(links), sum(count[x] == most[x[1]] for x in links),
                                  sum(count[x] for x in links), digest)
    assert alignment.align(spark.createDataFrame([], DOCS), A, B).collect() == []


def slow_phrases(rows, least, covered=80, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang, low = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\x0a\x0b\x0c\x0d":
            low = low.replace(c, "\n")
        for piece in low.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    out = []
    for lang in totals:
        known = {w: f for (of, w), f in counts.items() if of == lang and f >= least}
        found = []
        for w, a in known.items():
            longer = [f for x, f in known.items() if len(x) > len(w) > 1
                      and any(x[i:i + len(w)] == w for i in range(len(x) - len(w) + 1))]
            if len(w) > 1 and not any(100 * f >= covered * a for f in longer):
                cuts = [(2_000_000 * a // (known[w[:k]] + known[w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(w).encode(), known[w[:k]], known[w[k:]]))
        out += [(lang, n, x[2].decode(), -x[1], x[3], x[4], totals[lang], -x[0])
                for n, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("bucket", [300, 1 << 20])
def test_collocations(spark, bucket, monkeypatch):
    random.seed(bucket)
    words = ["New", "york", "a", "B", "é", "the", "x y", "City"]
    texts = [" ".join(random.choices(words, [9, 9, 3, 3, 2, 5, 1, 4], k=random.randrange(30))).replace(
        "York a", "york, a") + random.choice(["", ".", "\tnew york city!", "\n\n"]) for _ in range(80)]
    rows = [(n, t, random.choice(["en", None, "und", "de"]), "s", "g") for n, t in enumerate([*texts, None, "", texts[0]])]
    rows += rows[:2]
    monkeypatch.setattr(phrases, "BUCKET", bucket)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=6, top=15).collect())
    want = slow_phrases([(r[2], r[1]) for r in rows], 6, top=15)
    assert got == want and len(got) > 20
    assert phrases.collocations(spark.createDataFrame([], DOCS)).collect() == []


def test_summaries_keep_what_is_frequent():
    """Whatever the order of merges, no key as frequent as the threshold is lost, and memory is bounded."""
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 1 << 40, 20_000).astype(np.uint64), np.repeat(np.arange(9, dtype=np.uint64), 30)])
    rng.shuffle(keys)
    summary = phrases.Summary(len(keys), 30)
    for part in np.array_split(keys, 40):
        summary.add(*np.unique(part, return_counts=True))
        assert len(summary.keys) <= summary.capacity
    assert set(range(9)) <= set(summary.survivors().tolist())


def slow_earlier(rows, window):
    """Rows in order of doc_id, without repeated ids: windows seen before."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - window + 1):
            if data[at:at + window] in seen:
                gone[at:at + window] = b"\1" * window
            seen.add(data[at:at + window])
        kept = bytes(x for x, cut in zip(data, gone) if not cut)
        spans = sum(cut and not before for cut, before in zip(gone, b"\0" + bytes(gone)))
        out.append((doc_id, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window, crowd, block", [(12, 3, 500), (40, 1 << 14, 1 << 20), (100, 2, 4000)])
def test_earlier_bytes(spark, window, crowd, block, monkeypatch):
    for name, value in (("CROWDED", crowd), ("BLOCK", block), ("GROUP", 2000), ("ANCHORS", 3000)):
        monkeypatch.setattr(factors, name, value)
    random.seed(window)
    base = ["".join(random.choices("ab é日", k=400)) for _ in range(4)]
    texts = ["".join(random.choice(base)[(a := random.randrange(350)):a + random.randrange(200)] + random.choice(["", "x", "a" * 150])
                     for _ in range(random.randrange(6))) for _ in range(50)]
    texts += [None, "", "a" * 3000, "ab" * 1500, texts[7], texts[7], "b" * window, "b" * (window - 1)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(n, t, "en", "s", "g") for n, t in rows], DOCS).repartition(4)
    got = sorted(tuple(r) for r in factors.deduplicate(df, window, keep=False).collect())
    assert got == slow_earlier(rows, window)
    # The same row twice takes nothing from itself; rows without doc_id neither give nor lose.
    more = spark.createDataFrame([(1, "q" * 5 + base[0][:300]), (1, "q" * 5 + base[0][:300]), (None, base[0]), (None, base[0])],
                                 "doc_id long, text string")
    assert [r["n_removed"] for r in factors.deduplicate(more, 40).collect()] == [0] * 4
    assert factors.deduplicate(spark.createDataFrame([], DOCS)).collect() == []


def test_previous_smaller():
    values = np.random.default_rng(2).integers(0, 30, 500)
    want = [max((j for j in range(i) if values[j] < v), default=-1) for i, v in enumerate(values)]
    assert factors.previous_smaller(values, 500).tolist() == want


def test_page_scanner_loses_nothing_and_is_linear():
    page = "<article><p>one <a title=it's>link</a> two</p><p>three</p><p>don't four</p></article>"
    assert html.extract(page, None) == "one link two\nthree\ndon't four"
    assert html.extract("<article><header><h1>Head</h1></header><p>body</p></article>", None) == "Head\nbody"
    for name in ("reader-comments", "user-comments", "comment-thread", "disqus_thread", "newsletter-signup",
                 "share-buttons", "related-stories", "ad-slot", "gdpr-banner", "responses", "replies"):
        assert html.extract(f"<article><p>text</p><div class={name}><p>no</p></div></article>", None) == "text", name
    for part in ("<a ", "<a x='", '<a x="', "<script ", "<!", "<a ="):
        began = time.time()
        html.extract(part * 200_000, None)
        assert time.time() - began < 5, part


def test_large_and_tiny_vectors_have_neighbours(spark):
    rng = np.random.default_rng(4)
    for scale in (1e200, 1e-200):
        points = rng.normal(0, 1, (300, 4))
        df = spark.createDataFrame([(n, (p * scale).tolist()) for n, p in enumerate(points)],
                                   "vec_id long, embedding array<double>")
        got = neighbours.nearest(df, F.col("vec_id") % 100 == 0, k=5).collect()
        for q in (0, 100, 200):
            far = np.sqrt(np.square(points - points[q]).sum(1))
            far[q] = np.inf
            assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == np.argsort(far)[:5].tolist()


def test_mix_takes_the_nearer_side(spark):
    rows = [(1, "w " * 1000, "en", "y", "")] + [(n, "w " * 10, "en", "x", "") for n in range(2, 470)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), weights=(4, 1)).filter("doc_id = 1").first()
    assert abs(got["taken"] - got["target"]) <= abs(got["target"]) and got["taken"] > 0
    empty = spark.createDataFrame([(1, "", "en", "a", ""), (2, None, "en", "a", ""), (3, "a b", "en", "a", "")], DOCS)
    assert max(Counter(r["doc_id"] for r in mixing.take_mix(empty, most=3).collect()).values()) <= 3


def test_labels_out_of_range():
    texts, y = [b"good words here", b"bad junk there"] * 20, np.array([0, 1] * 20)
    odd = np.concatenate([y, [7, -1]])
    for one, two in zip(quality.fit(texts, y, 2), quality.fit([*texts, b"x", b"y"], odd, 2)):
        assert np.array_equal(one, two)
    toxicity.fit([*texts, b"x"], np.concatenate([y, [-3]]), steps=2)


@pytest.mark.parametrize("seed", range(3))
def test_factors_learn_exactly_one_of_two(seed):
    """Neither term tells anything on its own."""
    rng = random.Random(seed)
    filler, texts, y = [f"w{i}" for i in range(30)], [], []
    for _ in range(2000):
        one, two = rng.random() < 0.5, rng.random() < 0.5
        words = rng.sample(filler, 8) + ["insult"] * one + ["group"] * two
        rng.shuffle(words)
        texts.append(" ".join(words).encode())
        y.append(int(one != two))
    y = np.array(y)
    chosen, bias, w, v = toxicity.fit(texts[:1500], y[:1500])
    place = {slot: n for n, slot in enumerate(chosen)}
    own = [np.array([place[i] for i in toxicity.terms(t) if i in place], int) for t in texts[1500:]]
    score, _ = toxicity._score(toxicity.Sparse([(r, np.ones(len(r))) for r in own]), bias, w, v)
    assert np.mean((score > 0) == y[1500:]) >= 0.95


def test_terms_without_pairs_are_left_out():
    rng = random.Random(2)
    texts = [" ".join(rng.sample([f"w{i}" for i in range(40)], 12)).encode() for _ in range(1000)]
    y = np.array([rng.random() < 0.3 for _ in texts], int)
    rows = [toxicity.terms(t) for t in texts]
    assert len(toxicity.select(rows, y)) <= 4
    assert len(toxicity.select(rows, np.zeros(len(y), int))) == 0


def as_pattern(template):
    """The template as a regular expression over words with a blank before each."""
    out = ""
    for part in re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", template):
        region = re.fullmatch(r"\{(\d+)-(\d+)\}", part)
        out += "(?:" if part == "[" else ")?" if part == "]" else (
            r"(?: \S+){%s,%s}" % region.groups() if region else " " + part)
    return re.compile(out)


@pytest.mark.parametrize("template", [
    "a b [c] d", "a b {1-3} c [d [a] b] {0-2} c", "a a [a] {0-1} a", "a b [c {1-2}] [d] a"])
def test_automaton_against_a_pattern(template):
    rng, automaton, pattern = random.Random(5), licenses.Automaton(template), as_pattern(template)
    for _ in range(3000):
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 12))]
        ends = [n for n in range(len(words) + 1) if pattern.fullmatch("".join(" " + w for w in words[:n]))]
        assert automaton.accepts([w.encode() for w in words], 0) == max(ends, default=-1)


def filled(template):
    """A text of the template: without the optional regions, with `x` for each word of the others."""
    text = re.sub(r"\[[^\[\]]*\]", "", template)
    return re.sub(r"\{(\d+)-\d+\}", lambda m: "x " * int(m[1]), text).split()


def test_every_template_quoted_changed_and_cut(spark):
    """Quotes around words don't hide a text; one other mandatory word or a missing end does."""
    want, rows = {}, []
    for label, template in licenses.TEMPLATES.items():
        words = filled(template)
        at = next(n for n in range(len(words) - 2, 0, -1) if words[n] != "x")
        for text, found in [
                (words, True), (["\u201c" + words[0], words[1] + "\u201d", *words[2:-1], "\u2018" + words[-1] + "\u2019"], True),
                ([*words[:at], "otherwise", *words[at + 1:]], False), (words[:-1], False)]:
            want[len(rows)] = (label, found)
            rows.append((len(rows), "pre " + " ".join(text) + " post"))
    rows.append((len(rows), "word " * 200_000 + " ".join(filled(licenses.TEMPLATES["mit-text"])) + " \u201c \u201d"))
    want[len(rows) - 1] = ("mit-text", True)
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string").withColumn("labels", F.lit("clash"))
    got = licenses.scan(df).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        label, found = want[r["doc_id"]]
        assert (label in {s["label"] for s in r["spans"]}) == found, (label, r)


def random_outline(rng, size):
    """Parents and tags of a tree, in preorder."""
    def grow(left, depth):
        tag, kids = rng.choice("abc"), []
        while left > 1 and depth < 4 and rng.random() < 0.8:
            kids.append(grow(rng.randint(1, left - 1), depth + 1))
            left -= 1 + len(kids[-1][1])
        return tag, kids

    out = []

    def number(tree, parent):
        at = len(out)
        out.append((parent, tree[0]))
        for kid in tree[1]:
            number(kid, at)

    number(("root", [grow(size, 1) for _ in range(rng.randint(0, 4))]), -1)
    return out


def most_matched(a, b, x=0, y=0):
    """The largest matching of two subtrees, by trying all choices."""
    kids_a, kids_b = html._children(a)[x], html._children(b)[y]

    def lists(ka, kb):
        if not ka or not kb:
            return 0
        best = max(lists(ka[1:], kb), lists(ka, kb[1:]))
        if a[ka[0]][1] == b[kb[0]][1]:
            best = max(best, most_matched(a, b, ka[0], kb[0]) + lists(ka[1:], kb[1:]))
        return best

    return 1 + lists(kids_a, kids_b)


@pytest.mark.parametrize("vectors", [0, 4096])
def test_tree_matching_is_the_largest(vectors, monkeypatch):
    monkeypatch.setattr(html, "VECTORS", vectors)
    rng = random.Random(5)
    for _ in range(150):
        a, b = random_outline(rng, 6), random_outline(rng, 6)
        pairs = html.match(a, b)
        assert len(pairs) == most_matched(a, b)
        of = dict(pairs)
        assert len(of) == len(set(of.values())) == len(pairs) and pairs[0] == (0, 0)
        for x, y in pairs[1:]:
            assert a[x][1] == b[y][1] and of[a[x][0]] == b[y][0]
        for x, y in pairs:   # siblings keep their order
            assert all((x < x2) == (y < y2) for x2, y2 in pairs if a[x2][0] == a[x][0])


def test_long_lists_of_children_are_aligned_exactly():
    items = [f"<li><a>t</a>{'<p>x</p>' * (n % 7)}</li>" for n in range(3000)]
    a = html.outline(f"<ul>{''.join(items)}</ul>")
    b = html.outline(f"<ul><li><h2>advert</h2><h2>x</h2></li>{''.join(items)}</ul>")
    start = time.time()
    pairs = html.match(a, b)
    assert time.time() - start < 10
    assert len(pairs) == len(a)


def test_deep_pages_take_little_memory():
    page = "<div>" * 50_000 + "text" + "</div>" * 50_000
    start = time.time()
    tree = html.outline(page)
    assert len(tree) == 50_001 and html.shape(tree) == html.shape(list(tree))
    assert len(html.match(tree, tree)) == len(tree)
    assert time.time() - start < 10
    assert html.shape(html.outline("<div><b>x</b><p>y</p></div>")) == html.shape(html.outline("<div><p>z</p><p>y</p></div>"))
    assert html.shape(html.outline("<div><p>x</p></div>")) != html.shape(html.outline("<div><ul>x</ul></div>"))


def test_words_are_kept_for_later_tasks(monkeypatch):
    texts = [b"one two three ~four", b"five ~ six two", b""]
    first = packing.Encoder(queries.TOKENIZER)
    first.known.clear()
    want = first(texts)
    assert b"three" in packing.Encoder(queries.TOKENIZER).known
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    for n in range(3):   # full of other words, then of its own
        assert packing.Encoder(queries.TOKENIZER)(texts) == want
        packing.Encoder(queries.TOKENIZER)([b"%d %d %d %d" % (n, n + 10, n + 20, n + 30)])
    first.known.clear()
    assert first(texts) == want and len(first.known) == 3
    assert first([b"ten eleven two"]) and len(first.known) <= 3


def test_units_are_kept_for_later_tasks(monkeypatch):
    vocabulary = alignment.Vocabularies(A, B)
    texts = ["one two three", "four  five two", "", "x" * 100 + " one"]
    want = list(alignment.Aligner(vocabulary)(texts))
    assert "three" in vocabulary.known
    assert "x" * 100 not in vocabulary.known and list(alignment.Aligner(vocabulary)(texts)) == want
    monkeypatch.setattr(alignment, "KEPT", 2)
    for _ in range(3):
        assert list(alignment.Aligner(vocabulary)(texts)) == want
        list(alignment.Aligner(vocabulary)([f"w{n} v{n}" for n in range(9)]))
    assert 0 < len(vocabulary.known) <= 9
    vocabulary.known.clear()
    assert list(alignment.Aligner(vocabulary)(texts)) == want and 0 < len(vocabulary.known) <= 2


def test_anchors_are_the_same_in_stretches(monkeypatch):
    random.seed(5)
    data = np.frombuffer(bytes(random.choice(b"ab") for _ in range(500)) + bytes(100), np.uint8)
    whole = factors._anchors(data, 40, 9)
    hashes = factors._run_hashes(data, 9) >> np.uint64(32)
    assert whole[1].tolist() == [at + int(hashes[at:at + 32].argmin()) for at in range(len(data) - 39)]
    for size in (1, 7, 560, 561, 562):
        monkeypatch.setattr(factors, "STRETCH", size)
        assert all((x == y).all() for x, y in zip(whole, factors._anchors(data, 40, 9)))
