"""Quality rules: counts over words and lines, and the perplexity of an n-gram model.

The n-grams are of five UTF-8 bytes. Spark counts those of all texts, so they grow with the corpus,
and makes a modified Kneser-Ney model of the counts. A context has at most 256 followers and an
n-gram at most 256 predecessors, so no group is large. The model is kept in sorted arrays of n-gram
codes, cut by hash into slices of bounded size; each slice adds its share to the cost of every text.
The cost is measured per byte and per word, since marks stuck to words make bytes cheap and words
dear. Languages have bands of their own: a text is rejected if one of the measures lies far outside
the quartiles of its language.
"""

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import as_bytes, map_rows, stored

ORDER = 5             # bytes of an n-gram; its code is a long
CHUNK = 1 << 21       # n-grams that are worked on together
HELD = 1 << 22        # different n-grams that a task holds before it hands them on
SLICE = 1 << 22       # n-grams in a slice of the model, about; 12 bytes each
BINS = 500            # of a measure, for a unit
_SYMBOLS = "#*$%&|<>"
_KEY = ["text_key", "text_check"]


def _chunks(texts):
    """Of texts set in a row, between edges of zeros: (codes, number of the text of each code). A text
    has one n-gram for each byte and one for its end; a long text runs over several chunks."""
    edge = bytes(ORDER - 1)
    data = np.frombuffer(edge + edge.join(texts) + edge, np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes + ORDER - 2) - (sizes + ORDER - 2)
    for low in range(0, len(data) - ORDER + 1, CHUNK):
        part = data[low:low + CHUNK + ORDER - 1].astype(np.int64)
        code = np.zeros(len(part) - ORDER + 1, np.int64)
        for at in range(ORDER):
            code = code * 256 + part[at:at + len(code)]
        place = np.arange(low, low + len(code))
        owner = np.searchsorted(starts, place, side="right") - 1
        inside = place < (starts + sizes)[owner]
        yield code[inside], owner[inside]


def _added_up(codes, counts):
    """Sorted different codes and the sums of their counts."""
    codes, counts = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def count_ngrams(docs: DataFrame) -> DataFrame:
    """`(gram, n)` of all texts; a task adds its counts up before it hands them on."""
    def run(batches):
        codes, counts = [], []

        def handed_on():
            if codes:
                gram, n = _added_up(codes, counts)
                for at in range(0, len(gram), 1 << 16):
                    yield pa.RecordBatch.from_pydict({
                        "gram": pa.array(gram[at:at + (1 << 16)]), "n": pa.array(n[at:at + (1 << 16)])})

        for batch in batches:
            for code, _ in _chunks(batch.column(0).to_pylist()):
                gram, n = np.unique(code, return_counts=True)
                codes.append(gram)
                counts.append(n)
                if sum(map(len, codes)) > HELD:
                    codes[:], counts[:] = ([x] for x in _added_up(codes, counts))
                    if len(codes[0]) > HELD // 2:
                        yield from handed_on()
                        codes, counts = [], []
        yield from handed_on()

    return docs.select(as_bytes()).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(ones: int, twos: int, threes: int, fours: int) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from how many n-grams have counts 1 to 4."""
    n = [ones, twos, threes, fours]
    y = ones / max(1, ones + 2 * twos)
    return [min(max(k - (k + 1) * y * n[k] / max(1, n[k - 1]), 0.1 * k), 0.9 * k) for k in (1, 2, 3)]


def kneser_ney(counts: DataFrame) -> DataFrame:
    """`(gram, log_p)`: interpolated modified Kneser-Ney probabilities of all n-grams counted."""
    levels = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):   # how many different bytes stand before it
        shorter = (F.col("gram") % F.lit(256 ** size)).alias("gram")
        levels[size] = stored(levels[size + 1].groupBy(shorter).agg(F.count(F.lit(1)).alias("n")), "ngrams")
    few = reduce(DataFrame.unionAll, (
        df.filter("n <= 4").select(F.lit(size).alias("size"), "n") for size, df in levels.items()))
    found = {(r["size"], r["n"]): r["times"] for r in few.groupBy("size", "n").agg(
        F.count(F.lit(1)).alias("times")).collect()}   # at most 4 for each size
    p = None
    for size in range(1, ORDER + 1):
        one, two, more = discounts(*(found.get((size, n), 0) for n in (1, 2, 3, 4)))
        n, context = F.col("n"), Window.partitionBy(F.shiftright("gram", 8))
        spare = F.count_if(n == 1).over(context) * one + F.count_if(n == 2).over(context) * two \
            + F.count_if(n >= 3).over(context) * more
        total = F.sum("n").over(context)
        cut = F.when(n == 1, one).when(n == 2, two).otherwise(more)
        level = levels[size].select(
            "gram", ((n - cut) / total).alias("own"), (spare / total).alias("back"),
            (F.col("gram") % F.lit(256 ** (size - 1))).alias("shorter"))
        if p is None:
            level = level.withColumn("low", F.lit(1 / 256))
        else:
            level = level.join(p.select(F.col("gram").alias("shorter"), F.col("p").alias("low")), "shorter")
        p = level.select("gram", (F.col("own") + F.col("back") * F.col("low")).alias("p"))
    return p.select("gram", F.log("p").alias("log_p"))


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text (empty for null) and two hashes, 96 bits together, that name the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "lang", text.alias("text"), F.xxhash64(text).alias(_KEY[0]), F.hash(text).alias(_KEY[1]))


def _costs(keyed: DataFrame, part: DataFrame) -> DataFrame:
    """Each text's cost in nats, as far as its n-grams are in this slice of the model."""
    arrays = part.select("gram", F.col("log_p").cast("float")).toArrow()
    order = np.argsort(gram := arrays["gram"].to_numpy())
    gram, log_p = gram[order], arrays["log_p"].to_numpy()[order]

    def rows(keys, checks, texts):
        cost = np.zeros(len(texts))
        if len(gram):
            for code, owner in _chunks(texts):
                asked, back = np.unique(code, return_inverse=True)
                at = np.minimum(np.searchsorted(gram, asked), len(gram) - 1)
                known = np.where(gram[at] == asked, log_p[at], 0.0)
                cost -= np.bincount(owner, known[back], len(texts))
        yield keys, checks, cost

    return map_rows(keyed.select(*_KEY, as_bytes()), rows, f"{_KEY[0]} long, {_KEY[1]} int, cost double")


def costs(keyed: DataFrame) -> DataFrame:
    """The cost of every different text, in nats, under the model of all texts."""
    model = stored(kneser_ney(stored(count_ngrams(keyed), "ngrams")), "model")
    slices = max(1, -(-model.count() // SLICE))
    of = F.pmod(F.xxhash64("gram"), F.lit(slices))
    shares = [stored(_costs(keyed, model.filter(of == s)), "costs") for s in range(slices)]
    # Copies of a text have the same share each, so the mean is that of one of them. Stored, so that the
    # join with the rows can split those of a text with many copies.
    return stored(reduce(DataFrame.unionAll, shares).groupBy(*_KEY).agg((F.avg("cost") * slices).alias("cost")), "costs")


def base_counts(text: str):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.split()]
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        times = Counter(triples)
        until = 0
        for n, triple in enumerate(triples):
            if times[triple] > 1:
                repeated += n + 3 - max(n, until)
                until = n + 3
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    return (len(words), len(text) - blanks, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated)



def _kept(rated: DataFrame, measures, above: float, below: float, least: float) -> DataFrame:
    """`rated` with the column `kept`: base rules passed, and every measure inside its language's band."""
    bins = rated.filter("NOT base_failed").select("lang", F.inline(F.array(*(
        F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) * BINS).alias("bin")) for m in measures)))).groupBy(
        "lang", "measure", "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("lang", "measure")
    upto = F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    share = bins.select("lang", "measure", "bin", (upto / F.sum("n").over(whole)).alias("share"))

    def quartile(m, q):
        return F.min(F.when((F.col("measure") == m) & (F.col("share") >= q / 4), (F.col("bin") + 0.5) / BINS))

    bands = share.groupBy(F.col("lang").alias("of")).agg(*(
        quartile(m, q).alias(f"{m}_{q}") for m in measures for q in (1, 2, 3)))
    inside = ~F.col("base_failed")
    for m in measures:
        q1, middle, q3 = (F.col(f"{m}_{q}") for q in (1, 2, 3))
        low = middle - F.greatest(below * (middle - q1), F.lit(2 * least))
        high = middle + F.greatest(above * (q3 - middle), F.lit(least))
        inside = inside & F.coalesce((F.col(m) >= low) & (F.col(m) <= high), F.lit(False))
    return rated.join(bands, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn("kept", inside)


def rate(docs: DataFrame, above: float = 5.0, below: float = 8.0, least: float = 0.12) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, log_perplexity, log_word_cost.

    A text fails the base rules with under 50 words, or if over half of its words lie in 3-word
    windows that it repeats. log_perplexity is the model's cost of a byte in nats, log_word_cost the
    logarithm of its cost of a word. Others are kept if both are at most `above` times the distance of
    the upper quartile (at least `least`) over the median and `below` times that of the lower one (at
    least twice `least`) under it, among the texts of the same lang (null is a language of its own)
    that pass the base rules. The lower band is the wider, since copies, which are clean, are cheap.
    The model counts all texts. Null texts are empty; repeated rows count each; other columns are
    not read.
    """
    keyed = _keyed(docs)

    def rows(ids, langs, texts, keys, checks):
        counts = [base_counts(t) for t in texts]
        failed = [n < 50 or 100 * again > 50 * n for n, *_, again in counts]
        yield ids, langs, keys, checks, [len(t.encode()) + 1 for t in texts], *zip(*counts), failed

    based = map_rows(
        keyed, rows, f"doc_id long, lang string, {_KEY[0]} long, {_KEY[1]} int, size long, n_words long, "
        "word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean")
    word_cost = F.log(F.greatest(F.col("cost") / F.greatest("n_words", F.lit(1)), F.lit(1e-9)))
    rated = stored(based.join(costs(keyed), _KEY).withColumns({
        "log_perplexity": F.col("cost") / F.col("size"), "log_word_cost": word_cost}), "rated")
    return _kept(rated, ("log_perplexity", "log_word_cost"), above, below, least).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "log_perplexity", "log_word_cost")
