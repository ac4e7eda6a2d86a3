"""The operators with production parameters, over their whole tables."""

import public_tokenizers
from pyspark.sql import functions as F

from . import alignment, factors, html, licenses, mixing, neighbours, packing, perplexity, phrases, quality, simhash, substrings, toxicity
from .common import table
from .registry import ORACLES, QUERIES, query  # noqa: F401

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER, PIECE_TOKENIZER = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@query("op9_simhash_near_duplicates")
def op9(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"), size=3, distance=2)
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


@query("op2_substring_dedup")
def op2(spark, sf):
    return substrings.deduplicate(table(spark, sf, "documents"), window=13).drop("kept")


@query("op1_quality_grades")
def op1(spark, sf):
    return quality.grade(table(spark, sf, "documents"), table(spark, sf, "labels"), quality.rating(), grades=3)


@query("op10_toxicity")
def op10(spark, sf):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"), held_out)


@query("op3_best_fit_packing")
def op3(spark, sf):
    return packing.pack(table(spark, sf, "documents"), TOKENIZER, capacity=2048)


@query("op8_source_mix")
def op8(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), weights=(5, 2, 1), most=3)


@query("op5_perplexity_rules")
def op5(spark, sf):
    return perplexity.rate(table(spark, sf, "documents"))


@query("op6_license_templates")
def op6(spark, sf):
    return licenses.scan(table(spark, sf, "documents")).drop("spans")


@query("op7_nearest_vectors")
def op7(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op4_main_text")
def op4(spark, sf):
    return html.main_text(table(spark, sf, "pages"))


@query("op12_tokenizer_alignment")
def op12(spark, sf):
    return alignment.align(table(spark, sf, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)


@query("op11_collocations", r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS id, words FROM (
        SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents))
    WHERE len(words) > 0),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY 1),
grams AS (
    SELECT lang, m AS words, array_to_string(words[i:i + m - 1], ' ') AS phrase
    FROM (SELECT lang, words, m, unnest(generate_series(1, len(words) - m + 1)) AS i
          FROM pieces, generate_series(1, 4) s(m) WHERE len(words) >= m)),
counts AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, 2000000::HUGEINT * c.f // (x.f + y.f) AS score
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(generate_series(1, words - 1)) AS k
          FROM counts WHERE words > 1) c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
scored AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts)
    WHERE place = 1),
inner_phrases AS (
    SELECT lang, f, array_to_string(w[lo:lo + size - 1], ' ') AS phrase
    FROM (SELECT *, unnest(generate_series(1, words - size + 1)) AS lo
          FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(generate_series(2, words - 1)) AS size
                FROM counts WHERE words > 2))),
kept AS (
    SELECT * FROM scored s WHERE NOT EXISTS (
        SELECT 1 FROM inner_phrases i WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100::HUGEINT * i.f >= 80::HUGEINT * s.a)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang)
WHERE rank <= 2000""")
def op11(spark, sf):
    return phrases.collocations(table(spark, sf, "documents"))


@query("op13_earlier_bytes")
def op13(spark, sf):
    return factors.deduplicate(table(spark, sf, "documents"), window=100, keep=False)
