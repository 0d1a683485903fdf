"""One query per operator over the whole test tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import licenses
from starload.llm.bwt_dedup import remove_earlier
from starload.llm.collocations import collocations
from starload.llm.edit_counts import counts_after_edits
from starload.llm.hard_negatives import hard_negatives
from starload.llm.jaccard import jaccard_join
from starload.llm.licenses import license_scan
from starload.llm.mixing import mix
from starload.llm.packing import pack_documents
from starload.llm.quality_model import quality_scores
from starload.llm.quality_votes import quality_votes
from starload.llm.substrings import remove_repeats
from starload.llm.topk import top_k
from starload.llm.toxicity import toxicity_scores
from starload.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """Texts go to Python in small batches, as some are long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(prepared(spark), sf_dir)
    return QUERIES[run.__name__]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"), vocabulary(), with_ids=False)


@query
def op2_substrings(spark: SparkSession, d: str) -> DataFrame:
    return remove_repeats(table(spark, d, "documents")).select(
        "doc_id", F.col("dedup_words").alias("n_words"), F.col("dedup_removed").alias("n_removed"),
        F.sha2("dedup_text", 256).alias("kept_sha256"),
    )


@query
def op3_edit_counts(spark: SparkSession, d: str) -> DataFrame:
    """Each document gets three edits: a replaced stretch, a cut and a line at its end."""
    length = F.coalesce(F.length("text"), F.lit(0)).cast("long")

    def place(salt: int) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(salt)), length + 1)

    def edit(at: Column, removed: int, inserted: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(removed).cast("long").alias("removed"),
                        inserted.alias("inserted"))

    edits = F.array(
        edit(place(1), 12, F.concat(F.lit(" revised by "), F.coalesce("source", F.lit("hand")))),
        edit(place(2), 40, F.lit("")),
        edit(length + 100, 0, F.lit("\nEnd of document.")),
    )
    return counts_after_edits(table(spark, d, "documents"), edits, vocabulary()).select(
        "doc_id", "n_tokens", "n_tokens_after", "n_chars_after", "n_reencoded")


@query
def op4_mix(spark: SparkSession, d: str) -> DataFrame:
    """All documents with their places in the mixed order."""
    return mix(table(spark, d, "documents").select("doc_id", "source"))


@query
def op5_top_k(spark: SparkSession, d: str) -> DataFrame:
    return top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op6_licenses(spark: SparkSession, d: str) -> DataFrame:
    scanned = license_scan(table(spark, d, "documents"))
    starts = F.flatten(F.transform("found", lambda f: f["starts"]))
    phrase_labels = F.transform("found", lambda f: f["label"])
    return scanned.select(
        "doc_id", "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(phrase_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(phrase_labels, F.col("notices"))), ",").alias("labels"),
        F.when(F.size(starts) > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


@query
def op7_quality_model(spark: SparkSession, d: str) -> DataFrame:
    return quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op8_quality_votes(spark: SparkSession, d: str) -> DataFrame:
    return quality_votes(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


@query
def op9_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join(table(spark, d, "documents"))


@query
def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity_scores(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op11_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    """Some labels are moved on by one first, so that near neighbours differ."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, d, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


@query
def op12_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations(table(spark, d, "documents"))


@query
def op13_bwt_dedup(spark: SparkSession, d: str) -> DataFrame:
    return remove_earlier(table(spark, d, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("bytes_kept", 256).alias("kept_sha256"),
    )


@query
def pipeline(spark: SparkSession, d: str) -> DataFrame:
    return corpus_pipeline.run(spark, d)


def _license_sql() -> str:
    phrases = ", ".join(
        f"({len(p.split())}, ' {p} ', '{label}')" for p, label in licenses.PHRASES.items()
    )
    templates = ", ".join(
        f"('{label}', list_distinct(string_split('{words}', ' ')), "
        f"string_split('{licenses.NAMING.get(label, '')}', ' '), "
        f"{licenses.block_words(words)})"
        for label, words in licenses.TEMPLATES.items()
    )
    return f"""
    WITH d AS (
      SELECT doc_id, md5(concat_ws('|', coalesce(doc_id::VARCHAR, '-'), coalesce(text, ''))) AS h,
             translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}') AS lower_text
      FROM documents),
    w AS (SELECT doc_id, h, lower_text, regexp_extract_all(lower_text, '{licenses.WORD}') AS words
          FROM d),
    phrases(n, phrase, label) AS (VALUES {phrases}),
    templates(label, template, named, span) AS (VALUES {templates}),
    places AS (
      SELECT DISTINCT h, label, i - 1 AS start
      FROM (SELECT h, words, unnest(range(1, len(words) + 1)) AS i FROM w
            WHERE len(words) > 0) x, phrases
      WHERE ' ' || array_to_string(words[i:i + n - 1], ' ') || ' ' = phrase),
    found AS (
      SELECT h, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word
      FROM places GROUP BY ALL),
    -- A block worth a look begins with a word of the template.
    begun AS (
      SELECT DISTINCT h, i, t.label
      FROM (SELECT DISTINCT h, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word
            FROM (SELECT DISTINCT h, words FROM w WHERE len(words) > 0) y) x
      JOIN (SELECT label, unnest(template) AS word FROM templates) t ON t.word = x.word),
    met AS (
      SELECT h, label, max(len(held) / len(template)) AS c
      FROM (SELECT b.h, b.label, t.template, t.named,
                   list_intersect(list_distinct(u.words[b.i:b.i + t.span - 1]), t.template) AS held
            FROM begun b JOIN templates t USING (label)
            JOIN (SELECT DISTINCT h, words FROM w) u USING (h)) x
      WHERE len(held) * 10 >= 8 * len(template)
        AND (named = [''] OR len(list_intersect(held, named)) = len(named)) GROUP BY ALL),
    best AS (SELECT h, max(c) AS c FROM met GROUP BY ALL),
    named AS (
      SELECT h, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT h, label FROM places UNION SELECT h, label FROM met) x GROUP BY ALL),
    base_named AS (
      SELECT h, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM places GROUP BY ALL)
    SELECT w.doc_id, len(w.words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_named.labels, '') AS base_labels, coalesce(named.labels, '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best.c, 0.0) END::DOUBLE AS score
    FROM w LEFT JOIN found USING (h) LEFT JOIN best USING (h)
    LEFT JOIN named USING (h) LEFT JOIN base_named USING (h)"""


TOP_K_SQL = """
    WITH v AS (
      SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    numbered AS (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
             vec_id, score
      FROM scored)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM numbered WHERE rank <= 5"""

WORDS_SQL = r"[^\x20\x09-\x0D]+"

SUBSTRINGS_SQL = f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS_SQL}') AS w
      FROM documents),
    windows AS (
      SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
      FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35) x),
    hits AS (
      SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM windows
      WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
    words AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d WHERE len(w) > 0),
    kept AS (
      SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
      FROM words ANTI JOIN hits USING (r, i) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)"""

JACCARD_SQL = f"""
    WITH RECURSIVE d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{WORDS_SQL}') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT r, doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
      FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d
            WHERE len(w) > 0) x),
    sizes AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM shingles GROUP BY r),
    common AS (
      SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b USING (h)
      WHERE a.r <> b.r AND a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY a.r, b.r),
    links AS (
      SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM common o
      JOIN sizes x ON x.r = o.a JOIN sizes y ON y.r = o.b
      WHERE 100 * o.n >= 75 * (x.n + y.n - o.n)),
    reached(a, b) AS (
      SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
    lowest AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
    SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles,
           CASE WHEN sizes.n > 0 THEN least(d.doc_id, coalesce(lowest.b, d.doc_id))
                ELSE d.doc_id END AS component_id
    FROM d LEFT JOIN sizes USING (r) LEFT JOIN lowest ON lowest.a = d.doc_id"""

HARD_NEGATIVES_SQL = """
    WITH v AS (
      SELECT row_number() OVER () AS r, vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT q.r, q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
             list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
    positives AS (
      SELECT * FROM (
        SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score,
               row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
        FROM scored WHERE same) x WHERE place <= 5),
    negatives AS (
      SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score,
             s.score AS negative_score,
             row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM positives p JOIN scored s ON s.r = p.r AND NOT s.same
        AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
    FROM negatives WHERE rank <= 5"""

COLLOCATIONS_SQL = f"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
               translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
               '[.,;:!?\\x0A-\\x0D]')) AS piece
      FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
    n AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
    grams AS (
      SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM starts, (VALUES (1), (2), (3), (4), (5)) sizes(k) WHERE i + k - 1 <= len(w)),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
    cuts AS (
      SELECT lang, phrase, k, f AS a, p AS w, unnest(range(1, k)) AS cut
      FROM (SELECT *, string_split(phrase, ' ') AS p FROM f WHERE k > 1) x),
    parts AS (
      SELECT c.*, x.f AS l, y.f AS r, n.n,
             (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS score
      FROM cuts c JOIN n USING (lang)
      JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
      JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
    worst AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place
        FROM parts) x WHERE place = 1),
    inside AS (
      SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(f) AS f
      FROM (SELECT lang, w, f, i, unnest(range(i + 1, k + 1)) AS j
            FROM (SELECT lang, string_split(phrase, ' ') AS w, f, k, unnest(range(1, k)) AS i
                  FROM f WHERE k > 2) x) y
      WHERE j - i + 1 < len(w) GROUP BY ALL),
    kept AS (
      SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase)
      WHERE inside.f IS NULL OR 100 * inside.f < 100 * worst.a),
    numbered AS (
      SELECT lang, row_number() OVER (
               PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
             phrase, a, l, r, n, score::BIGINT AS score
      FROM kept)
    SELECT * FROM numbered WHERE rank <= 2000"""

# Bytes are written as pairs of hex digits.
BWT_DEDUP_SQL = """
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    starts AS (
      SELECT r, doc_id, i, hash(substr(x, 2 * i + 1, 100)) AS h
      FROM (SELECT r, doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM d
            WHERE doc_id IS NOT NULL AND length(x) >= 100) s),
    least AS (SELECT h, min(doc_id) AS doc_id FROM starts GROUP BY h),
    hits AS (SELECT s.r, s.i FROM starts s JOIN least USING (h) WHERE least.doc_id < s.doc_id),
    gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM hits),
    counts AS (
      SELECT r, count(*) AS n_removed, sum(CASE WHEN i = before + 1 THEN 0 ELSE 1 END)::BIGINT AS n_spans
      FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM gone) g GROUP BY r),
    bytes AS (
      SELECT r, i, substr(x, 2 * i + 1, 2) AS b
      FROM (SELECT r, x, unnest(range(0, length(x) // 2)) AS i FROM d WHERE r IN (SELECT r FROM gone)) s),
    kept AS (
      SELECT r, string_agg(b, '' ORDER BY i) AS x FROM bytes ANTI JOIN gone USING (r, i) GROUP BY r)
    SELECT doc_id, length(d.x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
           coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(CASE WHEN n_removed > 0 THEN coalesce(kept.x, '') ELSE d.x END)) AS kept_sha256
    FROM d LEFT JOIN counts USING (r) LEFT JOIN kept USING (r)"""

ORACLE: dict[str, str] = {
    "op11_hard_negatives": HARD_NEGATIVES_SQL, "op12_collocations": COLLOCATIONS_SQL,
    "op13_bwt_dedup": BWT_DEDUP_SQL,
    "op2_substrings": SUBSTRINGS_SQL, "op9_jaccard": JACCARD_SQL,
    "op5_top_k": TOP_K_SQL, "op6_licenses": _license_sql(),
}
