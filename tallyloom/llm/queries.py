"""Registered queries of the subpackage: one per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff, chat, collocations, licences, mixing, ordinal, packing, prefixhash, repeats, simhash, toxicity, weakrules, whitening
from .staging import ship, stage, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            CHECKS[name] = sql
        return shipped

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("bits")).alias("fingerprint"), "component_id")


MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, 'null')), 1, 3))::BIGINT AS bucket
    FROM documents
), sums AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
           2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS goal
    FROM sums
), ordered AS (
    -- Sources fill up in the order of cap / weight; the level holds if the source that fills next stays below its cap.
    SELECT *, coalesce(sum(cap) OVER w, 0.0) AS full_before, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0) AS rest
    FROM weighed WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
    SELECT max((goal - full_before) / rest) FILTER (WHERE (goal - full_before) / rest * weight <= cap) AS level FROM ordered
), targets AS (
    SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(weight * level, cap) END AS target FROM weighed, water
), planned AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
           target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS more
    FROM targets
), buckets AS (
    SELECT source, list({'bucket': bucket, 'words': words, 'left': 0::BIGINT, 'taken': []::BIGINT[], 'least': NULL::STRUCT(words BIGINT, bucket BIGINT)}
                        ORDER BY bucket) AS rows
    FROM (SELECT source, bucket, sum(size)::BIGINT AS words FROM sized GROUP BY source, bucket HAVING sum(size) > 0)
    GROUP BY source
), filled AS (
    -- Every bucket in seeded order, taken if it fits into what is still wanted.
    SELECT p.source, list_reduce(
        list_prepend({'bucket': -1::BIGINT, 'words': 0::BIGINT, 'left': floor(p.more)::BIGINT, 'taken': []::BIGINT[],
                      'least': NULL::STRUCT(words BIGINT, bucket BIGINT)}, b.rows),
        lambda s, r: {'bucket': r.bucket, 'words': r.words,
                'left': CASE WHEN r.words <= s.left THEN s.left - r.words ELSE s.left END,
                'taken': CASE WHEN r.words <= s.left THEN list_append(s.taken, r.bucket) ELSE s.taken END,
                'least': CASE WHEN r.words <= s.left THEN s.least
                              WHEN s.least IS NULL OR r.words < s.least.words THEN {'words': r.words, 'bucket': r.bucket}
                              ELSE s.least END}) AS f
    FROM planned p JOIN buckets b ON p.source IS NOT DISTINCT FROM b.source
), chosen AS (
    SELECT source, unnest(f.taken) AS bucket FROM filled
    UNION ALL SELECT source, f.least.bucket FROM filled WHERE f.least.words <= 2 * f.left
)
SELECT s.doc_id, s.size, p.source_size, p.target,
       (s.size * (p.whole + CASE WHEN c.bucket IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.bucket = c.bucket
"""


@query("op6_mixing", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(stage(sized, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"], cut_text=False)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ordinal.Model:
    """Grades of ``labels``: 0 low quality, 1 good but toxic, 2 good."""
    rating = F.when(F.col("quality") == 0, 0).when(F.col("quality").isNotNull(), F.when(F.col("toxic") == 1, 1).otherwise(2))
    return ordinal.train(docs, table(spark, sf_dir, "labels"), rating)


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    graded = ordinal.grade(docs, quality_model(spark, docs, sf_dir), keep=["doc_id"])
    return graded.withColumn("kept", F.col("tail_probability") >= 0.5)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_weak_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weakrules.judged(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good_probability"
    )


@query("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixhash.fingerprints(table(spark, sf_dir, "documents"))


@query("op5_chat")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, chat.ASSISTANT, said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(turns.union(more)))


@query("op3_licences")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


@query("op11_lm_scoring")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 2
    return backoff.scores(table(spark, sf_dir, "documents"), apart)


PHRASE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), listed AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k, list_slice(w, i, i + k - 1) AS p
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM listed, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k)
), counts AS (
    SELECT lang, k, array_to_string(p, ' ') AS phrase, p, count(*)::HUGEINT AS f FROM grams GROUP BY lang, k, p
), sizes AS (
    SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), cuts AS (
    SELECT c.lang, c.k, c.phrase, c.p, c.f AS a, x.cut,
           array_to_string(list_slice(c.p, 1, x.cut), ' ') AS head, array_to_string(list_slice(c.p, x.cut + 1, c.k), ' ') AS tail
    FROM counts c JOIN (VALUES (1), (2)) x(cut) ON x.cut < c.k WHERE c.f >= 10
), valued AS (
    SELECT c.*, h.f AS l, t.f AS r, (1000000 * c.a * c.a) // (h.f * t.f) AS score
    FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head AND h.k = c.cut
    JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail AND t.k = c.k - c.cut
), least AS (
    SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_pairs AS (
    SELECT lang, phrase, max(f) AS over FROM (
        SELECT lang, array_to_string(list_slice(p, 1, 2), ' ') AS phrase, f FROM counts WHERE k = 3 AND f >= 10
        UNION ALL SELECT lang, array_to_string(list_slice(p, 2, 3), ' '), f FROM counts WHERE k = 3 AND f >= 10
    ) GROUP BY lang, phrase
), ranked AS (
    SELECT l.lang, row_number() OVER (PARTITION BY l.lang ORDER BY l.score DESC, l.a DESC, l.phrase) AS rank, l.phrase, l.a, l.l, l.r, l.score
    FROM least l LEFT JOIN inner_pairs i ON i.lang = l.lang AND i.phrase = l.phrase AND l.k = 2
    WHERE i.over IS NULL OR 100 * i.over < 50 * l.a
)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, s.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE r.rank <= 2000
"""


@query("op12_collocations", PHRASE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
