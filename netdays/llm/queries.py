"""The registered queries: each operator over its whole table, by its contract."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.llm import block_names, conversations, failure_diagrams, itq, langid, packing, piece_bpe, pitman_yor, posting_lists, quality, simhash, suffixes, surrogates
from netdays.llm.common import prepare, remainder, table, written  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function=None, *, sql: str | None = None):
    """Register a function under its own name, with the SQL that must agree."""
    if function is None:
        return partial(query, sql=sql)

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    if sql is not None:
        ORACLES[function.__name__] = sql
    return function


def word_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(remainder("doc_id", 4) != 2))
    return langid.predict(docs, model).withColumn("held_out", remainder("doc_id", 4) == 2).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    return quality.scored(docs, model).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op3_itq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_components(table(spark, sf_dir, "embeddings"), itq.Settings(threshold=0.95))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, budget=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


SEQUENCE, END = 4096, 1


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = written(packing.tokenized(docs, word_model(), SEQUENCE, END, digest=True), "pieces")
    return packing.pack(pieces, SEQUENCE).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(docs, counted="n_entities")


@query
def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, words = pitman_yor.fit(docs.where(remainder("doc_id", 7) != 2))
    return pitman_yor.scored(docs, model, words).select(
        "doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.corpus.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"), piece_model())


@query
def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated spans of at least 50 words; a document without any has no row."""
    return suffixes.repeats(table(spark, sf_dir, "documents")).drop("text_class")


@query
def op10_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return posting_lists.nearest(rows, rows.where("vec_id % 20 = 0"), k=20)


@query(sql=r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
    FROM documents
),
stays AS (
    SELECT plain, count(*) AS group_size, arg_min(doc_id, (-points, doc_id)) AS keep_id FROM texts GROUP BY plain
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
FROM texts JOIN stays USING (plain)
""")
def op11_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.exact_groups(table(spark, sf_dir, "documents"))


@query(sql=r"""
WITH texts AS (
    SELECT d.doc_id, coalesce(d.lang, '') AS part, coalesce(d.text, '') AS t,
        regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS words,
        coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
),
masks AS (
    SELECT part, quality, toxic,
        (len(words) < 100)::INT
        + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask
    FROM texts
),
cells AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
    FROM masks GROUP BY part, mask
),
filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
        [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM filters a JOIN filters b ON a.bit <> b.bit JOIN filters c ON c.bit NOT IN (a.bit, b.bit)
    JOIN filters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN filters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
),
steps AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
counted AS (
    SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER (mask & (earlier + bit) = 0), 0) AS kept,
        coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS removed,
        coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & bit > 0), 0) AS redundant,
        coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
        coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
    redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
    toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
""")
def op12_failure_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_diagrams.corpus_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults that are drawn by id and turn."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return (
        rows.withColumn("draw", draw).where("draw <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        ).drop("copy")
    )


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(rows, damaged(rows))
