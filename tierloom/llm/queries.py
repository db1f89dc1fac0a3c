"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm import bpe, collocations, conversations, embedding_dedup, fingerprints, language, lm, mixing, ngram_join, packing, sharding, toxicity, warc
from tierloom.llm.common import fold_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REGISTERED_SQL: dict[str, str] = {}

BPE_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            REGISTERED_SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_bpe_encode")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded(table(spark, folder, "documents"), BPE_VOCABULARY)


@query(
    "op3_embedding_dedup",
    """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ), reach AS (
        SELECT a AS node, a AS root FROM links
        UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node
    ), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
    counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN roots ON roots.node = vec_id LEFT JOIN counts ON counts.node = vec_id
    """,
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.similar_vectors(table(spark, folder, "embeddings"))


@query("op4_ngram_join")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


@query("op5_warc")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archived(table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_fingerprints")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@query("op7_sharding")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.sharded(table(spark, folder, "documents"), 8)
    text = F.coalesce("row.text", F.lit("")).cast("binary")
    return shards.select(
        F.col("row.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_mixing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.planned(table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "shards")


@query("op6_language_id")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False))
    model = language.train(docs.where(~held_out), PIECE_VOCABULARY)
    return language.predicted(docs, model, PIECE_VOCABULARY).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False))
    model = toxicity.fit(docs, toxicity.labelled(docs, labels.where(~held_out)))
    return toxicity.scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op1_lm_score")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(fold_of("doc_id", 7) == 2, F.lit(False))
    counts = lm.counted(docs.where(~held_out))
    coded = lm.encoded(docs, counts, trains=~held_out)
    scores = lm.scored_from(coded, counts, lm.trained_on(coded, counts))
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_packing")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.packed(table(spark, folder, "documents"), BYTE_VOCABULARY)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op12_conversation_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return conversations.audited(rows, conversations.damaged(rows))


@query(
    "op13_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
    phrases AS (
        SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
        FROM starts, (VALUES (1), (2), (3), (4), (5)) AS sizes(size) WHERE i + size - 1 <= len(w) GROUP BY ALL
    ), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang),
    candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE size >= 2 AND f >= 100),
    cuts AS (SELECT *, unnest(range(1, size)) AS cut FROM candidates),
    scored AS (
        SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, t.n, c.cut, (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
        FROM cuts c JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
        JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ') JOIN totals t ON t.lang = c.lang
    ), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    lengths AS (SELECT *, unnest(range(2, size)) AS k FROM candidates WHERE size >= 3),
    spans AS (SELECT *, unnest(range(1, size - k + 2)) AS i FROM lengths),
    around AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS f FROM spans GROUP BY ALL),
    kept AS (SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.f IS NULL OR 100 * o.f < 100 * b.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
    """.replace(r"\x", r"\x"),
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
