"""One registered query for each operator, over its whole table, and the oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytables.llm.alignment import align_tokenizers
from skytables.llm.budgets import mix
from skytables.llm.conversations import repair_conversations
from skytables.llm.columns import text_of, words
from skytables.llm.hilbert import hilbert_shards
from skytables.llm.interpolation import interpolated_scores
from skytables.llm.outliers import reject_outliers
from skytables.llm.packing import pack_documents
from skytables.llm.paragraphs import repeated_passages
from skytables.llm.secrets import find_secrets
from skytables.llm.signature_join import near_duplicates
from skytables.llm.templates import extract_main_text
from skytables.llm.warc import archive_round_trip
from skytables.llm.winnowing import contamination

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_quality_outliers")
def _quality_outliers(spark, sf_dir):
    return reject_outliers(_table(spark, sf_dir, "documents"), columns=["doc_id"])


def corpus_tree() -> dict[str, Column]:
    """The levels of the mixture: a domain is a family of sources, told by the number in a source's name."""
    number = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(0))
    return {"domain": F.concat(F.lit("d"), (number % 3).cast("string")), "language": F.col("lang"), "origin": F.col("source")}


def node_weights(spark: SparkSession) -> DataFrame:
    """Target weights of the op4 query; nodes that are not named weigh 1."""
    rows = "('d0', NULL, NULL, 4), ('d1', NULL, NULL, 3), ('d2', NULL, NULL, 2), ('d0', 'en', NULL, 3), ('d1', 'en', NULL, 3), ('d2', 'en', NULL, 5)"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(domain, language, origin, weight)")


@query("op4_source_mixture")
def _source_mixture(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    budget = int(docs.select(F.sum(F.size(words(text_of("text"))))).first()[0] or 0)
    out = mix(docs, levels=corpus_tree(), weights=node_weights(spark), budget=budget, max_epochs=2)
    return out.select("_row.doc_id", "domain", "language", "origin", "n_tokens", "epoch")


@query("op8_hilbert_shards")
def _hilbert_shards(spark, sf_dir):
    return hilbert_shards(_table(spark, sf_dir, "documents"), columns=["doc_id"])


@query("op10_near_duplicates")
def _near_duplicates(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


_ALNUM_WORDS = """list_filter(string_split_regex(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


@query(
    "op7_winnowed_hits",
    f"""
WITH items AS (SELECT item_id, {_ALNUM_WORDS.format("text")} AS w FROM benchmark),
spans AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS span
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
),
docs AS (SELECT doc_id, {_ALNUM_WORDS.format("text")} AS w FROM documents),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS span
    FROM docs, (SELECT DISTINCT n FROM spans), unnest(range(1, len(w) - n + 2)) AS t(i)
),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN spans USING (n, span)),
hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
),
ids AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN ids USING (doc_id)
""",
)
def _winnowed_hits(spark, sf_dir):
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query(
    "op5_warc_index",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""",
)
def _warc_index(spark, sf_dir):
    return archive_round_trip(_table(spark, sf_dir, "pages"))


@query("op6_layered_secrets")
def _layered_secrets(spark, sf_dir):
    return find_secrets(_table(spark, sf_dir, "documents"))


@query("op9_interpolated_scores")
def _interpolated_scores(spark, sf_dir):
    return interpolated_scores(_table(spark, sf_dir, "documents"))


@query("op3_repeated_paragraphs")
def _repeated_paragraphs(spark, sf_dir):
    return repeated_passages(_table(spark, sf_dir, "documents"))


@query("op1_main_text")
def _main_text(spark, sf_dir):
    return extract_main_text(_table(spark, sf_dir, "pages"))


@query("op13_conversation_repair")
def _conversation_repair(spark, sf_dir):
    return repair_conversations(_table(spark, sf_dir, "conversations"))


@query("op11_packing")
def _packing(spark, sf_dir):
    return pack_documents(_table(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def _token_alignment(spark, sf_dir):
    return align_tokenizers(_table(spark, sf_dir, "documents"))
