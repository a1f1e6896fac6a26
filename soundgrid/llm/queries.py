"""The registered queries: each applies its operator to a whole table; those whose rows SQL can express carry it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embeddings, html, langid, media, minhash, mixing, packing, tokens, warc

PROBE = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return chat.format_conversations(turns.unionByName(probe), with_text=False).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def sample_edits() -> Column:
    """Three edits for any text: cut 20 characters at a third, put words in at half of what was, replace the first character."""
    n = F.length(F.coalesce("text", F.lit("")))
    edit = lambda start, stop, put: F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"), F.lit(put).alias("put"))
    third, half = F.floor(n / 3), F.floor(n / 2)
    return F.array(edit(third, third + 20, ""), edit(half, half, " words put in "), edit(F.lit(0), F.lit(1), "Z"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.edited_counts(table(spark, sf_dir, "documents").withColumn("edits", sample_edits()))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_media, op2_chat, op3_mixing, op4_langid, op5_minhash, op6_embeddings, op7_tokens, op8_warc, op9_packing, op10_html)}


def _escaped(text: str) -> str:
    out = rf"replace({text}, '\', '\\')"
    for c in chat.CONTROL:
        out = rf"replace({out}, '{c}', '{c[0]}\!{c[1:]}')"
    return out


_OP2 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
sized AS (
  SELECT *, length({_escaped("text")}) + CASE WHEN role = 'assistant' THEN 9 WHEN role = 'user' THEN 15
    ELSE 33 + length({_escaped("role")}) END AS formatted FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_COMPONENTS = """
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(id, seen) AS (SELECT x, y FROM ways UNION SELECT reach.id, ways.y FROM reach JOIN ways ON reach.seen = ways.x),
least AS (SELECT id, min(seen) AS component FROM reach GROUP BY id)
"""

_OP5 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
{_COMPONENTS}
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.component, d.doc_id)) AS component_id, d.doc_id <= coalesce(l.component, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.id = d.doc_id
"""

_OP6 = f"""
WITH RECURSIVE fine AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM fine a JOIN fine b ON a.vec_id < b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
{_COMPONENTS},
degree AS (SELECT x, count(*) AS n FROM ways GROUP BY x)
SELECT v.vec_id, coalesce(g.n, 0) AS n_links, least(v.vec_id, coalesce(l.component, v.vec_id)) AS component_id, v.vec_id <= coalesce(l.component, v.vec_id) AS kept
FROM embeddings v LEFT JOIN degree g ON g.x = v.vec_id LEFT JOIN least l ON l.id = v.vec_id
"""

_OP8 = """
WITH sized AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT s.page_id, s.payload_bytes, s.payload_digest, CASE WHEN f.first <> s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> s.page_id THEN f.first END AS refers_to
FROM sized s LEFT JOIN firsts f ON f.payload_digest = s.payload_digest
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": _OP2, "op5_minhash": _OP5, "op6_embeddings": _OP6, "op8_warc": _OP8}
