"""Queries over the given tables, one per operator, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subsight.llm.bpe import encode_documents
from subsight.llm.conversation_sql import CRC_TABLE, OP11, crc32
from subsight.llm.conversations import audit_conversations, damaged
from subsight.llm.decontaminate import find_leaks
from subsight.llm.edit_embedding import edited_fingerprints
from subsight.llm.importance import importance_resample
from subsight.llm.language import document_languages
from subsight.llm.merge_automaton import tokenize_documents
from subsight.llm.near_dup import near_duplicates
from subsight.llm.passages import repeated_passages
from subsight.llm.pitman_yor import lm_scores
from subsight.llm.secrets import secret_digest
from subsight.llm.sharding import sharded_documents
from subsight.llm.warc import header_text, page_captures, resolve_revisits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


_WORDS_SQL = r"""WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
"""

_OP10_SQL = (
    _WORDS_SQL
    + """sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN generate_series(1, len(w) - 4)]) END AS s
  FROM texts),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS o
  FROM flat x JOIN flat y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * o >= 85 * (na + nb - o)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.low AS component_id, s.doc_id = r.low AS kept
FROM sets s JOIN (SELECT node, min(seen) AS low FROM reach GROUP BY 1) r ON s.doc_id = r.node"""
)


@query("op10_minhash_near_dedup", _OP10_SQL)
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Rank file of the tokenizer; read on the driver and sent with the tasks.
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def tokenizer(name: str = RANK_FILE) -> tuple[bytes, str]:
    """Content of a vocabulary file and the pattern that splits texts before it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    return encode_documents(table(spark, sf_dir, "documents"), ranks, pattern, ids=False)


@query("op5_crf_language_id")
def op5_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_languages(table(spark, sf_dir, "documents"))


@query("op9_flow_resharding")
def op9_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_documents(table(spark, sf_dir, "documents"))


@query("op6_edit_fingerprints")
def op6_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op1_edit_decontamination")
def op1_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP4_SQL = r"""WITH captures AS (
  SELECT page_id AS p, c, url || CASE WHEN c % 2 = 1 THEN '#again' ELSE '' END AS url,
    page_id * 10 + c * 86400 + 1700000000 AS at, md5(html) AS digest, strlen(html) AS bytes,
    (c = 0 AND page_id % 11 <> 0) OR (c = 2 AND page_id % 7 = 0) AS full_,
    CASE WHEN page_id % 7 = 0 AND c >= 2 THEN 'b' WHEN c = 1 AND page_id % 5 = 0 THEN 'x' ELSE 'a' END AS v
  FROM pages, (SELECT unnest([0, 1, 2, 3]) AS c)),
bare AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM captures),
parts AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(
        regexp_extract(u, '^https?://([^/?]+)([^?]*)[?]?(.*)$', 1)), '^.*@', ''), ':(80|443)$', ''),
      '^(www[0-9]*|m)\.', '') AS host,
    regexp_replace(regexp_extract(u, '^https?://([^/?]+)([^?]*)[?]?(.*)$', 2), '/+$', '') AS path,
    array_to_string(list_sort([
      x FOR x IN string_split(regexp_extract(u, '^https?://([^/?]+)([^?]*)[?]?(.*)$', 3), '&')
      IF x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]*|fbclid|gclid|sessionid|phpsessid|jsessionid)(=|$)')]), '&') AS q
  FROM bare),
records AS (
  SELECT p * 4 + c AS id, host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url_key, *,
    '"' || v || '-' || digest || '"' AS tag FROM parts),
matched AS (
  SELECT r.id, max(s.id) FILTER (s.id IS NOT NULL AND (s.at, s.id) = m) AS sid FROM (
    SELECT r.id, r.url_key, max((s.at, s.id)) AS m
    FROM records r LEFT JOIN records s ON s.full_ AND s.url_key = r.url_key AND (s.at, s.id) < (r.at, r.id)
    WHERE NOT r.full_ GROUP BY 1, 2) r
  LEFT JOIN records s ON s.full_ AND s.url_key = r.url_key GROUP BY 1),
judged AS (
  SELECT r.*, s.id AS sid, s.tag AS stag, s.v AS sv, s.digest AS sdigest, s.bytes AS sbytes,
    CASE WHEN s.id IS NULL THEN 'unmatched' WHEN r.p % 6 = 0 THEN 'unverified'
      WHEN r.p % 6 > 1 AND r.tag = s.tag THEN 'resolved'
      WHEN r.p % 6 = 1 AND r.v = s.v THEN 'resolved' ELSE 'changed' END AS outcome
  FROM records r JOIN matched m ON r.id = m.id LEFT JOIN records s ON m.sid = s.id)
SELECT id AS record_id, url_key, outcome, sid AS response_id,
  'cache-control: max-age=' || c || chr(10)
  || CASE WHEN outcome IN ('resolved', 'unverified') THEN 'content-length: ' || sbytes || chr(10) || 'content-type: text/html'
     ELSE 'content-length: 0' END || chr(10)
  || CASE WHEN p % 6 > 1 THEN 'etag: ' || CASE WHEN p % 2 = 1 THEN 'W/' ELSE '' END || tag || chr(10)
     WHEN outcome IN ('resolved', 'unverified') THEN 'etag: ' || stag || chr(10) ELSE '' END
  || CASE WHEN p % 6 = 1 THEN 'last-modified: day ' || v || chr(10)
     WHEN outcome IN ('resolved', 'unverified') THEN 'last-modified: day ' || sv || chr(10) ELSE '' END
  || 'x-cache: hit' AS headers,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN sdigest || sv END AS payload
FROM judged"""


@query("op4_revisit_resolution", _OP4_SQL)
def op4_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", header_text(found["headers"]))


@query("op2_pitman_yor_scores")
def op2_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query("op8_chained_passages")
def op8_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op11_turn_alignment", OP11)
def op11_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_conversations(damaged(table(spark, sf_dir, "conversations")), present="present")


#: Model file with the merges, in their order.
MODEL_FILE = "byte_bpe_50k.json"


@query("op12_merge_automaton")
def op12_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, pattern = tokenizer(MODEL_FILE)
    return tokenize_documents(table(spark, sf_dir, "documents"), model, pattern, ids=False)


_OP13_SQL = f"""WITH {CRC_TABLE},
texts AS (SELECT doc_id, text, 'raw' AS side FROM documents UNION ALL SELECT item_id, text, 'target' FROM benchmark),
split AS (
  SELECT row_number() OVER () AS nth, doc_id, side, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
held AS (
  SELECT nth, side, unnest(list_concat(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]),
    [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) AS f FROM split),
counted AS (SELECT nth, side, f, count(*) AS n FROM held GROUP BY ALL),
distinct_features AS (SELECT DISTINCT f FROM counted),
hashed AS (SELECT f, {crc32('f')} % 10000 AS b FROM distinct_features, crc_table),
buckets AS (
  SELECT b, coalesce(sum(n) FILTER (side = 'raw'), 0) AS s, coalesce(sum(n) FILTER (side = 'target'), 0) AS t
  FROM counted JOIN hashed USING (f) GROUP BY 1),
totals AS (SELECT coalesce(sum(s), 0) AS big_s, coalesce(sum(t), 0) AS big_t FROM buckets),
gains AS (
  SELECT b, floor(1000 * ln(((t + 1) * (big_s + 10000))::DOUBLE / ((s + 1) * (big_t + 10000))::DOUBLE))::BIGINT AS g
  FROM buckets, totals),
weights AS (SELECT nth, sum(n)::BIGINT AS n, sum(n * g)::BIGINT AS weight FROM counted JOIN hashed USING (f) JOIN gains USING (b)
  WHERE side = 'raw' GROUP BY 1),
scored AS (
  SELECT nth, doc_id, len(w) >= 20 AS may, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(((
      '0x' || left(sha256('42:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (nth) WHERE side = 'raw'),
placed AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id NULLS FIRST) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN may AND place <= (SELECT count(*) * 5 // 100 FROM scored WHERE may) THEN place END AS rank
FROM placed"""


@query("op13_importance_resampling", _OP13_SQL)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.drop("n_words")
