"""Registered queries of the text operators, over whole tables, and their DuckDB twins."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.llm import (ann, bpe, chat, decontaminate, langid, ngram_join, pii, quality, runs, secrets, toxicity,
                          warc, whitening)
from corridor.llm.storage import table

SURROGATE_KEY = "corridor-surrogates"       # a deployment passes its own key


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file: from the installed package, or the folder in PUBLIC_TOKENIZERS."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers
        return public_tokenizers.path(name)
    return os.path.join("/opt/tokenizers", name)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest_columns(secrets.find_secrets(docs, secrets.train(docs)))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digest_columns(chat.format_examples(told.unionByName(extra)))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode_digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest_columns(decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.predict(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.digest_columns(langid.identify(docs, langid.train(docs)))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, SURROGATE_KEY)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = docs.select("doc_id", runs.repeat_tail(F.col("doc_id"), F.col("text")).alias("text"))
    return runs.digest_columns(runs.periodic_runs(told))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_secrets, op2_ngram_join, op3_chat, op4_bpe, op5_decontaminate, op6_warc, op7_ann,
                                   op8_quality, op9_langid, op10_pii, op11_runs, op12_whitening, op13_toxicity)}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
t AS (SELECT doc_id, len(g) AS n, unnest(list_transform(g, lambda x: hash(x))) AS h FROM s),
common AS (SELECT h FROM t GROUP BY h HAVING count(*) > 1),
c AS (SELECT t.* FROM t SEMI JOIN common USING (h)),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS k
  FROM c a JOIN c b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY ALL),
links AS (SELECT x, y FROM pairs WHERE 100 * k >= 85 * (nx + ny - k)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(node, low) AS (
  SELECT x, x FROM edges UNION SELECT e.y, r.low FROM reach r JOIN edges e ON e.x = r.node WHERE r.low < e.y),
lows AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(low, s.doc_id) AS component_id
FROM s LEFT JOIN lows ON lows.node = s.doc_id
"""


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_OP3 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, row_number() OVER w AS k, role = 'assistant' AS reply,
    sum({len(chat.TURN + chat.SAYS + chat.END)} + length({_escaped("role")}) + length({_escaped("text")}))
      OVER (w ROWS UNBOUNDED PRECEDING) AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
l AS (SELECT *, k = max(k) OVER (PARTITION BY conv_id) AS last FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (reply), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (reply OR last) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""

_OP5 = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(ws) - 8, 2))) AS u(i) WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT r, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM d, ks, unnest(range(1, len(ws) - k + 2)) AS u(i)),
found AS (SELECT r, i, k, g FROM grams SEMI JOIN win USING (k, g)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + k)) AS u(p) GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM found JOIN win USING (k, g) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_OP6 = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first, count(*) OVER (PARTITION BY d) AS copies FROM p),
t AS (SELECT *, n >= {warc.MIN_REVISIT} AND copies > 1 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM t
"""

# All words that repeat with a period, by brute force: a run of period q holds three multiples of q in a row at which a word
# equals the one q later, so only such (document, q) are compared word by word.
_OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: CAST(ascii(c) AS UBIGINT))), lambda crc, b: list_reduce(list_prepend(xor(crc, b),
        list_transform(range(8), lambda i: CAST(i AS UBIGINT))),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END)),
      CAST(4294967295 AS UBIGINT)) AS h
  FROM documents),
e AS (SELECT r, doc_id, ws, len(ws) AS n, CAST(h AS BIGINT) AS h, CAST(h // 10 AS BIGINT) AS g FROM d),
f AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM e),
t AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM f),
c AS (
  SELECT r, q FROM t, unnest(range(1, n // 4 + 1)) AS u(q)
  WHERE contains(array_to_string(list_transform(range((n - 1) // q),
    lambda k: CASE WHEN ws[k * q + 1] = ws[(k + 1) * q + 1] THEN '1' ELSE '0' END), ''), '111')),
m AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island
  FROM c JOIN t USING (r), unnest(range(n - q)) AS u(i) WHERE ws[i + 1] = ws[i + q + 1]),
s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM m GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
told AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first({'s': start, 'l': length, 'p': period} ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS best
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, i FROM runs, unnest(range(start + period, start + length)) AS u(i)),
kept AS (
  SELECT r, string_agg(ws[i + 1], ' ' ORDER BY i) AS words
  FROM (SELECT t.r, ws, i FROM told JOIN t USING (r), unnest(range(n)) AS u(i)) x ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
  CAST(best.p AS BIGINT) AS period, CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, array_to_string(ws, ' '))) AS collapsed_sha256
FROM t LEFT JOIN told USING (r) LEFT JOIN kept USING (r)
"""

ORACLE = {"op11_runs": _OP11, "op2_ngram_join": _OP2, "op3_chat": _OP3, "op5_decontaminate": _OP5, "op6_warc": _OP6}
