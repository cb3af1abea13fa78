"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import chat, decontaminate, html_text, langid, media, mixing, near_dedup, pii, secrets, sharding


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_matched")


def op2_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_documents(_read(spark, sf_dir, "conversations"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"), width=2, percent=80)


def op4_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_read(spark, sf_dir, "documents"), shards=8)


def op5_hierarchical_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(_read(spark, sf_dir, "documents"))


def op7_min_cut_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op8_token_efficiency_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op9_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(_read(spark, sf_dir, "documents"))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.loomgraph.pii.key", "a key for tests; set spark.loomgraph.pii.key to a secret")
    return pii.surrogate_digest(_read(spark, sf_dir, "documents"), key.encode())


def queries() -> dict:
    ops = [
        op1_template_decontamination, op2_snapshot_collapse, op3_minhash_near_dedup, op4_feistel_sharding, op5_hierarchical_language_id,
        op6_source_mixing, op7_min_cut_main_text, op8_token_efficiency_secrets, op9_jpeg_media, op10_pii_surrogates,
    ]
    return {f.__name__: f for f in ops}


_UNITS = decontaminate.UNITS
#: RE2 has no look-behind, so the character before a name is taken along and put back.
_OP1 = f"""
WITH raw AS (
  SELECT doc_id AS id, 'd' AS side, text FROM documents
  UNION ALL SELECT item_id, 'i', text FROM benchmark WHERE item_id IS NOT NULL
), numbered AS (
  SELECT id, side, regexp_replace(regexp_replace(coalesce(text, ''), '[0-9]+(?:[.,][0-9]+)*', ' zqnum ', 'g'),
    '(zqnum +)(?:{_UNITS})([^a-zA-Z0-9]|$)', '\\1zqunit \\2', 'g') AS t FROM raw
), tokens AS (
  SELECT id, side, list_filter(string_split_regex(lower(regexp_replace(t, '([^.!?:\\n ]) +((?:\\p{{Lu}}\\p{{Ll}}+ +)*\\p{{Lu}}\\p{{Ll}}+)', '\\1 zqname', 'g')),
    '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM numbered
), grams AS (
  SELECT id, side, p, array_to_string(w[p + 1 : p + 5], ' ') AS g
  FROM (SELECT id, side, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS p FROM tokens)
), sizes AS (SELECT id, count(*) AS n FROM grams WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, s.n AS n_windows, count(DISTINCT i.p) AS n_matched
FROM (SELECT DISTINCT id, g FROM grams WHERE side = 'd') d
JOIN (SELECT id, p, g FROM grams WHERE side = 'i') i USING (g)
JOIN sizes s ON s.id = i.id
GROUP BY d.id, i.id, s.n HAVING 100 * count(DISTINCT i.p) >= 80 * s.n
"""

_OP2 = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos, role, text
  FROM conversations WHERE conv_id IS NOT NULL
), said AS (
  SELECT conv_id, pos, '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS s,
    md5(coalesce(role, '-') || chr(0) || coalesce(text, chr(1))) AS h FROM t
), pre AS (
  SELECT conv_id, pos + 1 AS n, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY pos) AS k, count(*) OVER (PARTITION BY conv_id) AS last FROM said
), whole AS (SELECT k, n, min(conv_id) AS conv_id FROM pre WHERE n = last GROUP BY k, n),
kept AS (SELECT conv_id, n FROM whole WHERE k NOT IN (SELECT k FROM pre WHERE n < last))
SELECT conv_id, (pos // 1024)::INTEGER AS segment, n AS n_turns, string_agg(s, '' ORDER BY pos) AS text
FROM said JOIN kept USING (conv_id) GROUP BY conv_id, pos // 1024, n
"""


def _crc_table() -> str:
    out = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        out.append(str(i))
    return "[" + ",".join(out) + "]::BIGINT[]"


def _feistel(n: str, x: str) -> str:
    """One pass of the permutation of sharding.py, as nested macros would do it: six rounds of md5."""
    noise = lambda i, h: f"('0x' || substr(md5('{sharding.SEED}.{i}.' || ({h})::VARCHAR), 1, 15))::BIGINT"
    sql = f"SELECT *, ({x}) % a AS l0, ({x}) // a AS h0 FROM src"
    for i in range(sharding.ROUNDS):
        if i % 2 == 0:
            sql = f"SELECT * EXCLUDE (l0, h0), (l0 + {noise(i, 'h0')}) % a AS l0, h0 FROM ({sql})"
        else:
            sql = f"SELECT * EXCLUDE (l0, h0), l0, (h0 + {noise(i, 'l0')}) % b AS h0 FROM ({sql})"
    return f"SELECT * EXCLUDE (l0, h0), h0 * a + l0 AS y FROM ({sql})"


_OP4 = f"""
WITH RECURSIVE crc_t AS (SELECT {_crc_table()} AS t),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents
), c AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda acc, v: xor(t[(xor(acc, v) & 255) + 1], acc >> 8)), 4294967295::BIGINT) AS text_crc32
  FROM d, crc_t
), k AS (SELECT count(*) AS n, greatest(64, -(-count(*) // 50000)) AS buckets FROM documents),
r AS (
  SELECT doc_id, size, text_crc32, n, ceil(sqrt(n))::BIGINT AS a, (n + ceil(sqrt(n))::BIGINT - 1) // ceil(sqrt(n))::BIGINT AS b,
    row_number() OVER (ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':' || text_crc32), 1, 8))::BIGINT % buckets, doc_id NULLS FIRST, size, text_crc32) - 1 AS number
  FROM c, k
), walk AS (
  SELECT *, number AS x, 0 AS step FROM r
  UNION ALL
  SELECT * EXCLUDE (y, x, step), y AS x, step + 1 AS step FROM ({_feistel('n', 'x').replace('FROM src', 'FROM (SELECT * FROM walk WHERE step = 0 OR x >= n)')})
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % 8)::INTEGER AS shard, x // 8 AS slot, NULL::INTEGER AS grown_shard FROM walk WHERE step > 0 AND x < n
"""

_OP6 = """
WITH d AS (
  SELECT doc_id, source, text, len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents
), per AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, (sum(source_size) OVER ())::BIGINT AS total FROM per),
o AS (
  SELECT *, (total - 3 * (sum(source_size) OVER u - source_size)::BIGINT) / ((sum(weight) OVER ()) - (sum(weight) OVER u) + weight)::BIGINT AS level, row_number() OVER u AS ord
  FROM w WINDOW u AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), l AS (SELECT arg_min(level, ord) AS level FROM o WHERE level * weight <= 3 * source_size),
t AS (SELECT source, source_size, coalesce(least(l.level * weight, (3 * source_size)::DOUBLE), 0) AS target FROM o, l),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate FROM t),
c AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, d.source, (floor(rate) + CASE WHEN ('0x' || substr(md5('loom-mix:' ||
    CASE WHEN d.doc_id IS NULL THEN 't' || md5(coalesce(d.text, '')) ELSE d.doc_id::VARCHAR END), 1, 12))::BIGINT / 281474976710656 < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM c
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_template_decontamination": _OP1, "op2_snapshot_collapse": _OP2, "op4_feistel_sharding": _OP4, "op6_source_mixing": _OP6}
