"""The registered queries of the operators (thin digests of their outputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import convtree, fim, langid, mixing, nndescent, packing, pieces, quality, sharding, simhash, toxicity, urls, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicate_vectors(_read(spark, sf_dir, "embeddings"))


def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.robust_rules(_read(spark, sf_dir, "documents")).select("doc_id", *quality.STATS, "base_failed", "kept", "distance")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_read(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_read(spark, sf_dir, "pages"))


def op8_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.interleave(_read(spark, sf_dir, "documents"))
    return s.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtree.conversation_trie(_read(spark, sf_dir, "conversations"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = pieces.encode(_read(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join("ids", " ")).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(_read(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    back = fim.restore(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_nn_descent, op3_robust_outliers, op4_simhash, op5_language_id, op6_mixing, op7_url_filter, op8_interleaved_shards, op9_toxicity, op10_warc,
    op11_conversation_trie, op12_sentencepiece, op13_fill_in_middle)}


def _base32(hex_: str) -> str:
    """Base32 of 40 hex digits: every five digits (20 bits) are four characters."""
    def group(i: int) -> str:
        n = f"cast('0x' || substr({hex_}, {5 * i + 1}, 5) AS BIGINT)"
        return " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(({n} >> {s}) & 31 AS INTEGER) + 1, 1)" for s in (15, 10, 5, 0))

    return " || ".join(group(i) for i in range(8))



def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: one list element a bit, the byte in the first of its eight."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform({bits}, lambda b: b::BIGINT)), {step}), 4294967295)"


#: the operators whose results SQL can state; the others are held against
#: brute-force versions, round trips and held-out accuracy in tests/llm
ORACLE_SQL: dict[str, str] = {
    "op10_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS first_id FROM p
      WINDOW w AS (PARTITION BY d ORDER BY page_id NULLS LAST))
SELECT page_id, cast(strlen(payload) AS BIGINT) AS payload_bytes, {_base32('d')} AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN first_id END AS refers_to
FROM r""",
    "op11_conversation_trie": f"""WITH t AS (
  SELECT conv_id, role, body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || body)) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, {_crc32('conv_id::VARCHAR')} % 9 AS h FROM t GROUP BY conv_id),
d AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS head FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT d.conv_id, t.pos, role, body FROM d JOIN t ON t.conv_id = d.base WHERE t.pos < d.h
  UNION ALL SELECT d.conv_id, t.pos - d.h + d.head, role, body FROM d JOIN t ON t.conv_id = d.conv_id WHERE t.pos >= d.h),
m AS (SELECT conv_id, 0 AS depth, '' AS k, 0 AS bytes FROM c
  UNION ALL SELECT conv_id, pos + 1, sha256(string_agg(sha256(length(role) || ':' || role || body), ',') OVER (PARTITION BY conv_id ORDER BY pos)), strlen(body) FROM r),
v AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM m GROUP BY depth, k),
p AS (SELECT v.*, up.conv_id AS parent_conv_id FROM v LEFT JOIN m ON m.conv_id = v.conv_id AND m.depth = v.depth - 1 LEFT JOIN v up ON up.depth = m.depth AND up.k = m.k),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY ALL),
w AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM p LEFT JOIN kids USING (conv_id, depth)),
s AS (SELECT m.depth, m.k, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((w.n_convs - 1) * w.bytes) AS saved_tokens
  FROM m JOIN w ON w.conv_id = m.conv_id AND w.depth >= m.depth GROUP BY m.depth, m.k),
e AS (SELECT depth, k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, max(depth) AS depth, arg_max(k, depth) AS k FROM m GROUP BY conv_id) GROUP BY depth, k)
SELECT w.conv_id, w.depth::BIGINT AS depth, w.parent_conv_id, w.n_convs, w.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM w JOIN s USING (depth, k) LEFT JOIN e USING (depth, k)""",
    "op13_fill_in_middle": """WITH x AS (SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS g FROM documents),
h AS (SELECT doc_id, body, length(body) AS n, ('0x' || substr(g, 1, 8))::BIGINT AS h1, ('0x' || substr(g, 9, 8))::BIGINT AS h2,
  ('0x' || substr(g, 17, 8))::BIGINT AS h3, ('0x' || substr(g, 25, 8))::BIGINT AS h4 FROM x),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, substring(body, 1, a) AS p, substring(body, a + 1, b - a) AS m, substring(body, b + 1) AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(body) AS restored_sha256
FROM o""",
}
