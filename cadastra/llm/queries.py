"""The registered query of each operator, over its whole table with production parameters, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, buckets, chat, decontaminate, flac, language_id, licenses, line_dedup, packing, search, sharding, simhash, token_counts
from .common import sha256_hex, table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Looked up when a query runs, so that importing this module needs no file."""
    return public_tokenizers.path(name)


PROBE = r"\### Assistant: </turn> ok"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op6_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.read(flac.store(table(spark, sf_dir, "documents")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(token_counts.lengths(table(spark, sf_dir, "documents"), vocabulary()))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    out = chat.conversations(rows.unionByName(probe))
    turns, loss = chat.parsed("formatted"), chat.under_loss("formatted", "loss")
    out = out.select(F.col("tree").alias("conv_id"), turns.alias("turns"), loss.alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha256_hex(whole).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"), sha256_hex(F.col("loss_text")).alias("loss_sha256"), "formatted_chars")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths: a source is taken as a tree whose directories hold ranges of a hundred ids and of ten."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", F.expr("doc_id div 100"), F.expr("doc_id div 10"), "doc_id")
    return licenses.license_scan(docs.select("doc_id", path.alias("path"), "text"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select(F.col("page.doc_id").alias("doc_id"), "n_lines", "n_dropped", sha256_hex(F.coalesce("text", F.lit(""))).alias("text_sha256"), "text")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op13_co_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = 600
    bucket = F.pmod(F.crc32(F.concat(F.lit("s"), F.col("sale_id").cast("string"))), F.lit(n)).cast("int")
    by_sale = F.coalesce(bucket - (bucket % 4 == 1).cast("int"), F.lit(n + 1))
    by_item = F.coalesce(F.pmod(F.crc32(F.col("item_id").cast("string")), F.lit(n)).cast("int"), F.lit(0))
    return buckets.co_bucketed(table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines"), "sale_id", (by_sale, by_item), bucket, n, ("sales", "sale_lines"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_sharding, op3_bpe, op4_decontaminate, op5_simhash, op6_flac, op7_token_counts, op8_chat, op9_license_scan, op10_line_dedup, op11_ranked_search, op12_packing, op13_co_bucketed)}


_OP4 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS pos FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS s FROM starts),
sizes AS (SELECT DISTINCT n FROM wins),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes WHERE len(w) >= n),
grams AS (SELECT doc_id, n, pos, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS s FROM places),
hits AS (SELECT g.doc_id, g.pos, g.n, wins.item_id FROM grams g JOIN wins ON g.n = wins.n AND g.s = wins.s),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP8 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(15 + length(regexp_replace(role, '[\\#<:]', '..', 'g')) + length(regexp_replace(text, '[\\#<]', '..', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

_OP10 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
pages AS (SELECT source, count(*) AS pages FROM d GROUP BY 1),
counts AS (SELECT source, line, count(*) AS n FROM (SELECT DISTINCT r, source, trim(unnest(lines)) AS line FROM d) WHERE line <> '' GROUP BY 1, 2),
bad AS (SELECT c.source, list(line) AS keys FROM counts c JOIN pages p ON c.source IS NOT DISTINCT FROM p.source WHERE n >= 2 AND n / pages > 0.1 GROUP BY 1),
k AS (SELECT d.*, list_filter(lines, lambda x: trim(x) = '' OR NOT list_contains(coalesce(keys, []), trim(x))) AS kept FROM d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS text_sha256, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text FROM k
"""

_OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
lens AS (SELECT r, doc_id, len(ws)::BIGINT AS n FROM d WHERE len(ws) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lens),
tfs AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY 1, 2),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY 1),
b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark),
q AS (SELECT i, item_id, term, count(*)::BIGINT AS reps FROM (SELECT i, item_id, unnest(ws) AS term FROM b) GROUP BY 1, 2, 3),
w AS (SELECT term, df, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM dfs, total),
s AS (SELECT i, item_id, r, doc_id, sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score FROM q JOIN w USING (term) JOIN tfs USING (term) JOIN lens USING (r), total GROUP BY 1, 2, 3, 4)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontaminate": _OP4, "op8_chat": _OP8, "op10_line_dedup": _OP10, "op11_ranked_search": _OP11}
