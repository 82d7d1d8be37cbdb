"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelab.llm import chat, embedding_dedup, line_dedup, mixing, packing, phrases, quality, runs, secrets, sharding, simhash, topk, wrapper


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.EVERY == 0)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return placed.select("row.doc_id", "slot", "shard")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(_table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(runs.with_repeats(_table(spark, sf_dir, "documents"))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.windows(chat.with_marks(_table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_secrets": op2_secrets,
    "op3_topk": op3_topk,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_sharding": op6_sharding,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_quality": op8_quality,
    "op9_simhash": op9_simhash,
    "op10_extraction": op10_extraction,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_collocations": op12_collocations,
    "op13_chat": op13_chat,
}

ORACLE = {
    "op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, row_no, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line FROM (
    SELECT doc_id, row_number() OVER () AS row_no, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3
), judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.last AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row_no""",
    "op3_topk": r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10""",
    "op4_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) AS n
  FROM sized GROUP BY source
), rooms AS (
  SELECT *, [5, 2, 1][(n - 1) % 3 + 1] AS w, 3 * s AS cap, (3 * s)::DOUBLE / [5, 2, 1][(n - 1) % 3 + 1] AS room FROM sources
), filled AS (
  SELECT *, (sum(s) OVER () - coalesce(sum(cap) OVER up, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER up, 0)) AS level
  FROM rooms WINDOW up AS (ORDER BY room, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, max(level) FILTER (WHERE room > level) OVER () AS fill FROM filled
), targets AS (
  SELECT source, s, CASE WHEN fill IS NULL OR room <= fill THEN cap::DOUBLE ELSE fill * w END AS target FROM levels
), budgets AS (
  SELECT *, round(target)::BIGINT AS b, CASE WHEN s > 0 THEN round(target)::BIGINT // s ELSE 0 END AS e FROM targets
), placed AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d
)
SELECT p.doc_id, p.size, b.s AS source_size, b.target,
  (b.e * p.size + greatest(0, least(p.size, b.b - b.e * b.s - p.before)))::BIGINT AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source""",
    # The table itself is filled in turns and tested by brute force; SQL checks every document's slot and shard.
    "op6_sharding": f"""
SELECT doc_id, slot, 'shard-' || lpad(string_split('{",".join(map(str, sharding.lookup_table()))}', ',')[slot + 1], 3, '0') AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS} AS slot FROM documents)""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM listed GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed
), grams AS (
  SELECT lang, w, i, unnest(range(1, 6)) AS k FROM starts
), counts AS (
  SELECT lang, k, w[i:i + k - 1] AS p, count(*)::HUGEINT AS f FROM grams WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, k, p, f, unnest(range(1, k)) AS cut FROM counts WHERE k > 1
), scores AS (
  SELECT c.lang, c.k, c.p, c.f, c.cut, x.f AS l, y.f AS r, n, (1000 * c.f * n) // (x.f * y.f) AS score FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts x ON x.lang = c.lang AND x.p = c.p[:c.cut] JOIN counts y ON y.lang = c.lang AND y.p = c.p[c.cut + 1:]
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), held AS (
  SELECT lang, k, p[s:e] AS p, max(f) AS f FROM (
    SELECT lang, k, p, f, s, unnest(range(s + 1, k + 1)) AS e FROM (SELECT *, unnest(range(1, k)) AS s FROM counts WHERE k > 2))
  WHERE e - s + 1 < k GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = b.lang AND h.p = b.p AND 100 * h.f >= 100 * b.f)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase,
  f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM kept QUALIFY rank <= 2000""",
    "op13_chat": rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
  SELECT *, coalesce(turn, -9223372036854775808) AS t, CASE WHEN turn IS NULL THEN -36028797018963968 ELSE floor(turn / 256)::BIGINT END AS part,
    role <> 'system' AS later FROM given
), digests AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY t, later, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY t, later, role, text) FILTER (WHERE role = 'assistant'), '') AS loss FROM turns GROUP BY conv_id
), firsts AS (
  SELECT conv_id, min(t) AS t, min(part) AS part FROM turns GROUP BY conv_id
), systems AS (
  SELECT u.conv_id, min(u.text) AS text FROM turns u JOIN firsts f ON u.conv_id IS NOT DISTINCT FROM f.conv_id AND u.t = f.t WHERE u.role = 'system' GROUP BY ALL
), every AS (
  SELECT conv_id, part, 2 AS kind, t, later, role, text FROM turns
  UNION ALL SELECT conv_id, part + 1, 1, t, later, role, text FROM turns WHERE turn - 256 * part >= 256 - {chat.PAST}
  UNION ALL SELECT DISTINCT u.conv_id, u.part, 0, 0, false, 'system', s.text FROM turns u JOIN firsts f ON u.conv_id IS NOT DISTINCT FROM f.conv_id
    LEFT JOIN systems s ON u.conv_id IS NOT DISTINCT FROM s.conv_id WHERE u.part > f.part
), shaped AS (
  SELECT *, 4 + (strlen(text) + 3) // 4 AS tokens, {len(chat.OPEN + chat.SAYS + chat.CLOSE) + 1} + length(role) + length(text)
    + len(regexp_extract_all(role, '<\\*(?:turn>|says>|/turn>)')) + len(regexp_extract_all(text, '<\\*(?:turn>|says>|/turn>)')) AS chars FROM every
), parts AS (
  SELECT conv_id, part, list({{'kind': kind, 'role': role, 'text': text, 'tokens': tokens, 'chars': chars}} ORDER BY kind, t, later, role, text) AS a
  FROM shaped GROUP BY conv_id, part HAVING max(kind) = 2
), led AS (
  SELECT *, a[1].kind = 0 OR (a[1].kind = 2 AND a[1].role = 'system') AS leads FROM parts
), split AS (
  SELECT conv_id, part, CASE WHEN leads AND a[1].text IS NOT NULL THEN a[1].tokens ELSE 0 END AS system_tokens,
    CASE WHEN leads AND a[1].text IS NOT NULL THEN a[1].chars ELSE 0 END AS system_chars, CASE WHEN leads THEN a[2:] ELSE a END AS turns FROM led
), summed AS (
  SELECT *, len(turns) AS m, len(list_filter(turns, lambda x: x.kind = 1)) AS n_past, {chat.BUDGET} - system_tokens AS free,
    list_transform(range(0, len(turns) + 1), lambda i: coalesce(list_sum(list_transform(turns[1:i], lambda x: x.tokens)), 0)) AS sums FROM split
), walk AS (
  SELECT *, n_past AS first, NULL::BIGINT AS past, NULL::BIGINT AS stop FROM summed
  UNION ALL
  SELECT * EXCLUDE (first, past, stop, wide), first, past, least(m, greatest(first + 1, len(list_filter(sums, lambda s: s - sums[past + 1] <= free)) - 1)) FROM (
    SELECT * EXCLUDE (past), CASE WHEN sums[first + 2] - sums[wide + 1] > free THEN first ELSE wide END AS past FROM (
      SELECT *, len(list_filter(sums, lambda s: sums[first + 1] - s > {chat.HISTORY})) AS wide FROM (
        SELECT * REPLACE (coalesce(stop, first) AS first) FROM walk WHERE stop IS NULL OR stop < m)) ) x
), chars AS (
  SELECT conv_id, sum(system_chars + coalesce(list_sum(list_transform(turns[past + 1:stop], lambda x: x.chars)), 0))::BIGINT AS formatted_chars
  FROM walk WHERE stop IS NOT NULL GROUP BY conv_id
)
SELECT d.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM digests d JOIN chars c ON d.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
