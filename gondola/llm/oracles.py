"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from gondola.llm import embedding_join, mixing, quality, secret_scan

_WORD = r"[^\x20\x09-\x0D]+"

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT source, source_size, 3 * source_size AS stop,
  (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources),
lined AS (SELECT *, sum(stop) OVER w - stop AS stopped, sum(weight) OVER () - (sum(weight) OVER w - weight) AS rest,
  sum(source_size) OVER () AS total FROM ranked
  WINDOW w AS (ORDER BY stop / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT arg_min(CAST(total - stopped AS DOUBLE) / CAST(rest AS DOUBLE), stopped) AS level FROM lined
  WHERE weight * (CAST(total - stopped AS DOUBLE) / CAST(rest AS DOUBLE)) <= stop),
targets AS (SELECT source, source_size, least(weight * coalesce(level, 0), CAST(stop AS DOUBLE)) AS target FROM ranked, filled),
rated AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  CAST('0x' || substr(md5('{mixing.SEED}' || chr(31) || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  CAST((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM rated
"""


# CRC-32 with its table of 256, byte by byte; the shards are those of the bytes below a row's key.
SHARDS = """
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc),
h AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS digits FROM documents),
d AS (SELECT doc_id, size, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(digits, lambda x: CAST('0x' || x AS BIGINT))),
  lambda a, x: xor(a >> 8, t.crc[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32 FROM h, t),
b AS (SELECT *, sum(size) OVER (ORDER BY text_crc32, doc_id NULLS FIRST RANGE UNBOUNDED PRECEDING) - sum(size) OVER (PARTITION BY text_crc32, doc_id) AS below, sum(size) OVER () AS total FROM d),
s AS (SELECT *, CAST(8 * below // total AS INTEGER) AS shard FROM b)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY text_crc32, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""


def _spans(rank: int) -> str:
    """Matches of one kind with their positions: all pieces and matches before, then the match."""
    kind, pattern, group, least, base = secret_scan.KINDS[rank]
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, {rank} AS rank, '{kind}' AS kind, {str(base).lower()} AS base, value,
  CAST(sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit) AS BIGINT) AS s, CAST(sum(length(gap)) OVER w + sum(length(hit)) OVER w AS BIGINT) AS e, length(value) >= {least} AS good
  FROM (SELECT doc_id, source, unnest(regexp_extract_all(text, '{p}', 0)) AS hit, unnest(regexp_extract_all(text, '{p}', {group})) AS value,
    unnest(list_slice(string_split_regex(text, '{p}'), 1, -2)) AS gap, generate_subscripts(regexp_extract_all(text, '{p}', 0), 1) AS i FROM documents WHERE regexp_matches(text, '{p}'))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)"""


SECRETS = f"""
WITH found AS ({" UNION ALL ".join(f"({_spans(k)})" for k in range(len(secret_scan.KINDS)))}),
good AS (SELECT * FROM found WHERE good),
held AS (SELECT sha256(value) AS h, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT doc_id) + CAST(count(*) > count(doc_id) AS INTEGER) AS repositories FROM good GROUP BY 1),
judged AS (SELECT good.*, owners, repositories, CASE WHEN owners >= {secret_scan.EXAMPLE_OWNERS} AND repositories >= {secret_scan.EXAMPLE_REPOSITORIES} THEN 'example' WHEN base OR (len(list_distinct(string_split(value, ''))) >= {secret_scan.LIVE_CHARS}
  AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')) THEN 'credential' ELSE 'unsure' END AS verdict FROM good JOIN held ON h = sha256(value)),
kept AS (SELECT * FROM judged j WHERE base OR (verdict = 'credential' AND NOT EXISTS (SELECT 1 FROM judged b WHERE b.base AND b.doc_id = j.doc_id AND b.s < j.e AND j.s < b.e))),
by_doc AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  coalesce(string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, rank) FILTER (base), '') AS b, string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, rank) AS spans,
  string_agg(verdict, ',' ORDER BY s, rank) AS verdicts, string_agg(owners, ',' ORDER BY s, rank) AS owners, string_agg(repositories, ',' ORDER BY s, rank) AS repositories FROM kept GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(verdicts, '') AS verdicts, coalesce(owners, '') AS owners, coalesce(repositories, '') AS repositories
FROM documents d LEFT JOIN by_doc ON by_doc.doc_id = d.doc_id
"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= {embedding_join.COSINE}),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.r),
top AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY 1),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY 1)
SELECT top.vec_id, coalesce(n_links, 0) AS n_links, component_id, top.vec_id = component_id AS kept FROM top LEFT JOIN n ON n.a = top.vec_id
"""

_GROUPS = [f"CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT)" for k in range(8)]
_DIGITS = [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST({g} // {32**p} % 32 + 1 AS INTEGER), 1)" for g in _GROUPS for p in (3, 2, 1, 0)]
ARCHIVES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages), k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM p)
SELECT page_id, CAST(strlen(x) AS BIGINT) AS payload_bytes, concat({", ".join(_DIGITS)}) AS payload_digest,
  CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN keeper IS NULL OR page_id = keeper THEN NULL ELSE keeper END AS refers_to FROM k
"""

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
_BOUNDS = " AND ".join(
    f"{metric} {op} {bound}" for metric, low, high in quality.THRESHOLDS for op, bound in ((">=", low), ("<=", high)) if bound is not None
)
QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT doc_id, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL THEN concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) END AS g FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1 AS twice FROM g),
c AS (SELECT doc_id, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM r),
n AS (SELECT doc_id, count(*) FILTER (covered) AS n_repeat_words FROM c GROUP BY 1),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
  len(list_filter(ws, lambda x: list_contains([{_STOPS}], lower(x)))) + 1 AS stops, len(regexp_extract_all(text, '![\\x20\\x09-\\x0D]')) AS shouts, len(regexp_extract_all(array_to_string(ws, ''), '\\p{{Lu}}')) AS uppers
  FROM d LEFT JOIN n ON n.doc_id = d.doc_id),
q AS (SELECT *, coalesce(CAST(word_chars AS DOUBLE) / nullif(n_words, 0), 0) AS mean_word_chars, coalesce(CAST(n_symbols AS DOUBLE) / nullif(n_words, 0), 0) AS symbol_word_ratio, coalesce(CAST(stops AS DOUBLE) / nullif(n_words, 0), 0) AS stop_word_ratio,
  coalesce(CAST(shouts AS DOUBLE) / nullif(n_words, 0), 0) AS exclamation_word_ratio, coalesce(CAST(n_repeat_words AS DOUBLE) / nullif(n_words, 0), 0) AS repeat_word_ratio, coalesce(CAST(n_dup_lines AS DOUBLE) / nullif(n_lines, 0), 0) AS duplicate_line_ratio,
  coalesce(CAST(uppers AS DOUBLE) / nullif(word_chars, 0), 0) AS upper_ratio, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_BOUNDS} AS kept FROM q
"""


# Prefixes are compared by the hash of all their turns; CRC-32 as above.
TRIE = """
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc),
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS n,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(CAST(conv_id AS VARCHAR), '.'), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, x: xor(a >> 8, any_value(t.crc)[(xor(a, x) & 255) + 1])), 4294967295) % 6 AS h
  FROM turns, t GROUP BY conv_id),
sized AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS lent, least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) AS length FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT c.conv_id, pos + 1 AS depth, role, text, length FROM sized c JOIN turns ON turns.conv_id = c.base AND pos < h
  UNION ALL SELECT c.conv_id, lent + pos - h + 1, role, text, length FROM sized c JOIN turns ON turns.conv_id = c.conv_id AND pos >= h),
hashed AS (SELECT conv_id, depth, length, length(text) AS n_chars, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS key FROM rebuilt),
paths AS (
  SELECT conv_id, depth, length, n_chars, key, coalesce(lag(key) OVER (PARTITION BY conv_id ORDER BY depth), 'root') AS before FROM hashed
  UNION ALL SELECT conv_id, 0, length, 0, 'root', NULL FROM sized),
nodes AS (SELECT depth, key, before, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n_chars) AS saved,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256 FROM paths GROUP BY depth, key, before),
families AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.before = n.key) AS n_children FROM nodes n LEFT JOIN nodes p ON p.key = n.before),
sums AS (SELECT p.key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens FROM families f JOIN paths p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.key)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM families JOIN sums ON families.key = sums.key
"""
