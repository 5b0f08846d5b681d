"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

from cohortlens.llm import collocations, decontamination, mixing, secrets
from cohortlens.llm.common import WORD

_WEIGHTS = ", ".join(map(str, mixing.WEIGHTS))

OP4 = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{_WEIGHTS}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, ({mixing.SHARE}::DOUBLE * (sum(source_size) OVER ())::BIGINT - {mixing.MOST_EPOCHS} * coalesce(sum(source_size) OVER filled, 0)::BIGINT)
            / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER filled, 0)::BIGINT) AS level
  FROM sources
  WINDOW filled AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(({mixing.MOST_EPOCHS} * source_size)::DOUBLE, (max(level) OVER ()) * weight) AS target FROM levels
), budgets AS (
  SELECT *, floor(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM targets
), placed AS (
  SELECT s.*, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS room,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, (epochs * size + least(size, greatest(0, room - before)))::BIGINT AS taken FROM placed
"""


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(kind: str, pattern: str) -> str:
    p = _literal(pattern)
    return f"""
  SELECT row, {secrets.KINDS.index(kind)} AS rank, '{kind}' AS kind, unnest(list_zip(
      list_transform(range(len(m)), lambda i: list_sum(list_transform(p[1:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0)),
      m)) AS s
  FROM (SELECT row, regexp_extract_all(text, {p}) AS m, string_split_regex(text, {p}) AS p FROM texts WHERE regexp_matches(text, {p}))"""


OP2 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, source, lang FROM documents
), raw AS (
{' UNION ALL '.join(_spans(k, p) for k, p in zip(secrets.KINDS, (secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.FORMAT, secrets.BARE)))}
), every AS (
  SELECT row, rank, kind, s[1]::BIGINT AS start, (s[1] + length(s[2]))::BIGINT AS stop,
         CASE WHEN rank = 0 THEN regexp_extract(s[2], {_literal(secrets.ASSIGN)}, 2) ELSE s[2] END AS value FROM raw
), valid AS (
  SELECT * FROM every WHERE (rank > 0 OR length(value) >= {secrets.LEAST_ASSIGNED}) AND (rank < 4 OR regexp_matches(value, '[0-9]'))
), base AS (SELECT * FROM valid WHERE rank < 3
), formats AS (
  SELECT * FROM valid v WHERE rank = 3 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row = v.row AND b.start < v.stop AND v.start < b.stop)
), context AS (SELECT * FROM base UNION ALL SELECT * FROM formats
), bare AS (
  SELECT * FROM valid v WHERE rank = 4 AND NOT EXISTS (SELECT 1 FROM context b WHERE b.row = v.row AND b.start < v.stop AND v.start < b.stop)
), found AS (
  SELECT *, sha256(value) AS hash,
         len(list_distinct(regexp_extract_all(value, '(?s).'))) >= {secrets.LEAST_DIFFERENT}
         AND NOT regexp_matches(value, {_literal(secrets.PLACEHOLDER)}) AS random
  FROM (SELECT * FROM context UNION ALL SELECT * FROM bare)
), owners AS (
  SELECT hash, bool_or(rank < 4) AND bool_or(random) AND count(DISTINCT coalesce('=' || source, '')) < {secrets.COPIED_OWNERS} AS live
  FROM found JOIN texts USING (row) GROUP BY hash
), reported AS (
  SELECT f.*, o.live, kind || ':' || start || ':' || stop AS said FROM found f JOIN owners o USING (hash) WHERE rank < 3 OR live
), per AS (
  SELECT row, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
         string_agg(said, ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base,
         string_agg(said, ',' ORDER BY start, rank, stop) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM reported GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM texts LEFT JOIN per USING (row)
"""

OP5 = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id))::INTEGER AS rank, vec_id, score FROM pairs
)
SELECT * FROM ranked WHERE rank <= 10
"""

# Base 32 of a SHA-1: 40 hexadecimal digits are 32 groups of 5 bits, 4 groups from every 5 digits.
OP9 = """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), digests AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex, (i // 4)::INTEGER * 5 + 1, 5))::BIGINT >> ((3 - i % 4) * 5)::INTEGER) & 31) + 1)::INTEGER, 1)), '') AS payload_digest
  FROM hashed
), kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM kept
"""

_WORDS_11 = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce({_WORDS_11}, []) AS w FROM documents
), items AS (SELECT item_id, w, least({decontamination.WINDOW}, len(w)) AS size FROM (SELECT item_id, {_WORDS_11} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS held
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM items)
), places AS (
  SELECT row, p, size, array_to_string(w[p:p + size - 1], ' ') AS held
  FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), met AS (SELECT * FROM places WHERE held IN (SELECT held FROM windows)
), hit AS (SELECT row, count(DISTINCT p + shift) AS n_hit FROM (SELECT row, p, unnest(range(size)) AS shift FROM met) GROUP BY row
), found AS (
  SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS said
  FROM (SELECT DISTINCT row, held FROM met) JOIN windows USING (held) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN found USING (row)
"""

OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, array_to_string(w[p:p + size - 1], ' ') AS phrase, size, count(*) AS f
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM (SELECT *, unnest(range(1, {collocations.LONGEST + 1})) AS size FROM split) WHERE len(w) >= size)
  GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang
), candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE size > 1 AND f >= {collocations.LEAST_COUNT}
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, {collocations.SCALE}::HUGEINT * c.a // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[p:p + part - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - part + 2)) AS p FROM (SELECT *, unnest(range(2, size)) AS part FROM candidates))
  GROUP BY ALL
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score::BIGINT AS score
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE 100 * coalesce(longer, 0) < {collocations.CONTAINED} * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.BEST}
"""

ORACLE: dict[str, str] = {"op2_secrets": OP2, "op4_mix": OP4, "op5_neighbours": OP5, "op9_warc": OP9, "op11_suffix_arrays": OP11, "op13_collocations": OP13}
