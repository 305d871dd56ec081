"""SQL counterparts of the registered queries, for DuckDB."""

OP5 = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS tie FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, 1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM sources
), weighed AS (
  SELECT *, CAST([3, 1, 2][place % 3 + 1] AS DOUBLE) AS weight, 2 * CAST(source_size AS DOUBLE) AS most FROM ranked
), filled AS (
  SELECT *, most / weight AS ratio,
    coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared
  FROM weighed
), level AS (
  SELECT (total - before) / shared AS level FROM filled WHERE most * shared > (total - before) * weight ORDER BY ratio, place LIMIT 1
), targets AS (
  SELECT source, source_size, least(most, coalesce(weight * (SELECT level FROM level), most)) AS target FROM filled
), played AS (
  SELECT s.*, t.source_size, t.target,
    sum(size) OVER (PARTITION BY s.source ORDER BY md5(concat('0:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', tie)), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS played,
    row_number() OVER () AS id
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), queue AS (
  SELECT id, size, (played + r * source_size) / target AS finish FROM played, (VALUES (0), (1)) AS rounds(r) WHERE size > 0 AND target > 0
), summed AS (
  SELECT id, sum(size) OVER (ORDER BY finish) AS total FROM queue
), taken AS (
  SELECT id, count(*) AS times FROM summed WHERE total <= 1.5 * (SELECT sum(size) FROM sizes) GROUP BY id
)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(times, 0) AS BIGINT) AS taken FROM played LEFT JOIN taken USING (id)
"""

OP7 = r"""
WITH every AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(\||/?s>|/?SYS)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS safe FROM every
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>') + length(role) + 1 + length(safe) + length('<|end|>') + 1) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

OP10 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), windows AS (
  SELECT doc_id, pos, line, lead(line) OVER w AS second, lead(line, 2) OVER w AS third
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, pos) AS n
    FROM windows WHERE third IS NOT NULL AND NOT (trim(line) = '' AND trim(second) = '' AND trim(third) = '')
  ) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, pos + j AS pos FROM later, (VALUES (0), (1), (2)) AS steps(j)
), stay AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(s.text, '') END AS text,
  CAST(len(string_split(d.text, chr(10))) AS INTEGER) AS n_lines
FROM documents d LEFT JOIN stay s USING (doc_id)
"""

ORACLES = {"op5_mix": OP5, "op7_chats": OP7, "op10_line_dedup": OP10}
