"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

import corpus_pipeline

_SPACE = "[\\x20\\x09-\\x0D]+"

_OP5 = f"""
WITH words AS (
  SELECT item_id AS id, 'item' AS kind,
         list_filter(regexp_split_to_array(lower(text), '{_SPACE}'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
  UNION ALL
  SELECT doc_id, 'document',
         list_filter(regexp_split_to_array(lower(text), '{_SPACE}'), lambda x: x <> '')
  FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
shingles AS (
  SELECT DISTINCT id, kind, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) >= 1),
items AS (SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 'item')
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n) AS n_shingles,
       count(*) / any_value(n) AS containment
FROM shingles d JOIN items i USING (s) WHERE d.kind = 'document'
GROUP BY d.id, i.id HAVING count(*) >= any_value(n) * 0.8 - 1e-9
"""

_CONTROL = r"([<\[])(\\*)(s>|/s>|INST\]|/INST\])"

_OP10 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, length(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g')) AS role_chars,
         length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g')) AS text_chars,
         role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text)
           AS begins
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + 7 + CASE WHEN begins THEN role_chars + 13 ELSE 0 END) AS BIGINT)
         AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_OP11 = """
WITH clean AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM clean a JOIN clean r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
            AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def _seats(parts: str, group: str, part: str, weight: str) -> str:
    """Seats by highest quotients: all of them ranked, as many for each part as its weight
    may get and some more."""
    return f"""
  SELECT {group}, {part}, count(*) AS quota FROM (
    SELECT {group}, {part}, seats, row_number() OVER (
             PARTITION BY {group} ORDER BY {weight} / (2 * seat + 1) DESC, {part}, seat) AS place
    FROM (SELECT *, unnest(range(CAST({weight} * seats / total AS BIGINT) + parts + 2)) AS seat
          FROM (SELECT *, CAST(sum({weight}) OVER (PARTITION BY {group}) AS DOUBLE) AS total,
                       count(*) OVER (PARTITION BY {group}) AS parts FROM {parts})
          WHERE total > 0))
  WHERE place <= seats GROUP BY {group}, {part}"""


def _md5_number(text: str) -> str:
    return f"CAST('0x' || md5({text})[1:8] AS BIGINT)"


_OP13 = f"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS number
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(number - 1) % 3 + 1] AS weight, 2 * source_size AS cap,
         1.5 * sum(source_size) OVER () AS mixed, sum(weight) OVER () AS weights
  FROM sources),
filled AS (
  SELECT *, coalesce(sum(cap) OVER earlier, 0) AS caps,
         cap * (weights - coalesce(sum(weight) OVER earlier, 0)) <= (mixed - caps) * weight AS is_full
  FROM weighed
  WINDOW earlier AS (ORDER BY cap / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, number, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE
           CAST(mixed - coalesce(sum(cap) FILTER (is_full) OVER (), 0) AS DOUBLE)
           / (weights - coalesce(sum(weight) FILTER (is_full) OVER (), 0)) * weight END AS target,
         1 AS everything, CAST(floor(mixed / 16 + 0.5) AS BIGINT) AS seats
  FROM filled),
of_source AS ({_seats("goals", "everything", "number", "target")}),
quotas AS (
  SELECT g.source, g.number, g.source_size, g.target,
         CAST(least(coalesce(s.quota, 0), floor(2 * g.source_size / 16)) AS BIGINT) AS seats
  FROM goals g LEFT JOIN of_source s USING (number)),
pieces AS (
  SELECT e.*, q.number, q.seats, least(32768, size * copies - piece * 32768) AS words,
         {_md5_number("concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), size, piece)")}
         % ((source_size + 32767) // 32768) AS shard
  FROM (SELECT *, unnest(range((size * copies - 1) // 32768 + 1)) AS piece
        FROM (SELECT source, doc_id, size, count(*) AS copies FROM sized WHERE size > 0
              GROUP BY ALL)) e
  JOIN quotas q ON q.source IS NOT DISTINCT FROM e.source),
placed AS (
  SELECT *, sum(words) OVER (PARTITION BY number, shard ORDER BY doc_id NULLS FIRST, size, piece)
            - words AS start,
         CAST(sum(words) OVER (PARTITION BY number, shard) AS BIGINT) AS shard_size
  FROM pieces),
shards AS (
  SELECT number, shard, any_value(shard_size) AS shard_size, any_value(seats) AS seats
  FROM placed GROUP BY number, shard),
of_shard AS ({_seats("shards", "number", "shard", "shard_size")}),
blocks AS (
  SELECT number, shard, j, row_number() OVER (
           PARTITION BY number, shard ORDER BY md5(concat_ws(':', 13, number, shard, j))) AS place
  FROM (SELECT *, unnest(range(2 * shard_size // 16)) AS j FROM shards)),
chosen AS (
  SELECT b.number, b.shard, b.j * 16 AS first, (b.j + 1) * 16 AS last
  FROM blocks b JOIN of_shard s USING (number, shard) WHERE b.place <= s.quota),
covered AS (
  SELECT source, doc_id, size, any_value(copies) AS copies, sum(greatest(0,
           least(last, p * shard_size + start + words) - greatest(first, p * shard_size + start)))
           AS taken
  FROM placed JOIN chosen USING (number, shard), (VALUES (0), (1)) passes(p)
  GROUP BY source, doc_id, size)
SELECT d.doc_id, d.source, d.size, q.source_size, q.target,
       CAST(coalesce(floor(c.taken / c.copies + 0.5), 0) AS BIGINT) AS taken
FROM sized d
JOIN quotas q ON q.source IS NOT DISTINCT FROM d.source
LEFT JOIN covered c ON c.source IS NOT DISTINCT FROM d.source
  AND c.doc_id IS NOT DISTINCT FROM d.doc_id AND c.size = d.size
"""


def oracle_sql() -> dict[str, str]:
    found = {"op5_decontamination": _OP5, "op10_chat_format": _OP10,
             "op11_hard_negatives": _OP11, "op13_source_mix": _OP13}
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
