"""DuckDB SQL that must give the same rows as the queries of its name."""

SHARDING = """
WITH RECURSIVE shards AS (
    SELECT i AS id,
           ('0x' || substr(md5('offset shard-' || lpad(i::VARCHAR, 2, '0')), 1, 8))::BIGINT % 4099 AS o,
           1 + ('0x' || substr(md5('step shard-' || lpad(i::VARCHAR, 2, '0')), 1, 8))::BIGINT % 4098 AS step
    FROM range(32) t(i)
), claims AS (
    SELECT 0::BIGINT AS turn, range(4099) AS free, NULL::BIGINT AS slot
    UNION ALL
    SELECT turn + 1, list_filter(free, lambda x: x <> best), best
    FROM (
        SELECT turn, free,
               list_min(list_transform(free, lambda x: ((x - o) * step % 4099 + 4099) % 4099 * 4099 + x)) % 4099 AS best
        FROM claims JOIN shards ON id = turn % 32
        WHERE turn < 4099
    )
), held AS (
    SELECT slot, 'shard-' || lpad(((turn - 1) % 32)::VARCHAR, 2, '0') AS shard FROM claims WHERE slot IS NOT NULL
)
SELECT doc_id, slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 4099 AS slot FROM documents)
JOIN held USING (slot)
"""

CHAT = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
    SELECT *,
           length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|</?SYS>>)', '\1\\\2\3', 'g'))
           + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 5
             ELSE 20 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|</?SYS>>)', '\1\\\2\3', 'g')) END AS chars,
           row_number() OVER turn_order AS k,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM said WINDOW turn_order AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), upto AS (
    SELECT *, 3 + sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS total FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(total) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM upto GROUP BY conv_id
"""

EXACT = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# crc32 is eight shifts for each byte; the ways to each state are the least (cost, audit, turns), row by row.
REPAIR = r"""
WITH RECURSIVE hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce([4294967295::BIGINT] || list_transform(
                   string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
               lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS f
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
           CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE f <> 0
), placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
           right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final
    FROM damaged
), turns AS (
    SELECT *, CASE WHEN final = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           coalesce(initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY k) NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM placed
), inserts(st, added, more, dear, said) AS (
    VALUES (0, 0, '', 0, []::VARCHAR[]), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
           (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (3, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']),
           (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:'])
), arcs(letter, st, wanted, after, price, given) AS (
    VALUES ('D', 0, NULL, 0, 2, NULL), ('D', 1, NULL, 1, 2, NULL), ('D', 2, NULL, 2, 2, NULL), ('D', 3, NULL, 3, 2, NULL),
           ('K', 0, 's', 1, 0, NULL), ('K', 0, 'u', 2, 0, NULL), ('K', 1, 'u', 2, 0, NULL), ('K', 2, 'a', 3, 0, NULL), ('K', 3, 'u', 2, 0, NULL),
           ('R', 0, NULL, 2, 1, 'user'), ('R', 1, NULL, 2, 1, 'user'), ('R', 2, NULL, 3, 1, 'assistant'), ('R', 3, NULL, 2, 1, 'user')
), ways AS (
    SELECT conv_id, 0::BIGINT AS k, added AS st, {'cost': dear::BIGINT, 'audit': more, 'said': said} AS way
    FROM (SELECT DISTINCT conv_id FROM damaged), inserts WHERE inserts.st = 0
    UNION ALL
    SELECT conv_id, k, added, min({'cost': cost + dear, 'audit': audit || more, 'said': list_concat(turned, inserts.said)})
    FROM (
        SELECT w.conv_id, t.k, after, way.audit || letter AS audit,
               way.cost + price + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
               CASE letter WHEN 'D' THEN way.said ELSE list_append(way.said, coalesce(given, role) || ':' || text) END AS turned
        FROM ways w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.k = w.k + 1 JOIN arcs a ON a.st = w.st
        WHERE (wanted IS NULL OR wanted = initial) AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
    ) JOIN inserts ON inserts.st = after
    GROUP BY conv_id, k, added
), best AS (
    SELECT w.conv_id, min(way) AS way
    FROM ways w JOIN (SELECT conv_id, max(k) AS n FROM turns GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND w.k = n
    WHERE st IN (0, 3) GROUP BY w.conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (illegal) AS illegal
    FROM turns GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost,
       coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""
