"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

OP1 = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5('mix:' || doc_id), 1, 8))::BIGINT AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
    FROM sources
), ranked AS (
    SELECT *, 2.0::DOUBLE * size / weight AS bar, (SELECT sum(size) * 1.5::DOUBLE FROM sources) AS wanted,
           coalesce(sum(2 * size) OVER before, 0) AS full_before,
           sum(weight) OVER (ORDER BY 2.0::DOUBLE * size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_on
    FROM weighed
    WINDOW before AS (ORDER BY 2.0::DOUBLE * size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT arg_min((wanted - full_before) / weight_on, bar) FILTER (WHERE (wanted - full_before) / weight_on <= bar) AS level
    FROM ranked
), targets AS (
    SELECT source, size AS source_size, least(2.0::DOUBLE * size, coalesce(level, 1e300) * weight) AS target
    FROM weighed, level
), ordered AS (
    SELECT s.*, t.source_size, t.target,
           CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY place, doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ran
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
    SELECT *, whole + (2 * ran + size <= 2 * (target - whole * source_size))::BIGINT AS copies FROM ordered
)
SELECT doc_id, size, source_size, target, size * copies AS taken FROM taken
"""

OP4 = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), escaped AS (
    SELECT *, length(text) + length(role)
              + len(regexp_extract_all(text || role, '[\\<\[]')) + length('<s>[TEXT]</s>') AS chars
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

OP3 = r"""
WITH item_words AS (
    SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS m,
           unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS key
    FROM item_words WHERE len(w) > 0
), doc_words AS (
    SELECT doc_id, row_number() OVER () AS r,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), places AS (
    SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc_words, (SELECT DISTINCT m FROM windows)
), hits AS (
    SELECT p.r, p.i, p.m, x.item_id FROM places p JOIN windows x ON p.m = x.m AND array_to_string(p.w[p.i:p.i + p.m - 1], ' ') = x.key
), hit_words AS (
    SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS word FROM hits) GROUP BY r
), hit_items AS (
    SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

OP10 = r"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

OP5 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s
    FROM words WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
), reach AS (
    SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), least_of AS (
    SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       doc_id <= coalesce(other, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""


def _personal(kind: str, pattern: str, valid: str, words: str = "") -> str:
    """Spans of one kind: hits in order, their ends being running sums of lengths."""
    near = f"regexp_matches(right(gap, 40) || ' ' || left(after, 20), '{words}')" if words else "true"
    return rf"""
SELECT r, '{kind}' AS kind, e - length(hit) AS s, e FROM (
    SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i)::BIGINT AS e,
           regexp_replace(hit, '[^0-9]', '', 'g') AS digits, replace(hit, ' ', '') AS code
    FROM (SELECT r, i, hits[i] AS hit, gaps[i] AS gap, gaps[i + 1] AS after
          FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS gaps FROM texts),
               unnest(range(1, len(hits) + 1)) AS u(i))
) WHERE {valid} AND {near}"""


_LUHN = """(length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN substr(reverse(digits), i, 1)::INT
         ELSE 2 * substr(reverse(digits), i, 1)::INT // 10 + 2 * substr(reverse(digits), i, 1)::INT % 10 END)) % 10 = 0)"""
_MOD97 = """(length(code) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(
    list_aggregate(list_transform(string_split(substr(code, 5) || left(code, 4), ''), lambda c:
        CASE WHEN c >= 'A' THEN (ord(c) - 55)::VARCHAR ELSE c END), 'string_agg', ''), ''), lambda d: d::INT)),
    lambda a, d: (a * 10 + d) % 97) = 1)"""

OP13 = (
    "WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), spans AS ("
    + "\nUNION ALL".join(
        (
            _personal("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
            _personal("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_max(list_transform(string_split(hit, '.'), lambda p: p::DOUBLE)) <= 255"),
            _personal("card", r"[0-9](?:[\x20-]?[0-9])+", _LUHN),
            _personal("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15"),
            _personal("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", "NOT regexp_matches(right(gap, 1) || ' ' || left(after, 1), '[A-Za-z0-9]') AND " + _MOD97),
            _personal(
                "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
                "NOT regexp_matches(hit, '^(?:000|666|9)|-00-|-0000$') AND NOT regexp_matches(right(gap, 1) || ' ' || left(after, 1), '[0-9A-Za-z-]')",
                "(?i)ssn|social.?security|tax.?id",
            ),
            _personal(
                "tel", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
                r"NOT regexp_matches(right(gap, 6), '[0-9.(-]$|\+[0-9]{1,3}\x20?$') AND NOT regexp_matches(left(after, 2), '^(?:[0-9]|[.-][0-9])')",
                "(?i)call|phone|tel|mobil|fax|whatsapp",
            ),
            _personal(
                "secret", r"[A-Za-z0-9+/_-]{20,}", "regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')",
                "(?i)token|secret|passw|api.?key|bearer|credential",
            ),
        )
    )
    + """
), listed AS (
    SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY list_position(ranks, kind), s) AS spans,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY list_position(ranks, kind), s) FILTER (list_position(ranks, kind) <= 4) AS base,
           count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
           count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone
    FROM spans, (SELECT ['email', 'ip', 'card', 'phone', 'iban', 'ssn', 'tel', 'secret'] AS ranks) GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (r)
"""
)


def _plus(value: str, cost: str, letter: str) -> str:
    """A cost and an audit as one sortable text, an edit further."""
    return f"(format('{{:012d}}', left({value}, 12)::BIGINT + {cost}) || substr({value}, 13) || '{letter}')"


_OPENED = f"least(s2, {_plus('s0', '3', 'I')}, {_plus('s1', '3', 'I')}, {_plus('s3', '3', 'I')})"
_PAIRED = f"least(s3, {_plus('s2', '3', 'I')})"

# the repair as a walk over the turns: s0 to s3 are the best ways to each state
OP11 = f"""
WITH RECURSIVE crc_steps AS (
    SELECT i, 0 AS k, i AS c FROM range(256) AS t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY i) AS tab FROM crc_steps WHERE k = 8
), hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                                        lambda x: ord(x)::BIGINT)),
        lambda a, b: xor(tab[(xor(a, b) & 255) + 1], a >> 8))) % 20 AS fault
    FROM conversations, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hashed, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) WHERE fault <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
           regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS shown
    FROM damaged
), judged AS (
    SELECT *, left(role, 1) AS initial, CASE WHEN shown = '' THEN 'blank'
           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
           WHEN shown NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM ordered
), turns AS (
    SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra FROM judged
), walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM turns
    UNION ALL
    SELECT w.conv_id, t.i, {_plus('s0', '4', 'D')},
           least({_plus('s1', '4', 'D')}, CASE WHEN NOT gone AND initial = 's' THEN {_plus('s0', 'extra', 'K')} END),
           least({_plus('s2', '4', 'D')}, CASE WHEN NOT gone AND initial = 'u' THEN {_plus('least(s0, s1, s3)', 'extra', 'K')} END,
                 CASE WHEN NOT gone THEN {_plus('least(s0, s1, s3)', '3 + extra', 'R')} END),
           least({_plus('s3', '4', 'D')}, CASE WHEN NOT gone AND initial = 'a' THEN {_plus('s2', 'extra', 'K')} END,
                 CASE WHEN NOT gone THEN {_plus('s2', '3 + extra', 'R')} END)
    FROM (SELECT conv_id, i, s0, s1, s2, {_PAIRED} AS s3 FROM (SELECT conv_id, i, s0, s1, s3, {_OPENED} AS s2 FROM walk)) w
    JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
), last AS (
    SELECT conv_id, s0, {_OPENED} AS s2, s3 FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), found AS (
    SELECT conv_id, least(s0, {_PAIRED}) AS best FROM last
), letters AS (
    SELECT conv_id, l, substr(best, 12 + l, 1) AS letter FROM found, unnest(range(1, length(best) - 11)) AS u(l)
), edits AS (
    SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY l) AS i FROM letters
), kept AS (
    SELECT e.conv_id, l, letter, t.role, t.text,
           count(*) FILTER (NOT (letter = 'K' AND t.initial = 's')) OVER (PARTITION BY e.conv_id ORDER BY l) AS pos
    FROM edits e LEFT JOIN turns t ON e.letter <> 'I' AND t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.i = e.i
    WHERE letter <> 'D'
), told AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN pos % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY l) AS told
    FROM kept GROUP BY conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(best, 12)::BIGINT, 0) AS cost,
       coalesce(substr(best, 13), '') AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP12 = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
    FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
