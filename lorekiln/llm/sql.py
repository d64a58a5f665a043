"""DuckDB SQL of turn repair and of the license scan, written apart from the operators."""

from __future__ import annotations

from lorekiln.llm.licenses import TEMPLATES

#: Damage by CRC-32, bit by bit; then states and edits row by row, each state's best way kept.
REPAIR_SQL = r"""
    WITH RECURSIVE named AS (
        SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations
    ), hashed AS (
        SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, 8 * length(id)),
                lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr(id, CAST(i // 8 + 1 AS BIGINT), 1))::BIGINT ELSE 0::BIGINT END)),
            lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295::BIGINT) % 20 AS fault FROM named
    ), rows AS (
        SELECT c, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
            CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(0, CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed
    ), placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM rows),
    judged AS (
        SELECT *, left(role, 1) AS initial,
            CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
            lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before FROM placed
    ), inserts(q, ahead, p, lines) AS (VALUES
        (0, '', 0, []::VARCHAR[]), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']), (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']),
        (2, '', 2, []), (2, 'I', 3, ['assistant:']), (2, 'II', 2, ['assistant:', 'user:']), (3, '', 3, []), (3, 'I', 2, ['user:']), (3, 'II', 3, ['user:', 'assistant:'])
    ), edits(p, letter, initial, role, goal, price) AS (VALUES
        (0, 'D', NULL, NULL, 0, 4), (1, 'D', NULL, NULL, 1, 4), (2, 'D', NULL, NULL, 2, 4), (3, 'D', NULL, NULL, 3, 4),
        (0, 'K', 's', NULL, 1, 0), (0, 'K', 'u', NULL, 2, 0), (1, 'K', 'u', NULL, 2, 0), (3, 'K', 'u', NULL, 2, 0), (2, 'K', 'a', NULL, 3, 0),
        (0, 'R', NULL, 'user', 2, 3), (1, 'R', NULL, 'user', 2, 3), (3, 'R', NULL, 'user', 2, 3), (2, 'R', NULL, 'assistant', 3, 3)
    ), v AS (
        SELECT DISTINCT c, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM judged
        UNION ALL
        SELECT c, i, q, cost, audit, lines FROM (
            SELECT v.c, r.i, e.goal AS q, v.cost + 3 * length(n.ahead) + e.price + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS cost,
                v.audit || n.ahead || e.letter AS audit,
                list_concat(v.lines, n.lines, CASE WHEN letter = 'D' THEN [] ELSE [coalesce(e.role, r.role) || ':' || r.text] END) AS lines
            FROM v JOIN judged r ON r.c = v.c AND r.i = v.i + 1 JOIN inserts n ON n.q = v.q JOIN edits e ON e.p = n.p
            WHERE (letter = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (e.initial IS NULL OR e.initial = r.initial)
        ) QUALIFY row_number() OVER (PARTITION BY c, i, q ORDER BY cost, audit) = 1
    ), counts AS (
        SELECT c, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
            count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
            count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY c
    ), ended AS (
        SELECT v.c, cost + CASE q WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END AS cost, audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
            list_concat(lines, CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END) AS lines
        FROM v JOIN counts ON counts.c = v.c AND n = i
    ), best AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY c ORDER BY cost, audit) = 1)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, c FROM named) LEFT JOIN counts USING (c) LEFT JOIN best USING (c)
"""


def _quoted(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TEMPLATES = ", ".join(f"({k}, '{t.label}', {t.least}, {t.named}, {_quoted(t.words)})" for k, t in enumerate(TEMPLATES))
#: Runs of words by the words after each one, joined as text.
LICENSE_SQL = rf"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
        FROM documents
    ), w AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) - 1 AS w FROM d),
    r AS (SELECT doc_id, w, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS e FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY w)),
    t(template, label, least, named, words) AS (VALUES {_TEMPLATES}),
    g AS (
        SELECT template, least(4, len(words)) AS k, p - 1 AS t, array_to_string(words[p:p + least(4, len(words)) - 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(words) - least(4, len(words)) + 2)) AS p FROM t)
    ), hits AS (
        SELECT doc_id, w, template, t, k FROM r JOIN g ON k = 2 AND gram = a || ' ' || b
        UNION ALL SELECT doc_id, w, template, t, k FROM r JOIN g ON k = 3 AND gram = a || ' ' || b || ' ' || c
        UNION ALL SELECT doc_id, w, template, t, k FROM r JOIN g ON k = 4 AND gram = a || ' ' || b || ' ' || c || ' ' || e
    ), votes AS (
        SELECT doc_id, template, named, w - t AS diagonal, k, min(w) AS first, max(w) AS last, list(t) AS ts FROM hits JOIN t USING (template) GROUP BY ALL
    ), fresh AS (
        SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= CASE WHEN named THEN 0 ELSE 5 END THEN 0 ELSE 1 END AS f
        FROM votes WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)
    ), grouped AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS grp FROM fresh),
    each AS (SELECT doc_id, template, grp, first, last, k, diagonal, unnest(ts) AS t FROM grouped),
    cells AS (SELECT doc_id, template, grp, first, last, k, t + j AS cell, diagonal + t + j AS own FROM (SELECT *, unnest(range(0, k)) AS j FROM each)),
    spans AS (
        SELECT doc_id, label, named, min(first) AS start, max(last + k) AS stop, count(DISTINCT cell) / any_value(len(words)) AS score, count(DISTINCT own) AS own, any_value(least) AS least
        FROM cells JOIN t USING (template) GROUP BY doc_id, template, label, named, grp
    ), sound AS (SELECT * FROM spans WHERE score >= least AND own >= 0.5 * (stop - start)),
    s AS (
        SELECT doc_id, count(*) FILTER (WHERE named) AS n_base, min(start) FILTER (WHERE named) AS first_word, max(start) FILTER (WHERE named) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE named) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
        FROM sound GROUP BY doc_id
    )
    SELECT d.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
        coalesce(score, 0.0) AS score FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""
