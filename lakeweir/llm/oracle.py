"""SQL for DuckDB of the corpus queries that SQL can express.

Sharding, fingerprints and packing rest on hashes or tokens that SQL lacks, the others on
learned models, alignment or byte offsets; tests hold those to brute force.
"""

from __future__ import annotations

from lakeweir.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

WORD = r"[^\x20\x09-\x0D]+"


def _failed(rule) -> str:
    bounds = [f"{rule.measure} < {rule.low}"] if rule.low is not None else []
    bounds += [f"{rule.measure} > {rule.high}"] if rule.high is not None else []
    return f"CASE WHEN {' OR '.join(bounds)} THEN '{rule.measure}' END"


STOPS = ", ".join(f"'{word}'" for word in sorted(set(STOP_WORDS.split())))
QUALITY_RULES = f"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
           [line FOR line IN string_split(coalesce(text, ''), chr(10))
            IF regexp_matches(line, '{WORD}')] AS lines
    FROM documents
),
placed AS (
    SELECT doc_id, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM split
),
windows AS (
    SELECT doc_id, i, a, lead(a) OVER next AS b, lead(a, 2) OVER next AS c
    FROM placed WINDOW next AS (PARTITION BY doc_id ORDER BY i)
),
repeated AS (
    SELECT doc_id, i FROM windows WHERE c IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
),
covered AS (
    SELECT doc_id, count(DISTINCT i + step) AS n
    FROM repeated, (VALUES (0), (1), (2)) AS steps(step) GROUP BY doc_id
),
counted AS (
    SELECT split.doc_id, t, lines,
           CAST(len(words) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum([length(w) FOR w IN words]), 0) AS BIGINT)
               AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words,
           len([w FOR w IN words IF lower(w) IN ({STOPS})]) AS n_stops
    FROM split LEFT JOIN covered ON split.doc_id = covered.doc_id
),
measured AS (
    SELECT *,
           CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
           CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
           CASE WHEN n_words > 0 THEN len(regexp_extract_all(t, '!')) / n_words ELSE 0 END
               AS shouts_per_word,
           CASE WHEN n_words > 0 THEN n_stops / n_words ELSE 0 END AS stop_word_share,
           CASE WHEN len(lines) > 0 THEN n_dup_lines / len(lines) ELSE 0 END
               AS duplicate_line_share,
           CASE WHEN len(lines) > 0
                THEN len([x FOR x IN lines IF regexp_matches(x, '^\\s*[-*•]')]) / len(lines)
                ELSE 0 END AS bullet_line_share,
           CASE WHEN len(lines) > 0
                THEN len([x FOR x IN lines IF regexp_matches(x, '(\\.\\.\\.|…)\\s*$')])
                     / len(lines)
                ELSE 0 END AS ellipsis_line_share,
           n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
               AS base_failed
    FROM counted
),
judged AS (
    SELECT *, concat_ws(',', {", ".join(_failed(rule) for rule in RULES)}) AS failed_rules
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""

# CRC-32 of a decimal number, bit by bit over its digits.
CRC = """
xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(
        range(1, length(conv_id::VARCHAR) + 1),
        lambda i: ascii(substr(conv_id::VARCHAR, i::INTEGER, 1))::BIGINT)),
    lambda crc, code: list_reduce(
        list_prepend(xor(crc, code), range(8)),
        lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))))
"""
CONVERSATION_TRIE = f"""
WITH said AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                         ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
heads AS (SELECT *, conv_id - conv_id % 100 AS base, {CRC} % 6 AS h FROM said),
rebuilt AS (
    SELECT own.conv_id,
           list_concat(coalesce(first.turns[1:own.h], []), own.turns[own.h + 1:]) AS path
    FROM heads own LEFT JOIN said first ON first.conv_id = own.base
),
steps AS (
    SELECT conv_id, path, len(path) AS n, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt
),
members AS (
    SELECT conv_id, n, depth, to_json(path[1:depth])::VARCHAR AS node,
           to_json(path[1:depth - 1])::VARCHAR AS above,
           CASE WHEN depth > 0 THEN length(path[depth].text) ELSE 0 END AS chars
    FROM steps
),
nodes AS (
    SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id,
           count(*) AS n_convs, any_value(chars) AS chars,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                           FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM members GROUP BY depth, node
),
children AS (
    SELECT depth - 1 AS depth, above AS node, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY depth, above
),
counted AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children
    FROM nodes LEFT JOIN children USING (depth, node)
),
subtrees AS (
    SELECT members.depth, members.node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
           sum((n_convs - 1) * counted.chars)::BIGINT AS saved_tokens
    FROM counted JOIN members
    ON members.conv_id = counted.conv_id AND members.depth <= counted.depth
    GROUP BY members.depth, members.node
)
SELECT counted.conv_id, counted.depth, parent.conv_id AS parent_conv_id, counted.n_convs,
       counted.n_children, n_leaves, saved_tokens, counted.ends_sha256
FROM counted JOIN subtrees USING (depth, node)
LEFT JOIN nodes parent
ON counted.depth > 0 AND parent.depth = counted.depth - 1 AND parent.node = counted.above
"""

ORACLE = {"op2_quality_rules": QUALITY_RULES, "op11_conversation_trie": CONVERSATION_TRIE}
