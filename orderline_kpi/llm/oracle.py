"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from orderline_kpi.llm import licenses

OP8_QUALITY_RULES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT r, doc_id, source, text,
           list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), starts AS (
    SELECT r, words, unnest(range(1, greatest(len(words) - 1, 1))) AS p FROM split
), grams AS (
    SELECT r, p, count(*) OVER (PARTITION BY r, words[p], words[p + 1], words[p + 2]) AS n FROM starts
), covered AS (
    SELECT r, count(DISTINCT q) AS n_repeat_words
    FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM grams WHERE n > 1) GROUP BY r
), measured AS (
    SELECT doc_id, source, len(words) AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split LEFT JOIN covered USING (r)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), hosts AS (
    SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS f FROM judged GROUP BY source
), sums AS (
    SELECT count(*) - 1 AS chance, sum(n) AS n, sum(f) / sum(n) AS m, sum(n::DOUBLE * n) / sum(n) AS nn,
           sum(f::DOUBLE * f / n) AS ff
    FROM hosts
), prior AS (
    SELECT m, least(greatest(coalesce(
        ((ff - n * m * m) / nullif(m * (1 - m), 0) - chance) / nullif(n - nn - chance, 0), 0), 0), 0.5) AS s
    FROM sums
), shrunk AS (
    SELECT source, n, m, s, (s * f + m * (1 - s)) / (s * n + (1 - s)) AS rate FROM hosts, prior
), bounds AS (
    SELECT source, m, rate - 3 * sqrt(s * rate * (1 - rate) / (s * n + 1)) AS low FROM shrunk
), suspects AS (
    SELECT source, low > 0.5 AS rejected FROM bounds WHERE low > m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (
           SELECT 1 FROM suspects
           WHERE suspects.source IS NOT DISTINCT FROM judged.source AND (
               rejected OR n_words < 100 OR 100 * n_repeat_words > 25 * n_words OR 100 * n_symbols > 10 * word_chars)
       ) AS kept
FROM judged
"""

OP7_DECONTAMINATION = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), tests AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[p:p + 9], ' ') AS phrase
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 8, 2))) AS p FROM tests WHERE len(words) > 0)
), starts AS (
    SELECT r, n, p, array_to_string(words[p:p + n - 1], ' ') AS phrase
    FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS p
          FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)
), matches AS (
    SELECT r, p, n, item FROM starts JOIN windows USING (n, phrase)
), hits AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM matches) GROUP BY r
), found AS (
    SELECT r, count(DISTINCT item) AS n_items,
           array_to_string(list_sort(list(DISTINCT item)), ',') AS items
    FROM matches GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN found USING (r)
"""

OP10_SUBSTRING_DEDUP = r"""
WITH docs AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS r, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT r, p, array_to_string(words[p:p + 19], ' ') AS phrase
    FROM (SELECT r, words, unnest(range(1, len(words) - 18)) AS p FROM docs WHERE len(words) >= 20)
), repeats AS (
    SELECT r, p FROM (
        SELECT r, p, row_number() OVER (PARTITION BY phrase ORDER BY r, p) AS k FROM windows) WHERE k > 1
), removed AS (
    SELECT r, list(DISTINCT q) AS gone FROM (SELECT r, unnest(range(p, p + 20)) AS q FROM repeats) GROUP BY r
), listed AS (
    SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS q FROM docs WHERE r IN (SELECT r FROM removed)
), gone AS (
    SELECT r, unnest(gone) AS q FROM removed
), rest AS (
    SELECT r, string_agg(word, ' ' ORDER BY q) AS kept FROM listed ANTI JOIN gone USING (r, q) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(words, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM docs LEFT JOIN removed USING (r) LEFT JOIN rest USING (r)
"""

_PHRASE_PLACES = " || ".join(
    f"[{{'at': i, 'label': '{label}'}} FOR i IN range(0, len(words)) IF words[i + 1:i + {len(phrase.split())}] = {phrase.split()}]"
    for phrase, label in licenses.PHRASES.items())
_TEMPLATE_LABELS = " || ".join(
    f"CASE WHEN regexp_matches(joined, ' {licenses.template_pattern(template)}') THEN ['{label}'] ELSE [] END"
    for label, template in licenses.TEMPLATES.items())

# Templates as regular expressions over the words, built from the markup and not from the automata.
OP12_LICENSES = rf"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), found AS (
    SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS joined, {_PHRASE_PLACES} AS places FROM docs
), labelled AS (
    SELECT doc_id, words, places, list_distinct([p.label FOR p IN places]) AS base, {_TEMPLATE_LABELS} AS more FROM found
)
SELECT doc_id, len(words) AS n_words, len(places) AS n_base,
       list_min([p.at FOR p IN places]) AS first_word, list_max([p.at FOR p IN places]) AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(base || more)), ','), '') AS labels,
       CASE WHEN len(more) > 0 THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM labelled
"""

# The remainder of each CRC-32 is worked out bit by bit; a node is the digest of the list of its turns' digests.
OP13_PREFIX_TRIE = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, xor(list_reduce(
        [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')],
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda r, bit: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END)),
        4294967295::BIGINT), 4294967295) % 6 AS h
    FROM turns WHERE place = 1
), rebuilt AS (
    SELECT c.conv_id, 1 AS part, place, role, text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place <= h
    UNION ALL
    SELECT conv_id, 2, place, role, text FROM convs JOIN turns USING (conv_id) WHERE place > h
), paths AS (
    SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
           sha256(array_to_string(list(sha256(length(role) || ':' || role || text)) OVER w, ',')) AS node
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
), steps AS (
    SELECT conv_id, depth, node, chars, lag(node, 1, 'root') OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths
    UNION ALL SELECT conv_id, 0, 'root', 0, NULL FROM convs
), nodes AS (
    SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, min(parent) AS parent, min(chars) AS chars, count(*) AS n_convs
    FROM steps GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent
), subtrees AS (
    SELECT DISTINCT up.node AS node, down.node AS below
    FROM steps up JOIN steps down ON up.conv_id = down.conv_id AND down.depth >= up.depth
), totals AS (
    SELECT subtrees.node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
    FROM subtrees JOIN nodes ON nodes.node = below LEFT JOIN children ON children.node = below GROUP BY subtrees.node
), ends AS (
    SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT conv_id, arg_max(node, depth) AS node FROM steps GROUP BY conv_id) GROUP BY node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN totals USING (node) LEFT JOIN children USING (node) LEFT JOIN ends USING (node)
LEFT JOIN nodes p ON p.node = n.parent
"""

ORACLE_SQL: dict[str, str] = {
    "op7_decontamination": OP7_DECONTAMINATION,
    "op8_quality_rules": OP8_QUALITY_RULES,
    "op10_substring_dedup": OP10_SUBSTRING_DEDUP,
    "op12_licenses": OP12_LICENSES,
    "op13_prefix_trie": OP13_PREFIX_TRIE,
}
