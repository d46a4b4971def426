"""The same queries as SQL for a second engine, where SQL can express them."""

ORACLES: dict[str, str] = {}

# Of equal normalised texts the greatest id stays; groups are counted by a window.
ORACLES["op9_exact_dedup"] = """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
counted AS (
    SELECT doc_id, sha256(t) AS text_sha256,
        max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
    FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM counted
"""

# All windows that touch a shingle of the item, compared as multisets of shingles.
ORACLES["op1_benchmark_matches"] = r"""
WITH doc_words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}\p{M}]+'), lambda w: w <> '') AS w
    FROM documents
),
item_words AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}\p{M}]+'), lambda w: w <> '') AS w
    FROM benchmark
),
doc_shingles AS (
    SELECT doc_id, len(w) - 4 AS places, unnest(range(len(w) - 4)) AS spot,
        unnest(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) AS shingle
    FROM doc_words WHERE len(w) >= 5
),
item_shingles AS (
    SELECT item_id, len(w) - 4 AS m,
        unnest(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) AS shingle
    FROM item_words WHERE len(w) >= 5
),
item_counts AS (SELECT item_id, m, shingle, count(*) AS n FROM item_shingles GROUP BY ALL),
touched AS (SELECT DISTINCT doc_id, places, item_id, m, spot FROM doc_shingles JOIN item_counts USING (shingle)),
starts AS (
    SELECT DISTINCT doc_id, item_id, m, least(m, places) AS held, start
    FROM (SELECT *, unnest(range(greatest(0, spot - m + 1), spot + 1)) AS start FROM touched)
    WHERE start + m <= places OR start = 0
),
counted AS (
    SELECT s.doc_id, s.item_id, s.m, s.held, s.start, d.shingle, count(*) AS n
    FROM starts s JOIN doc_shingles d ON d.doc_id = s.doc_id AND d.spot >= s.start AND d.spot < s.start + s.m
    GROUP BY ALL
),
compared AS (
    SELECT c.doc_id, c.item_id, c.m, c.start, sum(least(c.n, i.n)) AS common, any_value(c.held) AS held
    FROM counted c JOIN item_counts i USING (item_id, shingle) GROUP BY c.doc_id, c.item_id, c.m, c.start
),
scored AS (SELECT *, CAST(common AS DOUBLE) / CAST(held + m - common AS DOUBLE) AS similarity FROM compared)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start_word, CAST(m + 4 AS INTEGER) AS n_words, similarity
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

# The first occurrence of each normalised sentence stays; a run of others goes if it has 30 words.
# A separator belongs to the sentence before it.
ORACLES["op2_line_dedup"] = r"""
WITH cut AS (
    SELECT doc_id, regexp_split_to_array(text, '\n|[.!?]+[ \t]+') AS units,
        regexp_extract_all(text, '\n|[.!?]+[ \t]+') AS marks
    FROM documents WHERE text IS NOT NULL
),
parts AS (
    SELECT doc_id, unnest(units) AS line, unnest(list_concat(marks, [''])) AS mark,
        generate_subscripts(units, 1) AS i, len(units) AS n
    FROM cut
),
spans AS (
    SELECT *, CAST(sum(length(line) + length(mark)) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - length(mark) AS BIGINT) AS start,
        trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[ \t\n\x0B\f\r]+', ' ', 'g')) AS unit
    FROM parts
),
ranked AS (
    SELECT *, unit <> '' AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, start) > 1 AS again,
        i < n OR line <> '' AS counts, CASE WHEN unit = '' THEN 0 ELSE len(string_split(unit, ' ')) END AS words
    FROM spans
),
runs AS (
    SELECT *, count(*) FILTER (unit <> '' AND NOT again) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM ranked
),
weighed AS (
    SELECT *, again AND sum(CASE WHEN again THEN words ELSE 0 END) OVER (PARTITION BY doc_id, run) >= 30 AS gone FROM runs
),
kept AS (
    SELECT doc_id,
        coalesce(string_agg(line || mark, '' ORDER BY i) FILTER (NOT gone), '') AS text,
        CAST(count(*) FILTER (counts) AS INTEGER) AS n_units, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
        coalesce(string_agg(start || '-' || (start + length(line)), ',' ORDER BY i) FILTER (gone), '') AS removed
    FROM weighed GROUP BY doc_id
)
SELECT * FROM kept
UNION ALL
SELECT doc_id, text, 0, 0, '' FROM documents WHERE text IS NULL
"""

ORACLES["op4_warc_archives"] = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS p, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
),
chosen AS (SELECT *, max(page_id) OVER (PARTITION BY p) AS kept FROM payloads)
SELECT page_id, payload_bytes, sha1(p) AS payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM chosen
"""


# CRC-32 of a column of ASCII digits, bit by bit; ``{}`` is the text.
_CRC32 = """xor(list_reduce(
    list_transform(string_split({}, ''), lambda c: CAST(unicode(c) AS UBIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS UBIGINT[])),
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1))),
    CAST(4294967295 AS UBIGINT)), CAST(4294967295 AS UBIGINT))"""

# Levels as lists, one hash at a time; proofs are folded one sibling at a time.
ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE marked AS (
    SELECT *, n_chars + CASE WHEN {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN 1 ELSE 0 END AS shown_chars
    FROM documents
),
stated AS (
    SELECT doc_id, lang,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
        coalesce(strlen(CAST(shown_chars AS VARCHAR)) || ':' || shown_chars, '-') AS shown_chars,
        coalesce(strlen(text) || ':' || text, '-') AS body
    FROM marked
),
leaves AS (
    SELECT doc_id, lang, sha256(head || chars || body) AS leaf, sha256(head || shown_chars || body) AS shown FROM stated
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS pos FROM leaves
),
levels AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range(CAST(ceil(len(nodes) / 2) AS BIGINT)),
        lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    FROM levels WHERE len(nodes) > 1
),
subroots AS (
    SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
    FROM levels WHERE len(nodes) = 1
),
upper AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0
    UNION ALL
    SELECT level + 1, list_transform(range(CAST(ceil(len(nodes) / 2) AS BIGINT)),
        lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    FROM upper WHERE len(nodes) > 1
),
sides AS (
    SELECT p.lang, p.pos, l.level, (p.pos >> l.level) % 2 = 1 AS is_right, l.nodes[xor(p.pos >> l.level, 1) + 1] AS sibling
    FROM placed p JOIN levels l ON l.lang IS NOT DISTINCT FROM p.lang AND len(l.nodes) > 1
    UNION ALL
    SELECT p.lang, p.pos, s.height + u.level, (s.place >> u.level) % 2 = 1, u.nodes[xor(s.place >> u.level, 1) + 1]
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN upper u ON len(u.nodes) > 1
),
folded AS (
    SELECT lang, pos, 0 AS level, shown AS node FROM placed
    UNION ALL
    SELECT f.lang, f.pos, f.level + 1,
        sha256(CASE WHEN is_right THEN sibling || node ELSE node || coalesce(sibling, '') END)
    FROM folded f JOIN sides s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.level = f.level
),
ends AS (SELECT lang, pos, arg_max(node, level) AS folded_root FROM folded GROUP BY lang, pos),
proofs AS (
    SELECT lang, pos, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY level)) AS proof_sha256
    FROM sides GROUP BY lang, pos
),
root AS (SELECT nodes[1] AS root FROM upper WHERE len(nodes) = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
    folded_root = root AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN ends e ON e.lang IS NOT DISTINCT FROM p.lang AND e.pos = p.pos
LEFT JOIN proofs f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos CROSS JOIN root
"""

# A path is the concatenated digests of its turns; every prefix of every conversation is listed.
ORACLES["op11_conversation_trie"] = f"""
WITH turns AS (
    SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
        strlen(coalesce(text, '')) AS size
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
    SELECT conv_id, list({{'key': key, 'size': size}} ORDER BY turn NULLS FIRST, key) AS turns FROM turns GROUP BY conv_id
),
headed AS (SELECT *, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(d.turns[1 : CAST(c.h AS BIGINT)], []), c.turns[CAST(c.h AS BIGINT) + 1 :]) AS turns
    FROM headed c LEFT JOIN own d ON d.conv_id = c.conv_id - c.conv_id % 5
),
pathed AS (
    SELECT conv_id, len(turns) AS n, turns, array_to_string(list_transform(turns, lambda t: t.key), '') AS path FROM rebuilt
),
prefixes AS (
    SELECT conv_id, n, d, left(path, 32 * d) AS path, CASE WHEN d = 0 THEN 0 ELSE turns[d].size END AS size
    FROM (SELECT *, unnest(range(n + 1)) AS d FROM pathed)
),
nodes AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
        sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
    FROM prefixes GROUP BY path, d
),
children AS (SELECT left(path, 32 * (d - 1)) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)),
subtrees AS (
    SELECT left(path, 32 * above) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(d + 1)) AS above FROM counted) GROUP BY 1
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves,
    CAST(s.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s USING (path) LEFT JOIN nodes p ON c.d > 0 AND p.path = left(c.path, 32 * (c.d - 1))
"""
