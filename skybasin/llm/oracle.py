"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_ESCAPED = r"regexp_replace({}, '([<\[])(\\*/?(?:s>|INST\]))', '\1\\\2', 'g')"

CHAT = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
    FROM rows
), sizes AS (
    SELECT *, length({_ESCAPED.format("text")}) + 4
        + CASE WHEN before IS DISTINCT FROM role THEN length({_ESCAPED.format("role")}) + 13 ELSE 0 END
        AS chars
    FROM marked
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
        AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
        FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sizes GROUP BY conv_id
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i : least(i + 4, len(w))], chr(10))) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
    SELECT a AS doc_id, a AS other FROM links
    UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), lowest AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
    d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, r.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM vectors q JOIN vectors r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id AND len(q.v) = len(r.v)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _record(number: str, uri: str, body: str) -> str:
    return (
        "'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:record:' || "
        f"CAST({number} AS VARCHAR) || '>' || e || 'WARC-Target-URI: ' || coalesce({uri}, '') || e || "
        f"'Content-Type: text/html' || e || 'Content-Length: ' || strlen({body}) || e || e || {body} || e || e"
    )


FIXITY = f"""
WITH pages_ AS (
    SELECT page_id, url, coalesce(html, '') AS html, chr(13) || chr(10) AS e,
        CAST('0x' || substr(md5(coalesce(url, '')), 1, 4) AS INTEGER) % 400 AS die
    FROM pages
), replica AS (
    SELECT page_id, url, e, CASE die WHEN 1 THEN left(html, 100) WHEN 2 THEN html || chr(10) ELSE html END AS html,
        CASE die WHEN 4 THEN 7 ELSE 0 END AS pad
    FROM pages_ WHERE die <> 0
    UNION ALL SELECT -1 - page_id, url, e, html, 0 FROM pages_ WHERE die = 3
), a AS (
    SELECT page_id, CAST(floor(page_id / 4096.0) AS BIGINT) AS file, {_record("page_id", "url", "html")} AS record FROM pages_
), b AS (
    SELECT page_id, CAST(floor(page_id / 4096.0) AS BIGINT) AS file, {_record("page_id", "url", "html")} AS record, pad FROM replica
), a_ AS (
    SELECT *, CAST(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id) AS BIGINT) AS stop FROM a
), b_ AS (
    SELECT *, CAST(sum(strlen(record) + pad) OVER (PARTITION BY file ORDER BY page_id) AS BIGINT) AS stop FROM b
)
SELECT coalesce(a_.page_id, b_.page_id) AS page_id,
    CASE WHEN b_.page_id IS NULL THEN 'missing' WHEN a_.page_id IS NULL THEN 'extra'
        WHEN a_.record <> b_.record THEN 'changed' ELSE 'moved' END AS state,
    a_.file AS file, a_.stop - strlen(a_.record) AS start, a_.stop AS "end",
    b_.stop - strlen(b_.record) AS found_start, b_.stop AS found_end,
    sha256(a_.record) AS expected_digest, sha256(b_.record) AS found_digest
FROM a_ FULL JOIN b_ ON a_.page_id = b_.page_id
WHERE a_.record IS DISTINCT FROM b_.record OR pad > 0
"""


def _crc(name: str, column: str, table: str) -> str:
    """A common table ``name``: the unsigned crc32 of the decimal text of every id, bit by bit."""
    return f"""{name} AS (
    SELECT {column}, xor(list_reduce(
        flatten(list_transform(string_split(CAST({column} AS VARCHAR), ''),
            lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda s, b: CASE WHEN xor(s, b) & 1 = 1 THEN xor(xor(s, b) >> 1, 3988292384) ELSE xor(s, b) >> 1 END,
        CAST(4294967295 AS BIGINT)), 4294967295) AS crc
    FROM (SELECT DISTINCT {column} FROM {table} WHERE {column} IS NOT NULL)
)"""


def _leaf(text: str) -> str:
    values = ("CAST(d.doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_SIBLINGS = """coalesce(string_agg(digest, '') OVER (PARTITION BY {0}level, i // 3 ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (PARTITION BY {0}level, i // 3 ORDER BY i
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"""

MANIFEST = f"""
WITH RECURSIVE {_crc("crcs", "doc_id", "documents")}, leaves AS (
    SELECT d.doc_id, coalesce('=' || source, '-') AS tree, {_leaf("text")} AS leaf,
        CASE WHEN crc % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS tampered
    FROM documents d LEFT JOIN crcs USING (doc_id)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, tampered) - 1 AS i,
        count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), trees AS (
    SELECT tree, 0 AS level, i, n, leaf AS digest FROM placed
    UNION ALL SELECT tree, level + 1, i // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY i))
    FROM trees WHERE n > 1 GROUP BY tree, level, i // 3
), subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM trees WHERE n = 1
), tops AS (
    SELECT 0 AS level, i, n, digest FROM subroots
    UNION ALL SELECT level + 1, i // 3, (max(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY i))
    FROM tops WHERE n > 1 GROUP BY level, i // 3
), edges AS (
    SELECT tree, level, i, {_SIBLINGS.format("tree, ")} FROM trees WHERE n > 1
), top_edges AS (
    SELECT level, i, {_SIBLINGS.format("")} FROM tops WHERE n > 1
), steps AS (
    SELECT p.tree, p.i, level, l, r FROM placed p JOIN edges e ON p.tree = e.tree AND p.i // CAST(pow(3, level) AS BIGINT) = e.i
    UNION ALL
    SELECT p.tree, p.i, 1000 + level, l, r FROM placed p JOIN subroots s USING (tree)
        JOIN top_edges e ON s.i // CAST(pow(3, level) AS BIGINT) = e.i
), proofs AS (
    SELECT tree, i, string_agg(l || r, '' ORDER BY level) AS siblings, list(l || '|' || r ORDER BY level) AS path
    FROM steps GROUP BY tree, i
), results AS (
    SELECT doc_id, leaf, digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
        sha256(coalesce(siblings, '')) AS proof_sha256,
        list_reduce(coalesce(path, []), lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2)), tampered)
            AS folded_root
    FROM placed p JOIN subroots s USING (tree) LEFT JOIN proofs f ON f.tree = p.tree AND f.i = p.i
)
SELECT *, folded_root = root AS verified FROM results
"""

PREFIX_TRIE = f"""
WITH {_crc("crcs", "conv_id", "conversations")}, turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
        md5(coalesce(role, '')) || md5(coalesce(text, '')) AS content,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL
), parts AS (
    SELECT c.conv_id, 0 AS part, t.k, t.content, t.words
    FROM crcs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.k <= c.crc % 4
    UNION ALL
    SELECT c.conv_id, 1, t.k, t.content, t.words FROM crcs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.crc % 4
), rebuilt AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS depth, content, words FROM parts
), members AS (
    SELECT conv_id, depth, words, string_agg(content, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix,
        depth = count(*) OVER (PARTITION BY conv_id) AS ends FROM rebuilt
    UNION ALL SELECT c.conv_id, 0, 0, '', NOT EXISTS (FROM rebuilt r WHERE r.conv_id = c.conv_id) FROM crcs c
), nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM members GROUP BY prefix, depth
), parents AS (
    SELECT n.*, p.conv_id AS parent_conv_id, p.prefix AS parent
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = left(n.prefix, 64 * (n.depth - 1))
), counted AS (
    SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p
        LEFT JOIN (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL) c
        ON c.parent = p.prefix AND c.depth = p.depth
), sums AS (
    SELECT m.prefix, m.depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
        sum((n_convs - 1) * c.words) AS saved_tokens
    FROM counted c JOIN members m ON m.conv_id = c.conv_id AND m.depth <= c.depth GROUP BY m.prefix, m.depth
)
SELECT c.conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted c JOIN sums USING (prefix, depth)
"""

REPEATS = """
WITH texts AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS digits FROM documents
), pieces AS (
    SELECT doc_id, n, base, substr(digits, 2 * base + 1, 1000) AS piece
    FROM (SELECT doc_id, n, digits, unnest(range(0, greatest(n - 399, 0), 100)) AS base FROM texts)
), windows AS (
    SELECT doc_id, base + k AS i, md5(substr(piece, 2 * k + 1, 800)) AS w
    FROM (SELECT doc_id, base, piece, unnest(range(0, least(100, n - 399 - base))) AS k FROM pieces)
), hits AS (
    SELECT doc_id, i FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)
), marked AS (
    SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, true) AS opens FROM hits
), runs AS (
    SELECT doc_id, i, count(*) FILTER (WHERE opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
), spans AS (
    SELECT doc_id, min(i) AS start, max(i) + 400 AS stop FROM runs GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, start, stop, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM spans
), cut AS (
    SELECT doc_id, sum(stop - start) AS n_removed, count(*) AS n_spans, max(stop) AS last,
        string_agg(substr(digits, CAST(2 * before + 1 AS BIGINT), CAST(2 * (start - before) AS BIGINT)), '' ORDER BY start) AS kept
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept || substr(digits, CAST(2 * last + 1 AS BIGINT)), digits))) AS kept_sha256,
    CAST(n_removed IS NOT NULL AS INTEGER) AS repeated
FROM texts LEFT JOIN cut USING (doc_id)
"""
