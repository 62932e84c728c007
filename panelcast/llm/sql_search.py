"""SQL of the conversation trie and the ranked search, for an engine other than Spark."""

from __future__ import annotations


def prefix_trie(every: int = 20, most: int = 4) -> str:
    """Prefixes as lists of turns; a subtree by the owners whose prefix of that length is the node."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    entry = "i"
    for _ in range(8):
        entry = f"(SELECT {step} FROM (SELECT {entry} AS x))"
    return rf"""
    WITH c AS (SELECT list({entry} ORDER BY i) AS t FROM range(256) r(i)),
    u AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
    i AS (
      SELECT conv_id, conv_id - conv_id % {every} AS base, xor(4294967295, list_reduce(list_concat([4294967295::bigint],
               list_transform(regexp_extract_all(conv_id::varchar, '.'), lambda z: ascii(z)::bigint)),
               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % {most} AS h
      FROM (SELECT DISTINCT conv_id FROM u), c),
    b AS (SELECT i.conv_id, u.pos, role, text FROM i JOIN u ON u.conv_id = base AND u.pos <= h),
    n AS (SELECT i.conv_id, any_value(h) AS h, count(b.pos) AS taken FROM i LEFT JOIN b USING (conv_id) GROUP BY 1),
    r AS (
      SELECT * FROM b UNION ALL
      SELECT u.conv_id, u.pos - h + taken, role, text FROM u JOIN n USING (conv_id) WHERE u.pos > h),
    p AS (
      SELECT conv_id, pos AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
             list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, [] FROM i),
    last AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY 1),
    m AS (
      SELECT p.depth, p.path, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(p.words) AS words,
             string_agg(p.conv_id::varchar, ',' ORDER BY p.conv_id) FILTER (last.depth = p.depth) AS ends
      FROM p JOIN last ON last.conv_id = p.conv_id GROUP BY 1, 2),
    k AS (SELECT depth - 1 AS depth, path[:-2] AS path, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY 1, 2),
    v AS (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN k USING (depth, path)),
    s AS (
      SELECT p.depth, p.path, sum((v.n_children = 0)::bigint) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved
      FROM v JOIN p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY 1, 2)
    SELECT v.conv_id, v.depth::bigint AS depth, o.conv_id AS parent_conv_id, v.n_convs::bigint AS n_convs,
           v.n_children::bigint AS n_children, n_leaves::bigint AS n_leaves, saved::bigint AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
    FROM v JOIN s USING (depth, path) LEFT JOIN v o ON v.depth > 0 AND o.depth = v.depth - 1 AND o.path = v.path[:-2]"""


def ranked(k: int = 50) -> str:
    """Scores of all documents that share a term with an item, and the best ranks."""
    split = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS row, {split} AS words FROM documents WHERE doc_id IS NOT NULL),
    b AS (SELECT DISTINCT item_id, unnest({split}) AS term FROM benchmark WHERE item_id IS NOT NULL),
    g AS (SELECT count(*) AS docs, sum(len(words))::bigint AS terms FROM d WHERE len(words) > 0),
    p AS (SELECT row, doc_id, len(words) AS n, unnest(words) AS term FROM d),
    f AS (SELECT row, doc_id, any_value(n) AS n, term, count(*) AS tf FROM p SEMI JOIN b USING (term) GROUP BY row, doc_id, term),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint AS w FROM f, g GROUP BY term),
    s AS (
      SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::bigint AS score
      FROM b JOIN f USING (term) JOIN w USING (term), g GROUP BY item_id, row, doc_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    SELECT item_id, rank::int AS rank, doc_id, score FROM r WHERE rank <= {k}"""
