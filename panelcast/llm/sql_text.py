"""SQL that must give the same rows as the queries, for an engine other than Spark."""

from __future__ import annotations

from panelcast.llm import warc


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _crlf(s: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in s)


def _id(kind: str, *parts: str) -> str:
    h = f"md5(concat_ws('/', '{kind}', {', '.join(parts)}))"
    pieces = ", ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || concat_ws('-', {pieces}) || '>')"


def _plain(html: str) -> str:
    text = f"regexp_replace(regexp_replace({html}, {quoted(warc.HIDDEN)}, '', 'g'), {quoted(warc.TAG)}, chr(10), 'g')"
    for name, sign in warc.ENTITIES:
        text = f"replace({text}, {quoted(name)}, {quoted(sign)})"
    text = f"regexp_replace(regexp_replace({text}, {quoted(warc.BLANKS)}, ' ', 'g'), {quoted(warc.LINES)}, chr(10), 'g')"
    return f"trim({text}, ' ' || chr(10))"


def warc_derivatives() -> str:
    crlf, scheme = _crlf("\r\n"), "[a-zA-Z][a-zA-Z0-9+.-]*"
    link = f"""
        CASE WHEN regexp_matches(x, '^{scheme}:') THEN x
             WHEN starts_with(x, '//') THEN regexp_extract(url, '^({scheme}:)', 1) || x
             WHEN starts_with(x, '/') THEN regexp_extract(url, '^({scheme}://[^/?#]*)', 1) || x
             WHEN starts_with(x, '?') THEN regexp_extract(url, '^([^?#]*)', 1) || x
             WHEN starts_with(x, '#') OR x = '' THEN regexp_extract(url, '^([^#]*)', 1) || x
             WHEN regexp_extract(url, '^({scheme}://[^/?#]*/(?:[^?#]*/)?)', 1) = ''
               THEN regexp_extract(url, '^({scheme}://[^/?#]*)', 1) || '/' || x
             ELSE regexp_extract(url, '^({scheme}://[^/?#]*/(?:[^?#]*/)?)', 1) || x END"""
    return f"""
    WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
    r AS (SELECT *, {_id("response", "coalesce(page_id::varchar, '')", "url")} AS rid, 'sha256:' || sha256(html) AS source FROM p),
    d AS (SELECT *, {_id("metadata", "rid")} AS mid, {_id("conversion", "rid")} AS cid,
            {_plain("html")} AS text, {_plain(f"regexp_extract(html, {quoted(warc.TITLE)}, 1)")} AS title,
            list_transform(regexp_extract_all(html, {quoted(warc.LINK)}, 1), lambda x: 'outlink: ' || {link}) AS links FROM r),
    m AS (SELECT *, array_to_string(list_concat([
            'source-type: application/http; msgtype=response',
            'source-header: Content-Type: {warc.HTML_TYPE}',
            'source-header: Content-Length: ' || strlen(html)::varchar,
            'source-payload-digest: ' || source,
            'title: ' || replace(title, chr(10), ' ')], links), {crlf}) AS fields FROM d),
    u AS (SELECT page_id, 'metadata' AS record_type, mid AS record_id, rid AS refers_to, cid AS concurrent_to, url AS target_uri,
            'application/warc-fields' AS content_type, source AS source_digest, fields AS block FROM m
          UNION ALL SELECT page_id, 'conversion', cid, rid, mid, url, 'text/plain', source, text FROM m)
    SELECT page_id, record_type, record_id, refers_to, concurrent_to, target_uri, '{warc.DATE}' AS warc_date, content_type,
           strlen(block)::bigint AS content_length, 'sha256:' || sha256(block) AS block_digest, source_digest, block FROM u"""


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def jaccard_groups(words: int, num: int, den: int) -> str:
    """All pairs that share a shingle, their similarity, and components by recursion over links."""
    return rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] ELSE
        list_transform(range(greatest(len(words) - {words - 1}, 1)), lambda i: list_slice(words, i + 1, i + {words})) END) AS gram FROM w),
    n AS (SELECT doc_id, count(gram) AS n FROM s GROUP BY doc_id),
    pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
    link AS (
      SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE {den} * k >= {num} * (a.n + b.n - k)),
    edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y)
    SELECT w.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, min(reach.y)::bigint AS component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.x = w.doc_id GROUP BY w.doc_id, n.n"""


def contamination(window: int) -> str:
    """Document windows of every length that an item window has, equal to one of them."""
    split = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
    WITH d AS (SELECT doc_id, {split} AS words FROM documents),
    b AS (SELECT item_id, {split} AS words FROM benchmark),
    p AS (
      SELECT DISTINCT item_id, unnest(CASE WHEN len(words) = 0 THEN [] ELSE
        list_transform(range(greatest(len(words) - {window - 1}, 1)), lambda i: list_slice(words, i + 1, i + {window})) END) AS phrase FROM b),
    sizes AS (SELECT DISTINCT len(phrase) AS size FROM p),
    g AS (
      SELECT doc_id, size, unnest(range(len(words) - size + 1)) AS pos, words FROM d, sizes WHERE len(words) >= size),
    o AS (
      SELECT doc_id, pos, size, item_id FROM g JOIN p ON len(phrase) = size AND list_slice(words, pos + 1, pos + size) = phrase),
    h AS (SELECT doc_id, count(DISTINCT hit) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS hit FROM o) GROUP BY 1),
    i AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::varchar AS item FROM o) GROUP BY 1)
    SELECT d.doc_id, len(words)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
           sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)"""


def _digits(text: str, n: int) -> str:
    return f"('0x' || substr(md5({text}), 1, {n}))::bigint"


def placement(regions: int, racks: int, per_rack: int, buckets: int) -> str:
    """Draws of all children at each level as lists, the place of the least draw, and slots by rank."""
    shards = regions * racks * per_rack

    def draws(names: list[str], weights: list[float]) -> str:
        each = [f"-ln(({_digits(f'({n}) || key', 13)} + 0.5) / 4503599627370496.0) / {float(w)}" for n, w in zip(names, weights, strict=True)]
        listed = f"[{', '.join(each)}]"
        return f"list_position({listed}, list_min({listed})) - 1"

    whole = [float(racks * per_rack)] * regions
    region = [f"'g{i}/'" for i in range(regions)]
    rack = [f"'g' || g || '/k' || (g * {racks} + {i}) || '/'" for i in range(racks)]
    leaf = [f"'g' || g || '/k' || k || '/s' || (k * {per_rack} + {i}) || '/'" for i in range(per_rack)]
    byte = "list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::bigint)"
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    table = f"SELECT list(x ORDER BY i) AS t FROM (SELECT i, {{0}} AS x FROM range(256) r(i))"
    crc = "i"
    for _ in range(8):
        crc = f"(SELECT {step} FROM (SELECT {crc} AS x))"
    return f"""
    WITH c AS ({table.format(crc)}),
    d AS (SELECT doc_id, coalesce(text, '') AS body, coalesce(doc_id::varchar, 'null') AS key FROM documents),
    z AS (
      SELECT doc_id, key, (strlen(body) + 8)::bigint AS size, xor(4294967295, list_reduce(list_concat([4294967295::bigint], {byte}),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32 FROM d, c),
    g AS (SELECT *, {draws(region, whole)} AS g, {draws([*region, f"'added{shards}/'"], [*whole, 1.0])} AS h FROM z),
    k AS (SELECT *, g * {racks} + {draws(rack, [float(per_rack)] * racks)} AS k FROM g),
    s AS (SELECT *, k * {per_rack} + {draws(leaf, [1.0] * per_rack)} AS shard, {_digits("'bucket/' || key", 3)} % {buckets} AS bucket FROM k)
    SELECT doc_id, size, text_crc32::bigint AS text_crc32, 'key' AS law, shard::int AS shard,
           (row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1)::bigint AS slot,
           (CASE WHEN h = {regions} THEN {shards} ELSE shard END)::int AS grown_shard
    FROM s"""
