"""DuckDB SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op6_url_filter"] = r"""
WITH RECURSIVE p AS (
    SELECT page_id, url, html,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
        CASE WHEN contains(url, '://') THEN
            translate(regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            || regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') END AS node
    FROM pages
),
rules(verdict, host, path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
links AS (
    SELECT p.node, unnest([
        regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'is'),
        regexp_extract(html, '<link\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)[^>]*\brel\s*=\s*["'']?canonical\b', 1, 'is'),
        regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*?\burl\s*=\s*["'']?([^"''\s>]+)', 1, 'is')
    ]) AS href
    FROM p WHERE regexp_matches(html, 'canonical|refresh', 'i')
),
targets AS (
    SELECT node AS a, CASE
        WHEN contains(href, '://') THEN href
        WHEN starts_with(href, '//') THEN regexp_extract(node, '^(.*?:)//', 1) || href
        WHEN starts_with(href, '/') THEN regexp_extract(node, '^(.*?://[^/?#]*)', 1) || href END AS url
    FROM links WHERE href <> ''
),
edges AS (
    SELECT a, translate(regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        || regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') AS b
    FROM targets WHERE contains(url, '://') AND a IS NOT NULL
),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (
    SELECT a, a FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
),
nodes AS (
    SELECT DISTINCT b AS node, regexp_extract(b, '^.*?://([^/?#]*)', 1, 's') AS host,
        regexp_extract(b, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM reach
),
decided AS (
    SELECT n.node, arg_max(r.verdict, length(r.host || r.path)) AS own
    FROM nodes n JOIN rules r
      ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
    GROUP BY n.node
),
shared AS (SELECT reach.a AS node, min(decided.own) AS own FROM reach JOIN decided ON decided.node = reach.b GROUP BY 1),
ruled AS (
    SELECT p.page_id, p.url, p.host, p.path, p.node,
        (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
         WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS rule,
        (SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
         WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS own
    FROM p
)
SELECT ruled.page_id, ruled.host, ruled.path, ruled.rule, coalesce(ruled.own, shared.own, 'allow') AS verdict
FROM ruled LEFT JOIN shared ON shared.node = ruled.node
"""

ORACLE["op7_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
    SELECT row_id, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
),
k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
    SELECT k.*, shared.key IS NOT NULL AND coalesce(k.doc_id < shared.keeper, true) AS dropped
    FROM k LEFT JOIN shared ON shared.key = k.key
)
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY row_id
"""

ORACLE["op8_passage_dedup"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
starts AS (SELECT row_id, doc_id, words, unnest(range(len(words) - 49)) AS start FROM d WHERE len(words) >= 50),
windows AS (SELECT row_id, doc_id, start, md5(array_to_string(words[start + 1:start + 50], ' ')) AS seq FROM starts),
firsts AS (SELECT seq, min(doc_id) AS first_id FROM windows GROUP BY seq),
gone AS (
    SELECT DISTINCT w.row_id, unnest(range(w.start, w.start + 50)) AS pos
    FROM windows w JOIN firsts f ON f.seq = w.seq AND w.doc_id > f.first_id
),
removed AS (SELECT row_id, count(*) AS n, list(pos) AS places FROM gone GROUP BY row_id),
kept AS (
    SELECT d.row_id, string_agg(word, ' ' ORDER BY pos) AS text
    FROM (SELECT row_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM d) d
    ANTI JOIN gone ON gone.row_id = d.row_id AND gone.pos = d.pos
    GROUP BY d.row_id
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(removed.n, 0) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (row_id) LEFT JOIN kept USING (row_id)
"""

ORACLE["op10_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.vec, b.vec) >= 0.9
),
reach(a, b) AS (
    SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links,
    (SELECT min(reach.b) FROM reach WHERE reach.a = v.vec_id) AS component_id,
    v.vec_id = (SELECT min(reach.b) FROM reach WHERE reach.a = v.vec_id) AS kept
FROM v
"""

ORACLE["op13_prefix_trie"] = r"""
WITH t AS (
    SELECT conv_id, turn, substr(sha256(length(r) || ':' || r || x), 1, 32) AS id,
        len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n_words
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
),
own AS (
    SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(n_words ORDER BY turn NULLS FIRST, id) AS words
    FROM t GROUP BY conv_id
),
steps AS (
    SELECT conv_id, list_prepend(4294967295, flatten(list_transform(
        string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))) AS todo
    FROM own
),
heads AS (
    SELECT conv_id, xor(list_reduce(todo, lambda a, e: CASE WHEN e >= 0 THEN xor(a, e)
        ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
    FROM steps
),
rebuilt AS (
    SELECT own.conv_id,
        list_concat(coalesce(base.ids[1:h], []), own.ids[h + 1:]) AS ids,
        list_concat(coalesce(base.words[1:h], []), own.words[h + 1:]) AS words
    FROM own JOIN heads USING (conv_id) LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 20
),
begun AS (SELECT conv_id, ids, words, unnest(range(0, len(ids) + 1)) AS depth FROM rebuilt),
nodes AS (
    SELECT array_to_string(ids[1:depth], '') AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * any_value(words[depth]) END AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ids) = depth), '')) AS ends_sha256
    FROM begun GROUP BY 1, 2
),
children AS (SELECT substr(node, 1, 32 * (depth - 1)::INT) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
above AS (SELECT substr(node, 1, 32 * unnest(range(0, depth + 1))::INT) AS node, n_children = 0 AS leaf, saved FROM counted),
subtrees AS (SELECT node, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY node)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s USING (node)
LEFT JOIN nodes p ON c.depth > 0 AND p.node = substr(c.node, 1, 32 * (c.depth - 1)::INT)
"""
