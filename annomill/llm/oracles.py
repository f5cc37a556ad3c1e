"""SQL twins of the queries that SQL can express."""


def centroid_sql(clusters: int, rounds: int) -> str:
    """The rounds one after the other, each in long form: a row for each vector and dimension."""
    def nearest(name: str, centroids: str) -> str:
        return f"""
        d{name} AS (
            SELECT v.id, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN {centroids} c ON v.k = c.k GROUP BY v.id, c.c),
        a{name} AS MATERIALIZED (
            SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{name} GROUP BY id)"""

    parts = [f"""
        WITH e AS (
            SELECT vec_id AS id, list_transform(embedding, lambda x: 64 * x::DOUBLE) AS s FROM embeddings
            WHERE len(embedding) = 64),
        v AS MATERIALIZED (
            SELECT id, unnest(range(1, 65)) AS k, unnest(list_transform(s, lambda x: floor(x)::BIGINT)) AS x FROM e
            WHERE len(list_filter(s, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS (
            SELECT f.c, k, x FROM v JOIN (
                SELECT id, row_number() OVER (ORDER BY sha256('1:' || id)) - 1 AS c FROM (SELECT DISTINCT id FROM v)
                QUALIFY c < {clusters}) f USING (id))"""]
    for r in range(rounds):
        parts.append(nearest(str(r), f"c{r}"))
        parts.append(f"""
        s{r} AS (
            SELECT c, k, sum(x)::BIGINT AS s, count(*) AS n FROM v JOIN a{r} USING (id) GROUP BY c, k),
        c{r + 1} AS MATERIALIZED (
            SELECT c, k, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{r} LEFT JOIN s{r} USING (c, k))""")
    parts.append(nearest("", f"c{rounds}"))
    parts.append(f"""
        h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY k)) AS h FROM c{rounds} GROUP BY c)""")
    return ",".join(parts) + """
        SELECT id AS vec_id, c::INT AS cluster, d::BIGINT AS distance,
               (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
               h AS centroid_sha256
        FROM a JOIN h USING (c)"""


def listed_sql(rules: tuple) -> str:
    listed = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in rules)
    return rf"""
        WITH r AS (
            SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS s
            FROM (VALUES {listed}) t(rule, verdict)),
        u AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        p AS (
            SELECT page_id, rest,
                   coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                   array_to_string(list_sort(list_filter(
                       string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
                       lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS query
            FROM u),
        c AS (
            SELECT *, CASE WHEN host <> '' THEN
                       regexp_replace(host, '^www\.|:(?:80|443)?$', '', 'g') || regexp_replace(path, '/+$', '')
                       || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical
            FROM p),
        l AS (SELECT canonical FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1),
        n AS (SELECT *, row_number() OVER () AS number FROM c),
        f AS (
            SELECT number, max((length(rule), length(h), rule, verdict)) AS best
            FROM n JOIN r ON rest IS NOT NULL AND (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)
            GROUP BY number)
        SELECT page_id, host, path, best[3] AS rule,
               coalesce(best[4], CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM n LEFT JOIN f USING (number) LEFT JOIN l ON n.canonical = l.canonical"""


ORACLES = {
    "op3_stateful_exact": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(n) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id)""",
    "op5_doubling_substrings": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        w AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM d),
        k AS (SELECT doc_id, words[p] AS word, p, CASE WHEN p + 19 <= len(words) THEN
                  array_to_string(words[p:p + 19], ' ') END AS run FROM w),
        f AS (SELECT *, run IS NOT NULL AND row_number() OVER (PARTITION BY run ORDER BY doc_id, p) > 1 AS later FROM k),
        g AS (SELECT *, max(later::INT) OVER (PARTITION BY doc_id ORDER BY p ROWS 19 PRECEDING) = 1 AS gone FROM f),
        r AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS r,
                     coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS kept FROM g GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(r, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN r USING (doc_id)""",
    "op6_deletion_lines": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS number FROM documents WHERE text IS NOT NULL),
        m AS (SELECT *, regexp_full_match(line, '[\x20\x09-\x0D]*') AS blank FROM l),
        e AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, number) AS copy FROM m),
        f AS (SELECT doc_id, number, line, length(line) AS n FROM e WHERE copy = 1 AND NOT blank AND length(line) >= 16),
        h AS (SELECT *, unnest([left(line, n // 2), left(line, (n - 1) // 2)]) AS half, 'first' AS side FROM f
              UNION ALL
              SELECT *, unnest([right(line, n // 2), right(line, (n - 1) // 2)]), 'last' FROM f),
        p AS (SELECT DISTINCT a.line AS later, b.line AS earlier FROM h a JOIN h b ON a.half = b.half AND a.side = b.side
              WHERE (b.doc_id, b.number) < (a.doc_id, a.number) AND abs(a.n - b.n) <= 1 AND a.line <> b.line),
        o AS (SELECT later, earlier, CASE WHEN length(later) >= length(earlier) THEN later ELSE earlier END AS x,
                     CASE WHEN length(later) >= length(earlier) THEN earlier ELSE later END AS y FROM p),
        q AS (SELECT DISTINCT later AS line FROM o WHERE len(list_filter(range(1, length(x) + 1), lambda c:
                  left(x, c - 1) = left(y, c - 1)
                  AND substr(x, c + 1) = CASE WHEN length(x) = length(y) THEN substr(y, c + 1) ELSE substr(y, c) END)) > 0),
        g AS (SELECT e.*, NOT blank AND (copy > 1 OR q.line IS NOT NULL) AS gone FROM e LEFT JOIN q ON e.line = q.line),
        r AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS r,
                     coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT gone), '') AS kept
              FROM g GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_lines, coalesce(r, 0) AS n_removed,
               CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
        FROM documents d LEFT JOIN r USING (doc_id)""",
    "op11_fm_variants": r"""
        WITH RECURSIVE
        t0 AS (SELECT range AS i, range AS v FROM range(256)),
        t8 AS (
            SELECT i, v, 0 AS round FROM t0
            UNION ALL
            SELECT i, xor(v // 2, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END), round + 1 FROM t8 WHERE round < 8),
        crc AS (SELECT list(v ORDER BY i) AS steps FROM t8 WHERE round = 8),
        o AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        g AS (SELECT run, count(*) AS copies, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS b
              FROM o WHERE length(run) >= 7 GROUP BY doc_id, run),
        h AS (
            SELECT run, copies, xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(range(0, length(b) // 2),
                                    lambda i: ('0x' || substr(b, 2 * i + 1, 2))::BIGINT)),
                       lambda a, c: xor(a // 256, steps[xor(a % 256, c) + 1]))) AS h
            FROM g, crc),
        w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                          ELSE run END AS word, copies FROM h),
        v AS MATERIALIZED (
            SELECT word, sum(copies)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(copies) >= 2),
        d AS MATERIALIZED (
            SELECT word, n, c, substr(word, 1, c - 1) || substr(word, c + 1) AS less
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS c FROM v)),
        p AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.less = b.less AND a.c = b.c AND a.word <> b.word
            UNION
            SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word
            UNION
            SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
        f AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS best, max(near_n) AS best_n
              FROM p GROUP BY word),
        k AS MATERIALIZED (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form,
                   CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n
            FROM v LEFT JOIN f USING (word)),
        r AS (SELECT word, word AS root, 0 AS step FROM k
              UNION ALL
              SELECT r.word, k.form, step + 1 FROM r JOIN k ON r.root = k.word WHERE k.form IS NOT NULL)
        SELECT k.word, n, n_near, form, form_n, arg_max(root, step) AS root
        FROM k JOIN r USING (word) GROUP BY ALL""",
    "op12_table_centroids": centroid_sql(16, 3),
    "op13_bloom_urls": listed_sql((("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
                                   ("org/fr/", "allow"))),
}
