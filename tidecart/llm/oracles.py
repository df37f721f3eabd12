"""SQL (DuckDB) for the operators of this subpackage that SQL can express on the given tables."""

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _vector_codes(rounds: int = 4) -> str:
    """The rounds written out. Distances are sums of products of integers, exact in doubles; ties go to the lower entry."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        d{k} AS MATERIALIZED (SELECT vec_id, v.p, b.e, list_inner_product(v.y, v.y) - 2 * list_inner_product(v.y, b.y) + list_inner_product(b.y, b.y) AS d
                 FROM v JOIN b{k} b ON v.p = b.p),
        a{k} AS MATERIALIZED (SELECT vec_id, p, arg_min(e, d * 256 + e) AS e, CAST(min(d) AS BIGINT) AS d FROM d{k} GROUP BY vec_id, p)""")
        if k < rounds:
            steps.append(f"""
        m{k} AS (SELECT p, e, i, floor(sum(c) / count(*)) AS c
                 FROM (SELECT a.p, a.e, unnest(range(len(y))) AS i, unnest(y) AS c FROM a{k} a JOIN v USING (vec_id, p)) GROUP BY p, e, i),
        b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.y, b.y) AS y
                 FROM b{k} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS y FROM m{k} GROUP BY p, e) n ON b.p = n.p AND b.e = n.e)""")
    return f"""
        WITH x AS (SELECT vec_id, label, [floor(1024 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        v AS MATERIALIZED (SELECT vec_id, p, x[p * len(x) // 4 + 1:(p + 1) * len(x) // 4] AS y FROM x, (SELECT unnest(range(4)) AS p)),
        b0 AS MATERIALIZED (SELECT p, e, y FROM (SELECT p, y, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM v) WHERE e < 256),
        {",".join(steps)},
        code AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
        books AS (SELECT sha256(string_agg(array_to_string([CAST(CAST(c AS BIGINT) AS VARCHAR) FOR c IN y], ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
        FROM x JOIN code USING (vec_id), books"""


ORACLES: dict[str, str] = {
    "op2_substring_dedup": rf"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
        starts AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM w WHERE len(w) >= 50),
        windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM starts),
        low AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN low USING (s), (SELECT unnest(range(50)) AS k) WHERE first < doc_id),
        cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
          sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ')
                 ELSE array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(ps, i)], ' ') END) AS kept_sha256
        FROM w LEFT JOIN cut USING (doc_id)""",
    "op7_decontamination": rf"""
        WITH d AS (SELECT doc_id, [x FOR x IN string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
                [x FOR x IN string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM benchmark),
        items AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
                  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM items),
        windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
                    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        hits AS (SELECT DISTINCT doc_id, item_id, i, n FROM windows JOIN items USING (n, s)),
        places AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, (SELECT unnest(range(10)) AS k) WHERE k < n GROUP BY doc_id),
        named AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS ids FROM hits GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
          CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
          sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op8_jaccard_join": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT doc_id, b FROM reach JOIN link ON other = a)
        SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least.c AS component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) least USING (doc_id)""",
    "op11_url_filter": r"""
        WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
        a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM u),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                [x FOR x IN string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&')
                 IF x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)=')] AS asked FROM a),
        c AS (SELECT page_id, host, path,
                regexp_replace(rtrim(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*\z', ''), '.'), '^www\.', '') AS site,
                regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/(index\.html?)?\z', '') AS place,
                array_to_string(list_sort(asked), '&') AS query FROM h),
        k AS (SELECT page_id, host, path, CASE WHEN site = '' THEN '' ELSE site || place || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical FROM c),
        rules(site, start, decision) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        fit AS (SELECT page_id, arg_max(site || start, length(site || start)) AS rule, arg_max(decision, length(site || start)) AS decision
                FROM k JOIN rules ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start) GROUP BY page_id),
        judged AS (SELECT k.*, rule, decision FROM k LEFT JOIN fit USING (page_id)),
        listed AS (SELECT DISTINCT canonical FROM judged
                   WHERE canonical <> '' AND (decision = 'block' OR regexp_matches(host, '(^|\.)(cheap-pills|spam-farm)\.')))
        SELECT page_id, host, path, rule, coalesce(decision, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict, j.canonical
        FROM judged j LEFT JOIN listed l ON j.canonical = l.canonical""",
    "op12_fill_in_middle": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
                [CAST('0x' || substr(h, k, 8) AS BIGINT) FOR k IN [1, 9, 17, 25]] AS r FROM d),
        f AS (SELECT *, CAST(len(lines) AS BIGINT) AS n, least(r[1] % (len(lines) + 1), r[2] % (len(lines) + 1)) AS a,
                greatest(r[1] % (len(lines) + 1), r[2] % (len(lines) + 1)) AS b FROM u),
        p AS (SELECT doc_id, n, text, array_to_string(lines[1:a], '') AS pre, array_to_string(lines[a + 1:b], '') AS mid,
                array_to_string(lines[b + 1:], '') AS suf,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
                     WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
          CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
          sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                 ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
          sha256(text) AS restored_sha256 FROM p""",
    "op13_vector_codes": _vector_codes(),
}
