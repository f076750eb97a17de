"""DuckDB SQL for the operators that SQL can express, on the driver's tables."""

from __future__ import annotations

from statistics import NormalDist

from .url_filter import EXACT_STRENGTH, LEAST_STRENGTH, RULES, SPREAD, TERMS, TWO_LABELS, WEIGHT

#: Words of documents and components over links (a, b) as SQL.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_REACH = """r AS (SELECT id AS a, id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), c AS (SELECT a AS id, min(b) AS component_id FROM r GROUP BY a)"""

EMBEDDINGS = f"""
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
    u AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
    n AS (SELECT DISTINCT vec_id AS id FROM embeddings), {_REACH},
    k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON vec_id = id LEFT JOIN k ON vec_id = a
"""

NGRAMS = f"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN ['short ' || array_to_string(w, ' ')] ELSE [] END AS s FROM w),
    every AS (SELECT doc_id, len(s) AS k, unnest(s) AS g FROM s), t AS (SELECT * FROM every WHERE g IN (SELECT g FROM every GROUP BY g HAVING count(*) > 1)),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, x.k AS m, y.k AS n, count(*) AS shared FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p WHERE 100 * shared >= 80 * (m + n - shared)),
    n AS (SELECT doc_id AS id FROM documents), {_REACH}
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN c ON doc_id = id
"""

SUBSTRINGS = f"""
    WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    h AS (SELECT doc_id, list_transform(range(1, len(w) - 18), lambda i: md5(array_to_string(w[i:i + 19], ' '))) AS h FROM w WHERE len(w) >= 20),
    g AS (SELECT doc_id, unnest(h) AS h, generate_subscripts(h, 1) AS i FROM h),
    later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM g) WHERE nth > 1),
    gone AS (SELECT DISTINCT doc_id, i + o AS i FROM later, range(0, 20) AS r(o)),
    every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
    kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS text, count(g.i) AS n FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
    SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

EXACT = f"""
    WITH n AS (SELECT doc_id, {_LOWERED} AS norm FROM documents),
    g AS (SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

#: Lines within one edit share what lies left or right of the shorter one's middle.
LINES = r"""
    WITH t AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
    e AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos FROM t),
    f AS (SELECT line, min((doc_id, pos)) AS first, length(line) AS n FROM e WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]') GROUP BY line),
    k AS (SELECT line, first, n, m, CAST(floor(m / 2) AS BIGINT) AS h FROM (SELECT *, unnest([n - 1, n]) AS m FROM f)),
    p AS (SELECT a.line AS a, b.line AS b, a.n AS na, b.n AS nb, a.first AS fa, b.first AS fb FROM k a JOIN k b ON a.m = b.m AND left(a.line, a.h) = left(b.line, b.h) AND a.line <> b.line WHERE greatest(a.n, b.n) - a.m <= 1 AND least(a.n, b.n) = a.m
        UNION SELECT a.line, b.line, a.n, b.n, a.first, b.first FROM k a JOIN k b ON a.m = b.m AND right(a.line, a.m - a.h) = right(b.line, b.m - b.h) AND a.line <> b.line WHERE greatest(a.n, b.n) - a.m <= 1 AND least(a.n, b.n) = a.m),
    bad AS (SELECT DISTINCT a FROM p WHERE fb < fa AND len(list_filter(range(0, greatest(na, nb)), lambda i: left(a, i) = left(b, i) AND substring(a, i + CASE WHEN na >= nb THEN 2 ELSE 1 END) = substring(b, i + CASE WHEN nb >= na THEN 2 ELSE 1 END))) > 0),
    kept AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.pos) AS text, count(*) AS n FROM e LEFT JOIN f ON e.line = f.line LEFT JOIN bad ON e.line = a WHERE f.line IS NULL OR (a IS NULL AND f.first = (e.doc_id, e.pos)) GROUP BY e.doc_id)
    SELECT t.doc_id, CAST(CASE WHEN t.text IS NULL THEN 0 ELSE len(x) END AS BIGINT) AS n_lines, CAST(CASE WHEN t.text IS NULL THEN 0 ELSE len(x) - coalesce(n, 0) END AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id
"""


def _rule_case(what: str) -> str:
    """The longest fitting rule's name or verdict."""
    best = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    fits = "".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if what == 'rule' else verdict}' " for verdict, h, p in best)
    return f"CASE {fits}END"


def _after(rows: str, n: str, k: str, moments: str) -> str:
    """rows with m and v after k bad ones of n labels, as url_filter has them."""
    spread = f"(SELECT greatest(least((coalesce(extra, 0) + {WEIGHT * SPREAD}) / (coalesce(pairs, 0) + {WEIGHT}), 0.9), 0.001) FROM {moments})"
    s = f"SELECT *, greatest(m * (1 - m) / (v + {spread} * m * (1 - m)) - 1, {LEAST_STRENGTH}) AS s FROM ({rows})"
    m = f"SELECT * EXCLUDE (m, v), (s * m + {k}) / (s + {n}) AS m FROM ({s})"
    return f"SELECT * EXCLUDE (s), m * (1 - m) / (s + {n} + 1) AS v FROM ({m})"


def _moments(name: str, children: str, parents: str, key: str) -> str:
    return f"""{name} AS (SELECT sum(c.n * pow(c.k / c.n - p.k / p.n, 2) - (p.k / p.n) * (1 - p.k / p.n)) AS extra, sum((p.k / p.n) * (1 - p.k / p.n) * (c.n - 1)) AS pairs FROM {children} c JOIN {parents} p ON c.{key} = p.{key} WHERE c.n > 0 AND p.n > 0)"""


_SURE = NormalDist().cdf(1.645)
_TWO = ", ".join(f"'{s}'" for s in TWO_LABELS)
URLS = f"""
    WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    b AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
    h0 AS (SELECT host, string_split(host, '.') AS x, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k FROM u LEFT JOIN b ON u.page_id = b.page_id GROUP BY host),
    h1 AS (SELECT *, array_to_string(x[greatest(len(x) - 1, 1):], '.') AS two FROM h0),
    h AS (SELECT host, n, k, 0 AS everything, CASE WHEN two IN ({_TWO}) THEN array_to_string(x[greatest(len(x) - 2, 1):], '.') ELSE two END AS domain, CASE WHEN two IN ({_TWO}) THEN two ELSE x[-1] END AS suffix FROM h1),
    d AS (SELECT domain, suffix, everything, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL), s AS (SELECT suffix, everything, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL), a AS (SELECT everything, sum(n) AS n, sum(k) AS k FROM s GROUP BY ALL),
    {_moments("ms", "s", "a", "everything")}, {_moments("md", "d", "s", "suffix")}, {_moments("mh", "h", "d", "domain")},
    kin AS (SELECT h.*, d.n AS nd, d.k AS kd, s.n AS ns, s.k AS ks, (a.k - s.k + 0.5) / (a.n - s.n + 1) AS m, a.n - s.n AS others FROM h JOIN d ON h.domain = d.domain JOIN s ON h.suffix = s.suffix CROSS JOIN a),
    ph AS ({_after(_after(_after("SELECT * EXCLUDE (others), m * (1 - m) / (others + 2) AS v FROM kin", "(ns - nd)", "(ks - kd)", "ms"), "(nd - n)", "(kd - k)", "md"), "n", "k", "mh")}),
    ph2 AS (SELECT host, m, v, m * (1 - m) / v - 1 AS s FROM ph),
    ab AS (SELECT host, m >= 0.5 AS under, s, CASE WHEN m >= 0.5 THEN m * s ELSE (1 - m) * s END AS p, CASE WHEN m >= 0.5 THEN (1 - m) * s ELSE m * s END AS q FROM ph2 WHERE s <= {EXACT_STRENGTH} AND m >= {_SURE} * 0.5),
    term AS (SELECT host, under, s, p, q, i, coalesce(sum(ln(0.5 * (s + i - 1) / (p + i))) FILTER (i > 0) OVER (PARTITION BY host ORDER BY i), 0) AS l FROM ab, range({TERMS}) AS r(i)),
    tail AS (SELECT host, CASE WHEN any_value(under) THEN 1 - sum(exp(l + s * ln(0.5) + lgamma(s) - lgamma(p + 1) - lgamma(q))) ELSE sum(exp(l + s * ln(0.5) + lgamma(s) - lgamma(p + 1) - lgamma(q))) END AS above FROM term GROUP BY host)
    SELECT page_id, u.host, path, {_rule_case("rule")} AS rule, coalesce({_rule_case("verdict")}, CASE WHEN sure THEN 'block' ELSE 'allow' END) AS verdict FROM (SELECT * FROM u) u JOIN (SELECT host AS of, CASE WHEN s <= {EXACT_STRENGTH} THEN coalesce(above > {_SURE}, false) ELSE m - 1.645 * sqrt(v) > 0.5 END AS sure FROM ph2 LEFT JOIN tail USING (host)) ON u.host = of
"""

ORACLE_SQL = {
    "op1_embedding_near_dedup": EMBEDDINGS, "op2_ngram_jaccard_join": NGRAMS, "op5_substring_dedup": SUBSTRINGS, "op7_url_filters": URLS, "op8_exact_dedup": EXACT, "op10_line_dedup": LINES,
}
