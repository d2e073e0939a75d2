"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from tidepanel.llm.queries import URL_RULES
from tidepanel.llm.url_reputation import LOWER, RHO, SECOND_LEVEL, UPPER

EXACT_TOPK = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

EXACT_DEDUP = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def _rules() -> str:
    """The rules as rows of (verdict, host, path)."""
    return ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)


def _level(level: str, source: str, prior: str) -> str:
    """One level of shrinkage: units with their prior, the level's rho, and posterior means."""
    return f"""
{level}_u AS (SELECT {level}, {prior} AS p, sum(n) AS n, sum(bad) AS bad FROM {source} GROUP BY ALL),
{level}_r AS (
    SELECT coalesce(least(greatest(
        coalesce(sum(CASE WHEN n > 0 THEN pow(bad - n * p, 2) / n - p * (1 - p) END), 0)
        / nullif(sum(CASE WHEN n > 0 THEN p * (1 - p) * (n - 1) END), 0), {RHO[0]}), {RHO[1]}), {RHO[1]}) AS rho
    FROM {level}_u
),
{level}_p AS (
    SELECT u.*, (1 - rho) / rho * p + bad AS alpha, (1 - rho) / rho * (1 - p) + n - bad AS beta
    FROM {level}_u u, {level}_r
)"""


URL_FILTERS = f"""
WITH RECURSIVE rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parsed AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
           substr(regexp_extract(r, '^[^?#]*'), length(regexp_extract(r, '^[^/?#]*')) + 1) AS path
    FROM rest
), rules(v, h, p) AS (VALUES {_rules()}),
pairs AS (
    SELECT host, path, max({{'length': length(h || p), 'verdict': v, 'rule': h || p}}) AS best
    FROM (SELECT DISTINCT host, path FROM parsed) x, rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL
), judged AS (
    SELECT page_id, parsed.host, parsed.path, best.rule AS rule, best.verdict AS ruled
    FROM parsed LEFT JOIN pairs ON parsed.host = pairs.host AND parsed.path = pairs.path
), counts AS (
    SELECT host, count(ruled) AS n, count(*) FILTER (ruled = 'block') AS bad,
           string_split(regexp_replace(regexp_extract(host, '[^@]*$'), ':[0-9]*$', ''), '.') AS l
    FROM judged GROUP BY host
), hosts AS (
    SELECT host, n, bad, array_to_string(l[-(2 + two):], '.') AS domain, array_to_string(l[-(1 + two):], '.') AS suffix
    FROM (SELECT *, CASE WHEN length(l[-1]) = 2 AND len(l) > 2 AND l[-2] IN {SECOND_LEVEL} THEN 1 ELSE 0 END AS two
          FROM counts)
), total AS (SELECT (sum(bad) + 1.0) / (sum(n) + 2.0) AS p FROM hosts),
suffixes AS (SELECT suffix, n, bad, p AS prior FROM hosts, total),
{_level('suffix', 'suffixes', 'prior')},
domains AS (
    SELECT domain, hosts.n, hosts.bad, alpha / (alpha + beta) AS prior
    FROM hosts JOIN suffix_p ON hosts.suffix = suffix_p.suffix
),
{_level('domain', 'domains', 'prior')},
named AS (
    SELECT host, hosts.n, hosts.bad, alpha / (alpha + beta) AS prior
    FROM hosts JOIN domain_p ON hosts.domain = domain_p.domain
),
{_level('host', 'named', 'prior')}
SELECT page_id, judged.host, judged.path, rule,
       coalesce(ruled, CASE WHEN alpha / (alpha + beta) - 1.645 * sqrt(alpha * beta / (pow(alpha + beta, 2) * (alpha + beta + 1)))
                            > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(n AS BIGINT) AS labelled, CAST(bad AS BIGINT) AS bad
FROM judged JOIN host_p ON judged.host = host_p.host
"""

# Contiguous runs of one to five words inside pieces, then cuts, coverage and ranks.
PHRASE_MINING = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), f AS (
    SELECT lang, m, ph, count(*) AS f FROM (
        SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: ws[i:i + m - 1])) AS ph
        FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(ws) >= m
    ) GROUP BY ALL HAVING count(*) >= 100
), totals AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
c AS (SELECT * FROM f WHERE m >= 2),
inside AS (
    SELECT lang, ph[i:i + j - 1] AS ph, max(f) AS longer
    FROM c, (SELECT unnest(range(2, 5)) AS j), (SELECT unnest(range(1, 5)) AS i) WHERE j < m AND i + j - 1 <= m GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.ph, c.f AS a, l.f AS l, r.f AS r, n,
           (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score, k
    FROM c JOIN totals USING (lang), (SELECT unnest(range(1, 5)) AS k), f l, f r
    WHERE k < c.m AND l.lang = c.lang AND r.lang = c.lang AND l.ph = c.ph[:k] AND r.ph = c.ph[k + 1:]
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1
)
SELECT b.lang, row_number() OVER w AS rank, array_to_string(b.ph, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.ph = i.ph
WHERE i.longer IS NULL OR 100 * i.longer < 100 * a
WINDOW w AS (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.ph, ' '))
QUALIFY rank <= 2000
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL_SEARCH = f"""
WITH t AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS ws
    FROM documents
), d AS (SELECT row, doc_id, len(ws) AS n, ws FROM t WHERE len(ws) > 0),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM d),
tf AS (SELECT row, doc_id, n, w, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(ws) AS w FROM d) GROUP BY ALL),
q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS w FROM benchmark
), df AS (SELECT w, count(*) AS df FROM tf WHERE w IN (SELECT w FROM q) GROUP BY w),
s AS (
    SELECT q.item_id, tf.row, tf.doc_id,
           sum(CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT)
               * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l))))::BIGINT AS score
    FROM q JOIN df ON q.w = df.w JOIN tf ON tf.w = q.w, total GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER v AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW v AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 50
"""

ORACLE = {
    "op5_exact_topk": EXACT_TOPK,
    "op7_url_filters": URL_FILTERS,
    "op9_exact_dedup": EXACT_DEDUP,
    "op11_phrase_mining": PHRASE_MINING,
    "op12_lexical_search": LEXICAL_SEARCH,
}
