"""SQL of the queries that SQL can express, over the same tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sums(children: str, parent: str) -> str:
    return (
        f"SELECT {parent}, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, count(*)::DOUBLE AS k, sum(n * n)::DOUBLE AS nn, "
        f"sum(bad * bad / n)::DOUBLE AS spread FROM {children} GROUP BY {parent}"
    )


def _strength(sums: str, parent: str) -> str:
    """The prior strength that the spread of the children's rates shows."""
    rho = "((spread - n * r * r) / (r * (1 - r)) - (k - 1)) / (n - nn / n - (k - 1))"
    known = "r * (1 - r) > 0 AND k > 1 AND n > nn / n + k - 1"
    return (
        f"SELECT {parent}, n, bad, CASE WHEN rho IS NULL OR rho <= 0 THEN 1000.0 ELSE greatest(1.0, least(1000.0, 1 / rho - 1)) END::DOUBLE AS s "
        f"FROM (SELECT *, CASE WHEN {known} THEN {rho} END AS rho FROM (SELECT *, bad / n AS r FROM ({sums}) a) b) c"
    )


ORACLE = {
    "op4_host_reputation": f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (
  SELECT host, CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END AS bad
  FROM h JOIN labels l ON l.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:[./]|$)', 1), '') AS BIGINT)),
hosts AS (
  SELECT host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, string_split(host, '.')[-1] AS suffix,
    array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM o GROUP BY host),
domains AS ({_strength(_sums('hosts', 'suffix, domain'), 'suffix, domain')}),
suffixes AS ({_strength(_sums('domains', 'suffix'), 'suffix')}),
root AS ({_strength(_sums('(SELECT *, 1 AS one FROM suffixes)', 'one'), 'one')}),
m1 AS (SELECT suffix, x.s AS s1, (x.bad + root.s * (root.bad + 0.5) / (root.n + 1)) / (x.n + root.s) AS m1 FROM suffixes x, root),
m2 AS (SELECT domain, d.s AS s2, (d.bad + s1 * m1) / (d.n + s1) AS m2 FROM domains d JOIN m1 USING (suffix)),
told AS (SELECT DISTINCT host, string_split(host, '.')[-1] AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain
  FROM h WHERE host <> ''),
priors AS (
  SELECT told.host, coalesce(s2, s1, root.s) AS s, coalesce(m2, m1, (root.bad + 0.5) / (root.n + 1)) AS m
  FROM told LEFT JOIN m2 ON m2.domain = told.domain LEFT JOIN m1 ON m1.suffix = told.suffix, root),
ab AS (
  SELECT p.host, coalesce(x.bad, 0) + s * m AS a, coalesce(x.n - x.bad, 0) + s * (1 - m) AS b
  FROM priors p LEFT JOIN hosts x ON x.host = p.host),
bounds AS (SELECT host, a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS bound FROM ab),
rules(verdict, rule, name, start) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
ruled AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM h JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY page_id)
SELECT h.page_id, h.host, h.path, r.rule, coalesce(r.verdict, CASE WHEN b.bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN ruled r ON r.page_id = h.page_id LEFT JOIN bounds b ON b.host = h.host""",
    "op8_curriculum_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s),
w AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, [-0.5::DOUBLE, 0.0, 0.5][rank % 3 + 1] AS slope, 2 * source_size AS cap FROM r),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
opened AS (SELECT level AS shared FROM levels WHERE level * weight <= cap ORDER BY cap / weight, rank LIMIT 1),
t AS (SELECT levels.*, least(cap::DOUBLE, coalesce(shared * weight, cap::DOUBLE)) AS target FROM levels LEFT JOIN opened ON true),
p AS (
  SELECT d.*, t.source_size, t.slope, t.target, round(t.target)::BIGINT AS wanted,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS passes FROM p),
x AS (SELECT *, greatest(0, least(size, wanted - passes * source_size - before)) AS part FROM q),
y AS (
  SELECT *, CASE WHEN size > 0 AND passes * size + part > 0
    THEN (2 * before + CASE WHEN passes > 0 THEN size ELSE part END) / (2 * wanted) END AS share FROM x)
SELECT doc_id, size, source_size, target, (passes * size + part)::BIGINT AS taken,
  CASE WHEN share <= 0 THEN 0.0::DOUBLE
    ELSE 2 * share / ((1 - slope) + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * share, 0.0))) END AS position
FROM y""",
    "op13_line_dedup": f"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM l),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM x),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
d AS (SELECT k.doc_id, line, pos, s.first IS NOT NULL AND k.doc_id > s.first AS gone FROM k LEFT JOIN s ON s.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id""",
}
