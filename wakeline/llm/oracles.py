"""DuckDB SQL for the queries of this subpackage, written from their contracts."""

from __future__ import annotations

from wakeline.llm import licenses
from wakeline.llm.license_rules import read_rules, spaced

# Targets from the closed form: sorted by size / weight, the first sources are
# full, and the first one that is not gives the share of a unit of weight.
_SEGMENTS = {0: (1.5, 1.25, 0.25), 1: (1.0, 1.0, 1.0), 2: (0.25, 1.25, 1.5)}


def _inverse(rates: tuple[float, ...]) -> str:
    """The time at which the integral of a piecewise linear rate reaches x."""

    step = 1.0 / (len(rates) - 1)
    area = [(a + b) / 2 * step for a, b in zip(rates, rates[1:], strict=False)]
    whole = sum(area)
    done, cases = 0.0, []
    for i, (a, b) in enumerate(zip(rates, rates[1:], strict=False)):
        slope = (b - a) / step
        d = f"greatest(x * {whole!r}::DOUBLE - {done!r}::DOUBLE, 0::DOUBLE)"
        root = f"(sqrt(greatest({a * a!r}::DOUBLE + {2 * slope!r}::DOUBLE * {d}, 0::DOUBLE)) - {a!r}::DOUBLE) / {slope!r}::DOUBLE"
        t = f"{d} / {a!r}::DOUBLE" if slope == 0 else root
        done += area[i]
        cases.append(f"WHEN x * {whole!r}::DOUBLE <= {done!r}::DOUBLE THEN {i * step!r}::DOUBLE + least({step!r}::DOUBLE, {t})")
    return "CASE " + " ".join(cases) + " ELSE 1::DOUBLE END"


OP2 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS mark
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT AS klass FROM s),
v AS (SELECT *, klass + 1 AS weight, source_size * 3 AS most FROM w),
o AS (SELECT *, coalesce(sum(most) OVER p, 0)::BIGINT AS full_words, (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0))::BIGINT AS open_weight,
             row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS n
      FROM v WINDOW p AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT sum(source_size)::BIGINT AS words FROM s),
f AS (SELECT min(n) AS n FROM o, t WHERE (words - full_words)::DOUBLE * weight / open_weight < most),
g AS (SELECT a.full_words, a.open_weight, a.n FROM o a, f WHERE a.n = f.n),
targets AS (
  SELECT o.source, o.source_size, o.klass,
         CASE WHEN o.n < g.n THEN o.most::DOUBLE WHEN g.n IS NULL THEN 0::DOUBLE
              ELSE (t.words - g.full_words)::DOUBLE * o.weight / g.open_weight::DOUBLE END AS target
  FROM o CROSS JOIN t LEFT JOIN g ON true),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.klass, t.target,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.mark, d.doc_id, d.size) - d.size)::BIGINT AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS passes
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, passes * size + least(greatest(round(target - passes * source_size)::BIGINT - before, 0), size) AS taken FROM r),
x AS (SELECT *, CASE WHEN target > 0 THEN least(1::DOUBLE, before / target) ELSE 0::DOUBLE END AS x FROM q)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       CASE WHEN taken > 0 THEN CASE klass WHEN 0 THEN {_inverse(_SEGMENTS[0])} WHEN 1 THEN {_inverse(_SEGMENTS[1])}
            ELSE {_inverse(_SEGMENTS[2])} END END AS position
FROM x
"""


def _hits(kind: str, rank: int, pattern: str, group: int, keep: str) -> str:
    """Rows (rid, kind, r, start, stop, m) of a kind's matches, from the lengths
    of the matches and of the text between them."""

    return f"""
  SELECT rid, '{kind}' AS kind, {rank} AS r, upto - len(m) AS start, upto AS stop, m FROM (
    SELECT rid, m[i] AS m, g[i] AS g, sum(len(p[i]) + len(m[i])) OVER (PARTITION BY rid ORDER BY i)::BIGINT AS upto
    FROM (SELECT rid, p, m, g, unnest(generate_series(1, len(m))) AS i FROM (
      SELECT rid, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS m,
             regexp_extract_all(t, '{pattern}', {group}) AS g FROM d)))
  WHERE {keep}"""


_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"

_ALLOWED = (
    r"(?i)\b[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\b|abcdefghij(?:klmnopqrstuvwxyz)?|(?:0123456789)+|x{4,}"
    r"|example|placeholder|your[-_]?(?:key|token|secret)|dummy|changeme")

OP4 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
base AS ({_hits("assign", 0, _ASSIGN, 1, "len(g) >= 6")}
  UNION ALL {_hits("access", 1, "AKIA[A-Z0-9]+", 0, "len(m) >= 20")}
  UNION ALL {_hits("hex", 2, "[0-9a-f]+", 0, "len(m) >= 24")}),
cand AS ({_hits("entropy", 3, "[A-Za-z0-9+/_=-]+", 0, "len(m) >= 20")}),
cut AS (SELECT rid, start, string_split_regex(m, '{_ALLOWED}') AS p, regexp_extract_all(m, '{_ALLOWED}') AS a FROM cand),
part AS (
  SELECT rid, (start + upto - width)::BIGINT AS start, m FROM (
    SELECT *, sum(width) OVER (PARTITION BY rid, start ORDER BY i) AS upto FROM (
      SELECT rid, start, i, p[i] AS m, len(p[i]) + len(coalesce(a[i], '')) AS width
      FROM (SELECT *, unnest(generate_series(1, len(p))) AS i FROM cut)))
  WHERE len(m) >= 20),
win AS (
  SELECT rid, start, k, w, len(regexp_replace(w, '[^a-z]', '', 'g')) AS lo, len(regexp_replace(w, '[^A-Z]', '', 'g')) AS up,
         len(regexp_replace(w, '[^0-9]', '', 'g')) AS dig
  FROM (SELECT rid, start, k, substr(m, k, 20) AS w FROM (SELECT *, unnest(generate_series(1, len(m) - 19)) AS k FROM part))),
hit AS (
  SELECT rid, start + min(k) - 1 AS a, start + max(k) + 19 AS b FROM win
  WHERE list_aggregate(string_split(w, ''), 'entropy') >=
    CASE WHEN regexp_full_match(w, '[0-9A-Fa-f]+') THEN 3.05 WHEN lo > 0 AND up > 0 AND dig > 0 THEN 3.83
         WHEN (lo + dig = 20 AND dig >= 3) OR (up + dig = 20 AND dig >= 1) THEN 3.4
         WHEN lo + up = 20 AND least(lo, up) >= 8 THEN 3.83 END
  GROUP BY rid, start),
spans AS (
  SELECT rid, kind, r, start, stop FROM base
  UNION ALL SELECT rid, 'entropy', 3, a, b FROM hit
  WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.rid = hit.rid AND base.start < hit.b AND hit.a < base.stop)),
txt AS (
  SELECT rid, count(*) FILTER (r = 0) AS n_assign, count(*) FILTER (r = 1) AS n_access, count(*) FILTER (r = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, r) FILTER (r < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, r) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN txt USING (rid)
"""


def _level(name: str, members: str, parent: str, up: str) -> str:
    """The posterior means of one level of the reputation."""

    return f"""
{name}_fit AS (
  SELECT CASE WHEN k > 1 AND all_n > k AND msb + (n0 - 1) * msw > 0
              THEN least(0.999::DOUBLE, greatest(0.001::DOUBLE, (msb - msw) / (msb + (n0 - 1) * msw))) ELSE 0.1::DOUBLE END AS rho
  FROM (SELECT k, all_n, (b2 - all_bad * all_bad / all_n) / (k - 1) AS msb, (all_bad - b2) / (all_n - k) AS msw,
               (all_n - n2 / all_n) / (k - 1) AS n0
        FROM (SELECT sum(n)::DOUBLE AS all_n, sum(bad)::DOUBLE AS all_bad, count(*) AS k, sum(n * n)::DOUBLE AS n2,
                     sum(bad * bad / n::DOUBLE) AS b2 FROM {members} WHERE n > 0))),
{name}_post AS (
  SELECT m.*, 1 / rho - 1 AS strength, (m.bad + (1 / rho - 1) * p.mean) / (m.n + 1 / rho - 1) AS mean
  FROM {members} m CROSS JOIN {name}_fit JOIN {parent} p ON m.{up} = p.{up})"""


_PUBLIC = "'co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in'"

OP7 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
l AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
      FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
h0 AS (SELECT host, count(l.bad) AS n, coalesce(sum(l.bad), 0)::BIGINT AS bad FROM v LEFT JOIN l ON v.page_id = l.doc_id GROUP BY host),
h1 AS (SELECT *, string_split(host, '.') AS w FROM h0),
h2 AS (SELECT *, array_to_string(w[-2:], '.') AS two FROM h1),
hosts AS (SELECT host, n, bad, CASE WHEN two IN ({_PUBLIC}) THEN array_to_string(w[-3:], '.') ELSE two END AS domain,
                 CASE WHEN two IN ({_PUBLIC}) THEN two ELSE w[-1] END AS suffix FROM h2),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, 'all' AS top, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM domains GROUP BY ALL),
tops AS (SELECT top, (sum(bad) + 1) / (sum(n) + 2) AS mean FROM suffixes GROUP BY top),
{_level("s", "suffixes", "tops", "top")},
{_level("d", "domains", "s_post", "suffix")},
{_level("h", "hosts", "d_post", "domain")},
b AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + strength + 1)) AS bound FROM h_post),
rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                      ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT page_id, v.host, v.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT * FROM v) v JOIN rules r
    ON (v.host = r.host OR ends_with(v.host, '.' || r.host)) AND starts_with(v.path, r.path)
  GROUP BY ALL)
SELECT v.page_id, v.host, v.path, best.rule, coalesce(best.verdict, CASE WHEN b.bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM v LEFT JOIN b ON v.host = b.host LEFT JOIN best ON v.page_id IS NOT DISTINCT FROM best.page_id AND v.host = best.host AND v.path = best.path
"""


OP1 = """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
c AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT c.a, p.b FROM c JOIN p ON c.b = p.a),
m AS (SELECT a AS vec_id, min(b) AS component_id FROM c GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT m.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, m.vec_id = component_id AS kept
FROM m LEFT JOIN n USING (vec_id)
"""

OP13 = """
WITH r AS (
  SELECT row_number() OVER () AS u, vec_id, IF(vec_id % 7 = 0, (label + 1) % 10, label) AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.u AS au, a.vec_id AS anchor_id, b.u AS bu, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM r a JOIN r b ON a.u <> b.u AND len(a.x) = len(b.x) WHERE a.vec_id % 50 = 0
), p AS (
  SELECT au, bu, anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY au ORDER BY score DESC, id, bu) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.au, p.bu ORDER BY s.score DESC, s.id, s.bu) AS INTEGER) AS rank,
  s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.au = p.au AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _op12() -> str:
    rules = ", ".join(f"({r.rank}, {r.level}, '{r.label}', '{r.pattern}')" for r in read_rules())
    base = ", ".join(f"('{label}', '{spaced(phrase)}')" for phrase, label in licenses.BASE.items())
    points = " ".join(f"WHEN {k} THEN {v}" for k, v in licenses.POINTS.items())
    count = "((length({0}) - length(replace({0}, ' ', ''))) // 2)"
    return f"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS u,
    trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.SEPARATORS}', '  ', 'g'), ' ') AS t
  FROM documents
), d AS (
  SELECT doc_id, u, CASE WHEN t = '' THEN '' ELSE ' ' || t || ' ' END AS words, {count.format("words")} AS n_words FROM t
), rule(rank, level, label, pattern) AS (VALUES {rules}
), phrase(label, pattern) AS (VALUES {base}
), found AS (
  SELECT u, rank, level, label, regexp_extract_all(words, pattern) AS ms, string_split_regex(words, pattern) AS parts
  FROM d, rule WHERE regexp_matches(words, pattern)
  UNION ALL
  SELECT u, -1, -1, label, regexp_extract_all(words, pattern), string_split_regex(words, pattern)
  FROM d, phrase WHERE regexp_matches(words, pattern)
), each_ AS (
  SELECT u, rank, level, label, ms, parts, unnest(ms) AS m, generate_subscripts(ms, 1) AS i FROM found
), h AS (
  SELECT u, rank, level, label,
    CAST(list_sum(list_transform(parts[1:i], lambda p: {count.format("p")})) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: {count.format("p")})), 0) AS BIGINT) AS s,
    s + {count.format("m")} AS e
  FROM each_
), kept AS (
  SELECT * FROM h WHERE rank >= 0 AND NOT EXISTS (
    SELECT 1 FROM h g WHERE g.rank >= 0 AND g.u = h.u AND g.s <= h.s AND g.e >= h.e
      AND (g.level < h.level OR (g.level = h.level AND (g.e - g.s > h.e - h.s OR (g.e - g.s = h.e - h.s AND g.rank < h.rank)))))
), strongest AS (
  SELECT u, sum(CASE level {points} END) AS points FROM (SELECT u, label, min(level) AS level FROM kept GROUP BY ALL) GROUP BY u
), base AS (
  SELECT u, count(*) AS n, min(s) AS first_word, max(s) AS last_word, list_sort(list_distinct(list(label))) AS labels FROM h WHERE rank < 0 GROUP BY u
), spans AS (
  SELECT u, list(label) AS labels, string_agg(label || ':' || s || ':' || e, ',' ORDER BY s, e DESC, level, rank) AS detections FROM kept GROUP BY u
)
SELECT doc_id, n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(spans.labels, [])))), ',') AS labels,
  1 - pow(2.0, -least({licenses.MOST_POINTS}, coalesce(points, 0))) AS score, coalesce(detections, '') AS detections
FROM d LEFT JOIN base USING (u) LEFT JOIN spans USING (u) LEFT JOIN strongest USING (u)
"""


OP12 = _op12()
