"""SQL that gives the same rows as a query, for those that SQL can express over whole tables."""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), " + _LOWER + r"), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _shingles(source: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, unnest(list_transform(range(1, CAST(greatest(2, len(w) - 3) AS BIGINT)), lambda k: array_to_string(w[k:k + 4], ' '))) AS s, least(len(w), 5) AS width
FROM (SELECT {key}, {_WORDS} AS w FROM {source}) WHERE len(w) > 0"""


#: The benchmark's items all have five words or more, so every shingle is five words wide.
OP6 = f"""WITH d AS ({_shingles("documents", "doc_id")}), i AS ({_shingles("benchmark", "item_id")}), n AS (SELECT item_id, COUNT(*) AS n_item FROM i GROUP BY 1)
SELECT doc_id, item_id, n_item, COUNT(*) AS n_shared, round(COUNT(*) / n_item, 6) AS containment FROM d JOIN i USING (s, width) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING COUNT(*) >= 0.75 * n_item"""

_RULES = (("example.org", "/en/1", "block"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("org", "/", "allow"))


def _case(what) -> str:
    return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{what(h, p, v)}'" for h, p, v in _RULES) + " END"


def _strength(parent: str, source: str) -> str:
    """Groups (bad, n, m) below each parent to (parent, strength)."""
    return f"""SELECT {parent}, CASE WHEN rho <= 0 THEN 200.0 ELSE least(200.0, greatest(1.0, 1 / rho - 1)) END AS s FROM (
SELECT {parent}, CASE WHEN mm * (1 - mm) > 0 AND nn / g > 1 THEN ((ss / nn) * (nn / g) / (mm * (1 - mm)) - 1) / (nn / g - 1) ELSE 0.0 END AS rho FROM (
SELECT {parent}, SUM(n * (bad / n - m) * (bad / n - m)) AS ss, SUM(n) AS nn, COUNT(*) AS g, MAX(m) AS mm FROM ({source}) GROUP BY 1))"""


_WORDS_BAD = "['adult', 'ads', 'bets', 'casino', 'pills', 'poker', 'porn', 'spam', 'viagra', 'xxx']"
_SHARED, _ADDRESS = r"'(^|\.)(ac|co|com|edu|gov|net|org)\.[a-z]{2}$'", r"'^[0-9]+(\.[0-9]+){3}$|^\['"


def _bad_words(column: str) -> str:
    return f"len(list_intersect(list_distinct(regexp_split_to_array(translate(coalesce({column}, ''), {_LOWER}), '[^a-z]+')), {_WORDS_BAD}))"


def _last(n: int) -> str:
    return f"array_to_string(string_split(name, '.')[-{n}:], '.')"


#: The standard normal distribution's 0.1 quantile.
_Z = "CAST(-1.2815515655446008 AS DOUBLE)"
_BOUND = f"""greatest(0, least(a / n, a / n + sqrt(a * b / (n + 1)) / n * ({_Z} + ({_Z} * {_Z} - 1) / 6 * skew
  + (pow({_Z}, 3) - 3 * {_Z}) / 24 * (6 * ((a - b) * (a - b) * (n + 1) - a * b * (n + 2)) / (a * b * (n + 2) * (n + 3))) - (2 * pow({_Z}, 3) - 5 * {_Z}) / 36 * skew * skew)))"""

_POST = "(h.bad + m * s) AS alpha, (h.n - h.bad + (1 - m) * s) AS beta"
OP3 = rf"""WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
  CASE WHEN {_bad_words("url")} > 0 OR {_bad_words("html")} >= 3 THEN 1 ELSE 0 END AS bad FROM pages),
v AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), '\.*(:[0-9]*)?$', '') AS name FROM u),
p AS (SELECT *, CASE WHEN regexp_matches(name, {_ADDRESS}) THEN name WHEN regexp_matches(name, {_SHARED}) THEN {_last(3)} ELSE {_last(2)} END AS domain,
  CASE WHEN regexp_matches(name, {_ADDRESS}) THEN '(address)' WHEN regexp_matches(name, {_SHARED}) THEN {_last(2)} ELSE {_last(1)} END AS suffix FROM v),
r AS (SELECT *, {_case(lambda h, p, v: h + p)} AS rule, {_case(lambda h, p, v: v)} AS ruled FROM p),
hosts AS (SELECT name, domain, suffix, CAST(SUM(bad) AS DOUBLE) AS bad, CAST(COUNT(*) AS DOUBLE) AS n FROM r GROUP BY 1, 2, 3),
domains AS (SELECT domain, suffix, SUM(bad) AS bad, SUM(n) AS n FROM hosts GROUP BY 1, 2), suffixes AS (SELECT suffix, SUM(bad) AS bad, SUM(n) AS n FROM domains GROUP BY 1),
root AS (SELECT (coalesce(SUM(bad), 0) + 1.0::DOUBLE) / (coalesce(SUM(n), 0) + 2.0::DOUBLE) AS m FROM suffixes),
rs AS ({_strength("k", "SELECT 0 AS k, bad, n, m FROM suffixes, root")}),
ps AS (SELECT suffix, {_POST} FROM suffixes h, root, rs), ms AS (SELECT suffix, alpha / (alpha + beta) AS m FROM ps),
ss AS ({_strength("suffix", "SELECT d.suffix, bad, n, m FROM domains d JOIN ms USING (suffix)")}), sp AS (SELECT suffix, m, s FROM ms JOIN ss USING (suffix)),
pd AS (SELECT domain, {_POST} FROM domains h JOIN sp USING (suffix)), md AS (SELECT domain, alpha / (alpha + beta) AS m FROM pd),
ds AS ({_strength("domain", "SELECT h.domain, bad, n, m FROM hosts h JOIN md USING (domain)")}), dp AS (SELECT domain, m, s FROM md JOIN ds USING (domain)),
ph AS (SELECT name, {_POST} FROM hosts h JOIN dp USING (domain)),
z AS (SELECT name, alpha AS a, beta AS b, alpha + beta AS n, 2 * (beta - alpha) * sqrt(alpha + beta + 1) / ((alpha + beta + 2) * sqrt(alpha * beta)) AS skew FROM ph),
y AS (SELECT name, round(a / n, 6) AS rate, round({_BOUND}, 6) AS bound FROM z)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN bound > 0.6 THEN 'block' ELSE 'allow' END) AS verdict, CASE WHEN ruled IS NULL THEN rate END AS bad_rate, CASE WHEN ruled IS NULL THEN bound END AS bad_bound FROM r JOIN y USING (name)"""

OP9 = f"""WITH RECURSIVE s AS ({_shingles("documents", "doc_id")}), n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.width = b.width AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN ways b ON r.m = b.x)
SELECT r.doc_id, coalesce(MAX(n.n), 0) AS n_shingles, MIN(r.m) AS component_id FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY 1"""
