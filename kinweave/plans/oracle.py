"""SQL twins of the queries, for an independent engine over the same tables."""

from __future__ import annotations

from kinweave.functions import text as X


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g'))"


def latin(x: str) -> str:
    out = f"translate({x}, {quoted(X.LATIN_FROM)}, {quoted(X.LATIN_TO)})"
    for a, b in X.LATIN_WIDE.items():
        out = f"replace({out}, {quoted(a)}, {quoted(b)})"
    return norm(out)


def md5_long(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 15))::BIGINT"


#: The records adapter over ``documents`` as common table expressions: rec, and truth (q, t).
RECORDS = f"""
rec0 AS (
  SELECT 'train' AS split, 'S' || (doc_id % 3 + 1) || '-' || lpad(doc_id::VARCHAR, greatest(6, length(doc_id::VARCHAR))::INT, '0') AS id, (doc_id % 3 + 1)::INT AS source,
         coalesce(lang, '') AS country, substr(coalesce(text, ''), 1, 60) AS raw_name, substr(coalesce(text, ''), 61, 80) AS raw_address,
         md5(coalesce(text, '')) AS content
  FROM documents WHERE doc_id IS NOT NULL),
rec1 AS (SELECT *, {norm("raw_name")} AS name, {norm("raw_address")} AS address FROM rec0),
rec AS (SELECT *, {latin("name")} AS latin_name, {latin("address")} AS latin_address FROM rec1),
owner AS (SELECT content, min(id) AS q FROM rec WHERE source = 1 GROUP BY content),
truth AS (SELECT q, id AS t FROM rec JOIN owner USING (content) WHERE source IN (2, 3))
"""

_NUMBERS = "list_distinct(regexp_extract_all({x}, '(\\p{{Nd}}+)', 1))"


def numbers(x: str) -> str:
    return _NUMBERS.format(x=x)


def longest(words: str, n: int) -> str:
    return f"list_transform(list_sort(list_transform(list_distinct({words}), lambda w: {{'l': -length(w), 'w': w}}))[1:{n}], lambda s: s.w)"


def record_keys(country_block: bool) -> str:
    """Expressions rk (id, view, key), after RECORDS."""
    lead = "country || '|' || " if country_block else ""
    return f"""
rk0 AS (
  SELECT id, country, latin_name AS nm,
         {longest("list_filter(string_split(latin_name, ' '), lambda w: length(w) > 1)", 4)} AS nw,
         {longest("list_filter(string_split(latin_address, ' '), lambda w: length(w) > 2 AND NOT regexp_full_match(w, '[0-9]+'))", 4)} AS aw,
         list_sort({numbers("latin_address")})[1:2] AS nums, replace(latin_name, ' ', '') AS tight, source
  FROM rec),
rk1 AS (
  SELECT *, list_transform(list_sort(list_transform(list_distinct(list_transform(range(1, greatest(length(tight) - 1, 1)), lambda i: substr(tight, i, 3))), lambda g: {{'h': md5(g), 'g': g}}))[1:4], lambda s: s.g) AS gs
  FROM rk0),
rk2 AS (
  SELECT id, source, country, 0 AS view, unnest(list_distinct(list_concat(
           CASE WHEN nm != '' THEN ['N:' || nm] ELSE [] END, list_transform(nw, lambda w: 'W:' || w),
           list_transform(list_filter([2, 3, 4], lambda j: len(nw) >= j), lambda j: 'P:' || least(nw[1], nw[j]) || ':' || greatest(nw[1], nw[j])),
           list_transform(gs, lambda g: 'G:' || g)))) AS key FROM rk1
  UNION ALL SELECT id, source, country, 1, unnest(list_transform(aw, lambda w: 'A:' || w)) FROM rk1
  UNION ALL SELECT id, source, country, 2, unnest(list_distinct(list_concat(
           flatten(list_transform(nums, lambda x: list_transform(nw[1:2], lambda w: 'J:' || x || ':' || w))),
           flatten(list_transform(nums, lambda x: list_transform(aw[1:2], lambda w: 'H:' || x || ':' || w)))))) FROM rk1),
rk AS (SELECT id, source, view, {lead}key AS key FROM rk2)
"""


def candidates(k: int, cap: int, country_block: bool = True) -> str:
    """Expressions cand (q, t, s_*, r_*), after RECORDS."""
    return record_keys(country_block) + f""",
sizes AS (SELECT key, count(*) AS n FROM rk WHERE source IN (2, 3) GROUP BY key HAVING count(*) <= {cap}),
found AS (
  SELECT a.id AS q, b.id AS t, a.view, a.key, ln(1 + (SELECT count(*) FROM rec WHERE source IN (2, 3)) / s.n) AS w
  FROM rk a JOIN sizes s ON a.key = s.key JOIN rk b ON b.key = a.key AND b.source IN (2, 3) WHERE a.source = 1),
own AS (SELECT q, view, sum(w) AS all_w FROM (SELECT DISTINCT q, view, key, w FROM found) GROUP BY q, view),
got AS (SELECT q, t, view, round(sum(w) / greatest(any_value(all_w), 1e-9), 6) AS s FROM found JOIN own USING (q, view) GROUP BY q, t, view),
wide AS (SELECT q, t, coalesce(max(s) FILTER (view = 0), 0) AS s0, coalesce(max(s) FILTER (view = 1), 0) AS s1, coalesce(max(s) FILTER (view = 2), 0) AS e2 FROM got GROUP BY q, t),
longs AS (
  SELECT q, t, 0 AS view, s0 AS s FROM wide UNION ALL SELECT q, t, 1, s1 FROM wide
  UNION ALL SELECT q, t, 2, round(s0 * 0.4::DOUBLE + s1 * 0.3::DOUBLE + e2 * 0.3::DOUBLE, 6) FROM wide),
""" + merged(k)


def merged(k: int) -> str:
    """Expressions cand from longs (q, t, view, s)."""
    names = ("name", "address", "combined")
    picks = [f"coalesce(max({x}) FILTER (view = {v}), 0) AS {p}_{n}" for p, x in (("s", "s"), ("r", "1.0::DOUBLE / rank")) for v, n in enumerate(names)]
    return f"""
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q, view ORDER BY s DESC, t) AS rank FROM longs WHERE s > 0) WHERE rank <= {k}),
cand AS (SELECT q, t, {', '.join(picks)} FROM hits GROUP BY q, t)
"""


def with_records(*parts: str, select: str) -> str:
    return "WITH " + ", ".join([RECORDS.strip(), *(p.strip() for p in parts)]) + "\n" + select


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two texts of up to 125 characters, by a row of bits that is worked on character by character."""
    where = f"list_transform(string_split({b}, ''), lambda c: list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN {a}[i] = c THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END))::HUGEINT)"
    full = f"((1::HUGEINT << length({a})::INT) - 1)"
    step = f"lambda r, h: ((r + (r & h)) | (r - (r & h))) & {full}"
    return f"(length({a}) - bit_count(list_reduce(list_prepend({full}, {where}), {step})))"


def similarities() -> str:
    """Expressions sims (q, t, k, s): the eight string similarities, after cand."""
    words = lambda x: f"list_filter(string_split({x}, ' '), lambda w: w != '')"
    return f"""
sides AS (
  SELECT cand.q, cand.t, f.f AS f, f.a AS a, f.b AS b FROM cand JOIN rec x ON x.id = cand.q JOIN rec y ON y.id = cand.t,
  LATERAL (VALUES ('name', x.latin_name, y.latin_name), ('addr', x.latin_address, y.latin_address), ('unicode_name', x.name, y.name), ('unicode_addr', x.address, y.address)) f(f, a, b)),
texts AS (SELECT *, list_sort({words("a")}) AS wa, list_sort({words("b")}) AS wb FROM (SELECT DISTINCT f LIKE 'u%' AS plain, a, b FROM sides WHERE a != '' AND b != '')),
sets AS (SELECT *, list_sort(list_filter(list_distinct(wa), lambda w: list_contains(wb, w))) AS com, list_sort(list_filter(list_distinct(wa), lambda w: NOT list_contains(wb, w))) AS la, list_sort(list_filter(list_distinct(wb), lambda w: NOT list_contains(wa, w))) AS lb FROM texts WHERE NOT plain),
jobs AS (
  SELECT plain, a, b, 'ratio' AS k, a AS x, b AS y FROM texts
  UNION ALL SELECT plain, a, b, 'token_sort', array_to_string(wa, ' '), array_to_string(wb, ' ') FROM texts WHERE NOT plain
  UNION ALL SELECT plain, a, b, 'token_set', '=', '=' FROM sets WHERE len(com) > 0 AND (len(la) = 0 OR len(lb) = 0)
  UNION ALL SELECT plain, a, b, 'token_set', array_to_string(list_concat(com, la), ' '), array_to_string(list_concat(com, lb), ' ') FROM sets WHERE len(com) = 0 OR (len(la) > 0 AND len(lb) > 0)
  UNION ALL SELECT plain, a, b, 'token_set', array_to_string(com, ' '), array_to_string(list_concat(com, u.o), ' ') FROM sets, LATERAL (VALUES (la), (lb)) u(o) WHERE len(com) > 0 AND len(la) > 0 AND len(lb) > 0),
told AS (SELECT x, y, CASE WHEN x = y THEN 1 ELSE 2.0::DOUBLE * {_lcs("x", "y")} / (length(x) + length(y)) END AS s FROM (SELECT DISTINCT x, y FROM jobs)),
best AS (SELECT plain, a, b, k, max(s) AS s FROM jobs JOIN told USING (x, y) GROUP BY ALL),
sims AS (SELECT sides.q, sides.t, sides.f || '_' || best.k AS k, best.s AS s FROM sides JOIN best ON best.a = sides.a AND best.b = sides.b AND best.plain = (sides.f LIKE 'u%'))
"""
