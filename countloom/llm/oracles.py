"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from countloom.llm.host_reputation import RULES, SUFFIXES

_SIZE = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))"
#: Inverse of the cumulative demand c (0 to 1) of the three schedules, from their areas.
_AT = """round(CASE rank % 3
    WHEN 0 THEN 2 * c / (1.5 + sqrt(greatest(0.0, 2.25 - 2 * c)))
    WHEN 1 THEN c
    ELSE CASE WHEN c <= 0.3125 THEN 2 * c / (0.5 + sqrt(0.25 + c)) ELSE least(1.0, 0.5 + 2 * (c - 0.3125) / (0.75 + sqrt(0.5625 + 5 * (c - 0.3125)))) END END, 9)"""
MIXING = f"""WITH d AS (SELECT doc_id, source, {_SIZE} AS size, md5(coalesce(doc_id::varchar, '')) AS spot FROM documents),
    s AS (SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM s),
    w AS (SELECT *, [3::double, 1::double, 2::double][rank % 3 + 1] AS weight, 2 * source_size AS lim FROM r),
    o AS (SELECT *, coalesce(sum(lim) OVER before, 0)::double AS filled, coalesce(sum(weight) OVER before, 0)::double AS gone FROM w
        WINDOW before AS (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (SELECT sum(source_size)::double * 1.5::double AS whole, sum(weight) AS weights FROM w),
    rate AS (SELECT min_by((whole - filled) / (weights - gone), (lim / weight, rank)) AS rate FROM o, t WHERE (whole - filled) / (weights - gone) * weight <= lim),
    goal AS (SELECT source, source_size, rank, least(lim::double, coalesce(rate * weight, lim::double)) AS target FROM w, rate),
    stream AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS start0 FROM d),
    passes AS (SELECT doc_id, size, source_size, target, rank, k, source_size * k + start0 AS start FROM stream JOIN goal ON stream.source IS NOT DISTINCT FROM goal.source CROSS JOIN (SELECT unnest([0, 1]) AS k)),
    took AS (SELECT *, least(size, greatest(0, floor(target)::bigint - start)) AS take, start / target AS c FROM passes),
    placed AS (SELECT *, CASE WHEN take > 0 THEN {_AT} END AS moment FROM took)
    SELECT doc_id, max(size)::bigint AS size, max(source_size) AS source_size, max(target) AS target, sum(take)::bigint AS taken, count(*) FILTER (WHERE take > 0)::int AS passes,
        min(moment) AS position, coalesce(list(moment ORDER BY k) FILTER (WHERE take > 0), []) AS positions FROM placed GROUP BY doc_id"""


def _rules(column: str) -> str:
    """The longest rule that fits, as one CASE."""
    whens = " ".join(
        f"WHEN (host = '{site}' OR ends_with(host, '.{site}')) AND starts_with(path, '{start}') THEN '{site + start if column == 'rule' else says}'"
        for site, start, says in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    )
    return f"CASE {whens} END"


def _fitted(counts: str, by: str, mean: str) -> str:
    """Beta prior of the members of each group by the method of moments."""
    return f"""SELECT {by}, m * k AS a, (1 - m) * k AS b, CASE WHEN members > 1 THEN 1.0::double ELSE 0.2::double END AS w FROM (SELECT *, CASE WHEN members > 1 THEN 1 / greatest(1 / 201::double, least(0.5::double, (s / greatest(m * (1 - m), 1e-9::double) - members) / greatest(n - members, 1.0::double))) - 1 ELSE 10 END AS k
        FROM (SELECT {by}, {mean} AS m, count(*)::double AS members, sum(n) AS n, sum(n * pow(bad / n - {mean}, 2)) AS s FROM {counts} GROUP BY {by}, {mean}))"""


_WIDE = "(" + ", ".join(f"'{s}'" for s in SUFFIXES) + ")"
_LEVELS = f"""SELECT *, CASE WHEN two IN {_WIDE} THEN two ELSE labels[-1] END AS suffix, CASE WHEN two IN {_WIDE} THEN array_to_string(labels[-3:], '.') ELSE two END AS domain
    FROM (SELECT *, array_to_string(labels[-2:], '.') AS two FROM (SELECT *, string_split(regexp_replace(string_split(host, '@')[-1], ':[0-9]*$', ''), '.') AS labels FROM {{}}))"""
REPUTATION = f"""WITH p0 AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM p0),
    shown AS (SELECT host, try_cast(nullif(regexp_extract(path, '/(\\d{{1,18}})(?:\\.html|/)?$', 1), '') AS bigint) AS doc_id FROM p),
    h0 AS (SELECT host, count(*)::double AS n, sum((quality IS NOT DISTINCT FROM 0 OR toxic IS NOT DISTINCT FROM 1)::int)::double AS bad FROM shown JOIN labels USING (doc_id) GROUP BY 1),
    h AS ({_LEVELS.format("h0")}),
    whole AS (SELECT (coalesce(sum(bad), 0) + 0.5::double) / (coalesce(sum(n), 0) + 1) AS share FROM h),
    s AS (SELECT 1 AS one, suffix, sum(n) AS n, sum(bad) AS bad, any_value(share) AS share FROM h, whole GROUP BY suffix),
    top AS (SELECT coalesce(a, share * 10) AS a, coalesce(b, (1 - share) * 10) AS b, coalesce(w, 0.2::double) AS w FROM whole LEFT JOIN ({_fitted("s", "one", "share")}) ON true),
    dm AS (SELECT suffix, domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value((s.bad + top.a) / (s.n + top.a + top.b)) AS m FROM h JOIN s USING (suffix), top GROUP BY ALL),
    sp AS ({_fitted("dm", "suffix", "m")}),
    hm AS (SELECT h.host, domain, h.n, h.bad, (dm.bad + sp.a) / (dm.n + sp.a + sp.b) AS m FROM h JOIN dm USING (suffix, domain) JOIN sp USING (suffix)),
    dp AS ({_fitted("hm", "domain", "m")}),
    hp AS (SELECT host, bad + a AS a, n - bad + b AS b FROM hm JOIN dp USING (domain)),
    asked AS ({_LEVELS.format("(SELECT DISTINCT host FROM p WHERE host <> '')")}),
    rep AS (SELECT host, CASE WHEN hp.a IS NOT NULL THEN 'host' WHEN dp.a IS NOT NULL THEN 'domain' WHEN sp.a IS NOT NULL THEN 'suffix' ELSE 'top' END AS level, coalesce(hp.a, dp.a * dp.w, sp.a * sp.w, top.a * top.w) AS a, coalesce(hp.b, dp.b * dp.w, sp.b * sp.w, top.b * top.w) AS b
        FROM asked LEFT JOIN hp USING (host) LEFT JOIN dp USING (domain) LEFT JOIN sp USING (suffix), top),
    m AS (SELECT host, level, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS sd FROM rep),
    j AS (SELECT page_id, host, path, {_rules("rule")} AS rule, {_rules("verdict")} AS says, mean, sd, mean - 1.645::double * sd AS bound, level FROM p LEFT JOIN m USING (host))
    SELECT page_id, host, path, rule, coalesce(says, CASE WHEN coalesce(bound, 0) > 0.25 THEN 'block' ELSE 'allow' END) AS verdict,
        round(mean, 9) AS bad_mean, round(sd, 9) AS bad_sd, round(bound, 9) AS bad_bound, level AS bad_level FROM j"""
SQL: dict[str, str] = {"op7_mixing": MIXING, "op8_host_reputation": REPUTATION}
