"""DuckDB SQL for the operators that SQL can express, written from the contracts, not from the Spark plans."""

from __future__ import annotations

import math

from rulecheck.llm import quality

_QUALITY = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
c AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
grams AS (
  SELECT row_no, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT row_no, ws, unnest(range(1, len(ws) - 1)) AS i FROM (SELECT row_number() OVER () AS row_no, ws FROM c))),
twice AS (SELECT row_no, i FROM (SELECT *, count(*) OVER (PARTITION BY row_no, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT row_no, count(DISTINCT j) AS n FROM (SELECT row_no, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY row_no),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(array_to_string(ws, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM (SELECT *, row_number() OVER () AS row_no FROM c) LEFT JOIN rep USING (row_no)),
s AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    {stratum} AS stratum,
    CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats
  FROM m),
told AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
held AS (
  SELECT row_number() OVER () AS id, stratum, q >= 1 AS good, symbols, dup_lines, repeats FROM s JOIN told USING (doc_id) WHERE NOT base_failed),
n_good AS (SELECT k AS stratum, count(*) FILTER (good) AS n FROM (SELECT unnest(range({strata})) AS k) LEFT JOIN held ON held.stratum = k GROUP BY k),
-- neighbouring strata until a pool has the good labels that a rule rejecting none of them needs
walk AS (
  SELECT stratum, n, 0 AS pool, n AS have FROM n_good WHERE stratum = 0
  UNION ALL SELECT g.stratum, g.n, pool + (have >= {need})::INT, CASE WHEN have >= {need} THEN g.n ELSE have + g.n END
  FROM walk JOIN n_good g ON g.stratum = walk.stratum + 1),
pool AS (
  SELECT stratum, n, CASE WHEN pool > 0 AND pool = max(pool) OVER () AND arg_max(have, stratum) OVER () < {need} THEN pool - 1 ELSE pool END AS pool FROM walk),
sizes AS (SELECT pool, sum(n)::BIGINT AS n, count(*) OVER () AS pools FROM pool GROUP BY pool),
long AS (
  SELECT id, pool, good, unnest([0, 1, 2]) AS signal, unnest([symbols, dup_lines, repeats]) AS v FROM held JOIN pool USING (stratum)),
-- the chain of each pool, from the bad documents alone: signals that reject more of them first, cutoffs that reject further ones
caught AS (
  SELECT pool, signal, cutoff, count(*) FILTER (v > cutoff) AS bad FROM long, (SELECT unnest({cutoffs}) AS cutoff) WHERE NOT good GROUP BY ALL),
gains AS (
  SELECT *, max(bad) OVER (PARTITION BY pool, signal) AS most, bad - coalesce(lag(bad) OVER (PARTITION BY pool, signal ORDER BY cutoff DESC), 0) AS more FROM caught),
chain AS (SELECT pool, signal, cutoff, row_number() OVER (PARTITION BY pool ORDER BY most DESC, signal, cutoff DESC) AS place FROM gains WHERE more > 0),
steps AS (SELECT id, pool, min(place) AS place FROM long JOIN chain USING (pool, signal) WHERE good AND v > cutoff GROUP BY id, pool),
hits AS (SELECT pool, place, count(*) AS hit FROM steps GROUP BY pool, place),
tests AS (
  SELECT pool, signal, cutoff, place, n, pools, sum(coalesce(hit, 0)) OVER (PARTITION BY pool ORDER BY place)::BIGINT AS k
  FROM chain JOIN sizes USING (pool) LEFT JOIN hits USING (pool, place)),
passed AS (
  SELECT *, CASE WHEN k < n * {a} THEN
    (SELECT sum(exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({a}) + (n - i) * ln(1 - {a})))
     FROM (SELECT unnest(range(0, k + 1)) AS i)) <= {d} / pools ELSE FALSE END AS ok
  FROM tests),
firm AS (SELECT *, bool_and(ok) OVER (PARTITION BY pool ORDER BY place) AS sure FROM passed),
cut AS (
  SELECT stratum, min(cutoff) FILTER (signal = 0) AS c1, min(cutoff) FILTER (signal = 1) AS c2, min(cutoff) FILTER (signal = 2) AS c3
  FROM firm JOIN pool USING (pool) WHERE sure GROUP BY stratum)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR coalesce(symbols > c1, FALSE) OR coalesce(dup_lines > c2, FALSE) OR coalesce(repeats > c3, FALSE)) AS kept
FROM s LEFT JOIN cut USING (stratum)
"""


def quality_sql() -> str:
    strata = " + ".join(f"(n_words >= {least})::INT" for least in quality.STRATA[1:])
    need = math.log(quality.DELTA / len(quality.STRATA)) / math.log1p(-quality.ALPHA)
    return _QUALITY.format(stratum=strata, strata=len(quality.STRATA), cutoffs=quality.CUTOFFS, need=f"{need!r}::DOUBLE",
                           a=f"{quality.ALPHA!r}::DOUBLE", d=f"{quality.DELTA!r}::DOUBLE")


_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, coalesce(role, '') AS r,
    length(replace(text, '\', '\\')) + len(regexp_extract_all(replace(text, '\', '\\'), '<(?:\||/?s>|</?SYS>>)|\[/?INST\]')) AS escaped
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|><|im_sep|><|im_end|>') + 1 + length(r) + escaped)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_MERKLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text
  FROM documents WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (
  SELECT *, length(text) AS n_chars,
    left(text, (length(text) - length(text) // 2)::BIGINT) || left(next_text, (length(text) // 2)::BIGINT) AS edited FROM d),
f AS (
  SELECT *, {root_text} AS fingerprint, {root_edited} AS edited_fingerprint, {root_next} AS next_fingerprint,
    {tree_text} AS ts, {tree_edited} AS es, {blocks_text} AS b, {blocks_edited} AS eb, {blocks_next} AS nb
  FROM e),
g AS (
  SELECT *, list_position(list_transform(range(1, greatest(len(ts), len(es)) + 1), lambda i: ts[i] IS DISTINCT FROM es[i]), TRUE) AS sec FROM f)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN fingerprint = edited_fingerprint THEN 1.0 WHEN len(b) + len(eb) = 0 THEN 0.0
    ELSE 2.0::DOUBLE * len(list_intersect(b, eb)) / (len(b) + len(eb)) END::DOUBLE AS near_edited,
  CASE WHEN fingerprint = next_fingerprint THEN 1.0 WHEN len(b) + len(nb) = 0 THEN 0.0
    ELSE 2.0::DOUBLE * len(list_intersect(b, nb)) / (len(b) + len(nb)) END::DOUBLE AS near_next,
  CASE WHEN fingerprint <> edited_fingerprint THEN sec - 1 END::INT AS edited_section,
  CASE WHEN fingerprint <> edited_fingerprint THEN greatest(0, list_position(list_transform(
    range(1, greatest(len(coalesce(ts[sec], [])), len(coalesce(es[sec], []))) + 1), lambda j: ts[sec][j] IS DISTINCT FROM es[sec][j]), TRUE) - 1) END::INT AS edited_paragraph
FROM g
"""


def merkle_sql() -> str:
    from rulecheck.llm.merkle import BLOCK

    parts = {}
    for name, c in (("text", "text"), ("edited", "edited"), ("next", "next_text")):
        tree = f"list_transform(string_split({c}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: sha256('p:' || p)))"
        parts[f"tree_{name}"] = tree
        parts[f"root_{name}"] = f"sha256('r:' || array_to_string(list_transform({tree}, lambda ps: sha256('s:' || array_to_string(ps, ','))), ','))"
        parts[f"blocks_{name}"] = f"list_distinct(regexp_extract_all({c}, '{BLOCK}'))"
    return _MERKLE.format(**parts)


_HOSTS = r"""
WITH RECURSIVE u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
told AS (
  SELECT doc_id, max(coalesce(quality = 0, FALSE) OR coalesce(toxic = 1, FALSE)) AS bad FROM labels
  WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
h AS (
  SELECT host, count(*) AS pages, count(bad) AS n, count(*) FILTER (bad) AS bad,
    regexp_replace(regexp_replace(host, '(?s)^.*@', ''), '\.*(:[0-9]*)?$', '') AS name
  FROM u LEFT JOIN told ON told.doc_id = u.page_id GROUP BY host),
l AS (SELECT *, string_split(name, '.') AS ls, regexp_matches(name, '^([0-9]+(\.[0-9]+)<3>|\[.*)$') AS address FROM h),
d2 AS (SELECT *, array_to_string(ls[-2:], '.') IN (<suffixes>) AS two FROM l),
g AS (
  SELECT host, pages, n, bad, CASE WHEN address THEN '' WHEN two THEN array_to_string(ls[-2:], '.') ELSE ls[-1] END AS suffix,
    CASE WHEN address THEN name WHEN two THEN array_to_string(ls[-3:], '.') ELSE array_to_string(ls[-2:], '.') END AS domain
  FROM d2),
dom AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM g GROUP BY ALL),
suf AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM dom GROUP BY ALL),
top AS (SELECT (sum(bad) + 0.5)::DOUBLE / (sum(n) + 1) AS mean FROM suf),
r1 AS (
  SELECT coalesce(least(<most>, greatest(<least>, (sum(n * (bad / n - mean) ** 2 / (mean * (1 - mean))) - count(*)) / nullif(sum(n - 1), 0))), <most>) AS rho
  FROM suf, top WHERE n > 0),
sr AS (SELECT suffix, (bad + mean * (1 / rho - 1)) / (n + 1 / rho - 1) AS mean FROM suf, top, r1),
dm AS (SELECT domain, n, bad, mean FROM dom JOIN sr USING (suffix)),
r2 AS (
  SELECT coalesce(least(<most>, greatest(<least>, (sum(n * (bad / n - mean) ** 2 / (mean * (1 - mean))) - count(*)) / nullif(sum(n - 1), 0))), <most>) AS rho
  FROM dm WHERE n > 0),
dr AS (SELECT domain, (bad + mean * (1 / rho - 1)) / (n + 1 / rho - 1) AS mean FROM dm, r2),
hm AS (SELECT host, n, bad, mean FROM g JOIN dr USING (domain)),
r3 AS (
  SELECT coalesce(least(<most>, greatest(<least>, (sum(n * (bad / n - mean) ** 2 / (mean * (1 - mean))) - count(*)) / nullif(sum(n - 1), 0))), <most>) AS rho
  FROM hm WHERE n > 0),
post AS (SELECT host, bad + mean * (1 / rho - 1) AS a, n - bad + (1 - mean) * (1 / rho - 1) AS b FROM hm, r3),
side AS (
  SELECT host, <limit> > (a + 1) / (a + b + 2) AS turned,
    CASE WHEN <limit> > (a + 1) / (a + b + 2) THEN b ELSE a END AS p, CASE WHEN <limit> > (a + 1) / (a + b + 2) THEN a ELSE b END AS q,
    CASE WHEN <limit> > (a + 1) / (a + b + 2) THEN 1 - <limit> ELSE <limit> END AS z FROM post),
-- the continued fraction of the incomplete beta function, from its tail up: 400 levels
fraction AS (
  SELECT host, turned, p, q, z, 400 AS m, 1.0::DOUBLE AS f FROM side
  UNION ALL
  SELECT host, turned, p, q, z, m - 1,
    1 - (p + m - 1) * (p + q + m - 1) * z / ((p + 2 * m - 2) * (p + 2 * m - 1)) / (1 + m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)) / f)
  FROM fraction WHERE m > 0),
sure AS (
  SELECT host, CASE WHEN turned THEN 1 - t ELSE t END AS sureness FROM (
    SELECT host, turned, exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * ln(z) + q * ln(1 - z)) / p / f AS t FROM fraction WHERE m = 0)),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN sureness >= <confidence> THEN 'allow' ELSE 'block' END AS verdict, g.n AS host_labelled, g.bad AS host_bad
FROM ruled JOIN g USING (host) JOIN sure USING (host)
"""


def hosts_sql() -> str:
    from rulecheck.llm import url_filter

    values = {"suffixes": ", ".join(f"'{s}'" for s in url_filter.SUFFIXES), "3": "{3}", "limit": f"{url_filter.LIMIT!r}::DOUBLE",
              "most": f"{url_filter.MOST_RHO!r}::DOUBLE", "least": f"{url_filter.LEAST_RHO!r}::DOUBLE", "confidence": url_filter.CONFIDENCE}
    out = _HOSTS
    for k, v in values.items():
        out = out.replace(f"<{k}>", str(v))
    return out


_CODES = r"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r, * FROM whole),
parts AS MATERIALIZED (SELECT r, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS x FROM kept, range(16) AS t(p)),
b0 AS (SELECT p, r AS e, x AS c FROM parts WHERE r < 64)
<rounds>,
last AS MATERIALIZED (
  SELECT r, a.p, min(list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - c[j]) * (x[j] - c[j])))::BIGINT * 64 + e) AS best
  FROM parts a JOIN b2 b ON a.p = b.p GROUP BY r, a.p),
coded AS (
  SELECT r, string_agg(format('{:02x}', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM last GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""

_CODES_ROUND = r""",
n<k> AS MATERIALIZED (
  SELECT r, a.p, x, min(list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - c[j]) * (x[j] - c[j])))::BIGINT * 64 + e) % 64 AS e
  FROM parts a JOIN b<k> b ON a.p = b.p GROUP BY r, a.p, x),
m<k> AS (
  SELECT p, e, j, sum(x[j])::BIGINT AS s, count(*)::BIGINT AS n FROM n<k>, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS j) GROUP BY p, e, j),
b<next> AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(list((s - ((s % n) + n) % n) // n ORDER BY j) FILTER (s IS NOT NULL), any_value(c)) AS c
  FROM b<k> b LEFT JOIN m<k> m ON m.p = b.p AND m.e = b.e GROUP BY b.p, b.e)"""


def codes_sql() -> str:
    return _CODES.replace("<rounds>", "".join(_CODES_ROUND.replace("<k>", str(k)).replace("<next>", str(k + 1)) for k in range(2)))


_RUNS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
  FROM documents),
a AS (
  SELECT r, doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a, (h // 10) % 8 AS g FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + g) AS p FROM a),
w AS MATERIALIZED (
  SELECT r, i, CASE WHEN planted AND i >= a THEN ws[1 + a + (i - a) % p] ELSE ws[1 + i] END AS word, n
  FROM (SELECT r, ws, n, planted, a, p, unnest(range(n)) AS i FROM p)),
-- a run shares at least 16 words with itself one period on: eight of them start at a multiple of eight
grams AS MATERIALIZED (
  SELECT r, i, n, CASE WHEN i + 8 <= n THEN md5_number(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)) END AS gram FROM w),
periods AS (
  SELECT DISTINCT x.r, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i AND y.i - x.i <= x.n // 3
  WHERE x.i % 8 = 0),
same AS (
  SELECT x.r, q, x.i, x.i - row_number() OVER (PARTITION BY x.r, q ORDER BY x.i) AS island
  FROM periods JOIN w x USING (r) JOIN w y ON y.r = x.r AND y.i = x.i + q AND y.word = x.word),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY r, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
best AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
strongest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY length / period DESC, start, period) AS k FROM runs) WHERE k = 1),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM w ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (r) LEFT JOIN strongest USING (r) LEFT JOIN kept USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_merkle_fingerprints": merkle_sql(), "op7_event_sourced_chat": _CHAT, "op9_risk_controlled_rules": quality_sql(),
            "op11_host_reputation": hosts_sql(), "op12_periodic_runs": _RUNS, "op13_cover_tree_codes": codes_sql()}
