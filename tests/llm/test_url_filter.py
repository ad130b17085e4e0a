"""Host reputation against plain Python: url parts, rules, empirical-Bayes levels, the beta tail, and the query's SQL."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rulecheck.llm import oracles, url_filter
from rulecheck.llm.url_filter import Rule

SF = "/root/testdata/sf0.001"
URLS = ["https://A.Example.COM/en/x?y#z", "http://example.com", "http://example.com?x/en/", "http://com/", "https://notexample.com/en/",
        "http://www.example.com/en", "http://www.example.com/en/", "http://m.www.example.com/en/a", "ftp://x.net/es/1", "http://net/fr/", "x.net/es/",
        "//a.net/fr/", "", None, "http://", "http://example.com:8080/en/", "http://u:p@Example.net/fr/a#b?c", "a\nb://Host.ORG/p\nq?x", "http://É.Org/ü://b/c",
        "http://1.2.3.4/fr/", "http://[::1]:80/x", "http://a.b.co.uk/", "http://co.uk", "http://example.net./es/"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, re.split("[?#]", rest[cut:], maxsplit=1)[0]


def fitting(host, path, rules):
    found = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(found, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)


def beta_tail(x, a, b, steps=200_000):
    """The integral of the beta density up to x by midpoints of t = s^k, which is smooth at zero for small a."""
    k = max(1.0, 3 / a)
    s = (np.arange(steps) + 0.5) / steps * x ** (1 / k)
    t = s ** k
    log = (a - 1) * np.log(t) + (b - 1) * np.log1p(-t) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + math.log(k) + (k - 1) * np.log(s)
    return float(np.exp(log).sum() / steps * x ** (1 / k))


def test_beta_below():
    rng = random.Random(8)
    a = np.array([0.2, 0.5, 1, 1, 2, 30, 400, 3_000, 0.3, 90] + [rng.uniform(0.1, 60) for _ in range(20)])
    b = np.array([0.5, 0.5, 1, 7, 2, 70, 900, 9_000, 60, 0.9] + [rng.uniform(1, 60) for _ in range(20)])
    for x in (0.05, 0.3, 0.6):
        got = url_filter.beta_below(x, a, b)
        assert got == pytest.approx([beta_tail(x, p, q) for p, q in zip(a, b, strict=True)], abs=2e-6)
    assert url_filter.beta_below(0.3, np.array([3e6, 3.1e6]), np.array([7e6, 7e6])) == pytest.approx([0.5, 0], abs=1e-3)
    assert len(url_filter.beta_below(0.3, np.zeros(0), np.zeros(0))) == 0


def test_url_parts_and_rules(spark):
    rules = [*url_filter.RULES, Rule("org", "", "block"), Rule("host.org", "", "allow")]
    df = spark.createDataFrame(list(enumerate(URLS)), "i int, url string")
    name, verdict = url_filter.first_rule(F.col("h"), F.col("p"), rules)
    got = df.select("i", url_filter.host_of(F.col("url")).alias("h"), url_filter.path_of(F.col("url")).alias("p")).select("*", name.alias("r"), verdict.alias("v"))
    for r in got.collect():
        host, path = parts(URLS[r["i"]])
        rule = fitting(host, path, rules)
        assert (r["h"], r["p"], r["r"], r["v"]) == (host, path, rule and rule.name, rule and rule.verdict), URLS[r["i"]]


def test_suffixes_and_domains(spark):
    want = {"a.b.example.com": ("com", "example.com"), "example.com": ("com", "example.com"), "com": ("com", "com"), "": ("", ""),
            "x.y.co.uk": ("co.uk", "y.co.uk"), "y.co.uk": ("co.uk", "y.co.uk"), "co.uk": ("co.uk", "co.uk"), "1.2.3.4:80": ("", "1.2.3.4"),
            "u:p@h.example.org:99": ("org", "example.org"), "[::1]:80": ("", "[::1]"), "example.net.": ("net", "example.net")}
    s, d = url_filter.suffix_and_domain(F.col("h"))
    got = spark.createDataFrame([(h,) for h in want], "h string").select("h", s.alias("s"), d.alias("d")).collect()
    assert {r["h"]: (r["s"], r["d"]) for r in got} == want


def brute_reputation(pages, bad_of, limit):
    """host -> (labelled, bad, posterior mean, sureness) from (key, host) rows, by the levels' definitions."""
    n, bad, domain = Counter(), Counter(), {}
    for key, host in pages:
        domain[host] = (".".join(host.split(".")[-2:]), host.split(".")[-1])
        known = bad_of.get(key) is not None
        n[host] += known
        bad[host] += known and bad_of[key]

    def level(groups, mean_of):
        used = [(k, t) for k, t in groups.items() if t[0]]
        more = sum(t[0] - 1 for _, t in used)
        spread = sum(t[0] * (t[1] / t[0] - mean_of(k)) ** 2 / (mean_of(k) * (1 - mean_of(k))) for k, t in used)
        rho = min(1 / 3, max(1 / 1001, (spread - len(used)) / more)) if more else 1 / 3
        w = 1 / rho - 1
        return w, {k: (t[1] + w * mean_of(k)) / (t[0] + w) for k, t in groups.items()}

    def summed(by):
        out = defaultdict(lambda: [0, 0])
        for h, keys in domain.items():
            out[by(h, keys)][0] += n[h]
            out[by(h, keys)][1] += bad[h]
        return out

    root = (sum(bad.values()) + 0.5) / (sum(n.values()) + 1)
    _, tops = level(summed(lambda h, k: k[1]), lambda k: root)
    _, doms = level(summed(lambda h, k: k), lambda k: tops[k[1]])
    w, hosts = level(summed(lambda h, k: h), lambda h: doms[domain[h]])
    return {h: (n[h], bad[h], hosts[h], beta_tail(limit, hosts[h] * (n[h] + w), (1 - hosts[h]) * (n[h] + w))) for h in domain}


def planted_pages(seed, hot):
    """(key, host) rows and outcomes: every domain has a rate of its own, one host holds a third of the pages."""
    rng = random.Random(seed)
    pages, bad_of, key = [], {}, 0
    for k in range(60):
        host = f"h{k}.site{k % 6}.{('com', 'net')[k % 2]}"
        rate = (0.02, 0.02, 0.7, 0.1, 0.02, 0.3)[k % 6]
        for _ in range(rng.randrange(1, 60) + hot * (k == 3) * 900):
            key += 1
            pages.append((key, host))
            if rng.random() < 0.6:
                bad_of[key] = rng.random() < rate
    return pages, bad_of


@pytest.mark.parametrize("hot", [0, 1])
def test_reputation_against_brute_force(spark, hot):
    pages, bad_of = planted_pages(3 + hot, hot)
    urls = [(k, f"http://{h}/p{k}", "x", 1) for k, h in pages] + [(None, "http://h1.site1.net/", "x", 1), (1, f"http://{pages[0][1]}/again", "x", 1)]
    df = spark.createDataFrame(urls, "key long, url string, verdict string, _host int").repartition(7)
    told = [(k, b) for k, b in bad_of.items()] + [(k, False) for k in list(bad_of)[:9]] + [(None, True), (5, None)]
    got = url_filter.judge(df, "url", "key", spark.createDataFrame(told, "key long, bad boolean"), limit=0.2, confidence=0.9)
    want = brute_reputation([*pages, (None, "h1.site1.net"), (1, pages[0][1])], bad_of, 0.2)
    rows = got.collect()
    assert len(rows) == len(urls) and got.columns == ["key", "url", "_host", *url_filter.NEW]
    for r in rows:
        n, bad, _, sure = want[r["host"]]
        assert (r["host_labelled"], r["host_bad"]) == (n, bad)
        assert r["host_sureness"] == pytest.approx(sure, abs=1e-5)
        assert r["verdict"] == ("allow" if sure >= 0.9 else "block")
    verdicts = {r["host"]: r["verdict"] for r in rows}
    kinds = Counter((h.split(".")[1], v) for h, v in verdicts.items())
    assert kinds["site2", "allow"] == 0 and kinds["site0", "allow"] >= 9 and kinds["site4", "allow"] >= 9  # bad ones go, clean ones stay


def test_without_labels_and_rows(spark):
    none = spark.createDataFrame([], "key long, bad boolean")
    df = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "key long, url string")
    got = {r["key"]: r for r in url_filter.judge(df, "url", "key", none, [Rule("com", "/", "allow")]).collect()}
    assert got[1]["verdict"] == "allow" and got[2]["host"] == got[2]["path"] == "" and got[2]["verdict"] == "block" and got[2]["host_labelled"] == 0
    assert url_filter.judge(df.limit(0), "url", "key", none).count() == 0


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(oracles.hosts_sql())
    names = [d[0] for d in cur.description]
    want = sorted(cur.fetchall(), key=lambda r: r[0])
    got = sorted((tuple(r) for r in url_filter.op11_host_reputation(spark, SF).select(*names).collect()), key=lambda r: r[0])
    assert got == want and len(got) == 50
