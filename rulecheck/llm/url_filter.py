"""URL filters: rules first, then the reputation of the host by empirical Bayes.

Labelled pages give each host a number of bad ones. A host's rate of bad pages has a beta prior centred on the rate of its
registered domain, whose own is centred on that of its suffix, and that on the rate of all pages. How strongly a level
pulls its members together is learnt from all of them: the excess of their rates' spread over what binomial chance
explains (method of moments) gives the correlation inside a group, and so the weight of the prior in pages. A host passes when, by its posterior,
its rate of bad pages is at most ``limit`` with a probability of ``confidence``: hosts with few labels lean on their domain, those with
many on themselves.

All statistics are sums over all pages, first by host, then by domain and suffix; single numbers of a level reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.llm import arrow  # noqa: F401 - sends this subpackage's code with the tasks
from rulecheck.llm.common import attach, free_name, materialize, restore, shield, table, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels under which names are registered; any other suffix is the last label.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")
LIMIT, CONFIDENCE = 0.3, 0.8
#: The correlation inside a group is kept in these bounds: a prior weighs as much as 2 to 1,000 pages.
LEAST_RHO, MOST_RHO = 1 / 1001, 1 / 3


@dataclass(frozen=True)
class Rule:
    """allow or block for a host with all its subdomains and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without a ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; nulls where none does. Among equally long ones the longer host wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):  # the last one asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def suffix_and_domain(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """The suffix and the registered domain (suffix and one label more) of a host. User, port and closing dots do not
    count; an address is a domain of its own under no suffix; a bare suffix is its own domain."""
    name = F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r"\.*(:[0-9]*)?$", "")
    address = name.rlike(r"^([0-9]+(\.[0-9]+){3}|\[.*)$")
    two = F.substring_index(name, ".", -2)
    suffix = F.when(address, "").when(two.isin(*suffixes), two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(address, name).when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two)
    return suffix, domain


def correlation(groups: DataFrame, mean: Column) -> float:
    """The correlation of outcomes inside a group of groups(n, bad), around each group's expected rate."""
    n, p = F.col("n"), F.col("bad") / F.col("n")
    told = groups.filter("n > 0").agg(
        F.sum(n * (p - mean) * (p - mean) / (mean * (1 - mean))).alias("spread"), F.count(F.lit(1)).alias("k"), F.sum(n - 1).alias("more")).first()
    if not told["more"]:
        return MOST_RHO
    return min(MOST_RHO, max(LEAST_RHO, (told["spread"] - told["k"]) / told["more"]))


def shrunk(mean: Column, rho: float) -> Column:
    """The rate of a group: its own outcomes and 1 / rho - 1 pages of the mean."""
    weight = 1 / rho - 1
    return (F.col("bad") + mean * weight) / (F.col("n") + weight)


def beta_below(x: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that a beta(a, b) variable is at most x: the continued fraction of the incomplete beta function, run until
    it stands still (about the square root of a + b steps)."""
    turned = x > (a + 1) / (a + b + 2)  # there the fraction of the other tail converges
    p, q, z = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    tiny = 1e-300
    log_gamma = np.vectorize(math.lgamma, otypes=[float])
    front = np.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
    safe = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(p), 1 / safe(1 - (p + q) * z / (p + 1))
    h, m, still = d.copy(), 1, np.zeros(len(p), bool)
    while not still.all():
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        for step in (even, odd):
            d, c = 1 / safe(1 + step * d), safe(1 + step / c)
            h = np.where(still, h, h * d * c)
        still |= np.abs(d * c - 1) < 1e-14
        m += 1
    return np.where(turned, 1 - front * h, front * h)


def reputation(hosts: DataFrame, limit: float = LIMIT, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """hosts(host, pages, n, bad; one row a host) with suffix, domain, bad_rate (posterior mean) and sureness (posterior
    probability that the rate is at most limit). Hosts without a labelled page take their domain's prior; an empty
    table stays empty."""
    suffix, domain = suffix_and_domain(F.col("host"), suffixes)
    hosts = hosts.select("host", "pages", "n", "bad", suffix.alias("suffix"), domain.alias("domain"))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("members")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    tops = domains.groupBy("suffix").agg(*sums)
    every = tops.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    mean = F.lit((every["bad"] + 0.5) / (every["n"] + 1))
    tops = tops.select("suffix", "members", shrunk(mean, correlation(tops, mean)).alias("suffix_rate"))
    domains = attach(domains, tops, "suffix", "members", ["suffix_rate"])
    mean = F.col("suffix_rate")
    domains = domains.withColumn("domain_rate", shrunk(mean, correlation(domains, mean)))
    hosts = attach(hosts, domains.select("domain", "members", "domain_rate"), "domain", "members", ["domain_rate"])
    mean = F.col("domain_rate")
    rho = correlation(hosts, mean)
    weight = 1 / rho - 1
    told = hosts.withColumn("bad_rate", shrunk(mean, rho))
    kept = ["host", "pages", "n", "bad", "suffix", "domain", "bad_rate"]
    schema = T.StructType([told.schema[c] for c in kept] + [T.StructField("sureness", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rate = (batch.column(kept.index(c)).to_numpy(zero_copy_only=False).astype(float) for c in ("n", "bad_rate"))
            sure = beta_below(limit, rate * (n + weight), (1 - rate) * (n + weight))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sure, pa.float64())], names=schema.names)

    return told.select(*kept).mapInArrow(run, schema)


def host_outcomes(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row for each host of pages(key, host): pages, n (labelled ones) and bad, from outcomes(key, bad), where several
    rows of a key count as one that is bad if any is. Null keys have no outcome."""
    known = outcomes.filter(F.col("key").isNotNull() & F.col("bad").isNotNull()).groupBy("key").agg(F.max("bad").alias("bad"))
    copies = pages.groupBy("key", "host").agg(F.count(F.lit(1)).alias("pages"))  # a key that fills the table is one row now
    return (copies.join(known, "key", "left").groupBy("host")
            .agg(F.sum("pages").alias("pages"), F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"),
                 F.coalesce(F.sum(F.when(F.col("bad"), F.col("pages"))), F.lit(0)).alias("bad")))


NEW = ["host", "path", "rule", "verdict", "host_labelled", "host_bad", "host_sureness"]


def judge(pages: DataFrame, url: str, key: str, outcomes: DataFrame, rules: Sequence[Rule] = (), limit: float = LIMIT,
          confidence: float = CONFIDENCE, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """pages with host, path, rule (the longest that fits, else null), verdict (the rule's, else allow or block by the host's
    posterior), host_labelled and host_bad (pages of the host with an outcome, and bad ones) and host_sureness.

    outcomes(key, bad): labelled pages by the value of their ``key`` column. A null url, or one without ://, has an empty
    host and path and is judged with all others of the empty host. Repeated rows count as often as they occur; an empty table stays
    empty; the new columns replace others of their names. ``rules`` is a short list held in the plan.
    """
    pages = without(pages, [c for c in NEW if c not in (url, key)])
    work = shield(pages, url, key)
    made = {c: free_name(work, "_" + c) for c in NEW}
    work = work.withColumns({made["host"]: host_of(F.col(url)), made["path"]: path_of(F.col(url))})
    name, verdict = first_rule(F.col(made["host"]), F.col(made["path"]), rules)
    work = work.withColumns({made["rule"]: name, made["verdict"]: verdict})
    hosts = host_outcomes(work.select(F.col(key).alias("key"), F.col(made["host"]).alias("host")), outcomes)
    told = materialize(reputation(materialize(hosts, "url-hosts"), limit, suffixes), "url-reputation")
    told = told.select(F.col("host").alias(made["host"]), "pages", F.col("n").alias(made["host_labelled"]),
                       F.col("bad").alias(made["host_bad"]), F.col("sureness").alias(made["host_sureness"]))
    out = attach(work, told, made["host"], "pages", [made[c] for c in ("host_labelled", "host_bad", "host_sureness")])
    own = F.when(F.col(made["host_sureness"]) >= confidence, "allow").otherwise("block")
    back = [c for c in pages.columns if c not in NEW]
    return out.withColumn(made["verdict"], F.coalesce(F.col(made["verdict"]), own)).select(
        *restore(out, back), *[F.col(made[c]).alias(c) for c in NEW])


#: The query's rules.
RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Labelled pages by id: bad where the quality is 0 or the page toxic; no outcome where both are null."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    return labels.select(F.col("doc_id").alias("key"), F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), bad).alias("bad"))


def op11_host_reputation(spark, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict. The outcome of a page is its label of the same id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    told = judge(pages, "url", "page_id", page_outcomes(table(spark, sf_dir, "labels")), RULES)
    return told.select("page_id", "host", "path", "rule", "verdict", "host_labelled", "host_bad")
