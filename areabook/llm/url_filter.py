"""URL filter: explicit host/path rules first, else empirical-Bayes host reputation
(built-in functions only).

Labelled page outcomes (bad or not) are counted per host, registered domain and suffix.
Each level's bad rate is shrunk towards its parent's through a beta-binomial prior: the
suffix towards the whole table, the domain towards its suffix, the host towards its
domain. The prior's strength is estimated per level by the method of moments from the
overdispersion of the counts around their parents, weighed with the estimate's own error
(`_spread`), so few counts never pass for certainty. A host is blocked when the lower
`z`-bound of its posterior bad rate exceeds `threshold`; hosts without labels inherit
their domain's or suffix's posterior.

Counts are pre-aggregated before any shuffle, so a host with a third of all pages costs
one row a task; pages meet their host's verdict in an ordinary join that adaptive
execution can split.

Edge cases: a NULL url or one without :// has empty host and path and is judged by the
method at the empty host; labels that repeat count once a page (bad if any is); pages
repeat as they come; NULL page_ids are never labelled; no labels at all gives the prior
`base` everywhere; other columns are ignored."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.llm.common import stager

#: Rules of the query contract (fixed values): verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Suffixes of two labels under which names are registered (a parameter; one label otherwise).
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")
THRESHOLD = 0.5
Z = 1.645


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


#: Entities that pages write for characters of their text.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def article_text(html: Column) -> Column:
    """The text of a page's article without its heading; of the whole body where it has no article."""
    body = F.regexp_replace(html, r"(?is)<(head|script|style|nav|footer)\b.*?</\1\s*>|<!--.*?-->", " ")
    article = F.regexp_extract(body, r"(?is)<article\b[^>]*>(.*)</article\s*>", 1)
    text = F.regexp_replace(F.when(article == "", body).otherwise(article), r"(?is)<h1\b.*?</h1\s*>|<[^>]*>", " ")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def text_print(text: Column) -> Column:
    """Hash of the lower-case words of a text, whatever stands between them; NULL without words."""
    said = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(said != "", F.sha2(said, 256))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else NULLs."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def domain_parts(host: Column, two_label=TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; user info and port do not count."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    suffix = F.when(F.substring_index(name, ".", -2).isin(*two_label), F.substring_index(name, ".", -2)) \
              .otherwise(F.substring_index(name, ".", -1))
    labels = F.when(F.substring_index(name, ".", -2).isin(*two_label), F.substring_index(name, ".", -3)) \
              .otherwise(F.substring_index(name, ".", -2))
    return labels, suffix


def _strength(units: DataFrame, parent: str) -> float:
    """Prior strength of a level, by moments: how much counts (n, bad) spread around their parents' rates."""
    p = _inside(F.col(parent))
    var = p * (1 - p)
    r = units.filter("n > 0").agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * p, 2) - F.col("n") * var).alias("over"),
        F.sum(F.col("n") * (F.col("n") - 1) * var).alias("scale"),
        F.sum(2 * F.col("n") * (F.col("n") - 1) * var * var).alias("noise")).first()
    rho = 0.1 if not r.scale else _spread(r.over / r.scale, math.sqrt(r.noise) / r.scale)
    return round(1 / rho - 1, 6)


def _spread(estimate: float, error: float) -> float:
    """Mean of the overdispersion within 0..1 given its moment estimate and that estimate's standard error."""
    near = min(max(estimate, 0.0), 1.0)
    lo, hi = max(0.0, near - 8 * error), min(1.0, near + 8 * error)
    x = lo + (np.arange(4000) + 0.5) / 4000 * (hi - lo)
    log = -((x - estimate) / error) ** 2 / 2
    w = np.exp(log - log.max())
    return float(min((x * w).sum() / w.sum(), 0.999))


def _inside(rate: Column) -> Column:
    return F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))


def _shrunk(units: DataFrame, parent: str, out: str) -> DataFrame:
    """Adds the posterior mean `out` and its Beta parameters, shrunk towards the column `parent`."""
    m, p = _strength(units, parent), _inside(F.col(parent))
    return (units.withColumn(f"{out}_a", F.col("bad") + m * p)
            .withColumn(f"{out}_b", F.col("n") - F.col("bad") + m * (1 - p))
            .withColumn(out, F.col(f"{out}_a") / (F.col(f"{out}_a") + F.col(f"{out}_b"))))


def host_reputation(pages: DataFrame, labels: DataFrame, base: float = 0.5, threshold: float = THRESHOLD,
                    z: float = Z) -> DataFrame:
    """(host, domain, suffix, n, bad, posterior, lower, upper, blocked) a host of pages(page_id, host);
    labels(page_id, bad 0/1). Of each level only three sums reach the driver."""
    st = stager(pages.sparkSession, "urls")
    lab = labels.filter(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    seen = pages.select("page_id", "host").join(lab, "page_id", "left")
    dom, suf = domain_parts(F.col("host"))
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    hosts = st.stage(seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                     .withColumn("domain", dom).withColumn("suffix", suf), "hosts")
    domains = st.stage(hosts.groupBy("domain", "suffix").agg(*counts), "domains")
    suffixes = domains.groupBy("suffix").agg(*counts)
    total = domains.agg(*counts).first()
    p0 = ((total.bad or 0) + 2 * base) / ((total.n or 0) + 2)
    suffixes = st.stage(_shrunk(suffixes.withColumn("p0", F.lit(p0)), "p0", "p_suffix").select("suffix", "p_suffix"), "suffix-rates")
    domains = st.stage(domains.join(suffixes, "suffix"), "domain-parents")
    domains = st.stage(_shrunk(domains, "p_suffix", "p_domain").select("domain", "suffix", "p_domain"), "domain-rates")
    hosts = st.stage(hosts.join(domains, ["domain", "suffix"]), "host-parents")
    out = _shrunk(hosts, "p_domain", "p")
    a, b, mean = F.col("p_a"), F.col("p_b"), F.col("p")
    sd = F.sqrt(mean * (1 - mean) / (a + b + 1))
    return out.select("host", "domain", "suffix", "n", "bad", mean.alias("posterior"),
                      F.greatest(F.lit(0.0), mean - z * sd).alias("lower"),
                      F.least(F.lit(1.0), mean + z * sd).alias("upper"),
                      (mean - z * sd > threshold).alias("blocked"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES, **options) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, n, bad (labelled pages of the host)."""
    p = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rep = host_reputation(p, labels, **options).select("host", "n", "bad", "blocked")
    r = rule_of(F.col("host"), F.col("path"), rules)
    return (p.join(rep, "host").withColumn("_r", r)
            .select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                    F.coalesce(F.col("_r.verdict"), F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
                    F.col("n").cast("long").alias("n_labelled"), F.col("bad").cast("long").alias("n_bad")))
