"""URL filters: host rules, and empirical-Bayes reputation for hosts that no rule names.

Labelled outcomes of pages are counted by host; a host's rate is shrunk to its
registered domain's, that to its suffix's, that to the rate of all, through
beta-binomial priors. A prior is as wide as its parent's posterior and the spread of
children around their parents together, so uncertainty is carried down; the spreads come
from the data by moments, and stay wide where few labels tell them. What a host is shrunk
to leaves its own labels out, so each label counts once, and a bound falls short of the
limit unless a host or enough of its kin have labels. DataFrame functions only.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path); a rule fits its host and all subdomains, if the path starts with its path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


#: Suffixes of two labels below which domains are registered.
TWO_LABELS = (
    "ac.jp", "ac.kr", "ac.nz", "ac.uk", "ac.za", "co.id", "co.il", "co.in", "co.jp", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.hk", "com.mx", "com.my",
    "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "edu.au", "edu.cn", "go.jp", "go.kr", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "ne.jp", "net.au", "net.br", "net.cn", "or.jp", "or.kr",
    "org.au", "org.br", "org.cn", "org.nz", "org.tw", "org.uk", "org.za", "re.kr", "sch.uk",
)
#: The spread of children that is assumed before the data tell, as a share of rate * (1 - rate), and how much evidence it weighs.
SPREAD, WEIGHT = 0.3, 1.0
#: The weight of a prior in labels at the least: two make an even prior flat.
LEAST_STRENGTH = 2.0
#: A posterior of up to this strength in labels is summed in so many terms; a stronger one is as good as normal.
EXACT_STRENGTH, TERMS = 1024.0, 512
#: Coefficients of the series of ln gamma in 1/x, 1/x^3, 1/x^5.
STIRLING = (1 / 12, -1 / 360, 1 / 1260)


def url_suffix(host: Column) -> Column:
    """The last label, or the last two where domains are registered below those."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABELS), two).otherwise(F.substring_index(host, ".", -1))


def url_domain(host: Column) -> Column:
    """The registered domain: the suffix and one label more."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABELS), F.substring_index(host, ".", -3)).otherwise(two)


def url_host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null. Of equally long
    rules the longer host wins, then block over allow."""
    best = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    if not best:
        return none
    cases = [
        F.when(
            ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path),
            F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, rule_host, rule_path in best
    ]
    return F.coalesce(*cases, none)


def _moments(level: str, children: DataFrame) -> DataFrame:
    """(level, extra, pairs) of children (n, k, m: their parent's rate): how much more labelled children differ from
    their parent than by chance, and the weight of that, by moments; their quotient is the share of rate * (1 - rate) that is spread."""
    own = F.col("m") * (1 - F.col("m"))
    return children.filter("n > 0").agg(
        F.lit(level).alias("level"), F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2) - own).alias("extra"), F.sum(own * (F.col("n") - 1)).alias("pairs"))


def _posterior(first: Column, levels: list[tuple[Column, Column, float]]) -> Column:
    """struct(m, v) of a rate after each level's (n labels, k bad ones, spread), from struct(m, v) of all."""
    steps = F.array(*(F.struct(n.cast("double").alias("n"), k.cast("double").alias("k"), F.lit(float(spread)).alias("spread")) for n, k, spread in levels))

    def after(p: Column, x: Column) -> Column:
        own = p["m"] * (1 - p["m"])
        s = F.greatest(own / (p["v"] + x["spread"] * own) - 1, F.lit(LEAST_STRENGTH))
        m = (s * p["m"] + x["k"]) / (s + x["n"])
        return F.struct(m.alias("m"), (m * (1 - m) / (s + x["n"] + 1)).alias("v"))

    return F.aggregate(steps, first, after)


def _ln_gamma(x: Column) -> Column:
    """ln gamma of x > 0 to about 1e-10, by its series at x + 7."""
    y = x + 7
    below = F.ln(x)
    for i in range(1, 7):
        below = below + F.ln(x + i)
    series = sum((c / F.pow(y, F.lit(2 * i + 1)) for i, c in enumerate(STIRLING)), F.lit(0.0))
    return (y - 0.5) * F.ln(y) - y + F.lit(0.9189385332046727) + series - below


def beta_above(m: Column, v: Column, limit: float) -> Column:
    """P(rate > limit) of a beta distribution of mean m and variance v, 0 < limit < 1: the incomplete beta function by its
    series of positive terms, of the side of the limit that does not hold the mean, where terms only fall."""
    s = m * (1 - m) / v - 1
    under = m >= limit  # the mean is above: the tail below is summed
    a, b = F.when(under, m * s).otherwise((1 - m) * s), F.when(under, (1 - m) * s).otherwise(m * s)
    given = F.struct(under.alias("under"), s.alias("s"), a.alias("a"), b.alias("b"), F.when(under, limit).otherwise(1.0 - limit).alias("x"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))

    def tail(g: Column) -> Column:
        ln = g["a"] * F.ln(g["x"]) + g["b"] * F.ln(1 - g["x"]) + _ln_gamma(g["s"]) - _ln_gamma(g["a"] + 1) - _ln_gamma(g["b"])
        sums = F.aggregate(F.sequence(F.lit(0), F.lit(TERMS - 1)), start, lambda acc, i: F.struct(
            (acc["term"] * g["x"] * (g["s"] + i) / (g["a"] + 1 + i)).alias("term"), (acc["sum"] + acc["term"]).alias("sum")))["sum"]
        return F.when(g["under"], 1 - F.exp(ln) * sums).otherwise(F.exp(ln) * sums)

    # The parameters go through an array of one, so that they are worked out once and not in each place.
    return F.transform(F.array(given), tail)[0]


def host_reputation(pages: DataFrame, labels: DataFrame, z: float = 1.645) -> DataFrame:
    """host, n, k, rate, low, high, v for every host of pages: labelled pages, bad ones
    among them, posterior mean of the bad rate, its bounds (z standard deviations) and its variance.

    A page is bad if a label of its id (doc_id of labels = page_id) has quality 0 or
    toxic 1; null grades are not bad. Without any label all rates are 0.5. Repeated rows
    of pages count each; of labels of one page one bad one decides. What comes to the driver
    is four rows of sums."""
    bad = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.coalesce(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long"), F.lit(0))).alias("bad"))
    counted = pages.select("page_id", url_host(F.col("url")).alias("host")).join(bad, "page_id", "left")
    hosts = stored(counted.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k")))
    hosts = hosts.withColumns({"domain": url_domain(F.col("host")), "suffix": url_suffix(F.col("host"))})
    up = lambda rows, *keys: rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = up(hosts, "domain", "suffix")
    suffixes = up(domains, "suffix")
    all_n, all_k = (float(x or 0) for x in suffixes.agg(F.sum("n"), F.sum("k")).first())
    rate = lambda rows, key: rows.filter("n > 0").select(key, (F.col("k") / F.col("n")).alias("m"))
    sums = _moments("suffix", suffixes.withColumn("m", F.lit(all_k / max(all_n, 1.0))))
    sums = sums.unionByName(_moments("domain", domains.join(rate(suffixes, "suffix"), "suffix"))).unionByName(_moments("host", hosts.join(rate(domains, "domain"), "domain")))
    spread = {r.level: min(max(((r.extra or 0.0) + WEIGHT * SPREAD) / ((r.pairs or 0.0) + WEIGHT), 0.001), 0.9) for r in sums.collect()}

    kin = hosts.join(domains.select("domain", F.col("n").alias("nd"), F.col("k").alias("kd")), "domain").join(suffixes.select("suffix", F.col("n").alias("ns"), F.col("k").alias("ks")), "suffix")
    n, k, nd, kd, ns, ks = map(F.col, ("n", "k", "nd", "kd", "ns", "ks"))
    m = (all_k - ks + 0.5) / (all_n - ns + 1)
    first = F.struct(m.alias("m"), (m * (1 - m) / (all_n - ns + 2)).alias("v"))
    kin = kin.withColumn("p", _posterior(first, [(ns - nd, ks - kd, spread["suffix"]), (nd - n, kd - k, spread["domain"]), (n, k, spread["host"])]))
    kin = kin.select("host", "n", "k", F.col("p.m").alias("m"), F.col("p.v").alias("v"))
    low, high = (F.col("m") + x * F.sqrt("v") for x in (-z, z))
    return kin.select("host", "n", "k", F.col("m").alias("rate"), F.greatest(F.lit(0.0), low).alias("low"), F.least(F.lit(1.0), high).alias("high"), "v")


def blocked_hosts(reputation: DataFrame, limit: float, z: float) -> DataFrame:
    """Rows of host_reputation() whose bad rate is above the limit with the probability that z stands for (1.645: 0.95). A
    mean under that share of the limit cannot give it (Markov), so its tail is not summed."""
    sure = NormalDist().cdf(z)
    m, v = F.col("rate"), F.col("v")
    exact = F.when(m >= sure * limit, beta_above(m, v, limit)).otherwise(0.0) > sure
    return reputation.filter(F.when(m * (1 - m) / v - 1 <= EXACT_STRENGTH, exact).otherwise(m - z * F.sqrt(v) > limit))


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES, limit: float = 0.5, z: float = 1.645) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (columns page_id and
    url; others are ignored).

    verdict is the longest fitting rule's; without one, block where the lower posterior bound of the host's bad rate,
    the quantile of its beta posterior that z stands for, exceeds `limit`, else allow. A null url, or
    one without ://, has host and path empty. Repeated rows are all returned. A host of a
    third of all rows is one row of the blocked hosts; its pages are the side that Spark
    splits. An empty table gives an empty result."""
    blocked = blocked_hosts(stored(host_reputation(pages, labels, z)), limit, z).select(F.col("host").alias("of"))
    out = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    out = out.withColumn("fits", rule_of(F.col("host"), F.col("path"), rules))
    judged = out.join(blocked, F.col("host") == F.col("of"), "left")
    return judged.select(
        "page_id", "host", "path", F.col("fits.rule").alias("rule"),
        F.coalesce("fits.verdict", F.when(F.col("of").isNotNull(), "block").otherwise("allow")).alias("verdict"),
    )
