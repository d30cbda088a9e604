"""URL filters by rules and by empirical-Bayes host reputation.

Rules name a host (with all its subdomains) and a path prefix; the longest rule
that fits decides.  All other urls are judged by their host's reputation: labelled
page outcomes (bad or not) are counted by host, registered domain and public
suffix; the global rate is the beta prior of the suffixes, a suffix's posterior
mean the prior of its domains, a domain's that of its hosts.  The priors' strengths
come from the spread between the sites of a level beyond what chance adds (method
of moments).  A host is blocked when the lower bound of its posterior rate of bad
pages (mean less ``BOUND_DEVIATIONS`` standard deviations) is above ``MOST_BAD``.  A
prior counts for no more pages in that bound than were seen beside the site's own, so
a host without labels has its domain's rate and the doubt that is left about it.

Public suffixes are those of ``public_suffix_list.dat`` (publicsuffix.org, ICANN and
private section, with its wildcard and exception rules), joined with the distinct hosts;
a suffix that no rule names is the last label.  Only where the package was installed
without that file, the few suffixes of ``SECOND_LEVEL`` stand in for it, with a warning.

Column expressions and joins only.  Hosts are aggregated before they meet a page;
their table is broadcast behind a check of its size, else joined by shuffle, where
a hot host can be split.

Defined cases: a NULL url and one without ``://`` have an empty host and path,
which form a site of their own; labels that are NULL or of no page are ignored,
repeated labels of a page count as their mean; ports and user names stay in
``host`` and are left off for the domain, as is a dot at the end; an IP address is its
own domain, and so is a host that is a public suffix itself; without
any label everything that no rule blocks is allowed; repeated rows are each
judged; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import broadcast_if_small, materialize


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


#: A host is blocked when its rate of bad pages is credibly above this.
MOST_BAD = 0.25
BOUND_DEVIATIONS = 1.645
#: What is held of all pages before any label: this rate of bad ones, worth so many pages.
FIRST_RATE, FIRST_PAGES = 0.1, 10
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 10.0, 1000.0

SUFFIX_LIST = "public_suffix_list.dat"
# Second-level public suffixes where there is no list; all other suffixes are the last label.
SECOND_LEVEL = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")


def host_of(url: Column) -> Column:
    """A-Z lower-cased, from the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    """By ``SECOND_LEVEL`` alone; :func:`with_sites` takes the whole list."""
    bare = bare_host(host)
    two = F.substring_index(bare, ".", -2)
    return F.when(bare.rlike(r"^[0-9.]*$"), bare).when(two.isin(*SECOND_LEVEL), two).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain, the public suffix and one label before it, by ``SECOND_LEVEL`` alone."""
    bare = bare_host(host)
    two = F.substring_index(bare, ".", -2)
    return F.when(bare.rlike(r"^[0-9.]*$"), bare).when(two.isin(*SECOND_LEVEL), F.substring_index(bare, ".", -3)).otherwise(two)


def suffix_rules(lines: list[str]) -> list[tuple[str, int, bool]]:
    """``tail, labels, exception`` of each rule of a public suffix list: a host that ends in
    ``tail`` has a suffix of so many labels.  Names beyond ASCII stand in both spellings."""
    rules = set()
    for line in lines:
        rule = (line.split() or ["//"])[0].lower()
        if rule.startswith("//"):
            continue
        exception, wild = rule.startswith("!"), rule.startswith("*.")
        labels = rule.removeprefix("!").removeprefix("*.").split(".")
        coded = [x if x.isascii() else "xn--" + x.encode("punycode").decode() for x in labels]
        rules |= {(".".join(x), len(labels) + wild - exception, exception) for x in (labels, coded)}
    return sorted(rules)


def listed_rules() -> list[tuple[str, int, bool]]:
    """The rules of the list in this package, else the fallback."""
    try:
        return suffix_rules(resources.files(__package__).joinpath(SUFFIX_LIST).read_text("utf-8").splitlines())
    except FileNotFoundError:
        warnings.warn(f"{SUFFIX_LIST} is not installed: only {len(SECOND_LEVEL)} second-level suffixes are known", stacklevel=2)
        return suffix_rules(list(SECOND_LEVEL))


def with_sites(hosts: DataFrame, rules: list[tuple[str, int, bool]]) -> DataFrame:
    """``hosts``, one row per ``host``, with the ``domain`` and public ``suffix`` of each.  An
    exception goes before all other rules, else the rule of most labels holds."""
    bare = F.regexp_replace(bare_host(F.col("host")), r"\.$", "")
    labels = F.split(bare, r"\.")
    n, most = F.size(labels), max(tail.count(".") + 1 for tail, _, _ in rules)
    tails = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(most))), lambda k: F.lower(F.array_join(F.slice(labels, n - k + 1, k), ".")))
    table = hosts.sparkSession.createDataFrame(rules, "_rule string, _labels int, _exception boolean")
    met = hosts.select(F.col("host").alias("_of"), n.alias("_n"), F.explode(tails).alias("_tail")).join(F.broadcast(table), F.col("_tail") == F.col("_rule"))
    best = met.where("_labels <= _n").groupBy("_of").agg(F.max(F.struct("_exception", "_labels"))["_labels"].alias("_take"))
    take = F.coalesce("_take", F.lit(1))
    address = bare.rlike(r"^[0-9.]*$")
    domain = F.array_join(F.slice(labels, F.greatest(n - take, F.lit(1)), n), ".")
    suffix = F.array_join(F.slice(labels, n - take + 1, take), ".")
    named = hosts.join(best, F.col("host") == F.col("_of"), "left")
    return named.select(*hosts.columns, F.when(address, bare).otherwise(domain).alias("domain"), F.when(address, bare).otherwise(suffix).alias("suffix"))


def bare_host(host: Column) -> Column:
    """Without user name and port."""
    return F.regexp_extract(host, r"(?s)^(?:.*@)?([^:]*)", 1)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """``name, verdict`` of the longest rule that fits, else NULL."""
    none = F.lit(None).cast("struct<name:string,verdict:string>")
    from_short = sorted(rules, key=lambda r: (len(r.name), r.name))
    return reduce(lambda rest, r: F.when(fits(r, host, path), F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(rest), from_short, none)


def _strength(sites: DataFrame, mean: Column, rate: float) -> float:
    """Pages that a level's prior is worth, by the spread of its sites' rates around ``mean``."""
    spread = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, 2)) / F.sum("n") - F.sum(mean * (1 - mean)) / F.sum("n")
    value = sites.where("n > 1").agg(spread.alias("v")).head()["v"]
    return min(STRONGEST, max(WEAKEST, rate * (1 - rate) / value - 1)) if value and value > 0 else STRONGEST


def _shrunk(strength: float, prior: Column) -> Column:
    return (prior * strength + F.col("bad")) / (F.col("n") + strength)


def _pages(strength: float, above: Column) -> Column:
    """Pages that a site's rate rests on: its own and, up to the prior's strength, the
    others that the level above rests on."""
    return F.col("n") + F.least(F.lit(strength), above - F.col("n"))


def reputations(hosts: DataFrame) -> DataFrame:
    """``host, n, bad, mean, lower`` from labelled counts ``host, n, bad`` of every host."""
    hosts = materialize(with_sites(materialize(hosts), listed_rules()))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    total = hosts.agg(*sums).head()
    every = float(total["n"] or 0) + FIRST_PAGES
    rate = ((total["bad"] or 0) + FIRST_RATE * FIRST_PAGES) / every
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    k = _strength(suffixes, F.lit(rate), rate)
    by_suffix = suffixes.select("suffix", _shrunk(k, F.lit(rate)).alias("prior"), _pages(k, F.lit(every)).alias("pages"))
    placed = materialize(domains.join(by_suffix, "suffix"))
    k = _strength(placed, F.col("prior"), rate)
    by_domain = placed.select("suffix", "domain", _shrunk(k, F.col("prior")).alias("prior"), _pages(k, F.col("pages")).alias("pages"))
    placed = materialize(hosts.join(by_domain, ["suffix", "domain"]))
    k = _strength(placed, F.col("prior"), rate)
    known = placed.select("host", "n", "bad", _shrunk(k, F.col("prior")).alias("mean"), _pages(k, F.col("pages")).alias("pages"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("pages") + 1))
    return known.select("host", "n", "bad", "mean", F.greatest(F.lit(0.0), F.col("mean") - BOUND_DEVIATIONS * deviation).alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``page_id, url``;
    ``outcomes`` holds ``page_id, bad`` (0 or 1) of labelled pages."""
    url = F.col("url").cast("string")
    named = pages.select(F.col("page_id").cast("long"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy(F.col("page_id").cast("long").alias("_id")).agg(F.avg("bad").alias("bad"))
    counted = named.join(known, F.col("page_id") == F.col("_id"), "left").groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0.0)).alias("bad"))
    known_hosts = materialize(reputations(counted).select(F.col("host").alias("_h"), F.when(F.col("lower") > MOST_BAD, "block").otherwise("allow").alias("_verdict")))
    joined = named.join(broadcast_if_small(known_hosts, known_hosts.count()), F.col("host") == F.col("_h"))
    ruled = joined.withColumn("_rule", longest_rule(rules, F.col("host"), F.col("path")))
    return ruled.select("page_id", "host", "path", F.col("_rule.name").alias("rule"), F.coalesce("_rule.verdict", "_verdict").alias("verdict"))
