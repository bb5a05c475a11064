"""URL filters: rules, and an empirical-Bayes reputation of hosts for pages without one."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.lookup import lookup
from pairloom.llm.text import whole
from pairloom.scratch import broadcast_if_small, stage

# Verdict, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Endings of two labels under which names are registered; elsewhere the last label is the suffix.
LONG_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "co.in", "co.jp", "co.kr", "co.nz", "co.za", "com.cn", "com.mx", "com.tr")

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(whole(url), _URL, 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(whole(url), _URL, 2)


def matched_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, rules)``: for each distinct host the rules of the host itself and of the domains above it.

    A host is taken apart into its own endings, one per label, which are joined with the rules by
    equality; no rule is compared with a host that it does not fit.
    """
    labels = F.split("host", r"\.")
    endings = hosts.select("host", F.posexplode(labels).alias("at", "label"), labels.alias("labels"))
    endings = endings.select("host", F.array_join(F.slice("labels", F.col("at") + 1, F.size("labels")), ".").alias("rule_host"))
    by_host = rules.groupBy("rule_host").agg(F.collect_set(F.struct("path", "rule", "verdict")).alias("rules"))
    found = endings.join(broadcast_if_small(by_host, rules.count(), 256), "rule_host")
    return found.groupBy("host").agg(F.flatten(F.collect_list("rules")).alias("rules"))


def _shrunk(groups: DataFrame, mean: str) -> DataFrame:
    """``groups`` with ``strength`` of their Beta prior and posterior mean ``posterior``; ``mean`` is the prior's.

    The share of variance that lies between groups is estimated by moments over all groups of the level:
    of ``n`` outcomes with mean ``m``, the squared distance of the bad ones from ``n m`` is expected to be
    ``n m (1 - m) (1 + (n - 1) rho)``. A prior then counts as ``(1 - rho) / rho`` outcomes.
    """
    n, x, m = F.col("n").cast("double"), F.col("x").cast("double"), F.col(mean)
    spread = m * (1 - m)
    above = F.sum((x - n * m) * (x - n * m) - n * spread)
    below = F.sum(n * (n - 1) * spread)
    rho = F.when(below > 0, F.least(F.lit(0.999), F.greatest(F.lit(0.001), above / below))).otherwise(F.lit(0.5))
    rho = groups.agg(rho.alias("rho")).first()["rho"]
    strength = F.lit((1 - rho) / rho)
    return groups.withColumns({"strength": strength, "posterior": (x + strength * m) / (n + strength)})


def host_reputation(hosts: DataFrame, *, long_suffixes: Sequence[str] = LONG_SUFFIXES, z: float = 1.645) -> DataFrame:
    """``(host, domain, suffix, n, x, bad_rate, bound, pages)`` from ``(host, n, x, pages)``: ``x`` of ``n`` known outcomes are bad.

    Each level is shrunk towards the one above it: the suffix towards the rate of all outcomes, the
    registered domain towards its suffix, the host towards its domain, by beta-binomial priors whose
    strength comes from the level itself. ``bad_rate`` is the posterior mean of the host and ``bound``
    the mean less ``z`` posterior standard deviations. A host without outcomes has its domain's mean.
    The domain is the suffix and one label more; a host of no more labels is its own domain.
    """
    last = F.substring_index("host", ".", -1)
    two = F.substring_index("host", ".", -2)
    long = two.isin(*long_suffixes) if long_suffixes else F.lit(False)
    suffix = F.when(long, two).otherwise(last)
    domain = F.when(long, F.substring_index("host", ".", -3)).otherwise(two)
    placed = hosts.withColumns({"suffix": suffix, "domain": domain})
    domains = placed.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("x").alias("x"), F.count(F.lit(1)).alias("hosts"))
    domains = stage(domains, "url-domains").df
    suffixes = stage(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "url-suffixes").df
    everything = suffixes.agg(F.sum("n").alias("n"), F.sum("x").alias("x")).first()
    mean = F.lit(((everything["x"] or 0) + 0.5) / ((everything["n"] or 0) + 1.0))
    suffixes = _shrunk(suffixes.withColumn("mean", mean), "mean").select("suffix", F.col("posterior").alias("mean"))
    many = domains.groupBy("suffix").agg(F.count(F.lit(1)).alias("many"))
    domains = lookup(domains, suffixes.join(many, "suffix").select("suffix", "mean", "many"), ["suffix"], "many").drop("many")
    domains = stage(_shrunk(domains, "mean").select("suffix", "domain", "hosts", F.col("posterior").alias("mean")), "url-domains").df
    placed = stage(placed, "url-hosts").df
    placed = _shrunk(lookup(placed, domains, ["suffix", "domain"], "hosts").drop("hosts"), "mean")
    total = F.col("n") + F.col("strength")
    deviation = F.sqrt(F.col("posterior") * (1 - F.col("posterior")) / (total + 1.0))
    return placed.select(
        "host", "domain", "suffix", "n", "x", "pages", F.col("posterior").alias("bad_rate"), (F.col("posterior") - F.lit(z) * deviation).alias("bound")
    )


def filter_urls(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    outcomes: DataFrame | None = None,
    limit: float = 0.5,
    z: float = 1.645,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """``(id_col, host, path, rule, verdict, n_labelled, bad_rate, bound)``, a row for every row of ``pages``.

    ``rules`` are (verdict, host, path). A rule fits its host and all subdomains when the path of the
    url starts with the rule's; of several the longest wins (host and path together, then the smaller
    text, then the smaller verdict), and decides. A page without a rule goes by its host: ``block`` when
    the lower posterior bound of the host's rate of bad outcomes is above ``limit``, see
    :func:`host_reputation`; so little evidence never blocks. Labelled outcomes are ``outcomes``
    (``host`` string, ``bad`` boolean; one row each) or, without them, the pages that a rule decides, of
    which the blocked ones are bad.

    A null url or one without ``://`` has an empty host and path; the empty host is a host like others,
    and no rule fits it. Ports and user names stay in the host. Rows that repeat an id are judged one by
    one, a null id is kept. Urls of any length are taken whole. Other columns are not read. An empty
    table gives no rows.
    """
    spark = pages.sparkSession
    given = [(verdict, host, path, host + path) for verdict, host, path in rules]
    table = spark.createDataFrame(given, "verdict string, rule_host string, path string, rule string")
    rows = stage(pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")), "url-rows").df
    hosts = stage(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "url-names").df
    ruled = hosts.join(matched_rules(hosts.filter("host <> ''"), table), "host", "left")
    ruled = lookup(rows, stage(ruled, "url-rules").df, ["host"], "pages", row_bytes=512)
    fitting = F.filter(F.coalesce("rules", F.array().cast("array<struct<path:string,rule:string,verdict:string>>")), lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_min(F.transform(fitting, lambda r: F.struct((-F.length(r["rule"])).alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    ruled = ruled.select("id", "host", "path", best.alias("best"))
    ruled = stage(ruled.select("id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled")), "url-ruled").df
    known = ruled.filter("ruled IS NOT NULL").select("host", (F.col("ruled") == "block").alias("bad")) if outcomes is None else outcomes
    known = known.select(F.coalesce("host", F.lit("")).alias("host"), "bad").filter("bad IS NOT NULL")
    counts = known.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("x"))
    # Hosts that have outcomes only count for their domains.
    seen = hosts.join(counts, "host", "full").select("host", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n", "x", "pages")])
    judged = stage(host_reputation(stage(seen, "url-seen").df, long_suffixes=long_suffixes, z=z).filter("pages > 0"), "url-reputation").df
    out = lookup(ruled, judged.select("host", "n", "pages", "bad_rate", "bound"), ["host"], "pages")
    by_host = F.when(F.col("bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", by_host).alias("verdict"),
        F.col("n").alias("n_labelled"),
        F.round("bad_rate", 6).alias("bad_rate"),
        F.round("bound", 6).alias("bound"),
    )
