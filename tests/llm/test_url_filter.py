from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.llm import lookup as lk
from pairloom.llm.url_filter import LONG_SUFFIXES, RULES, filter_urls
from tests.llm import data

PAGES = "page_id long, url string, html string"


def pages(spark, given):
    return spark.createDataFrame([(k, url, None) for k, url in given], PAGES).repartition(3)


def parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (data.ascii_lower(found[1]), found[2]) if found else ("", "")


def rule_of(host, path, rules=RULES):
    fits = [(-len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits)[1:] if fits else (None, None)


def levels(host):
    names = host.split(".")
    long = ".".join(names[-2:]) in LONG_SUFFIXES
    suffix = ".".join(names[-2:] if long else names[-1:])
    return suffix, ".".join(names[-3:] if long else names[-2:])


def shrunk(groups):
    """groups: key -> (n, x, mean)"""
    above = sum((x - n * m) ** 2 - n * m * (1 - m) for n, x, m in groups.values())
    below = sum(n * (n - 1) * m * (1 - m) for n, x, m in groups.values())
    rho = min(0.999, max(0.001, above / below)) if below > 0 else 0.5
    s = (1 - rho) / rho
    return {k: ((x + s * m) / (n + s), s) for k, (n, x, m) in groups.items()}


def brute(given, outcomes=None, limit=0.5):
    rows = [(k, *parts(url)) for k, url in given]
    known = [(h, rule_of(h, p)[1] == "block") for _, h, p in rows if rule_of(h, p)[1]] if outcomes is None else outcomes
    count = {}
    for h in {h for _, h, _ in rows} | {h for h, _ in known}:
        bad = [b for g, b in known if g == h]
        count[h] = (len(bad), sum(bad))
    total = [sum(c[k] for c in count.values()) for k in (0, 1)]

    def level(key, mean):
        sums = {}
        for h, (n, x) in count.items():
            a, b, _ = sums.get(key(h), (0, 0, 0))
            sums[key(h)] = (a + n, b + x, mean(h))
        return shrunk(sums)

    root = (total[1] + 0.5) / (total[0] + 1)
    suffixes = level(lambda h: levels(h)[0], lambda h: root)
    domains = level(levels, lambda h: suffixes[levels(h)[0]][0])
    hosts = level(lambda h: h, lambda h: domains[levels(h)][0])
    out = []
    for k, h, p in rows:
        rate, s = hosts[h]
        bound = rate - 1.645 * (rate * (1 - rate) / (count[h][0] + s + 1)) ** 0.5
        rule, verdict = rule_of(h, p)
        out.append((k, h, p, rule, verdict or ("block" if bound > limit else "allow"), count[h][0], rate, bound))
    return sorted(out, key=repr)


def awkward():
    urls = [
        None, "", "no scheme", "http://", "://", "http://ORG/es/", "http://example.org/es/x", "http://a.Example.ORG/en/12", "http://badexample.org/es/1",
        "https://x.com/fr/1#a/b", "https://x.com/fr", "https://x.com/de/1?u=http://y.net/", "http://y.net?q=/de/", "http://com/de/", "x://y://z.com/fr/",
        "http://user@shop.co.uk:80/a", "http://a.b.co.uk/", "http://.org/", "http://a..com/de/", "http://x.com/de/\n2?x", "http://q.com/" + "long/" * 100_000,
    ]
    draw = random.Random(3)
    urls += [f"http://h{draw.randrange(6)}.d{draw.randrange(4)}.{draw.choice(('com', 'net', 'co.uk'))}/{draw.choice(('de', 'fr', 'en'))}/{k}" for k in range(300)]
    urls += [f"http://bad.de1.com/de/{k}" for k in range(40)] + ["http://bad.de1.com/en/1"]
    return [(k, url) for k, url in enumerate(urls)] + [(5, urls[5]), (None, urls[6])]


def close(have, want):
    assert [r[:6] for r in have] == [r[:6] for r in want]
    assert all(abs(a - b) < 2e-6 for r, s in zip(have, want, strict=True) for a, b in zip(r[6:], s[6:], strict=True))


def test_against_brute_force(spark):
    have = data.check_table(filter_urls, pages(spark, awkward()))
    close(have, brute(awkward()))


def test_outcomes_of_the_caller(spark):
    known = [("h1.d1.com", True)] * 30 + [("h2.d1.com", False)] * 3 + [("only.known.com", True)] * 9
    table = spark.createDataFrame([*known, (None, True), ("h1.d1.com", None)], "host string, bad boolean")
    have = data.listed(filter_urls(pages(spark, awkward()), outcomes=table))
    close(have, brute(awkward(), [*known, ("", True)]))


def test_a_lookup_moves_only_rows_of_light_keys(spark, monkeypatch):
    """A third of the rows have one key: they are joined where they are."""
    import pairloom.scratch as scratch

    monkeypatch.setattr(scratch, "BROADCAST_BYTES", 0)
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("members"))
    out = lk.lookup(rows, table, ["k"], "members")
    assert sorted(out.columns) == ["id", "k", "members"] and out.count() == 30_000
    assert out.filter("k = 0").agg(F.min("members")).first()[0] == 10_000
    plan = out._jdf.queryExecution().toString()
    assert "Union" in plan and "LeftAnti" in plan


@pytest.mark.parametrize("pages_of_host", [1, 400])
def test_little_evidence_never_blocks(spark, pages_of_host):
    given = [(k, f"http://a.x.com/de/{k}") for k in range(pages_of_host)] + [(-1, "http://a.x.com/other")] + [(1000 + k, f"http://h{k}.z{k}.com/fr/") for k in range(400)]
    have = {r[0]: r[4] for r in data.listed(filter_urls(pages(spark, given)))}
    assert have[-1] == ("block" if pages_of_host == 400 else "allow")
