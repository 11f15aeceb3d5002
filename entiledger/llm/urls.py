"""URL filters: rules, and trust and distrust over the links between hosts.

Only built-in functions are used. Hosts whose pages the rules allow are trusted seeds,
those whose pages they block are distrusted ones, each by the share of its pages. Trust
flows along links by personalised PageRank, distrust against them, as who links to
blocked hosts is suspect. Every rank is held against the rank that the same host would
have if all hosts were seeds, so a verdict depends on the share of the evidence, not on
how many hosts share it out. Ranks are whole numbers of a fixed scale, so that sums don't
depend on their order and a lost task gives the same verdicts when it is run again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiledger.llm.common import cut
from entiledger.operators.joins import lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path); the longest that fits a url decides.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
LINK = r"""(?i)href[ \t\r\n\f]*=[ \t\r\n\f]*["']?(?:https?:)?//([^/?#"'<> \t\r\n\f]+)"""

#: A seed's whole weight, and the twentieths of a rank that its own seed keeps.
SCALE = 10**12
RESTART = 3
#: Rounds go on while the last one moved any rank by more than a thousandth of it and a
#: millionth of a seed; that is looked at after every fourth round.
MOVED_PART = 1000
MOVED_LEAST = SCALE // 10**6
CUT_EVERY = 4
#: Ranks and their sums: a host that millions link to has more than a long holds.
WHOLE = "decimal(30,0)"


def _div(value: Column, by: Column) -> Column:
    """Whole quotient of whole decimals; `div` itself gives a long, which may overflow."""
    return ((value - value % by) / by).cast(WHOLE)


def host_of(url: Column) -> Column:
    """Host of a url in lower case; empty for a null and without `://`."""
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of a url, up to the query; empty for a null and without `://`."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_rule(host: Column, path: Column, rules: list, pick) -> Column:
    """pick(rule) of the longest rule that fits, null for none."""
    tests = []
    for rule in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        _, domain, start = rule
        inside = (host == domain) | host.endswith("." + domain)
        tests.append(F.when(inside & path.startswith(start), F.lit(pick(rule))))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def ruled(pages: DataFrame, rules: list = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page; null where no rule fits."""
    parts = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    )
    host, path = F.col("host"), F.col("path")
    return parts.select(
        "*",
        _by_rule(host, path, rules, lambda r: r[1] + r[2]).alias("rule"),
        _by_rule(host, path, rules, lambda r: r[0]).alias("verdict"),
    )


def host_links(pages: DataFrame) -> DataFrame:
    """Different (src, dst) of the links in pages' html between different hosts."""
    linked = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(
            F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1)))
        ).alias("dst"),
    )
    lower = linked.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return lower.where((F.col("src") != "") & (F.col("src") != F.col("dst"))).distinct()


def seeds(judged: DataFrame) -> DataFrame:
    """(kind, host, seed): trust and distrust of each host by its pages under rules."""
    shares = (
        judged.where(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("verdict") == "allow").alias("trust"),
            F.count_if(F.col("verdict") == "block").alias("distrust"),
        )
    )
    return shares.select(
        "host",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("kind"), F.col(k).alias("part"))
                    for k in ("trust", "distrust")
                ]
            )
        ).alias("s"),
        "n",
    ).select(
        "s.kind",
        "host",
        _div(F.col("s.part").cast(WHOLE) * F.lit(SCALE), F.col("n"))
        .cast("long")
        .alias("seed"),
    )


def ranks(start: DataFrame, links: DataFrame) -> DataFrame:
    """(kind, host, seed, rank, base) once no rank moves any more, as `MOVED_PART` says.

    A rank is RESTART twentieths of the host's seed and the rest of the equal shares that
    its neighbours pass on: trust to the hosts that a host links to, distrust to those
    that link to it. base is the rank if every host had a whole seed.
    """
    ways = [
        links.select(F.lit(kind).alias("kind"), F.col(a).alias("host"), F.col(b).alias("to"))
        for kind, a, b in (("trust", "src", "dst"), ("distrust", "dst", "src"))
    ]
    flow = reduce(DataFrame.union, ways)
    degree = flow.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("degree"))
    flow = cut(flow.join(degree, ["kind", "host"]))
    named = [flow.select("kind", "to"), flow.select("kind", "host"), start.select("kind", "host")]
    everyone = reduce(DataFrame.union, named).distinct().toDF("kind", "host")
    seeded = cut(
        everyone.join(start, ["kind", "host"], "left").select(
            "kind", "host", F.coalesce("seed", F.lit(0)).cast(WHOLE).alias("seed")
        )
    )
    whole = F.lit(SCALE).cast(WHOLE)

    def of(seed: Column, got: Column) -> Column:
        return _div(seed * RESTART + F.coalesce(got, F.lit(0)) * (20 - RESTART), F.lit(20))

    def moved(now: str, old: str) -> Column:
        change = F.abs(F.col(now) - F.col(old))
        return (change * MOVED_PART > F.col(now)) & (change > MOVED_LEAST)

    state = seeded.select(
        "*", of(F.col("seed"), F.lit(0)).alias("rank"), of(whole, F.lit(0)).alias("base")
    )
    if flow.isEmpty():
        return state
    turn = 0
    while True:
        turn += 1
        passed = (
            flow.join(state.drop("seed"), ["kind", "host"])
            .groupBy("kind", F.col("to").alias("host"))
            .agg(
                *[
                    F.sum(_div(F.col(c), F.col("degree"))).cast(WHOLE).alias(f"got_{c}")
                    for c in ("rank", "base")
                ]
            )
        )
        before = state.select("kind", "host", "seed", *[
            F.col(c).alias(f"old_{c}") for c in ("rank", "base")
        ])
        state = before.join(passed, ["kind", "host"], "left").select(
            "kind",
            "host",
            "seed",
            of(F.col("seed"), F.col("got_rank")).alias("rank"),
            of(whole, F.col("got_base")).alias("base"),
            "old_rank",
            "old_base",
        )
        if turn % CUT_EVERY == 0:
            state = cut(state)
            going = state.where(moved("rank", "old_rank") | moved("base", "old_base"))
            if going.isEmpty():
                return state.drop("old_rank", "old_base")
        state = state.drop("old_rank", "old_base")


def blocked_hosts(ranked: DataFrame) -> DataFrame:
    """Hosts of whose evidence at least half is distrust, and more than is trust.

    Evidence is what all hosts pass on to a host, and its own seed if any of its pages is
    under a rule; the share is that of the rank in it. A host that links to blocked hosts
    only has a share of one, whoever else links to them; one without links is blocked if
    half of its pages are.
    """
    own = F.max(F.when(F.col("seed") > 0, 1).otherwise(0)).over(Window.partitionBy("host"))
    kept = SCALE * RESTART // 20
    received = F.col("base") - F.lit(kept).cast(WHOLE)
    evidence = (received + own * F.lit(kept).cast(WHOLE)).cast("double")
    share = F.when(evidence > 0, F.col("rank").cast("double") / evidence).otherwise(0.0)
    shares = ranked.select("kind", "host", share.alias("share"))
    by_host = shares.groupBy("host").agg(
        *[
            F.coalesce(F.max(F.when(F.col("kind") == k, F.col("share"))), F.lit(0.0)).alias(k)
            for k in ("trust", "distrust")
        ]
    )
    return by_host.where(
        (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= 0.5)
    ).select("host")


def judged(pages: DataFrame, rules: list = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict): allow or block for every page.

    pages: page_id, url and html; other columns are ignored. A rule's verdict holds for
    the pages that it fits, and the host's for the others. Pages without a host and
    hosts without evidence are allowed. Null html has no links, repeated rows give
    repeated results, and an empty table none. Counts by host are taken map-side first,
    and the pages of a host with many of them are spread over tasks for its verdict.
    """
    rows = ruled(pages, rules)
    hosts = blocked_hosts(ranks(cut(seeds(rows)), host_links(pages)))
    bad = hosts.withColumn("bad", F.lit(True))
    marked = lookup_join(rows, bad, "host", "left", ["page_id"])
    by_host = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return marked.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", by_host).alias("verdict"),
    )
