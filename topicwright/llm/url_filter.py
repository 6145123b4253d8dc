"""URL filter: rules by host and path, and for all other pages trust and distrust that spread over links between hosts.

Trust starts at hosts in proportion to the share of their pages that a rule allows and follows links: a personalised PageRank. Distrust
starts in proportion to the share that a rule blocks and follows links backwards, to those who link there. A host
whose distrust exceeds its trust by THRESHOLD is blocked; the unit is what a host has whose own pages are all ruled on alike
and which no link reaches. What a blocked host hands back is shared by all who link there, so with many of them each gets next to
nothing; a host is therefore also blocked when its distrust would exceed its trust by as much if none but its own links
led to the hosts it links to, each weighed by its share of the host's links. That verdict depends on no other linking host.

Links are absolute `href`s and those that begin with `//`; others stay on their host and say nothing. All is DataFrame
functions: hosts and links are summed up before they are joined, ranks go to the shared folder after each step, and only the
largest change of a step comes to the driver.

A null url, or one without `://`, has an empty host and path, fits no rule and is allowed, as nothing is known of it. Null html
has no links. Repeated rows are judged alike and count as pages of their own.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwright.llm.shared import written

DAMPING = 0.85
THRESHOLD = 0.5
STEPS = 50
CLOSE = 1e-6
#: Parts that the pages of a host are dealt to when they are joined with the verdict on it.
SALTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""
ADDRESS = r"(?s)^(?:(?!://).)*+://([^/?#]*)([^?#]*)"


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """What is between the first `://` and `/`, `?`, `#` or the end, with A-Z lower-cased."""
    return lowered(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict), or null.

    Rules are `host/path` to `allow` or `block`, a configured list that travels in the plan. They fit a host and its
    subdomains where the path starts with theirs.
    """
    by_host: dict[str, list] = {}
    for rule, verdict in rules.items():
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name, []).append({"size": len(rule), "rule": rule, "verdict": verdict, "path": slash + rest})
    kind = "map<string, array<struct<size: int, rule: string, verdict: string, path: string>>>"
    known = F.from_json(F.lit(json.dumps(by_host)), kind)
    labels = F.split(host, r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    of_names = F.flatten(F.filter(F.transform(names, lambda n: F.element_at(known, n)), lambda x: x.isNotNull()))
    return F.array_max(F.filter(of_names, lambda r: F.startswith(path, r["path"])))


def ruled(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(page_id, host, path, rule, said, links): pages with the longest rule that fits and the hosts they link to."""
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lowered))
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), links.alias("links"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.withColumn("_rule", rule).select("page_id", "host", "path", "_rule.rule", F.col("_rule.verdict").alias("said"), "links")


def host_links(judged: DataFrame) -> DataFrame:
    """(source, target, pages): how many pages of one host link to another."""
    pairs = judged.select(F.col("host").alias("source"), F.explode("links").alias("target"))
    pairs = pairs.where("source <> '' and target <> '' and source <> target")
    return pairs.groupBy("source", "target").agg(F.count("*").alias("pages"))


def seeds(judged: DataFrame) -> DataFrame:
    """(host, good, bad): the shares of a host's pages that rules allow and block."""
    share = lambda verdict: F.avg(F.when(F.col("said") == verdict, 1.0).otherwise(0.0))
    return judged.where("host <> ''").groupBy("host").agg(share("allow").alias("good"), share("block").alias("bad"))


def spread(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(host, trust, distrust) of all hosts of seeds (host, good, bad) and links (source, target, pages)."""
    links = written(links, "links")
    out = links.groupBy(F.col("source").alias("a")).agg(F.sum("pages").alias("of"))
    into = links.groupBy(F.col("target").alias("a")).agg(F.sum("pages").alias("of"))
    onward = links.join(out, F.col("source") == F.col("a")).selectExpr("a", "target as b", "pages / of as trust", "0.0D as distrust")
    back = links.join(into, F.col("target") == F.col("a")).selectExpr("a", "source as b", "0.0D as trust", "pages / of as distrust")
    flow = written(onward.union(back), "flow")
    hosts = links.select(F.col("source").alias("host")).union(links.select("target")).distinct()
    base = hosts.join(seeds, "host", "full").fillna(0.0, ["good", "bad"])
    base = base.selectExpr("host", f"good * {1 - DAMPING} as good", f"bad * {1 - DAMPING} as bad")
    ranks = written(base.selectExpr("*", "good as trust", "bad as distrust", "good + bad as change"), "ranks")
    for _ in range(STEPS):
        at = ranks.selectExpr("host as a", "trust as t", "distrust as d")
        sums = flow.join(at, "a").groupBy(F.col("b").alias("_host"))
        sums = sums.agg(F.sum(F.col("trust") * F.col("t")).alias("t"), F.sum(F.col("distrust") * F.col("d")).alias("d"))
        step = ranks.join(sums, F.col("host") == F.col("_host"), "left")
        step = step.selectExpr(
            "host", "good", "bad", f"good + {DAMPING} * coalesce(t, 0D) as trust", f"bad + {DAMPING} * coalesce(d, 0D) as distrust",
            "trust as t0", "distrust as d0",
        )
        ranks = written(step.selectExpr("host", "good", "bad", "trust", "distrust", "greatest(abs(trust - t0), abs(distrust - d0)) as change"), "ranks")
        if (ranks.agg(F.max("change")).first()[0] or 0) <= CLOSE:
            break
    return ranks.select("host", "trust", "distrust")


def complicity(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(host, alone): the distrust of hosts that link to blocked ones, each link by its share of the host's own links."""
    out = links.groupBy(F.col("source").alias("host")).agg(F.sum("pages").alias("of"))
    bad = seeds.where("bad > 0").select(F.col("host").alias("target"), "bad")
    into = links.join(bad, "target").groupBy(F.col("source").alias("_host")).agg(F.sum(F.col("pages") * F.col("bad")).alias("bad"))
    return out.join(into, F.expr("host = _host")).selectExpr("host", f"{DAMPING * (1 - DAMPING)} * bad / of as alone")


def judge(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of pages (page_id bigint, url string, html string)."""
    judged = written(ruled(pages.select("page_id", "url", "html"), rules), "pages")
    base, links = written(seeds(judged), "seeds"), written(host_links(judged), "links")
    alone = base.join(complicity(base, links), "host", "full").select(
        F.col("host").alias("_host"), (F.coalesce("bad", F.lit(0.0)) * (1 - DAMPING) + F.coalesce("alone", F.lit(0.0))).alias("alone")
    )
    ranks = spread(base, links).join(alone, F.expr("host = _host"), "left").drop("_host")
    blocked = ranks.where(f"greatest(distrust, alone) - trust >= {THRESHOLD * (1 - DAMPING)}").select(F.col("host").alias("_host"))
    verdict = F.coalesce("said", F.when(F.col("_host").isNotNull(), "block").otherwise("allow"))
    # A blocked host is looked up under SALTS keys, so that the pages of a large host are dealt to as many tasks.
    blocked = blocked.select("_host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = judged.drop("links").withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    joined = salted.join(blocked, F.expr("host = _host and salt = _salt and said is null"), "left")
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
