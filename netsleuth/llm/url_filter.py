"""URL filters: rules first, then a tree of path templates per host.

A path becomes segments; digits in a segment stand for any number, and a segment with
more than ``MANY`` different values under its host and parent, with few different paths
below each, is a wildcard. A node of a host's tree is a template prefix; the tree covers whole paths. The urls that a rule decides
are the labelled ones: a node's purity is its share of blocked labels, smoothed toward
its parent's over all hosts, then toward the same prefix on all hosts. Branches of one
parent whose label shares do not differ significantly from those of the whole parent
are merged into it. A url without a rule takes the verdict of its deepest template.

Nothing is gathered but counts per template. A host with most urls is one key of grouped
sums that combine map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.shared import written

#: (verdict, host, start of the path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

MANY = 20
SMOOTHING = 2.0
SIGNIFICANT = 1.96

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. A rule fits its host and subdomains."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, rule_host + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def templates(urls: DataFrame, many: int = MANY) -> DataFrame:
    """``urls`` (host, path, ...) with ``nodes``: the template prefixes of the whole path, shortest first.

    A prefix with at most ``many`` paths below it can hold no further wildcard, so the rest of those paths is taken as it
    is; the others are split level by level until none is left.
    """
    segments = F.filter(F.split(F.regexp_replace("path", r"[0-9]+", "<n>"), "/"), lambda s: s != "")
    # each path counts once, however many rows hold it
    paths = urls.select("host", "path").distinct().select("host", "path", F.array(F.lit("")).alias("nodes"), segments.alias("_s"))
    rows, done = written(paths, "paths").withColumn("_open", F.size("_s") > 0), []
    while True:
        done.append(rows.filter(~F.col("_open")))
        rows = rows.filter("_open")
        if rows.isEmpty():
            break
        here = rows.withColumns({"_parent": F.element_at("nodes", -1), "_seg": F.element_at("_s", 1)})
        counts = here.groupBy("host", "_parent", "_seg").agg(F.count(F.lit(1)).alias("_n"))
        wide = counts.groupBy("host", "_parent").agg(
            F.count(F.lit(1)).alias("_kinds"), F.sum("_n").alias("_all")).filter(
            (F.col("_kinds") > many) & (F.col("_all") < F.col("_kinds") * many)).select(
            F.col("host").alias("_wh"), F.col("_parent").alias("_wp"), F.lit(True).alias("_wild"))
        joined = here.join(written(wide, "wildcards"), (F.col("host") == F.col("_wh")) & (F.col("_parent") == F.col("_wp")), "left")
        name = F.concat("_parent", F.lit("/"), F.when(F.col("_wild"), "*").otherwise(F.col("_seg")))
        rest = F.slice("_s", 2, F.greatest(F.size("_s") - 1, F.lit(0)))
        named = written(joined.select("host", "path", F.array_append("nodes", name).alias("nodes"), rest.alias("_s")), "level")
        node = F.element_at("nodes", -1)
        large = written(named.filter(F.size("_s") > 0).groupBy("host", node.alias("_node")).agg(F.count(F.lit(1)).alias("_n")).filter(
            F.col("_n") > many).select(F.col("host").alias("_lh"), F.col("_node").alias("_ln"), F.lit(True).alias("_more")), "large")
        joined = named.join(large, (F.col("host") == F.col("_lh")) & (node == F.col("_ln")), "left")
        rows = joined.select("host", "path", "nodes", "_s", ((F.size("_s") > 0) & F.coalesce("_more", F.lit(False))).alias("_open"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    below = F.when(F.size("_s") > 0, F.transform(F.sequence(F.lit(1), F.size("_s")), lambda i: F.concat(
        F.element_at("nodes", -1), F.lit("/"), F.array_join(F.slice("_s", F.lit(1), i), "/"))))
    whole = whole.select(F.col("host").alias("_ph"), F.col("path").alias("_pp"), F.concat(
        "nodes", F.coalesce(below, F.array().cast("array<string>"))).alias("nodes"))
    return urls.join(whole, (F.col("host") == F.col("_ph")) & (F.col("path") == F.col("_pp"))).drop("_ph", "_pp")


def template_purity(labelled: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """(host, node, purity) of the labelled templates, and (null, node, purity) of those over all hosts.

    ``labelled`` is (host, nodes, bad) with bad 0 or 1.
    """
    each = labelled.select("host", "bad", F.posexplode("nodes").alias("level", "node"))
    own = written(each.groupBy("host", "level", "node").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").cast("double").alias("b")), "templates")
    parent = F.when(F.col("level") > 0, F.regexp_replace("node", r"/[^/]*$", ""))
    # prefixes over all hosts, each smoothed toward the one above it, from the counts of its whole chain
    wide = written(own.groupBy("level", "node").agg(F.sum("n").alias("n"), F.sum("b").alias("b")), "prefixes")
    parts = F.split("node", "/")
    chain = wide.select("node", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(
        F.slice(parts, F.lit(1), i), "/"))).alias("_above")).join(
        wide.select(F.col("node").alias("_above"), "level", "n", "b"), "_above").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("level", "n", "b"))).alias("_chain"))
    everywhere = written(chain.select("node", F.aggregate(
        "_chain", F.lit(0.5), lambda p, x: (x["b"] + smoothing * p) / (x["n"] + smoothing)).alias("purity")), "purity")
    # a branch that does not differ from its parent is merged into it: it takes the parent's counts
    up = own.select(F.col("host").alias("_h"), F.col("node").alias("_of"), F.col("n").alias("_n"), F.col("b").alias("_b"))
    tree = own.withColumn("_up", parent).join(up, (F.col("host") == F.col("_h")) & (F.col("_up") == F.col("_of")), "left")
    share, whole = F.col("b") / F.col("n"), F.col("_b") / F.col("_n")
    z = F.abs(share - whole) / F.sqrt(F.greatest(whole * (1 - whole), F.lit(0.01)) / F.col("n"))
    merged = F.col("_n").isNotNull() & (z < SIGNIFICANT)
    tree = tree.join(everywhere, "node")
    counts = lambda mine, theirs: F.when(merged, F.col(theirs)).otherwise(F.col(mine))
    hosts = tree.select("host", "node", ((counts("b", "_b") + smoothing * F.col("purity")) / (counts("n", "_n") + smoothing)).alias("purity"))
    return hosts.unionByName(everywhere.select(F.lit(None).cast("string").alias("host"), "node", "purity"))


def judge(pages: DataFrame, rules=RULES, bar: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, purity) of every url.

    A rule's verdict stands. Otherwise the url is blocked where the smoothed share of
    blocked labels of its deepest labelled template reaches ``bar``; a template that no
    labelled url of its host shares is judged by the same prefix on all hosts. Without
    any label every other url is allowed. A null url or one without :// has an empty host
    and path. Rows keep their number; other columns are ignored.
    """
    urls = pages.select("page_id", host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = templates(urls.withColumns({"rule": rule, "_verdict": verdict}))
    urls = written(urls, "urls")
    purity = written(template_purity(urls.filter("rule is not null").select(
        "host", "nodes", (F.col("_verdict") == "block").cast("int").alias("bad"))), "verdicts")
    open_nodes = urls.filter("rule is null").select("host", "nodes").distinct()
    spread = open_nodes.select("host", "nodes", F.posexplode("nodes").alias("_level", "node"))
    of_host = purity.filter("host is not null").select(F.col("host").alias("_h"), F.col("node").alias("_n"), F.col("purity").alias("_own"))
    of_all = purity.filter("host is null").select(F.col("node").alias("_m"), F.col("purity").alias("_any"))
    seen = spread.join(of_host, (F.col("host") == F.col("_h")) & (F.col("node") == F.col("_n")), "left").join(
        of_all, F.col("node") == F.col("_m"), "left")
    # a label of the own host outweighs one elsewhere at the same depth
    best = seen.filter(F.coalesce("_own", "_any").isNotNull()).groupBy("host", "nodes").agg(
        F.max_by(F.coalesce("_own", "_any"), F.col("_level")).alias("purity"))
    best = written(best, "open").select(F.col("host").alias("_h"), F.col("nodes").alias("_n"), "purity")
    joined = urls.join(best, (F.col("host") == F.col("_h")) & (F.col("nodes") == F.col("_n")), "left")
    other = F.when(F.coalesce("purity", F.lit(0.0)) >= bar, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("_verdict", other).alias("verdict"),
                         F.when(F.col("rule").isNull(), F.col("purity")).alias("purity"))
