"""URL filter: rules on hosts and paths, and for the rest a tree of path templates judged by labelled pages.

Numbers and hexadecimal ids in a path segment are variables by their looks. Level by level, the children of a node with few
labels become a wildcard, and so do those whose share of bad labels does not differ from that of their siblings by a
two-proportion test: what is left apart is statistically its own branch. No child needs a share of its parent's pages, so a
large host keeps as small a branch apart as a small one, and no depth is the last: a branch ends where its labels are too
few for any test. A template's share of bad labels is smoothed toward its host's, and the host's toward that of all pages.
The tree is built on counts per distinct path shape.
"""

from __future__ import annotations

import itertools
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import pick, stored

#: Fixed values of the contract: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Labels that a child and its siblings need each for the test, which takes counts as normal.
SUPPORT = 10
#: Standard errors by which a child's bad share must differ from its siblings'.
DISTINCT = 1.96
#: Labels that the prior counts for, and the bad share beyond which a template is blocked.
PRIOR, LIMIT = 5.0, 0.5


def host_of(url: Column) -> Column:
    """From after the first ``://`` to the next ``/``, ``?`` or ``#``; A-Z in lower case. Empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*+)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*+([^?#]*+)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits (its host or a subdomain, its path as a prefix) as ``rule, verdict``; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, prefix in sorted(rules, key=lambda rule: len(rule[1] + rule[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape_of(path: Column) -> Column:
    """The segments of a path, numbers and hexadecimal ids as variables."""
    ids = F.regexp_replace(path, r"(?<![0-9A-Za-z])[0-9a-fA-F]{8,}+(?![0-9A-Za-z])", "{h}")
    return F.filter(F.split(F.regexp_replace(ids, "[0-9]+", "{n}"), "/"), lambda segment: segment != "")


def templates(shapes: DataFrame) -> DataFrame:
    """``host, shape, template`` from ``host, shape`` (array) ``, pages, labels, bad``, one row per host and shape.

    One round per level, while any node has labels enough to part its children. Shapes of other nodes are done with: the
    rest of their segments are wildcards.
    """
    open_, done = stored(shapes.withColumn("template", F.lit("")), "templates"), []
    for level in itertools.count():
        node = ["host", "template"]
        parents = open_.where(F.size("shape") > level).groupBy(*node).agg(*[
            F.sum(name).alias(f"all_{name}") for name in ("labels", "bad")]).where(F.col("all_labels") >= 2 * SUPPORT)
        segment = F.get("shape", F.lit(level))
        children = open_.join(parents, node).where(segment.isNotNull()).groupBy(*node, segment.alias("segment")).agg(
            F.sum("labels").alias("labels"), F.sum("bad").alias("bad"), F.first("all_labels").alias("all_labels"), F.first("all_bad").alias("all_bad"))
        nodes = children.select(*node, "segment", _differs().alias("apart"))
        named = stored(open_.withColumn("segment", segment).join(nodes, [*node, "segment"], "left"), "named")
        step = F.when(F.col("apart"), F.col("segment")).otherwise("*")
        rest = F.concat("template", F.repeat(F.lit("/*"), F.greatest(F.size("shape") - level, F.lit(0))))
        done.append(named.where("apart IS NULL").withColumn("template", rest).select(shapes.columns + ["template"]))
        open_ = named.where("apart IS NOT NULL").withColumn("template", F.concat("template", F.lit("/"), step)).select(shapes.columns + ["template"])
        if open_.isEmpty():
            return reduce(DataFrame.union, done)


def _differs() -> Column:
    """Whether a child's share of bad labels is statistically not that of its siblings."""
    rest, pool = F.col("all_labels") - F.col("labels"), F.col("all_bad") / F.col("all_labels")
    error = F.sqrt(pool * (1 - pool) * (1 / F.col("labels") + 1 / rest))
    apart = F.abs(F.col("bad") / F.col("labels") - (F.col("all_bad") - F.col("bad")) / rest) > DISTINCT * error
    return F.when((F.col("labels") >= SUPPORT) & (rest >= SUPPORT), apart).otherwise(False)


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, bad_share`` for every row of ``pages`` (``page_id``, ``url``).

    ``labels`` (``doc_id``, ``quality``, ``toxic``) belong to the page of that id; bad is quality 0 or toxic 1, a label
    with neither known is left out, and of several for one page the worst counts. A null url, or one without ``://``, has
    an empty host and path, and a template of its own. Null ids are kept and have no label; repeated rows count and come
    out as often. Urls are read whole, however long. Without any label everything beyond the rules is allowed; no pages
    give an empty table. Columns of other names are not read.
    """
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    judged = pick(labels, {"doc_id": "long", "quality": "int", "toxic": "int"}).groupBy("doc_id").agg(F.max(bad).alias("bad"))
    urls = pick(pages, {"page_id": "long", "url": "string"}).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    seen = stored(urls.withColumn("shape", shape_of(F.col("path"))).join(
        judged.where("bad IS NOT NULL"), F.col("page_id") == F.col("doc_id"), "left").drop("doc_id"), "urls")
    counts = [F.count(F.lit(1)).alias("pages"), F.count("bad").alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")]
    shapes = templates(seen.groupBy("host", "shape").agg(*counts))
    total = shapes.agg(F.sum("labels").alias("labels"), F.sum("bad").alias("bad")).first()
    share = (total["bad"] or 0) / total["labels"] if total["labels"] else 0.0
    hosts = shapes.groupBy("host").agg(((F.sum("bad") + PRIOR * share) / (F.sum("labels") + PRIOR)).alias("host_share"))
    own = shapes.groupBy("host", "template").agg(F.sum("labels").alias("labels"), F.sum("bad").alias("bad")).join(hosts, "host").select(
        "host", "template", ((F.col("bad") + PRIOR * F.col("host_share")) / (F.col("labels") + PRIOR)).alias("bad_share"))
    table = stored(shapes.select("host", "shape", "template").join(own, ["host", "template"]), "judged-shapes")
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    return seen.join(table, ["host", "shape"]).withColumn("ruled", ruled).select(
        "page_id", "host", "path", F.col("ruled.rule").alias("rule"),
        F.coalesce(F.col("ruled.verdict"), F.when(F.col("bad_share") > LIMIT, "block").otherwise("allow")).alias("verdict"),
        "template", "bad_share")
