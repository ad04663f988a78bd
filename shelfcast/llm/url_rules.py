"""URL filters: a fixed list first, association rules where the list says nothing.

A URL becomes a set of items: labels of its host, words of its path, names of its query and its
kind of ending; digits become ``#``.  Labelled URLs are baskets of their items and their class,
FP-growth mines them, and rules that end in a class are kept if support, confidence and lift
reach their limits and no rule with one item fewer is as sure.  Rules are matched through an
inverted index: each is filed under its least frequent item, looked up by the items of the
distinct item sets, and checked whole.  The surest rule decides, then the best supported, then
the first in order; without one the verdict is the default.

Items that the same labelled URLs have are mined as one, so a URL of forty words that makes up a
third of the labels is one item and not 2^40 sets.  A rule that holds such an item stands for
the rules with any one of its members; those with two members go, as one with fewer is as sure.

Everything runs in the JVM.  Pages are joined by their item set, so a host with a third of all
pages is as many lookups as it has kinds of URL.

Defined results: a URL that is null or lacks ``://`` has no host, path or items and gets the
default; repeated rows stay; other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.durable import settle

#: Verdict, host and path of the list.
LISTED = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Least share of labelled URLs, confidence and lift of a rule; verdict without any rule.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT, DEFAULT = 0.01, 0.8, 1.05, "allow"

CLASS = "class="


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, listed: Sequence = LISTED) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; null if none does."""
    rule = verdict = None
    for what, rule_host, rule_path in sorted(listed, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.lit(rule_host + rule_path)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, F.lit(what)) if verdict is None else verdict.when(fits, F.lit(what))
    return rule, verdict


def url_items(url: Column, host: Column, path: Column) -> Column:
    """The sorted distinct items of a URL."""

    def words(text: Column, mark: str) -> Column:
        plain = F.regexp_replace(F.lower(text), r"\d+", "#")
        parts = F.filter(F.split(plain, r"[^\p{L}\p{M}#]+"), lambda w: w != "")
        return F.transform(parts, lambda w: F.concat(F.lit(mark), w))

    query = F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.split(F.regexp_replace(query, "=[^&]*", ""), "&"), lambda w: w != "")
    names = F.transform(keys, lambda w: F.concat(F.lit("query:"), w))
    fragment = F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array())
    items = F.concat(
        words(host, "host:"), words(path, "path:"), names, fragment.cast("array<string>")
    )
    empty = F.array().cast("array<string>")
    return F.when(F.instr(url, "://") > 0, F.array_sort(F.array_distinct(items))).otherwise(empty)


def equal_items(baskets: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """``leader, members``: frequent items that the same rows have, under their least item.

    Which rows have an item is told by the number of its item sets and 128 bits over them.  A
    group is no larger than a URL has items; support bounds their number.
    """
    sets = baskets.groupBy("items").agg(F.count(F.lit(1)).alias("rows"))
    marked = sets.select(
        "rows", F.xxhash64("items").alias("h1"), F.xxhash64(F.lit(1), "items").alias("h2"),
        F.explode("items").alias("item"),
    )
    total = baskets.agg(F.count(F.lit(1))).scalar()
    found = (
        marked.groupBy("item")
        .agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("sets"),
            F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"),
        )
        .where(F.col("rows") >= total * F.lit(min_support))
    )
    groups = found.groupBy("rows", "sets", "h1", "h2").agg(
        F.array_sort(F.collect_list("item")).alias("members")
    )
    return groups.where(F.size("members") > 1).select(F.col("members")[0].alias("leader"), "members")


def mine_rules(
    baskets: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """``items, needed, verdict, confidence, support`` from ``items, label`` rows.

    ``needed`` lists for each item those that stand for it: itself, or its equal items.
    A rule goes if one with an item fewer and the same verdict has at least its confidence:
    what it matches the shorter one matches as surely.
    """
    equal = settle(equal_items(baskets, min_support), "equal-items")
    followers = equal.select(F.explode(F.slice("members", 2, F.size("members"))).alias("item"))
    left_out = followers.agg(F.collect_list("item")).scalar()
    labelled = baskets.select(
        F.array_append(
            F.array_except("items", left_out), F.concat(F.lit(CLASS), "label")
        ).alias("items")
    )
    growth = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    model = growth.fit(labelled)
    rules = model.associationRules.where(F.col("consequent")[0].startswith(CLASS)).where(
        F.col("lift") >= min_lift
    )
    rules = settle(
        rules.select(
            F.array_sort("antecedent").alias("items"),
            F.substring(F.col("consequent")[0], len(CLASS) + 1, 100).alias("verdict"),
            "confidence",
            "support",
        ),
        "rules",
    )
    parts = rules.select(
        F.col("items").alias("whole"), "verdict", "confidence",
        F.explode(F.transform("items", lambda i: F.array_remove("items", i))).alias("items"),
    )
    shorter = rules.select("items", "verdict", F.col("confidence").alias("sure"))
    weaker = (
        parts.join(shorter, ["items", "verdict"])
        .where("sure >= confidence")
        .select(F.col("whole").alias("items"), "verdict")
        .distinct()
    )
    kept = rules.join(weaker, ["items", "verdict"], "left_anti")
    any_of = F.coalesce("members", F.array("leader"))
    return (
        kept.select("*", F.explode("items").alias("leader"))
        .join(equal, "leader", "left")
        .groupBy("items", "verdict", "confidence", "support")
        .agg(F.collect_list(any_of).alias("needed"))
    )


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``items, verdict``: the deciding rule of each item set in ``sets`` that some rule fits.

    A rule is filed under every member of its rarest item.
    """
    in_sets = sets.select(F.explode("items").alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("n")
    )
    each = rules.select("*", F.explode("needed").alias("any_of"))
    counted = (
        each.select("*", F.explode("any_of").alias("item"))
        .join(in_sets, "item", "left")
        .groupBy("needed", "verdict", "confidence", "support", "any_of")
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    )
    rarest = F.min(F.struct("n", "any_of"))["any_of"]
    filed = (
        counted.groupBy("needed", "verdict", "confidence", "support")
        .agg(rarest.alias("any_of"))
        .withColumn("item", F.explode("any_of"))
    )
    looked_up = sets.select("items", F.explode("items").alias("item")).join(filed, "item")
    fitting = looked_up.where(F.forall("needed", lambda m: F.arrays_overlap(m, F.col("items"))))
    found = F.transform("needed", lambda m: F.array_min(F.array_intersect(m, F.col("items"))))
    order = F.struct(-F.col("confidence"), -F.col("support"), F.array_sort(found), "verdict")
    return fitting.groupBy("items").agg(F.min(order)["verdict"].alias("mined"))


def judge_pages(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
    listed: Sequence = LISTED, min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, default: str = DEFAULT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    ``labels`` has ``id, label`` (allow or block) for some pages; pages that the list judges are
    labelled by it instead.
    """
    url = F.col("url")
    host, path = split_url(url)
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    judged = source.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    judged = judged.select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"),
        url_items(url, F.col("host"), F.col("path")).alias("items"),
    )
    judged = settle(judged, "urls")
    known = labels.where("id is not null and label is not null").groupBy("id").agg(
        F.max("label").alias("label")  # block comes after allow: one bad label is enough
    )
    baskets = (
        judged.join(known, judged["page_id"] == known["id"], "left")
        .select("items", F.coalesce("listed", "label").alias("label"))
        .where("label is not null")
    )
    rules = mine_rules(baskets, min_support, min_confidence, min_lift)
    sets = judged.where(F.col("listed").isNull()).select("items").distinct()
    # written, so that the join to the pages is dealt out by itself and a hot set can be split
    decided = settle(match_rules(sets, settle(rules, "kept-rules")), "decided")
    return judged.join(decided, "items", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("listed", "mined", F.lit(default)).alias("verdict"),
    )
