"""Listed rules by hand, mined rules against brute force over all item sets."""

import random
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfcast.llm import url_rules as urls

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    return host, rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]


def plain_rule(host, path):
    fits = [
        (len(h + p), h + p, what)
        for what, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def plain_verdicts(rows, min_support, min_confidence, min_lift):
    """``rows``: (items, label or None); the verdict of each by mining all item sets."""
    baskets = [(frozenset(i), label) for i, label in rows if label]
    n, seen, classes = len(baskets), Counter(), Counter(label for _, label in baskets)
    for items, label in baskets:
        for size in range(1, len(items) + 1):
            for part in combinations(sorted(items), size):
                seen[part, None] += 1
                seen[part, label] += 1
    need = -(-n * min_support // 1)
    rules = {}
    for (part, label), hits in seen.items():
        if label and hits >= need:
            sure = hits / seen[part, None]
            if sure >= min_confidence and sure / (classes[label] / n) >= min_lift:
                rules[part, label] = (sure, hits / n)
    kept = {
        (part, label): v
        for (part, label), v in rules.items()
        if not any(
            rules.get((part[:i] + part[i + 1 :], label), (0, 0))[0] >= v[0] for i in range(len(part))
        )
    }
    out = []
    for items, _ in rows:
        fit = [(-s, -u, list(p), label) for (p, label), (s, u) in kept.items() if set(p) <= set(items)]
        out.append(min(fit)[3] if fit else "allow")
    return out


URLS = [
    None, "", "example.net/en/", "https://example.net/en/1", "http://EXAMPLE.net/en", "https://net",
    "https://net/", "ftp://a.b.NET/x?y#z", "x://example.com/de/", "x://notexample.com/de/",
    "x://m.example.com/de/7?k=v&w", "x://a.org/fr/", "x://a.org#/fr/", "x://org/fr/x://net/", "://net/a",
    "http://example.net?/en/", "x://É.Net/ü\n/", "x://a.com/b://c",
]


def test_listed_rules_and_parts(spark):
    pages = spark.createDataFrame(
        [(i, u, "r", "h") for i, u in enumerate(URLS)] + [(None, URLS[3], None, None)] * 2,
        "page_id long, url string, rule string, host string",
    )
    labels = spark.createDataFrame([(None, "block"), (1, None)], "id long, label string")
    got = urls.judge_pages(pages, labels, min_support=0.5).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[3 if r.page_id is None else r.page_id]
        host, path = plain_split(url)
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert verdict in (None, r.verdict)
    none = pages.where("false")
    assert urls.judge_pages(none, labels.where("false")).count() == 0


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(120):
        lang, host, tail = rng.choice("abc"), rng.choice(["spam", "news", "blog"]), rng.choice(["", "?ref=1", "#x"])
        rows.append((i, f"https://{host}.example.org/{lang}/{i}{tail}"))
        if i % 3:
            bad = host == "spam" or (lang == "b" and tail == "?ref=1") or rng.random() < 0.1
            labels.append((i, "block" if bad else "allow"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame(labels, "id long, label string")
    limits = {"min_support": 0.05, "min_confidence": 0.75, "min_lift": 1.05}
    got = {r.page_id: r.verdict for r in urls.judge_pages(pages, known, **limits).collect()}
    host, path = urls.split_url(F.col("url"))
    items = dict(pages.select("page_id", urls.url_items(F.col("url"), host, path)).collect())
    by_id = dict(labels)
    want = plain_verdicts([(items[i], by_id.get(i)) for i, _ in rows], *limits.values())
    assert [got[i] for i, _ in rows] == want
    assert {"allow", "block"} == set(want)


def test_equal_items_give_the_rules_of_brute_force(spark):
    """Query names that come together only; pages without a label that have one of them."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(150):
        host, lang = rng.choice(["spam", "news", "blog"]), rng.choice("ab")
        tail = rng.choice(["", "?u=1&v=2&w=3", "?k&l"]) if i % 3 else rng.choice(["?v", "?w#x", "?l&u", "?k", ""])
        rows.append((i, f"https://{host}.example.org/{lang}/{i}{tail}"))
        if i % 3:
            bad = "u=1" in tail and host != "news" or ("k&l" in tail and lang == "b")
            labels.append((i, "block" if bad != (rng.random() < 0.05) else "allow"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame(labels, "id long, label string")
    limits = {"min_support": 0.05, "min_confidence": 0.75, "min_lift": 1.05}
    got = {r.page_id: r.verdict for r in urls.judge_pages(pages, known, **limits).collect()}
    host, path = urls.split_url(F.col("url"))
    items = dict(pages.select("page_id", urls.url_items(F.col("url"), host, path)).collect())
    by_id = dict(labels)
    want = plain_verdicts([(items[i], by_id.get(i)) for i, _ in rows], *limits.values())
    assert [got[i] for i, _ in rows] == want
    assert "block" in want[::3]


def test_a_long_url_repeated(spark):
    """A third of the labels are one URL of forty words: its words are one item."""
    words = [a + b for a in "abcde" for b in "fghijklm"]
    rows = [(i, "https://x.example.org/" + "/".join(words)) for i in range(40)]
    rows += [(40 + i, f"https://x.example.org/{w}") for i, w in enumerate(["aa", "bb"] * 40)]
    rows += [(200, "https://y.example.org/af"), (201, "https://x.example.org/aa/q")]
    labels = [(i, "block" if i < 40 else "allow") for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    known = spark.createDataFrame(labels, "id long, label string")
    got = {r.page_id: r.verdict for r in urls.judge_pages(pages, known).collect()}
    assert all(got[i] == ("block" if i < 40 else "allow") for i in range(120))
    assert (got[200], got[201]) == ("block", "allow")


def test_op10_on_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r for r in entry.queries()["op10_url_rules"](spark, sf).collect()}
    assert len(got) == len(pages)
    for p in pages:
        r, (host, path) = got[p.page_id], plain_split(p.url)
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
