"""The quality ledger against a plain count of every measure, policies and ablation."""

from pyspark.sql import functions as F

from shelfcast.llm import quality_ledger as ledger


def plain_measures(text):
    text = text or ""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def plain_kept(text):
    n, chars, symbols, lines, again, repeated = plain_measures(text)
    return not (
        n < 50 or 100 * repeated > 50 * n or 10 * symbols > n or 2 * again > lines
        or chars < 2 * n or chars > 15 * n
    )


TEXTS = [
    None, "", " \n\t", "a b c a b c", "a a a a", "x\nx\n x\n\nx", "#*$%&|<> é🙂", "é\x1cü\x85 z w",
    "one two three " * 40, " ".join(f"w{i}x" for i in range(60)), "| " * 60 + "a " * 60, "k" * 40_000,
]


def test_measures_and_odd_rows(spark, docs_frame):
    pairs = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "a b c"), (None, None)]
    rows = ledger.apply_policy(ledger.build_ledger(docs_frame(pairs)), ledger.STANDARD).collect()
    got = [(r.doc_id, tuple(r[m] for m in ledger.MEASURES), r.kept) for r in rows]
    want = [(i, plain_measures(t), plain_kept(t)) for i, t in pairs]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert ledger.build_ledger(docs_frame([])).count() == 0
    kept = ledger.keep_documents(docs_frame(pairs), ledger.STANDARD)
    assert kept.columns == docs_frame(pairs).columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in pairs if plain_kept(t)]


def test_ablation_counts_documents(spark, docs_frame):
    book = ledger.build_ledger(docs_frame(enumerate(TEXTS)))
    policies = [ledger.BASE, ledger.STANDARD]
    got = {(r.policy, r.rule): (r.failed, r.rejected, r.freed) for r in ledger.ablation(book, policies).collect()}
    rules = list(ledger.RULES)
    bits = [r.fail_bits for r in book.collect()]
    for policy in policies:
        names = [*policy.hard, *policy.soft]

        def out(b, names):
            return any(b >> rules.index(n) & 1 for n in names)

        for rule in names:
            others = [n for n in names if n != rule]
            assert got[policy.name, rule] == (
                sum(out(b, [rule]) for b in bits),
                sum(out(b, names) for b in bits),
                sum(out(b, names) and not out(b, others) for b in bits),
            )


def test_bits_by_source(spark, docs_frame):
    book = ledger.build_ledger(docs_frame(enumerate(TEXTS))).withColumn("all", F.lit(1))
    row = ledger.bits_by(book, "all").first()
    bits = [r.fail_bits for r in book.collect()]
    some = every = bits[0]
    for b in bits:
        some, every = some | b, every & b
    assert (row.some_fail, row.all_fail) == (some, every)
