"""Line templates against a plain tree of dictionaries."""

import random
import re

from shelfcast.llm import line_templates


def plain_dedup(pairs, min_docs=2, min_tokens=3):
    """Texts after dedup, in the order of ``pairs``."""
    order = sorted(range(len(pairs)), key=lambda n: (pairs[n][0] is None, pairs[n][0] or 0, n))
    holders, first, having = {}, {}, {}
    for n in order:
        for at, line in enumerate((pairs[n][1] or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            words = ["<*>" if re.search("[0-9]", w) else w for w in words]
            if len(words) < min_tokens:
                continue
            found = [("whole", tuple(words))]
            for j in range(4 if len(words) >= 11 else 0):
                low, high = (3 + (len(words) - 3) * k // 4 for k in (j, j + 1))
                found.append((j, len(words), tuple(words[:low]), tuple(words[high:])))
            having[n, at] = found
            for t in found:
                holders.setdefault(t, set()).add(n)
                first.setdefault(t, (n, at))
    out = []
    for n, (_, text) in enumerate(pairs):
        if text is None:
            out.append(None)
            continue
        out.append("\n".join(
            line for at, line in enumerate(text.split("\n"))
            if not any(len(holders[t]) >= min_docs and first[t] != (n, at) for t in having.get((n, at), []))
        ))
    return out


def check(docs_frame, pairs, **limits):
    docs = docs_frame(pairs).coalesce(1)
    got = line_templates.dedup_lines(docs, **limits)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = got.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    want = [(i, t) for (i, _), t in zip(pairs, plain_dedup(pairs, **limits))]
    assert sorted(((r.doc_id, r.text) for r in rows), key=key) == sorted(want, key=key)
    assert all(r.text is None or r.n_chars == len(r.text) for r in rows)


LONG = "one two three four five six seven eight nine ten eleven twelve"


def test_templates(spark, docs_frame):
    pairs = [
        (1, f"a b c\n{LONG}\n\nx y"), (2, "a b c\nx y\n"), (3, LONG.replace("five", "FIVE")),
        (4, LONG.replace("two", "TWO")), (5, LONG.replace("four", "4th").replace("twelve", "dozen")),
        (6, "page 3 of 10"), (7, "page 44 of x9"), (8, "page 3 of ten"), (9, ""), (10, None),
        (11, "same same same\nsame same same"), (12, "  é ñ x ö\n\t\x0b\x0c\r"),
        (12, "  é ñ x ö\n\t\x0b\x0c\r"), (None, "a b c\nzz"), (None, "only mine here"),
        (0, "only mine here"),
    ]
    check(docs_frame, pairs)
    check(docs_frame, pairs, min_docs=3)
    check(docs_frame, pairs, min_tokens=1)
    check(docs_frame, [])


def test_random_documents(spark, docs_frame):
    rng = random.Random(9)
    lines = [" ".join(rng.choice("ab c d e1 f g".split()) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    pairs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    check(docs_frame, pairs)


def test_very_long_texts(spark, docs_frame):
    many = "\n".join(f"line number of it {'x' * (i % 7)}{chr(97 + i % 26)} {chr(97 + i // 26 % 26)} {chr(97 + i // 676 % 26)}" for i in range(30_000))
    check(docs_frame, [(1, many), (2, many), (3, "w" * 200_000 + " a b"), (4, "1" * 200_000 + " a b")])


def test_rows_of_figures_stay(spark, docs_frame):
    tables = [
        "\n".join(f"{k}{i} {k * i + 7}.5 2024-01-{i + 10}\n| {i}{k} | {i} | {k}{k} |" for i in range(9)) for k in (1, 2)
    ]
    long_rows = [" ".join(str(k * 100 + i) for i in range(14)) + "\n" + " ".join(["-"] * 9 + [f"{k}."] * 5) for k in (1, 2)]
    texts = [f"{t}\n{r}\nTotal of page {k}\n1 2 3" for k, (t, r) in enumerate(zip(tables, long_rows))]
    got = {r.doc_id: r.text for r in line_templates.dedup_lines(docs_frame([*enumerate(texts)])).collect()}
    # the line with words recurs with other figures, the row of equal figures as it is
    assert got == {0: texts[0], 1: texts[1].removesuffix("\nTotal of page 1\n1 2 3")}


def test_lines_are_parsed_once(spark, docs_frame):
    """The condition on the number of tokens masks and splits no line a second time."""
    rows = line_templates.numbered_rows(docs_frame([(1, "a b c 4")]), "doc_id", "text")
    plan = line_templates.hashed_lines(rows, 3)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any(w in line for line in filters for w in ("split(", "<*>"))


def test_tokens_with_letters_are_counted(spark):
    lines = ["", "a", " a\t- b--\x0b7 x9 ", "É | 日本\r..\x0c--", "-", "a b", "  ,,,,  b  <*> ß1", "  a\u0085 ."]
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    spaced = line_templates.spaced_line(frame.line)
    n = line_templates.F.size(line_templates.tokens_of(spaced))
    got = frame.select("line", n, line_templates.lettered_count(spaced, n)).collect()
    for line, tokens, lettered in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        assert (tokens, lettered) == (len(words), sum(any(c.isalpha() for c in w) for w in words))
