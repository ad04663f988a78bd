"""Line dedup with a log-template tree of fixed depth.

A line becomes tokens; tokens with digits are variable fields at once.  The tree has two fixed
levels, token count and ``LEADING`` leading tokens, whose leaves hold templates: the whole line,
and for longer lines the line with one of ``SEGMENTS`` equal parts of its tail generalised to a
variable field.  A template with variable fields needs words: ``MIN_WORDS`` and one token in
``WORD_SHARE`` (of the line) are constant tokens with letters.  Lines with digits and fewer words,
such as rows of figures, recur only as they are.  A template recurs if lines of ``min_docs`` documents have it.  Of a recurring
template the first line stays (smallest document id, then row and place), and every other line
that has it goes.  So what is left of a group of copies is one copy.

Everything is DataFrame operations on hashes: only leaves met in two documents or more are
looked at, counts are summed before they are shuffled, and the text is shuffled once, by row.
A leaf and a template are 64 bits each and are compared together.

Defined results: a null text stays null; lines with fewer than ``min_tokens`` tokens, blank ones
among them, stay; null ids come last in the order of documents; of repeated rows each is a
document of its own; all other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.durable import settle

#: Leading tokens in the tree, parts of the tail, fewest tokens of a line with parts and at all.
LEADING, SEGMENTS, PARTED_TOKENS, MIN_TOKENS = 3, 4, 11, 3
MIN_DOCS = 2
#: Constant tokens with letters in a generalised template: at least so many, and one in so many.
MIN_WORDS, WORD_SHARE = 2, 3

#: White space besides the blank; parsing works on lines with one before each token and no other.
OTHER_SPACE = r"[\x09-\x0D]"
#: A token with a digit, and one without a letter, with the blank before it.
VARIABLE = r"\x20[^\x200-9]*+[0-9][^\x20]*+"
LETTERLESS = r"\x20[^\x20\p{L}]++(?!\p{L})"
FIELD = "<*>"


def spaced_line(line: Column) -> Column:
    """The line behind a blank, with blanks as its only white space."""
    blanks = F.when(line.rlike(OTHER_SPACE), F.regexp_replace(line, OTHER_SPACE, " ")).otherwise(line)
    return F.concat(F.lit(" "), blanks)


def has_tokens(spaced: Column, number: int) -> Column:
    """Whether there are so many tokens; reads no further than these."""
    return spaced.rlike(rf"\A(?:\x20*+[^\x20]++){{{max(number, 0)}}}")


def masked_line(spaced: Column) -> Column:
    """The line with its variable tokens as ``<*>``."""
    return F.when(spaced.rlike("[0-9]"), F.regexp_replace(spaced, VARIABLE, f" {FIELD}")).otherwise(spaced)


def tokens_of(spaced: Column) -> Column:
    # a pattern of one character is split without a regular expression
    return F.array_remove(F.split(spaced, " "), "")


def lettered_count(masked: Column, n: Column) -> Column:
    """Tokens with letters, of ``n``: most lines have no others, and nothing is cut out of those."""
    letterless = F.regexp_count(masked, F.lit(LETTERLESS))
    return F.when(masked.rlike(LETTERLESS), n - letterless).otherwise(n)


def _pieces(tokens: Column, n: Column) -> list[Column]:
    """Leading tokens, then the parts of the tail."""
    tail = F.greatest(n - LEADING, F.lit(0))
    edges = [0] + [LEADING + F.floor(tail * j / SEGMENTS).cast("int") for j in range(SEGMENTS + 1)]
    return [F.slice(tokens, F.lit(low) + 1, high - low) for low, high in zip(edges, edges[1:])]


def template_hashes(tokens: Column, n: Column, spaced: Column, words: Column, hashes: Column) -> Column:
    """The templates of one line: the whole, then one for each generalised part.

    ``words`` counts the constant tokens with letters, ``hashes`` has one of the leading tokens
    and one of each part, so that templates hash numbers and no token again.
    """
    head, *parts = [F.get(hashes, F.lit(j)) for j in range(SEGMENTS + 1)]
    enough = lambda count: (count >= MIN_WORDS) & (count * WORD_SHARE >= n)
    lettered = lambda ts: F.size(F.filter(ts, lambda t: t.rlike(r"\p{L}")))
    # a part has this many tokens at most; prose has enough words whichever part is left out
    surely = enough(words - F.floor((n - LEADING) / SEGMENTS) - 1)
    general = [
        F.xxhash64(F.lit(j + 1), n, head, *parts[:j], *parts[j + 1 :]) for j in range(SEGMENTS)
    ]
    pieces = _pieces(tokens, n)[1:]
    some = [F.when(enough(words - lettered(piece)), g) for piece, g in zip(pieces, general)]
    raw = F.xxhash64(F.lit(-1), n, tokens_of(spaced))
    bare = ~enough(words) & spaced.rlike("[0-9]")
    whole = F.when(bare, raw).otherwise(F.xxhash64(F.lit(0), n, hashes))
    return (
        F.when(n < PARTED_TOKENS, F.array(whole))
        .when(surely, F.array(whole, *general))
        .otherwise(F.array_compact(F.array(whole, *some)))
    )


def numbered_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``uid, doc_id, text, row``, written once; ``row`` has the other columns."""
    rest = [F.col(c) for c in docs.columns if c != text_col] or [F.lit(None).alias("none")]
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"), F.struct(*rest).alias("row"),
    )
    return settle(rows, "rows")


def hashed_lines(rows: DataFrame, min_tokens: int) -> DataFrame:
    """``uid, doc_id, at, leaf, templates`` of every line with ``min_tokens`` tokens."""
    lines = rows.select("uid", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    # a condition on the parsed tokens would be moved below the parsing and parse every line twice
    parsed = (
        lines.withColumn("spaced", spaced_line(F.col("line")))
        .where(has_tokens(F.col("spaced"), min_tokens))
        .withColumn("masked", masked_line(F.col("spaced")))
        .withColumn("tokens", tokens_of(F.col("masked")))
        .withColumn("n", F.size("tokens"))
        .withColumn("words", lettered_count(F.col("masked"), F.col("n")))
        .withColumn("hashes", F.array(*[F.xxhash64(p) for p in _pieces(F.col("tokens"), F.col("n"))]))
    )
    leaf = F.xxhash64("n", F.get("hashes", F.lit(0)))
    templates = template_hashes(*map(F.col, ("tokens", "n", "spaced", "words", "hashes")))
    return parsed.select("uid", "doc_id", "at", leaf.alias("leaf"), templates.alias("templates"))


def dropped_lines(rows: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``uid, at``: rows and places of the lines that go, from ``uid, doc_id, text``."""
    hashed = settle(hashed_lines(rows, min_tokens), "lines")
    # A template cannot recur in a leaf of one document.  Written, as the templates are below, so
    # that the join is dealt out by itself and a hot leaf or template can be split.
    shared = settle(
        hashed.groupBy("leaf")
        .agg(F.min("uid").alias("least"), F.max("uid").alias("most"))
        .where("least < most")
        .select("leaf"),
        "shared-leaves",
    )
    open_lines = settle(hashed.join(shared, "leaf", "left_semi"), "open-lines")
    held = open_lines.select("uid", "doc_id", "at", "leaf", F.explode("templates").alias("template"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "at")
    recurring = settle(
        held.groupBy("leaf", "template", "uid")
        .agg(F.min(place).alias("place"))
        .groupBy("leaf", "template")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("leaf", "template", F.col("first.uid").alias("uid_1"), F.col("first.at").alias("at_1")),
        "recurring",
    )
    later = held.join(recurring, ["leaf", "template"]).where("uid <> uid_1 or at <> at_1")
    return later.select("uid", "at").distinct()


def _flags(dropped: DataFrame) -> DataFrame:
    """``uid, flags``: one byte a line up to the last that goes, ``1`` for those that go."""
    places = dropped.groupBy("uid").agg(F.sort_array(F.collect_list("at")).alias("places"))
    gap = lambda p, i: p - F.coalesce(F.get("places", i - 1), F.lit(-1)) - 1
    mark = lambda p, i: F.concat(F.repeat(F.lit("0"), gap(p, i)), F.lit("1"))
    marks = F.transform("places", mark)
    return places.select("uid", F.array_join(marks, "").cast("binary").alias("flags"))


def dedup_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """``doc_id, row, n_lines, n_dropped, kept_text`` for every row."""
    rows = numbered_rows(docs, id_col, text_col)
    flags = _flags(dropped_lines(rows, min_docs, min_tokens))
    joined = rows.join(flags, "uid", "left")
    lines = F.split("text", "\n")
    # of binary values substring() takes one step, however long they are
    stays = lambda line, i: F.substring(F.col("flags"), i + 1, F.lit(1)) != F.lit(b"1")
    cut = F.array_join(F.filter(lines, stays), "\n")
    return joined.select(
        "doc_id", "row",
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.length(F.regexp_replace(F.col("flags").cast("string"), "0", "")), F.lit(0))
        .cast("long").alias("n_dropped"),
        F.when(F.col("flags").isNull(), F.col("text")).otherwise(cut).alias("kept_text"),
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    length_col: str | None = "n_chars", min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """``docs`` without the lines that go; all rows and columns stay.

    Where ``length_col`` is a column it follows the new text.
    """
    done = dedup_rows(docs, id_col, text_col, min_docs, min_tokens)
    columns = []
    for name, kind in docs.dtypes:
        if name == text_col:
            columns.append(F.col("kept_text").alias(name))
        elif name == length_col:
            columns.append(F.char_length("kept_text").cast(kind).alias(name))
        else:
            columns.append(F.col("row")[name].alias(name))
    return done.select(*columns)
