"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document.  The ledger keeps the measurements and one
integer in which bit *k* says that rule *k* failed.  A policy is a name, a version and two sets
of rules; applying one, or asking what a rule adds to it, only needs the integer.

Defined results: a null text measures 0 everywhere; every input row gives one ledger row, so
repeated rows and null ids stay; other columns of the input are not read; an empty table gives
an empty ledger.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcast.llm.arrow import map_lists

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
)

#: Rules in the order of their bits: a condition over the measures under which a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails any rule of ``hard``, or ``soft_limit`` rules of ``soft``."""

    name: str
    version: int
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    soft_limit: int = 2


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy(
    "standard", 1, ("few_words", "repeated_windows", "many_symbols", "repeated_lines"),
    ("short_words", "long_words"), 1,
)

#: White space that separates words: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three found twice or more, each counted once."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            covered[i : i + 3] = covered[j : j + 3] = b"\1\1\1"
    return covered.count(1)


def measure(text: str | None) -> tuple[int, ...]:
    """The ``MEASURES`` of one text."""
    if not text:
        return (0,) * len(MEASURES)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: splits at the six characters of SPACES and no others
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(data.count(s) for s in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _start():
    def work(texts: list) -> dict[str, list]:
        columns = list(zip(*map(measure, texts))) or [()] * len(MEASURES)
        return {m: list(c) for m, c in zip(MEASURES, columns)}

    return work


def rule_bits(names: Sequence[str], rules: dict[str, str] = RULES) -> int:
    """The bits of the named rules."""
    order = list(rules)
    return sum(1 << order.index(name) for name in set(names))


def build_ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, str] = RULES
) -> DataFrame:
    """``doc_id``, the measures, and ``fail_bits``; one pass, no shuffle."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([StructField(m, LongType()) for m in MEASURES])
    measured = map_lists(source, _start, schema, carry=1)
    bits = [
        F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
        for k, rule in enumerate(rules.values())
    ]
    return measured.withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits))


def rejected(bits: Column, policy: Policy, rules: dict[str, str] = RULES) -> Column:
    """Whether ``policy`` rejects a document with these failure bits."""
    hard, soft = (F.lit(rule_bits(r, rules)).cast("long") for r in (policy.hard, policy.soft))
    by_soft = F.bit_count(bits.bitwiseAND(soft)) >= policy.soft_limit
    by_hard = bits.bitwiseAND(hard) != 0
    return (by_hard | by_soft) if policy.soft else by_hard


def apply_policy(ledger: DataFrame, policy: Policy, rules: dict[str, str] = RULES) -> DataFrame:
    """The ledger with ``kept`` under one policy."""
    return ledger.withColumn("kept", ~rejected(F.col("fail_bits"), policy, rules))


def keep_documents(
    docs: DataFrame, policy: Policy, text_col: str = "text", rules: dict[str, str] = RULES
) -> DataFrame:
    """The rows of ``docs`` that ``policy`` keeps, with all their columns and no others."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    judged = apply_policy(build_ledger(rows, "row", "text", rules), policy, rules)
    return judged.where("kept").select("doc_id.*")


def ablation(
    ledger: DataFrame, policies: Sequence[Policy], rules: dict[str, str] = RULES
) -> DataFrame:
    """What each rule adds to each policy: ``policy, version, rule, failed, rejected, freed``.

    ``freed`` counts documents that are rejected only because of the rule.  The ledger is first
    summed to one row for each combination of bits (at most ``2 ** len(rules)`` of them), so
    the policies are never applied to documents again.
    """
    counts = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    bits = F.col("fail_bits")
    cases = []
    for policy in policies:
        out = rejected(bits, policy, rules)
        for rule in sorted({*policy.hard, *policy.soft}, key=list(rules).index):
            one = F.lit(rule_bits([rule], rules)).cast("long")
            still = rejected(bits.bitwiseAND(F.bitwise_not(one)), policy, rules)
            cases.append(
                F.struct(
                    F.lit(policy.name).alias("policy"),
                    F.lit(policy.version).alias("version"),
                    F.lit(rule).alias("rule"),
                    F.when(bits.bitwiseAND(one) != 0, F.col("n")).otherwise(0).alias("failed"),
                    F.when(out, F.col("n")).otherwise(0).alias("rejected"),
                    F.when(out & ~still, F.col("n")).otherwise(0).alias("freed"),
                )
            )
    return (
        counts.select(F.explode(F.array(*cases)).alias("c"))
        .select("c.*")
        .groupBy("policy", "version", "rule")
        .agg(*[F.sum(c).alias(c) for c in ("failed", "rejected", "freed")])
    )


def bits_by(ledger: DataFrame, key: str) -> DataFrame:
    """For each value of ``key``: rules that some document fails, and that every document fails."""
    return ledger.groupBy(key).agg(
        F.bit_or("fail_bits").alias("some_fail"), F.bit_and("fail_bits").alias("all_fail")
    )
