"""Quality rules with a ledger of failure bits.

Every rule is evaluated once for each document. The ledger keeps the measurements and one integer in
which bit *b* says that rule *b* failed. A policy is a named, versioned set of rules: applying it,
comparing two versions, or asking what each rule contributes are bit operations on the ledger and
read no text. Everything is built-in column functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.llm.frames import column_name, computed_once, without

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_bangs",
]


@dataclass(frozen=True)
class Rule:
    """Fails where ``failed``, SQL over the measurements, is true. ``bit`` never changes its meaning."""

    bit: int
    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return reduce(lambda mask, rule: mask | 1 << RULES[rule].bit, self.rules, 0)


RULES = {
    rule.name: rule
    for rule in [
        Rule(0, "few_words", "n_words < 50"),
        Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
        Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
        Rule(3, "duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
        Rule(4, "short_words", "word_chars < 3 * n_words"),
        Rule(5, "long_words", "word_chars > 10 * n_words"),
        Rule(6, "shouting", "100 * n_upper > 30 * word_chars"),
        Rule(7, "digits", "100 * n_digits > 20 * word_chars"),
        Rule(8, "exclamations", "100 * n_bangs > 30 * n_words"),
        # One or two repeated lines of a short text say nothing.
        Rule(9, "repeated_lines", "n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines"),
    ]
}
BASE = Policy("base", 1, ("few_words", "repeated_windows"))
POLICIES = [
    BASE,
    Policy("web", 1, (*BASE.rules, "symbols", "duplicate_lines")),
    Policy("web", 2, tuple(r for r in RULES if r != "repeated_lines")),
    Policy("web", 3, tuple(r for r in RULES if r != "duplicate_lines")),
]
CURRENT = POLICIES[3]


def _count_of(text: Column, characters: str) -> Column:
    """Number of the given ASCII characters in a text."""
    return F.octet_length(text) - F.octet_length(F.translate(text, characters, ""))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements of ``text``; null counts as empty.

    Words are runs without ASCII white space. Columns of the measurements' names are replaced.
    """
    kept = without(df, [*MEASURES, "_text", "_words", "_sorted", "_places"])
    source = F.col(column_name(df, text))
    words = F.array_remove(F.split("_text", SPACES), "")
    docs = df.select(*kept, F.coalesce(source, F.lit("")).alias("_text"))
    docs = docs.select(*kept, "_text", words.alias("_words"), F.size(words).cast("long").alias("n_words"))
    # Windows of three words, sorted: equal ones lie side by side.
    windows = F.transform(
        F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.col("n_words").cast("int") - 3)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.struct(
            F.concat_ws(" ", F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("window"),
            i.alias("at"),
        ),
    )
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.translate(line, " \t\n\x0b\x0c\r", "") != "")
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = docs.select(
        *kept,
        "n_words",
        (F.char_length("_text") - _count_of(F.col("_text"), " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        _count_of(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        _count_of(F.col("_text"), letters.upper()).cast("long").alias("n_upper"),
        _count_of(F.col("_text"), "0123456789").cast("long").alias("n_digits"),
        _count_of(F.col("_text"), "!").cast("long").alias("n_bangs"),
        lines.alias("_lines"),
        F.array_sort(windows).alias("_sorted"),
    )
    repeated = F.filter(
        "_sorted",
        lambda x, k: F.coalesce(F.get("_sorted", k + 1)["window"] == x["window"], F.lit(False))
        | F.coalesce(F.get("_sorted", k - 1)["window"] == x["window"], F.lit(False)),
    )
    docs = docs.select(
        *kept,
        *[m for m in MEASURES if m not in ("n_lines", "n_dup_lines", "n_repeat_words")],
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.array_sort(F.transform(repeated, lambda x: x["at"])).alias("_places"),
    )
    # A window covers three words, or as many as lie before the next repeated window.
    covered = F.transform(
        "_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - p, F.lit(3)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b)
    return computed_once(docs, kept, {m: F.col(m) for m in MEASURES if m != "n_repeat_words"} | {"n_repeat_words": total})


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements and ``failures``, the bits of all rules that failed.

    A null or empty text has measurements of 0. Rows stay as they are, repeated ones too; columns of
    the new names are replaced.
    """
    found = measured(df, text)
    bits = [F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES.values()]
    return found.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def passes(policy: Policy, failures: str = "failures") -> Column:
    """Whether a ledger row fails none of the policy's rules."""
    return F.col(failures).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(rows: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """For each policy and rule: documents, rejected ones, failures of the rule, and what it alone rejects.

    The ledger is first counted by its bits, so that at most 2 to the number of rules rows are left;
    every policy and rule is a mask over those. ``fails_any`` and ``fails_all`` are the bits that some
    and that all rejected documents have. An empty ledger gives counts of 0.
    """
    by_bits = rows.groupBy("failures").agg(F.count("*").alias("n"))
    cases = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p.name).alias("policy"),
                    F.lit(p.version).alias("version"),
                    F.lit(r).alias("rule"),
                    F.lit(p.mask).cast("long").alias("mask"),
                    F.lit(1 << RULES[r].bit).cast("long").alias("bit"),
                )
                for p in policies
                for r in p.rules
            ]
        )
    ).alias("case")
    listed = rows.sparkSession.range(1).select(cases).select("case.*")
    spread = by_bits.select("failures", "n", cases).select("failures", "n", "case.*")
    bits = F.col("failures").bitwiseAND(F.col("mask"))
    n_where = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    found = spread.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("n_docs"),
        n_where(bits != 0).alias("n_rejected"),
        n_where(bits.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        n_where(bits == F.col("bit")).alias("n_only_this"),
        F.bit_or(bits).alias("fails_any"),
        F.bit_and(F.when(bits != 0, bits)).alias("fails_all"),
    )
    counts = ["n_docs", "n_rejected", "n_failed", "n_only_this", "fails_any", "fails_all"]
    return listed.select("policy", "version", "rule").join(found, ["policy", "version", "rule"], "left").fillna(0, counts)
