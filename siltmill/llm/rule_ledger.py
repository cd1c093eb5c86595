"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per rule, so a
policy (a versioned set of rules that reject) and every ablation (what a policy would keep without one of its rules)
are bit operations on the ledger and never read a text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """failed is SQL over the measurements; bit is the rule's place in the mask and never reused."""

    bit: int
    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


#: All conditions are integer arithmetic, so that every engine agrees on them.
RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_trigrams", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbol_heavy", "10 * n_symbols > 5 * n_words"),
    Rule(3, "short_words", "word_chars < 2 * n_words"),
    Rule(4, "long_words", "word_chars > 20 * n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
)
POLICIES = (
    Policy("base", ("too_few_words", "repeated_trigrams")),
    Policy("v1", ("too_few_words", "repeated_trigrams", "symbol_heavy", "short_words", "long_words")),
    Policy("v2", tuple(r.name for r in RULES)),
)


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated 3-word windows, lines with a word."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: splits at ASCII white space and nowhere else
    spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        end = 0  # first word that no counted window covers
        for i, w in enumerate(windows):
            if often[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return len(words), len(text) - spaces, sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


def measure_texts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(x) for x in texts], columns=[x.split()[0] for x in MEASURES.split(", ")])


def bits(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    return sum(1 << r.bit for r in rules if r.name in set(names))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: id, measurements and fail_bits (long).

    A null or empty text has no words and fails what its zero counts fail. Repeated rows give repeated rows; other
    columns, whatever their names, are ignored.
    """
    measures = docs.select(F.col(id_col), F.pandas_udf(measure_texts, MEASURES)(F.col(text_col)).alias("m")).select(id_col, "m.*")
    mask = F.lit(0).cast("long")
    for r in rules:
        mask = mask + F.when(F.expr(r.failed), F.lit(1 << r.bit)).otherwise(F.lit(0))
    return measures.withColumn("fail_bits", mask)


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether the ledger's row passes the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(bits(policy.rules, rules))) == 0


def verdicts(book: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with a boolean column kept_<version> for each policy."""
    return book.withColumns({f"kept_{p.version}": passes(p, rules) for p in policies})


def ablations(book: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that stay if it is left out.

    One pass: rows are first counted by mask, so at most 2^rules rows leave the map side.
    """
    whole = bits(policy.rules, rules)
    masks = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole)).alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    mine = [r for r in rules if r.name in policy.rules]
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in mine])
    rows = masks.select("mask", "n", F.explode(each).alias("r")).select("mask", "n", "r.rule", "r.bit")
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("long")
    has, rest = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.bitwise_not(F.col("bit")))
    return rows.groupBy("rule").agg(
        count(has).alias("n_failed"), count(F.col("mask") == F.col("bit")).alias("n_failed_alone"), count(rest == 0).alias("n_kept_without")
    )
