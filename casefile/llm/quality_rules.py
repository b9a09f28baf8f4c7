"""Quality rules on texts as a short-circuit cascade, all in DataFrame expressions.

Every rule is tried alone on a sample: the share it rejects is its selectivity, the time a row takes
its cost. Rules are then asked in the order of rejection per cost, and a row rejected by one is
not shown to the next. The verdict does not depend on the order, only the work does.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """`rejects` makes the condition from the columns of the measured table."""

    name: str
    rejects: Callable[[], Column]


def with_measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) for each row; a null text counts as empty.

    Repeated windows are found by sorting the hashes of a text's windows with their places, which is
    done only for texts in which some hash occurs twice.
    """
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", BLANKS), lambda w: w != ""))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    places = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int"))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("marks", F.transform(places, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))).drop("words")
    some = F.size(F.array_distinct("marks")) < F.size("marks")
    rows = rows.withColumn("ordered", F.when(some, F.array_sort(F.transform("marks", lambda m, i: F.struct(m.alias("m"), i.alias("i")))))).drop("marks")

    def twice(e: Column, k: Column) -> Column:
        before, after = F.get("ordered", k - 1)["m"], F.get("ordered", k + 1)["m"]
        return F.coalesce(before == e["m"], F.lit(False)) | F.coalesce(after == e["m"], F.lit(False))

    rows = rows.withColumn("at", F.array_sort(F.transform(F.filter("ordered", twice), lambda e: e["i"]))).drop("ordered")
    steps = F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - p, F.lit(WINDOW))).cast("long"))
    repeated = F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    bare = F.translate("text", " \t\n\x0b\f\r", "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    rows = rows.withColumn("lines", lines)
    return rows.select(
        "doc_id", "text", "n_words", F.length(bare).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _kept_share(pattern: str) -> Column:
    """Characters of the text that `pattern` leaves, by its code points."""
    return F.length(F.regexp_replace("text", pattern, ""))


# What a text must not be beyond the base: thresholds are fixed parameters, as whole-number ratios.
RULES = [
    Rule("symbols", lambda: 100 * F.col("n_symbols") > 10 * F.col("word_chars")),
    Rule("duplicate_lines", lambda: F.col("n_dup_lines") * 10 > 3 * F.size(F.split("text", "\n"))),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
    Rule("upper_case", lambda: 100 * _kept_share("[^A-Z]") > 50 * F.col("word_chars")),
    Rule("digits", lambda: 100 * _kept_share("[^0-9]") > 30 * F.col("word_chars")),
    Rule("exclamations", lambda: 100 * (F.length("text") - F.length(F.translate("text", "!", ""))) > 50 * F.col("n_words")),
]


def _sample(measured: DataFrame, rows: int) -> DataFrame:
    """About `rows` rows by the hash of their id, the same on every run."""
    total = measured.select("doc_id").count()
    if total <= rows:
        return measured
    return measured.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * rows / total))


def rule_order(measured: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with selectivity and seconds a row, by rejection per cost, measured on a sample."""
    sample = _sample(measured, sample_rows).cache()
    held = sample.count()

    def seconds(condition: Column) -> tuple[float, int]:
        started = time.perf_counter()
        rejected = sample.agg(F.sum(F.when(condition, 1).otherwise(0)).alias("n")).first()["n"] or 0
        return time.perf_counter() - started, rejected

    try:
        seconds(F.lit(False))
        idle, _ = seconds(F.lit(False))
        found = []
        for rule in rules:
            spent, rejected = seconds(rule.rejects())
            found.append((rule, rejected / max(held, 1), max(spent - idle, 1e-4) / max(held, 1)))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda f: (-f[1] / f[2], f[0].name))


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, in the given order; null if none does. Later rules are then not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(), F.lit(rule.name)).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) for every row of `docs`.

    A null or empty text has no words and fails the base; null ids and repeated rows are judged one
    by one; other columns are ignored; no rows give no rows.
    """
    measured = with_measures(docs, text_column)
    order = [rule for rule, _, _ in rule_order(measured, rules, sample_rows)]
    judged = measured.withColumn("base_failed", base_failed())
    first = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order))
    return judged.withColumn("kept", first.isNull()).drop("text")
