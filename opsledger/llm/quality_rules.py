"""Quality rules over whole texts, run as a cascade in the order of rejections per cost. Built-in functions only."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text that goes; it reads ``t``, ``words`` and the counts of ``with_counts``."""
    name: str
    rejects: Callable[[], Column]


def _without(chars: str) -> Column:
    return F.length("t") - F.length(F.translate(F.col("t"), chars, ""))


def production_rules() -> list[Rule]:
    """Limits of the usual web-text filters: shares are of words or of lines with a word."""
    words, n = F.col("words"), F.col("n_words")
    return [
        Rule("symbols", lambda: 10 * F.col("n_symbols") > n),
        Rule("repeated_lines", lambda: 10 * F.col("n_dup_lines") > 6 * F.col("n_word_lines")),
        Rule("word_length", lambda: ~F.col("word_chars").between(2 * n, 20 * n)),
        Rule("shouting", lambda: _without(UPPER) > _without(LOWER)),
        Rule("exclamations", lambda: 5 * (F.length("t") - F.length(F.replace("t", F.lit("!!"), F.lit("!")))) > n),
        Rule("letters", lambda: 10 * F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) < 6 * n),
        Rule("ellipses", lambda: 10 * F.size(F.filter(F.split("t", "\n"), lambda x: x.rlike(r"(\.\.\.|…)[ \t\r]*$")))
             > 5 * F.col("n_word_lines")),
    ]


def _repeat_words(w: Column) -> Column:
    """Words that lie in a three-word window which occurs twice or more in the text."""
    windows = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                          lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1), F.lit(" "), F.get(w, i + 2)))

    def covered(e: Column) -> Column:
        twice = F.filter(F.transform(e, lambda s, j: F.when(
            s["x"].eqNullSafe(F.get(e, j - 1)["x"]) | s["x"].eqNullSafe(F.get(e, j + 1)["x"]), s["i"])),
            lambda p: p.isNotNull())
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda p: F.array(p, p + 1, p + 2)))))

    def count(t: Column) -> Column:
        entries = F.array_sort(F.transform(t, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        sorted_windows = F.transform(F.array(entries), covered)[0]
        return F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(sorted_windows)

    return F.transform(F.array(windows), count)[0]


def with_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, text ``t``, its ``words`` and the counts the rules read, each made once per text."""
    slim = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    trimmed = F.btrim("t", F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(b: Column) -> Column:
        w, x = b["w"], b["l"]
        return F.struct(
            w.alias("words"), F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.size(x).cast("bigint").alias("n_word_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(w).cast("bigint").alias("n_repeat_words"))

    both = F.array(F.struct(words.alias("w"), lines.alias("l")))
    return slim.select(key, "t", _without(SYMBOLS).cast("bigint").alias("n_symbols"),
                       F.inline(F.transform(both, counts)))


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    n = F.col("n_words")
    return (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n)


def cascade_order(docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text",
                  sample_rows: int = 512, times: int = 20) -> list[Rule]:
    """The rules by rejected sample rows per second of their own run time, best first.

    Cost and selectivity come from at most ``sample_rows`` rows, each run ``times`` times. The sample only decides
    the order of evaluation; a text is kept when no rule rejects it, so the verdict is the same in any order. Rows are
    chosen by a hash of their key in a share of the table that holds about twice as many, so what the tasks send to
    the one that cuts the sample does not grow with their number.
    """
    from opsledger.llm.samples import below_share
    from opsledger.session import run_folder, stored

    spark = docs.sparkSession
    total = docs.count()
    head = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"))
    if total > 2 * sample_rows:
        head = head.where(below_share(F.xxhash64(F.col(f"`{key}`")), 2 * sample_rows / total))
    head = head.limit(sample_rows)
    sample = stored(with_counts(head, key, text), run_folder(spark, "rule_sample"))
    copies = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("copy"))

    def run(condition: Column) -> tuple[float, int]:
        begin = time.perf_counter()
        hits = copies.agg(F.count_if(condition)).first()[0]
        return time.perf_counter() - begin, hits

    run(F.length("t") >= 0)
    idle = run(F.length("t") >= 0)[0]
    scores = {}
    for r in rules:
        seconds, hits = run(r.rejects())
        scores[r.name] = (hits + 1) / max(seconds - idle, 1e-3)
    return sorted(rules, key=lambda r: -scores[r.name])


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, the counts, ``base_failed`` and ``kept``.

    A text that fails the base rules is not kept and runs no other rule; otherwise the rules run one after the other
    in the order of ``cascade_order`` until one rejects.

    A null text counts as an empty one and fails the base rules. Rows are judged one by one, so repeated rows get
    equal results and a null key stays null. The work on one text is at most n log n in its words. An empty table
    gives an empty table; columns other than key and text are not read.
    """
    rules = production_rules() if rules is None else rules
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for r in cascade_order(docs, rules, key, text):
        verdict = verdict.when(r.rejects(), F.lit(False))
    return with_counts(docs, key, text).withColumn("base_failed", base_failed()).select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        verdict.otherwise(F.lit(True)).alias("kept"))
