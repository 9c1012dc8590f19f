"""Removal of line passages that stood earlier in the corpus: overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions in a text stay below this, so document and position make one exact number.
POSITIONS = 1 << 31


def _windows(docs: DataFrame, lines: int) -> DataFrame:
    """One row per window with at least one word: document, start and the digest of its lines."""
    def digest(all_lines: Column, i: Column) -> Column:
        whole = F.array_join(F.slice(all_lines, i + 1, lines), "\n")
        return F.when(whole.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(whole)))

    starts = F.transform(F.array(F.split("t", "\n")), lambda a: F.transform(
        F.slice(a, 1, F.greatest(F.size(a) - (lines - 1), F.lit(0))), lambda _, i: digest(a, i)))[0]
    return docs.select("k", "f", F.posexplode(starts).alias("start", "h")).where(F.col("h").isNotNull())


def _place(key: str, fingerprint: str, start: str) -> Column:
    """Order of windows: by document, then by position; documents without a key come first, by their fingerprints."""
    without = F.col(fingerprint).cast("decimal(20,0)") - F.lit(str(1 << 64)).cast("decimal(20,0)")
    document = F.coalesce(F.col(key).cast("decimal(20,0)"), without.cast("decimal(20,0)"))
    return document * F.lit(POSITIONS).cast("decimal(10,0)") + F.col(start)


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", lines: int = 3) -> DataFrame:
    """Start positions (column ``starts``, sorted) of the windows of each text that stood earlier in the corpus.

    Windows are found by digest over the whole table: the first place of each digest comes from an aggregation with
    partial results per task, so a passage that a third of all documents share arrives as one row per task.
    Documents are known by key and text fingerprint, columns ``k`` and ``f``.
    """
    slim = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("f"),
                       F.col(f"`{text}`").cast("string").alias("t"))
    windows = _windows(slim, lines).withColumn("place", _place("k", "f", "start"))
    first = windows.groupBy("h").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("h", "first")
    later = windows.join(first, "h").where(F.col("place") > F.col("first"))
    return later.groupBy("k", "f").agg(F.array_sort(F.collect_set("start")).alias("starts"))


def remove_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", lines: int = 3) -> DataFrame:
    """``docs`` with the lines of later window occurrences taken out of ``text``, and four columns added.

    Windows of ``lines`` consecutive lines (split at \\n, compared exactly) that hold at least one word are hashed.
    Of equal windows the one in the lowest document, and there at the lowest position, stays; the lines that later
    ones cover are merged to spans and removed. Added: ``n_lines``, ``n_removed``, ``n_spans`` and ``kept_lines``
    (the remaining lines). These replace columns of the same names; all other columns stay.

    A null text stays null with 0 lines; an empty text is one empty line. A text of fewer lines than a window is
    never changed. Rows that share a key take the same place in the order, so a row repeated as a whole is not
    removed by its own copy; rows with a null key come first, ordered by the fingerprints of their texts. An empty
    table gives an empty table.
    """
    found = repeated_windows(docs, key, text, lines).toDF("found_key", "found_print", "starts")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_spans", "kept_lines")]
    # columns go by position, so no name of the table can clash with one of these
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{key}`").cast("bigint").alias("k"),
                       F.xxhash64(F.col(f"`{text}`")).alias("f"))
    joined = rows.join(found, F.col("k").eqNullSafe(F.col("found_key")) & (F.col("f") == F.col("found_print")), "left")
    whole = f"c{names.index(text)}"

    def cut(a: Column, p: Column) -> Column:
        n = F.size(a)
        begins = F.filter(p, lambda x, i: (i == 0) | (x - F.get(p, i - 1) > lines))
        ends = F.transform(F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) - x > lines)), lambda x: x + lines)
        gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), ends).alias("lo"), F.concat(begins, F.array(n)).alias("hi"))
        kept = F.flatten(F.transform(gaps, lambda g: F.slice(a, g["lo"] + 1, g["hi"] - g["lo"])))
        return F.struct(n.alias("n_lines"), F.size(begins).alias("n_spans"), kept.alias("kept_lines"))

    no_starts = F.array().cast("array<int>")
    both = F.array(F.struct(F.split(F.col(whole), "\n").alias("a"), F.coalesce("starts", no_starts).alias("p")))
    result = joined.select(*[f"c{i}" for i in range(len(names))], "starts", F.inline_outer(
        F.transform(both, lambda x: F.when(x["a"].isNotNull(), cut(x["a"], x["p"])))))
    return result.select(
        *[F.when(F.col("starts").isNull(), F.col(f"c{i}")).otherwise(F.array_join("kept_lines", "\n")).alias(c)
          if c == text else F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.col("n_lines") - F.size("kept_lines"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_lines", F.array().cast("array<string>")).alias("kept_lines"))
