"""Whole-text statistics as Spark columns, used by the quality operators."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolway.llm.common import words

WINDOW = 5


def _length_of(text: Column, keep: str) -> Column:
    """Number of characters of a class, given its complement as a pattern of runs."""
    return F.char_length(F.regexp_replace(text, keep, "")).cast("long")


def covered_by_repeats(windows: Column, width: int = WINDOW) -> Column:
    """How many words lie in a window that occurs more than once, from the windows' hashes.

    Windows are sorted with their places; those next to an equal one are repeated. Each
    adds ``width`` words, or as many as there are up to the next repeated window.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(ordered: Column) -> Column:
        def same(x: Column, i: Column, step: int) -> Column:
            # get() beyond the array is null
            return F.coalesce(F.get(ordered, i + step)["h"] == x["h"], F.lit(False))

        marked = F.transform(ordered, lambda x, i: F.when(same(x, i, -1) | same(x, i, 1), x["i"]))
        return F.array_sort(F.filter(marked, lambda x: x.isNotNull()))

    def cover(at: Column) -> Column:
        gains = F.transform(at, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - x, F.lit(width))))
        return F.aggregate(gains, F.lit(0), lambda a, b: a + b)

    # transform over an array of one binds an intermediate result without computing it twice
    bound = F.transform(F.transform(F.array(placed), starts), cover)
    return F.get(bound, F.lit(0)).cast("long")


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add a struct ``stats`` of whole-text counts (all long) by Spark expressions alone.

    A null text counts as one without words. Word windows are compared by XXH64 within
    one text. Texts without a repeated window, which most are, skip the sorting.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumns(
        {
            "_words": words(F.col(text)),
            "_lines": F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    n = F.size("_words")
    window = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)]),
    )
    step = step.withColumn("_windows", F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    repeats = F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0).cast("long")).otherwise(
        covered_by_repeats(F.col("_windows"))
    )
    stats = F.struct(
        n.cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        _length_of(value, r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        _length_of(value, r"[^A-Z]+").alias("n_upper"),
        _length_of(value, r"[^!?]+").alias("n_shouts"),
        _length_of(value, r"[^.]+").alias("n_stops"),
        _length_of(value, r"[^0-9]+").alias("n_digits"),
    )
    return step.withColumn("stats", stats).drop("_words", "_lines", "_windows")


def ratios(stats: str = "stats") -> dict[str, Column]:
    """The statistics as ratios (double, never null), which do not grow with a text's length."""

    def per(a: str, b: str) -> Column:
        return F.col(f"{stats}.{a}").cast("double") / F.greatest(F.col(f"{stats}.{b}"), F.lit(1))

    return {
        "log_words": F.log(F.col(f"{stats}.n_words").cast("double") + 1),
        "word_length": per("word_chars", "n_words"),
        "symbols": per("n_symbols", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "distinct": per("n_distinct", "n_words"),
        "line_words": F.log(per("n_words", "n_lines") + 1),
        "upper": per("n_upper", "word_chars"),
        "shouts": per("n_shouts", "n_words"),
        "stops": per("n_stops", "n_words"),
        "digits": per("n_digits", "word_chars"),
    }
