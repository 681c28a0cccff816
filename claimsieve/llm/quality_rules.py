"""Rule-based document quality: a table of thresholds compiled into one projection of built-in functions.

`THRESHOLDS` names a measure and the range in which a text passes. The measures are arrays and strings of Spark's
own, so every document is judged in the scan that reads it: no shuffle, no Python, whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\u000b\f\r"
NOT_BLANK = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with a in is it for was on by as from "
    "der die das und ein eine ist nicht mit von zu den für dem im "
    "le la les de des et un une que est pas dans pour en du "
    "el los las y del que se por con no una su al lo"
).split()


@dataclass(frozen=True)
class Threshold:
    measure: str
    least: float | None = None
    most: float | None = None


THRESHOLDS = (
    Threshold("mean_word_chars", least=2.0, most=14.0),
    Threshold("symbols_per_word", most=0.2),
    Threshold("stop_word_share", least=0.02),
    Threshold("dup_line_share", most=0.5),
    Threshold("bullet_line_share", most=0.9),
    Threshold("ellipsis_line_share", most=0.3),
    Threshold("shouting_share", most=0.5),
    Threshold("alphabetic_word_share", least=0.7),
)


def bound(value: Column, body) -> Column:
    """`body(value)` with the value worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the array, the first finding included.

    Texts without a repeated window, found by hashing, are done at once. The others sort (window, place); places
    whose window equals a neighbour's are kept in order, and each covers the words up to the next one, at most three.
    """

    def covered(places):
        def width(place, i):
            return F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - place, F.lit(WINDOW)))

        return F.aggregate(F.transform(places, width), F.lit(0), lambda total, n: total + n)

    def places(ordered):
        def repeated(entry, i):
            same_before = F.get(ordered, i - 1)["window"] == entry["window"]
            same_after = F.get(ordered, i + 1)["window"] == entry["window"]
            return F.coalesce(same_before, F.lit(False)) | F.coalesce(same_after, F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, repeated), lambda entry: entry["place"]))

    def count(windows):
        entries = F.transform(windows, lambda w, i: F.struct(w.alias("window"), i.alias("place")))
        in_order = bound(F.sort_array(entries), places)
        unique = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(unique, F.lit(0)).otherwise(bound(in_order, covered))

    def windows(all_words):
        def window(word, place):
            return F.concat_ws(" ", word, F.get(all_words, place + 1), F.get(all_words, place + 2))

        starts = F.slice(all_words, 1, F.greatest(F.size(all_words) - (WINDOW - 1), F.lit(0)))
        return bound(F.transform(starts, window), count)

    # a filter on the result is pushed below the projection that splits words; bound, they are split once even then
    return bound(words, windows)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and the measures of the threshold table."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shaped = texts.select(
        "doc_id",
        "text",
        F.regexp_extract_all("text", F.lit(f"({NOT_BLANK})")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0).alias("lines"),
        F.length(F.translate("text", BLANKS, "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
    )
    words, lines = F.col("words"), F.col("lines")
    n_words, n_lines = F.size(words), F.size(lines)
    core = bound(F.transform(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))), lambda plain: plain)

    def words_like(condition) -> Column:
        return F.size(F.filter(words, condition))

    def lines_like(pattern: str) -> Column:
        return F.size(F.filter(lines, lambda line: line.rlike(pattern)))

    dup_lines = n_lines - F.size(F.array_distinct(lines))
    return shaped.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
        _share(F.col("word_chars"), n_words).alias("mean_word_chars"),
        _share(F.col("n_symbols"), n_words).alias("symbols_per_word"),
        _share(F.size(F.filter(core, lambda w: w.isin(*STOP_WORDS))), n_words).alias("stop_word_share"),
        _share(dup_lines, n_lines).alias("dup_line_share"),
        _share(lines_like(r"^[\x20\t]*[-*•]"), n_lines).alias("bullet_line_share"),
        _share(lines_like(r"(\.\.\.|…)[\x20\t]*\z"), n_lines).alias("ellipsis_line_share"),
        _share(words_like(lambda w: w.rlike(r"^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*\z")), n_words).alias("shouting_share"),
        _share(words_like(lambda w: w.rlike("\\p{L}")), n_words).alias("alphabetic_word_share"),
    )


def passes(thresholds=THRESHOLDS) -> Column:
    """The whole threshold table as one condition."""
    verdict = F.lit(True)
    for rule in thresholds:
        if rule.least is not None:
            verdict = verdict & (F.col(rule.measure) >= rule.least)
        if rule.most is not None:
            verdict = verdict & (F.col(rule.measure) <= rule.most)
    return verdict


def judge(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """One row per document: base counts, `base_failed`, every measure, and `kept`.

    A null or empty text has no words and fails the base rule. Repeated rows and null ids give a row each; further
    columns of `docs` are ignored whatever their names. Texts are read whole: the dearest measure sorts the windows of
    one text.
    """
    measured = measures(docs)
    repeats = 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    failed = measured.withColumn("base_failed", (F.col("n_words") < 50) | repeats)
    return failed.withColumn("kept", ~F.col("base_failed") & passes(thresholds))
