"""Quality rules: a table of thresholds compiled into one projection of SQL functions.

Every measure is a column expression over one text; a rule is a measure with a least and a most
value, and from a number of words on. A document is kept if it has enough words, repeats few of
them in five-word windows, and breaks no rule of the table. NULL texts have no words. Rows are
judged one by one, so repeated rows and ties need no rule, and no row is moved: there is no
shuffle. Input columns of any name stay out of the way (``measures`` reads two columns only).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5  # words of a window
BLANKS = " \t\n\x0b\x0c\r"
# Stop words of the four languages, in the order of the alphabet.
STOP_WORDS = ("a", "and", "are", "as", "at", "au", "auf", "be", "by", "con", "das", "de", "del",
              "dem", "den", "der", "des", "die", "du", "ein", "eine", "el", "en", "es", "est",
              "et", "for", "in", "is", "ist", "it", "la", "las", "le", "les", "los", "mit", "no",
              "of", "on", "or", "ou", "para", "por", "que", "se", "sur", "that", "the", "this",
              "to", "un", "und", "une", "von", "was", "with", "y", "zu")


@dataclass(frozen=True)
class Threshold:
    """Fails a document whose measure lies outside [least, most], if it has at least
    ``from_words`` words."""
    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 1


RULES = (
    Threshold("word_length", "word_chars / n_words", 1.5, 25.0),
    Threshold("symbols_per_word", "n_symbols / n_words", None, 0.5, 20),
    Threshold("symbol_words", "n_symbol_words / n_words", None, 0.4, 20),
    Threshold("shouting", "n_shouted / n_words", None, 0.3, 20),
    Threshold("stop_words", "n_stop_words / n_words", 0.01, None, 100),
    Threshold("repeated_lines", "n_dup_lines / n_lines", None, 0.75, 20),
)


def measures(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys``, and the counts that rules are made of."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(BLANKS))
    plain = docs.select(*keys, body.alias("body"), trimmed.alias("trimmed"))
    words = F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(
        F.split("trimmed", r"[\x20\x09-\x0D]+", -1))
    lines = F.filter(F.split("body", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = plain.select(*keys, "body", words.alias("words"), lines.alias("lines"))
    hashed = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    stop = F.filter("words", lambda w: w.isin(*STOP_WORDS))
    counted = split.select(
        *keys, F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("body") - F.char_length(F.regexp_replace("body", r"[#*$%&|<>]+", "")))
        .cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(stop).cast("long").alias("n_stop_words"),
        # Words of symbols or ending in three and more of them, and words in capitals before "!!".
        F.regexp_count("body", F.lit(r"(?<![^\x20\x09-\x0D])(?:[#*$%&|<>]+|[^\x20\x09-\x0D#*$%&|<>]+[#*$%&|<>]{3,})(?![^\x20\x09-\x0D])"))
        .cast("long").alias("n_symbol_words"),
        F.regexp_count("body", F.lit(r"!!+(?![^\x20\x09-\x0D])")).cast("long").alias("n_shouted"),
        hashed.alias("windows"))
    # Only rows with an equal pair of windows have an array here; the others have NULL.
    ranked = counted.withColumn("ranked", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    def same(j: Column, other: Column) -> Column:
        return F.coalesce(F.get("ranked", j)["h"] == F.get("ranked", other)["h"], F.lit(False))
    places = ranked.withColumn("places", F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("ranked") - 1),
                 lambda j: same(j, j - 1) | same(j, j + 1)),
        lambda j: F.get("ranked", j)["i"])))
    # A window at place p covers WINDOW words, less those that the next one covers.
    covered = F.aggregate(F.transform("places", lambda p, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get("places", j + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    done = places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "windows", "ranked", "places")
    # A generator in between keeps later filters from being put in place of the columns they
    # read, which would compute the words anew for each word.
    whole = F.struct(*[F.col(f"`{c}`") for c in done.columns])
    return done.select(F.explode(F.array(whole)).alias("__all")).select("__all.*")


def verdicts(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text",
             rules: Sequence[Threshold] = RULES) -> DataFrame:
    """``keys``, the measures, ``base_failed``, ``failed_rules`` (names) and ``kept``."""
    def broken(rule: Threshold) -> Column:
        value = F.expr(rule.measure)
        out = F.lit(False)
        if rule.least is not None:
            out = out | (value < rule.least)
        if rule.most is not None:
            out = out | (value > rule.most)
        return F.when((F.col("n_words") >= rule.from_words) & (F.col("n_words") > 0) & out, rule.name)

    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (measures(docs, keys, text).withColumn("base_failed", base)
            .withColumn("failed_rules", F.array_compact(F.array(*[broken(r) for r in rules])))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Threshold] = RULES) -> DataFrame:
    """The rows that are kept, with all their columns: the row travels as one struct beside the
    measures, so its names cannot clash with theirs."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text).alias("__text"))
    return verdicts(row, ["__row"], "__text", rules).where("kept").select("__row.*")
