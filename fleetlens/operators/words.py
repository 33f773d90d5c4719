"""Word histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.functions import split_words, tokens
from fleetlens.plans import Slices, ordered_scan
from fleetlens.plans.slices import ROWS_PER_SLICE


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Occurrences of each lower-cased word.

    Frequent words are summed inside each scan task first, so a word that makes up a third of the text
    sends one row per task through the shuffle.
    """
    words = lines.select(F.explode(split_words(text)).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def running_word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """The same histogram on a stream: write it in ``update`` (changed words) or ``complete`` mode."""
    if not lines.isStreaming:
        raise ValueError("running_word_count needs a stream; use word_count on a table")
    return word_count(lines, text)


def word_count_changelog(
    lines: DataFrame, text: str = "value", seq: str = "seq",
    slices: Slices | None = None, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One row per word occurrence: how often the word has occurred up to there.

    ``seq`` is the arrival number of a line; ``pos`` counts its words from 0.
    """
    words = lines.select(F.col(seq).alias("seq"), F.posexplode(tokens(text)).alias("pos", "word"))
    scanned = ordered_scan(
        words, ["word"], ["seq", "pos"],
        local=lambda w: [{"_n": F.row_number().over(w).cast("long")}],
        totals={"_rows": F.count(F.lit(1))},
        inherit=lambda w: [{"_prior": F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1))}],
        inherited="_prior long", slices=slices, rows_per_slice=rows_per_slice,
    )
    return scanned.select("seq", "pos", "word", (F.col("_n") + F.coalesce("_prior", F.lit(0))).alias("count"))
