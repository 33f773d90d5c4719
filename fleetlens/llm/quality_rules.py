"""Quality rules as weak supervision, in DataFrame functions only.

Every rule looks at counts of a whole text and votes good (1) or bad (-1), or abstains (0).  How far each rule
is to be believed is not set by hand: expectation-maximisation over the corpus estimates, per rule, the chance
that it votes good on a good text and bad on a bad one, and the share of good texts.  The posterior probability
of a good text then decides; no single rule can reject, as it would where all of them must pass.

Votes are grouped to vote patterns, at most three to the power of the rules whatever the size of the corpus, and
the estimation runs on that table.  Its start and pseudo-counts say that rules are right more often than not,
which names the two classes.

Words are runs of anything but the six ASCII white spaces.  A null text is empty; an empty text has no words and
fails the base rules.  Repeated rows are judged each, a null doc_id too, other columns take no part.  An empty
table gives an empty one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.tables import settle

#: Rounds of estimation at most; it ends earlier where no chance moves by more than ``STILL``.
ROUNDS, STILL = 30, 1e-9
DECISION = 0.5
#: The chances that estimation starts from, and the pseudo-counts that pull towards them.
START_GOOD, START_RIGHT_ON_GOOD, START_RIGHT_ON_BAD, PSEUDO = 0.8, 0.9, 0.5, 5.0
SYMBOLS = "#*$%&|<>"
#: Letters, then at most one mark.
PLAIN = r"^[A-Za-z\x{80}-\x{10FFFF}]+[.,;:!?]?$"
#: Short words of English, German, French and Spanish.
COMMON = ("the", "of", "and", "to", "in", "is", "that", "it", "der", "die", "und", "den", "von", "mit", "le", "la", "les",
          "et", "un", "des", "el", "los", "que", "en", "y", "de")

#: Of each rule: when it votes bad, when good; else it abstains.  Integers only, so any engine decides alike.
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words < 50", "n_words >= 100"),
    "word_length": ("word_chars < 2 * n_words or word_chars > 12 * n_words",
                    "word_chars >= 3 * n_words and word_chars <= 9 * n_words and n_words > 0"),
    "symbols": ("10 * n_symbols > n_words", "100 * n_symbols <= n_words and n_words > 0"),
    "symbol_words": ("10 * n_marked > n_words", "50 * n_marked <= n_words and n_words > 0"),
    "plain_words": ("10 * n_plain < 5 * n_words", "10 * n_plain >= 8 * n_words and n_words > 0"),
    "same_lines": ("n_lines >= 2 and 10 * n_dup_lines > 3 * n_lines", "n_lines >= 2 and 10 * n_dup_lines <= n_lines"),
    "same_words": ("n_words >= 10 and 10 * n_repeat_words > 3 * n_words",
                   "n_words >= 10 and 10 * n_repeat_words <= n_words"),
    "capitals": ("n_capitals + n_small >= 20 and 10 * n_capitals > 4 * (n_capitals + n_small)",
                 "n_capitals + n_small >= 20 and 10 * n_capitals <= 2 * (n_capitals + n_small)"),
    "shouting": ("20 * n_shouts > n_words", "200 * n_shouts <= n_words and n_words > 0"),
    "bullets": ("n_lines >= 3 and 10 * n_bullets > 9 * n_lines", "n_lines >= 3 and 10 * n_bullets <= 3 * n_lines"),
    "common_words": ("n_words >= 50 and 100 * n_common < n_words", "100 * n_common >= 5 * n_words and n_words > 0"),
    "sentences": ("n_words >= 30 and (50 * n_ends < n_words or 2 * n_ends > n_words)",
                  "n_words >= 30 and 50 * n_ends >= n_words and 3 * n_ends <= n_words"),
}
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_small",
          "n_shouts", "n_bullets", "n_common", "n_ends",
          "n_marked", "n_plain")
_SPACE, _WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Trust:
    """The share of good texts, and per rule the chances of a right vote on a good and on a bad text."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]


def _left(text: Column, gone: str) -> Column:
    """Characters of a text that are left without the matches of a pattern."""
    return F.length(F.regexp_replace(text, gone, "")).cast("long")


def _size(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0)).cast("long")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_counts`` of what the rules look at, from the whole text.

    Only texts with two windows of one hash go on: their three-word windows are sorted with their places, so that
    equal ones are neighbours.  That costs a text's length times its logarithm, and a place is counted once
    however many windows cover it.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    with_words = docs.withColumns({
        "_text": body, "_words": F.regexp_extract_all(body, F.lit(_WORD), F.lit(0)),
        "_lines": F.filter(F.split(body, "\n", -1), lambda line: line.rlike(_WORD))})
    last = F.size("_words") - 3

    def window(i: Column) -> list[Column]:
        return [F.get("_words", i + k) for k in range(3)]

    hashed = with_words.withColumn("_hashes", F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*window(i)))))
    windows = F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i")))))
    ordered = hashed.withColumn("_windows", windows)
    head, tail = F.slice("_windows", 1, F.size("_windows") - 1), F.slice("_windows", 2, F.size("_windows") - 1)
    twice = F.filter(F.zip_with(head, tail, lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"]))),
                     lambda pair: pair.isNotNull())
    paired = ordered.withColumn("_twice", F.when(F.size("_windows") > 1, twice))
    covered = F.array_distinct(F.flatten(F.transform("_twice", lambda p: F.array(
        p[0], p[0] + 1, p[0] + 2, p[1], p[1] + 1, p[1] + 2))))
    text_column = F.col("_text")
    counts = {
        "n_words": _size(F.col("_words")),
        "word_chars": _left(text_column, _SPACE),
        "n_symbols": F.length(text_column).cast("long") - _left(text_column, f"[{SYMBOLS}]+"),
        "n_dup_lines": _size(F.col("_lines")) - _size(F.array_distinct("_lines")),
        "n_repeat_words": _size(covered),
        "n_lines": _size(F.col("_lines")),
        "n_capitals": _left(text_column, "[^A-Z]+"),
        "n_small": _left(text_column, "[^a-z]+"),
        "n_shouts": F.floor((F.length(text_column) - F.length(F.replace(text_column, F.lit("!!"), F.lit("")))) / 2)
        .cast("long"),
        "n_bullets": _size(F.filter("_lines", lambda line: line.rlike(r"^[\x20\x09]*[-*]"))),
        "n_common": _size(F.filter("_words", lambda w: F.lower(w).isin(*COMMON))),
        "n_marked": _size(F.filter("_words", lambda w: w.rlike(f"[{SYMBOLS}]"))),
        "n_plain": _size(F.filter("_words", lambda w: w.rlike(PLAIN))),
        "n_ends": _size(F.filter("_words", lambda w: F.right(w, F.lit(1)).isin(".", "!", "?"))),
    }
    return paired.withColumn("_counts", F.struct(*[c.alias(name) for name, c in counts.items()])).drop(
        "_text", "_words", "_lines", "_hashes", "_windows", "_twice")


def vote(rule: str) -> Column:
    """The vote of a rule over columns of counts."""
    bad, good = RULES[rule]
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)


def votes() -> Column:
    """The votes of all rules over columns of counts, in the order of the rules."""
    return F.array(*[vote(rule) for rule in RULES])


def posterior(trust: Trust, voted: str = "votes") -> Column:
    """Probability that a text is good, given the array of its votes.

    The weights are one array of constants, so each round of estimation runs the same compiled code.
    """
    weights = F.array(*[
        F.struct(F.lit(math.log(right / (1 - bad))).alias("yes"), F.lit(math.log((1 - right) / bad)).alias("no"))
        for right, bad in [(trust.good, trust.good), *zip(trust.on_good, trust.on_bad)]])
    # the share of good texts enters as a rule that always says good
    said = F.zip_with(F.concat(F.array(F.lit(1)), F.col(voted)), weights, lambda v, w: F.when(v == 1, w["yes"]).when(
        v == -1, w["no"]).otherwise(0.0))
    return 1 / (1 + F.exp(-F.aggregate(said, F.lit(0.0), lambda total, x: total + x)))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Trust:
    """Estimate from vote patterns: the array ``votes``, and how many texts ``n`` have them.

    Every round is one aggregation of the small table; a single row of sums comes back.
    """
    trust = Trust(START_GOOD, (START_RIGHT_ON_GOOD,) * len(RULES), (START_RIGHT_ON_BAD,) * len(RULES))
    good, bad = F.col("n") * F.col("_p"), F.col("n") * (1 - F.col("_p"))
    sums = {"n": F.sum("n"), "good": F.sum(good)}
    for k in range(len(RULES)):
        said = F.get("votes", F.lit(k))
        sums |= {f"right{k}": F.sum(F.when(said == 1, good)), f"given{k}": F.sum(F.when(said != 0, good)),
                 f"caught{k}": F.sum(F.when(said == -1, bad)), f"held{k}": F.sum(F.when(said != 0, bad))}
    for _ in range(rounds):
        seen = patterns.withColumn("_p", posterior(trust)).agg(*[c.alias(name) for name, c in sums.items()]).head()
        if not seen["n"]:
            return trust
        part = {name: value or 0.0 for name, value in seen.asDict().items()}

        def chance(hits: float, of: float, start: float) -> float:
            return (hits + PSEUDO * start) / (of + PSEUDO)

        now = Trust(
            chance(part["good"], part["n"], START_GOOD),
            tuple(chance(part[f"right{k}"], part[f"given{k}"], START_RIGHT_ON_GOOD) for k in range(len(RULES))),
            tuple(chance(part[f"caught{k}"], part[f"held{k}"], START_RIGHT_ON_BAD) for k in range(len(RULES))))
        moved = max(abs(a - b) for a, b in zip(
            (now.good, *now.on_good, *now.on_bad), (trust.good, *trust.on_good, *trust.on_bad)))
        trust = now
        if moved < STILL:
            break
    return trust


def _patterns(counted: DataFrame) -> DataFrame:
    # one row per pattern: bounded by the number of rules, so one partition is enough
    return settle(counted.select(votes().alias("votes")).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1))


def quality_rules(docs: DataFrame, rounds: int = ROUNDS, decision: float = DECISION) -> DataFrame:
    """Counts, base verdict, votes, posterior and final verdict of every row of ``docs`` (doc_id, text).

    The texts are read once: their counts, some 100 bytes a document, are checkpointed between estimation and
    judgement.  ``kept`` is false where the base rules fail, else whether ``posterior`` reaches ``decision``.
    """
    counted = settle(with_counts(docs.select("doc_id", "text")).select("doc_id", "_counts.*"))
    trust = estimate(_patterns(counted), rounds)
    judged = counted.withColumn("votes", votes()).withColumns(
        {"posterior": posterior(trust), "base_failed": F.expr(BASE_FAILED)})
    kept = ~F.col("base_failed") & (F.col("posterior") >= decision)
    return judged.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "posterior", "votes")


def without_poor(docs: DataFrame, rounds: int = ROUNDS, decision: float = DECISION) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("_row"), "text")
    counted = with_counts(whole).select("_row", "_counts.*")
    trust = estimate(_patterns(counted), rounds)
    good = ~F.expr(BASE_FAILED) & (posterior(trust) >= decision)
    # A row number that the condition reads keeps it above the counts; pushed below, it would compute them anew
    # for each of its terms.
    judged = counted.withColumn("votes", votes()).select(
        "_row", good.alias("_good"), F.monotonically_increasing_id().alias("_place"))
    return judged.where("_good and _place >= 0").select("_row.*")
