"""Quality rules as weak supervision.

Every rule looks at measures of a text and votes good (1), bad (-1) or abstains (0). No rule is
trusted outright: expectation-maximisation over the vote patterns of the corpus estimates how often
good and bad documents get each vote, and with it each rule's accuracy. A document is kept by its
posterior probability of being good, not by passing all rules.

Texts are measured and judged by DataFrame expressions. The vote patterns, at most 3 to the number of
rules whatever the corpus (2,187 of the seven rules here), are counted once by Spark; the estimation
goes over that small table in the driver, as a job for each step would leave it its plan and its code.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace

WHITE_SPACE = ("\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5

GOOD, ABSTAIN, BAD = 1, 0, -1


# --- measures ------------------------------------------------------------------------------------


def spaced(text: Column) -> Column:
    """The text with every white-space character as a space; empty for null."""
    text = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        text = F.replace(text, F.lit(character), F.lit(" "))
    return text


def n_words(text: str = "text") -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.size(F.array_remove(F.split(spaced(F.col(text)), " "), "")).cast("long")


def without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of every window of five words, in order."""

    def pairs(left: Column, right: Column, ahead: int) -> Column:
        ahead_of_it = F.slice(right, F.lit(ahead + 1), F.size(right))
        return F.zip_with(left, ahead_of_it, lambda a, b: F.xxhash64(a, b))

    one = F.transform(words, lambda w: F.xxhash64(w))
    two = pairs(one, one, 1)
    five = pairs(pairs(two, two, 2), one, 4)
    return F.slice(five, F.lit(1), F.greatest(F.size(words) - (WINDOW_WORDS - 1), F.lit(0)))


def by_hash(windows: Column) -> Column:
    return F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def repeated_places(ordered: Column) -> Column:
    """Places of windows that have an equal one; equal ones are neighbours in ``ordered``."""

    def place(item: Column, n: Column) -> Column:
        before, after = F.get(ordered, n - 1), F.get(ordered, n + 1)
        same = (item["h"] == before["h"]) | (item["h"] == after["h"])
        return F.when(F.coalesce(same, F.lit(False)), item["i"])

    return F.array_sort(F.array_compact(F.transform(ordered, place)))


def covered_words(places: Column) -> Column:
    """Words in the windows at these places, each word once: a window counts up to the next."""
    steps = F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda a, b: b - a)
    full = F.lit(WINDOW_WORDS)
    return F.aggregate(
        steps, F.lit(0).cast("long"), lambda total, n: total + F.least(F.coalesce(n, full), full)
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of each whole text in a struct column ``measures``."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"_spaced": spaced(F.col(text)), "_lines": lines})
    lettered = without(F.col("_spaced"), SYMBOLS)
    out = out.withColumn("_words", F.array_remove(F.split("_spaced", " "), ""))
    out = out.withColumn("_worded", F.array_remove(F.split(lettered, " "), ""))
    out = out.withColumn("_windows", window_hashes(F.col("_words")))
    # Most texts repeat no window; only the windows of the others are sorted.
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    windows = F.when(some, F.col("_windows")).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("_ordered", by_hash(windows))
    out = out.withColumn("_places", repeated_places(F.col("_ordered")))
    values = {
        "n_words": F.size("_words"),
        "word_chars": F.length(without(F.col("_spaced"), " ")),
        "n_symbols": F.length(body) - F.length(without(body, SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": covered_words(F.col("_places")),
        "n_lines": F.size("_lines"),
        "n_symbol_words": F.size("_words") - F.size("_worded"),
        "n_sentence_ends": F.regexp_count(body, F.lit(r"[.!?](?=[\x20\x09-\x0D]|\z)")),
    }
    measures = F.struct(*(value.cast("long").alias(name) for name, value in values.items()))
    scratch = ("_spaced", "_lines", "_words", "_worded", "_windows", "_ordered", "_places")
    return out.withColumn("measures", measures).drop(*scratch)


# --- rules ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(self.bad, F.lit(BAD)).when(self.good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))


def rules() -> list[Rule]:
    m = {
        name: F.col("measures")[name].cast("double")
        for name in (
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "n_lines",
            "n_symbol_words",
            "n_sentence_ends",
        )
    }
    words = F.greatest(m["n_words"], F.lit(1.0))
    mean = m["word_chars"] / words
    symbols = m["n_symbols"] / F.greatest(m["word_chars"], F.lit(1.0))
    bare = m["n_symbol_words"] / words
    repeats = m["n_repeat_words"] / words
    copies = m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1.0))
    ends = m["n_sentence_ends"] / words
    return [
        Rule("length", m["n_words"] >= 20, m["n_words"] < 10),
        Rule("word_length", mean.between(3.5, 7.0), (mean < 3.0) | (mean > 10.0)),
        Rule("symbols", symbols < 0.01, symbols > 0.05),
        Rule("symbol_words", bare < 0.01, bare > 0.1),
        Rule("repeated_words", repeats < 0.05, repeats > 0.2),
        Rule("repeated_lines", copies < 0.05, copies > 0.5),
        Rule("sentences", ends.between(0.04, 0.3), (ends < 0.01) | (ends > 0.5)),
    ]


def base_failed() -> Column:
    words, repeats = F.col("measures.n_words"), F.col("measures.n_repeat_words")
    return (words < 10) | (100 * repeats > 20 * words)


# --- the label model -----------------------------------------------------------------------------


@dataclass(frozen=True)
class LabelModel:
    """``votes[rule][class][vote]``: how likely a rule that does not abstain votes good (1) or bad
    (-1), for classes good (1) and bad (0). Abstaining says nothing about a document."""

    names: list[str]
    prior: float
    votes: list[dict[int, dict[int, float]]]

    def accuracy(self) -> dict[str, float]:
        """How often a rule that does not abstain is right."""
        out = {}
        for name, chances in zip(self.names, self.votes):
            right = self.prior * chances[1][GOOD] + (1 - self.prior) * chances[0][BAD]
            wrong = self.prior * chances[1][BAD] + (1 - self.prior) * chances[0][GOOD]
            out[name] = right / (right + wrong)
        return out

    def posterior(self, votes: Column) -> Column:
        """Probability that a document with these votes is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for n, chances in enumerate(self.votes):
            ratio = {v: math.log(chances[1][v] / chances[0][v]) for v in (GOOD, BAD)}
            vote = votes[n]
            odds = odds + (
                F.when(vote == GOOD, F.lit(ratio[GOOD]))
                .when(vote == BAD, F.lit(ratio[BAD]))
                .otherwise(F.lit(0.0))
            )
        return 1 / (1 + F.exp(-odds))

    def chance_good(self, votes: np.ndarray) -> np.ndarray:
        """``posterior`` of patterns, one a row."""
        odds = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for n, chances in enumerate(self.votes):
            for vote in (GOOD, BAD):
                odds += (votes[:, n] == vote) * math.log(chances[1][vote] / chances[0][vote])
        return 1 / (1 + np.exp(-odds))


def moved(before: LabelModel | None, after: LabelModel) -> float:
    """The largest change of the prior or a chance between two models."""
    if before is None:
        return 1.0
    pairs = zip(before.votes, after.votes)
    steps = [abs(a[k][v] - b[k][v]) for a, b in pairs for k in (0, 1) for v in (GOOD, BAD)]
    return max(abs(before.prior - after.prior), *steps)


def fit(
    patterns: DataFrame, names: list[str], tolerance: float = 1e-4, most_steps: int = 500
) -> LabelModel:
    """Expectation-maximisation over ``patterns`` (votes, documents), until a step changes neither the
    prior nor any chance by more than ``tolerance``, or with a warning after ``most_steps``.

    It starts by doubting every document with a bad vote, as rules seldom blame a good text. Each
    chance has one document of each vote added, so that no vote is certain. An empty table gives the uninformed model.
    """
    counted = patterns.groupBy("votes").agg(F.sum("documents").alias("documents"))
    rows = sorted((tuple(r.votes), r.documents) for r in counted.collect())  # 3 to the rules at most
    votes = np.array([v for v, _ in rows], dtype=np.int64).reshape(len(rows), len(names))
    weight = np.array([n for _, n in rows], dtype=np.float64)
    good = np.where((votes == BAD).any(axis=1), 0.1, 0.9)
    model, step = None, 1.0
    for _ in range(most_steps):
        chances = [{} for _ in names]
        for kind, share in ((1, weight * good), (0, weight * (1 - good))):
            for n, by_class in enumerate(chances):
                counts = {v: float(share[votes[:, n] == v].sum()) + 1 for v in (GOOD, BAD)}
                by_class[kind] = {v: c / sum(counts.values()) for v, c in counts.items()}
        prior = (float((weight * good).sum()) + 1) / (float(weight.sum()) + 2)
        before, model = model, LabelModel(names, prior, chances)
        step = moved(before, model)
        if step <= tolerance:
            return model
        good = model.chance_good(votes)
    warnings.warn(f"after {most_steps} steps the label model still changes by {step:.1e}")
    return model


ADDED = ("measures", "votes", "base_failed", "posterior", "kept")


def with_votes(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``measures`` and the rules' ``votes``; columns of ``ADDED`` are replaced."""
    voted = measured(docs.drop(*ADDED), text)
    return voted.withColumn("votes", F.array(*(r.vote() for r in rules())))


def judge(
    voted: DataFrame, work: Workspace, threshold: float = 0.5
) -> tuple[DataFrame, LabelModel]:
    """What ``with_votes`` gave, with base_failed, posterior and kept; and the fitted model.

    ``voted`` is written once, then read for the estimation and for the result; drop columns first
    that the result need not have.

    Defined cases: a null or empty text has no words and fails the base rule; repeated rows are
    judged alike, each counting for the estimation; an empty table gives an empty result; texts of
    any length are judged whole.
    """
    voted = work.keep(voted, "votes")
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("documents"))
    model = fit(work.keep(patterns, "patterns"), [r.name for r in rules()])
    posterior = model.posterior(F.col("votes"))
    judged = voted.withColumns({"base_failed": base_failed(), "posterior": posterior})
    kept = ~F.col("base_failed") & (F.col("posterior") >= threshold)
    return judged.withColumn("kept", kept), model
