"""Quality rules: rules vote or abstain, and their votes are weighed by estimated accuracies."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import WORD, chunks
from starload.session import materialize

# Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_bangs", "n_stops", "n_distinct",
)


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on and good up to ``good``, if given; else it abstains."""

    name: str
    value: str
    bad: float
    good: float | None = None

    def vote(self) -> Column:
        value = F.expr(self.value)
        vote = F.when(value >= self.bad, -1)
        if self.good is not None:
            vote = vote.when(value <= self.good, 1)
        return F.when(F.col("n_words") > 0, vote.otherwise(0)).otherwise(0)


# Production rules: each value is low in good text. Most look for one defect, and abstain
# where they do not find it.
RULES = (
    Rule("symbols", "n_symbols / n_words", 0.2),
    Rule("symbol_share", "n_symbols / word_chars", 0.05),
    Rule("repeated_lines", "n_dup_lines / n_lines", 0.4),
    Rule("repeated_words", "100 * n_repeat_words / n_words", 20, 5),
    Rule("capitals", "n_upper / word_chars", 0.4),
    Rule("bangs", "n_bangs / n_words", 0.2),
    Rule("no_stops", "n_words / (n_stops + 1)", 100, 40),
    Rule("few_words", "-n_distinct / sqrt(n_words)", -1.5),
)
# The most often a rule may be wrong about good texts, and the least about bad ones.
WRONG_BAD, WRONG_GOOD = 0.02, 0.3


def _renamed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both numbers are equal, below their count."""
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1]


def repeated_words(doc: np.ndarray, words: np.ndarray, n_docs: int) -> np.ndarray:
    """Words per document inside windows of five words found twice or more in it.

    ``words`` are small numbers, ``doc`` the document of each. Windows get numbers step by
    step, pairs first, so equal numbers mean equal words.
    """
    size = len(words) - WINDOW + 1
    if size < 1:
        return np.zeros(n_docs, np.int64)
    pairs = _renamed(words[:-1], words[1:])
    fours = _renamed(pairs[:-2], pairs[2:])
    inside = np.flatnonzero(doc[:size] == doc[WINDOW - 1:])
    if not len(inside):
        return np.zeros(n_docs, np.int64)
    named = _renamed(_renamed(fours[inside], words[inside + WINDOW - 1]), doc[inside])
    twice = inside[np.bincount(named)[named] > 1]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edges[:-1]) > 0], minlength=n_docs)


def _duplicate_lines(lines: list[str]) -> int:
    seen, again = set(), 0
    for line in lines:
        if line in seen:
            again += 1
        elif WORD.search(line):
            seen.add(line)
    return again


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in chunks(batches):
        names: dict[str, int] = {}
        flat, doc, out = [], [], []
        for i, text in enumerate(texts):
            words = WORD.findall(text)
            flat.extend([names.setdefault(w, len(names)) for w in words])
            doc.append(len(words))
            lines = text.split("\n")
            out.append((
                len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
                _duplicate_lines(lines), 0, len(lines),
                sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")), text.count("!"),
                sum(map(text.count, ".;?")), len(set(words)),
            ))
        table = np.array(out, np.int64)
        table[:, 4] = repeated_words(
            np.repeat(np.arange(len(texts)), doc), np.array(flat, np.int64), len(texts)
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.array(c) for c in table.T]], ["doc_id", *COUNTS]
        )


def text_counts(docs: DataFrame) -> DataFrame:
    """The counts of each text of ``docs`` (doc_id, text); a NULL text has none of anything."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_counts, schema)


def estimate(patterns: np.ndarray, weights: np.ndarray, rounds: int = 100) -> tuple:
    """Prior of good, and per rule and vote (bad, abstain, good) its probability in good and
    in bad texts, by expectation-maximisation over the distinct vote patterns.

    Rules find single defects, so a bad text gets few bad votes: what keeps the classes apart is
    that a rule votes bad in at most ``WRONG_BAD`` of the good texts, and may well vote good
    in bad ones (``WRONG_GOOD`` of them at least).
    """
    is_vote = [(patterns == v).astype(float) for v in (-1, 0, 1)]
    start = np.array([[0.02, 0.38, 0.6], [0.4, 0.3, 0.3]])
    prior, tables = 0.85, np.repeat(start[:, None, :], patterns.shape[1], axis=1)
    for _ in range(rounds):
        logit = np.log(prior / (1 - prior)) + sum(
            m @ np.log(tables[0, :, v] / tables[1, :, v]) for v, m in enumerate(is_vote)
        )
        good = weights / (1 + np.exp(-logit))
        for c, w in enumerate((good, weights - good)):
            seen = np.stack([w @ m for m in is_vote], axis=1) + 10 * start[c]
            tables[c] = seen / seen.sum(axis=1, keepdims=True)
        votes_good = patterns.max(axis=0, initial=0) > 0
        tables[0, :, 0] = np.minimum(tables[0, :, 0], WRONG_BAD)
        tables[1, :, 2] = np.where(votes_good, np.maximum(tables[1, :, 2], WRONG_GOOD), tables[0, :, 2])
        tables /= tables.sum(axis=2, keepdims=True)
        prior = min(max((good.sum() + 1) / (weights.sum() + 2), 0.01), 0.99)
    return prior, tables


def quality_votes(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, votes and posterior quality of every row of ``docs`` (doc_id, text).

    Texts are counted once, in tasks. The votes are grouped by their pattern, at most
    3 ** len(rules) of them whatever the number of texts; only these reach the driver, which
    estimates the accuracies. The posterior is a column expression.

    Result: doc_id, the counts, one column ``vote_<rule>`` each, ``base_failed`` (fewer than
    ten words, or more than 20 % of them in repeated windows), ``quality`` (posterior) and
    ``kept``. Null or empty text: no words, so base_failed. Null doc_id and repeated rows:
    one result each. Empty table: no rows. Other columns are not read.
    """
    votes = [f"vote_{r.name}" for r in rules]
    counted = materialize(
        text_counts(docs).select("*", *[r.vote().cast("int").alias(v) for r, v in zip(rules, votes)]),
        "votes",
    )
    seen = counted.groupBy(*votes).agg(F.count("*").alias("n")).collect()
    patterns = np.array([[r[v] for v in votes] for r in seen], np.int64).reshape(len(seen), len(votes))
    prior, tables = estimate(patterns, np.array([r["n"] for r in seen], float))
    logit = F.lit(float(np.log(prior / (1 - prior))))
    for v, (bad, none, good) in zip(votes, np.log(tables[0] / tables[1]).tolist()):
        logit = logit + F.when(F.col(v) == -1, bad).when(F.col(v) == 1, good).otherwise(none)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-logit))}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    )
