"""A quality classifier that is a sparse list of weighted rules.

Statistics of each text are columns. Small trees are grown on labelled rows; every path
from a tree's root is a rule, a conjunction of comparisons. A logistic regression with a
lasso penalty over the rules' answers leaves few of them with a weight, and those are
compiled into one Spark column expression, so that scoring is a projection.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Most labelled documents that a model is fitted on; those with the smallest hash of their id are taken.
MOST_LABELLED = 20_000
TREES = 24
DEPTH = 3
PENALTY = 0.002
SEED = 11
HELD_OUT_PART, PARTS = 2, 4
ACCEPTED = 0.7

STATISTICS = (
    "log_chars", "log_words", "word_chars", "long_words", "short_words", "letters", "capitals", "digits", "spaces",
    "stops", "signs", "bars", "shouts", "odd_tails", "entropy", "distinct_words", "top_word", "bare_repeats",
    "repeated_lines", "line_chars", "shouted_words", "log_repeats", "log_tails", "log_bars",
)

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CAPITALS = np.zeros(256, dtype=bool)
_CAPITALS[65:91] = True
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[48:58] = True
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b".,;:?'\"()-")] = True
_OTHER = ~(_LETTERS | _DIGITS | _SPACES | _STOPS)


def statistics_of(text: str) -> tuple[float, ...]:
    """The statistics of one text, in the order of ``STATISTICS``; all zero for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    ws = raw.split()
    if not ws:
        return (0.0,) * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size, n = len(raw), len(ws)
    lengths = np.fromiter(map(len, ws), dtype=np.int64, count=n)
    kinds: dict[bytes, int] = {}
    for w in ws:
        kinds[w] = kinds.get(w, 0) + 1
    share = counts[counts > 0] / size
    lines = [line for line in raw.split(b"\n") if line.strip()]
    tails = sum(_OTHER[w[-1]] for w in ws)
    repeats = sum(a == b for a, b in zip(ws, ws[1:], strict=False))
    return (
        np.log1p(size),
        np.log1p(n),
        float(lengths.mean()),
        float((lengths > 20).mean()),
        float((lengths <= 3).mean()),
        counts[_LETTERS].sum() / size,
        counts[_CAPITALS].sum() / size,
        counts[_DIGITS].sum() / size,
        counts[_SPACES].sum() / size,
        counts[_STOPS].sum() / size,
        counts[_OTHER].sum() / size,
        float(counts[124] / n),
        float(counts[33] / n),
        float(tails / n),
        float(-(share * np.log2(share)).sum()),
        len(kinds) / n,
        max(kinds.values()) / n,
        repeats / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(size / len(lines))),
        sum(w.isupper() and len(w) > 1 for w in ws) / n,
        float(np.log1p(repeats)),
        float(np.log1p(tails)),
        float(np.log1p(counts[124])),
    )


def measured(text: Column) -> Column:
    """The statistics of each text, as a struct; a null text counts as empty."""

    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics_of(t or "") for t in texts], columns=STATISTICS, dtype="float64")

    return F.pandas_udf(measure, ", ".join(f"{s} double" for s in STATISTICS))(text)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, *STATISTICS), one row for each row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), measured(F.col("text")).alias("s")).select("doc_id", "s.*")


class Test(NamedTuple):
    """One comparison of a rule."""

    statistic: str
    at_most: bool
    bound: float

    def column(self, of: str = "") -> Column:
        value = F.col(of + self.statistic)
        return value <= self.bound if self.at_most else value > self.bound


Rule = tuple[Test, ...]


def tree_rules(described: str) -> list[Rule]:
    """Every path from the root, as a rule, of a tree as Spark ML describes it."""
    rules, path = [], []
    for line in described.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            # A line's indent is its depth; deeper tests of the branch before it no longer hold.
            path = [(indent, test) for indent, test in path if indent < len(found[1])]
            path.append((len(found[1]), Test(STATISTICS[int(found[2])], found[3] == "<=", float(found[4]))))
            rules.append(tuple(sorted(test for _, test in path)))
    return rules


class Model(NamedTuple):
    """Weighted rules; ``score`` is the column that they compile to, over statistics named ``of``*."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, of: str = "") -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.weights:
            total += F.when(_holds(rule, of), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _holds(rule: Rule, of: str = "") -> Column:
    return reduce(lambda a, b: a & b, (test.column(of) for test in rule))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS == HELD_OUT_PART, F.lit(False))


def labelled(rows: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Statistics and ``label`` of at most ``most`` labelled documents outside the test part.

    A document with several labels has the one that most of them say, 1 if they balance.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return rows.join(known, "doc_id")


def fit(rows: DataFrame) -> Model:
    """Rules from trees, weights by lasso. With labels of one kind, or none, a constant."""
    # A bounded number of rows in a fixed order, so that the same labels give the same model.
    data = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics").transform(rows.repartition(1).sortWithinPartitions("doc_id", *STATISTICS))
    data = stored(data.select("label", "statistics", *STATISTICS), "labelled")
    counts = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = 0.5 if not counts else min(max(next(iter(counts)), 0.01), 0.99)
        return Model(float(np.log(share / (1 - share))), ())
    # Both kinds weigh the same in the trees, or rare junk would never be split off.
    weighted = data.withColumn("weight", F.when(F.col("label") == 1, 1.0 / counts[1.0]).otherwise(1.0 / counts[0.0]) * sum(counts.values()) / 2)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="statistics", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=2
    ).fit(weighted)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree.toDebugString)})
    if not rules:
        return Model(float(np.log(counts[1.0] / counts[0.0])), ())
    answers = weighted.select("label", "weight", *(_holds(rule).cast("double").alias(f"r{at}") for at, rule in enumerate(rules)))
    answers = VectorAssembler(inputCols=[f"r{at}" for at in range(len(rules))], outputCol="rules").transform(answers)
    lasso = LogisticRegression(
        labelCol="label", featuresCol="rules", weightCol="weight", elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=60
    ).fit(answers.select("label", "weight", "rules"))
    weights = zip(rules, lasso.coefficients.toArray().tolist(), strict=True)
    return Model(float(lasso.intercept), tuple((rule, w) for rule, w in weights if w))


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    ``score`` is from 0 to 1, higher for better texts; null and empty texts are scored like
    any other (all statistics are zero); ``predicted`` is 1 from a score of 0.7. Only the
    text decides. Labels of the held-out part (crc32 of the id, modulo 4, is 2) are never
    learned; a null id is not held out. Without labels of both kinds every score is the
    same. Repeated rows are scored alike; other columns are ignored.
    """
    rows = stored(statistics(docs), "statistics")
    model = fit(labelled(rows, labels, most))
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches 0.7.

    Texts of labelled documents are measured for the model; all rows are then scored where
    they are, without a shuffle.
    """
    wanted = labels.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("doc_id"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    model = fit(labelled(stored(statistics(known), "statistics"), labels, most))
    rows = docs.select(F.struct("*").alias("row"), measured(docs["text"]).alias("stats"))
    return rows.where(model.score("stats.") >= ACCEPTED).select("row.*")
