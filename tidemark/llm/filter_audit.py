"""Filter interaction audit by decision diagrams.

Each document is reduced to its failure mask, one bit for each filter that it fails, and
masks are counted per part. The counts of a part become a decision diagram whose levels
test the filters one after another. Swapping two neighbouring levels changes only those,
so a walk through all orders by such swaps never starts anew. In every order, the path on
which all filters pass meets one node per step: what hangs below its failing side is what
the step removes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Orders grow with the factorial of the filters.
MOST_FILTERS = 8
_ZERO = 0
_SCHEMA = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


# --- failure masks --------------------------------------------------------------------


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions on a text that is not null and on the counts of its words."""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]++", "")).cast("long")
    return {
        "A": words["n"] < 100,
        "B": words["distinct"] * 100 < words["n"] * 80,
        "C": capitals * 100 > F.length(text).cast("long") * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def word_counts(text: Column) -> Column:
    """(n, distinct) of the words of a text, which ASCII white space parts."""
    found = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]++"), F.lit(0))

    def counts(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("long").alias("n"), F.size(F.array_distinct(ws)).cast("long").alias("distinct"))

    # Bound to a variable, so that a text is cut into words once.
    return F.transform(F.array(found), counts)[0]


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters A to E that they fail, A the lowest bit.

    The part is the language, the empty string for null. Filter E fails a document whose text
    a smaller doc_id has as well. Null texts count as empty. Rows without a doc_id come after
    all others. Rows that repeat an id are documents of their own; of equal texts, all rows
    with the smallest id pass. A document counts as good or toxic if any label row of its id says so.
    """
    one = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = one.agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    tests = text_filters(F.col("text"), F.col("words"))
    counted = rows.withColumn("words", word_counts(F.col("text")))
    mask = sum((test.cast("int") * (1 << bit) for bit, test in enumerate(tests.values())), F.lit(0))
    thin = counted.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    # Keyed by id as well, so that a text with very many copies is spread over the tasks.
    groups = stored(
        thin.join(known, "doc_id", "left")
        .groupBy("digest", "doc_id", "part", "mask")
        .agg(F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic"))),
        "masks",
    )
    duplicate = 1 << len(tests)
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    everything = groups.groupBy("part", "mask").agg(*sums)
    # The rows of the smallest id of each text; minima are combined before the shuffle.
    entry = F.struct("part", "mask", "n", "good", "toxic")
    of_id = groups.groupBy("digest", "doc_id").agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    first = of_id.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rows")).alias("first"))
    passing = first.select(F.inline("first.rows")).groupBy("part", "mask").agg(*sums)

    def signed(df: DataFrame, sign: int, extra: int) -> DataFrame:
        return df.select("part", (F.col("mask") + extra).alias("mask"), *(F.col(c) * sign for c in ("n", "good", "toxic"))).toDF(
            "part", "mask", "n", "good", "toxic"
        )

    whole = signed(everything, 1, duplicate).unionByName(signed(passing, -1, duplicate)).unionByName(signed(passing, 1, 0))
    return whole.groupBy("part", "mask").agg(*sums).where("n > 0")


# --- diagrams -------------------------------------------------------------------------


class Diagram:
    """Weights by failure mask. A node of level ``i`` tests filter ``order[i]`` and leads to (passing, failing).

    Equal nodes of a level are one node, nothing at all is node 0, and no level is left out.
    """

    def __init__(self, masks: Mapping[int, tuple[int, ...]], filters: int) -> None:
        self.order = list(range(filters))
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in range(filters)]
        self._known: list[dict[tuple, int]] = [{} for _ in range(filters + 1)]
        self._next = _ZERO
        width = len(next(iter(masks.values()), ()))
        self.weights: dict[int, tuple[int, ...]] = {_ZERO: (0,) * width}
        self.root = self._build(0, masks)

    def _build(self, level: int, masks: Mapping[int, tuple[int, ...]]) -> int:
        if not masks:
            return _ZERO
        if level == len(self.order):
            (weights,) = masks.values()
            return self._made(level, weights, weights)
        bit = 1 << self.order[level]
        sides = ({m: w for m, w in masks.items() if bool(m & bit) == fails} for fails in (False, True))
        return self._node(level, *(self._build(level + 1, side) for side in sides))

    def _made(self, level: int, key: tuple, weights: tuple[int, ...]) -> int:
        if key not in self._known[level]:
            self._next += 1
            self._known[level][key] = self._next
            self.weights[self._next] = weights
        return self._known[level][key]

    def _node(self, level: int, passing: int, failing: int) -> int:
        if passing == failing == _ZERO:
            return _ZERO
        both = tuple(map(sum, zip(self.weights[passing], self.weights[failing], strict=True)))
        node = self._made(level, (passing, failing), both)
        self.levels[level][node] = (passing, failing)
        return node

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next. Nodes of the level keep their number and weights."""
        upper, lower = self.levels[level], self.levels[level + 1]
        self.levels[level + 1], self._known[level + 1] = {}, {}
        none = (_ZERO, _ZERO)
        for node, (passing, failing) in upper.items():
            (pp, pf), (fp, ff) = lower.get(passing, none), lower.get(failing, none)
            upper[node] = (self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
        self._known[level] = {sides: node for node, sides in upper.items()}
        for gone in lower:
            del self.weights[gone]
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, weights kept, weights removed) of each step, along the path on which all pass."""
        node = self.root
        for level, tested in enumerate(self.order):
            passing, failing = self.levels[level].get(node, (_ZERO, _ZERO))
            yield tested, self.weights[passing], self.weights[failing]
            node = passing


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places to exchange with their right neighbour, one after another, so that every order of ``n`` comes once.

    The last one sweeps through the orders of the others, which move on each time it is at an end.
    """
    if n < 2:
        return
    others, leftwards = adjacent_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if leftwards else range(n - 1)
        step = next(others, None)
        if step is None:
            return
        yield step + leftwards
        leftwards = not leftwards


def audit_of_part(masks: Mapping[int, tuple[int, int, int]], filters: str) -> Iterator[tuple]:
    """The audit's rows of one part, without the part, for weights (documents, good, toxic) by mask."""
    failing = [sum(w[0] for m, w in masks.items() if m >> f & 1) for f in range(len(filters))]
    alone = [masks.get(1 << f, (0, 0, 0))[0] for f in range(len(filters))]
    diagram = Diagram(masks or {0: (0, 0, 0)}, len(filters))
    orders: list[tuple[str, list]] = []

    def note() -> None:
        orders.append(("".join(filters[f] for f in diagram.order), list(diagram.steps())))

    note()
    for place in adjacent_swaps(len(filters)):
        diagram.swap(place)
        note()
    shapley = [0] * len(filters)
    for _, steps in orders:
        for tested, _, removed in steps:
            shapley[tested] += removed[0]
    for order, steps in orders:
        for step, (f, kept, removed) in enumerate(steps, 1):
            yield (
                order, step, filters[f], kept[0], removed[0], failing[f] - removed[0], alone[f], removed[1], removed[2], shapley[f]
            )


def filter_audit(masks: DataFrame, filters: Sequence[str]) -> DataFrame:
    """What each filter removes at each step of every order, for each part.

    ``masks`` has (part, mask, n, good, toxic), one row for each part and mask, bit ``i``
    for the ``i``-th of ``filters`` (one letter each, eight at most). Columns: part,
    filter_order, step (from 1), filter, and the counts of documents kept after it, removed by
    it, redundant (failing it, but removed earlier), unique_fails (failing it alone), good_lost and
    toxic_lost (removed here with that label), shapley (removed by this filter, summed over
    all orders). Zeros included. A part's masks are at most two to the power of the filters.
    """
    letters = "".join(filters)
    if len(letters) != len(filters) or len(set(letters)) != len(letters) or not 1 <= len(letters) <= MOST_FILTERS:
        raise ValueError(f"filters need different names of one letter, {MOST_FILTERS} at most")

    def of_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        for frame in frames:
            for part, found in zip(frame["part"], frame["masks"], strict=True):
                weights = {int(m["mask"]): (int(m["n"]), int(m["good"]), int(m["toxic"])) for m in found}
                yield pd.DataFrame([(part, *row) for row in audit_of_part(weights, letters)], columns=names)

    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return parts.mapInPandas(of_parts, _SCHEMA)
