"""Ranked lexical search over term-partitioned posting lists, pipelined.

The terms of the queries are divided among a few owners, the rarest first, so that each
owns about as many postings. Queries travel in bundles. A bundle visits the owners one
after another, once for each slice of documents, and carries its accumulators along: the
score so far of each query and document that met. At an owner the bundle is cogrouped with
that owner's posting lists of the slice, and their contributions, whole numbers, are added.
After the last owner each slice hands on its best documents of a query, and the best of
those are the result.

An accumulator is left behind only when it cannot be among the best of its slice: when all
that later owners could add would leave it below the last of the best so far.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import groups_of_texts, place_counts, stored, summed

BEST = 10
OWNERS = 4
#: Queries in a bundle, and the most documents and characters of a slice; they bound what a task holds.
BUNDLE = 256
SLICE_ROWS, SLICE_CHARS = 4096, 8_000_000
#: Bits of the filter that spares most terms that no query has; the others are joined away.
FILTER_BITS = 1 << 22
REMEMBERED = 300_000

#: Fixed value: what parts terms (all of ASCII but digits and letters), and upper case.
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Maximal runs of digits, letters and everything outside ASCII; only A-Z is lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def _bit(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) & (FILTER_BITS - 1)


# --- queries and postings ---------------------------------------------------------------


def _query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), distinct."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in groups_of_texts(batches):
            for item, text in zip(ids, texts, strict=True):
                found = sorted(set(terms(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["item_id", "term"]
                )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(cut, "item_id long, term binary").distinct()


def _filter(wanted: DataFrame) -> np.ndarray:
    """Bits of the queries' terms."""

    def mark(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        places = (np.array([_bit(t) for t in batch.column(0).to_pylist()], dtype=np.int64) for batch in batches)
        return (place_counts(places, FILTER_BITS) > 0).astype(np.int64)

    return summed(wanted.select("term"), mark, FILTER_BITS) > 0


_SLICES = "slice long, docs array<long>, lengths array<long>, term binary, at array<int>, tf array<int>, n_terms long, n_docs long"


def _postings(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Slices of the documents: one row with their ids and lengths, and one for each term that a query may have.

    ``at`` are the places of the slice's documents that hold the term, ``tf`` how often they do.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    class Wanted(dict):
        def __missing__(self, term: bytes) -> bool:
            if len(self) >= REMEMBERED:
                self.clear()
            bit = _bit(term)
            value = self[term] = bool(shared.value[bit >> 3] >> (7 - (bit & 7)) & 1)
            return value

    def one(number: int, ids: list, texts: list[str], wanted: Wanted) -> Iterator[pa.RecordBatch]:
        lists: dict[bytes, tuple[list, list]] = {}
        kept, lengths = [], []
        for doc_id, text in zip(ids, texts, strict=True):
            counts = Counter(terms(text))
            if not counts:
                continue
            for term in filter(wanted.__getitem__, counts):
                at, tf = lists.setdefault(term, ([], []))
                at.append(len(kept))
                tf.append(counts[term])
            kept.append(doc_id)
            lengths.append(counts.total())
        order = sorted(lists)
        total = sum(lengths)
        yield pa.RecordBatch.from_pydict(
            {
                "slice": [number] * (len(order) + 1),
                "docs": [kept] + [None] * len(order),
                "lengths": [lengths] + [None] * len(order),
                "term": [None, *order],
                "at": [None, *(lists[t][0] for t in order)],
                "tf": [None, *(lists[t][1] for t in order)],
                "n_terms": [total] + [None] * len(order),
                "n_docs": [len(kept), *(len(lists[t][0]) for t in order)],
            },
            schema=pa.schema(
                [
                    ("slice", pa.int64()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("term", pa.binary()),
                    ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())), ("n_terms", pa.int64()), ("n_docs", pa.int64()),
                ]
            ),
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        wanted = Wanted()
        for ids, texts in groups_of_texts(batches, SLICE_CHARS):
            for begin in range(0, len(ids), SLICE_ROWS):
                yield from one(number, ids[begin : begin + SLICE_ROWS], texts[begin : begin + SLICE_ROWS], wanted)
                number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _SLICES)


# --- owners -----------------------------------------------------------------------------


def _owned(wanted: DataFrame, postings: DataFrame, n_docs: int, owners: int) -> DataFrame:
    """(bundle, place, item_id, term, owner, weight): query terms with what the pipeline needs of them.

    Owners take terms by falling weight until each has its share of the postings. The
    table is as large as the queries; running sums go by ranges of weight, then inside a range.
    """
    held = postings.where("term IS NOT NULL").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * F.lit(n_docs) + 2) / (2.0 * F.col("df") + 1))).cast("long")
    known = stored(wanted.join(held, "term").withColumn("weight", weight), "query-terms")
    by_weight = known.select("term", "df", "weight").distinct().groupBy("weight").agg(F.sum("df").alias("postings"))
    # One row for each different weight, at most some tens of thousands whatever the queries are.
    before = F.sum("postings").over(Window.orderBy(F.desc("weight"))) - F.col("postings")
    owner = F.least(F.floor(before * owners / F.sum("postings").over(Window.partitionBy(F.lit(0)))), F.lit(owners - 1))
    owning = by_weight.select("weight", owner.cast("int").alias("owner"))
    return known.join(owning, "weight").select("item_id", "term", "owner", "weight")


def _contributions(tf: np.ndarray, m: np.ndarray, weight: int) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _hopeful(scores: np.ndarray, rest: np.ndarray, best: int) -> np.ndarray:
    """Which scores above 0 can still be among the ``best`` of their row when each gains less than ``rest``."""
    if scores.shape[1] <= best:
        return scores > 0
    floor = np.partition(scores, scores.shape[1] - best, axis=1)[:, scores.shape[1] - best]
    return (scores > 0) & (scores + rest[:, None] >= floor[:, None])


def _tops(bundle: int, docs: list, scores: np.ndarray, best: int) -> pa.Table:
    """The best documents of each query in a slice."""
    # Ids in order, nulls last, so that of equal scores the first places are the smallest ids.
    order = np.array(sorted(range(len(docs)), key=lambda p: (docs[p] is None, docs[p] or 0)), dtype=np.int64)
    found: list[tuple] = []
    for query in range(len(scores)):
        mine = scores[query, order]
        top = np.argsort(-mine, kind="stable")[:best]
        found += [(bundle, query, docs[order[p]], int(mine[p])) for p in top[mine[top] > 0]]
    return pa.table([list(c) for c in zip(*found, strict=True)] if found else [[]] * 4, schema=_ENDS)


def _list(values: np.ndarray, kind: pa.ListType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values).cast(kind.value_type))


_BUNDLES = "bundle int, slice long, docs array<long>, lengths array<long>, rest array<long>, queries array<int>, places array<int>, scores array<long>"
_TOPS = "bundle int, place int, doc_id long, score long"
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_CARRIES = pa.schema(
    [
        ("bundle", pa.int32()), ("slice", pa.int64()), ("docs", _LONGS), ("lengths", _LONGS), ("rest", _LONGS),
        ("queries", _INTS), ("places", _INTS), ("scores", _LONGS),
    ]
)
_ENDS = pa.schema([("bundle", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST, owners: int = OWNERS, bundle: int = BUNDLE) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) its ``best`` documents.

    N documents hold a term at all, with L terms in all, repeats included. A term that df of
    them hold weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); where it comes tf times in a
    document of n terms, with m = 100 - 90 + 90 n N div L, it adds w (1000000000 tf div
    (1000 tf + 8 m)). A document's score is the sum over the item's different terms. Only
    scores above 0 are ranked, from 1, equal ones by doc_id; rows without an id come last.
    Null and empty texts have no terms. Items that repeat an id are one item with the terms of
    all; rows of documents that repeat an id are ranked each. Other columns are ignored.
    """
    wanted = stored(_query_terms(items), "query-words")
    postings = stored(_postings(docs, _filter(wanted)), "postings")
    sums = postings.where("term IS NULL").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).collect()[0]
    n_docs, n_terms = sums["n"] or 0, sums["l"] or 0
    owned = stored(_owned(wanted, postings, max(n_docs, 1), owners), "owned-terms")

    # Each item's place in a bundle, and what the terms of later owners can weigh for it in all.
    later = [F.sum(F.when(F.col("owner") > s, F.col("weight")).otherwise(0)).alias(f"rest{s}") for s in range(owners)]
    ids = owned.groupBy("item_id").agg(F.array(*later).alias("rest"))
    bundles = max(-(-ids.count() // bundle), 1)
    dealt = ids.withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(bundles)).cast("int"))
    place = F.row_number().over(Window.partitionBy("bundle").orderBy(F.col("item_id").asc_nulls_first())) - 1
    placed = stored(dealt.withColumn("place", place), "bundles")
    by_place = F.array_sort(F.collect_list(F.struct("place", "rest")))
    crews = placed.groupBy("bundle").agg(F.flatten(F.transform(by_place, lambda q: q["rest"])).alias("rest"))
    slices = postings.where("term IS NULL AND n_docs > 0").select("slice", "docs", "lengths")
    # A bundle reads every slice: a query set against all rows, slice by slice.
    carried = slices.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)))).join(crews, "bundle")
    empty = [F.array().cast(kind).alias(name) for name, kind in (("queries", "array<int>"), ("places", "array<int>"), ("scores", "array<long>"))]
    carried = carried.select("bundle", "slice", "docs", "lengths", "rest", *empty)

    of_term = (
        owned.join(placed.select("item_id", "bundle", "place"), owned["item_id"].eqNullSafe(placed["item_id"]))
        .groupBy("term", "owner", "weight", "bundle")
        .agg(F.array_sort(F.collect_list("place")).alias("queries"))
    )
    lists = postings.where("term IS NOT NULL").select("term", "slice", "at", "tf").join(of_term, "term")
    lists = stored(lists.select("owner", "bundle", "slice", "at", "tf", "weight", F.col("queries").alias("asking")), "lists", ("owner",))

    def visit(stage: int):
        last = stage == owners - 1
        out = _ENDS if last else _CARRIES

        def add(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return out.empty_table()
            head = {name: left.column(name)[0] for name in left.column_names}
            lengths, rests, queries, places, scored = (
                head[name].values.to_numpy().astype(np.int64) for name in ("lengths", "rest", "queries", "places", "scores")
            )
            rests = rests.reshape(-1, owners)
            m = 100 - 90 + (90 * lengths * n_docs) // n_terms
            scores = np.zeros((len(rests), len(lengths)), dtype=np.int64)
            scores[queries, places] = scored
            for n in range(right.num_rows):
                at, tf, asking = (right.column(c)[n].values.to_numpy().astype(np.int64) for c in ("at", "tf", "asking"))
                gained = _contributions(tf, m[at], right.column("weight")[n].as_py())
                for query in asking:
                    scores[query, at] += gained
            if last:
                return _tops(head["bundle"].as_py(), head["docs"].as_py(), scores, best)
            queries, places = np.nonzero(_hopeful(scores, rests[:, stage] * 1_000_000, best))
            moved = {"queries": queries, "places": places, "scores": scores[queries, places]}
            columns = [
                _list(moved[f.name], f.type) if f.name in moved else left.column(f.name).slice(0, 1).cast(f.type) for f in out
            ]
            return pa.table(columns, schema=out)

        return add

    for stage in range(owners):
        mine = lists.where(F.col("owner") == stage).drop("owner")
        pairs = carried.groupBy("bundle", "slice").cogroup(mine.groupBy("bundle", "slice"))
        carried = pairs.applyInArrow(visit(stage), _TOPS if stage == owners - 1 else _BUNDLES)
    named = carried.join(placed.select("bundle", "place", "item_id"), ["bundle", "place"])
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return named.withColumn("rank", rank).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")

