"""Jaccard join of word n-gram sets: a size-aware heavy-light join.

Copies of one set are one set from the start. The elements of a set are ordered by how
common they are, the rarest first. Two sets that reach the threshold share elements among
their first ones (prefix filter), so candidates meet

* in the light part, when the smaller set is small: every set lists all two-element subsets
  of its first elements, and partners meet at a common subset;
* in the heavy part, when both are large: every set is entered in the lists of its first
  elements, and partners meet in a list.

Where light ends and heavy begins is chosen by cost, from counts over all sets.

A group of thousands of near copies would be millions of pairs, but only which sets hang
together is asked for. So each list first links its members to one of them, the one in
which the list's element lies earliest. Sets that then hang together need no further look.
What is left, pairs that share a list and do not hang together yet, is tried pair by pair.
Every candidate is decided on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import groups_of_texts, place_counts, stored, summed

WORDS = 4


class Share(NamedTuple):
    """A Jaccard threshold as a ratio of integers, above one half: linked sets then share two elements."""

    needed: int
    of: int

    @property
    def smallest(self) -> int:
        """Elements of the smallest set that links to another than its copies: one that is larger by one holds it."""
        return -(-self.needed // (self.of - self.needed)) if self.needed < self.of else 1 << 62


SHARE = Share(85, 100)
#: Counters of the sketch that orders elements, and bits of the filter that picks texts to read again.
#: Both are of fixed size and decide only what is tried first and what is read, never a result.
COUNTERS = 1 << 20
FILTER_BITS = 1 << 26
#: Largest sizes of a light set to choose from.
BOUNDARIES = (0, 8, 12, 16, 24, 32, 48, 64, 96, 128)
REMEMBERED = 300_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hash of each word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """The distinct hashes of a text's word n-grams, ascending; a shorter text is one n-gram."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, found), dtype=np.uint64, count=len(found))
    size = min(n, len(hashes))
    grams = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for at in range(size):
        grams = grams * _MULTIPLIER + hashes[at : len(hashes) - size + 1 + at]
        grams ^= grams >> np.uint64(29)
    return np.unique(grams * _MULTIPLIER)


def _smallest_partner_overlap(n: Column, share: Share) -> Column:
    """Elements that a set of ``n`` shares at least with the smallest set it can link to."""
    return F.ceil(n * share.needed / share.of)


def _equal_partner_overlap(n: Column, share: Share) -> Column:
    return F.ceil(n * (2 * share.needed) / (share.of + share.needed))


def _prefix(n: int, share: Share = SHARE) -> int:
    """Elements kept of a set: the longest prefix that any pair needs, and one more for subsets."""
    return max(n - -(-n * share.needed // share.of) + 2, 0)


# --- what all texts have in common -----------------------------------------------------


def _sketch(texts: DataFrame, n: int) -> np.ndarray:
    """How many sets have an element in each counter, over all texts."""
    shift = np.uint64(64 - COUNTERS.bit_length() + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return place_counts(
            ((shingles(text, n) >> shift).astype(np.int64) for _, group in groups_of_texts(batches) for text in group), COUNTERS
        )

    return summed(texts.select("key", "text"), count, COUNTERS)


def _filter(keys: DataFrame) -> np.ndarray:
    """Bits of the keys, for picking rows by key without a shuffle; it may let others through."""

    def mark(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            bits[batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64) & (FILTER_BITS - 1)] = True
        return np.packbits(bits).view("<i8")

    return summed(keys, mark, FILTER_BITS // 64, either=True).view(np.uint8)


# --- sets -----------------------------------------------------------------------------


def _set_id(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


def _sets(spark: SparkSession, texts: DataFrame, n: int, share: Share) -> DataFrame:
    """(key, n, sid, first): size, identity and first elements of each text's set."""
    order = spark.sparkContext.broadcast(_sketch(texts, n).astype(np.uint32))
    shift = np.uint64(64 - COUNTERS.bit_length() + 1)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = order.value
        for keys, group in groups_of_texts(batches):
            sizes, ids, first = [], [], []
            for text in group:
                elements = shingles(text, n)
                rank = np.lexsort((elements, common[(elements >> shift).astype(np.int64)]))[: _prefix(len(elements), share)]
                sizes.append(len(elements))
                ids.append(_set_id(elements))
                first.append(elements[rank].view(np.int64))
            bounds = np.cumsum([0, *map(len, first)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(first))),
                ],
                names=["key", "n", "sid", "first"],
            )

    return texts.select("key", "text").mapInArrow(make, "key long, n long, sid long, first array<long>")


def _elements(spark: SparkSession, texts: DataFrame, bits: np.ndarray, n: int) -> DataFrame:
    """(sid, n, elements) of the texts whose key the filter lets through, one row for each set."""
    shared = spark.sparkContext.broadcast(bits)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def picked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64) & (FILTER_BITS - 1)
                chosen = shared.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1
                yield batch.filter(pa.array(chosen.astype(bool)))

        for _, group in groups_of_texts(picked()):
            sets = [shingles(text, n) for text in group]
            bounds = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_set_id(s) for s in sets], pa.int64()),
                    pa.array(map(len, sets), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(sets).view(np.int64))),
                ],
                names=["sid", "n", "elements"],
            )

    found = texts.select("key", "text").mapInArrow(make, "sid long, n long, elements array<long>")
    return found.dropDuplicates(["sid", "n"])


# --- candidates -----------------------------------------------------------------------


class _Entry(NamedTuple):
    n: Column
    pos: Column


def _meets(small: _Entry, large: _Entry, boundary: int, share: Share) -> Column:
    """Whether a common list entry of two sets, the smaller first, can belong to a link."""
    both = small.n + large.n
    needed = F.ceil(both * share.needed / (share.of + share.needed))
    rest = F.least(small.n - small.pos, large.n - large.pos)
    heavy = (small.n > boundary) & (small.pos <= small.n - _equal_partner_overlap(small.n, share)) & (rest >= needed)
    return (small.n * share.of >= large.n * share.needed) & F.when(small.pos < 0, small.n <= boundary).otherwise(heavy)


def _boundary(sets: DataFrame, share: Share) -> int:
    """The largest size of a light set that costs the fewest entries, made and scanned.

    Every entry is made once. One that shares its list is scanned twice more, for the star
    and for what the star leaves; a long list costs no more than that for an entry, since
    its pairs are not tried while they hang together. The share of such entries is measured
    on the elements whose hash falls into one of 64 parts.
    """
    sized = sets.where(F.col("n") >= share.smallest)
    lists = (
        sized.select(F.explode("first").alias("e")).where(F.pmod("e", F.lit(64)) == 0).groupBy("e").count()
        .agg((F.sum(F.when(F.col("count") > 1, F.col("count")).otherwise(0)) / F.sum("count")).alias("shared"))
    )
    scan = 2 * (lists.collect()[0]["shared"] or 0.0)
    p = F.size("first").cast("double")
    sums = []
    for b in BOUNDARIES:
        light = F.when(F.col("n") * share.needed <= b * share.of, p * (p - 1) / 2).otherwise(0.0)
        heavy = F.when(F.col("n") > b, (p - 1) * (1 + scan)).otherwise(0.0)
        sums.append(F.sum(light + heavy).alias(f"b{b}"))
    cost = sized.agg(*sums).collect()[0]
    return min(BOUNDARIES, key=lambda b: (cost[f"b{b}"] or 0.0, b))


def _entries(sets: DataFrame, boundary: int, share: Share) -> DataFrame:
    """(list, sid, n, pos): entries of the heavy lists, and subsets of light sets with pos -1.

    Sets below the smallest size that can link have no partner but their copies.
    """
    sized = sets.where(F.col("n") >= share.smallest)
    longest = (F.col("n") - _smallest_partner_overlap(F.col("n"), share) + 1).cast("int")
    heavy = sized.where(F.col("n") > boundary).select(
        "sid", "n", F.posexplode(F.slice("first", F.lit(1), longest)).alias("pos", "list")
    )
    pairs = F.flatten(
        F.transform(
            "first",
            lambda a, at: F.transform(F.slice("first", at + 2, F.size("first")), lambda b: F.xxhash64(a, b)),
        )
    )
    light = sized.where(F.col("n") * share.needed <= boundary * share.of).select(
        "sid", "n", F.lit(-1).alias("pos"), F.explode(pairs).alias("list")
    )
    columns = ["list", "sid", "n", "pos"]
    return heavy.select(columns).unionByName(light.select(columns)) if boundary else heavy.select(columns)


def _pair(a: str, b: str, boundary: int, share: Share) -> tuple[Column, list[Column]]:
    """The condition, and the smaller and the larger set, of entries with these prefixes."""
    a_first = (F.col(f"{a}n") < F.col(f"{b}n")) | ((F.col(f"{a}n") == F.col(f"{b}n")) & (F.col(f"{a}sid") < F.col(f"{b}sid")))

    def pick(name: str, smaller: bool) -> Column:
        mine, other = F.col(f"{a}{name}"), F.col(f"{b}{name}")
        return F.when(a_first, mine if smaller else other).otherwise(other if smaller else mine)

    small, large = _Entry(pick("n", True), pick("pos", True)), _Entry(pick("n", False), pick("pos", False))
    columns = [pick("sid", True).alias("a"), small.n.alias("a_n"), pick("sid", False).alias("b"), large.n.alias("b_n")]
    return _meets(small, large, boundary, share), columns


def _links(pairs: DataFrame, sets: DataFrame, share: Share) -> DataFrame:
    """(a, b) of the pairs whose whole sets reach the threshold."""
    left = sets.select(F.col("sid").alias("a"), F.col("n").alias("a_n"), F.col("elements").alias("a_e"))
    right = sets.select(F.col("sid").alias("b"), F.col("n").alias("b_n"), F.col("elements").alias("b_e"))
    common = F.size(F.array_intersect("a_e", "b_e"))
    reached = common * share.of >= (F.col("a_n") + F.col("b_n") - common) * share.needed
    return pairs.join(left, ["a", "a_n"]).join(right, ["b", "b_n"]).where(reached).select("a", "b")


def _decided(pairs: DataFrame, sets: DataFrame, texts: DataFrame, n: int, share: Share) -> DataFrame:
    """The links among candidate pairs. The texts of their sets are read once more, others are not."""
    ids = pairs.select(F.col("a").alias("sid"), F.col("a_n").alias("n")).unionByName(pairs.select(F.col("b").alias("sid"), F.col("b_n").alias("n")))
    keys = sets.groupBy("sid", "n").agg(F.min("key").alias("key")).join(ids.distinct(), ["sid", "n"], "left_semi").select("key")
    elements = stored(_elements(pairs.sparkSession, texts, _filter(keys), n), "elements")
    return stored(_links(pairs, elements, share), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for the nodes that have links.

    Each round, a root moves to the smallest root next to its component, and nodes then
    move to the root of their root, so long chains take few rounds. Every round is written
    to the shared folder.
    """
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root"))
    while True:
        # The root of the root, until nothing moves.
        up = roots.select(F.col("node").alias("root"), F.col("root").alias("up"))
        roots = stored(roots.join(up, "root").select("node", F.col("up").alias("root")), "roots")
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moves = edges.join(a, "a").join(b, "b").where("rb < ra").groupBy("ra").agg(F.min("rb").alias("to"))
        moves = stored(moves, "moves")
        if moves.isEmpty():
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("up"))
            if roots.join(up, "root").where("up < root").isEmpty():
                return roots
            continue
        roots = roots.join(moves.withColumnRenamed("ra", "root"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )


def ngram_join(docs: DataFrame, n: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, kept), one row for each row of ``docs``.

    A document's set has the distinct ``n``-word shingles of its lower-cased (A-Z) words,
    which ASCII white space parts; fewer words are one shingle. Two documents link when
    their Jaccard similarity is at least ``share``, 0.85 unless given; ``component_id`` is the smallest doc_id that
    links reach. Null and empty texts, and texts of white space, have the empty set, which
    links with nothing, so their component is their own id. Copies and repeated rows share
    a set. A null doc_id is never the smallest; a component of null ids has a null id.
    Other columns are ignored. ``text_hash`` is of id and text; ``kept`` marks one of each component.

    Sets are told apart by 64 bits and their size, elements by 64 bits.
    """
    share = Share(*share)
    if not share.of < 2 * share.needed <= 2 * share.of:
        raise ValueError("the share must be above one half, and at most one")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
    sets = stored(_sets(spark, texts, n, share), "sets")
    boundary = _boundary(sets, share)
    entries = _entries(sets, boundary, share)

    # Lists that more than one set is in. The member in which the element lies earliest stands for the list.
    lists = (
        entries.groupBy("list").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low <> high").select("list")
    )
    met = stored(entries.join(lists, "list").distinct(), "entries")
    rank = F.shiftleft((F.col("pos") + 1).cast("long"), 40).bitwiseOR(F.shiftrightunsigned("sid", 24))
    centers = met.groupBy("list").agg(
        F.min_by("sid", rank).alias("c_sid"), F.min_by("n", rank).alias("c_n"), F.min("pos").alias("c_pos")
    )
    possible, columns = _pair("", "c_", boundary, share)
    stars = met.join(centers, "list").where((F.col("sid") != F.col("c_sid")) & possible).select(*columns).distinct()
    stars = stored(stars, "stars")
    first = _decided(stars, sets, texts, n, share)
    roots = components(first)

    # Lists whose members do not hang together yet.
    known = roots.select(F.col("node").alias("sid"), "root")
    rooted = met.join(known, "sid", "left").select("list", "sid", "n", "pos", F.coalesce("root", "sid").alias("root"))
    apart = rooted.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("list")
    rest = stored(rooted.join(apart, "list", "left_semi"), "rest")
    left = rest.select("list", *(F.col(c).alias(f"l_{c}") for c in ("sid", "n", "pos", "root")))
    right = rest.select("list", *(F.col(c).alias(f"r_{c}") for c in ("sid", "n", "pos", "root")))
    possible, columns = _pair("l_", "r_", boundary, share)
    once = (F.col("l_root") < F.col("r_root")) & (F.col("l_sid") != F.col("r_sid"))
    tried = left.join(right, (left["list"] == right["list"]) & once & possible).select(*columns).distinct()
    tried = stored(tried.join(stars, ["a", "a_n", "b", "b_n"], "left_anti"), "tried")
    more = _decided(tried, sets, texts, n, share)
    if not more.isEmpty():
        roots = components(first.unionByName(more))

    of_set = roots.select(F.col("node").alias("sid"), "root")
    ids = texts.select("doc_id", "key").join(sets.select("key", "n", "sid").distinct(), "key")
    # A set without links stands for itself; its size keeps it apart from another with the same 64 bits.
    placed = ids.join(of_set, "sid", "left").select(
        "doc_id", "n", "key", F.coalesce("root", "sid").alias("root"), F.when(F.col("root").isNull(), F.col("n")).otherwise(0).alias("alone")
    )
    keeper = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    smallest = placed.groupBy("root", "alone").agg(F.min("doc_id").alias("component_id"), F.min(keeper).alias("keeper"))
    empty = F.col("n") == 0
    return placed.join(smallest, ["root", "alone"]).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("key").alias("text_hash"),
        (empty | (F.col("key") == F.col("keeper.key"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, n: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when each component keeps one.

    It keeps the row with the smallest id (nulls last; of one id, the smallest hash of id
    and text). Of rows that repeat id and text one stays. Texts without words all stay.
    """
    found = stored(ngram_join(docs, n, share), "components")
    gone = found.where(~F.col("kept")).select(F.col("text_hash").alias("_gone")).distinct()
    key = F.xxhash64(F.col("row.doc_id").cast("long"), F.col("row.text"))
    left = docs.select(F.struct("*").alias("row")).withColumn("_key", key)
    left = left.join(gone, left["_key"] == gone["_gone"], "left_anti")
    again = stored(found.where("kept AND n_shingles > 0").groupBy("text_hash").count().where("count > 1"), "repeated")
    if again.isEmpty():
        return left.select("row.*")
    again = again.select(F.col("text_hash").alias("_key"))
    first = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0)))
    repeated = left.join(again, "_key", "left_semi").withColumn("_first", first).where("_first = 1")
    return left.join(again, "_key", "left_anti").select("row.*").unionByName(repeated.select("row.*"))
