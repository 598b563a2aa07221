"""Benchmark decontamination by winnowing.

Every ``k`` consecutive words are hashed, and of each ``window - k + 1`` consecutive
hashes the smallest is kept, at its leftmost place. Two texts that share ``window`` words
share all hashes of that span and hence a kept one, so joining the kept hashes of
documents with those of benchmark items misses no shared span. At each hit the windows
around it are then compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored

WINDOW = 10
K = 5

#: Fixed value: what parts words (all of ASCII but digits and lower-case letters).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    whole = F.coalesce(text, F.lit(""))
    # Spark's own lower case differs from that only outside ASCII.
    lowered = F.when(F.length(whole) == F.octet_length(whole), F.lower(whole)).otherwise(ascii_lower(whole))
    return F.array_remove(F.split(lowered, _BETWEEN, -1), "")


def _starts(last: Column) -> Column:
    """0 to ``last``, or nothing."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _sliding(values: Column, width: int, combine) -> Column:
    """``combine`` over every ``width`` consecutive values; each pass covers up to twice as many, some of them twice."""

    def wider(step: int):
        def pair(part: Column) -> Column:
            n = F.greatest(F.size(part) - step, F.lit(0))
            return F.zip_with(F.slice(part, F.lit(1), n), F.slice(part, F.lit(1 + step), n), combine)

        return pair

    reached = 1
    while reached < width:
        step = min(reached, width - reached)
        values = _let(values, wider(step))
        reached += step
    return values


def _grams(ws: Column, n: int) -> Column:
    """Hash of the ``n`` words from each place on, made of the words' own hashes."""
    return _sliding(F.transform(ws, lambda w: F.xxhash64(w)), n, lambda a, b: F.xxhash64(a, b))


def fingerprints(ws: Column, k: int, window: int) -> Column:
    """(n, pos, hash) of the winnowed ``k``-grams; ``n`` is the window they stand for."""
    reach = window - k + 1

    def chosen(hashes: Column) -> Column:
        def picked(least: Column) -> Column:
            # The smallest hash moves on only where a window has another one, or has left it behind.
            def moved(at: Column) -> Column:
                before = F.get(least, at - 1)
                return (at == 0) | (F.get(least, at) != before) | (F.get(hashes, at - 1) == before)

            def place(at: Column) -> Column:
                return at + F.array_position(F.slice(hashes, at + 1, reach), F.get(least, at)).cast("int") - 1

            return F.array_distinct(F.transform(F.filter(_starts(F.size(least) - 1), moved), place))

        places = _let(_sliding(hashes, reach, lambda a, b: F.least(a, b)), picked)
        return F.transform(places, lambda at: F.struct(F.lit(window).alias("n"), at.alias("pos"), F.get(hashes, at).alias("hash")))

    return _let(_grams(ws, k), chosen)


def _marks(ws: Column, k: int, window: int, short: list[int]) -> Column:
    """Fingerprints for full windows, and every gram of the lengths that short items have."""

    def grams(n: int) -> Column:
        return F.transform(_grams(ws, n), lambda h, at: F.struct(F.lit(n).alias("n"), at.alias("pos"), h.alias("hash")))

    return F.concat(fingerprints(ws, k, window), *map(grams, short))


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, n, ws): the windows of each item, as arrays of words."""
    n = F.least(F.size("ws"), F.lit(window))
    cut = F.transform(_starts(F.size("ws") - n), lambda at: F.slice("ws", at + 1, n))
    return items.where(F.size("ws") > 0).select("item_id", n.alias("n"), F.explode(F.array_distinct(cut)).alias("ws"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(doc_id, n_words, hits, item_ids), one row for each row of ``docs``.

    ``hits`` has the half-open ranges (start, end) of document words that lie in an
    occurrence of an item's window, one for each occurrence, in order; ``item_ids`` the
    items with such windows. A window is ``window`` consecutive words of an item; an item
    of fewer words is one window, an item without words none. Null and empty texts have no
    words and no hits. Rows that repeat an id are told apart by their text. Items that
    repeat an id count once. Other columns are ignored.
    """
    items = benchmark.select("item_id", words(F.col("text")).alias("ws"))
    windows = stored(_item_windows(items, window), "item-windows")
    # At most window - 1 numbers.
    short = sorted(r["n"] for r in windows.where(F.col("n") < window).select("n").distinct().collect())
    # The windows are whole items here, or all that the full items' fingerprints come from.
    hashes = windows.select(F.explode(_let(F.col("ws"), lambda ws: _marks(ws, k, window, short))).alias("m"), "n")
    # Stored, so that its size is known where it is joined.
    wanted = stored(hashes.where("m.n = n").select("m.n", "m.hash").distinct(), "item-marks")
    texts = windows.select(F.array_join("ws", " ").alias("words")).distinct()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    marks = keyed.select("doc_id", "text_hash", F.inline(_let(words(F.col("text")), lambda ws: _marks(ws, k, window, short))))
    marked = stored(
        marks.join(wanted, ["n", "hash"], "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("n", "pos")).alias("marks")),
        "marked",
    )

    # Every window that holds a marked gram, compared with the items' windows as text.
    def around(mark: Column) -> Column:
        first = F.when(mark["n"] == window, F.greatest(mark["pos"] - (window - k), F.lit(0))).otherwise(mark["pos"])
        return F.transform(F.sequence(first, mark["pos"]), lambda at: F.struct(mark["n"].alias("n"), at.alias("pos")))

    def spelled(ws: Column, at: Column) -> Column:
        return F.struct(
            at["pos"].alias("pos"), at["n"].alias("n"), F.array_join(F.slice(ws, at["pos"] + 1, at["n"]), " ").alias("words")
        )

    def tried(ws: Column) -> Column:
        places = F.array_distinct(F.flatten(F.transform("marks", around)))
        inside = F.filter(places, lambda at: at["pos"] + at["n"] <= F.size(ws))
        return F.transform(inside, lambda at: spelled(ws, at))

    right = marked.select(F.col("doc_id").alias("_key"), F.col("text_hash").alias("_hash"), "marks")
    same = keyed["doc_id"].eqNullSafe(right["_key"]) & (keyed["text_hash"] == right["_hash"])
    open_docs = keyed.dropDuplicates(["doc_id", "text_hash"]).join(right, same)
    found = stored(
        open_docs.select("doc_id", "text_hash", F.inline(_let(words(F.col("text")), tried))).join(texts, "words", "left_semi"),
        "hit-windows",
    )
    ranges = found.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("n")).alias("end")))).alias("hits")
    )
    of_items = windows.select(F.array_join("ws", " ").alias("words"), "item_id").distinct()
    named = (
        found.select("doc_id", "text_hash", "words")
        .distinct()
        .join(of_items, "words")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("item_id").alias("item_ids"))
    )
    both = ranges.alias("r").join(
        named.alias("i"), F.col("r.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("r.text_hash") == F.col("i.text_hash"))
    )
    hit = both.select(F.col("r.doc_id").alias("_key"), F.col("r.text_hash").alias("_hash"), "hits", "item_ids")
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.size(words(F.col("text"))).cast("long").alias("n_words"),
    )
    return counted.join(
        hit, counted["doc_id"].eqNullSafe(hit["_key"]) & (counted["text_hash"] == hit["_hash"]), "left"
    ).select("doc_id", "n_words", "text_hash", "hits", "item_ids")


def hit_words(hits: Column) -> Column:
    """Number of words in the union of ranges; null: none."""

    def add(state: Column, part: Column) -> Column:
        fresh = F.greatest(part["end"] - F.greatest(part["start"], state["to"]), F.lit(0))
        return F.struct((state["n"] + fresh).alias("n"), F.greatest(state["to"], part["end"]).alias("to"))

    empty = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    return F.coalesce(F.aggregate(hits, empty, add, lambda s: s["n"]), F.lit(0)).cast("long")


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of an item."""
    found = contamination(docs, benchmark).where(F.col("hits").isNotNull())
    bad = stored(found.select(F.col("doc_id").alias("_key"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"))
    same = rows["row.doc_id"].cast("long").eqNullSafe(bad["_key"]) & (F.xxhash64(rows["row.text"]) == bad["_hash"])
    return rows.join(bad, same, "left_anti").select("row.*")
