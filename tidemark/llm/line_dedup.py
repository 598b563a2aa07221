"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a text are one window. A window that occurs more than
once in the corpus keeps its first place; at the others its lines are covered, and the
covered lines of a text are removed together. Lines may be cut at the ends of sentences first,
so that passages inside long lines, and in texts of one or two lines, are found as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

LINES = 3
#: A window with more than this part of all repeated places is joined apart from the others.
HOT_SHARE = 1000
#: Between the sentences of a line.
_SENTENCE_END = r"(?:(?<=[.!?][\x20\t])|(?<=[\u3002\uFF01\uFF1F]))(?![\x20\t]*+\z)"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _pieces(text: Column, sentences: bool) -> Column:
    """(line, text) of each line, or of each sentence with the space behind it."""

    def of_line(line: Column, at: Column) -> Column:
        cut = F.split(line, _SENTENCE_END, -1) if sentences else F.array(line)
        return F.transform(cut, lambda piece: F.struct(at.alias("line"), piece.alias("text")))

    return F.flatten(F.transform(_lines(text), of_line))


def _compared(text: Column, sentences: bool) -> Column:
    """The lines or sentences as windows compare them; space around a sentence does not matter."""
    if not sentences:
        return _lines(text)
    return F.transform(_pieces(text, True), lambda piece: F.regexp_replace(piece["text"], r"^[\x20\t]+|[\x20\t]+\z", ""))


def _joined(pieces: Column) -> Column:
    """The text of pieces, with a line feed where a piece is of another line than the one before."""

    def part(piece: Column, at: Column) -> Column:
        new_line = (at > 0) & (F.get(pieces, at - 1)["line"] != piece["line"])
        return F.concat(F.when(new_line, F.lit("\n")).otherwise(F.lit("")), piece["text"])

    return F.array_join(F.transform(pieces, part), "")


def _windows(lines: Column, size: int) -> Column:
    """(pos, h1, h2) of each window with a line that is not blank; two hashes, 128 bits."""

    def window(ls: Column, at: Column) -> Column:
        own = F.slice(ls, at + 1, size)
        return F.struct(at.alias("pos"), F.xxhash64(own).alias("h1"), F.xxhash64(F.lit(size), own, F.lit("\n")).alias("h2"))

    def all_windows(ls: Column) -> Column:
        last = F.size(ls) - size
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        filled = F.filter(starts, lambda at: F.trim(F.array_join(F.slice(ls, at + 1, size), "")) != "")
        return F.transform(filled, lambda at: window(ls, at))

    # Bound to a variable first, so that a text is split once and not once for each window.
    return F.flatten(F.transform(F.array(lines), all_windows))


def repeated_lines(docs: DataFrame, size: int = LINES, sentences: bool = False) -> DataFrame:
    """(doc_id, text_hash, starts): the windows of each document that occur earlier in the corpus."""
    keyed = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    windows = keyed.select("doc_id", "text_hash", F.inline(_windows(_compared(F.col("text"), sentences), size)))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "pos")
    # A common window is counted in each task before the shuffle.
    repeats = stored(
        windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "windows"
    )
    # Windows that hold more than one in HOT_SHARE of all repeated places are fewer than HOT_SHARE. Their
    # first places go to every task; their other places are spread, and meet nothing in the join.
    places = repeats.agg(F.sum("n")).head()[0] or 0
    hot = repeats.where(F.col("n") * HOT_SHARE > places).select("h1", "h2", F.col("first").alias("hot"))
    marked = windows.join(F.broadcast(hot), ["h1", "h2"], "left")
    own = F.xxhash64("doc_id", "text_hash", "pos")
    spread = marked.withColumns(
        {f"k{i}": F.when(F.col("hot").isNull(), F.col(f"h{i}")).otherwise(own + i) for i in (1, 2)}
    )
    rest = repeats.where(F.col("n") * HOT_SHARE <= places).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first")
    first = F.coalesce("hot", "first")
    later = spread.join(rest, ["k1", "k2"], "left").where(first.isNotNull() & (place != first))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("starts"))


def dedup_lines(docs: DataFrame, size: int = LINES, sentences: bool = False) -> DataFrame:
    """The rows of ``docs`` as ``row``, with the text left, ``n_lines`` and ``n_removed``.

    Columns: ``row`` (struct of all input columns, so that no name can clash), ``text``,
    ``n_lines`` (null text: 0) and ``n_removed``.

    A document has the lines between its line feeds. Windows lie at every line; the first
    place of a window is the one with the smallest doc_id (null ids last), then the smallest
    hash of the text, then the smallest position. Windows of blank lines only are left
    alone, and so are texts of fewer than ``size`` lines, null and empty texts. Rows that
    repeat both id and text count as one document and are treated alike.

    With ``sentences``, lines are cut behind every full stop, question or exclamation mark that
    a space follows, and all of the above, the counts too, is of these pieces. What stays of a
    line is joined as it was; a line of which nothing stays goes with its line feed.
    """
    repeats = repeated_lines(docs, size, sentences).select(
        F.col("doc_id").alias("_key"), F.col("text_hash").alias("_hash"), F.col("starts").alias("_starts")
    )
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(
        repeats,
        rows["row.doc_id"].cast("long").eqNullSafe(repeats["_key"]) & (F.xxhash64(rows["row.text"]) == repeats["_hash"]),
        "left",
    )
    text = F.col("row.text")

    def left(ls: Column) -> Column:
        covered = F.array_distinct(
            F.flatten(F.transform(F.col("_starts"), lambda at: F.transform(F.lit(list(range(size))), lambda k: at + k)))
        )
        kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), covered), lambda at: F.get(ls, at))
        # Bound to a variable, so that the pieces are picked once and not once for each of them.
        return F.transform(F.array(kept), lambda k: F.struct(_joined(k).alias("text"), F.size(k).alias("n")))[0]

    lines = _pieces(text, sentences)
    n = F.coalesce(F.size(lines), F.lit(0))
    out = F.when(F.col("_starts").isNotNull(), F.transform(F.array(lines), left)[0])
    return joined.select("row", out.alias("_left"), n.cast("long").alias("n_lines")).select(
        "row",
        F.when(F.col("_left").isNotNull(), F.col("_left.text")).otherwise(text).alias("text"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.col("n_lines") - F.col("_left.n"), F.lit(0)).cast("long").alias("n_removed"),
    )
