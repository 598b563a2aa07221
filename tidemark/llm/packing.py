"""Packing of documents into token sequences by shortest-pack-first over the length histogram.

1. Tasks tokenise the documents and cut them into pieces of at most ``capacity`` ids.
2. The histogram of piece lengths (at most ``capacity`` rows, whatever the corpus) goes to
   the driver. There lengths are placed from the longest down, each into the shortest pack
   that has room; packs of the same content are one pattern with a count.
3. Each piece gets its rank among the pieces of its length, counted in parallel; the rank
   says which copy of which pattern, and which place in it, the piece takes.
"""

from __future__ import annotations

import gc
import heapq
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import TOKENIZERS, byte_letters, groups_of_texts, stored

CAPACITY = 4096
END_ID = 2
#: Parts in which the pieces of one length are ranked side by side.
RANK_PARTS = 1024
#: Chunks whose ids a worker remembers; the memory is emptied beyond that.
REMEMBERED = 1_000_000
REMEMBERED_CHARS = 64

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
# Separators that Python takes for white space and the vocabulary does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
# Fixed value: the vocabulary's pre-tokens, in lower case.
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Below it, letters are composed and have one lower case, so that no normaliser changes more.
_PLAIN = "\u0130"


class Encoder:
    """Ids of texts as bytes (little-endian, 32 bits each).

    The vocabulary drops white space before it merges, and no merge crosses a pre-token. So a
    text is encoded chunk by chunk, a new chunk pre-token by pre-token, and the library
    merges each new pre-token once. Chunks with letters that need normalising go to the
    library whole, and so do texts that may spell a special token.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.letters = byte_letters()

    def library(self, text: str) -> bytes:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array("I", found.ids).tobytes()

    def merged(self, word: str) -> bytes:
        """Ids of one pre-token in lower case."""
        spelled = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def learn(self, chunks: set[str]) -> None:
        words, known = self.words, self.known
        for chunk in chunks:
            if max(chunk) < _PLAIN:
                found = []
                for word in _PRETOKEN.findall(chunk.lower()):
                    ids = words.get(word)
                    if ids is None:
                        ids = words[word] = self.merged(word)
                    found.append(ids)
                known[chunk] = b"".join(found)
            else:
                known[chunk] = self.library(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. No cycles arise here, so the collector need not look for any meanwhile."""
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [[] if "<|" in t else _SPACE.split(t.strip(" \t\n\r\f\v")) if _NOT_SPACE.search(t) else t.split() for t in texts]
        fresh: set[str] = set()
        for chunks in split:
            fresh.update(chunks)
        fresh.discard("")
        fresh.difference_update(self.known)
        self.learn(fresh)
        self.known[""] = b""
        out = [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]
        for at, text in enumerate(texts):
            if "<|" in text:
                out[at] = self.library(text)
        for chunk in fresh:
            if len(chunk) > REMEMBERED_CHARS:
                del self.known[chunk]
        if len(self.known) > self.remembered:
            self.known.clear()
        if len(self.words) > self.remembered:
            self.words.clear()
        return out


@lru_cache(maxsize=1)
def _encoder(path: str, remembered: int) -> Encoder:
    return Encoder(path, remembered)


class Pattern(NamedTuple):
    """``count`` packs, each holding ``times`` pieces of each ``length``, in this order."""

    count: int
    slots: tuple[tuple[int, int], ...]


def _with(slots: tuple[tuple[int, int], ...], length: int, times: int = 1) -> tuple[tuple[int, int], ...]:
    if slots and slots[-1][0] == length:
        return (*slots[:-1], (length, slots[-1][1] + times))
    return (*slots, (length, times))


def shortest_pack_first(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece of the histogram (length to count).

    Equal packs are handled together, so the work follows the number of lengths and not the
    number of pieces. A piece that finds no pack with room opens one; equal pieces fill the
    new pack while they fit, since it then is the shortest.
    """
    packs: dict[int, list[Pattern]] = defaultdict(list)  # by free room
    rooms: list[int] = []  # the rooms that have packs, largest first, negated

    def put(room: int, pattern: Pattern) -> None:
        if not packs[room]:
            heapq.heappush(rooms, -room)
        packs[room].append(pattern)

    for length in sorted(histogram, reverse=True):
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} is not between 1 and {capacity}")
        left = histogram[length]
        while left and rooms and -rooms[0] >= length:
            room = -rooms[0]
            pattern = packs[room].pop()
            if not packs[room]:
                heapq.heappop(rooms)
            # How many of these pieces each pack takes while it stays the shortest.
            next_room = max(-rooms[0] if rooms else 0, 0)
            times = max(1, min(room // length, (room - next_room) // length + 1, left // pattern.count))
            used = min(pattern.count, left)
            if used < pattern.count:
                put(room, pattern._replace(count=pattern.count - used))
            put(room - length * times, Pattern(used, _with(pattern.slots, length, times)))
            left -= used * times
        each = capacity // length
        if left >= each:
            put(capacity - each * length, Pattern(left // each, ((length, each),)))
        if left % each:
            put(capacity - left % each * length, Pattern(1, ((length, left % each),)))
    return [p for found in packs.values() for p in found]


def places(patterns: list[Pattern], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """One row for each run of ranks of a length that one place of a pattern takes.

    ``key`` is the length and the run's first rank in one number, ascending.
    """
    rows, first, next_rank = [], 0, defaultdict(int)
    for count, slots in patterns:
        offset = 0
        for length, times in slots:
            rows.append((length, next_rank[length], first, offset, times))
            next_rank[length] += count * times
            offset += length * times
        first += count
    rows.sort()
    columns = np.array(rows or np.zeros((0, 5)), dtype=np.int64).T
    length, rank, sequence, offset, times = columns
    return {"key": length << 48 | rank, "rank": rank, "sequence": sequence, "offset": offset, "times": times}


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool, remembered: int = REMEMBERED
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every document's pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, remembered)
        end = np.array([end_id], dtype="<u4").tobytes()
        for doc_ids, texts in groups_of_texts(batches):
            rows, blocks = [], []
            for doc_id, raw in zip(doc_ids, encoder.encode(texts), strict=True):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, capacity):
                    block = raw[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(block) // 4, zlib.crc32(block), total))
                    if with_ids:
                        blocks.append(block)
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                bounds = np.cumsum([0, *(len(b) // 4 for b in blocks)]).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(blocks), dtype="<u4").astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(bounds), ids))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def ranked(found: DataFrame, parts: int = RANK_PARTS) -> DataFrame:
    """The pieces with ``_rank``, 0 and up without gaps among those of the same length.

    Pieces of one length are ranked in ``parts`` parts at once, so that a length that very
    many pieces have is not one task's work.
    """
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)).cast("int")
    split = found.withColumn("_part", part)
    counts = split.groupBy("length", "_part").count()
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_part").orderBy("doc_id", "start")
    numbered = split.withColumn("_in_part", F.row_number().over(inside) - 1)
    joined = numbered.join(offsets, ["length", "_part"])
    return joined.withColumn("_rank", F.col("_before") + F.col("_in_part")).drop("_part", "_before", "_in_part")


def _placed(table: dict[str, np.ndarray]):
    """A column function: length and rank to the sequence and the offset in it."""

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(table["key"], n << 48 | r, side="right") - 1
        copy, turn = np.divmod(r - table["rank"][at], table["times"][at])
        return pd.DataFrame({"sequence_id": table["sequence"][at] + copy, "offset": table["offset"][at] + turn * n})

    return place


def pack(
    docs: DataFrame,
    tokenizer: str = f"{TOKENIZERS}/word_bpe_49k.json",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), a row for each piece.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Longer
    documents are cut every ``capacity`` ids. Every id lies in exactly one piece, and the
    pieces of a sequence follow one another from offset 0 without gaps. Null and repeated
    doc_ids are packed like any other row; other columns are ignored. No documents give no
    rows. ``with_ids`` adds the ids of each piece. ``remembered`` bounds the chunks and words
    whose ids a worker keeps at hand (about 200 bytes each), nothing else.

    The driver sees the histogram and its patterns: at most ``capacity`` lengths, and no more
    patterns than a small multiple of that.
    """
    found = stored(pieces(docs, tokenizer, capacity, end_id, with_ids, remembered), "pieces")
    histogram = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    table = places(shortest_pack_first(histogram, capacity), capacity)
    placed = ranked(found).withColumn("_place", _placed(table)(F.col("length"), F.col("_rank")))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "_place.sequence_id", "_place.offset",
        *(["ids"] if with_ids else []),
    )


def padding(packed: DataFrame, capacity: int = CAPACITY) -> Column:
    """Aggregate: share of padding when each sequence is filled up to ``capacity``."""
    return 1 - F.sum("length") / (F.count_distinct("sequence_id") * capacity)
