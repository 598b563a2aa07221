"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

__all__ = [
    "TOKENIZERS", "ascii_lower", "byte_letters", "documents", "groups_of_texts", "place_counts", "slices", "stored", "summed", "table",
]

#: Folder of the public vocabulary files; every operator takes it as a parameter.
TOKENIZERS = "/opt/tokenizers"

_UPPER = "".join(map(chr, range(65, 91)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other letter alone."""
    return F.translate(text, _UPPER, _UPPER.lower())


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes for themselves, the rest from U+0100 on."""
    letters, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


def groups_of_texts(batches: Iterator[pa.RecordBatch], chars: int = 2_000_000) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of Arrow batches (doc_id, text) in groups of about ``chars`` characters.

    A null text counts as empty. A text longer than ``chars`` is a group of its own, whole.
    """
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            value = text.as_py() or ""
            if texts and size + len(value) > chars:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(value)
            size += len(value)
    if texts:
        yield ids, texts


# --- fixed-size counters over all rows ------------------------------------------------
#
# Each task counts into an array of its own and hands on slices of it. Tasks that have all
# parts of a slice add them as they come, so no task and not the driver holds more than one array.

SLICE = 4096


def slices(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A counter array (a multiple of ``SLICE`` long) as (slice, counts), empty slices left out."""
    parts = counts.astype("<i8").reshape(-1, SLICE)
    for at in np.flatnonzero(parts.any(axis=1)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(at)], pa.int32()), pa.array([parts[at].tobytes()], pa.binary())], names=["slice", "counts"]
        )


def place_counts(batches: Iterator[np.ndarray], size: int) -> np.ndarray:
    """How often each place below ``size`` comes."""
    counts = np.zeros(size, dtype=np.int64)
    waiting: list[np.ndarray] = []
    held = 0
    for places in batches:
        waiting.append(places)
        held += len(places)
        if held > 1_000_000:
            counts += np.bincount(np.concatenate(waiting), minlength=size)
            waiting, held = [], 0
    if waiting:
        counts += np.bincount(np.concatenate(waiting), minlength=size)
    return counts


def summed(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int, either: bool = False) -> np.ndarray:
    """The sum (or bitwise or) of the arrays that ``count`` makes of the batches of each task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from slices(count(batches))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(raw.as_py(), dtype="<i8")
                sums[at] = part if at not in sums else sums[at] | part if either else sums[at] + part
        for at, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "counts"]
            )

    schema = "slice int, counts binary"
    out = np.zeros((size // SLICE, SLICE), dtype=np.int64)
    for row in rows.mapInArrow(cut, schema).repartition("slice").mapInArrow(add, schema).collect():
        out[row["slice"]] = np.frombuffer(row["counts"], dtype="<i8")
    return out.ravel()
