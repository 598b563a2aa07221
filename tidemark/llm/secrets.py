"""Secret scans: fixed patterns, and strings that look random to character Markov models.

Two models of character pairs are trained on labelled samples of the whole corpus: the
values that the fixed patterns find are samples of random strings, all other runs of
identifier characters are samples of ordinary ones. Secrets that no pattern finds lie among
these at first; the runs that the first models find are left out of the sample when the
models are counted again. A run that no pattern found is a secret when the log-likelihood
ratio of the two models says so, unless it is part of an email address: its whole ratio must outweigh how rare secrets are among
runs, whatever characters it is made of. So the ratio asked for, a character, rises as runs
get shorter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, groups_of_texts, summed

KINDS = ("assign", "access", "hex", "random")
#: Log-likelihood ratio, in nats a character, from which a long run counts as random.
RATIO = 1.3
#: The least ratio of a whole run, in nats: one secret among e^26 runs would stand out.
WHOLE = 26.0
#: How often the models are counted, each time without the runs that the models before found.
ROUNDS = 2
#: Every pair's share of a sample that stands for a model before it has seen anything.
PRIOR = 2.0

# Patterns, and the shortest value each accepts.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Names in email addresses may be random and are no secrets; what a colon precedes ("user:value@host") may be one.
_EMAIL = re.compile(rb"(?<![A-Za-z0-9._%+:-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_HINTS = ("passw", "secret", "token", "api")
_SHORTEST_VALUE, _SHORTEST_ACCESS = 8, 16

_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Class 0 stands for any other character, and so for both ends of a run.
CLASSES = len(_LETTERS) + 1
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[list(_LETTERS.encode())] = np.arange(1, CLASSES)
#: Both models' pair counts behind one another, in whole slices.
_ROOM = -(-CLASSES * CLASSES // SLICE) * SLICE


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the fixed patterns' matches."""
    found = []
    lower = text.lower()
    if any(hint in lower for hint in _HINTS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= _SHORTEST_VALUE:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _SHORTEST_ACCESS]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def _bytes_at(text: str, place: int) -> int:
    return len(text[:place].encode("utf-8", "surrogatepass"))


def _apart(text: str, spans: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Character classes of a text with its spans and email addresses blanked out, and those of the spans' values."""
    raw = text.encode("utf-8", "surrogatepass")
    classes = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    emails = [m.span() for m in _EMAIL.finditer(raw)] if b"@" in raw else []
    values = []
    places = [(_bytes_at(text, a), _bytes_at(text, v), _bytes_at(text, b)) for a, _, b, v in spans]
    for _, value, end in places:
        values.append(classes[value:end].copy())
    for start, end in [(start, end) for start, _, end in places] + emails:
        classes[start:end] = 0
    return classes, values


def _pairs(classes: np.ndarray) -> np.ndarray:
    ends = np.concatenate(([0], classes, [0]))
    codes = ends[:-1] * CLASSES + ends[1:]
    return codes[codes > 0]


def pair_counts(docs: DataFrame, found: Callable[[np.ndarray], list] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Character pairs of all documents' random and ordinary strings; two tables of fixed size.

    The runs that ``found`` picks from a text's character classes are samples of neither.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros(2 * _ROOM, dtype=np.int64)
        for _, texts in groups_of_texts(batches):
            ordinary: list[np.ndarray] = []
            for text in texts:
                classes, values = _apart(text, base_spans(text))
                for start, end in found(classes) if found else ():
                    classes[start:end] = 0
                ordinary += [classes, np.zeros(1, dtype=np.int64)]
                for value in values:
                    counts[:_ROOM] += np.bincount(_pairs(value), minlength=_ROOM)
            counts[_ROOM:] += np.bincount(_pairs(np.concatenate(ordinary)), minlength=_ROOM)
        return counts

    counts = summed(docs.select(F.col("doc_id").cast("long"), "text"), count, 2 * _ROOM)
    table = lambda part: part[: CLASSES * CLASSES].reshape(CLASSES, CLASSES)
    return table(counts[:_ROOM]), table(counts[_ROOM:])


def log_ratios(random: np.ndarray, ordinary: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log-likelihood ratio of each character pair.

    Random strings are taken as even draws until samples say otherwise: the prior is worth
    as much as the sample, so that alphabets no sample showed are not ruled out. Ordinary
    strings are taken to follow the frequencies of single characters until then.
    """

    def shares(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return (counts + weight) / (counts + weight).sum(axis=1, keepdims=True)

    seen = random.sum(axis=1, keepdims=True)
    even = np.maximum(seen / CLASSES, prior) * np.ones_like(random, dtype=float)
    single = (ordinary.sum(axis=0) + 1) / (ordinary.sum() + CLASSES)
    return np.log(shares(random, even)) - np.log(shares(ordinary, prior * CLASSES * single * np.ones_like(ordinary, dtype=float)))


def _in_code_points(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places of runs, which are ASCII, from bytes to code points."""
    starts = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    return [(int(starts[a]) - 1, int(starts[a]) - 1 + b - a) for a, b in runs]


def random_runs(classes: np.ndarray, ratios: np.ndarray, ratio: float, whole: float) -> list[tuple[int, int]]:
    """Runs of identifier characters that look random: (start, end) in bytes.

    A run's ratio is the sum over the pairs inside it.
    """
    inside = np.concatenate(([False], classes > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    # A run of one character has no pair, and one pair never weighs enough.
    edges = edges[edges[:, 1] - edges[:, 0] > 2]
    if not len(edges):
        return []
    so_far = np.concatenate(([0.0], np.cumsum(ratios[classes[:-1], classes[1:]])))
    total = so_far[edges[:, 1] - 1] - so_far[edges[:, 0]]
    least = np.maximum(whole, ratio * (edges[:, 1] - edges[:, 0]))
    return [(a, b) for a, b in edges[total >= least].tolist()]


def secret_spans(docs: DataFrame, ratio: float = RATIO, whole: float = WHOLE, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base, added), one row for each row of ``docs``.

    ``base`` and ``added`` are arrays of (start, kind, end) in code points, end exclusive, in
    order of start and kind; ``kind`` is an index into ``KINDS``. ``base`` has the matches of
    the fixed patterns, ``added`` the runs that the models find beside them: those whose
    log-likelihood ratio is at least ``whole`` and at least ``ratio`` a character. A null or empty
    text has none. Null and repeated ids stay as they are; other columns are ignored. An
    empty table gives no rows.

    The models are counted over all documents; they and nothing else reach the driver.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ratios = log_ratios(*pair_counts(texts))
    for _ in range(rounds - 1):
        ratios = log_ratios(*pair_counts(texts, partial(random_runs, ratios=ratios, ratio=ratio, whole=whole)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        for ids, group in groups_of_texts(batches):
            base, added = [], []
            for text in group:
                spans = base_spans(text)
                classes, _ = _apart(text, spans)
                runs = random_runs(classes, ratios, ratio, whole)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b, _ in spans])
                if runs:
                    raw = text.encode("utf-8", "surrogatepass")
                    runs = _in_code_points(raw, runs)
                added.append([{"start": a, "kind": 3, "end": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(base, pa.list_(span)), pa.array(added, pa.list_(span))],
                names=["doc_id", "base", "added"],
            )

    spans = "array<struct<start: bigint, kind: int, end: bigint>>"
    return texts.mapInArrow(scan, f"doc_id long, base {spans}, added {spans}")
