"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

Texts are split into pre-tokens. The distinct pre-tokens of a batch lie behind one
another in one flat array of symbols (a ragged array: symbols, and the pre-token each
belongs to). In every round each pre-token applies its own pair of lowest rank, at all
its places at once; pre-tokens without a mergeable pair leave the array, and the symbols
they still hold are their token count. A merged symbol only takes part in pairs of higher
rank, so this gives what merging pair by pair gives.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TOKENIZERS, byte_letters, groups_of_texts

TOKEN_LIMIT = 1024
#: Pre-tokens whose counts a worker remembers; the memory is emptied beyond that.
REMEMBERED = 500_000
#: Longer pre-tokens are counted each time and not remembered.
REMEMBERED_CHARS = 64
#: Bytes of pre-tokens merged together.
ARRAY_BYTES = 1 << 20

_NONE = np.iinfo(np.int64).max

# Fixed value: the vocabulary's pre-token pattern, with white space spelled as its Unicode property.
_PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Letters, marks and signs that every Unicode version classes alike; other texts are split by the library.
_SETTLED = regex.compile(r"[\x00-ɏ‐-‧‰-⁞]*")


class Merges:
    """The merge table of a vocabulary file as sorted arrays, and the counting over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, pairs = spec["model"]["vocab"], spec["model"]["merges"]
        self.size = max(vocab.values()) + 1
        letters = byte_letters()
        self.byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self.symbols = np.array([vocab[letter] for letter in letters], dtype=np.int64)
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.special = [t["content"] for t in spec["added_tokens"]]

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word after all merges."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        counts = lengths.copy()
        symbols = self.symbols[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        while len(symbols) > 1:
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = (self.keys[at] == keys) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.ranks[at], _NONE), _NONE)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word))))
            chosen = (rank == best) & (rank != _NONE)
            # Where places overlap (a a a), they are taken from the left, every second one of a run.
            index = np.arange(len(chosen))
            run_start = np.maximum.accumulate(np.where(chosen & ~np.append(False, chosen[:-1]), index, 0))
            chosen &= (index - run_start) % 2 == 0
            first = np.flatnonzero(chosen)
            symbols[first] = self.merged[at[first]]
            counts -= np.bincount(word[first], minlength=len(counts))
            keep = best != _NONE
            keep[first + 1] = False
            symbols, word = symbols[keep], word[keep]
        return counts


class Counter:
    """Counts tokens of texts; remembers pre-tokens within a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.merges = Merges(path)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.pattern = regex.compile(_PRETOKEN)
        specials = "|".join(regex.escape(s) for s in sorted(self.merges.special, key=len, reverse=True))
        self.special = regex.compile(specials) if specials else None
        self.known: dict[str, int] = {}

    def pretokens(self, text: str) -> list[str]:
        if _SETTLED.fullmatch(text):
            return self.pattern.findall(text)
        byte_of = self.merges.byte_of
        pieces = (bytes(byte_of[c] for c in piece) for piece, _ in self.splitter.pre_tokenize_str(text))
        return [piece.decode("utf-8", "surrogateescape") for piece in pieces]

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special tokens it spells out."""
        if self.special is None or "<|" not in text:
            return self.pretokens(text), 0
        parts = self.special.split(text)
        return list(chain.from_iterable(map(self.pretokens, parts))), len(parts) - 1

    def learn(self, words: Iterable[str]) -> None:
        waiting: list[str] = []
        size = 0
        for word in chain(words, [None]):
            if waiting and (word is None or size > ARRAY_BYTES):
                raw = [w.encode("utf-8", "surrogateescape") for w in waiting]
                self.known.update(zip(waiting, self.merges.count(raw).tolist(), strict=True))
                waiting, size = [], 0
            if word is not None:
                waiting.append(word)
                size += len(word)

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.split(text) for text in texts]
        fresh: set[str] = set()
        for words, _ in split:
            fresh.update(words)
        fresh.difference_update(self.known)
        self.learn(fresh)
        out = [sum(map(self.known.__getitem__, words)) + special for words, special in split]
        for word in fresh:
            if len(word) > REMEMBERED_CHARS:
                del self.known[word]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return out


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def token_counts(
    docs: DataFrame,
    tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.json",
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each input row.

    A null or empty text has no bytes and no tokens. Null and repeated ids stay as they
    are; other columns are ignored. The strings of special tokens inside a text are one
    token each, as the library has it by default. ``tokenizer`` names the vocabulary file,
    which every executor must see. A pre-token of many thousand letters without a break
    takes a round for each distinct pair that it merges.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for ids, texts in groups_of_texts(batches):
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counter.counts(texts), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
