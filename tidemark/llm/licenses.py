"""License scans: phrases, and an exact set-similarity join of text blocks with license notices.

A block is a line, or a paragraph of several lines. It matches a notice when it holds at
least the given share of the notice's distinct words (containment). Words are ordered by
how many blocks of the corpus have them, the rarest first. A block that reaches the
threshold has enough of the notice's words (length filter), one of the first of them
(prefix filter), and enough left after the first common one (positional filter); what
passes is compared in full.

Notices of different licenses share most of their words, so a match also tells whether the
block names the license: whether the words that are the notice's mark stand in it one after
another, outside the mark of another license that holds them ("by nc" in "by nc sa").
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, groups_of_texts, stored, summed

CONTAINMENT_PERCENT = 80

# Words, phrases and their labels.
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = (
    (("gnu", "general", "public", "license"), "gpl"),
    (("apache", "license"), "apache"),
    (("cc", "by"), "cc-by"),
    (("mit", "license"), "mit"),
)

# Label, wording and mark of common notices.
NOTICES = (
    ("agpl", "GNU Affero General Public License as published by the Free Software Foundation", "gnu affero general public license"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "gnu affero general public license"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "apache license"),
    ("bsd", "Released under the BSD License", "bsd license"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "source and binary forms"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "by nc"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0", "by nc nd"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0", "by nc sa"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "by nd"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "by sa"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "related or neighboring rights"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License", "eclipse public license"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3", "gnu general public license"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gnu general public license"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("lgpl", "redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "gnu lesser general public license"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gnu lesser general public license"),
    ("mit-notice", "Released under the MIT License", "mit license"),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "free of charge"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered software"),
)


def words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


def _needed(size: int, percent: int) -> int:
    return -(-size * percent // 100)


class Notices:
    """The notices' words by rank; ``counts`` has how many blocks hold each word."""

    def __init__(self, notices: tuple[tuple[str, str, str], ...], percent: int):
        self.labels = [label for label, _, _ in notices]
        self.sets = [sorted(set(words(text))) for _, text, _ in notices]
        self.marks = [tuple(words(mark)) for _, _, mark in notices]
        if not all(self.sets) or not all(self.marks):
            raise ValueError("a notice or its mark has no words")
        self.vocabulary = {w: at for at, w in enumerate(sorted({w for s in self.sets for w in s}))}
        self.percent = percent
        self.fewest = min(_needed(len(s), percent) for s in self.sets)

    def order(self, counts: np.ndarray) -> None:
        """Give every word its rank, rare words first."""
        ranks = np.argsort(np.argsort(counts[: len(self.vocabulary)], kind="stable"))
        self.rank = {w: int(ranks[at]) for w, at in self.vocabulary.items()}
        self.ranked = [sorted(self.rank[w] for w in s) for s in self.sets]
        self.first = {r for s in self.ranked for r in s[: len(s) - _needed(len(s), self.percent) + 1]}

    def index(self, spark: SparkSession) -> DataFrame:
        """(notice, label, mark, ranks, needed, pos, word): the prefix of each notice; as small as the list of notices."""
        rows = []
        for at, (label, mark, ranks) in enumerate(zip(self.labels, self.marks, self.ranked, strict=True)):
            needed = _needed(len(ranks), self.percent)
            spelled = " ".join(mark)
            rows += [(at, label, spelled, ranks, needed, pos, word) for pos, word in enumerate(ranks[: len(ranks) - needed + 1])]
        return spark.createDataFrame(
            rows, "notice int, label string, mark string, ranks array<int>, needed int, pos int, word int"
        )

    def named(self, ws: list[str]) -> list[str]:
        """The marks that stand in a block of words, but for places inside another mark's place."""
        found = sorted(
            (at, -len(mark), mark) for mark in set(self.marks) for at in _places(ws, mark)
        )
        seen, end = set(), 0
        for at, length, mark in found:
            if at - length > end:
                seen.add(" ".join(mark))
                end = at - length
        return sorted(seen)


def _blocks(found: list[list[str]], blank: list[bool]) -> Iterator[tuple[set[str], int, int]]:
    """Word sets of the lines, and of the paragraphs of several lines, each with its first line and the one after its last."""
    start = 0
    for at, empty in enumerate([*blank, True]):
        if not empty:
            yield set(found[at]), at, at + 1
            continue
        if at - start > 1:
            yield set().union(*found[start:at]), start, at
        start = at + 1


def _places(ws: list[str], phrase: tuple[str, ...]) -> Iterator[int]:
    at = -1
    for _ in range(ws.count(phrase[0])):
        at = ws.index(phrase[0], at + 1)
        if tuple(ws[at : at + len(phrase)]) == phrase:
            yield at


def _phrases(ws: list[str]) -> list[tuple[int, str]]:
    """(place, label) of each phrase, by place."""
    return sorted((at, label) for phrase, label in PHRASES for at in _places(ws, phrase))


def _lines(text: str) -> tuple[list[list[str]], list[bool]]:
    """The words of each line, and whether the line is blank."""
    lines = text.split("\n")
    return [words(line) for line in lines], [not line.strip() for line in lines]


def license_scan(
    docs: DataFrame,
    notices: tuple[tuple[str, str, str], ...] = NOTICES,
    percent: int = CONTAINMENT_PERCENT,
) -> DataFrame:
    """(doc_id, text_hash, n_words, phrases, matches), one row for each row of ``docs``.

    ``phrases`` has (place, label) of every fixed phrase, in order of place (a word's number
    from 0). ``matches`` has (label, block, containment, named) of each block that holds at
    least ``percent`` of a notice's words: lines and paragraphs are numbered together, in
    order. ``named`` tells whether the notice's mark stands in the block; a block that is
    not named has the wording but most likely another license.
    A null or empty text has no words and no matches; null ids and repeated rows stay as
    they are, and equal rows are treated alike. Other columns are ignored. An empty table
    gives no rows.

    Word frequencies are counted over all blocks; the driver receives a number for each
    word of the notices.
    """
    spark = docs.sparkSession
    known = Notices(notices, percent)
    room = -(-len(known.vocabulary) // SLICE) * SLICE

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = [0] * room
        place = known.vocabulary
        for _, texts in groups_of_texts(batches):
            for text in texts:
                lines, blank = _lines(text)
                for block, _, _ in _blocks([[w for w in line if w in place] for line in lines], blank):
                    for word in block:
                        counts[place[word]] += 1
        return np.array(counts)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known.order(summed(texts, count, room))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrase = pa.struct([("place", pa.int64()), ("label", pa.string())])
        block_type = pa.struct([("block", pa.int32()), ("words", pa.list_(pa.int32())), ("marks", pa.list_(pa.string()))])
        rank, first, fewest = known.rank, known.first, known.fewest
        for batch in batches:
            keys, hashes = batch.column(0), batch.column(2)
            n, phrases, blocks = [], [], []
            for value in batch.column(1):
                lines, blank = _lines(value.as_py() or "")
                ws = [w for line in lines for w in line]
                n.append(len(ws))
                phrases.append([{"place": at, "label": label} for at, label in _phrases(ws)])
                kept = []
                found = _blocks([[w for w in line if w in rank] for line in lines], blank)
                for at, (block, start, end) in enumerate(found):
                    if len(block) >= fewest:
                        ranks = sorted(map(rank.__getitem__, block))
                        if not first.isdisjoint(ranks):
                            marks = known.named([w for line in lines[start:end] for w in line])
                            kept.append({"block": at, "words": ranks, "marks": marks})
                blocks.append(kept)
            yield pa.RecordBatch.from_arrays(
                [keys, hashes, pa.array(n, pa.int64()), pa.array(phrases, pa.list_(phrase)), pa.array(blocks, pa.list_(block_type))],
                names=["doc_id", "text_hash", "n_words", "phrases", "blocks"],
            )

    schema = (
        "doc_id long, text_hash long, n_words long, phrases array<struct<place: bigint, label: string>>, "
        "blocks array<struct<block: int, words: array<int>, marks: array<string>>>"
    )
    scanned = stored(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(scan, schema), "license-blocks")

    opened = scanned.where(F.size("blocks") > 0).select("doc_id", "text_hash", F.inline("blocks"))
    entries = opened.select("doc_id", "text_hash", "block", "words", "marks", F.posexplode("words").alias("at", "word"))
    index = known.index(spark)
    # The first common word alone decides: what either side holds before it is not shared.
    rest = F.least(F.size("words") - F.col("at"), F.size("ranks") - F.col("pos"))
    candidates = entries.join(index, "word").where((F.size("words") >= F.col("needed")) & (rest >= F.col("needed")))
    shared = F.size(F.array_intersect("words", "ranks"))
    matches = (
        candidates.where(shared >= F.col("needed"))
        .select(
            "doc_id", "text_hash", "label", "block", (shared / F.size("ranks")).alias("containment"),
            F.array_contains("marks", F.col("mark")).alias("named"),
        )
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.struct("label", "block", "containment", "named"))).alias("matches"))
        .select(F.col("doc_id").alias("_key"), F.col("text_hash").alias("_hash"), "matches")
    )
    same = scanned["doc_id"].eqNullSafe(matches["_key"]) & (scanned["text_hash"] == matches["_hash"])
    none = F.array().cast("array<struct<label: string, block: int, containment: double, named: boolean>>")
    return scanned.join(matches, same, "left").select(
        "doc_id", "text_hash", "n_words", "phrases", F.coalesce("matches", none).alias("matches")
    )
