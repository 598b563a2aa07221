"""Zipped CSV scan.

Spark has no zip codec, so this is one of two places where Python touches rows. The
archives' central directories are read first; then one task streams one member: the
archive is opened in place at the member, which is decompressed and parsed piece by piece.
No archive is ever held in memory or sent through Arrow.
"""

from __future__ import annotations

import codecs
import csv
import io
import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contracts
from tidemark.session import stored
from tidemark.sources.paths import open_file

ROWS_PER_BATCH = 20_000
# With more members than this, tasks take several one after the other.
MOST_TASKS = 10_000
# A member of at most so many bytes is unpacked once and held until its check sum is known;
# a larger one is unpacked once for the check sum and once more for its rows.
HELD_BYTES = 64 << 20


def bike_archive_rows(archives: DataFrame, path: str = "path") -> DataFrame:
    """Rows of the archives in ``path`` under the old bike layout, all text.

    Adds ``_archive``, ``_member`` and ``_layout``: ``old`` or ``new`` for rows, and for an
    archive or member that yields none one row saying ``not a zip``, ``no csv``, ``header``
    or ``damaged``.
    """
    return zipped_csv(
        archives, path, contracts.BIKE_OLD_COLUMNS,
        contracts.BIKE_NEW_TO_OLD, contracts.BIKE_NEW_MARKER,
    )


def zipped_csv(
    archives: DataFrame, path: str, columns: tuple[str, ...],
    renamed: dict[str, str] | None = None, marker: str | None = None,
) -> DataFrame:
    """Read every CSV member of every archive under a header contract.

    A header equal to ``columns``, in order, is taken as it is. Otherwise, if it has
    the ``marker`` column, ``renamed`` (contract column -> file column) applies. Any
    other header rejects the member. Empty text is NULL. A member whose bytes are damaged
    gives no rows at all.
    """
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in (*columns, "_archive", "_member", "_layout")]
    )
    batch_rows, held = ROWS_PER_BATCH, HELD_BYTES
    mapping = dict(renamed or {})

    def read(batches):
        import zipfile
        import zlib

        import pyarrow as pa

        damage = (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError, OSError, pa.ArrowInvalid)

        def batch(data, origin, layout, count):
            texts = [pa.array(values, pa.string()) for values in data]
            texts += [pa.array([x] * count, pa.string()) for x in (*origin, layout)]
            return pa.RecordBatch.from_arrays(texts, names=schema.names)

        def rejected(origin, reason):
            return batch([[None]] * len(columns), origin, reason, 1)

        def layout_of(header):
            if tuple(header) == columns:
                return "old", list(columns)
            if marker is not None and marker in header:
                return "new", [mapping.get(c) for c in columns]
            return "header", []

        def parsed(pack, archive, name):
            """Batches of a member, as they come; damage shows at the latest when its end is read."""
            with pack.open(name) as member:
                header, chunks = _csv_columns(member, batch_rows)
                layout, wanted = layout_of(header)
                if layout == "header":
                    _verify(pack, name)
                    yield rejected((archive, name), layout)
                    return
                # A repeated header name means its last column.
                place = {h: at for at, h in enumerate(header)}
                for count, found in chunks:
                    picked = [
                        found[place[w]] if w in place and place[w] < len(found) else [None] * count
                        for w in wanted
                    ]
                    yield batch(picked, (archive, name), layout, count)

        for incoming in batches:
            for archive, name, size, problem in zip(*(c.to_pylist() for c in incoming.columns), strict=True):
                if problem:
                    yield rejected((archive, name), problem)
                    continue
                try:
                    with open_file(archive) as raw, zipfile.ZipFile(raw) as pack:
                        if size <= held:
                            # Small enough to wait for its check sum before anything is handed on.
                            whole = list(parsed(pack, archive, name))
                        else:
                            _verify(pack, name)
                            yield from parsed(pack, archive, name)
                            continue
                except damage:
                    yield rejected((archive, name), "damaged")
                    continue
                yield from whole

    # One member per task: sizes differ by orders of magnitude. The number has to be
    # given, or adaptive execution would merge the short rows into one task.
    listed = stored(members(archives, path), "members")
    tasks = min(max(listed.count(), 1), MOST_TASKS)
    return listed.repartitionByRange(tasks, "archive", "member").mapInArrow(read, schema)


def members(archives: DataFrame, path: str = "path") -> DataFrame:
    """(archive, member, size, problem) of the CSV members, from the archives' central directories.

    Only the end of each archive is read. An archive without any is one row whose
    ``problem`` says ``not a zip`` or ``no csv``; ``size`` is in bytes, unpacked.
    """

    def look(batches):
        import zipfile

        import pyarrow as pa

        for incoming in batches:
            found = []
            for archive in incoming.column(0).to_pylist():
                try:
                    with open_file(archive) as raw, zipfile.ZipFile(raw) as pack:
                        tables = [(archive, i.filename, i.file_size, None) for i in pack.infolist() if _is_table(i.filename)]
                except (zipfile.BadZipFile, EOFError, OSError, pa.ArrowInvalid):
                    tables = [(archive, None, 0, "not a zip")]
                found += tables or [(archive, None, 0, "no csv")]
            columns = zip(*found, strict=True) if found else [[]] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["archive", "member", "size", "problem"],
            )

    paths = archives.select(F.col(path).alias("_path"))
    tasks = min(max(paths.count(), 1), MOST_TASKS)
    return paths.repartitionByRange(tasks, "_path").mapInArrow(
        look, "archive string, member string, size long, problem string"
    )


def _is_table(member: str) -> bool:
    return member.lower().endswith(".csv") and not member.startswith("__MACOSX/")


def _verify(pack, member: str) -> None:
    """Read a member to its end, so that its check sum is compared and its text is known to decode."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    with pack.open(member) as stream:
        while piece := stream.read(1 << 20):
            decoder.decode(piece)
    decoder.decode(b"", final=True)


def _csv_columns(stream, batch_rows: int):
    """The header of a CSV stream, and its rows as (number of rows, columns) in batches; empty text is None."""
    records = csv.reader(io.TextIOWrapper(stream, encoding="utf-8", newline=""))
    header = next(records, [])

    def chunks():
        filled = filter(None, records)
        while rows := list(itertools.islice(filled, batch_rows)):
            turned = itertools.zip_longest(*rows)
            yield len(rows), [[value or None for value in column] for column in turned]

    return header, chunks()


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("_layout").isin("old", "new"))


def rejects(rows: DataFrame) -> DataFrame:
    """Archives, or members of them, that gave no rows, with the reason."""
    return rows.where(~F.col("_layout").isin("old", "new")).select(
        "_archive", "_member", F.col("_layout").alias("reason")
    )
