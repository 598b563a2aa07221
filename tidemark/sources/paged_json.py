"""Sliced, paged JSON extract as a Python data source.

Slices are read in parallel, and each slice by several readers that take its pages in
turn (reader i of n reads pages i, i + n, i + 2n, ...), so a slice that holds most of
the records is not left to one task. A short page ends a reader: all pages after it are
empty. Only one page per reader is held.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark import contracts
from tidemark.sources.paths import file_system

READERS = 4
# fetch(start, end, limit, offset) -> the page's records, in cursor order
Fetch = Callable[[str, str, int, int], list]
SCHEMA = "slice_no int, page_no int, payload string"


def page_batches(
    fetch: Fetch, number: int, start: str, end: str, page_size: int, reader: int, readers: int
) -> Iterator:
    """One slice's pages ``reader``, ``reader + readers``, ... as Arrow batches, up to a short page."""
    import json

    import pyarrow as pa

    page = reader
    while True:
        records = fetch(start, end, page_size, page * page_size)
        if records:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(records), pa.int32()),
                    pa.array([page] * len(records), pa.int32()),
                    pa.array([json.dumps(r, ensure_ascii=False) for r in records], pa.string()),
                ],
                names=["slice_no", "page_no", "payload"],
            )
        if len(records) < page_size:
            return
        page += readers


def read_pages(
    spark: SparkSession, fetch: Fetch, slices: Sequence[tuple[int, str, str]],
    page_size: int = contracts.PAGE_SIZE, readers: int = READERS,
) -> DataFrame:
    """Records of all slices as ``slice_no``, ``page_no`` and ``payload`` (JSON text).

    ``slices`` are (number, first moment, last moment) as ISO text, both ends
    included. ``fetch`` runs inside the tasks.
    """
    name = f"paged_json_{uuid.uuid4().hex[:12]}"
    todo = [tuple(s) for s in slices]

    class Slice(InputPartition):
        def __init__(self, number, start, end, reader):
            super().__init__((number, reader))
            self.number, self.start, self.end, self.reader = number, start, end, reader

    class Reader(DataSourceReader):
        def partitions(self):
            return [Slice(*s, reader) for s in todo for reader in range(readers)]

        def read(self, partition):
            return page_batches(
                fetch, partition.number, partition.start, partition.end, page_size, partition.reader, readers
            )

    class PagedJson(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Reader()

    if not todo:
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(PagedJson)
    return spark.read.format(name).load()


def stored_pages(root: str) -> Fetch:
    """Fetch from pages kept as ``<root>/slice_start=<ISO>/page_no=<n>/*.json`` lines."""
    def fetch(start: str, end: str, limit: int, offset: int) -> list:
        import json
        from urllib.parse import quote

        from pyarrow import fs

        system, base = file_system(root)
        folder = f"{base}/slice_start={quote(start, safe='')}/page_no={offset // limit}"
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = sorted(f.path for f in found if f.base_name.endswith(".json"))
        records = []
        for name in names:
            with system.open_input_stream(name) as lines:
                records += [json.loads(line) for line in lines.read().splitlines() if line]
        return records

    return fetch
