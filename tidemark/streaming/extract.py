"""Resumable extract: date slices of a paged source as a stream.

The stream's offset is the last moment of the newest finished slice, so a run takes all
open slices in one job, and a slice that a finished batch held is never asked for again.
Pages of a batch that is still open are landed in the shared folder as they come: when the
job dies, the next run takes them from there and fetches only what was not there yet. A
finished batch is committed, which deletes its landed pages.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark import contracts
from tidemark.session import remove, setting
from tidemark.sources.paged_json import READERS, SCHEMA, Fetch, page_batches
from tidemark.sources.paths import file_system

#: Number, first and last moment (ISO text, both included).
Slice = tuple[int, str, str]


def _folder(root: str, start: str, end: str) -> str:
    return f"{root}/{quote(start, safe='')}_{quote(end, safe='')}"


def landed(fetch: Fetch, root: str) -> Fetch:
    """``fetch`` that keeps every page below ``root`` and gives a kept page without asking again."""

    def kept(start: str, end: str, limit: int, offset: int) -> list:
        system, folder = file_system(_folder(root, start, end))
        name = f"{folder}/{limit}-{offset}.json"
        try:
            with system.open_input_stream(name) as page:
                return json.loads(page.read())
        except FileNotFoundError:
            pass
        records = fetch(start, end, limit, offset)
        system.create_dir(folder, recursive=True)
        # Under another name first, so that a page that is there is whole.
        partial = f"{folder}/.{uuid.uuid4().hex}"
        with system.open_output_stream(partial) as page:
            page.write(json.dumps(records, ensure_ascii=False).encode())
        system.move(partial, name)
        return records

    return kept


def _forget(root: str, start: str, end: str) -> None:
    system, folder = file_system(_folder(root, start, end))
    if system.get_file_info(folder).type.name == "Directory":
        system.delete_dir(folder)


def slice_stream(
    spark: SparkSession, fetch: Fetch, slices: Sequence[Slice], landing: str,
    page_size: int = contracts.PAGE_SIZE, readers: int = READERS,
) -> DataFrame:
    """The slices' records as a stream of ``slice_no``, ``page_no`` and ``payload`` (JSON text).

    A slice is open while it ends after the stream's offset; a slice that was cut short by
    the end of an earlier range is open again, whole, once the range goes further.
    """
    todo = sorted((tuple(s) for s in slices), key=lambda s: s[2])
    name = f"sliced_json_{uuid.uuid4().hex[:12]}"
    asked = landed(fetch, landing)

    class Part(InputPartition):
        def __init__(self, number: int, start: str, end: str, reader: int) -> None:
            super().__init__((number, reader))
            self.number, self.start, self.end, self.reader = number, start, end, reader

    class Reader(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"finished": ""}

        def latestOffset(self) -> dict:
            return {"finished": todo[-1][2]}

        def partitions(self, start: dict, end: dict) -> list:
            opened = [s for s in todo if start["finished"] < s[2] <= end["finished"]]
            return [Part(*s, reader) for s in opened for reader in range(readers)]

        def read(self, partition: Part) -> Iterator:
            return page_batches(
                asked, partition.number, partition.start, partition.end, page_size, partition.reader, readers
            )

        def commit(self, end: dict) -> None:
            for _, first, last in todo:
                if last <= end["finished"]:
                    _forget(landing, first, last)

    class SlicedJson(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema):
            return Reader()

    spark.dataSource.register(SlicedJson)
    return spark.readStream.format(name).load()


def pull_slices(
    spark: SparkSession, fetch: Fetch, slices: Sequence[Slice], state: str, write: Callable[[DataFrame], None],
    page_size: int = contracts.PAGE_SIZE, readers: int = READERS,
) -> None:
    """Hand the records of all open slices to ``write``, in one job, and remember the slices as finished.

    ``state`` is a folder that all executors share and that stays the same from run to run.
    ``write`` may get a batch again after a failure and so has to replace the slices it
    gets, as ``replace_slices`` does. Without slices nothing happens.
    """
    if not slices:
        return
    stream = slice_stream(spark, fetch, slices, f"{state}/pages", page_size, readers)
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: write(batch))
        .option("checkpointLocation", f"{state}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # All slices are finished; the stream itself would commit its last batch only in its next run.
    remove(spark, f"{state}/pages")


def replace_slices(rows: DataFrame, path: str, column: str = "slice_no") -> None:
    """Write slices into a folder for each below ``path``, in place of what it had."""
    with setting(rows.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)
