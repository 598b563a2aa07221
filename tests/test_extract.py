"""Slices pulled as a stream: what is fetched again after a failure, and what is not."""

import json
from pathlib import Path

import pytest

from tidemark import contracts
from tidemark.plans.open_data import load_records
from tidemark.sinks import tables
from tidemark.sources.paged_json import SCHEMA
from tidemark.streaming.extract import landed, pull_slices, replace_slices

DAYS = [(n, f"2023-01-{n + 1:02d}T00:00:00", f"2023-01-{n + 1:02d}T23:59:59") for n in range(6)]
RECORDS = [{"at": f"2023-01-{n + 1:02d}T{h:02d}:00:00", "id": f"{n}-{h}"} for n in range(6) for h in range(n + 1)]


class Source:
    """A source that notes what it is asked for and can be told to die in a slice."""

    def __init__(self, folder: Path) -> None:
        self.log, self.fatal = folder / "asked", folder / "fatal"
        self.log.mkdir()

    def fetch(self):
        log, fatal, records = self.log, self.fatal, RECORDS

        def fetch(start, end, limit, offset):
            if fatal.exists() and start in fatal.read_text():
                raise RuntimeError("the source is gone")
            with open(log / f"{start}_{offset}".replace(":", ""), "a") as f:
                f.write("x")
            inside = sorted((r for r in records if start <= r["at"] <= end), key=lambda r: r["at"])
            return inside[offset : offset + limit]

        return fetch

    def asked(self) -> dict[str, int]:
        return {p.name: len(p.read_text()) for p in sorted(self.log.iterdir())}


@pytest.fixture
def source(tmp_path):
    return Source(tmp_path)


def pulled(spark, path):
    return sorted(json.loads(r["payload"])["id"] for r in spark.read.schema(SCHEMA).parquet(path).collect())


def test_a_restart_fetches_no_page_again(spark, tmp_path, source):
    state = f"file://{tmp_path}/state"
    run = lambda slices: pull_slices(
        spark, source.fetch(), slices, state, lambda rows: replace_slices(rows, f"{state}/records"), 2, readers=2
    )
    run(DAYS[:2])
    first = source.asked()
    source.fatal.write_text(DAYS[4][1])
    with pytest.raises(Exception, match="the source is gone"):
        run(DAYS)
    died = source.asked()
    assert not any(n.startswith("2023-01-05") for n in died)
    source.fatal.unlink()
    run(DAYS)
    done = source.asked()
    assert pulled(spark, f"{state}/records") == sorted(r["id"] for r in RECORDS)
    assert set(done.values()) == {1}, "every page was asked for once"
    assert set(first) <= set(died) <= set(done)
    run(DAYS)
    assert source.asked() == done, "nothing is open"
    assert not list((tmp_path / "state" / "pages").glob("*/*.json")), "landed pages go with their slice"


def test_a_batch_written_twice_is_there_once(spark, tmp_path, source):
    state = f"file://{tmp_path}/state"
    dies = [True]

    def write(rows):
        replace_slices(rows, f"{state}/records")
        if dies:
            raise RuntimeError("the driver is gone")

    with pytest.raises(Exception, match="the driver is gone"):
        pull_slices(spark, source.fetch(), DAYS, state, write, 2)
    asked = source.asked()
    dies.clear()
    pull_slices(spark, source.fetch(), DAYS, state, write, 2)
    assert source.asked() == asked
    assert pulled(spark, f"{state}/records") == sorted(r["id"] for r in RECORDS)


def test_a_cut_slice_is_open_again(spark, tmp_path, source):
    state = f"file://{tmp_path}/state"
    run = lambda slices: pull_slices(
        spark, source.fetch(), slices, state, lambda rows: replace_slices(rows, f"{state}/records"), 50
    )
    number, start, _ = DAYS[3]
    run([*DAYS[:3], (number, start, "2023-01-04T01:30:00")])
    assert pulled(spark, f"{state}/records") == sorted(r["id"] for r in RECORDS if r["at"] <= "2023-01-04T01:30:00")
    run(DAYS[:4])
    assert pulled(spark, f"{state}/records") == sorted(r["id"] for r in RECORDS if r["at"] <= "2023-01-04T23")
    run([])
    run([(7, "2024-01-01T00:00:00", "2024-01-01T23:59:59")])
    assert len(pulled(spark, f"{state}/records")) == 10, "a slice without records is finished as well"


def test_landed_pages_are_whole_or_not_there(tmp_path):
    asked = []

    def fetch(start, end, limit, offset):
        asked.append(offset)
        if len(asked) == 1:
            raise RuntimeError("no answer")
        return [{"n": "é"}]

    kept = landed(fetch, str(tmp_path))
    with pytest.raises(RuntimeError):
        kept("a:b", "c/d", 5, 0)
    assert kept("a:b", "c/d", 5, 0) == kept("a:b", "c/d", 5, 0) == [{"n": "é"}]
    assert asked == [0, 0] and kept("a:b", "c/d", 6, 0) and asked == [0, 0, 0]


def test_records_are_taken_up_where_a_load_died(spark, tmp_path, source, monkeypatch):
    for name in contracts.LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    entry = contracts.RECORD_SETS[0]
    fetch = source.fetch()

    def feed(start, end, limit, offset):
        return [{"unique_key": r["id"], "created_date": r["at"]} for r in fetch(start, end, limit, offset)]

    load = lambda: load_records(spark, entry, feed, DAYS[0][1], DAYS[5][2], page_size=3, days=1)
    source.fatal.write_text(DAYS[2][1])
    with pytest.raises(Exception, match="the source is gone"):
        load()
    source.fatal.unlink()
    import tidemark.plans.open_data as plan

    with monkeypatch.context() as patched:
        # It dies again, after its records are in the table and before the watermark moves.
        patched.setattr(plan.watermarks, "advance", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load()
    asked = source.asked()
    assert set(asked.values()) == {1}
    loaded = load()
    assert source.asked() == asked, "all was landed"
    assert sorted(r["unique_key"] for r in loaded.collect()) == sorted(r["id"] for r in RECORDS)
    again = load()
    assert again.count() == 2 * len(RECORDS), "the next load reads the lookback anew and appends it"
    assert tables.load_number() > 0
