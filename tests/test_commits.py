"""Changes that stop at any step, logs of what was taken in, and the key index."""

import json
import os
from datetime import date

import pytest
from conftest import rows
from test_second_runs import accident, filed, land

from siltstone.operators import merge, surrogate
from siltstone.plans import refresh
from siltstone.sources import commits, files, sinks
from siltstone.sources.sinks import write_dimension, write_partitioned
from siltstone.sources.tables import read_table, read_table_if_any

AT = "2024-07-01 00:00:00"


class Stopped(BaseException):
    """As a killed driver: nothing that would clean up after an error may run."""


def stopping(monkeypatch, modules, name, at):
    """Let the ``at``-th call of a file operation, counted from 0, stop instead of being done."""
    real, calls = getattr(files, name), [0]

    def step(*args):
        calls[0] += 1
        if calls[0] > at:
            raise Stopped
        return real(*args)

    for module in modules:
        if hasattr(module, name):
            monkeypatch.setattr(module, name, step)
    return calls


STEPS = [("move", 0), ("move", 1), ("remove", 0)]


@pytest.mark.parametrize("name,at", STEPS)
def test_a_stopped_replacement_keeps_rows_and_keys(spark, tmp_path, monkeypatch, name, at):
    path = str(tmp_path / "dim")
    members = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    write_dimension(surrogate.assign_keys(members("bcd"), ["name"], "key"), path)
    first = dict(rows(read_table(spark, path), "name", "key"))

    def refreshed():
        return surrogate.assign_keys(members("abcd"), ["name"], "key", read_table_if_any(spark, path))

    with monkeypatch.context() as patch:
        stopping(patch, [files], name, at)
        with pytest.raises(Stopped):
            write_dimension(refreshed(), path)
    found = dict(rows(read_table(spark, path), "name", "key"))
    assert {n: found[n] for n in "bcd"} == first
    write_dimension(refreshed(), path)
    found = dict(rows(read_table(spark, path), "name", "key"))
    assert {n: found[n] for n in "bcd"} == first and len(set(found.values())) == 4
    assert [n for n in os.listdir(tmp_path) if "-old-" in n] == []


def test_two_that_recover_at_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_dimension(spark.range(2), path)
    move = files.move

    def raced(spark_, source, target):
        done = move(spark_, source, target)
        if target.rpartition("/")[2].startswith(".t-old-"):
            files.recover(spark_, path)  # a reader between the two renames
        return done

    monkeypatch.setattr(files, "move", raced)
    write_dimension(spark.range(5), path)
    assert read_table(spark, path).count() == 5 and os.listdir(tmp_path) == ["t"]


@pytest.mark.parametrize("at", range(5))
@pytest.mark.parametrize("name", ["move", "remove", "write_text"])
def test_a_stopped_merge_is_made_whole_or_not_at_all(spark, tmp_path, monkeypatch, name, at):
    path = str(tmp_path / "t")
    schema = "id int, v int"
    merge.upsert_table(path, filed(spark, [(1, 1, 2024, 1, 1), (2, 1, 2024, 1, 2), (3, 1, 2024, 1, 3)], schema), ["id"], ["v"])
    before = rows(read_table(spark, path), "id", "v", "_day")
    change = filed(spark, [(1, 2, "x", 2024, 1, 3), (2, 2, "x", 2024, 1, 2)], f"{schema}, note string")
    after = [(1, 2, 3), (2, 2, 2), (3, 1, 3)]
    with monkeypatch.context() as patch:
        stopping(patch, [commits], name, at)
        try:
            merge.upsert_table(path, change, ["id"], ["v"])
            stopped = False
        except Stopped:
            stopped = True
    if stopped:
        noted = [n for n in os.listdir(f"{path}/_pending") if os.path.exists(f"{path}/_pending/{n}/note.json")]
        monkeypatch.setattr(commits, "STOPPED", -1)
        assert rows(read_table(spark, path), "id", "v", "_day") == (after if noted else before)
        merge.upsert_table(path, change, ["id"], ["v"])
    assert rows(read_table(spark, path), "id", "v", "_day") == after
    assert rows(read_table(spark, path), "note")[0] == ("x",)
    assert not commits.names_in(spark, f"{path}/_pending")
    assert files.folder_values(spark, path, ("_year", "_month", "_day")) == [(2024, 1, 2), (2024, 1, 3)]


def test_readers_leave_a_live_writers_change_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(filed(spark, [(1, 2024, 1, 1)], "id int"), path)
    change = commits.staged(spark, path)
    filed(spark, [(2, 2024, 1, 1)], "id int").write.partitionBy("_year", "_month", "_day").parquet(f"{change}/rows")
    assert rows(read_table(spark, path), "id") == [(1,)] and os.path.exists(change)
    write_partitioned(filed(spark, [(3, 2024, 1, 2)], "id int"), path, only_touched=True)
    assert rows(read_table(spark, path), "id") == [(1,), (3,)] and not os.path.exists(change)


def test_moving_keys_are_found_without_reading_other_folders(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    days = [(i, 0, 2024, 1, 1 + i % 20) for i in range(200)]
    merge.upsert_table(path, filed(spark, days, "id int, v int"), ["id"], ["v"])
    opened = []
    hashed = merge.folders_of

    def seen(df, columns):
        opened.append({f for f in df.inputFiles() if path in f and "/_keys/" not in f})
        return hashed(df, columns)

    monkeypatch.setattr(merge, "folders_of", seen)
    touched = merge.upsert_table(path, filed(spark, [(5, 1, 2024, 1, 19), (300, 1, 2024, 1, 2)], "id int, v int"), ["id"], ["v"])
    assert not any(opened)  # folders are found from the index alone
    assert touched == {"_year=2024/_month=1/_day=6", "_year=2024/_month=1/_day=19", "_year=2024/_month=1/_day=2"}
    want = {i: (0, 1 + i % 20) for i in range(200)} | {5: (1, 19), 300: (1, 2)}
    for at in range(3):  # moves on, and the index with it
        assert {i: (v, d) for i, v, d in rows(read_table(spark, path), "id", "v", "_day")} == want
        merge.upsert_table(path, filed(spark, [(5, 2 + at, 2024, 1, 7 + at), (None, at, 2024, 1, at + 1)], "id int, v int"), ["id"], ["v"])
        want |= {5: (2 + at, 7 + at), None: (at, at + 1)}
    index = commits.key_index(spark, path, ["id"], read_table(spark, path).select("_year", "_month", "_day").schema)
    assert index.count() == len(want)


def test_other_writers_drop_the_index(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert_table(path, filed(spark, [(1, 0, 2024, 1, 1)], "id int, v int"), ["id"], ["v"])
    sinks.append_new(filed(spark, [(2, 0, 2024, 1, 2)], "id int, v int"), path, ["id"])
    merge.upsert_table(path, filed(spark, [(2, 1, 2024, 1, 1)], "id int, v int"), ["id"], ["v"])
    assert rows(read_table(spark, path), "id", "v", "_day") == [(1, 0, 1), (2, 1, 1)]


def test_a_second_run_opens_new_files_only(spark, tmp_path):
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    land(tmp_path / "bronze", date(2024, 6, 1), accident(1, "old", 1, 1), accident(2, "b", 1, 1))
    land(tmp_path / "bronze", date(2024, 6, 2), accident(9, "nine", 9, 2))
    assert len(refresh.take_in(spark, "accidents", bronze, path, AT)) == 2
    assert refresh.take_in(spark, "accidents", bronze, path, AT) == set()
    untouched = {f for f in read_table(spark, path).inputFiles() if "_day=9" in f}
    land(tmp_path / "bronze", date(2024, 6, 3), accident(1, "corrected", 2, 3))
    raw, fresh = refresh.new_records(spark, "accidents", bronze, path)
    assert len(raw.inputFiles()) == fresh.count() == 1 and "day=03" in raw.inputFiles()[0]
    assert refresh.take_in(spark, "accidents", bronze, path, AT) == {f"_year=2024/_month=6/_day={d}" for d in (1, 2)}
    assert {f for f in read_table(spark, path).inputFiles() if "_day=9" in f} == untouched
    assert rows(read_table(spark, path), "id", "borough", "_day") == [(1, "corrected", 2), (2, "b", 1), (9, "nine", 9)]
    refresh.refresh_silver(spark, "accidents", bronze, str(tmp_path / "rebuilt"), AT)
    assert rows(read_table(spark, str(tmp_path / "rebuilt"))) == rows(read_table(spark, path))
    assert refresh.take_in(spark, "accidents", bronze, str(tmp_path / "rebuilt"), AT) == set()


def test_copies_of_equal_age_do_not_depend_on_the_run(spark, tmp_path):
    made = []
    for order in ("ab", "ba"):
        bronze, path = tmp_path / f"bronze-{order}", str(tmp_path / f"silver-{order}")
        for borough in order:
            land(bronze, date(2024, 6, 1), accident(1, borough, 1, 1))
            refresh.take_in(spark, "accidents", str(bronze), path, AT)
        made.append(rows(read_table(spark, path), "id", "borough"))
    assert made == [[(1, "a")]] * 2


def test_bad_lines_are_set_aside_once(spark, tmp_path):
    bronze, path = tmp_path / "bronze", str(tmp_path / "silver")
    land(bronze, date(2024, 6, 1), accident(1, "a", 1, 1), {"borough": "no id"})
    folder = bronze / "year=2024/month=06/day=01"
    (folder / "cut.json").write_text('{"id": 7, "bor\n\n')
    for _ in range(2):
        refresh.take_in(spark, "accidents", str(bronze), path, AT)
    aside = rows(commits.quarantined(spark, path), "line", "reason", "file")
    assert [(json.loads(x[0])["borough"] if x[1] == "incomplete" else x[0], x[1], os.path.basename(x[2])) for x in aside] == [
        ('{"id": 7, "bor', "unparsed", "cut.json"), ("no id", "incomplete", "0.json"),
    ] or len(aside) == 2
    assert rows(read_table(spark, path), "id") == [(1,)]
    refresh.refresh_silver(spark, "accidents", str(bronze), str(tmp_path / "rebuilt"), AT)
    assert rows(commits.quarantined(spark, str(tmp_path / "rebuilt"))) == rows(commits.quarantined(spark, path))


def test_logs_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "LOG_PARTS", 3)
    bronze, path = tmp_path / "bronze", str(tmp_path / "silver")
    for day in range(1, 8):
        land(bronze, date(2024, 6, day), accident(day, "a", 1, day))
        refresh.take_in(spark, "accidents", str(bronze), path, AT)
        assert commits.taken_in(spark, path).count() == day
        assert len(commits.names_in(spark, f"{path}/{commits.LOG}")) <= 3
    assert read_table(spark, path).count() == 7


def test_new_members_reach_older_facts(spark, tmp_path):
    from test_layers import ARRIVAL, LINE

    bronze, silver_root, gold = (str(tmp_path / x) for x in ("bronze", "silver", "gold"))
    stamp = {"_ingested_at": "2024-06-15T08:00:00Z"}
    for feed in refresh.silver.TABLES:
        (tmp_path / "bronze" / feed).mkdir(parents=True)
    land(tmp_path / "bronze/arrivals", date(2024, 6, 15), {**ARRIVAL, **stamp})
    runs = []
    for feed, record in (("line_status", {**LINE, "id": "other", **stamp}), ("line_status", {**LINE, "id": ARRIVAL["lineId"], **stamp})):
        land(tmp_path / "bronze" / feed, date(2024, 6, 15), record)
        runs.append(refresh.refresh_new(spark, bronze, silver_root, gold, at=AT))
    paths = refresh.table_paths(silver_root, gold)
    assert runs[1]["arrivals"] == set() and len(runs[1]["fact_arrivals"]) == 1
    assert read_table(spark, paths["fact_arrivals"]).where("line_key is not null").count() == 1
