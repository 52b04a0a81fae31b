from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from siltstone.operators import merge
from siltstone.sources.sinks import write_partitioned
from siltstone.sources.tables import read_table

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ROW = "id int, v string, t int, _day int"


def test_upsert_latest(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], "id int, v string, t int")
    source = spark.createDataFrame([(1, "A", 2), (2, "B", 4), (3, "C", 1), (4, "D", 1)], "id int, v string, t int")
    once = merge.upsert_latest(target, source, ["id"], ["t"])
    assert rows(once) == [(1, "A", 2), (2, "b", 5), (3, "C", 1), (4, "D", 1)]
    assert rows(merge.upsert_latest(once, source, ["id"], ["t"])) == rows(once)


@pytest.mark.parametrize("filed_by_key", [False, True])
def test_upsert_table_touches_only_its_folders(spark, tmp_path, filed_by_key):
    path = str(tmp_path / "t")
    merge.upsert_table(path, spark.createDataFrame([(1, "a", 1, 1), (2, "b", 1, 2), (2, "old", 0, 2), (3, "c", 1, None)], ROW), ["id"], ["t"], ["_day"])
    before = {f for f in read_table(spark, path).inputFiles() if "_day=2/" in f}
    change = spark.createDataFrame([(1, "A", 2, 1), (3, "C", 2, None), (4, "D", 1, 1)], ROW)
    for _ in range(2):
        merge.upsert_table(path, change, ["id"], ["t"], ["_day"], filed_by_key)
    assert rows(read_table(spark, path)) == [(1, "A", 2, 1), (2, "b", 1, 2), (3, "C", 2, None), (4, "D", 1, 1)]
    assert {f for f in read_table(spark, path).inputFiles() if "_day=2/" in f} == before


def test_upsert_table_follows_a_row_to_another_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(spark.createDataFrame([(1, "a", 1, 1), (2, "b", 1, 2), (5, "e", 1, 2)], ROW), path, ["_day"])
    merge.upsert_table(path, spark.createDataFrame([(1, "A", 2, 7), (2, "B", 2, 7)], ROW), ["id"], ["t"], ["_day"])
    assert rows(read_table(spark, path)) == [(1, "A", 2, 7), (2, "B", 2, 7), (5, "e", 1, 2)]


def test_incremental_load_empties_staging(spark, tmp_path):
    staging, table = str(tmp_path / "s"), str(tmp_path / "t")
    staged = spark.createDataFrame([(1, "a", 1, 1)], ROW)
    staged.write.parquet(staging)
    merge.incremental_load(spark, staging, table, staged.schema, ["id"], ["t"], ["_day"])
    assert rows(read_table(spark, table)) == [(1, "a", 1, 1)]
    assert read_table(spark, staging).count() == 0 and read_table(spark, staging).columns == staged.columns
    merge.incremental_load(spark, staging, table, staged.schema, ["id"], ["t"], ["_day"])
    assert rows(read_table(spark, table)) == [(1, "a", 1, 1)]


def version(k, a, begin, end, current):
    return (k, a, begin, end, current)


SCD = "k int, a string, valid_from string, valid_to string, is_current boolean"


def test_scd2_apply(spark):
    dim = spark.createDataFrame([
        (1, "x", "2023", None, True), (2, "y", "2023", None, True), (3, None, "2023", None, True), (4, "gone", "2023", None, True),
        (1, "older", "2022", "2023", False),
    ], SCD)
    snapshot = spark.createDataFrame([(1, "x"), (2, "Y"), (3, None), (5, "new")], "k int, a string")
    once = merge.scd2_apply(dim, snapshot, ["k"], ["a"], "2024")
    assert rows(once) == [
        (1, "older", "2022", "2023", False), (1, "x", "2023", None, True), (2, "Y", "2024", None, True), (2, "y", "2023", "2024", False),
        (3, None, "2023", None, True), (4, "gone", "2023", None, True), (5, "new", "2024", None, True),
    ]
    assert rows(merge.scd2_apply(once, snapshot, ["k"], ["a"], "2025")) == rows(once)


@few
@given(data=st.lists(st.tuples(st.sampled_from([1, 1, 1, 2]), st.integers(0, 40), st.sampled_from(["a", "b", None])), min_size=1, max_size=50, unique_by=lambda x: x[:2]))
def test_scd2_from_history(spark, data):
    got = rows(merge.scd2_from_history(spark.createDataFrame(data + data, "k int, t int, a string").repartition(3), ["k"], ["a"], "t"))
    expected, last = [], {}
    for k, t, a in sorted(data, key=lambda x: x[:2]):
        if k in last and last[k][1] == a:
            continue
        if k in last:
            last[k][3:] = [t, False]
        last[k] = [k, a, t, None, True]
        expected.append(last[k])
    assert got == sorted((tuple(x) for x in expected), key=repr)
    assert all(sum(1 for r in got if r[0] == k and r[4]) == 1 for k in {d[0] for d in data})


def reading(keys, times, values):
    return st.lists(st.tuples(st.sampled_from(keys), st.integers(0, times), st.sampled_from(values)), min_size=1, max_size=30)


@few
@given(readings=reading([1, 1, 2, None], 9, ["a", "b", None]), cuts=st.tuples(st.integers(0, 30), st.integers(0, 30)))
def test_late_snapshots_give_the_dimension_of_sorted_ones(spark, readings, cuts):
    """Readings in any order, in three batches, some of them twice."""
    first, second = sorted(cuts)
    schema, dim = "k int, t int, a string", None
    for batch in (readings[:first], readings[first:second], readings[second:] + readings[:3]):
        dim = merge.scd2_splice(dim, spark.createDataFrame(batch, schema), ["k"], ["a"], "t")
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    best = {}
    for k, t, a in readings:
        best[k, t] = max(best.get((k, t), a) or "", a or "") or None
    expected = []
    for k in {k for k, _, _ in readings}:
        versions = []
        for t in sorted(t for q, t in best if q == k):
            if versions and versions[-1][1] == best[k, t]:
                versions[-1][5].append(t)
                continue
            if versions:
                versions[-1][3:5] = [t, False]
            versions.append([k, best[k, t], t, None, True, [t]])
        expected += map(tuple, versions)
    assert sorted(map(tuple, dim.collect()), key=repr) == sorted(expected, key=repr)


def test_late_snapshot_leaves_other_members(spark):
    schema = "t int, k int, a string"
    dim = merge.scd2_splice(None, spark.createDataFrame([(5, 1, "x"), (5, 2, "y"), (9, 1, "x"), (None, 1, "q")], schema), ["k"], ["a"], "t")
    late = merge.scd2_splice(dim, spark.createDataFrame([(7, 1, "z")], schema), ["k"], ["a"], "t")
    assert sorted(map(tuple, late.collect())) == [
        (1, "x", 5, 7, False, [5]), (1, "x", 9, None, True, [9]), (1, "z", 7, 9, False, [7]), (2, "y", 5, None, True, [5]),
    ]
    assert merge.scd2_splice(late, spark.createDataFrame([], schema), ["k"], ["a"], "t").count() == 4


def test_schema_evolution(spark):
    old = spark.createDataFrame([(1, 2, "x")], "a int, b bigint, c string")
    new = spark.createDataFrame([(3, 0.5, True)], "a bigint, b double, d boolean")
    out = merge.schema_evolve(old, new)
    assert out.schema.simpleString() == "struct<a:bigint,b:double,c:string,d:boolean>"
    assert rows(out) == [(1, 2.0, "x", None), (3, 0.5, None, True)]
    narrowed = merge.schema_evolve(new.select("a"), old.select("a"))
    assert narrowed.schema["a"].dataType == T.LongType()
    with pytest.raises(TypeError):
        merge.evolved_schema(old.schema, T.StructType.fromDDL("c INT"))
