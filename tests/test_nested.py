from conftest import rows

from siltstone.functions import nested as n
from siltstone.schemas import LINE_COLOURS

ITEMS = "id int, items array<struct<type: string, severity: string>>"


def items(spark):
    return spark.createDataFrame(
        [(1, [("Car", "Fatal"), (None, "fatal"), ("Bus", None)]), (2, []), (3, None), (4, [("Van", "Slight")])], ITEMS
    )


def test_explode_keeps_rows_without_items(spark):
    df = n.explode_items(items(spark), "items", "item").select("id", "item.type")
    assert rows(df) == [(1, "Bus"), (1, "Car"), (1, None), (2, None), (3, None), (4, "Van")]


def test_join_skips_nulls(spark):
    assert rows(items(spark).select("id", n.join_field("items", "type"))) == [(1, "Car, Bus"), (2, ""), (3, None), (4, "Van")]


def test_counts(spark):
    df = items(spark).select("id", n.count_items("items"), n.count_items_where("items", "severity", "FATAL"))
    assert rows(df) == [(1, 3, 2), (2, 0, 0), (3, 0, 0), (4, 1, 0)]


def test_properties_first_match_wins(spark):
    df = spark.createDataFrame(
        [(1, [("A", "x"), ("A", "y"), ("B", None)]), (2, []), (3, None)], "id int, p array<struct<key: string, value: string>>"
    )
    assert df.select(*n.property_columns("p", ["A", "NbX"])).columns == ["a", "nbx"]
    got = df.select("id", *n.property_columns("p", ["A", "B", "C"]))
    assert rows(got) == [(1, "x", None, None), (2, None, None, None), (3, None, None, None)]


def test_map_lookup(spark):
    df = spark.createDataFrame([("dlr",), ("nowhere",), (None,)], "line string")
    assert rows(df.select("line", n.lookup(LINE_COLOURS, "line"))) == [("dlr", "#00A4A7"), ("nowhere", None), (None, None)]
