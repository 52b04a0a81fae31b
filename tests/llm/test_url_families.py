"""The default URL model on all unwanted host families of the pages, none of which is in its table."""

import pytest
from pyspark.sql import functions as F

from siltstone.llm import url_filter

FAMILIES = ("casino-win", "cheap-pills", "ads-track", "free-bets", "spam-farm", "adult-x")


def test_all_unwanted_families(spark):
    assert not any(f in u for f in FAMILIES for u in (*url_filter.BLOCKED_URLS, *url_filter.ALLOWED_URLS))
    rows = url_filter.judge(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).where("rule is null")
    family = F.coalesce(*(F.when(F.contains("host", F.lit(f)), f) for f in FAMILIES), F.lit("wanted"))
    found = rows.groupBy(family.alias("family")).agg(F.avg((F.col("verdict") == "block").cast("int")).alias("blocked")).collect()
    blocked = {r["family"]: r["blocked"] for r in found}
    assert len(blocked) == len(FAMILIES) + 1
    assert all(blocked[f] >= 0.9 for f in FAMILIES) and blocked["wanted"] <= 0.01


@pytest.mark.parametrize("url", ["http://www.farmers.test/market", "https://dairy-farm.test/visit", "http://alphabet.school.test/a"])
def test_wanted_hosts_with_unwanted_syllables(url):
    host, path = url_filter.split_url(url)
    assert url_filter.default_model().probability(host.encode(), path.encode()) < url_filter.BLOCK_FROM


def test_a_long_table_keeps_both_classes(monkeypatch):
    rows = [(f"http://casino{i}.test/win", True) for i in range(90)] + [(f"http://school{i}.test/en", False) for i in range(30)]
    monkeypatch.setattr(url_filter, "TRAIN_ROWS", 40)
    for order in (rows, rows[::-1]):
        kept = url_filter.bounded(order)
        assert len(kept) == 40 and sum(bad for _, bad in kept) == 20
        assert url_filter.train(order).probability(b"school99.test", b"/en") < 0.5
    assert url_filter.bounded(rows[85:95]) == rows[85:95]
    assert len(url_filter.bounded(rows[:95])) == 40 and sum(not bad for _, bad in url_filter.bounded(rows[:95])) == 5
