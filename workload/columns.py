"""Column-level operators, joins, deduplication, nested data and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import cleaning as c, nested as n
from siltstone.functions.timekeys import date_key, time_key
from siltstone.operators import dedup
from siltstone.operators.starjoin import Lookup, heavy_keys, lookup_join, salted_left_join
from siltstone.operators.surrogate import assign_keys
from siltstone.schemas import HOUR_BANDS, LINE_COLOURS, OTHER_HOURS, OTHER_SEVERITY, SEVERITY_BANDS
from siltstone.session import materialise
from workload import feeds, sql
from workload.registry import query


@query("""
select o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) as integer) as urgency,
  try_cast(o_orderpriority as integer) as not_a_number, cast(o_totalprice as double) as price,
  case o_orderstatus when 'O' then true when 'F' then false end as is_open,
  case when o_orderstatus <> 'P' then o_orderdate end as ordered_at
from orders""")
def safe_casts(spark, sf_dir):
    status = F.col("o_orderstatus")
    df = feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        c.part("o_orderpriority", "-", 0).alias("urgency"),
        F.col("o_orderpriority").alias("not_a_number"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(status == "O", "true").when(status == "F", "false").otherwise("perhaps").alias("is_open"),
        F.when(status == "P", "soon").otherwise(feeds.iso(F.col("o_orderdate"), "+00:00")).alias("ordered_at"),
    )
    typed = c.with_types(df, {"urgency": "int", "not_a_number": "int", "price": "double", "is_open": "boolean"})
    return c.with_timestamps(typed, ["ordered_at"])


@query("select c_custkey, trim(c_name) as name, lower(trim(c_mktsegment)) as segment from customer")
def clean_strings(spark, sf_dir):
    df = feeds.table(spark, sf_dir, "customer").select(
        "c_custkey", feeds.text("  ", F.col("c_name"), " ").alias("name"), feeds.text(" ", F.col("c_mktsegment")).alias("segment")
    )
    return c.with_normalised(c.with_trimmed(df, ["name"]), ["segment"])


@query("""
select o_orderkey, cast(year(o_orderdate) as integer) as _year, cast(month(o_orderdate) as integer) as _month,
  cast(day(o_orderdate) as integer) as _day from orders""")
def partition_columns(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return c.with_partition_columns(orders, "o_orderdate").drop("o_orderdate")


@query(f"select event_id, {sql.date_key('ts')} as date_key, {sql.time_key('ts')} as time_key from events")
def time_keys(spark, sf_dir):
    return feeds.table(spark, sf_dir, "events").select(
        "event_id", date_key("ts").alias("date_key"), time_key("ts").alias("time_key")
    )


@query(f"""
select event_id, {sql.hours('ts')} as period_of_day,
  case when {sql.K} % 12 = 10 then 'Normal' when {sql.K} % 12 between 6 and 9 then 'Minor'
    when {sql.K} % 12 between 3 and 5 then 'Major' else 'Severe' end as severity_category from events""")
def banding(spark, sf_dir):
    return feeds.events_with_k(spark, sf_dir).select(
        "event_id",
        c.banded(F.hour("ts"), HOUR_BANDS, OTHER_HOURS).alias("period_of_day"),
        c.banded(F.pmod("k", F.lit(12)), SEVERITY_BANDS, OTHER_SEVERITY).alias("severity_category"),
    )


@query(f"select page_id, {sql.decoded('html')} as decoded, {sql.stripped('html')} as stripped from pages")
def html_clean(spark, sf_dir):
    return feeds.table(spark, sf_dir, "pages").select(
        "page_id", c.clean_markup("html").alias("decoded"), c.drop_markup("html").alias("stripped")
    )


@query("""
select o_orderkey, split_part(o_orderpriority, '-', 1) as code, split_part(o_orderpriority, '-', 2) as label,
  cast(null as varchar) as missing from orders""")
def split_parts(spark, sf_dir):
    return feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", *(c.part("o_orderpriority", "-", i).alias(name) for i, name in enumerate(("code", "label", "missing")))
    )


@query("""
select o_orderkey, o_custkey, c_mktsegment, c_nationkey from orders
left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey""")
def left_join_using(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    solvent = feeds.table(spark, sf_dir, "customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return lookup_join(orders, Lookup(solvent, "o_custkey", "o_custkey", ("c_mktsegment", "c_nationkey")), ["o_orderkey"])


@query("""
select c_custkey, c_nationkey, n_name from customer
left join (select * from nation where n_regionkey = 1) on c_nationkey = n_nationkey""")
def left_join_on(spark, sf_dir):
    customer = feeds.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = feeds.table(spark, sf_dir, "nation").where("n_regionkey = 1")
    return lookup_join(customer, Lookup(nation, "c_nationkey", "n_nationkey", ("n_name",)), ["c_custkey"])


@query("""
select l_orderkey, l_linenumber, l_partkey, l_quantity, p_brand, p_size from lineitem
left join (select * from part where p_size > 10) on l_partkey = p_partkey""")
def left_join_salted(spark, sf_dir):
    """The join taken when a dimension is too large to broadcast: heavy keys are cut into pieces."""
    items = feeds.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    part = feeds.table(spark, sf_dir, "part").where("p_size > 10").select("p_partkey", "p_brand", "p_size")
    pieces = heavy_keys(items, "l_partkey")
    joined = salted_left_join(items, part, "l_partkey", "p_partkey", ["l_orderkey", "l_linenumber", "l_quantity"], pieces)
    return joined.drop("p_partkey")


@query(f"""
select c_custkey, line_id, {sql.COLOUR} as colour
from (select c_custkey, {sql.LINE_ID.replace('user_id', 'c_nationkey')} as line_id from customer)""")
def map_lookup(spark, sf_dir):
    lines = feeds.table(spark, sf_dir, "customer").select("c_custkey", feeds.line_id(F.col("c_nationkey")).alias("line_id"))
    return lines.withColumn("colour", n.lookup(LINE_COLOURS, "line_id"))


LINEITEM_ORDER = ", ".join(
    f"{x} nulls last" for x in ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
)


@query(f"""
select * from lineitem
qualify row_number() over (partition by l_orderkey order by l_shipdate desc nulls last, {LINEITEM_ORDER}) = 1""")
def dedup_latest(spark, sf_dir):
    return dedup.dedup_latest(feeds.table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_shipdate"])


@query(f"""
select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
  order by l_shipdate desc nulls last, {LINEITEM_ORDER.replace('l_linenumber nulls last, ', '')}) = 1""")
def dedup_composite(spark, sf_dir):
    return dedup.dedup_latest(feeds.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


LINK = 'href="([^"]*)"'


@query(f"""
select page_id, target, cast(length(target) as integer) as size
from (select page_id, unnest(case when len(l) = 0 then [null] else l end) as target
  from (select page_id, regexp_extract_all(html, '{LINK}', 1) as l from pages))""")
def explode_outer_items(spark, sf_dir):
    """All links of each page; pages without one keep a row."""
    links = F.regexp_extract_all("html", F.lit(LINK), F.lit(1))
    items = F.transform(links, lambda x: F.struct(x.alias("target"), F.length(x).alias("size")))
    pages = feeds.table(spark, sf_dir, "pages").select("page_id", items.alias("links"))
    return n.explode_items(pages, "links", "link").select("page_id", "link.target", "link.size")


def document_lines():
    """Lines of a text as ``{body, kind}``, blank ones without a body."""
    def line(x):
        kind = F.when(F.length(x) == 0, "Blank").when(F.length(x) < 80, "Short").otherwise("Long")
        return F.struct(F.nullif(x, F.lit("")).alias("body"), kind.alias("kind"))

    return F.transform(F.split("text", "\n"), line)


@query("""
select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), ', ') as joined from documents""")
def array_flatten_string(spark, sf_dir):
    docs = feeds.table(spark, sf_dir, "documents").select("doc_id", document_lines().alias("lines"))
    return docs.select("doc_id", n.join_field("lines", "body").alias("joined"))


@query("""
select doc_id, cast(len(l) as integer) as total, cast(len(list_filter(l, lambda x: length(x) >= 80)) as integer) as long,
  cast(len(list_filter(l, lambda x: length(x) > 0 and length(x) < 80)) as integer) as short, 0 as other
from (select doc_id, string_split(text, chr(10)) as l from documents)""")
def array_category_counts(spark, sf_dir):
    docs = feeds.table(spark, sf_dir, "documents").select("doc_id", document_lines().alias("lines"))
    counts = {k: n.count_items_where("lines", "kind", k) for k in ("long", "short", "other")}
    return docs.select("doc_id", n.count_items("lines").alias("total"), *(v.alias(k) for k, v in counts.items()))


@query(f"""
select event_id, event_type as type, cast({sql.K} as varchar) as k, cast(user_id as varchar) as user,
  cast(null as varchar) as absent from events""")
def kv_extract(spark, sf_dir):
    def entry(key, value):
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    events = feeds.events_with_k(spark, sf_dir).select(
        "event_id",
        F.array(entry("Type", F.col("event_type")), entry("K", F.col("k")), entry("User", F.col("user_id")), entry("Type", F.lit("second"))).alias("p"),
    )
    return events.select("event_id", *n.property_columns("p", ["Type", "K", "User", "Absent"]))


@query("""
select c_name, c_mktsegment, row_number() over (partition by c_acctbal > 5000 order by c_name) - 1
  + case when c_acctbal > 5000 then 0 else (select count(*) from customer where c_acctbal > 5000) end as customer_key
from customer""")
def surrogate_keys(spark, sf_dir):
    """A first build of the wealthier customers, then a refresh that adds the others."""
    members = feeds.table(spark, sf_dir, "customer").select("c_name", "c_mktsegment", "c_acctbal")
    first = materialise(assign_keys(members.where("c_acctbal > 5000"), ["c_name"], "customer_key"), "dimension")
    return assign_keys(members, ["c_name"], "customer_key", first).drop("c_acctbal")
