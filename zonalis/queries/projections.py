"""Projections and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonalis.operators import selectors as sel
from zonalis.operators.geometry import box_ring
from zonalis.operators.statistics import category_rank
from zonalis.plans.geography import without_geometry
from zonalis.plans.reports import CHANGES, with_changes
from zonalis.queries.analogues import census_files
from zonalis.queries.registry import Tables, query
from zonalis.sources.text import category_columns


@query("select o_custkey, o_orderkey, o_orderpriority from orders")
def proj_select(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", "o_orderpriority")


@query("select c_custkey, c_nationkey, c_acctbal from customer")
def proj_drop(t: Tables) -> DataFrame:
    return t.customer.drop("c_name", "c_mktsegment")


@query(
    """select l_shipdate, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_orderkey, l_partkey,
              l_suppkey, l_returnflag, l_linestatus
       from lineitem"""
)
def proj_selectors(t: Tables) -> DataFrame:
    """Suffix, range, list, exclusion and the rest."""
    df = t.lineitem
    keys = sel.without(sel.ends_with(df, "KEY"), [])
    flags = sel.without(sel.starts_with(df, "L_RETURN", "l_lines"), keys)
    numbers = sel.between(df, "l_linenumber", "l_tax")
    return df.select(*sel.everything(df.select(*sel.one_of(df, ["l_shipdate"]), *numbers, *keys, *flags), "l_shipdate"))


@query("select n_nationkey as id, n_name as name, n_regionkey from nation")
def proj_rename(t: Tables) -> DataFrame:
    return t.nation.withColumnsRenamed({"n_nationkey": "id", "n_name": "name"})


@query(
    """select l_orderkey, l_linenumber, round(l_quantity * l_tax, 6) as taxed, l_partkey + l_suppkey as both
       from lineitem"""
)
def proj_mutate(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_quantity") * F.col("l_tax"), 6).alias("taxed"),
        (F.col("l_partkey") + F.col("l_suppkey")).alias("both"),
    )


@query("select o_orderkey, 2019 as year, 'FdT' as facet from orders")
def proj_literal(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.lit(2019).alias("year"), F.lit("FdT").alias("facet"))


@query("select s_suppkey as id, s_nationkey as province from supplier")
def proj_drop_geometry(t: Tables) -> DataFrame:
    """Polygons as a plain table of their attributes."""
    x, y = F.col("s_suppkey").cast("double"), F.col("s_nationkey").cast("double")
    polygons = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("province"), box_ring(x, y, x + 1, y + 1).alias("ring"))
    return without_geometry(polygons.select("id", "province", F.array("ring").alias("rings")))


@query(
    """select o_custkey::varchar as radio,
              count(*) filter (year(o_orderdate) = 1995)::bigint as "vi_year_1995",
              count(*) filter (year(o_orderdate) = 1996)::bigint as "vi_year_1996",
              count(*) filter (year(o_orderdate) = 1997)::bigint as "vi_year_1997",
              count(*) filter (year(o_orderdate) = 1998)::bigint as "vi_year_1998",
              count(*) filter (year(o_orderdate) = 1999)::bigint as "vi_year_1999",
              count(*) filter (year(o_orderdate) = 2000)::bigint as "vi_year_2000",
              count(*) filter (year(o_orderdate) = 2001)::bigint as "vi_year__2001"
       from orders group by 1"""
)
def proj_header_parse(t: Tables) -> DataFrame:
    return category_columns(census_files(t.orders)["year"], "vi_year_")


@query("select l_orderkey as id_mesa, l_quantity as votos, l_returnflag as partido from lineitem")
def proj_dictionary(t: Tables) -> DataFrame:
    dictionary = [
        ("l_orderkey", 1, "id_mesa"),
        ("l_tax", 0, ""),
        ("l_quantity", 1, "votos"),
        ("l_shipdate", 0, ""),
        ("l_returnflag", 1, "partido"),
    ]
    return sel.dictionary_projection(t.lineitem, dictionary)


@query(
    """select l_orderkey, l_linenumber, l_quantity * 2 as l_quantity, round(l_discount * 2, 4) as l_discount,
              round(l_tax * 2, 4) as l_tax
       from lineitem"""
)
def proj_across(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return sel.across(df, sel.starts_with(df, "L_QUANT", "l_disc", "l_tax"), lambda c: F.round(c * 2, 4))


_SERIES = {
    "paso19_cand_FdT": "l_quantity",
    "paso15_cand_FPV": "l_linenumber::double",
    "pres15_cand_FPV": "l_partkey % 100",
    "paso19_cand_JxC": "50 - l_quantity",
    "paso15_cand_Cam": "l_suppkey % 50",
    "pres15_cand_Cam": "l_orderkey % 70",
}


@query(
    "select l_orderkey, l_linenumber, "
    + ", ".join(f"(({_SERIES[a]}) - ({_SERIES[b]}))::double as {name}" for name, (a, b) in CHANGES.items())
    + " from lineitem"
)
def feat_change(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("paso19_cand_FdT"),
        F.col("l_linenumber").cast("double").alias("paso15_cand_FPV"),
        (F.col("l_partkey") % 100).cast("double").alias("pres15_cand_FPV"),
        (50 - F.col("l_quantity")).alias("paso19_cand_JxC"),
        (F.col("l_suppkey") % 50).cast("double").alias("paso15_cand_Cam"),
        (F.col("l_orderkey") % 70).cast("double").alias("pres15_cand_Cam"),
    )
    return with_changes(df).select("l_orderkey", "l_linenumber", *CHANGES)


@query(
    """select o_orderpriority, case when o_totalprice < 2000 then null else o_totalprice end as price, o_orderkey
       from orders order by o_orderpriority, price desc nulls last, o_orderkey"""
)
def sort_multi(t: Tables) -> DataFrame:
    price = F.when(F.col("o_totalprice") >= 2000, F.col("o_totalprice"))
    return t.orders.select("o_orderpriority", price.alias("price"), "o_orderkey").orderBy(
        "o_orderpriority", F.desc_nulls_last("price"), "o_orderkey"
    )


@query(
    """select event_type, case event_type when 'purchase' then 0 when 'view' then 1 else 2 end as event_type_rank,
              count(*) as n
       from events group by 1 order by 2, 1"""
)
def sort_category(t: Tables) -> DataFrame:
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    ranked = counts.withColumn("event_type_rank", category_rank(F.col("event_type"), ["purchase", "view"]))
    return ranked.orderBy("event_type_rank", "event_type")
