"""Predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonalis.functions import null_if_nan
from zonalis.operators.statistics import complete_rows
from zonalis.queries.registry import Tables, query


@query("select l_orderkey, l_quantity from lineitem where l_linestatus = 'F' and l_returnflag = 'A'")
def filt_and(t: Tables) -> DataFrame:
    return t.lineitem.filter((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")).select("l_orderkey", "l_quantity")


@query("select l_orderkey, l_discount from lineitem where l_discount > 0.001 and l_quantity < 25")
def filt_range(t: Tables) -> DataFrame:
    return t.lineitem.filter((F.col("l_discount") > 0.001) & (F.col("l_quantity") < 25)).select("l_orderkey", "l_discount")


@query("select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '5-LOW')")
def filt_in(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", "o_orderpriority")


@query(
    """select p_partkey, p_name from part
       where starts_with(p_name, 'blue') or starts_with(p_name, 'red') and not starts_with(p_type, 'ECO')"""
)
def filt_prefix(t: Tables) -> DataFrame:
    name, kind = F.col("p_name"), F.col("p_type")
    kept = name.startswith("blue") | (name.startswith("red") & ~kind.startswith("ECO"))
    return t.part.filter(kept).select("p_partkey", "p_name")


@query(
    """select o_orderkey, case when o_orderstatus <> 'P' then o_totalprice end as x from orders
       where not (o_orderpriority = '5-LOW' and case when o_orderstatus <> 'P' then o_totalprice end < 75000)"""
)
def filt_not_and(t: Tables) -> DataFrame:
    """A row whose predicate is NULL is dropped."""
    df = t.orders.withColumn("x", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    return df.filter(~((F.col("o_orderpriority") == "5-LOW") & (F.col("x") < 75000))).select("o_orderkey", "x")


@query("select o_orderkey, o_totalprice as x from orders where o_orderstatus = 'F' and o_totalprice >= 0")
def filt_not_null(t: Tables) -> DataFrame:
    """NaN counts as missing."""
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).when(
        F.col("o_orderstatus") == "O", F.lit(float("nan"))
    )
    return t.orders.select("o_orderkey", null_if_nan(price).alias("x")).filter(F.col("x").isNotNull())


@query("select user_id, event_id from events where case when user_id % 5 = 0 then null else event_type end <> 'view'")
def filt_ne(t: Tables) -> DataFrame:
    """A missing value is not kept either."""
    kind = F.when(F.col("user_id") % 5 != 0, F.col("event_type"))
    return t.events.filter(kind != "view").select("user_id", "event_id")


@query(
    """select o_orderkey, o_totalprice as price, floor(o_totalprice / 1000)::bigint as thousands from orders
       where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'"""
)
def filt_drop_na(t: Tables) -> DataFrame:
    nan = F.lit(float("nan"))
    price = F.when(F.col("o_orderpriority") == "5-LOW", nan).otherwise(F.col("o_totalprice"))
    thousands = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1000))
    return complete_rows(t.orders.select("o_orderkey", price.alias("price"), thousands.alias("thousands")))
