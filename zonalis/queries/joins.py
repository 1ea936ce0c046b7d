"""Joins and group values attached to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonalis.functions import strict_sum
from zonalis.operators.joins import attach_group_values, join_fold, left_join
from zonalis.plans.census import census_wide
from zonalis.plans.geography import best_matches, overwrite_province
from zonalis.plans.votes import box_table
from zonalis.queries.analogues import (
    PARTIES_2019_SQL,
    PREFIXES,
    REGIONS_SQL,
    ballots,
    ballots_sql,
    box_totals,
    box_totals_sql,
    census_files,
    census_wide_sql,
    parties_2015,
    PARTIES_2015_SQL,
    parties_2019,
    regions,
)
from zonalis.queries.registry import Tables, query
from zonalis.sources.text import category_columns, total_column


@query(
    """select o_orderkey, o_custkey, c_name, c_nationkey from orders
       left join (select * from customer where c_acctbal > 0) on o_custkey = c_custkey"""
)
def join_left(t: Tables) -> DataFrame:
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return t.orders.select("o_orderkey", "o_custkey").join(known, "o_custkey", "left")


@query(
    """with a as (select l_suppkey % 3 as prov, l_suppkey % 5 as dep, l_suppkey as circ, sum(l_quantity)::bigint as votes
                  from lineitem where l_returnflag <> 'R' group by all),
            b as (select l_suppkey % 3 as prov, l_suppkey % 5 as dep, l_suppkey as circ, sum(l_quantity)::bigint as blanks
                  from lineitem where l_returnflag = 'R' and l_suppkey % 7 <> 0 group by all)
       select prov, dep, circ, votes, blanks from a left join b using (prov, dep, circ)"""
)
def join_left_composite(t: Tables) -> DataFrame:
    s = F.col("l_suppkey")
    keys = ["prov", "dep", "circ"]
    votes = F.col("l_quantity").cast("bigint").alias("q")
    rows = t.lineitem.select((s % 3).alias("prov"), (s % 5).alias("dep"), s.alias("circ"), "l_returnflag", votes)
    votes = rows.filter("l_returnflag <> 'R'").groupBy(*keys).agg(F.sum("q").alias("votes"))
    blanks = rows.filter("l_returnflag = 'R' and circ % 7 <> 0").groupBy(*keys).agg(F.sum("q").alias("blanks"))
    return votes.join(blanks, keys, "left")


_ROLE_SQL = f"""
    with votes as (select * from ({ballots_sql('F')}) where codigo_categoria = '000100000000000'),
         totals as ({box_totals_sql('Voto blanco')}), regions as ({REGIONS_SQL}),
         parties as (select codigo_agrupacion, arg_min(nombre_agrupacion, ordinal) as nombre_agrupacion
                     from ({PARTIES_2019_SQL}) group by 1),
         named as (select *, sum(votos_agrupacion) over (partition by codigo_mesa) as en_mesa from votes)
    select codigo_distrito, d.nombre_region as name_distrito, codigo_seccion, s.nombre_region as name_seccion,
           codigo_circuito, n.codigo_mesa, b.valor as votos_blanco, (en_mesa + b.valor)::bigint as votos_validos,
           codigo_agrupacion, nombre_agrupacion, votos_agrupacion
    from named n
    left join (select * from totals where contador = 'Voto blanco') b on n.codigo_mesa = b.codigo_mesa
    left join regions d on d.codigo_region = codigo_distrito
    left join regions s on s.codigo_region = codigo_seccion
    left join parties using (codigo_agrupacion)"""


@query(_ROLE_SQL)
def join_role_playing(t: Tables) -> DataFrame:
    """The box table: one region table joined as district and as section."""
    return box_table(
        ballots(t.lineitem, "F"),
        box_totals(t.orders, "Voto blanco"),
        parties_2019(t.lineitem),
        regions(t.supplier),
        "Voto blanco",
    )


_TOTALS_SQL = """
    select o_custkey::varchar as radio, count(*)::bigint as "vi_TOTAL", count(*)::bigint as "vi_urban_TOTAL",
           count(*)::bigint as "ho_TOTAL", count(*)::bigint as "per_TOTAL" from orders group by 1"""


@query(_TOTALS_SQL)
def join_nway_left(t: Tables) -> DataFrame:
    files = census_files(t.orders)
    prefixes = {"year": "vi_", "price": "vi_urban_", "status": "ho_", "priority": "per_"}
    return join_fold([total_column(files[name], prefix) for name, prefix in prefixes.items()], ["radio"])


@query(
    """select o_custkey, o_orderkey from orders where exists
       (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)"""
)
def join_semi(t: Tables) -> DataFrame:
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_custkey", "o_orderkey").join(known, "o_custkey", "left_semi")


@query(
    f"""select l_orderkey, l_linenumber, 100 + l_partkey % 6 as code, label
        from lineitem left join ({PARTIES_2015_SQL}) p on p.code = 100 + l_partkey % 6"""
)
def join_fanout(t: Tables) -> DataFrame:
    """The right side lists some codes twice; both rows are kept."""
    from zonalis.functions import as_integer, recode
    from zonalis.plans.votes import LABELS_2015, OTHERS

    listed = parties_2015(t.part).select(
        as_integer(F.col("codigo_partido")).alias("code"),
        recode(F.col("denominacion"), LABELS_2015, OTHERS).alias("label"),
    )
    votes = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 6 + 100).alias("code"))
    return left_join(votes, listed, ["code"])


@query(
    """select l_orderkey, l_linenumber, l_partkey, l_quantity::bigint as q,
              case when count(*) over w = count(l_quantity) filter (l_linenumber <> 7) over w
                   then sum(l_quantity::bigint) over w end::bigint as strict_total,
              (sum(l_quantity::bigint) over w)::bigint as total
       from lineitem window w as (partition by l_orderkey)"""
)
def win_total(t: Tables) -> DataFrame:
    q = F.col("q")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
    gapped = F.when(F.col("l_linenumber") != 7, q)
    return attach_group_values(rows, ["l_orderkey"], {"strict_total": strict_sum(gapped), "total": F.sum(q)})


@query(
    """select o_custkey, o_orderkey, count(*) over w as n, max(o_totalprice) over w as top from orders
       window w as (partition by o_custkey)"""
)
def win_count_max(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return attach_group_values(
        rows, ["o_custkey"], {"n": F.count(F.lit(1)), "top": F.max("o_totalprice")}
    ).drop("o_totalprice")


@query(
    """with c as (select l_partkey % 500 as a, l_suppkey as b, count(*) as n from lineitem group by all)
       select lpad(a::varchar, 5, '0') as id_seccion_elec, lpad(b::varchar, 5, '0') as id_seccion_indec
       from (select *, rank() over (partition by a order by n desc) as r from c) where r = 1"""
)
def win_argmax_ties(t: Tables) -> DataFrame:
    matches = t.lineitem.groupBy(
        F.lpad((F.col("l_partkey") % 500).cast("string"), 5, "0").alias("id_seccion_elec"),
        F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("id_seccion_indec"),
    ).agg(F.count(F.lit(1)).alias("count"))
    return best_matches(matches)


@query(
    """select c_custkey, c_nationkey as source_file,
              case when max((c_custkey % 211 = 0)::int) over (partition by c_nationkey) = 1 then '63'
                   else lpad((c_nationkey % 3)::varchar, 2, '0') end as indec_p
       from customer"""
)
def win_any_overwrite(t: Tables) -> DataFrame:
    """One file per nation; the province is named on a few rows of some files."""
    named = F.when(F.col("c_custkey") % 211 == 0, F.lit("Río Negro")).otherwise(F.lit("Otra"))
    rows = t.customer.select(
        "c_custkey",
        F.col("c_nationkey").alias("source_file"),
        named.alias("provincia"),
        F.lpad((F.col("c_nationkey") % 3).cast("string"), 2, "0").alias("indec_p"),
    )
    return overwrite_province(rows).drop("provincia")


@query(census_wide_sql())
def census_table(t: Tables) -> DataFrame:
    """All category files as one wide table."""
    files = census_files(t.orders)
    return census_wide([category_columns(files[n], p) for n, p in PREFIXES.items()])


@query(_TOTALS_SQL)
def census_totals(t: Tables) -> DataFrame:
    """The denominators, through the long form."""
    files = census_files(t.orders)
    prefixes = {"year": "vi_", "price": "vi_urban_", "status": "ho_", "priority": "per_"}
    return census_wide([total_column(files[name], prefix) for name, prefix in prefixes.items()])


