"""Aggregates, pivots and the vote roll-ups built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonalis.functions import first_by, percent_of, recode, skipna_sum, strict_sum, strict_sum_where
from zonalis.operators.joins import spread
from zonalis.operators.reshape import to_long, to_wide
from zonalis.plans.final import census_percentages
from zonalis.plans.votes import LABELS_2019, OTHERS, SHORT_2015, SHORT_2019, circuits_2015, circuits_2019, wide
from zonalis.queries.analogues import (
    PARTIES_2015_SQL,
    PARTIES_2019_SQL,
    REGIONS_SQL,
    ballots,
    ballots_sql,
    box_totals,
    box_totals_sql,
    parties_2015,
    parties_2019,
    regions,
    votes_2015,
    votes_2015_sql,
)
from zonalis.queries.registry import Tables, query


@query("select l_suppkey, l_returnflag, sum(l_quantity)::bigint as votes from lineitem group by 1, 2")
def agg_sum(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("votes"))


@query(
    """select o_custkey, case when count(*) = count(*) filter (o_orderstatus <> 'P')
                              then sum(floor(o_totalprice / 10000)::bigint) end::bigint as blank
       from orders group by 1"""
)
def agg_sum_strict(t: Tables) -> DataFrame:
    blank = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 10000))
    return t.orders.groupBy("o_custkey").agg(strict_sum(blank).alias("blank"))


@query(
    """select o_custkey, coalesce(sum(floor(o_totalprice / 10000)::bigint) filter (o_orderstatus = 'P'), 0)::bigint as blank
       from orders group by 1"""
)
def agg_sum_skipna(t: Tables) -> DataFrame:
    blank = F.when(F.col("o_orderstatus") == "P", F.floor(F.col("o_totalprice") / 10000))
    return t.orders.groupBy("o_custkey").agg(skipna_sum(blank).alias("blank"))


@query(
    """select user_id, arg_min_null(case when event_id % 3 = 0 then null else event_type end, event_id) as first_type
       from events group by 1"""
)
def agg_first(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    return t.events.groupBy("user_id").agg(first_by(kind, F.col("event_id")).alias("first_type"))


@query(
    """with box as (select l_suppkey, l_orderkey, max(o_totalprice) as p, any_value(o_orderstatus) as s
                    from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
       select l_suppkey, sum(floor(p / 10000)::bigint)::bigint as valid,
              case when count(*) = count(*) filter (l_orderkey % 700 <> 3)
                   then sum((l_orderkey % 50)::bigint) end::bigint as blank
       from box group by 1"""
)
def agg_two_level(t: Tables) -> DataFrame:
    """A box total repeats on each ballot: once per box, then summed per circuit."""
    lines = t.lineitem.select("l_suppkey", F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    orders = t.orders.select("o_orderkey", F.floor(F.col("o_totalprice") / 10000).alias("valid"))
    blank = F.when(F.col("o_orderkey") % 700 != 3, F.col("o_orderkey") % 50)
    # sort, join and both aggregates of a box are in one task; its rows must not grow with the table
    rows = lines.count()
    lines, orders = (spread(df, ["o_orderkey"], rows) for df in (lines, orders))
    box = (
        lines.join(orders, "o_orderkey")
        .groupBy("l_suppkey", "o_orderkey")
        .agg(first_by(F.col("valid"), F.col("l_linenumber")).alias("valid"), first_by(blank, F.col("l_linenumber")).alias("blank"))
    )
    return box.groupBy("l_suppkey").agg(strict_sum(F.col("valid")).alias("valid"), strict_sum(F.col("blank")).alias("blank"))


@query(
    """with v as (select l_suppkey, l_linenumber as k, case when l_quantity = 50 and l_linenumber = 1 and l_partkey % 50 = 1
                         then null else l_quantity::bigint end as q from lineitem where l_suppkey % 10 <> 4 or l_linenumber <> 7),
       p as (select l_suppkey, case when count(*) = count(q) then sum(q) end::bigint as candidates from v where k < 6 group by 1),
       b as (select l_suppkey, case when count(*) = count(q) then sum(q) end::bigint as blank from v where k = 7 group by 1)
       select distinct l_suppkey, candidates, blank from v left join p using (l_suppkey) left join b using (l_suppkey)"""
)
def agg_conditional(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    bad = (F.col("l_quantity") == 50) & (line == 1) & (F.col("l_partkey") % 50 == 1)
    votes = F.when(~bad, F.col("l_quantity").cast("bigint"))
    rows = t.lineitem.filter((F.col("l_suppkey") % 10 != 4) | (line != 7))
    return rows.groupBy("l_suppkey").agg(
        strict_sum_where(line < 6, votes).alias("candidates"), strict_sum_where(line == 7, votes).alias("blank")
    )


@query(
    """select l_suppkey, label, sum(q)::bigint as votes from (
         select l_suppkey, case l_returnflag when 'A' then 'Frente de Todos' when 'N' then 'Juntos por el Cambio'
                when 'R' then case when l_linenumber < 3 then null else 'Otros' end end as label, l_quantity::bigint as q
         from lineitem) group by 1, 2"""
)
def agg_recode_rollup(t: Tables) -> DataFrame:
    name = (
        F.when(F.col("l_returnflag") == "A", "FRENTE DE TODOS")
        .when(F.col("l_returnflag") == "N", "JUNTOS POR EL CAMBIO")
        .when(F.col("l_linenumber") >= 3, F.concat(F.lit("PARTIDO "), F.col("l_linenumber").cast("string")))
    )
    rows = t.lineitem.select("l_suppkey", recode(name, LABELS_2019, OTHERS).alias("label"), F.col("l_quantity").cast("bigint").alias("q"))
    return rows.groupBy("l_suppkey", "label").agg(strict_sum(F.col("q")).alias("votes"))


@query("select o_custkey, o_orderpriority, count(*) as n from orders group by 1, 2")
def agg_count(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    """select l_suppkey, sum(l_quantity)::bigint as l_quantity, sum(l_linenumber)::bigint as l_linenumber,
              coalesce(sum(l_partkey) filter (l_partkey % 97 = l_suppkey % 97), 0)::bigint as l_partkey
       from lineitem group by 1"""
)
def agg_all_columns(t: Tables) -> DataFrame:
    part = F.when(F.col("l_partkey") % 97 == F.col("l_suppkey") % 97, F.col("l_partkey"))
    rows = t.lineitem.select("l_suppkey", F.col("l_quantity").cast("bigint").alias("l_quantity"), "l_linenumber", part.alias("l_partkey"))
    return rows.groupBy("l_suppkey").agg(*[skipna_sum(F.col(c)).alias(c) for c in rows.columns if c != "l_suppkey"])


@query(
    """select o_custkey, a::double / nullif(n, 0) * 100 as vi_a, u::double / nullif(nu, 0) * 100 as vi_urban_u,
              a::double / nullif(z, 0) * 100 as ho_a
       from (select o_custkey, count(*) as n, count(*) filter (o_orderstatus = 'F') as a,
                    count(*) filter (o_totalprice > 490000) as nu,
                    count(*) filter (o_totalprice > 490000 and o_orderstatus = 'F') as u,
                    count(*) filter (o_orderpriority = '5-LOW') as z from orders group by 1)"""
)
def ratio_percent(t: Tables) -> DataFrame:
    """Each family over its own total; a total of 0 gives NULL."""
    status, price = F.col("o_orderstatus") == "F", F.col("o_totalprice") > 490000
    counts = t.orders.groupBy("o_custkey").agg(
        F.count_if(status).alias("vi_a"),
        F.count(F.lit(1)).alias("vi_TOTAL"),
        F.count_if(price & status).alias("vi_urban_u"),
        F.count_if(price).alias("vi_urban_TOTAL"),
        F.count_if(status).alias("ho_a"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("ho_TOTAL"),
    )
    return census_percentages(counts)


@query(
    """select l_suppkey, max(v) filter (l_returnflag = 'A')::bigint as "A", max(v) filter (l_returnflag = 'N')::bigint as "N"
       from (select l_suppkey, case when l_linenumber < 6 then l_returnflag end as l_returnflag, sum(l_quantity::bigint) as v
             from lineitem group by 1, 2) group by 1"""
)
def reshape_pivot(t: Tables) -> DataFrame:
    flag = F.when(F.col("l_linenumber") < 6, F.col("l_returnflag")).alias("l_returnflag")
    long = t.lineitem.select("l_suppkey", flag, "l_quantity").groupBy("l_suppkey", "l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("v")
    )
    return to_wide(long, ["l_suppkey"], "l_returnflag", "v", ["A", "N"])


@query(
    """select l_orderkey, l_linenumber, facet, x from (
         select l_orderkey, l_linenumber, l_quantity, l_extendedprice, case when l_tax > 0.02 then l_tax end as l_tax
         from lineitem) unpivot include nulls (x for facet in (l_quantity, l_extendedprice, l_tax))"""
)
def reshape_unpivot(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("l_tax", F.when(F.col("l_tax") > 0.02, F.col("l_tax")))
    return to_long(df, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_tax"], "facet", "x")


# -- vote roll-ups -------------------------------------------------------------------------------


def _strict(value: str, over: str = "") -> str:
    return f"(case when count(*) {over} = count({value}) {over} then sum({value}) {over} end)::bigint"


def long_2019_sql(status: str, blank: str) -> str:
    """Row by row with windows and joins, the way the roll-up is defined."""
    return f"""
    with cand as (select *, {_strict('votos_agrupacion', 'over w')} as en_mesa
                  from ({ballots_sql(status)}) where codigo_categoria = '000100000000000'
                  window w as (partition by codigo_mesa)),
         blank as (select * from ({box_totals_sql(blank)}) where contador = '{blank}'),
         regions as ({REGIONS_SQL}),
         names as (select codigo_agrupacion, arg_min(nombre_agrupacion, ordinal) as nombre
                   from ({PARTIES_2019_SQL}) group by 1),
         mesa as (select c.*, b.valor as votos_blanco, b.ordinal, en_mesa + b.valor as votos_validos, nombre
                  from cand c left join blank b on b.codigo_mesa = c.codigo_mesa
                  left join regions d on d.codigo_region = codigo_distrito
                  left join regions s on s.codigo_region = codigo_seccion
                  left join names n on n.codigo_agrupacion = c.codigo_agrupacion),
         box as (select codigo_circuito, codigo_mesa, arg_min_null(votos_blanco, ordinal) as b,
                        arg_min_null(votos_validos, ordinal) as v from mesa group by 1, 2),
         totals as (select codigo_circuito, {_strict('b')} as votos_blanco, {_strict('v')} as votos_validos from box group by 1),
         label as (select codigo_circuito, case nombre when 'FRENTE DE TODOS' then 'Frente de Todos'
                            when 'JUNTOS POR EL CAMBIO' then 'Juntos por el Cambio'
                            else case when nombre is not null then 'Otros' end end as partido, votos_agrupacion
                   from mesa where codigo_distrito in ('01', '02'))
    select 2019 as year, codigo_circuito as id_circuito_elec, votos_blanco, votos_validos, partido,
           {_strict('votos_agrupacion')} as votos_candidatura
    from label left join totals using (codigo_circuito) group by all"""


def long_2015_sql(status: str) -> str:
    return f"""
    with v as ({votes_2015_sql(status)}), p as ({PARTIES_2015_SQL}),
         blanks as (select prov, dep, circ, {_strict('votes')} as blancos from v where code = 9004 group by all),
         cands as (select prov, dep, circ, {_strict('votes')} as candidaturas from v where code < 9000 group by all),
         byparty as (select prov, dep, circ, label as partido, {_strict('votes')} as votos_candidatura
                     from v left join p using (code) where code < 9000 group by all)
    select 2015 as year,
           prov || dep || case length(circ) when 2 then '0000' when 3 then '000' when 4 then '00' when 5 then '0'
                               when 6 then '' else 'NA' end || circ as id_circuito_elec,
           blancos as votos_blanco, blancos + candidaturas as votos_validos, partido, votos_candidatura
    from byparty left join cands using (prov, dep, circ) left join blanks using (prov, dep, circ)"""


def wide_sql(long: str, election: str, short: dict[str, str]) -> str:
    columns = ", ".join(
        f"max(votos_candidatura) filter (partido = '{label}') as \"{election}_cand_{code}\"" for label, code in short.items()
    )
    return f"""
    select id_circuito_elec, votos_blanco as {election}_blanco, votos_validos as {election}_validos, {columns}
    from ({long}) group by 1, 2, 3"""


def pres19_long(t: Tables) -> DataFrame:
    return circuits_2019(
        ballots(t.lineitem, "F"), box_totals(t.orders, "Voto blanco"), parties_2019(t.lineitem), regions(t.supplier), "Voto blanco"
    )


def paso19_long(t: Tables) -> DataFrame:
    return circuits_2019(
        ballots(t.lineitem, "O"), box_totals(t.orders, "VB"), parties_2019(t.lineitem), regions(t.supplier), "VB"
    )


def paso15_long(t: Tables) -> DataFrame:
    return circuits_2015([votes_2015(t.lineitem, "F", "02"), votes_2015(t.lineitem, "F", "01")], parties_2015(t.part))


def pres15_long(t: Tables) -> DataFrame:
    return circuits_2015([votes_2015(t.lineitem, "O", "02"), votes_2015(t.lineitem, "O", "01")], parties_2015(t.part))


LONG_SQL = {
    "pres19": long_2019_sql("F", "Voto blanco"),
    "paso19": long_2019_sql("O", "VB"),
    "paso15": long_2015_sql("F"),
    "pres15": long_2015_sql("O"),
}
WIDE_SQL = {
    name: wide_sql(sql, name, SHORT_2019 if name.endswith("19") else SHORT_2015) for name, sql in LONG_SQL.items()
}


@query(LONG_SQL["pres19"])
def elections_2019_long(t: Tables) -> DataFrame:
    return pres19_long(t)


@query(WIDE_SQL["pres19"])
def elections_2019_wide(t: Tables) -> DataFrame:
    return wide(pres19_long(t), "pres19", SHORT_2019)


@query(WIDE_SQL["paso19"])
def elections_2019_primary(t: Tables) -> DataFrame:
    return wide(paso19_long(t), "paso19", SHORT_2019)


@query(LONG_SQL["paso15"])
def elections_2015_long(t: Tables) -> DataFrame:
    return paso15_long(t)


@query(WIDE_SQL["pres15"])
def elections_2015_wide(t: Tables) -> DataFrame:
    return wide(pres15_long(t), "pres15", SHORT_2015)


@query(WIDE_SQL["paso15"])
def elections_2015_primary(t: Tables) -> DataFrame:
    return wide(paso15_long(t), "paso15", SHORT_2015)


@query(
    f"""select id_circuito_elec, partido, votos_candidatura::double / nullif(votos_validos, 0) * 100 as pct
        from ({LONG_SQL['paso19']})"""
)
def ratio_votes(t: Tables) -> DataFrame:
    """Share of each label in the valid votes of its circuit."""
    return paso19_long(t).select(
        "id_circuito_elec", "partido", percent_of(F.col("votos_candidatura"), F.col("votos_validos")).alias("pct")
    )
