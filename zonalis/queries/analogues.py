"""The driver's tables in the shape of vote, census and polygon files.

Suppliers stand for circuits, orders for ballot boxes, line items for ballots, customers for tracts.
Each function has a SQL twin that the oracles build on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonalis.operators.geometry import box_ring
from zonalis.plans.votes import PRESIDENT

TRACTS_PER_ROW = 50
CIRCUITS_PER_ROW = 12


def district(supplier: str) -> str:
    """District of a supplier, as SQL text both engines read."""
    return f"lpad(CAST({supplier} % 3 + 1 AS STRING), 2, '0')"


def section(supplier: str) -> str:
    return f"lpad(CAST({supplier} % 5 AS STRING), 3, '0')"


# -- 2019 layout ---------------------------------------------------------------------------------


def ballots(lineitem: DataFrame, status: str) -> DataFrame:
    place, part = district("l_suppkey"), section("l_suppkey")
    return lineitem.selectExpr(
        f"if(l_linestatus = '{status}', '{PRESIDENT}', '000200000000000') AS codigo_categoria",
        f"{place} AS codigo_distrito",
        f"concat({place}, {part}) AS codigo_seccion",
        f"concat({place}, {part}, lpad(CAST(l_suppkey AS STRING), 6, '0')) AS codigo_circuito",
        "CAST(l_orderkey AS STRING) AS codigo_mesa",
        "l_returnflag AS codigo_agrupacion",
        "CAST(l_quantity AS BIGINT) AS votos_agrupacion",
    )


def ballots_sql(status: str) -> str:
    return f"""
    select case when l_linestatus = '{status}' then '{PRESIDENT}' else '000200000000000' end as codigo_categoria,
           lpad((l_suppkey % 3 + 1)::varchar, 2, '0') as codigo_distrito,
           lpad((l_suppkey % 3 + 1)::varchar, 2, '0') || lpad((l_suppkey % 5)::varchar, 3, '0') as codigo_seccion,
           lpad((l_suppkey % 3 + 1)::varchar, 2, '0') || lpad((l_suppkey % 5)::varchar, 3, '0')
             || lpad(l_suppkey::varchar, 6, '0') as codigo_circuito,
           l_orderkey::varchar as codigo_mesa, l_returnflag as codigo_agrupacion,
           l_quantity::bigint as votos_agrupacion
    from lineitem"""


def box_totals(orders: DataFrame, blank: str) -> DataFrame:
    """Blank votes per box, without a row for a few boxes, and void votes for all."""
    counters = f"if(o_orderkey % 5000 <> 17, array('{blank}', 'Voto nulo'), array('Voto nulo'))"
    return orders.selectExpr(
        f"'{PRESIDENT}' AS codigo_categoria",
        "CAST(o_orderkey AS STRING) AS codigo_mesa",
        "o_orderkey AS ordinal",
        "floor(o_totalprice / 10000) AS valor",
        f"explode({counters}) AS contador",
    )


def box_totals_sql(blank: str) -> str:
    return f"""
    select '{PRESIDENT}' as codigo_categoria, o_orderkey::varchar as codigo_mesa, '{blank}' as contador,
           floor(o_totalprice / 10000)::bigint as valor, o_orderkey as ordinal
    from orders where o_orderkey % 5000 <> 17
    union all
    select '{PRESIDENT}', o_orderkey::varchar, 'Voto nulo', floor(o_totalprice / 10000)::bigint, o_orderkey
    from orders"""


def parties_2019(lineitem: DataFrame) -> DataFrame:
    """Several rows per party code; the first by ``ordinal`` names it."""
    return lineitem.select("l_returnflag", "l_linenumber").distinct().selectExpr(
        f"'{PRESIDENT}' AS codigo_categoria",
        "l_returnflag AS codigo_agrupacion",
        "CASE l_returnflag WHEN 'A' THEN 'FRENTE DE TODOS' WHEN 'N' THEN 'JUNTOS POR EL CAMBIO'"
        " ELSE concat('PARTIDO ', l_linenumber) END AS nombre_agrupacion",
        "l_linenumber AS ordinal",
    )


PARTIES_2019_SQL = f"""
    select distinct '{PRESIDENT}' as codigo_categoria, l_returnflag as codigo_agrupacion,
           case l_returnflag when 'A' then 'FRENTE DE TODOS' when 'N' then 'JUNTOS POR EL CAMBIO'
                else 'PARTIDO ' || l_linenumber end as nombre_agrupacion, l_linenumber as ordinal
    from lineitem"""


def regions(supplier: DataFrame) -> DataFrame:
    """Districts and sections in one table."""
    place, part = district("s_suppkey"), section("s_suppkey")
    return supplier.selectExpr(
        f"inline(array(struct({place} AS codigo_region, concat('Distrito ', {place}) AS nombre_region),"
        f" struct(concat({place}, {part}) AS codigo_region, concat('Seccion ', {part}) AS nombre_region)))"
    ).distinct()


REGIONS_SQL = """
    select distinct lpad((s_suppkey % 3 + 1)::varchar, 2, '0') as codigo_region,
           'Distrito ' || lpad((s_suppkey % 3 + 1)::varchar, 2, '0') as nombre_region from supplier
    union all
    select distinct lpad((s_suppkey % 3 + 1)::varchar, 2, '0') || lpad((s_suppkey % 5)::varchar, 3, '0'),
           'Seccion ' || lpad((s_suppkey % 5)::varchar, 3, '0') from supplier"""


# -- 2015 layout ---------------------------------------------------------------------------------


def votes_2015(lineitem: DataFrame, status: str, province: str) -> DataFrame:
    """One file: votes as text, a few of them not a number; code 9004 blank, 9001 another special code."""
    place = district("l_suppkey")
    return lineitem.filter(f"l_linestatus = '{status}' AND {place} = '{province}'").selectExpr(
        f"{place} AS `codigo provincia`",
        f"{section('l_suppkey')} AS `codigo departamento`",
        "CAST(l_suppkey AS STRING) AS `codigo circuito`",
        "CAST(CASE l_linenumber WHEN 7 THEN 9004 WHEN 6 THEN 9001 ELSE l_partkey % 6 + 100 END AS STRING)"
        " AS `codigo votos`",
        "if(l_quantity = 50 AND l_partkey % 100 = 7 AND l_linenumber = 3, 'x', CAST(l_quantity AS STRING)) AS votos",
    )


def votes_2015_sql(status: str) -> str:
    return f"""
    select lpad((l_suppkey % 3 + 1)::varchar, 2, '0') as prov, lpad((l_suppkey % 5)::varchar, 3, '0') as dep,
           l_suppkey::varchar as circ,
           case when l_linenumber = 7 then 9004 when l_linenumber = 6 then 9001 else l_partkey % 6 + 100 end as code,
           case when l_quantity = 50 and l_partkey % 100 = 7 and l_linenumber = 3 then null
                else l_quantity::bigint end as votes
    from lineitem where l_linestatus = '{status}' and l_suppkey % 3 + 1 in (1, 2)"""


def parties_2015(part: DataFrame) -> DataFrame:
    """Codes 103 and 104 are listed twice, 105 not at all."""
    listed = part.filter("p_partkey % 6 <> 5").selectExpr(
        "p_partkey % 6 AS code", "if(p_partkey % 6 IN (3, 4), p_size % 2, 0) AS twin"
    )
    return listed.distinct().selectExpr(
        "concat('0', code + 100) AS codigo_partido",
        "CAST(twin AS STRING) AS lista_interna",
        "'AGRUPACION' AS agrupacion",
        "CASE code WHEN 0 THEN 'ALIANZA CAMBIEMOS' WHEN 1 THEN 'ALIANZA FRENTE PARA LA VICTORIA'"
        " WHEN 2 THEN 'ALIANZA UNIDOS POR UNA NUEVA ALTERNATIVA (UNA)' WHEN 3 THEN concat('PARTIDO ', twin)"
        " ELSE 'PARTIDO 2' END AS denominacion",
    )


PARTIES_2015_SQL = """
    select distinct 100 + p_partkey % 6 as code, case when p_partkey % 6 in (3, 4) then p_size % 2 else 0 end as twin,
           case p_partkey % 6 when 0 then 'Cambiemos' when 1 then 'Frente Para la Victoria' when 2 then 'UNA'
                else 'Otros' end as label
    from part where p_partkey % 6 <> 5"""


# -- census --------------------------------------------------------------------------------------


def _category_file(orders: DataFrame, category: str, headers: dict[str, str]) -> DataFrame:
    """Counts per tract and category under the original headers, with TOTAL."""
    counts = [F.expr(f"count_if({category} = '{code}') AS `{header}`") for code, header in headers.items()]
    codes = ", ".join(f"'{code}'" for code in headers)
    return orders.groupBy(F.expr("CAST(o_custkey AS STRING) AS radio")).agg(
        *counts, F.expr(f"count_if({category} IN ({codes})) AS TOTAL")
    )


PRIORITY_HEADERS = {
    "1-URGENT": "1 URGENT",
    "2-HIGH": "2 HIGH",
    "3-MEDIUM": "3 MEDIUM",
    "4-NOT SPECIFIED": "4 NOT SPECIFIED",
    "5-LOW": "5 LOW",
}
STATUS_HEADERS = {"F": "1 Filled", "O": "2 Open", "P": "3 Partly open"}
PRICE_HEADERS = {"low": "1 Urbano", "high": "2 Rural"}
SERVICE_HEADERS = {"con": "1 Con", "sin": "2 Sin"}
YEAR_HEADERS = {str(y): f"{y - 1994 if y < 2001 else 10} {y}" for y in range(1995, 2002)}
PREFIXES = {
    "priority": "per_prio_",
    "status": "ho_stat_",
    "service": "ho_serv_",
    "price": "vi_urban_",
    "year": "vi_year_",
}


def census_files(orders: DataFrame) -> dict[str, DataFrame]:
    """Files of one variable each, as they are before the header rule."""
    return {
        "priority": _category_file(orders, "o_orderpriority", PRIORITY_HEADERS),
        "status": _category_file(orders, "o_orderstatus", STATUS_HEADERS),
        "service": _category_file(orders, "if(o_orderkey % 10 <> 0, 'con', 'sin')", SERVICE_HEADERS),
        "price": _category_file(orders, "if(o_totalprice < 250000, 'low', 'high')", PRICE_HEADERS),
        "year": _category_file(orders, "CAST(year(o_orderdate) AS STRING)", YEAR_HEADERS),
    }


CENSUS_COLUMNS = {
    "per_prio_URGENT": "o_orderpriority = '1-URGENT'",
    "per_prio_HIGH": "o_orderpriority = '2-HIGH'",
    "per_prio_MEDIUM": "o_orderpriority = '3-MEDIUM'",
    "per_prio_NOT_SPECIFIED": "o_orderpriority = '4-NOT SPECIFIED'",
    "per_prio_LOW": "o_orderpriority = '5-LOW'",
    "ho_stat_Filled": "o_orderstatus = 'F'",
    "ho_stat_Open": "o_orderstatus = 'O'",
    "ho_stat_Partly_open": "o_orderstatus = 'P'",
    "ho_serv_Con": "o_orderkey % 10 <> 0",
    "ho_serv_Sin": "o_orderkey % 10 = 0",
    "vi_urban_Urbano": "o_totalprice < 250000",
    "vi_urban_Rural": "o_totalprice >= 250000",
    **{f"vi_year_{y}": f"year(o_orderdate) = {y}" for y in range(1995, 2001)},
    # the cut position of the first header leaves the space of a two-digit header in the name
    "vi_year__2001": "year(o_orderdate) = 2001",
}


def census_wide_sql() -> str:
    columns = ", ".join(f'count(*) filter ({c})::bigint as "{n}"' for n, c in CENSUS_COLUMNS.items())
    return f"select o_custkey::varchar as radio, {columns} from orders group by 1"


TOTALS = ("vi_TOTAL", "vi_urban_TOTAL", "ho_TOTAL", "per_TOTAL")


# -- geography -----------------------------------------------------------------------------------


def tracts(customer: DataFrame) -> DataFrame:
    """Unit squares side by side, one per customer."""
    k = F.col("c_custkey")
    x, y = k % TRACTS_PER_ROW, F.floor(k / TRACTS_PER_ROW)
    return customer.select(
        k.alias("id"), k.cast("string").alias("id_radio"), F.array(box_ring(x, y, x + 1, y + 1)).alias("rings")
    )


TRACTS_SQL = f"""
    select c_custkey as id, c_custkey::varchar as id_radio, (c_custkey % {TRACTS_PER_ROW})::double as x0,
           floor(c_custkey / {TRACTS_PER_ROW})::double as y0, (c_custkey % {TRACTS_PER_ROW})::double + 1 as x1,
           floor(c_custkey / {TRACTS_PER_ROW})::double + 1 as y1
    from customer"""


def circuits(supplier: DataFrame) -> DataFrame:
    """Boxes of 5 by 4 on a 4.5 by 3.5 raster, one per supplier; neighbours overlap."""
    k = F.col("s_suppkey")
    x, y = k % CIRCUITS_PER_ROW * 4.5 - 1, F.floor(k / CIRCUITS_PER_ROW) * 3.5
    return supplier.select(
        k.alias("id"),
        F.expr(district("s_suppkey")).alias("indec_p"),
        F.expr(section("s_suppkey")).alias("indec_d"),
        k.cast("string").alias("circuito"),
        F.array(box_ring(x, y, x + 5, y + 4)).alias("rings"),
    )


CIRCUITS_SQL = f"""
    select s_suppkey as id, lpad((s_suppkey % 3 + 1)::varchar, 2, '0') as indec_p,
           lpad((s_suppkey % 5)::varchar, 3, '0') as indec_d, s_suppkey::varchar as circuito,
           s_suppkey % {CIRCUITS_PER_ROW} * 4.5::double - 1 as x0, floor(s_suppkey / {CIRCUITS_PER_ROW}) * 3.5::double as y0,
           s_suppkey % {CIRCUITS_PER_ROW} * 4.5::double + 4 as x1, floor(s_suppkey / {CIRCUITS_PER_ROW}) * 3.5::double + 4 as y1
    from supplier"""

PADDED_CIRCUITS_SQL = """
    select *, indec_p || indec_d || lpad(circuito, 6, '0') as id_circuito from circuits
    where length(circuito) between 2 and 6"""


def polling_places(lineitem: DataFrame) -> DataFrame:
    """Points inside the box of the line's supplier, labelled with that supplier's section."""
    k = F.col("l_suppkey")
    x = k % CIRCUITS_PER_ROW * 4.5 - 1 + F.col("l_linenumber") * 0.625
    y = F.floor(k / CIRCUITS_PER_ROW) * 3.5 + F.round(F.col("l_discount") * 100).cast("int") * 0.375
    return lineitem.select(
        (k % 3 + 1).alias("id_distrito"), (k % 5).alias("id_seccion"), x.alias("x"), y.alias("y")
    )


PLACES_SQL = f"""
    select lpad((l_suppkey % 3 + 1)::varchar, 2, '0') || lpad((l_suppkey % 5)::varchar, 3, '0') as id_seccion_elec,
           l_suppkey % {CIRCUITS_PER_ROW} * 4.5::double - 1 + l_linenumber * 0.625::double as x,
           floor(l_suppkey / {CIRCUITS_PER_ROW}) * 3.5::double + round(l_discount * 100)::int * 0.375::double as y
    from lineitem"""
