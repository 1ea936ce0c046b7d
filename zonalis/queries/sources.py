"""Sources and sinks: tables are written in a source's layout and read back through its reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from zonalis.operators.reshape import stack
from zonalis.operators.selectors import lower_header
from zonalis.plans.census import fan_in
from zonalis.queries.analogues import CENSUS_COLUMNS, PREFIXES, census_files
from zonalis.queries.registry import Tables, query
from zonalis.schemas import COUNT, TEXT
from zonalis.session import stage_path
from zonalis.sources import geo, links, stage, text


@query(
    """select o_orderkey::varchar as codigo_mesa, o_orderpriority as contador, floor(o_totalprice)::bigint as valor
       from orders"""
)
def src_pipe_csv(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "pipe")
    t.orders.select(
        F.col("o_orderkey").alias("CODIGO_MESA"),
        F.col("o_orderpriority").alias("CONTADOR"),
        F.floor("o_totalprice").alias("VALOR"),
    ).write.option("sep", "|").option("header", True).csv(path)
    schema = T.StructType([T.StructField("valor", COUNT), *text.strings("codigo_mesa", "contador").fields])
    return text.read_pipe(t.spark, path, schema)


@query(
    """select lpad(c_nationkey::varchar, 3, '0') as codigo, c_mktsegment as denominacion, c_acctbal as saldo
       from customer"""
)
def src_semicolon_csv(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "semicolon")
    t.customer.select(
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("CODIGO"),
        F.col("c_mktsegment").alias("DENOMINACION"),
        F.replace(F.format_string("%.2f", "c_acctbal"), F.lit("."), F.lit(",")).alias("SALDO"),
    ).write.option("sep", ";").option("header", True).csv(path)
    schema = text.strings("codigo", "denominacion").add("saldo", T.DoubleType())
    return text.read_semicolon(t.spark, path, schema)


@query("select c_custkey::varchar as radio, replace(c_name, 'Customer#', 'Región Nº ñ') as nombre from customer")
def src_latin1_csv(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "latin1")
    t.customer.select(
        F.col("c_custkey").alias("radio"),
        F.replace("c_name", F.lit("Customer#"), F.lit("Región Nº ñ")).alias("nombre"),
    ).write.option("header", True).option("encoding", text.LATIN1).csv(path)
    return text.read_latin1(t.spark, path)


@query("select n_nationkey, n_name, n_regionkey from nation")
def src_lower_header(t: Tables) -> DataFrame:
    return lower_header(t.nation.toDF(*[c.upper() for c in t.nation.columns]))


@query("select o_custkey, count(*) as n, sum(floor(o_totalprice)::bigint)::bigint as total from orders group by 1")
def src_stage_roundtrip(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "stage")
    totals = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("o_totalprice")).alias("total")
    )
    stage.write_stage(totals, path)
    return stage.read_stage(t.spark, path)


@query(
    """select c_custkey, c_mktsegment, case when c_acctbal < 0 then null else c_acctbal end as c_acctbal from customer"""
)
def sink_semicolon_csv(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "sink")
    text.write_semicolon(
        t.customer.select(
            "c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
        ),
        path,
    )
    schema = text.strings("c_mktsegment").add("c_acctbal", T.DoubleType()).add("c_custkey", COUNT)
    return text.read_semicolon(t.spark, path, schema)


@query(
    """select (user_id % 3 + 1)::bigint as id_distrito, event_type as nombre, user_id::double as x, value as y
       from events"""
)
def src_geojson_points(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "geojson")
    t.events.select(
        F.lit("Feature").alias("type"),
        F.struct((F.col("user_id") % 3 + 1).alias("ID_DISTRITO"), F.col("event_type").alias("NOMBRE")).alias("properties"),
        F.struct(
            F.lit("Point").alias("type"), F.array(F.col("user_id").cast("double"), "value").alias("coordinates")
        ).alias("geometry"),
    ).write.json(path)
    return geo.read_points(t.spark, path, {"ID_DISTRITO": COUNT, "NOMBRE": TEXT})


@query(
    """select lpad((s_nationkey % 7 + 1)::varchar, 2, '0') as province, count(*) as n, sum(s_suppkey)::bigint as keys
       from supplier where s_nationkey % 7 + 1 in (1, 2) group by 1"""
)
def src_partition_prune(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "polygons")
    coded = t.supplier.withColumn("province", F.lpad((F.col("s_nationkey") % 7 + 1).cast("string"), 2, "0"))
    stage.write_stage(coded, path, "province")
    kept = geo.read_provinces(t.spark, path, ["01", "02"])
    return kept.groupBy("province").agg(F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("keys"))


# the pages of the test tables write all links alike, so text between fixed marks is enough here
LINKS_SQL = """
    select page_id, (row_number() over (partition by page_id order by i) - 1)::int as position, split_part(split_part(tag, 'href="', 2), '"', 1) as href
    from (select page_id, generate_subscripts(l, 1) as i, split_part(unnest(l), '>', 1) as tag
          from (select page_id, string_split(html, '<a ')[2:] as l from pages))
    where contains(tag, 'href="')"""


@query(LINKS_SQL)
def src_html_links(t: Tables) -> DataFrame:
    return links.harvest_links(t.pages.select("page_id", "html"))


@query(
    f"""with links as ({LINKS_SQL}),
        typed as (select page_id, position, href || case position % 3 when 0 then '.csv' when 1 then '.html'
                                                    else '-HOGAR-NHOG.csv' end as href from links)
        select * from typed where href like '%.csv'
           and not regexp_matches(href, 'HOGAR.NHOG|VIVIENDA.V00|HOGAR.H15|PERSONA.P03')"""
)
def src_url_filter(t: Tables) -> DataFrame:
    position = F.col("position")
    ending = F.when(position % 3 == 0, ".csv").when(position % 3 == 1, ".html").otherwise("-HOGAR-NHOG.csv")
    found = links.harvest_links(t.pages.select("page_id", "html"))
    return links.data_files(found.withColumn("href", F.concat("href", ending)))


_LONG_SQL = " union all ".join(
    f"select o_custkey::varchar as radio, '{n}' as var, count(*) filter ({c})::bigint as value from orders group by 1"
    for n, c in CENSUS_COLUMNS.items()
)


@query(_LONG_SQL)
def src_fan_in_long(t: Tables) -> DataFrame:
    files = census_files(t.orders)
    return fan_in([text.category_columns(files[name], prefix) for name, prefix in PREFIXES.items()])


@query(
    """select o_custkey::varchar as radio,
              count(*) filter (o_orderpriority = '1-URGENT')::bigint as "per_prio_URGENT",
              count(*) filter (o_orderpriority = '2-HIGH')::bigint as "per_prio_HIGH",
              count(*) filter (o_orderpriority = '3-MEDIUM')::bigint as "per_prio_MEDIUM",
              count(*) filter (o_orderpriority = '4-NOT SPECIFIED')::bigint as "per_prio_NOT_SPECIFIED",
              count(*) filter (o_orderpriority = '5-LOW')::bigint as "per_prio_LOW"
       from orders group by 1"""
)
def src_category_file(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "category")
    census_files(t.orders)["priority"].write.option("header", True).option("encoding", text.LATIN1).csv(path)
    return text.read_category_file(t.spark, path, "per_prio_")


@query("""select o_custkey::varchar as radio, count(*) as "ho_TOTAL" from orders group by 1""")
def src_denominator_file(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "denominator")
    census_files(t.orders)["status"].write.option("header", True).option("encoding", text.LATIN1).csv(path)
    return text.read_total_file(t.spark, path, "ho_")


@query(
    """select 'A' as origin, o_orderkey, o_orderpriority, null as o_orderstatus from orders
       union all select 'B', o_orderkey, null, o_orderstatus from orders"""
)
def set_union_by_name(t: Tables) -> DataFrame:
    a = t.orders.select(F.lit("A").alias("origin"), "o_orderkey", "o_orderpriority")
    b = t.orders.select("o_orderstatus", "o_orderkey", F.lit("B").alias("origin"))
    return stack([a, b])
