"""Spatial queries, lookups, interpolation and the final table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from zonalis.operators.geometry import bounds, box_ring, point, shoelace
from zonalis.operators.projection import CENSUS_ZONE, WGS84, equal_area, map_vertices
from zonalis.operators.spatial import box_overlay, overlay, points_in_polygons, polygon_boxes
from zonalis.operators.validity import check, repair
from zonalis.plans.census import fan_in, value_names
from zonalis.plans.final import final_table, interpolate
from zonalis.plans.geography import (
    best_matches,
    circuit_ids,
    full_lookup,
    overlay_shares,
    prepare_circuits,
    prepare_tracts,
    section_matches,
    without_slivers,
)
from zonalis.plans.votes import SHORT_2015, SHORT_2019, wide
from zonalis.queries.aggregates import WIDE_SQL, paso15_long, paso19_long, pres15_long, pres19_long
from zonalis.queries.analogues import (
    CENSUS_COLUMNS,
    CIRCUITS_SQL,
    PADDED_CIRCUITS_SQL,
    PLACES_SQL,
    PREFIXES,
    TOTALS,
    TRACTS_SQL,
    census_files,
    census_wide_sql,
    circuits,
    district,
    polling_places,
    section,
    tracts,
)
from zonalis.queries.registry import Tables, query
from zonalis.sources.stage import staged
from zonalis.sources.text import category_columns

# -- boxes of different sizes against a regular raster ---------------------------------------------


def _part_corner() -> tuple[Column, Column, Column]:
    k = F.col("p_partkey")
    return k % 40, F.floor(k / 40), F.col("p_size") % 5 + 1


def _part_boxes(t: Tables) -> DataFrame:
    x, y, w = _part_corner()
    return t.part.select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") % 500).cast("string").alias("id_radio"),
        F.array(box_ring(x, y, x + w, y + w)).alias("rings"),
    )


def _raster(t: Tables, hole: bool = False) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = k % 10 * 4, F.floor(k / 10) * 4
    outer = box_ring(x, y, x + 4, y + 4)
    rings = F.array(outer, box_ring(x + 1, y + 1, x + 3, y + 3, hole=True)) if hole else F.array(outer)
    return t.supplier.select(k.alias("id"), (k % 37).cast("string").alias("id_circuito"), rings.alias("rings"))


_PART_BOXES_SQL = """
    select p_partkey as id, (p_partkey % 500)::varchar as id_radio, (p_partkey % 40)::double as x0,
           floor(p_partkey / 40)::double as y0, (1 + p_size % 5)::double as w from part"""
_RASTER_SQL = """
    select s_suppkey as id, (s_suppkey % 37)::varchar as id_circuito, (s_suppkey % 10 * 4)::double as x0,
           (floor(s_suppkey / 10) * 4)::double as y0 from supplier"""


def _shared(ax0: str, ay0: str, aw: str, bx0: str, by0: str, bw: str) -> str:
    return (
        f"greatest(least({ax0} + {aw}, {bx0} + {bw}) - greatest({ax0}, {bx0}), 0)"
        f" * greatest(least({ay0} + {aw}, {by0} + {bw}) - greatest({ay0}, {by0}), 0)"
    )


_BOX_OVERLAY_SQL = f"""
    select p.id as a, s.id as b, {_shared('p.x0', 'p.y0', 'p.w', 's.x0', 's.y0', '4')} as area
    from ({_PART_BOXES_SQL}) p join ({_RASTER_SQL}) s
      on p.x0 < s.x0 + 4 and s.x0 < p.x0 + p.w and p.y0 < s.y0 + 4 and s.y0 < p.y0 + p.w"""


@query(_BOX_OVERLAY_SQL)
def geo_overlay_boxes(t: Tables) -> DataFrame:
    return box_overlay(polygon_boxes(_part_boxes(t)), polygon_boxes(_raster(t)))


@query(
    f"""with l as (select id, x0, y0, w, x0 + w / 2 as cx, y0 + w / 2 as cy from ({_PART_BOXES_SQL})),
             h as (select id, x0, y0 from ({_RASTER_SQL})),
             pairs as (select l.id as a, h.id as b,
                  {_shared('l.x0', 'l.y0', 'w', 'h.x0', 'h.y0', '4')} - {_shared('l.x0', 'l.y0', 'w', 'h.x0 + 1', 'h.y0 + 1', '2')}
                  - {_shared('cx', 'cy', 'w / 2', 'h.x0', 'h.y0', '4')} + {_shared('cx', 'cy', 'w / 2', 'h.x0 + 1', 'h.y0 + 1', '2')} as area
                  from l join h on l.x0 < h.x0 + 4 and h.x0 < l.x0 + w and l.y0 < h.y0 + 4 and h.y0 < l.y0 + w)
        select a, b, round(area, 6) as area from pairs where area > 0"""
)
def geo_overlay_polygons(t: Tables) -> DataFrame:
    """L shapes over squares with a hole."""
    x, y, w = _part_corner()
    corners = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.5), (0.5, 0.5), (0.5, 1.0), (0.0, 1.0), (0.0, 0.0)]
    ring = F.array(*[point(x + w * dx, y + w * dy) for dx, dy in corners])
    shapes = t.part.select(F.col("p_partkey").alias("id"), F.array(ring).alias("rings"))
    return overlay(shapes, _raster(t, hole=True)).select("a", "b", F.round("area", 6).alias("area"))


_SHARES_SQL = f"""
    select id_radio, id_circuito, round(sum(round_even(area / (w * w), 5)), 5) as por_radio
    from ({_BOX_OVERLAY_SQL}) o join ({_PART_BOXES_SQL}) p on p.id = a join ({_RASTER_SQL}) s on s.id = b group by 1, 2"""


def _shares(t: Tables) -> DataFrame:
    shares = overlay_shares(_part_boxes(t), _raster(t))
    return shares.withColumn("por_radio", F.round("por_radio", 5))


@query(_SHARES_SQL)
def geo_overlay_share(t: Tables) -> DataFrame:
    """Several polygons per id on both sides; shares are rounded per polygon pair, then summed."""
    return _shares(t)


@query(f"select * from ({_SHARES_SQL}) where por_radio > 0.001")
def geo_sliver_filter(t: Tables) -> DataFrame:
    return without_slivers(_shares(t))


@query(
    f"""with p as (select event_id, (event_id * 37 % 160) / 4.0::double as x, (event_id * 7 % 1600) / 4.0::double as y from events)
        select event_id, x, y, s.id from p join ({_RASTER_SQL}) s
          on x between s.x0 and s.x0 + 4 and y between s.y0 and s.y0 + 4
         and not (x > s.x0 + 1 and x < s.x0 + 3 and y > s.y0 + 1 and y < s.y0 + 3)"""
)
def geo_point_in_polygon(t: Tables) -> DataFrame:
    """Points on a boundary belong to each polygon they touch; points in a hole to none."""
    k = F.col("event_id")
    points = t.events.select("event_id", (k * 37 % 160 / 4.0).alias("x"), (k * 7 % 1600 / 4.0).alias("y"))
    return points_in_polygons(points, _raster(t, hole=True), ["event_id"])


# -- coordinates -----------------------------------------------------------------------------------


def _degree_box(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    lon, lat = F.lit(-70.0) + k % 40 * 0.25, F.lit(-52.0) + F.floor(k / 40) % 120 * 0.25
    return t.supplier.select("s_suppkey", F.array(box_ring(lon, lat, lon + 0.25, lat + 0.125)).alias("rings"))


@query(
    """select s_suppkey, -70.0::double + s_suppkey % 40 * 0.25 as xmin, -52.0::double + floor(s_suppkey / 40) % 120 * 0.25 as ymin,
              -69.75::double + s_suppkey % 40 * 0.25 as xmax, -51.875::double + floor(s_suppkey / 40) % 120 * 0.25 as ymax
       from supplier"""
)
def geo_reproject(t: Tables) -> DataFrame:
    """Degrees to the census zone in metres and back, vertex by vertex."""
    metres = _degree_box(t).withColumn("rings", map_vertices(F.col("rings"), CENSUS_ZONE.forward))
    back = metres.withColumn("box", bounds(map_vertices(F.col("rings"), CENSUS_ZONE.inverse)))
    return back.select("s_suppkey", *[F.round(F.col("box")[c], 7).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


_E2 = (2 - 1 / WGS84[1]) / WGS84[1]


def _q_sql(latitude: str) -> str:
    s, e = f"sin(radians({latitude}))", f"sqrt({_E2!r}::double)"
    return f"(1 - {_E2!r}::double) * ({s} / (1 - {_E2!r}::double * {s} * {s}) + ln((1 + {e} * {s}) / (1 - {e} * {s})) / (2 * {e}))"


@query(
    f"""with b as (select s_suppkey, -52.0::double + floor(s_suppkey / 40) % 120 * 0.25 as lat from supplier)
        select s_suppkey, round({WGS84[0]!r}::double * {WGS84[0]!r}::double * radians(0.25) / 2
                                * ({_q_sql('lat + 0.125')} - {_q_sql('lat')}) / 1e6, 3) as km2 from b"""
)
def geo_area(t: Tables) -> DataFrame:
    """Area on the ellipsoid: shoelace in an equal-area plane."""
    plane = _degree_box(t).withColumn("rings", map_vertices(F.col("rings"), equal_area()))
    return plane.select("s_suppkey", F.round(shoelace(F.col("rings")) / 1e6, 3).alias("km2"))


@query(
    """select p_partkey as id, 0 as ring, 5 as vertices, p_size % 3 = 0 as crosses,
              (1 + p_size % 5) * (1 + p_size % 5) / case when p_size % 3 = 0 then 2.0 else 1.0 end::double as area
       from part"""
)
def geo_validate(t: Tables) -> DataFrame:
    """Open, repeated, clockwise and bow-tie rings: repaired, and bow-ties reported; they keep half of their box."""
    x, y, w = _part_corner()
    a, b, c, d = point(x, y), point(x + w, y), point(x + w, y + w), point(x, y + w)
    size = F.col("p_size")
    ring = F.when(size % 3 == 0, F.array(a, c, b, d)).when(size % 2 == 0, F.array(d, c, b, b, a)).otherwise(F.array(a, b, c, d, a))
    polygons = t.part.select(F.col("p_partkey").alias("id"), F.array(ring).alias("rings"))
    areas = repair(polygons).select("id", shoelace(F.col("rings")).alias("area"))
    return check(polygons).join(areas, "id")


# -- source polygons: tracts in zone metres, circuits in degrees ---------------------------------------


def _degrees(column: str, per_row: int, width: float, height: float) -> tuple[str, str]:
    """South-west corner of a raster cell, as SQL text both engines read."""
    return f"(-62.0 + {column} % {per_row} * {width})", f"(-38.0 + floor({column} / {per_row}) * {height})"


def _source_boxes(key: str, per_row: int, step: tuple[float, float], size: tuple[float, float]) -> Column:
    x, y = (F.expr(e).cast("double") for e in _degrees(key, per_row, *step))
    return F.array(box_ring(x, y, x + size[0], y + size[1]))


def source_tracts(customer: DataFrame) -> DataFrame:
    """Boxes in degrees moved to the census zone; every fifth customer's box is listed twice."""
    twice = customer.selectExpr("c_custkey", "explode(if(c_custkey % 5 = 0, array(1, 2), array(1)))")
    boxes = twice.select(
        F.col("c_custkey").cast("string").alias("link"),
        _source_boxes("c_custkey", 50, (0.0625, 0.0078125), (0.0625, 0.0078125)).alias("rings"),
    )
    province = F.expr("concat('0', cast(link as int) % 2 + 1)").alias("province")
    return boxes.select("link", province, map_vertices(F.col("rings"), CENSUS_ZONE.forward).alias("rings"))


def source_circuits(supplier: DataFrame) -> DataFrame:
    rings = _source_boxes("s_suppkey", 12, (0.28125, 0.02734375), (0.3125, 0.03125))
    return supplier.select(
        F.expr("concat('layer_', s_suppkey % 4)").alias("source_file"),
        F.expr("concat('0', s_suppkey % 2 + 1)").alias("province"),
        F.expr("if(s_suppkey = 6, 'Río Negro', 'Otra')").alias("provincia"),
        F.expr(district("s_suppkey")).alias("indec_p"),
        F.expr(section("s_suppkey")).alias("indec_d"),
        F.col("s_suppkey").cast("string").alias("circuito"),
        rings.alias("rings"),
    )


def _source_overlay_sql() -> str:
    tx, ty = _degrees("c_custkey", 50, 0.0625, 0.0078125)
    cx, cy = _degrees("s_suppkey", 12, 0.28125, 0.02734375)
    return f"""
    with t as (select c_custkey::varchar as id_radio, c_custkey % 2 as layer, case when c_custkey % 5 = 0 then 2 else 1 end as copies,
                      {tx}::double as x0, {ty}::double as y0, {tx}::double + 0.0625 as x1, {ty}::double + 0.0078125 as y1 from customer),
         c as (select case when s_suppkey % 4 = 2 then '63' else lpad((s_suppkey % 3 + 1)::varchar, 2, '0') end
                        || lpad((s_suppkey % 5)::varchar, 3, '0') || lpad(s_suppkey::varchar, 6, '0') as id_circuito, s_suppkey % 2 as layer,
                      {cx}::double as x0, {cy}::double as y0, {cx}::double + 0.3125 as x1, {cy}::double + 0.03125 as y1
               from supplier where s_suppkey >= 10),
         o as (select id_radio, id_circuito, copies, x1 - x0 as width, {_q_sql('y1')} - {_q_sql('y0')} as height, w,
                      {_q_sql('hi')} - {_q_sql('lo')} as h
               from (select id_radio, id_circuito, copies, t.x0, t.x1, t.y0, t.y1, least(t.x1, c.x1) - greatest(t.x0, c.x0) as w,
                            greatest(t.y0, c.y0) as lo, least(t.y1, c.y1) as hi
                     from t join c on t.layer = c.layer and t.x0 < c.x1 and c.x0 < t.x1 and t.y0 < c.y1 and c.y0 < t.y1))
    select id_radio, id_circuito, round(sum(round_even(w * h / (width * height), 5) * copies), 5) as por_radio
    from o group by 1, 2 having sum(round_even(w * h / (width * height), 5) * copies) > 0.001"""


@query(_source_overlay_sql())
def geo_intersect_sources(t: Tables) -> DataFrame:
    """From polygons as they are delivered to the lookup: province code, projection, repair, overlay by province, shares."""
    planar_tracts = prepare_tracts(source_tracts(t.customer))
    planar_circuits = prepare_circuits(source_circuits(t.supplier))
    shares = without_slivers(
        overlay_shares(staged(planar_tracts, "tracts"), staged(circuit_ids(planar_circuits), "circuits"))
    )
    return shares.withColumn("por_radio", F.round("por_radio", 5))


# -- tracts, circuits, polling places --------------------------------------------------------------

_SECTION_SQL = f"""
    select id_seccion_elec, indec_p || indec_d as id_seccion_indec, count(distinct c.id) as count
    from (select distinct * from ({PLACES_SQL})) p
    join ({CIRCUITS_SQL}) c on x between c.x0 and c.x1 and y between c.y0 and c.y1 group by 1, 2"""
_BEST_SQL = f"""
    select id_seccion_elec, id_seccion_indec from
      (select *, rank() over (partition by id_seccion_elec order by count desc) as r from ({_SECTION_SQL})) where r = 1"""
_TRACT_SHARES_SQL = f"""
    with circuits as ({CIRCUITS_SQL}), padded as ({PADDED_CIRCUITS_SQL})
    select id_radio, id_circuito, sum(round_even((least(t.x1, c.x1) - greatest(t.x0, c.x0)) * (least(t.y1, c.y1) - greatest(t.y0, c.y0)), 5)) as por_radio
    from ({TRACTS_SQL}) t join padded c on t.x0 < c.x1 and c.x0 < t.x1 and t.y0 < c.y1 and c.y0 < t.y1
    group by 1, 2 having por_radio > 0.001"""
_LOOKUP_SQL = f"""
    select * from (
      select id_radio, id_circuito, por_radio, substr(id_circuito, 1, 5) as id_seccion_indec, id_seccion_elec,
             coalesce(id_seccion_elec, 'NA') || substr(id_circuito, 6, 6) as id_circuito_elec
      from ({_TRACT_SHARES_SQL}) s left join ({_BEST_SQL}) b on b.id_seccion_indec = substr(id_circuito, 1, 5))
    where id_circuito_elec in (select id_circuito_elec from ({WIDE_SQL['paso19']}) where paso19_blanco is not null)"""


@query(_SECTION_SQL)
def geo_section_match(t: Tables) -> DataFrame:
    return section_matches(polling_places(t.lineitem), circuits(t.supplier))


@query(_BEST_SQL)
def geo_section_crosswalk(t: Tables) -> DataFrame:
    return best_matches(section_matches(polling_places(t.lineitem), circuits(t.supplier)))


def _tract_shares(t: Tables) -> DataFrame:
    return without_slivers(overlay_shares(tracts(t.customer), circuit_ids(circuits(t.supplier))))


@query(_TRACT_SHARES_SQL)
def geo_tract_shares(t: Tables) -> DataFrame:
    return _tract_shares(t)


def _lookup(t: Tables, paso19: DataFrame) -> DataFrame:
    sections = best_matches(section_matches(polling_places(t.lineitem), circuits(t.supplier)))
    return full_lookup(_tract_shares(t), sections, paso19, "paso19_blanco")


@query(_LOOKUP_SQL)
def geo_full_lookup(t: Tables) -> DataFrame:
    return _lookup(t, wide(paso19_long(t), "paso19", SHORT_2019))


def _census(t: Tables) -> tuple[DataFrame, list[str]]:
    """Long census table with the denominators, and its variable names."""
    totals = {"year": "vi_TOTAL", "price": "vi_urban_TOTAL", "status": "ho_TOTAL", "priority": "per_TOTAL"}
    files = census_files(t.orders)
    tables = [category_columns(files[n], prefix, totals.get(n)) for n, prefix in PREFIXES.items()]
    return fan_in(tables), value_names(tables)


_TOTAL_COLUMNS = ", ".join(
    '"ho_stat_Filled" + "ho_stat_Open" + "ho_stat_Partly_open" as "%s"' % n for n in TOTALS
)


def _interpolated_sql(lookup: str, id_column: str) -> str:
    names = [*CENSUS_COLUMNS, *TOTALS]
    sums = ", ".join(f'round_even(coalesce(sum("{n}" * por_radio), 0), 0) as "{n}"' for n in names)
    return f"""
    select {id_column} as id_circuito_elec, {sums}
    from ({lookup}) l left join (select *, {_TOTAL_COLUMNS} from ({census_wide_sql()})) c on c.radio = l.id_radio group by 1"""


@query(_interpolated_sql(_TRACT_SHARES_SQL, "id_circuito"))
def areal_interpolate(t: Tables) -> DataFrame:
    """Census counts moved from tracts to circuits by area share."""
    census, names = _census(t)
    lookup = _tract_shares(t).withColumnRenamed("id_circuito", "id_circuito_elec")
    return interpolate(lookup, census, names)


# The names on the right are those the reports use; the columns on the left only stand in for them.
DICTIONARY = [
    ("id_circuito_elec", 1, "id_circuito_elec"),
    ("per_prio_URGENT", 1, "per_nietos_hogar"),
    ("per_prio_HIGH", 1, "per_edad_20_24"),
    ("per_prio_MEDIUM", 1, "per_edad_65mas"),
    ("per_prio_NOT_SPECIFIED", 1, "per_estud_universitario"),
    ("per_prio_LOW", 1, "per_servicio_domestico_interno"),
    ("ho_stat_Filled", 1, "ho_3omas_por_cuarto"),
    ("ho_stat_Open", 1, "ho_necesidad_basica_insatisfecha"),
    ("ho_stat_Partly_open", 0, ""),
    ("ho_serv_Con", 1, "ho_compu"),
    ("ho_serv_Sin", 1, "ho_fijo"),
    ("vi_urban_Urbano", 1, "per_desocupado"),
    ("vi_urban_Rural", 0, ""),
    *[(f"vi_year_{y}", 1, f"vi_year_{y}") for y in range(1995, 2001)],
    ("vi_year__2001", 0, ""),
    *[
        (f"{e}_{c}", 1, f"{e}_{c}")
        for e, short in (("paso19", SHORT_2019), ("pres19", SHORT_2019), ("pres15", SHORT_2015), ("paso15", SHORT_2015))
        for c in ("blanco", "validos", *[f"cand_{s}" for s in short.values()])
    ],
]


def _final_sql() -> str:
    totals = {"per_": "per_TOTAL", "ho_": "ho_TOTAL", "vi_urban_": "vi_urban_TOTAL", "vi_": "vi_TOTAL"}
    columns = ["z.id_circuito_elec"]
    for old, flag, new in DICTIONARY[1:]:
        if not flag:
            continue
        if "_cand_" in old:
            columns.append(f'"{old}"::double / nullif({old[:6]}_validos, 0) * 100 as "{new}"')
        elif old.startswith(("paso", "pres")):
            columns.append(f'"{old}" as "{new}"')
        else:
            whole = next(v for k, v in totals.items() if old.startswith(k))
            columns.append(f'"{old}" / nullif("{whole}", 0) * 100 as "{new}"')
    province = "case substr(z.id_circuito_elec, 1, 2) when '01' then 'CABA' when '02' then 'Buenos Aires' end as province"
    joins = " ".join(
        f"left join ({WIDE_SQL[e]}) {e} on {e}.id_circuito_elec = z.id_circuito_elec" for e in ("paso19", "pres19", "paso15", "pres15")
    )
    return f"select {province}, {', '.join(columns)} from ({_interpolated_sql(_LOOKUP_SQL, 'id_circuito_elec')}) z {joins}"


FINAL_SQL = _final_sql()


def elections(t: Tables) -> dict[str, DataFrame]:
    """The four wide tables. The first also decides which circuits are kept, so it is staged."""
    return {
        "paso19": staged(wide(paso19_long(t), "paso19", SHORT_2019), "paso19"),
        "pres19": wide(pres19_long(t), "pres19", SHORT_2019),
        "paso15": wide(paso15_long(t), "paso15", SHORT_2015),
        "pres15": wide(pres15_long(t), "pres15", SHORT_2015),
    }


def build_final(t: Tables) -> DataFrame:
    census, names = _census(t)
    results = elections(t)
    return final_table(_lookup(t, results["paso19"]), census, names, results, DICTIONARY)


@query(FINAL_SQL)
def final_circuit_table(t: Tables) -> DataFrame:
    """Everything: overlay, crosswalk, interpolation, percentages, four elections, dictionary."""
    return build_final(t)
