"""Points from GeoJSON and polygons from Parquet partitioned by province."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonalis.operators.selectors import lower_header


def _feature_type(properties: Mapping[str, T.DataType]) -> T.StructType:
    geometry = T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
    return T.StructType(
        [
            T.StructField("properties", T.StructType([T.StructField(n, t) for n, t in properties.items()])),
            T.StructField("geometry", geometry),
        ]
    )


def read_points(
    spark: SparkSession, path: str, properties: Mapping[str, T.DataType], collection: bool = False
) -> DataFrame:
    """Point features: their properties (names lower-cased) with ``x`` and ``y``.

    One feature per line splits across tasks. ``collection`` reads files that each hold one
    FeatureCollection; such a file cannot be split, only several files run in parallel.
    """
    feature = _feature_type(properties)
    if collection:
        whole = T.StructType([T.StructField("features", T.ArrayType(feature))])
        files = spark.read.schema(whole).option("multiLine", True).json(path)
        features = files.select(F.inline("features"))
    else:
        features = spark.read.schema(feature).json(path)
    at = F.col("geometry.coordinates")
    return lower_header(features.select("properties.*", F.get(at, F.lit(0)).alias("x"), F.get(at, F.lit(1)).alias("y")))


def read_provinces(spark: SparkSession, path: str, provinces: Sequence[str]) -> DataFrame:
    """Rows of the given provinces; other partitions are not listed or read.

    Partition folders hold codes such as ``01``; the schema is given, for inference would make them numbers.
    """
    body = spark.read.option("basePath", path).parquet(path).schema
    schema = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == "province" else f for f in body.fields]
    )
    return spark.read.schema(schema).parquet(path).filter(F.col("province").isin(*provinces))
