"""Delimited text in the layouts of the vote and census files, and the semicolon sink.

Codes are strings throughout: schema inference would strip their leading zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from zonalis.functions import decimal_comma_text, format_decimal_comma
from zonalis.operators.selectors import category_names, lower_header, one_of

LATIN1 = "ISO-8859-1"


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _choose(df: DataFrame, schema: T.StructType, comma: bool = False) -> DataFrame:
    """The columns of the schema, found by lower-cased name; files may hold more, in any order."""
    lowered = lower_header(df)
    one_of(lowered, schema.names)

    def typed(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            return text
        number = decimal_comma_text(text) if comma and isinstance(field.dataType, T.DoubleType) else text
        return number.try_cast(field.dataType).alias(field.name)

    return lowered.select(*[typed(f) for f in schema.fields])


def read_pipe(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Pipe-delimited with header; a value that does not fit its type is NULL."""
    return _choose(spark.read.option("sep", "|").option("header", True).csv(path), schema)


def read_semicolon(
    spark: SparkSession, path: str | list[str], schema: T.StructType, encoding: str = "UTF-8"
) -> DataFrame:
    """Semicolon-delimited with header, decimal comma and ``NA`` for missing."""
    options = {"sep": ";", "header": "true", "nullValue": "NA", "encoding": encoding}
    return _choose(spark.read.options(**options).csv(path), schema, comma=True)


def read_latin1(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comma-delimited with header, Latin-1 text; every column a string under its own name."""
    return spark.read.option("header", True).option("encoding", LATIN1).csv(path)


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``ordinal``, which sorts rows as they lie in their files. Call it right after a read."""
    return df.withColumn(
        "ordinal",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_category_file(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Census file of one variable: key, renamed category counts; the total is dropped."""
    return category_columns(read_latin1(spark, path), prefix)


def category_columns(df: DataFrame, prefix: str, total: str | None = None) -> DataFrame:
    """Renamed categories; the total is dropped, or kept under the name given."""
    key, *categories, last = df.columns
    names = {c: n for c, n in zip(categories, category_names(categories, prefix), strict=True)}
    if total:
        names[last] = total
    return df.selectExpr(f"`{key}`", *[f"try_cast(`{c}` AS BIGINT) AS `{n}`" for c, n in names.items()])


def read_total_file(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Key and total of a census file."""
    return total_column(read_latin1(spark, path), prefix)


def total_column(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(df.columns[0], F.col("TOTAL").try_cast("bigint").alias(f"{prefix}TOTAL"))


def write_semicolon(df: DataFrame, path: str) -> None:
    """Semicolon-delimited, decimal comma, missing as ``NA``."""
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType))}
    df.select(
        *[format_decimal_comma(F.col(f"`{c}`")).alias(c) if c in real else F.col(f"`{c}`") for c in df.columns]
    ).write.mode("overwrite").option("sep", ";").option("header", True).option("nullValue", "NA").csv(path)
