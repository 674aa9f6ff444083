"""Fields of JSON texts by Spark's VARIANT type, with broken texts kept apart.

A text is parsed once; paths are then read from its binary form, in generated code and
without a schema that would have to be declared. Which fields there are is found from the
data itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parsed(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``_json`` (null where the text is null or broken) and ``_broken``."""
    value = F.try_parse_json(F.col(column))
    return rows.withColumn("_json", value).withColumn(
        "_broken", F.col(column).isNotNull() & F.col("_json").isNull()
    )


def fields(rows: DataFrame, column: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with a column for each name: its path and type. Missing fields, fields of a
    type that does not convert, and broken texts give null."""
    known = parsed(rows, column)
    named = {n: F.try_variant_get("_json", path, kind) for n, (path, kind) in paths.items()}
    return known.withColumns(named).drop("_json", "_broken")


def broken(rows: DataFrame, column: str) -> DataFrame:
    """The rows whose text is no JSON."""
    return parsed(rows, column).filter("_broken").drop("_json", "_broken")


def report(rows: DataFrame, column: str) -> DataFrame:
    """n_rows, n_null, n_broken and found_schema, the merged schema of all parsed texts."""
    return parsed(rows, column).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(column).isNull()).alias("n_null"),
        F.count_if("_broken").alias("n_broken"),
        F.schema_of_variant_agg("_json").alias("found_schema"),
    )
