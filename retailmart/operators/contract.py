"""Declared output schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def enforce(df: DataFrame, schema: StructType) -> DataFrame:
    """Select, order and cast the declared columns; a NULL in a required column fails the job."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{field.name} must not be NULL")))
        columns.append(value.alias(field.name))
    return df.select(*columns)
