"""Compare a table with its declared columns, in one pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def required_columns(table: DataFrame, declared: T.StructType | str) -> DataFrame:
    """The table, if it has every declared column in the declared type; no data is read. NULLs are the checks' matter."""
    declared = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    actual = {field.name: field.dataType.simpleString() for field in table.schema.fields}
    wrong = [
        f"{field.name}: {actual.get(field.name, 'missing')} instead of {field.dataType.simpleString()}"
        for field in declared.fields
        if actual.get(field.name) != field.dataType.simpleString()
    ]
    if wrong:
        raise ValueError("; ".join(wrong))
    return table


def contract_report(table: DataFrame, declared: T.StructType | str) -> DataFrame:
    """One row per declared or present column: expected type, actual type, NULLs where none are allowed.

    ``forbidden_nulls`` is counted for columns declared NOT NULL and is zero for the others; ``agrees`` says
    whether the column keeps its contract.
    """
    declared = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    expected = {field.name: field for field in declared.fields}
    actual = {field.name: field.dataType.simpleString() for field in table.schema.fields}
    required = [name for name, field in expected.items() if not field.nullable and name in actual]
    nulls = table.agg(F.count("*").alias("rows"), *[F.count_if(F.col(name).isNull()).alias(name) for name in required])

    def line(name):
        wanted = expected[name].dataType.simpleString() if name in expected else None
        found = F.col(name) if name in required else F.lit(0).cast("bigint")
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(wanted).cast("string").alias("expected"),
            F.lit(actual.get(name)).cast("string").alias("actual"),
            F.col("rows"),
            found.alias("forbidden_nulls"),
            (F.lit(wanted == actual.get(name)) & (found == 0)).alias("agrees"),
        )

    names = [*expected, *[name for name in actual if name not in expected]]
    return nulls.select(F.inline(F.array(*[line(name) for name in names])))
