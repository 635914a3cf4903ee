"""Shape a gold table for the warehouse: declared columns, types, defaults and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.functions.dates import moment
from palisade.schemas import WarehouseColumn, WarehouseTable

PROBLEMS = "rejected_for"


def _source(column: WarehouseColumn, present: set[str], loaded_at) -> Column:
    value = F.col(column.name) if column.name in present else F.lit(None)
    if column.default == "now":
        return F.coalesce(value.cast(column.type), moment(loaded_at))
    return value if column.default is None else F.coalesce(value, F.lit(column.default))


def _problem(column: WarehouseColumn, source: Column) -> list[Column]:
    cast = source.try_cast(column.type)
    found = [F.when(source.isNotNull() & cast.isNull(), F.lit(f"range:{column.name}"))]
    if column.required:
        found.append(F.when(source.isNull(), F.lit(f"missing:{column.name}")))
    if column.width is not None:
        found.append(F.when(F.octet_length(cast) > column.width, F.lit(f"width:{column.name}")))
    return found


def conform(table: DataFrame, target: WarehouseTable, loaded_at=None) -> tuple[DataFrame, DataFrame]:
    """Rows the warehouse can load, and the others with the reasons in ``rejected_for``.

    Columns the warehouse does not declare (the arrays) are left out of the first; the second keeps the
    table's own columns. Reasons are ``missing``, ``width`` (bytes) and ``range`` (does not fit the type).
    """
    present = set(table.columns)
    sources = {column.name: _source(column, present, loaded_at) for column in target.columns}
    problems = [found for column in target.columns for found in _problem(column, sources[column.name])]
    checked = table.withColumn(PROBLEMS, F.array_compact(F.array(*problems)))
    loadable = checked.where(F.size(PROBLEMS) == 0).select(
        *[sources[column.name].try_cast(column.type).alias(column.name) for column in target.columns]
    )
    return loadable, checked.where(F.size(PROBLEMS) > 0)
