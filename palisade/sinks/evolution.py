"""Schema changes of tables kept as Parquet files: new columns and wider types, refused where values could be lost.

The schema of such a table lies beside its data as numbered files below ``_schema``, which readers skip. A number is written
before the first data that need it, so a crash in between leaves a schema whose new columns are NULL so far. Files written
earlier stay as they are: the reader fills in new columns and widens as it decodes.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.sinks import folders

SCHEMAS = "_schema"
INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
EXACT_AS_DOUBLE = [*INTEGERS[:3], T.FloatType(), T.DoubleType()]


def wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both and that the reader can widen to; None if there is none."""
    if one == other:
        return one
    if one in INTEGERS and other in INTEGERS:
        return max(one, other, key=INTEGERS.index)
    if one in EXACT_AS_DOUBLE and other in EXACT_AS_DOUBLE:
        return T.DoubleType()
    if isinstance(one, T.DecimalType) and isinstance(other, T.DecimalType):
        scale = max(one.scale, other.scale)
        precision = scale + max(one.precision - one.scale, other.precision - other.scale)
        return T.DecimalType(precision, scale) if precision <= 38 else None
    return None


def united(held: T.StructType, new: T.StructType, partition_by=()) -> T.StructType:
    """``held`` with the columns that only ``new`` has behind its own, each column as wide as both need, partition columns last.

    Names are compared without case, as Spark does. A column whose types have no common width is refused, as is another
    type of a partition column, whose values are folder names. All such columns are named at once.
    """
    arriving = {field.name.lower(): field for field in new.fields}
    folded = {name.lower() for name in partition_by}
    fields, refused = [], []
    for field in held.fields:
        other = arriving.pop(field.name.lower(), None)
        kind = field.dataType if other is None else wider(field.dataType, other.dataType)
        if kind is None or (field.name.lower() in folded and kind != field.dataType):
            refused.append(f"{field.name}: {field.dataType.simpleString()} and {other.dataType.simpleString()}")
        else:
            fields.append(T.StructField(field.name, kind))
    fields += [T.StructField(field.name, field.dataType) for field in arriving.values()]
    if refused:
        raise ValueError("types that can't be united: " + "; ".join(refused))
    return T.StructType([f for f in fields if f.name.lower() not in folded] + [f for f in fields if f.name.lower() in folded])


def known_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept for a table, None if none was."""
    numbered = [name for name in folders.names(spark, f"{path}/{SCHEMAS}") if name.endswith(".json")]
    text = folders.read_text(spark, f"{path}/{SCHEMAS}/{max(numbered)}") if numbered else None
    return None if text is None else T.StructType.fromJson(json.loads(text))


def read_known(spark: SparkSession, path: str, *parts: str) -> DataFrame:
    """A table by its kept schema, or as its files say; ``parts`` are the folders wanted of it."""
    reader, schema = spark.read, known_schema(spark, path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("basePath", path).parquet(*parts) if parts else reader.parquet(path)


def evolve(new: DataFrame, path: str, partition_by=()) -> DataFrame:
    """``new`` with the table's columns and types, after the table's schema took up what only ``new`` has.

    Columns that ``new`` lacks are NULL. A table that has no kept schema yet gets one from the footers of all its files.
    """
    spark = new.sparkSession
    before = known_schema(spark, path)
    held = before
    if before is None and any(folders.shown(name) for name in folders.names(spark, path)):
        held = spark.read.option("mergeSchema", True).parquet(path).schema
    schema = united(held or T.StructType([]), new.schema, partition_by)
    if schema != before:
        last = max((name for name in folders.names(spark, f"{path}/{SCHEMAS}") if name.endswith(".json")), default="0")
        folders.make(spark, f"{path}/{SCHEMAS}")
        folders.write_text(spark, f"{path}/{SCHEMAS}/{int(last.split('.')[0]) + 1:09d}.json", schema.json())
    present = {name.lower() for name in new.columns}
    columns = [F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None) for f in schema.fields]
    return new.select(*[column.cast(f.dataType).alias(f.name) for column, f in zip(columns, schema.fields, strict=True)])


def update_catalog(spark: SparkSession, name: str, path: str, partition_by) -> None:
    """Bring an external catalog table up to the kept schema: new columns are added; for a wider type the entry is made anew.

    The files aren't touched. While an entry is made anew, the name is gone for a moment.
    """
    schema = known_schema(spark, path)
    if schema is None:
        return
    now = {field.name.lower(): field.dataType for field in spark.table(name).schema.fields}
    added = [field for field in schema.fields if field.name.lower() not in now]
    if any(now.get(field.name.lower(), field.dataType) != field.dataType for field in schema.fields):
        described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        if described["Type"] != "EXTERNAL":
            raise ValueError(f"{name} owns its files; its types can't be changed")
        spark.sql(f"DROP TABLE {name}")
        create_table(spark, name, path, schema, partition_by)
    elif added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_listed(added)})")


def create_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by) -> None:
    parts = f"PARTITIONED BY ({', '.join(f'`{column}`' for column in partition_by)})" if partition_by else ""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({_listed(schema.fields)}) USING parquet {parts} LOCATION '{place}'")


def _listed(fields) -> str:
    return ", ".join(f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in fields)
