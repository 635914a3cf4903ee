"""CSV files whose columns differ in number and order, aligned by header name.

All files are read in one scan. Each file's header says at which position a column stands; every line is
split once and its values are picked by position. Files are cut into blocks like any text, so one large file
is read by many tasks; files whose values contain line breaks are found by their open quotes and go through the
whole-file reading of ``read_records``. Files share few distinct headers, so a row carries its file's header by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.session import settle
from palisade.sinks.tables import write_table

# Quotes inside a quoted value are doubled.
CSV_OPTIONS = {"mode": "PERMISSIVE", "escape": '"'}
MAX_COLUMNS = 10_000
# Up to so many torn files are opened by name; beyond, all files are scanned for them. The rows are the same.
LISTED_FILES = 10_000
# A day of the lake with more rows goes to several tasks. Rows repeat their file's path, so their bytes say little.
DAY_ROWS = 1_000_000


def read_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Every line below ``path`` with its file and where its block starts. No header line is special yet."""
    return _lines(spark.read, path, glob)


def new_lines(spark: SparkSession, path: str, glob: str = "*.csv", files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream: the lines of files that the stream's checkpoint has not seen yet."""
    reader = spark.readStream if files_per_batch is None else spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _lines(reader, path, glob)


def _lines(reader, path: str, glob: str) -> DataFrame:
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _with_fields(df: DataFrame, line: str, count: int, name: str) -> DataFrame:
    """Adds the first ``count`` values of a CSV line as an array of strings; the line is parsed once."""
    slots = [f"c{number}" for number in range(count)]
    parsed = F.from_csv(line, ", ".join(f"{slot} STRING" for slot in slots), CSV_OPTIONS)
    return (
        df.withColumn("_parsed", parsed)
        .withColumn(name, F.array(*[F.col(f"_parsed.{slot}") for slot in slots]))
        .drop("_parsed")
    )


def file_heads(lines: DataFrame) -> DataFrame:
    """One row per file that holds text: ``file``, ``header`` (its first line with text), ``torn`` (some line leaves a quote
    open, so a value goes on in the next line) and ``lines`` (how many with text).

    Blocks are numbered by where they start and lines of a block in reading order, so blank lines may fill whole blocks
    before the header. Written once, as the numbering must not be evaluated again.
    """
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    place = F.struct("block_start", F.monotonically_increasing_id())
    found = (
        lines.where(F.trim("line") != "")
        .select("file", "line", place.alias("place"), (quotes % 2 == 1).alias("open"))
        .groupBy("file")
        .agg(F.min_by("line", "place").alias("header"), F.max("open").alias("torn"), F.count("*").alias("lines"))
    )
    return settle(found, "csv-heads")


def file_headers(lines: DataFrame) -> DataFrame:
    """``file_heads`` with ``names``, the column names in order. Each distinct header is parsed once."""
    heads = file_heads(lines)
    distinct = heads.select("header").distinct()
    commas = F.length("header") - F.length(F.replace(F.col("header"), F.lit(","), F.lit("")))
    widest = distinct.agg(F.max(commas)).first()[0]
    if widest is None:
        return heads.withColumn("names", F.array().cast("array<string>"))
    named = _with_fields(distinct, "header", widest + 1, "names").withColumn("names", F.transform("names", lambda name: F.trim(name)))
    last = F.array_max(F.transform("names", lambda name, place: F.when(name.isNotNull(), place + 1)))
    return heads.join(named.withColumn("names", F.slice("names", 1, F.coalesce(last, F.lit(0)))), "header")


def column_names(headers: DataFrame) -> list[str]:
    """All names that occur in any header, sorted: the schema of the aligned table.

    More than ``MAX_COLUMNS`` names can't be columns of one table and are refused; the report lists them by file.
    """
    names = headers.select("names").distinct().select(F.explode("names").alias("name")).where("name IS NOT NULL").distinct()
    found = sorted(row.name for row in names.limit(MAX_COLUMNS + 1).collect())
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} column names; give the columns wanted")
    return found


def header_report(headers: DataFrame, columns: list[str]) -> DataFrame:
    """Per file: how many columns, which of ``columns`` it lacks, which names repeat, which are unknown."""
    wanted = F.array(*[F.lit(name) for name in columns])
    times = lambda name: F.size(F.filter("names", lambda other: other == name))
    return headers.select(
        "file",
        F.size("names").alias("column_count"),
        F.array_sort(F.array_except(wanted, "names")).alias("missing"),
        F.array_sort(F.array_distinct(F.filter("names", lambda name: times(name) > 1))).alias("repeated"),
        F.array_sort(F.array_except("names", wanted)).alias("unknown"),
    )


def _with_places(rows: DataFrame, headers: DataFrame, columns: list[str], kept: list[str]) -> DataFrame:
    """Each row with ``kept`` of its file's header and the position of every wanted column, -1 where it is absent.

    Rows first get the number of their file's header, from two narrow columns, then what belongs to the number. Both joins
    are left to AQE: it broadcasts what measures small and splits the rows of a large file. Files without a header are
    those without text, so no row is lost.
    """
    numbered = headers.select("file", F.xxhash64("header").alias("variant"))
    wanted = F.array(*[F.lit(name) for name in columns])
    places = F.transform(wanted, lambda name: F.array_position("names", name) - 1).alias("places")
    variants = headers.select(F.xxhash64("header").alias("variant"), *kept, places).dropDuplicates(["variant"])
    return rows.join(numbered, "file").join(variants, "variant")


def _picked(rows: DataFrame, columns: list[str], types: dict[str, str] | None) -> DataFrame:
    chosen = []
    for number, name in enumerate(columns):
        place = F.col("places")[number].cast("int")
        value = F.when(place >= 0, F.get("values", place))
        kind = (types or {}).get(name)
        chosen.append((value.try_cast(kind) if kind else value).alias(name))
    surplus = F.get("values", F.size("names")).isNotNull().alias("surplus")
    return rows.select(*chosen, surplus, *[c for c in ("extra", "file", "modified") if c in rows.columns])


def widest_header(headers: DataFrame) -> int:
    return headers.agg(F.max(F.size("names"))).first()[0] or 0


def align(
    lines: DataFrame, headers: DataFrame, columns: list[str], types: dict[str, str] | None = None, keep_extra: bool = False
) -> DataFrame:
    """The data lines of all files that aren't torn, as a table of ``columns``; NULL where a file lacks one.

    The first of repeated names counts. Blank lines and lines equal to their file's header are left out.
    ``types`` casts columns, with NULL for text that does not fit. ``surplus`` marks lines that go on after
    their last named column; ``file`` and ``modified`` say where a line came from. With ``keep_extra`` the column
    ``extra`` keeps the whole line where it holds values of other columns or past the last name. Torn files never come out in
    halves: see ``torn_files`` and ``read_aligned``.
    """
    whole = headers.where(~F.col("torn"))
    data = lines.where(F.trim("line") != "").select("line", "file", "modified")
    placed = _with_places(data, whole, columns, ["header", "names"]).where(F.col("line") != F.col("header"))
    values = _with_fields(placed, "line", widest_header(headers) + 1, "values")
    if keep_extra:
        more = F.size(F.array_except("names", F.array(*[F.lit(name) for name in columns]))) > 0
        values = values.withColumn("extra", F.when(more | F.get("values", F.size("names")).isNotNull(), F.col("line")))
    return _picked(values, columns, types)


def torn_files(headers: DataFrame) -> DataFrame:
    """The files that have to be read as whole records."""
    return headers.where("torn").select("file", "lines")


def read_records(spark: SparkSession, path: str | list[str], width: int, glob: str = "*.csv") -> DataFrame:
    """CSV records that may span lines, as an array of ``width`` values. Every file is read by one task."""
    slots = [f"c{number}" for number in range(width)]
    reader = spark.read.schema(", ".join(f"{slot} STRING" for slot in slots)).options(**CSV_OPTIONS)
    reader = reader.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.csv(path).select(
        F.array(*slots).alias("values"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def align_records(records: DataFrame, headers: DataFrame, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """The same for whole records; those equal to their file's column names are left out."""
    placed = _with_places(records, headers, columns, ["names"])
    named = F.transform(F.slice("values", 1, F.size("names")), lambda value: F.trim(value))
    return _picked(placed.where(~named.eqNullSafe(F.col("names"))), columns, types)


def read_aligned(
    spark: SparkSession, path: str, columns: list[str] | None = None, types=None, glob="*.csv", multi_line: bool = False
) -> DataFrame:
    """Align every CSV file below ``path``; all columns found when ``columns`` is not given.

    Files that hold values with line breaks are read as whole records, each by one task; the others line by line.
    ``multi_line`` reads all files that way, for the odd file whose quotes come out even by chance. The header itself must
    be one line.
    """
    lines = read_lines(spark, path, glob)
    headers = file_headers(lines)
    columns = column_names(headers) if columns is None else columns
    records = read_records(spark, path, widest_header(headers) + 1, glob)
    if multi_line:
        return align_records(records, headers, columns, types)
    torn = headers.where("torn")
    if torn.isEmpty():
        return align(lines, headers, columns, types)
    paths = [row.file for row in torn.select("file").collect()] if torn.count() <= LISTED_FILES else None
    if paths is not None:  # only these files are opened
        records = read_records(spark, paths, widest_header(headers) + 1, glob)
    return align(lines, headers, columns, types).unionByName(align_records(records, torn, columns, types))


def by_day(aligned: DataFrame, date_column: str | None = None) -> DataFrame:
    """Adds year, month and day of ``date_column``, or of the file's modification time without one."""
    when = F.to_date(F.col(date_column or "modified"))
    return aligned.withColumns({"year": F.year(when), "month": F.month(when), "day": F.dayofmonth(when)})


def write_lake(aligned: DataFrame, path: str, load: str, date_column: str | None = None) -> int:
    """Parquet by year, month, day and load. A load that is repeated replaces itself; others of the same day stay."""
    dated = by_day(aligned, date_column).withColumn("load", F.lit(load))
    return write_table(dated, path, ["year", "month", "day", "load"], stale=lambda values: values["load"] == load, most_rows=DAY_ROWS)
