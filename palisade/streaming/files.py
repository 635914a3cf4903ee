"""CSV files into the lake as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palisade.sinks.tables import write_table
from palisade.session import scratch
from palisade.sources.aligned_csv import DAY_ROWS, align, align_records, by_day, file_headers, header_report, read_records, widest_header
from palisade.streaming.ingest import run_available, write_batch


def lake_new_files(
    lines: DataFrame,
    lake: str,
    checkpoint: str,
    columns: list[str],
    types: dict[str, str] | None = None,
    date_column: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda aligned: aligned,
    report: str | None = None,
) -> StreamingQuery:
    """Align the files of each micro-batch and add them to the lake by year, month, day and batch.

    A file belongs to one micro-batch as a whole, header included. The batch number is the last partition
    column: a batch that is tried again replaces its own folders and leaves earlier ones alone. ``prepare``
    may add columns, such as the date. Torn files of the batch are read as whole records. ``report`` is a folder for the
    header report of each batch, with the columns that ``columns`` leaves out.
    """

    def handle(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            headers = file_headers(batch)
            aligned = align(batch, headers, columns, types)
            if torn := [row.file for row in headers.where("torn").select("file").collect()]:
                records = read_records(batch.sparkSession, torn, widest_header(headers) + 1)
                aligned = aligned.unionByName(align_records(records, headers.where("torn"), columns, types))
            dated = by_day(prepare(aligned), date_column).withColumn("batch", F.lit(number))
            write_table(dated, lake, partition_by=["year", "month", "day", "batch"], most_rows=DAY_ROWS)
            if report:
                write_batch(header_report(headers, columns), report, number)

    return run_available(lines, handle, checkpoint)
