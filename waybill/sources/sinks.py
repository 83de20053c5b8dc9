"""Tables, partitioned text and CSV reports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waybill.operators.status import document_status, observe_status
from waybill.sources.files import SEPARATOR
from waybill.sources.schema import load_schema

MAX_RECORDS_PER_FILE = 1_000_000
#: Bytes, before encoding, of the rows that a file of a table is made of.
FILE_BYTES = 256 << 20


def conform(loads: DataFrame) -> DataFrame:
    """The declared columns in declared order, bound by name, with their comments.

    Columns the table does not declare follow at the end, as a merged schema has them.
    """
    declared = load_schema().fields
    names = {field.name for field in declared}
    return loads.select(
        *[
            (F.col(field.name) if field.name in loads.columns else F.lit(None))
            .cast(field.dataType)
            .alias(field.name, metadata=field.metadata)
            for field in declared
        ],
        *[name for name in loads.columns if name not in names],
    )


def write_loads(loads: DataFrame, table: str | None = None, path: str | None = None) -> None:
    """Replace the load table, by name or by path."""
    writer = (
        conform(loads)
        .write.mode("overwrite")
        .format("parquet")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    )
    if table is None:
        writer.save(path)
    elif path is None:
        writer.saveAsTable(table)
    else:
        writer.option("path", path).saveAsTable(table)


class SchemaConflict(ValueError):
    """A column has another type in the stored table."""


def merged(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the columns of the stored table first, in its order: those that ``df`` has not are
    NULL, those that the table has not follow.  A column of another type is refused."""
    if not df.sparkSession.catalog.tableExists(table):
        return df
    stored = df.sparkSession.table(table).schema
    given = {field.name.lower(): field for field in df.schema}
    if len(given) < len(df.columns):
        raise SchemaConflict("columns that differ in case only")
    columns = []
    for field in stored:
        mine = given.pop(field.name.lower(), None)
        if mine is not None and mine.dataType != field.dataType:
            raise SchemaConflict(f"{field.name}: {mine.dataType.simpleString()}, stored {field.dataType.simpleString()}")
        value = F.lit(None).cast(field.dataType) if mine is None else F.col(f"`{mine.name}`")
        columns.append(value.alias(field.name, metadata=field.metadata))
    return df.select(*columns, *[F.col(f"`{field.name}`") for field in given.values()])


@contextmanager
def _file_size(spark: SparkSession, size: int) -> Iterator[None]:
    """Partitions dealt anew get about ``size`` bytes each, even if that leaves cores idle."""
    wanted = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def replace_table(df: DataFrame, table: str, root: str, file_bytes: int = FILE_BYTES) -> str:
    """Replace a table's rows, and return the folder that holds them.

    The rows are written to a new folder below ``root``; only when all are there is the table
    made to point to it.  A write that fails leaves the table as it was, and so do readers that
    started before.  Columns of the stored table stay (see :func:`merged`), new ones are added.
    Rows are dealt anew into files of about ``file_bytes``.  Earlier folders stay until they are
    removed by whoever owns ``root``.
    """
    spark = df.sparkSession
    df = merged(df, table)
    path = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    with _file_size(spark, file_bytes):
        df.hint("rebalance").write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
        return path
    stored = {name.lower() for name in spark.table(table).columns}
    new = [field for field in df.schema if field.name.lower() not in stored]
    if new:
        # Rows written before have NULL there, so the order of the two changes does not matter.
        spec = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({spec})")
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{escaped}'")
    spark.catalog.refreshTable(table)
    return path


def replace_loads(loads: DataFrame, table: str, root: str, file_bytes: int = FILE_BYTES) -> str:
    """Replace the load table, declared columns first, as :func:`replace_table` does."""
    return replace_table(conform(loads), table, root, file_bytes)


def write_by_status(docs: DataFrame, path: str, text: str = "text") -> Observation:
    """Every document below ``path``, good and quarantined ones in folders of their own by ``status``,
    in one pass; the counts of each kind are observed by the write."""
    df, counts = observe_status(document_status(docs, text), f"status-{uuid.uuid4().hex}")
    write_partitioned(df, path, "status")
    return counts


def _by_partition(df: DataFrame, *columns: str) -> DataFrame:
    # Evens out file sizes: small partitions are joined and a hot one is split over
    # several tasks when the query runs.
    return df.hint("rebalance", *columns)


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    (
        _by_partition(df, *columns)
        .write.mode("overwrite")
        .partitionBy(*columns)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(path)
    )


def write_text(
    df: DataFrame,
    path: str,
    *partitions: str,
    text: str = "text",
    records_per_file: int = 1,
    mode: str = "overwrite",
) -> None:
    """Texts as files below ``path``, each ``records_per_file`` of them (with a line end)."""
    writer = (
        df.select(F.col(text).alias("value"), *partitions)
        .write.mode(mode)
        .option("maxRecordsPerFile", records_per_file)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.text(path)


def write_packed_texts(
    df: DataFrame,
    path: str,
    *partitions: str,
    text: str = "text",
    separator: str = SEPARATOR,
    mode: str = "overwrite",
) -> None:
    """Texts as few files below ``path``, the separator after each; a text that holds it is refused.

    Rows go to files of about an advisory partition's size, a hot partition to several.  NULL is
    written as an empty text.
    """
    value = F.col(text).cast("binary")
    torn = F.contains(value, F.lit(separator).cast("binary"))
    whole = F.when(torn, F.raise_error(F.lit("a text holds the separator"))).otherwise(F.col(text))
    rows = df.select(whole.alias("value"), *partitions)
    writer = _by_partition(rows, *partitions).write.mode(mode).option("lineSep", separator)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A report with a header, in UTF-8."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def append_stream(df: DataFrame, path: str, checkpoint: str, *partitions: str) -> int:
    """Run a stream over all there is now and append its rows below ``path``; returns how many there
    were.  What a run that failed has left over is written by the next, once."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return sum(progress.numInputRows for progress in running.recentProgress)
