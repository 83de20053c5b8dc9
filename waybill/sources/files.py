"""Text and document files, and where they lie.

Folders are ``source=<name>`` below a root, so that a filter on ``source`` reads only the
files of that source.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.sources.schema import SOURCE_FILE


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="waybill-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, source: DataFrame | None = None, finer: int = 1) -> DataFrame:
    """Rows of an input of fewer splits than cores over all cores; others stay where they are.

    Text work costs far more than its bytes suggest.  The splits are those of ``source``, a
    plain scan, if ``df`` is derived from it.  Thin rows that become long texts are dealt into
    ``finer`` times as many parts as there are splits, so that no task is long at any size.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = (df if source is None else source).rdd.getNumPartitions()
    if finer > 1:
        return df.repartition(max(cores, finer * splits))
    return df.repartition(cores) if splits < cores else df


_FILE = "path string, modificationTime timestamp, length long, content binary"


def _texts(files: DataFrame, keep_unreadable: bool = False) -> DataFrame:
    partitions = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    readable = F.is_valid_utf8(F.col("content").cast("string"))
    text = F.when(readable, F.col("content").cast("string"))
    bytes_of = [F.when(~readable, F.col("content")).alias("unreadable")] if keep_unreadable else []
    return files.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE), text.alias("text"), *bytes_of, *partitions
    )


def scan_text_files(
    spark: SparkSession,
    path: str,
    glob: str = "*.txt",
    recursive: bool = False,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Whole text files: ``source_file, text`` and the partition columns of the path.

    ``source_file`` is the percent-encoded address.  A file that is not UTF-8 has NULL as
    its text, for the status operators to set aside, and its bytes in ``unreadable`` if they
    are asked for.  Spark's scan gives no row for a file of no bytes.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(path)
    )
    return _texts(files, keep_unreadable)


def stream_text_files(
    spark: SparkSession, path: str, glob: str = "*.txt", partitions: str = "", files_per_batch: int = 100_000
) -> DataFrame:
    """The same rows as a stream of the files that come to lie below ``path``.

    A query on it with a checkpoint reads every file once, however often it is started anew, so
    with the trigger ``availableNow`` each run works on what is new since the last.
    ``partitions`` declares the columns of the path, such as ``source string``.
    """
    schema = ", ".join(part for part in (_FILE, partitions) if part)
    files = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return _texts(files)


#: Stands after every text of a packed file; a character no text may hold.
SEPARATOR = "\f"


def _packed(lines: DataFrame) -> DataFrame:
    partitions = [c for c in lines.columns if c != "value"]
    readable = F.is_valid_utf8(F.col("value"))
    return lines.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.when(readable, F.col("value")).alias("text"),
        F.when(~readable, F.col("value").cast("binary")).alias("unreadable"),
        *partitions,
    )


def scan_packed_texts(
    spark: SparkSession, path: str, separator: str = SEPARATOR, glob: str = "*.txt"
) -> DataFrame:
    """Texts of files that hold many: ``source_file, text, unreadable`` and the path's partition columns.

    A large file is read by several tasks, and a table of many small texts needs few files.  Texts of
    one file share its address.  One that is not UTF-8 has NULL as its text and its bytes in
    ``unreadable``; the others of its file are as they are.  An empty text is a row, a file of no
    bytes gives none, and a byte order mark at the start of a file belongs to no text.
    """
    lines = spark.read.format("text").option("lineSep", separator).option("pathGlobFilter", glob)
    return _packed(lines.load(path))


def stream_packed_texts(
    spark: SparkSession,
    path: str,
    separator: str = SEPARATOR,
    glob: str = "*.txt",
    partitions: str = "",
    files_per_batch: int = 10_000,
) -> DataFrame:
    """The same rows as a stream of the files that come to lie below ``path``, as with
    :func:`stream_text_files`."""
    schema = ", ".join(part for part in ("value string", partitions) if part)
    lines = (
        spark.readStream.format("text")
        .schema(schema)
        .option("lineSep", separator)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    return _packed(lines.load(path))


def display_path(source_file: Column) -> Column:
    """A source file's address with its percent codes read; ``+`` stays a plus."""
    return F.url_decode(F.replace(source_file, F.lit("+"), F.lit("%2B")))


def discover_documents(spark: SparkSession, root: str, extension: str = ".pdf") -> DataFrame:
    """Files below ``root`` at any depth, the extension in any case; contents not read."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{letters}")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def read_source(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Rows of one source of a partitioned table; the others are not listed in the scan."""
    return spark.read.parquet(root).filter(F.col("source") == source)
