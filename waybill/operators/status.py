"""Per-document outcome of text extraction, and the gate on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

OK, EMPTY, FAILED = "ok", "empty", "failed"


class NothingProcessed(RuntimeError):
    """No document gave any text."""


def has_text(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def document_status(df: DataFrame, text: str = "text", error: str | None = None) -> DataFrame:
    """Adds ``status`` and ``error``: a document that fails never stops the others.

    A document failed if its text could not be decoded (NULL) or an ``error`` column says
    so; it is empty if its text is.
    """
    message = F.col(error) if error else F.lit(None).cast("string")
    message = F.coalesce(message, F.when(F.col(text).isNull(), F.lit("text not readable")))
    status = F.when(message.isNotNull(), FAILED).when(has_text(F.col(text)), OK).otherwise(EMPTY)
    return df.withColumns({"status": status, "error": message})


def split_status(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents to go on with, and the quarantined rest."""
    return df.filter(F.col("status") == OK), df.filter(F.col("status") != OK)


def _counts() -> list[Column]:
    return [
        F.count("*").alias("n_documents"),
        F.count_if(F.col("status") == OK).alias("n_ok"),
        F.count_if(F.col("status") == EMPTY).alias("n_empty"),
        F.count_if(F.col("status") == FAILED).alias("n_failed"),
    ]


def extraction_status(df: DataFrame) -> DataFrame:
    """One row of counts, and whether anything was processed at all."""
    return df.agg(*_counts()).withColumn("passed", F.col("n_ok") > 0)


def observe_status(df: DataFrame, name: str = "extraction") -> tuple[DataFrame, Observation]:
    """The same counts, collected by whatever job writes ``df``; no extra scan."""
    observation = Observation(name)
    return df.observe(observation, *_counts()), observation


def require_processed(status: DataFrame) -> None:
    if status.first()["n_ok"] == 0:
        raise NothingProcessed("No documents were processed")
