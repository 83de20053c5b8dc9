"""Texts as they arrive to load rows, each text once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waybill.operators.extract import get_extractor
from waybill.operators.status import document_status
from waybill.sources.sinks import append_stream


def extract_with_status(
    texts: DataFrame, extractor: str = "load_confirmation", text: str = "text"
) -> DataFrame:
    """Every document with its ``status`` and ``error``, its columns but the text, and its fields.

    The fields of a document that failed or is empty are blank.  One map-only stage, on a batch or
    on a stream.
    """
    docs = document_status(texts, text)
    return get_extractor(extractor)(docs, text=text, keep=[c for c in docs.columns if c != text])


def extract_new_texts(
    texts: DataFrame, path: str, checkpoint: str, extractor: str = "load_confirmation"
) -> int:
    """One run of the job over a stream of texts: what is new since the last run is extracted and
    appended below ``path``, by ``status``, so that a reader of good loads does not open the others.

    Returns how many texts there were.  Runs share ``checkpoint``; a run that fails leaves no rows, and
    the next one takes its files.
    """
    return append_stream(extract_with_status(texts, extractor), path, checkpoint, "status")
