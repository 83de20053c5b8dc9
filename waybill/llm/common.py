"""What several operators share: worker caches, tables in the shared folder, row keys."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from waybill.sources.files import shared_folder

#: Unicode White_Space, as a character class.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Entries in each of a memo's two halves, and the longest key it holds.
MEMO_ENTRIES = 400_000
MEMO_CHARS = 40


def per_worker(name: str, build: Callable[[], Any]) -> Any:
    """A value built once in each Python worker process."""
    store = sys.modules.setdefault("waybill_llm_worker", types.ModuleType("waybill_llm_worker"))
    if not hasattr(store, name):
        setattr(store, name, build())
    return getattr(store, name)


class Memo(dict):
    """Results by string, of bounded size: when it is full, what was not asked for since it was
    last full goes.  Long keys are not held."""

    def __init__(self, compute: Callable[[Any], Any], entries: int = MEMO_ENTRIES):
        super().__init__()
        self.compute = compute
        self.entries = entries
        self.older: dict = {}

    def __missing__(self, key: Any) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it again: cut lineage, computed once."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(
    docs: DataFrame, keep: Sequence[str], text_col: str, once: bool = False
) -> tuple[DataFrame, list[str], str]:
    """Columns ``keep`` as ``k0, k1, ...``, which clash with nothing, their names, and that of the
    text: ``text``, NULL as empty.  With ``once`` a kept text is not sent a second time; it is
    as given then, so that ``texts_of`` must read it."""
    names = [f"k{i}" for i in range(len(keep))]
    columns = [F.col(f"`{c}`").alias(name) for c, name in zip(keep, names)]
    if once and text_col in keep and isinstance(docs.schema[text_col].dataType, StringType):
        return docs.select(*columns), names, names[list(keep).index(text_col)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    return docs.select(*columns, text), names, "text"


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a batch, NULL as empty."""
    return [text or "" for text in column.to_pylist()]


def schema_with(rows: DataFrame, names: Sequence[str], more: str) -> StructType:
    """Fields ``names`` of ``rows``, then those of ``more``."""
    added = StructType.fromDDL(more).fields if more else []
    return StructType([*(rows.schema[name] for name in names), *added])


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of an id as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))
