"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder, by whatever store Spark can read."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, or the empty text for NULL."""
    return F.coalesce(text, F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from: crc32 of the id's digits divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty if there are none."""
    trimmed = F.btrim(whole(text), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def packed(rows: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``rows`` as one struct ``row``, next to new columns; no name can clash."""
    every = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    return rows.select(every.alias("row"), *(value.alias(name) for name, value in columns.items()))


Computed = dict[str, list]
# Texts that become Python strings at a time, beyond the first.
SLICE_BYTES = 8 * 2**20


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts have ``most`` bytes together, or are one text; no part without rows."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).cumsum(dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(sizes[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def with_computed(
    rows: DataFrame,
    keep: Sequence[str],
    text: str,
    fields: str,
    make: Callable[[], Callable[[list[str | None]], Computed]],
) -> DataFrame:
    """``keep`` columns of ``rows`` as they are, and ``fields`` computed from the text of each row.

    ``make`` runs once per task and returns a function from the texts of a batch
    to the values of the new columns. Kept columns stay in Arrow, so large numbers
    next to NULLs, nested values and dates come through unchanged. A kept column
    that has the name of a field is left out.
    """
    added = T.StructType.fromDDL(fields)
    keep = [c for c in keep if c not in added.names]
    at = keep.index(text) if text in keep else len(keep)
    given = rows.select(*(F.col(f"`{c}`") for c in keep), *([F.col(f"`{text}`").alias("_text")] if at == len(keep) else []))
    types = [to_arrow_type(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in (part for whole_batch in batches for part in slices(whole_batch, at)):
            found = compute(batch.column(at).to_pylist())
            new = [pa.array(found[n], type=t) for n, t in zip(added.names, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + new, names=keep + added.names)

    return given.mapInArrow(run, T.StructType([given.schema[c] for c in keep] + list(added)))
