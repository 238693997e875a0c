"""What the operators of this package share.

Tables are read by Spark only. Every operator takes the columns it needs by name and
works on columns of its own, so further columns, whatever their names, do not matter.
A null text is an empty text. Rows that repeat, in whole or by id, each count.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = "\t\n\x0b\f\r "

# Texts are taken in slices of about so many bytes, so that what a task holds beside one
# Arrow batch does not depend on the number of rows in the batch.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id``, ``text`` ('' for null) and further columns, nothing else."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *columns,
    )


def id_bucket(column: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


def native_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array, by SQL functions."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+", -1)
    )


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, or that with underscores in front, so that no column is called so."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``SLICE_BYTES`` of ``column``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(lengths.astype(np.int64)) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, schema.field(name).type)
            for name, c in ((n, columns[n]) for n in schema.names)
        ],
        schema=schema,
    )


def shared_file(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a place in the shared folder, in tasks as on the driver."""
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "", 1))


def commit_file(uri: str, temporary: str) -> None:
    """Give a finished file its name. A second attempt of a task writes the same bytes."""
    files, path = shared_file(uri)
    files.move(shared_file(temporary)[1], path)
