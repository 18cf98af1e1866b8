"""What the corpus operators share: the documents table, words, and Arrow passes over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled this many bytes at a time at most inside a batch, whatever the batch holds.
CHUNK_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that no other column can clash with what an operator adds."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Written to a folder of the shared one and read back, so that a lost executor costs no earlier step."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part holds more than CHUNK_BYTES of text, unless one text does alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and held + size > CHUNK_BYTES:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


def arrow_map(
    df: DataFrame, text: str, schema: str, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """Pass the rows through `start()`'s function, in Arrow batches of bounded text size.

    `start` runs once per task, so that vocabularies and caches are made where they are used.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for piece in pieces(batch, text):
                yield step(piece)

    return df.mapInArrow(run, schema)
