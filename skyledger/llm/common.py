"""Helpers shared by the training-data operators.

Fixed conventions of the package: a null text is an empty text, a null id
hashes like an empty string, words are maximal runs of bytes outside ASCII
white space (0x20, 0x09-0x0D), and intermediate tables go to the folder in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from types import ModuleType

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_path


_HOME = "_skyledger_llm_worker"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def id_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as ''."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    as_bytes = F.coalesce(col.cast("string"), F.lit("")).cast("binary")
    return F.crc32(as_bytes) % modulus


# Tables and folders that calls in this driver process have made, for ``release``.
_made: list[tuple[str | None, str]] = []
# Of a dealt table.  A bucket holds many parts of a large input; Spark allows 100,000.
MAX_BUCKETS = 8192


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives lost executors without running
    the work again.
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    _made.append((None, path))
    return spark.read.schema(df.schema).parquet(path)


def dealt_table(rows: DataFrame, column: str, parts: int) -> str:
    """Deal ``rows`` by ``column`` (of ``parts`` values) once and keep them as a bucketed table; its name.

    Reading the table grouped by ``column`` needs no shuffle, so operators
    that go over the same texts several times move them only here.  Its files
    are in the checkpoint folder.  It stays for the result that reads it;
    ``release`` removes it afterwards.
    """
    name = f"skyledger_parts_{uuid.uuid4().hex}"
    path = checkpoint_path(rows.sparkSession, "llm", name)
    buckets = min(parts, MAX_BUCKETS)
    writer = rows.repartition(buckets, column).write.option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, column).format("parquet").saveAsTable(name)
    _made.append((name, path))
    return name


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables of all calls so far; results that read them must have been stored."""
    while _made:
        name, path = _made.pop()
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def worker_store() -> dict:
    """A dictionary of this Python worker process that outlives the task, for caches."""
    home = sys.modules.setdefault(_HOME, ModuleType(_HOME))
    return home.__dict__


def field(df: DataFrame, column: str, name: str | None = None) -> T.StructField:
    """A field of ``df`` for the schema of a Python stage."""
    return T.StructField(name or column, df.schema[column].dataType, True)


def byte_values(batch: pa.RecordBatch, column: int) -> list[bytes]:
    """A string column of an Arrow batch as a list of bytes, null as empty."""
    values = batch.column(column)
    if pa.types.is_large_string(values.type):
        values = values.cast(pa.large_binary())
    elif not pa.types.is_binary(values.type):
        values = values.cast(pa.binary())
    return [v or b"" for v in values.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows into slices of about ``max_bytes`` of text.

    A single longer text is a slice of its own and is never cut.
    """
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if row > first and held + size > max_bytes:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first, batch.num_rows - first)
