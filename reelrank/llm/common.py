"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

#: Words are runs of anything but ASCII white space; ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"

#: The columns of ``documents``.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the package to the Python workers, once a session; Spark serves it to executors."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        # The driver serves the archive for as long as the session lives.
        folder = tempfile.mkdtemp(prefix="reelrank-py-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = os.path.join(folder, "reelrank")
        context.addPyFile(shutil.make_archive(name, "zip", root, "reelrank"))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, text_col: str = "text"
) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents, as (doc_id, text, label).

    The ids with the smallest hashes are taken, so reruns agree. ``rows`` is the
    bound: two numbers a row are broadcast to the scan of ``docs``, whose texts
    are then not shuffled. Rows of ``labels`` without an id or a label are left
    out; an id that is labelled twice counts with its larger label.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")


#: Characters of text, and rows, that are worked on together.
PART_BYTES, PART_ROWS = 1 << 20, 2000

_ARROW = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
}


def _arrow_type(kind: str) -> pa.DataType:
    inner = kind.removeprefix("array<").removesuffix(">")
    return _ARROW[kind] if inner == kind else pa.list_(_ARROW[inner])


def parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PART_BYTES of text, or one row with a longer text."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0)
    upto = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(batch):
        full = np.searchsorted(upto, (upto[at - 1] if at else 0) + PART_BYTES)
        end = min(max(at + 1, int(full)), at + PART_ROWS, len(batch))
        yield batch.slice(at, end - at)
        at = end


def beside(
    frame: DataFrame,
    keep: list[str],
    text: str,
    fields: dict[str, str],
    work: Callable[[], Callable],
    more: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``frame`` as columns ``keep`` and new columns ``fields``, made from ``text``.

    Kept columns never leave Arrow, so a 64-bit id beside a null comes back as it is. Each task calls
    ``work()`` once; what it returns gets the texts of a part and its ``more`` columns, in Arrow, and
    gives (rows, values): the places of the rows that stay (None for all), and a sequence for each
    new column.
    """
    kept = [T.StructField(c, frame.schema[c].dataType) for c in keep]
    new = [T.StructType.fromDDL(f"`{name}` {kind}").fields[0] for name, kind in fields.items()]
    kinds = [_arrow_type(kind) for kind in fields.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = work()
        for batch in batches:
            for part in parts(batch, text):
                rows, values = make(*[part.column(c) for c in (text, *more)])
                own = part.select(keep)
                if rows is not None:
                    own = own.take(pa.array(rows, pa.int64()))
                made = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*own.columns, *made], names=[*keep, *fields])

    needed = list(dict.fromkeys([*keep, text, *more]))
    schema = T.StructType([*kept, *new])
    return frame.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(run, schema)
