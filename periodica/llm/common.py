"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000  # rows of a few numbers that are broadcast at most; more are joined by shuffle

SLICE_CHARS = 500_000  # of text that a Python worker unpacks at once
BATCH_BYTES = "4m"  # of a batch between JVM and Python where a stage is written out at once

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


OWN_FOLDERS: dict[str, str] = {}  # by application, where the setting is unset


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session. Only where it is
    unset on one machine, as in tests, a temporary folder takes its place."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        application = spark.sparkContext.applicationId
        folder = OWN_FOLDERS.setdefault(application, "") or tempfile.mkdtemp(prefix="periodica-")
        OWN_FOLDERS[application] = folder
    return folder.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write `frame` to the shared folder and read it back: lineage ends there, and a lost
    executor costs no more than the tasks that read from it."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/periodica/{name}-{uuid.uuid4().hex}"
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, BATCH_BYTES)  # for this one job
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return spark.read.schema(frame.schema).parquet(path)


def slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(place of the first, texts): a column of texts in slices of about SLICE_CHARS bytes, each unpacked when it
    is asked for. A longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(texts):
        reach = (ends[at - 1] if at else 0) + SLICE_CHARS
        end = max(at + 1, int(np.searchsorted(ends, reach, "right")))
        yield at, texts.slice(at, end - at).to_pylist()
        at = end


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def whole(text: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def checked(ids: DataFrame, name: str) -> DataFrame:
    """`ids`, written, and to be broadcast if they are few enough: a join with texts then moves no text."""
    kept = stored(ids, name)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def rows_with(docs: DataFrame, hashed: Column, keys: DataFrame, how: str) -> DataFrame:
    """Rows of `docs` by a semi or anti join with `keys` (doc_id, hash), where `hashed` gives a row's hash of
    its text: of rows that share a doc_id only those with such a text are meant. Names of extra columns can't
    clash because the row travels as one struct. A null doc_id matches nothing."""
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), hashed.alias("own_hash"))
    found = checked(keys.select("doc_id", "hash").distinct(), "row-keys")
    return packed.join(found, (F.col("own_id") == F.col("doc_id")) & (F.col("own_hash") == F.col("hash")), how).select("row.*")
