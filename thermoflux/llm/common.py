"""Helpers that several operators of this folder share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoflux.session import ensure_checkpoint_dir

#: Words are runs of anything but U+0020 and U+0009..U+000D.  ``bytes.split()`` cuts at
#: exactly these six bytes, so word work is done on UTF-8 bytes.
CHUNK_CHARS = 1 << 20
#: Spark's setting that deletes the shuffle files of a query as soon as the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file; the package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back: it is computed
    once, and a lost executor costs a re-read, not the work above.  Nothing reads the shuffle
    files behind it again, so they go at once and not when the driver next collects garbage."""
    spark = df.sparkSession
    path, was = scratch_table(spark, name), spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def as_text(df: DataFrame, text: str = "text") -> F.Column:
    """The text column, null read as empty."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def text_chunks(batch: pa.RecordBatch, text: str = "text", chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """Cut an Arrow batch into runs of rows of about ``chars`` characters (one row at
    least): (first row, row after the last, texts).  Bounds the memory of vectorised work."""
    column, n, at = batch.column(text), batch.num_rows, 0
    while at < n:
        texts, size, end = [], 0, at
        while end < n and (size < chars or end == at):
            t = column[end].as_py() or ""
            texts.append(t)
            size += len(t)
            end += 1
        yield at, end, texts
        at = end


def map_texts(df: DataFrame, work: Callable[[list, list[str]], dict], schema: str, key: str = "doc_id",
              text: str = "text", chars: int = CHUNK_CHARS) -> DataFrame:
    """Map (keys, texts) of bounded chunks to the columns of ``schema``; map-only, no shuffle.
    Other columns of ``df`` are pruned before the scan, so their names cannot clash."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("k").to_pylist()
            for a, b, texts in text_chunks(batch, "t", chars):
                made = work(keys[a:b], texts)
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in out], schema=out)

    return df.select(df[key].alias("k"), as_text(df, text).alias("t")).mapInArrow(run, schema)


def quiet_tokenizers() -> None:
    """One thread for each task: Spark already runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when the session was made elsewhere: workers on
    this machine get its folder by the context's environment.  On a cluster the package is
    installed or sent with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, root])
    return spark
