"""Small helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of contracts that split on ASCII white space, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of our own only where none is set (tests)."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        found = tempfile.mkdtemp(prefix="helioflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
        _removed_at_exit(spark, context.getCheckpointDir())
    return found


def _removed_at_exit(spark: SparkSession, folder: str) -> None:
    """Let the driver remove a folder of this application's own when it ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint a small table. The files go when the application ends, or with Spark's setting to
    clean checkpoints up, when nothing refers to them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write a large table to the shared folder as compressed Parquet and read it back.

    All such tables of an application are in one folder, which is removed when it ends.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/helioflow-{spark.sparkContext.applicationId}"
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _removed_at_exit(spark, folder)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str, modulus: int) -> Column:
    """True where crc32(doc_id as text) mod ``modulus`` is 2; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == 2, F.lit(False))


def within_share(share: Column | float, *keys: str) -> Column:
    """A repeatable sample: keeps a row where the hash of its keys falls in the first ``share``."""
    return F.pmod(F.xxhash64(*keys), F.lit(1_000_003)) < F.lit(1_000_003) * share


def slices(frames: Iterator[pd.DataFrame], column: str, chars: int) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into parts of about ``chars`` characters, to bound a worker's memory."""
    for frame in frames:
        sizes = frame[column].str.len().fillna(0).to_numpy()
        part = ((sizes.cumsum() - sizes) // chars).astype("int64")
        for _, rows in frame.groupby(part, sort=True):
            yield rows


def strings(texts: pa.Array, chars: int = 1_000_000) -> Iterator[str | None]:
    """The texts of an Arrow array, made into Python strings a part at a time."""
    for part in parts(texts, chars):
        yield from part


def parts(texts: pa.Array, chars: int = 1_000_000) -> Iterator[list[str | None]]:
    """As ``arrow_parts``, made into Python strings."""
    for part in arrow_parts(texts, chars):
        yield part.to_pylist()


def arrow_parts(texts: pa.Array, chars: int) -> Iterator[pa.Array]:
    """Parts of about ``chars`` bytes of an Arrow array of texts, to bound a worker's memory; none is empty."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (sizes.cumsum() - sizes) // chars
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield texts.slice(a, b - a)


def unused(names: list[str], like: str = "own") -> str:
    """A column name that none of ``names`` clashes with, whatever its case."""
    taken = {n.lower() for n in names}
    while like.lower() in taken:
        like += "_"
    return like
