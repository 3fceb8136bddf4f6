"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from veleta.session import scratch

U64 = np.uint64
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Odd 64-bit multipliers for mixing; any odd constants do.
ODD = tuple(U64((0x9E3779B97F4A7C15 * (2 * k + 1) ^ (0xBF58476D1CE4E5B9 >> k)) & (2**64 - 1) | 1)
            for k in range(32))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so long texts do not pile up in a worker."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    # Workers import this package from where the driver did, if they have it there.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    # A task has one core: small matrix products must not wait for helper threads.
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
        spark.sparkContext.environment.setdefault(name, "1")
    return df.mapInArrow(fn, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: lineage is cut, and a
    lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read any more."""
    for t in tables:
        remove_folder(t.sparkSession, t.stored_at)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; bijective."""
    x = x ^ (x >> U64(32))
    x *= ODD[0]
    x ^= x >> U64(29)
    x *= ODD[1]
    x ^= x >> U64(32)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit value for every run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n] * ODD[2]
    for k in range(1, size):
        out += words[k:k + n] * ODD[2 + k]
    return mix(out)


def octets(texts: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column, summed over all rows."""
    return texts.agg(F.sum(F.octet_length(column))).first()[0] or 0
