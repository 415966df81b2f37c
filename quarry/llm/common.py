"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

# Characters that separate words: space and U+0009..U+000D.  ``bytes.split()``
# without arguments splits on exactly this set.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage is cut and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, n: int):
    """``crc32(id as text) mod n`` as a column; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def fold_of(value, n: int) -> int:
    """The same remainder in Python (tests)."""
    return 0 if value is None else zlib.crc32(str(value).encode()) % n


def byte_texts(column) -> list:
    """The UTF-8 bytes of an Arrow string column; null becomes ``b''``."""
    import pyarrow as pa
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


SLICE = 512                 # rows of an Arrow batch turned into Python objects at once


def slices(batch, size: int = SLICE):
    """An Arrow batch (or array) in pieces, so that only a few rows' texts are
    Python objects at a time."""
    for lo in range(0, len(batch), size):
        yield batch.slice(lo, size)


def release() -> None:
    """Give freed memory back to the system: workers are kept between tasks
    and would otherwise hold their peak."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)
