"""What the operators share: shipping the package to executors, staging tables
in the shared folder, giving memory back, and running totals that no single task has to hold."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

#: Words are runs of anything but ASCII white space; bytes.split() cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()
_own_dirs: dict[str, str] = {}


#: How many bytes an Arrow batch has, about: buffers on both sides of the Python workers stay small, whatever the length of rows.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers that lack it, once per application,
    and bounds the session's Arrow batches, unless the session has a bound of its own."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session (tests) gets
    one of its own; on a cluster, whose executors would each write to their own disk, it raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="cairn-shared-")
    return _own_dirs[app]


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: lineage ends at
    files that outlive any executor. The folder goes when the shared one is cleared."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cairn-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns free memory of Arrow and of the C library to the system; a worker lives on for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def one_thread() -> None:
    """Has numpy's OpenBLAS multiply in the calling thread alone: on small matrices more threads only spin."""
    import ctypes

    import numpy as np

    for path in Path(np.__file__).resolve().parents[1].glob("numpy.libs/*openblas*"):
        lib = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads"):
            if hasattr(lib, name):
                getattr(lib, name)(1)
                return


@lru_cache(maxsize=1)
def _libc():
    import ctypes

    try:
        return ctypes.CDLL(None)
    except OSError:
        return None


def parallelism(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added while df has a column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def words_count(text: Column) -> Column:
    """Number of words; null text has none. JVM only."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _has_no_hash(kind: DataType) -> bool:
    """Whether a type is, or holds, a map or a variant, which Spark does not hash."""
    if isinstance(kind, ArrayType):
        return _has_no_hash(kind.elementType)
    if isinstance(kind, StructType):
        return any(_has_no_hash(f.dataType) for f in kind)
    return isinstance(kind, (MapType, VariantType))


def row_key(df: DataFrame) -> Column:
    """64-bit hash of all columns of a row, nulls told apart: rows that share it are copies of
    each other in every column. Columns that hold maps or variants go by their JSON, so maps
    of equal entries in another order count as different."""
    names = [f"`{f.name}`" for f in df.schema]
    shown = [F.to_json(F.struct(df[c]), {"ignoreNullFields": "false"}) if _has_no_hash(f.dataType) else df[c] for c, f in zip(names, df.schema, strict=True)]
    return F.xxhash64(*[x for c, v in zip(names, shown, strict=True) for x in (v, df[c].isNull())])


def running_total(df: DataFrame, key: Column, bucket: Column, order: list, value: Column, out: str) -> DataFrame:
    """Adds out = sum of value over the rows of the same key that come earlier.

    bucket: long that never falls in the given order. Rows are summed within
    (key, bucket), then bucket totals within 4096 buckets, then those; so a key with
    most of the rows is spread over its buckets. df should be staged: it is read twice.
    """
    base = df.withColumns({"_k": key, "_b": bucket, "_v": value})
    fine = base.groupBy("_k", "_b").agg(F.sum("_v").alias("_s")).withColumn("_c", F.shiftright("_b", 12))
    coarse = fine.groupBy("_k", "_c").agg(F.sum("_s").alias("_cs"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.withColumn("_c0", F.coalesce(F.sum("_cs").over(before("_k").orderBy("_c")), F.lit(0)))
    fine = fine.withColumn("_f0", F.coalesce(F.sum("_s").over(before("_k", "_c").orderBy("_b")), F.lit(0)))
    same = lambda a, b, *cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    fine = fine.alias("f").join(coarse.alias("c"), same("f", "c", "_k", "_c")).select("f._k", "f._b", (F.col("_f0") + F.col("_c0")).alias("_start"))
    inner = base.withColumn("_i0", F.coalesce(F.sum("_v").over(before("_k", "_b").orderBy(*order)), F.lit(0)))
    cols = [F.col(f"r.`{c}`") for c in df.columns]
    return inner.alias("r").join(fine.alias("f"), same("r", "f", "_k", "_b")).select(*cols, (F.col("_i0") + F.col("_start")).alias(out))


