"""Session-level helpers: the shared folder, checked broadcasts and block keys.

Nothing in here holds data; every helper returns a lazy DataFrame or a string.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if Catalyst's size estimate, times this factor for
#: decoded rows, stays under BROADCAST_LIMIT.
DECODED_FACTOR = 4
BROADCAST_LIMIT = 48 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: spark.checkpoint.dir. Only where one machine is all there is may it be unset."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {sc.master} share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
    return sc.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again.

    Cuts the lineage at a place that outlives any executor; later passes scan
    the table instead of repeating the shuffle above it.
    """
    spark = df.sparkSession
    folder = tables_dir(spark)
    fs, root = _hadoop(spark, folder)
    if folder not in _marked:
        _marked.add(folder)
        fs.deleteOnExit(root)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.tickloom_table = path
    return table


_marked: set[str] = set()


def tables_dir(spark: SparkSession) -> str:
    """Where the tables of this application are; others that share the folder have their own."""
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop(table: DataFrame) -> None:
    """Delete one table that materialize() gave. Frames that were made from it must be done."""
    fs, at = _hadoop(table.sparkSession, table.tickloom_table)
    fs.delete(at, True)


def drop_materialized(spark: SparkSession) -> None:
    """Delete every table that this application's materialize() wrote; the end of the driver does so, too."""
    fs, at = _hadoop(spark, tables_dir(spark))
    fs.delete(at, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of df's size (file sizes scaled by the columns that are read)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return estimated_bytes(df) * DECODED_FACTOR <= limit


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "inner", limit: int = BROADCAST_LIMIT, size_of: DataFrame | None = None) -> DataFrame:
    """Join a large left side to a lookup table.

    The lookup is broadcast while its estimated size is under limit. Beyond that
    the same join runs shuffled, where AQE splits skewed keys of the left side.
    size_of is a table that bounds the lookup's rows, where Catalyst's estimate
    of the lookup itself is a product of sizes, as of joins.
    """
    small = fits_broadcast(right if size_of is None else size_of, limit)
    return left.join(F.broadcast(right) if small else right, on, how)


def block_keys(order: Column, block: int, halo: int = 0) -> Column:
    """Numbers of the blocks that hold a row: its own, and a neighbour if the row is within halo of the border.

    Exploding them splits one long series over many tasks, each of which sees
    halo rows beyond both ends of the block it owns.
    """
    first = F.greatest(F.lit(0), F.floor((order - F.lit(halo)) / F.lit(block)))
    last = F.greatest(F.lit(0), F.floor((order + F.lit(halo)) / F.lit(block)))
    return F.sequence(first.cast("bigint"), last.cast("bigint"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; they need no copy of the repository."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tickloom-")) / "tickloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*")):
            if p.suffix in (".py", ".yaml"):
                z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
