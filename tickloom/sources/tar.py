"""Members of tar shards as a Spark data source; each shard is read once, front to back, in a partition of its own.

    spark.dataSource.register(TarSource)
    spark.read.format("tarshard").option("names", "a/b.h5,...").option("prefixes", "a/depth/").load("/shards")

Columns: tar_path, name, size, content. names and prefixes choose the members;
without both all files are given. Reading stops as soon as all names are found,
if there are no prefixes. A member above 2 GB is an error, and so is a path that
does not exist; it is local or a URI that Arrow knows (s3, s3a, gs, hdfs).
"""

from __future__ import annotations

import tarfile
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tickloom.sources.files import files_below, open_stream

MEMBER_CAP = 2 << 30


def _listed(text: str | None) -> list[str]:
    return [x for x in (text or "").split(",") if x]


def members(path: str, names: set[str], prefixes: tuple[str, ...]) -> Iterator[tuple[str, int, bytes]]:
    left = set(names)
    with open_stream(path) as f, tarfile.open(fileobj=f, mode="r|*") as tar:
        for m in tar:
            if not m.isfile() or not (not names and not prefixes or m.name in names or m.name.startswith(prefixes or ("\0",))):
                continue
            if m.size > MEMBER_CAP:
                raise ValueError(f"{m.name} in {path} has {m.size} bytes, more than {MEMBER_CAP}")
            yield m.name, m.size, tar.extractfile(m).read()
            left.discard(m.name)
            if names and not left and not prefixes:
                return


class _TarReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options.get("path", "")
        self.names, self.prefixes = set(_listed(options.get("names"))), tuple(_listed(options.get("prefixes")))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in files_below(self.root, ".tar")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for name, size, content in members(partition.value, self.names, self.prefixes):
            yield partition.value, name, size, content


class TarSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tarshard"

    def schema(self) -> str:
        return "tar_path string, name string, size bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _TarReader(self.options)


def missing_members(found: DataFrame, wanted: DataFrame, name: str = "name") -> DataFrame:
    """Wanted member names that no shard held."""
    return wanted.join(found.select(name), name, "left_anti")


def classify(found: DataFrame, cameras: list[str], proprio: str = "proprio_stats.h5") -> DataFrame:
    """Members with their kind (proprio, video, depth), episode and camera, by name."""
    n = F.col("name")
    camera = F.regexp_extract(n, r"(?:^|/)([A-Za-z0-9_]+)_color\.mp4$", 1)
    depth = F.regexp_extract(n, r"/depth/([A-Za-z0-9_]+)_depth_[0-9]+\.png$", 1)
    kind = F.when(F.endswith(n, F.lit(proprio)), "proprio").when(camera.isin(cameras), "video").when(depth != "", "depth")
    episode = F.when(kind == "proprio", F.element_at(F.split(n, "/"), -2)).otherwise(F.get(F.split(n, "/"), F.lit(0)))
    return found.withColumn("kind", kind).withColumn("episode", episode).withColumn("camera", F.when(kind == "video", camera).when(kind == "depth", depth)).where("kind is not null")
