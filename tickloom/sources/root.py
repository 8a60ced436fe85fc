"""Episode datasets on disk: data/, videos/ and meta/ below one root.

data/chunk-<c>/file-<f>.parquet holds the frames of one episode; meta/ holds
tasks, episodes, info, statistics, the request's fingerprint and the manifest.
A root is a path or a URI of any file system that Arrow and Spark both know.
Frames are written by the tasks that hold them: under a temporary name first,
renamed when complete, so a repeated task leaves one file. The global index is
computed before the only write.

videos/ holds the encoded frames of one camera of one episode per file, as they
were recorded (columns of CAMERA_ROWS); a row of data/ names the frame that it
shows in camera_frame.<key>. They are not encoded anew as mp4.
"""

from __future__ import annotations

import itertools
import json
import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import images
from tickloom.operators.chunk import action_chunks
from tickloom.operators.planner import global_index, missing_tasks, with_offsets
from tickloom.runtime import ship
from tickloom.schema import RobotSchema
from tickloom.sources.files import move_in

#: Fixed values of the layout.
CHUNK_FILES = 1000
DATA_PATH = "data/chunk-{chunk:03d}/file-{file:06d}.parquet"
VIDEO_PATH = "videos/{key}/chunk-000/file-{file:06d}.mp4"
CAMERA_PATH = "videos/{key}/chunk-000/file-{file:06d}.parquet"
#: Columns of data/ with the number of the camera frame that a row shows.
CAMERA_FRAME = "camera_frame."
CAMERA_ROWS = pa.schema([("episode_index", pa.int64()), ("camera", pa.string()), ("frame", pa.int64()), ("log_time", pa.int64()), ("format", pa.string()), ("data", pa.binary())])
PARAMS, MANIFEST, INFO, REJECTS = "meta/conversion_params.json", "meta/episode_manifest.json", "meta/info.json", "meta/rejects.json"


class UnsafeRoot(ValueError):
    """A path that must not be emptied or left."""


def safe_relative(path: str) -> str:
    """The path, if it stays below its root; absolute and climbing paths are refused."""
    if not path or path.startswith("/") or ".." in Path(os.path.normpath(path)).parts:
        raise UnsafeRoot(f"{path!r} is not below its root")
    return path


def default_root(source: str, tasks: list[str]) -> str:
    return f"datasets/{source}/{'-'.join(sorted(tasks))}"


def resolve_root(root: str | None, source: str, tasks: list[str]) -> str:
    """The given root, else the default; made absolute unless it is a URI."""
    chosen = root or default_root(source, tasks)
    return chosen if "://" in chosen else str(Path(chosen).absolute())


def _place(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a root."""
    if "://" in root:
        return pafs.FileSystem.from_uri(root.rstrip("/"))
    return pafs.LocalFileSystem(), str(Path(root).absolute())


def _exists(root: str, rel: str) -> bool:
    fs, base = _place(root)
    return fs.get_file_info(f"{base}/{rel}").type != pafs.FileType.NotFound


def _get(root: str, rel: str):
    if not _exists(root, rel):
        return None
    fs, base = _place(root)
    with fs.open_input_stream(f"{base}/{rel}") as f:
        return json.loads(f.read())


def _put(root: str, rel: str, content: object) -> None:
    fs, base = _place(root)

    def write(part: str) -> None:
        with fs.open_output_stream(part) as f:
            f.write(json.dumps(content, indent=1).encode())

    move_in(fs, f"{base}/{rel}", write)


def wipe(root: str) -> None:
    """Empty a dataset root. Refused for /, a bucket, the home folder and those above it, and folders without the fingerprint that marks a dataset."""
    fs, base = _place(root)
    if isinstance(fs, pafs.LocalFileSystem):
        path, home = Path(base).resolve(), Path.home().resolve()
        if path in (Path("/"), home, *home.parents):
            raise UnsafeRoot(f"will not empty {path}")
    elif "/" not in base.strip("/"):
        raise UnsafeRoot(f"will not empty {root}")
    if fs.get_file_info(base).type != pafs.FileType.NotFound:
        if not _exists(root, PARAMS):
            raise UnsafeRoot(f"{root} has no {PARAMS}; it is no dataset")
        fs.delete_dir(base)


def swap(new: str, root: str) -> None:
    """Put the complete dataset new in the place of root. Until then root is as it was; a dataset that is there goes last."""
    fs, base = _place(root)
    _, beside = _place(new)
    old = f"{base}.old"
    if fs.get_file_info(old).type != pafs.FileType.NotFound:
        fs.delete_dir(old)  # left by a run that ended here
    if fs.get_file_info(base).type != pafs.FileType.NotFound:
        if not _exists(root, PARAMS) and fs.get_file_info(pafs.FileSelector(base)):
            raise UnsafeRoot(f"{root} has no {PARAMS}; it is no dataset")
        _move_dir(fs, base, old)
    _move_dir(fs, beside, base)
    if fs.get_file_info(old).type != pafs.FileType.NotFound:
        fs.delete_dir(old)


def _move_dir(fs: pafs.FileSystem, source: str, target: str) -> None:
    """Rename a folder; object stores, which have none, copy its files."""
    if isinstance(fs, pafs.S3FileSystem):
        pafs.copy_files(source, target, source_filesystem=fs, destination_filesystem=fs)
        fs.delete_dir(source)
    else:
        fs.move(source, target)


def write_rejects(rejects: DataFrame, root: str) -> None:
    """Keep episode_id and reason of what was not converted with the dataset."""
    uri = root if "://" in root else _place(root)[1]
    rejects.write.mode("overwrite").json(f"{uri}/{REJECTS}")


def stamp(root: str, params: dict) -> None:
    """Mark a complete dataset with the request that it serves."""
    _put(root, PARAMS, params)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """episode_id and reason of what was not converted when the dataset was written last."""
    kinds = "episode_id string, reason string"
    return spark.read.schema(kinds).json(f"{root}/{REJECTS}") if _exists(root, REJECTS) else spark.createDataFrame([], kinds)


def read_params(root: str) -> dict | None:
    return _get(root, PARAMS)


def read_info(root: str) -> dict | None:
    return _get(root, INFO)


def dataset_exists(root: str) -> bool:
    return _exists(root, INFO)


def is_prepared(root: str, params: dict) -> bool:
    """Whether the root holds exactly what is asked for."""
    return dataset_exists(root) and read_params(root) == params


def write_root(frames: DataFrame, tasks: DataFrame, schema: RobotSchema, root: str, params: dict, manifest: DataFrame | None = None, cameras: DataFrame | None = None, depth_shapes: dict[str, tuple[int, int, int]] | None = None) -> dict:
    """Write frames (episode_index, frame_index, task_index, observation.state, action) as a dataset and return its info.

    timestamp is frame_index / fps, vectors become 32-bit, index runs over all
    episodes. Every task_index in use must be in tasks (task_index, task).
    cameras: rows of CAMERA_ROWS, which camera_frame.<key> of frames count.
    depth_shapes: height, width, channels of the flat columns depth.<key>.
    """
    spark = frames.sparkSession
    ship(spark)
    if lacking := [r.task_index for r in missing_tasks(frames, tasks).limit(5).collect()]:
        raise ValueError(f"frames use tasks that are not listed: {lacking}")
    lengths = frames.groupBy("episode_index").agg(F.count("*").alias("length"), F.min("task_index").alias("task_index"))
    episodes = with_offsets(lengths)
    full = global_index(frames, episodes).select(
        F.col("index").cast("bigint").alias("index"), F.col("episode_index").cast("bigint").alias("episode_index"), F.col("frame_index").cast("bigint").alias("frame_index"),
        (F.col("frame_index") / F.lit(schema.tick_fps)).alias("timestamp"), F.col("task_index").cast("bigint").alias("task_index"),
        F.col("`observation.state`").cast("array<float>").alias("observation.state"), F.col("action").cast("array<float>").alias("action"),
        *[F.col(f"`{c}`") for c in frames.columns if c.startswith(("depth.", CAMERA_FRAME))],
    )
    names = full.columns
    # mapInArrow takes no column names with dots; the tasks put the real ones back
    sorted_frames = full.repartition("episode_index").sortWithinPartitions("episode_index", "frame_index").toDF(*(c.replace(".", "_") for c in names))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        fs, base = _place(root)

        def flush(table: pa.Table, last: bool) -> pa.Table | None:
            episode = table["episode_index"].to_numpy()
            at = 0
            while at < len(episode):
                end = at + int((episode[at:] == episode[at]).sum())
                if end == len(episode) and not last:
                    return table.slice(at)
                number = int(episode[at])
                rows = table.slice(at, end - at).rename_columns(names)
                move_in(fs, f"{base}/{DATA_PATH.format(chunk=number // CHUNK_FILES, file=number)}", lambda part, rows=rows: pq.write_table(rows, part, filesystem=fs))
                at = end
            return None

        n = 0
        for batch in batches:
            n += batch.num_rows
            table = pa.Table.from_batches([batch])
            kept = flush(table if kept is None else pa.concat_tables([kept, table]), False)
        if kept is not None:
            flush(kept, True)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    total = sorted_frames.mapInArrow(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if cameras is not None:
        _write_cameras(cameras, root)
    uri = root if "://" in root else _place(root)[1]
    cameras = {f"videos/{c}/{k}": v for c in schema.camera_keys for k, v in (("chunk_index", F.lit(0).cast("bigint")), ("file_index", F.col("episode_index")), ("from_timestamp", F.lit(0.0)))}
    table = episodes.select(
        "episode_index", "length", F.expr(f"episode_index div {CHUNK_FILES}").alias("data/chunk_index"), F.col("episode_index").alias("data/file_index"), *[v.alias(k) for k, v in cameras.items()]
    )
    table.repartitionByRange(F.col("episode_index")).write.mode("overwrite").parquet(f"{uri}/meta/episodes/chunk-000")
    tasks.select("task_index", "task").coalesce(1).write.mode("overwrite").parquet(f"{uri}/meta/tasks.parquet")
    if manifest is not None:
        manifest.write.mode("overwrite").json(f"{uri}/{MANIFEST}")
    info = {
        "total_frames": int(total), "total_episodes": lengths.count(), "fps": schema.tick_fps, "data_path": DATA_PATH, "video_path": VIDEO_PATH if cameras is None else CAMERA_PATH,
        "features": {
            "observation.state": {"dtype": "float32", "shape": [schema.state_dim]}, "action": {"dtype": "float32", "shape": [schema.action_dim]},
            **{c: {"dtype": "video", "shape": [*params.get("image_size", [0, 0]), 3]} for c in schema.camera_keys},
            **{c: {"dtype": "int64", "shape": [1]} for c in frames.columns if c.startswith(CAMERA_FRAME)},
        },
    }
    kinds = dict(frames.dtypes)
    for k, shape in (depth_shapes or {}).items():
        info["features"][f"depth.{k}"] = {"dtype": kinds[f"depth.{k}"].removeprefix("array<").removesuffix(">"), "shape": list(shape)}
    _put(root, "meta/stats.json", {})
    _put(root, PARAMS, params)
    _put(root, INFO, info)  # last: it makes the dataset exist
    spark.catalog.refreshByPath(root)
    return info


def _write_cameras(cameras: DataFrame, root: str) -> None:
    """A file per episode and camera, written row group by row group."""
    names = CAMERA_ROWS.names

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(root)
        rows = (batch.slice(lo, hi - lo) for batch in batches for lo, hi in _runs(batch))
        n = 0
        for (number, camera), parts in itertools.groupby(rows, lambda b: (b["episode_index"][0].as_py(), b["camera"][0].as_py())):

            def fill(part: str, parts=parts) -> None:
                nonlocal n
                with pq.ParquetWriter(part, CAMERA_ROWS, filesystem=fs) as out:
                    for b in parts:
                        n += b.num_rows
                        out.write_table(pa.Table.from_batches([b]).cast(CAMERA_ROWS))

            move_in(fs, f"{base}/{CAMERA_PATH.format(key=camera, file=number)}", fill)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    ordered = cameras.select(*names).repartition("episode_index", "camera").sortWithinPartitions("episode_index", "camera", "frame")
    ordered.mapInArrow(write, "n bigint").agg(F.sum("n")).first()


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Stretches of a batch that belong to one episode and camera."""
    keys = list(zip(batch["episode_index"].to_pylist(), batch["camera"].to_pylist(), strict=True))
    cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
    return list(zip([0, *cuts], [*cuts, len(keys)], strict=True)) if keys else []


def read_cameras(spark: SparkSession, root: str) -> DataFrame:
    """The encoded camera frames of a dataset, CAMERA_ROWS; none if it was written without."""
    kinds = "episode_index bigint, camera string, frame bigint, log_time bigint, format string, data binary"
    if not _exists(root, "videos"):
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).option("recursiveFileLookup", True).parquet(f"{root}/videos")


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    return spark.read.json(f"{root}/{MANIFEST}") if _exists(root, MANIFEST) else None


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    """Frames of a dataset with their task text."""
    frames = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/data")
    tasks = spark.read.parquet(f"{root}/meta/tasks.parquet")
    return frames.join(tasks, "task_index", "left")


def read_training_rows(spark: SparkSession, root: str, chunk_size: int, depth_keys: Sequence[str] = ()) -> DataFrame:
    """task, observation.state, action (chunk) and action_is_pad per frame, and what the dataset has of cameras.

    Image columns come as observation.images.<key>, the depth of depth_keys as
    observation.images.depth_<key> in rows of pixels of channels. Other depth
    columns and the numbers of camera frames stay as they are.
    """
    prefix = "observation.images."
    features = read_info(root)["features"]
    frames = read_frames(spark, root)
    for k in depth_keys:
        if f"depth.{k}" not in frames.columns or f"depth.{k}" not in features:
            raise ValueError(f"{root} has no depth of {k!r} with a shape")
    shown = {k.removeprefix(prefix) for k, f in features.items() if f["dtype"] in ("video", "image")}
    frames = images.prefixed(frames, [k for k in frames.columns if k in shown], list(depth_keys))
    for k in depth_keys:
        name = f"{prefix}depth_{k}"
        frames = frames.withColumn(name, images.reshape(F.col(f"`{name}`"), *features[f"depth.{k}"]["shape"]))
    kept = [f"`{c}`" for c in frames.columns if c.startswith((prefix, "depth.", CAMERA_FRAME))]
    rows = action_chunks(frames, ["episode_index"], "frame_index", "action", chunk_size)
    return rows.select("episode_index", "frame_index", "index", "task", "`observation.state`", F.col("chunk").alias("action"), F.col("is_pad").alias("action_is_pad"), *kept)
