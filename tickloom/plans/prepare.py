"""From raw messages to an episode dataset: discover, select, plan, align, write.

Messages are rows of episode_id, topic, log_time, seq, value and, with cameras,
data (the bytes of a camera message) and format (its codec; may be absent). A row
with a non-null `error`, if there is such a column, says that the recording could
not be read to its end: its episode is refused as a whole.
Messages without a column data hold no cameras: of them state and action are
converted alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import align, catalog, planner
from tickloom.operators.ordered import int_bucket, numbered
from tickloom.schema import RobotSchema, conversion_params
from tickloom.sources import root as dataset
from tickloom.sources.root import CAMERA_FRAME


#: Rejected episodes that are named in what prepare() returns.
REPORTED = 100


def _vector_topics(schema: RobotSchema) -> list[str]:
    return [n for n, _ in (*schema.state_components, *schema.action_components)]


def _cameras(messages: DataFrame, schema: RobotSchema) -> tuple[str, ...]:
    """The cameras that messages must have."""
    return schema.camera_keys if "data" in messages.columns else ()


def camera_frames(messages: DataFrame, schema: RobotSchema) -> DataFrame:
    """episode_id, camera, frame, log_time, format, data: the encoded frames of each camera, numbered by time, then read order.

    Of several topics that may carry a camera the one that an episode has first
    holds. Frames without data or time are none.
    """
    by_topic = {t: c for c, topics in schema.camera_topics.items() for t in topics}
    rows = messages.where(F.col("topic").isin(list(by_topic)) & F.col("data").isNotNull() & F.col("log_time").isNotNull())
    for topics in schema.camera_topics.values():
        if len(topics) > 1:
            rows = align.lock_topic(rows, "episode_id", "topic", "seq", list(topics))
    camera = F.create_map(*(F.lit(x) for pair in by_topic.items() for x in pair))[F.col("topic")]
    kind = F.col("format") if "format" in messages.columns else F.lit(None).cast("string")
    named = rows.select("episode_id", camera.alias("camera"), "log_time", "seq", kind.alias("format"), "data")
    placed = numbered(named, ["episode_id", "camera"], ["log_time", "seq"], int_bucket(F.col("log_time"), schema.step_ns * align.STRETCH), "frame")
    return placed.select("episode_id", "camera", "frame", "log_time", "format", "data")


def _signals(messages: DataFrame, schema: RobotSchema) -> DataFrame:
    """episode_id, topic, log_time, seq, value of all that is aligned; a camera's topic is `camera <key>`, its value the frame's number."""
    vectors = messages.where(F.col("topic").isin(_vector_topics(schema))).select("episode_id", "topic", "log_time", "seq", "value")
    if not _cameras(messages, schema):
        return vectors
    frame = F.col("frame").cast("double")
    number = F.array(frame) if dict(messages.dtypes)["value"].startswith("array") else frame
    shown = camera_frames(messages, schema).select("episode_id", F.concat(F.lit("camera "), "camera").alias("topic"), "log_time", F.col("frame").alias("seq"), number.alias("value"))
    return vectors.unionByName(shown)


def aligned_frames(messages: DataFrame, schema: RobotSchema) -> DataFrame:
    """episode_id, frame_index, observation.state and action of every tick of every episode that has all topics and cameras.

    The ticks run from the first to the last message of any of them. For each
    camera `camera_frame.<key>` is the number of the frame that a tick shows, see
    camera_frames().
    """
    cameras = _cameras(messages, schema)
    names = [*_vector_topics(schema), *(f"camera {c}" for c in cameras)]
    rows = align.align_topics(_signals(messages, schema), "episode_id", "topic", "log_time", "seq", "value", names, schema.step_ns)
    dims = schema.state_dim + schema.action_dim
    whole = rows.where(F.size("vector") == dims + len(cameras))
    indexed = numbered(whole, ["episode_id"], ["tick_ns"], int_bucket(F.col("tick_ns"), schema.step_ns * align.STRETCH), "frame_index")
    return indexed.select(
        "episode_id", "frame_index", F.slice("vector", 1, schema.state_dim).alias("observation.state"), F.slice("vector", schema.state_dim + 1, schema.action_dim).alias("action"),
        *[F.get("vector", F.lit(dims + i)).cast("bigint").alias(f"{CAMERA_FRAME}{c}") for i, c in enumerate(cameras)],
    )


def rejects(messages: DataFrame, schema: RobotSchema) -> DataFrame:
    """episode_id and reason of episodes that cannot be converted; the others are not held up by them. Episodes are those that messages or error rows name."""
    names = [*_vector_topics(schema), *(f"camera {c}" for c in _cameras(messages, schema))]
    signals = _signals(messages, schema)
    all_episodes = messages.select("episode_id", F.lit(None).cast("string").alias("topic")).distinct()
    # messages that were not decoded have no value and are none
    lacking = align.missing_topics(signals.select("episode_id", F.when(F.col("value").isNotNull(), F.col("topic")).alias("topic")).unionByName(all_episodes), "episode_id", "topic", names).select("episode_id", F.concat(F.lit("no message of "), "topic").alias("reason"))
    short = align.spans_of(signals, ["episode_id"], "log_time").where("start_ns = end_ns").select("episode_id", F.lit("too short").alias("reason"))
    return lacking.unionByName(short).unionByName(_broken(messages))


def _broken(messages: DataFrame) -> DataFrame:
    """episode_id and reason of recordings that could not be read to their end."""
    if "error" not in messages.columns:
        return messages.limit(0).select("episode_id", F.lit("").alias("reason"))
    return messages.where(F.col("error").isNotNull()).groupBy("episode_id").agg(F.concat(F.lit("broken recording: "), F.min("error")).alias("reason"))


def prepare(spark: SparkSession, messages: DataFrame, listing: DataFrame, schema: RobotSchema, tasks: list[str], cap: int, root: str, image_size: tuple[int, int] = (224, 224), reconvert: bool = False, strict: bool = False) -> dict:
    """Convert what the request adds to the dataset at root, and return its info.

    listing: path, listing_pos and episode_id. A dataset that already is what is
    asked for is left alone. Episodes that were converted before keep number and
    task_index; if the request drops one, or the fingerprint differs in a field
    that changes the frames, all is converted anew. Failed episodes leave no gap;
    info["rejected"] names at most REPORTED of them, meta/rejects.json all. The
    dataset is written beside the old one, which goes when the new one is whole.
    Camera frames are stored as they were recorded, once each, see write_root().
    """
    params = conversion_params(schema, tasks, cap, image_size)
    cameras = _cameras(messages, schema)
    if cameras:
        params["camera_frames"] = "encoded"
    if not reconvert and dataset.is_prepared(root, params):
        return {**dataset.read_info(root), "rejected": _reported(spark, root)}
    named = catalog.task_catalog(listing, "path", schema.options.get("mcap", {}).get("episode_filename", ""))
    chosen = catalog.select_episodes(named, tasks, "path_task", "listing_pos", cap)
    request = chosen.select(F.col("path").alias("rel_path"), F.col("path_task").alias("task"), "episode_id", "listing_pos")
    old = dataset.read_manifest(spark, root)
    empty = spark.createDataFrame([], "rel_path string, task string, episode_index bigint, task_index bigint, length bigint")
    reuse = not reconvert and old is not None and planner.may_reuse(dataset.read_params(root), params, strict)
    before = _held(old.select(empty.columns)) if reuse else empty
    plan = planner.plan(request, before, "rel_path", "task", "episode_index")
    if not plan.removed.isEmpty():
        reuse, before = False, empty
        plan = planner.plan(request, before, "rel_path", "task", "episode_index")
    topics = [*_vector_topics(schema), *(t for c in cameras for t in schema.camera_topics[c])]
    # recordings are read once; what follows passes over them several times, mostly without the camera data
    used = F.col("topic").isin(topics) | F.col("error").isNotNull() if "error" in messages.columns else F.col("topic").isin(topics)
    messages = _held(messages.where(used).join(plan.to_convert.select("episode_id"), "episode_id", "left_semi"))
    failed = _held(rejects(messages, schema))
    if "error" in messages.columns:
        messages = messages.join(_broken(messages).select("episode_id"), "episode_id", "left_anti")
    frames = _held(aligned_frames(messages, schema))
    lengths = frames.groupBy("episode_id").agg(F.count("*").alias("length"))
    done = plan.to_convert.join(lengths, "episode_id")  # episodes without frames failed
    order = numbered(done, [], ["listing_pos"], int_bucket(F.col("listing_pos")), "_p").crossJoin(F.broadcast(plan.next_episode_index))
    index = _held(plan.task_index.select("task", "task_index"))
    converted = order.withColumn("episode_index", F.col("next_index") + F.col("_p")).join(index, "task").select("rel_path", "episode_id", "task", "episode_index", "task_index", "length")
    converted = _held(converted)
    new_frames = frames.join(converted.select("episode_id", "episode_index", "task_index"), "episode_id")
    all_frames = _narrow(new_frames)
    shown = camera_frames(messages, schema).join(converted.select("episode_id", "episode_index"), "episode_id").drop("episode_id") if cameras else None
    if reuse and not before.isEmpty():
        all_frames = _narrow(dataset.read_frames(spark, root)).unionByName(all_frames)
        if cameras:
            shown = _held(dataset.read_cameras(spark, root)).unionByName(shown)
    manifest = _held(planner.merge_manifest(before, converted.select(empty.columns)))
    beside = f"{root.rstrip('/')}.new"
    dataset.wipe(beside)
    info = dataset.write_root(all_frames, index, schema, beside, params, manifest, shown)
    dataset.write_rejects(failed, beside)
    dataset.swap(beside, root)
    spark.catalog.refreshByPath(root)
    return {**info, "rejected": _reported(spark, root)}


def _reported(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    return [tuple(r) for r in dataset.read_rejects(spark, root).orderBy("episode_id", "reason").limit(REPORTED).collect()]


def _narrow(frames: DataFrame) -> DataFrame:
    vectors = [F.col(f"`{c}`").cast("array<float>").alias(c) for c in ("observation.state", "action")]
    return frames.select("episode_index", "frame_index", "task_index", *vectors, *(f"`{c}`" for c in frames.columns if c.startswith(CAMERA_FRAME)))


def _held(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what is read must not change while its source is rewritten."""
    from tickloom.runtime import materialize

    return materialize(df, "prepare")
