"""How the recordings of a source become a dataset, by the ingestion_strategy of its schema.

mcap: message files, aligned and converted (plans.prepare). mirror: a dataset
that already has our layout is copied as a whole; no task is left out. hdf5:
shards whose vectors need the library h5py; see sources.tar and sources.decode.
Others are added with register().
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.plans import prepare as conversion
from tickloom.schema import RobotSchema, conversion_params
from tickloom.sources import decode, listing, mcap, transfer
from tickloom.sources import root as dataset


@dataclass(frozen=True)
class Request:
    """What is to be converted, and where to. options are those of the reader, over the ones that the schema declares."""

    source_uri: str
    tasks: list[str]
    cap: int
    root: str
    image_size: tuple[int, int] = (224, 224)
    reconvert: bool = False
    options: dict[str, str] | None = None


@dataclass(frozen=True)
class Strategy:
    """config gives the reader's options of a schema; run converts and returns the dataset's info."""

    config: Callable[[RobotSchema], dict[str, str]]
    run: Callable[[SparkSession, RobotSchema, Request, dict[str, str]], dict]


def episodes(spark: SparkSession, uri: str, glob: str) -> DataFrame:
    """path below the root, size, listing_pos and episode_id of the recordings below uri."""
    files = listing.numbered_files(listing.list_files(spark, uri, glob).withColumn("path", F.regexp_replace("path", "^.*?(?=data/)", "")))
    return files.withColumn("episode_id", F.regexp_extract("path", "episode_([^/]+)", 1))


def _mcap_config(schema: RobotSchema) -> dict[str, str]:
    cameras = [t for topics in schema.camera_topics.values() for t in topics]
    declared = schema.options.get("mcap") or {}
    fields = (("value_field", "state_value_field"), ("data_field", "camera_data_field"), ("format_field", "camera_format_field"))
    topics = [*(n for n, _ in (*schema.state_components, *schema.action_components)), *cameras]
    return {"topics": ",".join(topics), "raw": ",".join(cameras), **{k: declared[d] for k, d in fields if d in declared}}


def _mcap(spark: SparkSession, schema: RobotSchema, request: Request, options: dict[str, str]) -> dict:
    messages = mcap.read(spark, request.source_uri, **options)
    found = episodes(spark, request.source_uri, "*.mcap")
    return conversion.prepare(spark, messages, found, schema, request.tasks, request.cap, request.root, request.image_size, request.reconvert)


def _mirror(spark: SparkSession, schema: RobotSchema, request: Request, options: dict[str, str]) -> dict:
    params = conversion_params(schema, request.tasks, request.cap, request.image_size)
    if not request.reconvert and dataset.is_prepared(request.root, params):
        return {**dataset.read_info(request.root), "rejected": []}
    if not dataset.dataset_exists(request.source_uri):
        raise FileNotFoundError(f"{request.source_uri} holds no dataset; hub repositories have to be downloaded first")
    beside = f"{request.root.rstrip('/')}.new"
    dataset.wipe(beside)
    base = request.source_uri.rstrip("/").removeprefix("file:")
    at = F.instr("path", base.lstrip("/")) + F.lit(len(base.lstrip("/")) + 1)
    paths = listing.list_files(spark, request.source_uri).select(F.expr("path"), at.alias("at")).select(F.substring("path", F.col("at"), F.length("path")).alias("path"))
    copied = transfer.fetch_all(paths, request.source_uri, beside)
    failed = copied.where("error is not null").limit(5).collect()
    if failed:
        raise OSError(f"not copied: {[(r.path, r.error) for r in failed]}")
    dataset.stamp(beside, params)
    dataset.swap(beside, request.root)
    return {**dataset.read_info(request.root), "rejected": []}


def _hdf5(spark: SparkSession, schema: RobotSchema, request: Request, options: dict[str, str]) -> dict:
    decode.library("h5py")
    raise NotImplementedError("shards are read by sources.tar and decode.hdf5_rows; no plan puts them together yet")


_strategies: dict[str, Strategy] = {"mcap": Strategy(_mcap_config, _mcap), "mirror": Strategy(lambda _: {}, _mirror), "hdf5": Strategy(lambda s: dict(s.options.get("hdf5") or {}), _hdf5)}


def register(name: str, strategy: Strategy) -> None:
    """Add a strategy, or put another in its place."""
    _strategies[name] = strategy


def strategy_of(schema: RobotSchema) -> Strategy:
    if schema.ingestion_strategy not in _strategies:
        raise ValueError(f"{schema.dataset_source} has the strategy {schema.ingestion_strategy!r}, not one of {sorted(_strategies)}")
    return _strategies[schema.ingestion_strategy]


def run(spark: SparkSession, schema: RobotSchema, request: Request) -> dict:
    """Convert what is asked for by the strategy of the schema."""
    strategy = strategy_of(schema)
    return strategy.run(spark, schema, request, {**strategy.config(schema), **(request.options or {})})
