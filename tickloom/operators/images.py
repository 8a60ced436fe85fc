"""Flat image arrays: layout, channels and normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("mean_std", "unit01", "unit_pm1", "depth", "log")


def reshape(flat: Column, height: int, width: int, channels: int) -> Column:
    """A flat row-major vector as rows of pixels of channels."""
    step = width * channels
    return F.transform(
        F.sequence(F.lit(0), F.lit(height - 1)),
        lambda y: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda x: F.slice(flat, y * step + x * channels + 1, F.lit(channels))),
    )


def hwc_to_chw(flat: Column, height: int, width: int, channels: int) -> Column:
    """Channel-last to channel-first order of a flat vector."""
    area = height * width
    return F.transform(F.sequence(F.lit(0), F.lit(area * channels - 1)), lambda i: F.get(flat, (i % area) * channels + (i / area).cast("int")))


def replicate_channels(flat: Column, channels: int) -> Column:
    """A single channel (channel-first) three times; others stay."""
    return F.concat(flat, flat, flat) if channels == 1 else flat


def checked_max(camera: str, mode: str, max_values: dict[str, float]) -> float:
    limit = max_values.get(camera)
    if limit is None or limit <= 0:
        raise ValueError(f"mode {mode!r} of camera {camera!r} needs a positive max value, not {limit!r}")
    return float(limit)


def normalized(x: Column, mode: str, mean: Column | float | None = None, std: Column | float | None = None, limit: float | None = None, eps: float = 0.0) -> Column:
    """One number normalised. A standard deviation of 0 gives null, unless eps is added to it; `log` is not cut above 1."""
    x = x.cast("double")
    if mode == "mean_std":
        return F.try_divide(x - F.lit(mean), F.lit(std) + F.lit(eps))
    if mode == "unit01":
        return x / 255.0
    if mode == "unit_pm1":
        return x / 127.5 - 1.0
    if mode in ("depth", "log") and not (limit and limit > 0):
        raise ValueError(f"mode {mode!r} needs a positive limit")
    if mode == "depth":
        return F.least(F.greatest(x, F.lit(0.0)), F.lit(float(limit))) / F.lit(float(limit))
    if mode == "log":
        return F.log1p(F.greatest(x, F.lit(0.0))) / F.log1p(F.lit(float(limit)))
    raise ValueError(f"unknown mode {mode!r}, one of {MODES}")


def normalize_columns(df: DataFrame, modes: dict[str, str], default: str, prefix: str = "observation.images.", stats: dict[str, tuple[list[float], list[float]]] | None = None, max_values: dict[str, float] | None = None) -> DataFrame:
    """Normalise every array column that begins with prefix, by its camera's mode or the default. Others stay.

    stats: camera -> (means, stds) per channel of channel-first arrays, spread evenly over the array.
    """
    out = {}
    for name in df.columns:
        if not name.startswith(prefix):
            continue
        camera = name[len(prefix) :]
        mode = modes.get(camera, default)
        limit = checked_max(camera, mode, max_values or {}) if mode in ("depth", "log") else None
        c = F.col(f"`{name}`")
        out[name] = _channelwise(c, *(stats or {})[camera]) if mode == "mean_std" else _elementwise(c, mode, limit)
    return df.withColumns(out)


def _elementwise(image: Column, mode: str, limit: float | None) -> Column:
    return F.transform(image, lambda x: normalized(x, mode, limit=limit))


def _channelwise(image: Column, means: list[float], stds: list[float]) -> Column:
    area = F.size(image) / F.lit(len(means))

    def of_channel(values: list[float], i: Column) -> Column:
        return F.get(F.array(*(F.lit(float(v)) for v in values)), (i / area).cast("int"))

    return F.transform(image, lambda x, i: F.try_divide(x.cast("double") - of_channel(means, i), of_channel(stds, i)))


def visual_features(cameras: list[str], depth_cameras: list[str], height: int, width: int) -> dict[str, tuple[int, int, int]]:
    """Declared shapes of all image inputs: channel first and always three channels, depth cameras too."""
    names = [*cameras, *(f"depth_{c}" for c in depth_cameras)]
    return {f"observation.images.{n}": (3, height, width) for n in names}


def prefixed(df: DataFrame, video_keys: list[str], depth_keys: list[str] = (), prefix: str = "observation.images.") -> DataFrame:
    """Video columns under prefix, unless they have it already; `depth.<k>` as prefix + `depth_<k>`. Others keep their names."""
    names = {k: k if k.startswith(prefix) else prefix + k for k in video_keys} | {f"depth.{k}": f"{prefix}depth_{k}" for k in depth_keys}
    return df.withColumnsRenamed({k: v for k, v in names.items() if k != v})
