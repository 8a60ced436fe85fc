"""Scalar expressions: paths, templates, parsing and lookups. All run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names by which codecs are known, and the decoder of each.
CODECS = {"h264": "h264", "avc": "h264", "avc1": "h264", "h265": "hevc", "hevc": "hevc", "hvc1": "hevc"}


def split_and_task(path: Column, prefix: str = "data") -> Column:
    """struct(split, task) of 'prefix/split/task/...'; both 'unknown' unless there are four segments and the prefix fits."""
    parts = F.split(path, "/")
    fits = (F.size(parts) >= 4) & (F.get(parts, F.lit(0)) == prefix)
    named = F.struct(F.get(parts, F.lit(1)).alias("split"), F.get(parts, F.lit(2)).alias("task"))
    return F.when(fits, named).otherwise(F.struct(F.lit("unknown").alias("split"), F.lit("unknown").alias("task")))


def hub_uri(uri: Column) -> Column:
    """struct(repo_type, repo_id) of a hub URI; the type is 'model' unless 'datasets/' or 'spaces/' precedes. Null for other URIs."""
    rest = F.regexp_extract(uri, r"^hf://(.*)$", 1)
    kind = F.when(F.startswith(rest, F.lit("datasets/")), "dataset").when(F.startswith(rest, F.lit("spaces/")), "space").otherwise("model")
    bare = F.regexp_replace(rest, r"^(datasets|spaces)/", "")
    return F.when(F.startswith(uri, F.lit("hf://")), F.struct(kind.alias("repo_type"), bare.alias("repo_id")))


def uri_scheme(uri: Column) -> Column:
    """'hf', 's3', 'gs', ... or 'file' where there is no scheme."""
    found = F.lower(F.regexp_extract(uri, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    return F.when(uri.isNotNull(), F.when(found == "", "file").otherwise(found))


def is_safe_path(path: Column) -> Column:
    """Whether a relative path stays below its root: not absolute, and never above it on its way."""
    depth = F.aggregate(
        F.split(path, "/"),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("least")),
        lambda acc, part: F.struct(
            (acc["now"] + F.when(part == "..", -1).when(part.isin("", "."), 0).otherwise(1)).alias("now"),
            F.least(acc["least"], acc["now"] + F.when(part == "..", -1).otherwise(0)).alias("least"),
        ),
        lambda acc: acc["least"],
    )
    return (path != "") & ~F.startswith(path, F.lit("/")) & (depth >= 0)


def key_value(pair: Column) -> Column:
    """struct(key, value) of 'key=value', split at the first '='; null without one."""
    at = F.instr(pair, "=")
    return F.when(at > 0, F.struct(F.trim(F.substring(pair, F.lit(1), at - 1)).alias("key"), F.substring(pair, at + 1, F.length(pair)).alias("value")))


def span_pair(text: Column) -> Column:
    """struct(first, last) of 'first:last' with whole numbers and first < last; else null."""
    parts = F.split(text, ":", 2)
    first, last = (F.get(parts, F.lit(i)).try_cast("bigint") for i in (0, 1))
    return F.when((F.size(parts) == 2) & (first < last), F.struct(first.alias("first"), last.alias("last")))


def codec(name: Column) -> Column:
    """The decoder of a codec name, in any case; null for unknown ones."""
    table = F.create_map(*(F.lit(x) for pair in CODECS.items() for x in pair))
    return F.try_element_at(table, F.lower(name))


def require(value: Column, message: str) -> Column:
    """value, or an error where it is null."""
    return F.coalesce(value, F.raise_error(F.lit(message)))


def shard_range(path: Column) -> Column:
    """struct(lo, hi) of '.../<lo>-<hi>.tar'; null for other names and for numbers that do not fit."""
    lo, hi = (F.regexp_extract(path, r"(?:^|/)([0-9]+)-([0-9]+)\.tar$", i).try_cast("bigint") for i in (1, 2))
    return F.when(lo.isNotNull() & hi.isNotNull(), F.struct(lo.alias("lo"), hi.alias("hi")))


def trailing_number(path: Column, suffix: str = ".png") -> Column:
    """The digits before the suffix as a number: 9, 10 and 010 sort as 9, 10, 10."""
    return F.regexp_extract(path, r"([0-9]+)" + re.escape(suffix) + "$", 1).try_cast("bigint")


def data_path(chunk: Column, file: Column) -> Column:
    return F.format_string("data/chunk-%03d/file-%06d.parquet", chunk, file)


def video_path(key: Column, file: Column) -> Column:
    return F.format_string("videos/%s/chunk-000/file-%06d.mp4", key, file)


def glob_pattern(glob: str) -> str:
    """Regular expression of a shell glob over whole names: * crosses '/', ? is one character, [!a] negates."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body[0] == "!" else body) + "]"
            i = close
        else:
            out += re.escape(c)
        i += 1
    return f"^(?s:{out})$"


def glob_filter(name: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Names that match an include glob (all, if None) and no exclude glob."""
    kept = F.lit(True) if include is None else _any(name, include)
    return kept & ~_any(name, exclude or [])


def _any(name: Column, globs: list[str]) -> Column:
    out = F.lit(False)
    for g in globs:
        out |= name.rlike(glob_pattern(g))
    return out


def even_positions(length: Column, n: int) -> Column:
    """n positions spread evenly over 0 .. length - 1, cut to whole numbers; none for an empty series."""
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return F.when(length > 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    spread = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i.cast("double") * (length - 1) / (n - 1)).cast("bigint"))
    return F.when(length > 0, spread).otherwise(F.array().cast("array<bigint>"))


def run_name(tasks: Column) -> Column:
    """Order-free name of a set of tasks."""
    return F.array_join(F.array_sort(tasks), "-")


def history_line(time: Column, status: Column, loss: Column) -> Column:
    """'time status loss' with four decimals of the loss, or n/a."""
    shown = F.coalesce(F.format_string("%.4f", loss), F.lit("n/a"))
    return F.concat_ws(" ", F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), status, F.when(loss.isNull(), F.lit("n/a")).otherwise(shown))
