"""Files of any file system that Arrow knows, for data sources that run in Python workers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs


def place(uri: str) -> tuple[pafs.FileSystem, str, str]:
    """File system of a path or URI, the path in it, and what to put before its paths to name them outside (nothing if local)."""
    if ":/" not in uri:
        return pafs.LocalFileSystem(), str(Path(uri).absolute()), ""
    scheme, _, rest = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        scheme = "s3"
    fs, path = pafs.FileSystem.from_uri(f"{scheme}://{rest.lstrip('/')}" if scheme != "file" else f"file:///{rest.lstrip('/')}")
    if isinstance(fs, pafs.LocalFileSystem):
        return fs, path, ""
    # hdfs paths lack the host that the URI names
    return fs, path, f"{scheme}://{rest.lstrip('/').split('/')[0]}" if path.startswith("/") else f"{scheme}://"


def files_below(uri: str, suffix: str) -> list[str]:
    """The file uri, or all files below it that end in suffix, in order. A uri that does not exist is an error."""
    fs, path, before = place(uri)
    found = fs.get_file_info(path)
    if found.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"{uri} does not exist")
    if found.type == pafs.FileType.File:
        return [before + path]
    below = fs.get_file_info(pafs.FileSelector(path, recursive=True))
    return sorted(before + f.path for f in below if f.type == pafs.FileType.File and f.path.endswith(suffix))


def open_stream(uri: str) -> pa.NativeFile:
    """The file's bytes from front to back; nothing seeks."""
    fs, path, _ = place(uri)
    return fs.open_input_stream(path, compression=None)


def move_in(fs: pafs.FileSystem, path: str, write: Callable[[str], None]) -> None:
    """Write under another name, then rename: nobody sees half a file, and a repeated task leaves one."""
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write(part)
    fs.move(part, path)
