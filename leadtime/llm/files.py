"""Files in the shared folder, through pyarrow's file systems (local paths, hdfs://, s3://, gs://)."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_whole(path: str, data: bytes) -> None:
    """Write under a temporary name, then rename, so that no reader sees half a file."""
    system, place = opened(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(place + ".part") as out:
        out.write(data)
    system.move(place + ".part", place)
