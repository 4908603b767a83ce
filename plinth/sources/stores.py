"""Files of any store that pyarrow knows (file, hdfs, s3, gs), opened where they are read: by the driver for headers
and listings, by executors for data.  A plain path must be on a mount that all of them share.
"""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def exists(path: str) -> bool:
    store, at = opened(path)
    return store.get_file_info(at).type == fs.FileType.File


def files_below(path: str, suffix: str) -> list[str]:
    """The file itself, or all files with the suffix below a folder, in order."""
    store, at = opened(path)
    if store.get_file_info(at).type == fs.FileType.File:
        return [path]
    scheme = path[: len(path) - len(at)] if path.endswith(at) else ""
    found = store.get_file_info(fs.FileSelector(at, recursive=True))
    hidden = lambda f: any(p.startswith("_") for p in f.path[len(at) :].split("/"))  # noqa: E731  what a writer has not committed
    return sorted(scheme + f.path for f in found if f.type == fs.FileType.File and f.path.endswith(suffix) and not hidden(f))


def read_at(path: str, offset: int, size: int) -> bytes:
    store, at = opened(path)
    with store.open_input_file(at) as f:
        return f.read_at(max(0, min(size, f.size() - offset)), offset)


def size_of(path: str) -> int:
    store, at = opened(path)
    return store.get_file_info(at).size


def sink(path: str):
    """A stream into a new file; folders above it are made."""
    store, at = opened(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(at)


def move(path: str, to: str) -> None:
    """The file under its new name in the same store; one that is there is replaced."""
    store, at = opened(path)
    there = opened(to)[1]
    store.create_dir(there.rsplit("/", 1)[0], recursive=True)
    store.move(at, there)


def delete_folder(path: str) -> None:
    store, at = opened(path)
    if store.get_file_info(at).type == fs.FileType.Directory:
        store.delete_dir(at)
