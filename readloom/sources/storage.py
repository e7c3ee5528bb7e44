"""Files of any file system that pyarrow knows, by path or URI; a path without a scheme is a local one."""

from __future__ import annotations

import io
import os

from pyarrow import fs

#: File systems of further schemes.
SYSTEMS: dict[str, fs.FileSystem] = {}


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path there."""
    scheme, found, inner = path.partition("://")
    if found and scheme in SYSTEMS:
        return SYSTEMS[scheme], inner
    if found and scheme != "file":
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file://").removeprefix("file:"))


def uri(path: str) -> str:
    """The path as Spark has to be given it: local ones with their scheme, since Spark may have another default."""
    return path if "://" in path else "file://" + os.path.abspath(path.removeprefix("file:"))


def is_folder(path: str) -> bool:
    system, inner = located(path)
    return system.get_file_info(inner).type == fs.FileType.Directory


def size(path: str) -> int:
    system, inner = located(path)
    return system.get_file_info(inner).size


def names(folder: str) -> list[str]:
    """Names of the files right in a folder, sorted; none if it doesn't exist."""
    return [f for f in files_below(folder, False) if "/" not in f]


def files_below(folder: str, recursive: bool = True) -> list[str]:
    """The files of a folder by their path from there, sorted; none if it doesn't exist."""
    system, inner = located(folder)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=recursive))
    return sorted(f.path[len(inner.rstrip("/")) + 1 :] for f in found if f.type == fs.FileType.File)


def part_names(folder: str) -> list[str]:
    """Names of the part files that Spark wrote, in order of their numbers."""
    parts = [f for f in names(folder) if f.startswith("part-")]
    return sorted(parts, key=lambda f: (int(f.split("-")[1].split(".")[0]), f))


def open_in(path: str):
    """A file to read from any place."""
    system, inner = located(path)
    return system.open_input_file(inner)


def first_line(path: str) -> str:
    """The first line of a text, without its end."""
    with io.TextIOWrapper(open_in(path), encoding="utf-8") as text:
        return text.readline().rstrip("\r\n")


def make_folder(path: str) -> None:
    system, inner = located(path)
    system.create_dir(inner)


def remove_folder(path: str) -> None:
    system, inner = located(path)
    system.delete_dir(inner)


def write_whole(path: str, blocks) -> None:
    """A file of blocks of bytes, which appears once it is whole: a task that writes it can be repeated."""
    system, inner = located(path)
    tmp = f"{inner}.{os.urandom(6).hex()}"
    with system.open_output_stream(tmp) as out:
        for block in blocks:
            out.write(block)
    system.move(tmp, inner)
