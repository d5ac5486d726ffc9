"""File systems as Python code on executors reaches them: local or mounted folders, and what Arrow knows by its URI."""

from __future__ import annotations

import re

from pyarrow import fs


def reached(path: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path within it, what its paths begin with as URIs)."""
    if (local := re.fullmatch(r"file:/{0,2}(/.*)|(/.*)", path)) is not None:
        return fs.LocalFileSystem(), local[1] or local[2], "file:"
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: len(path) - len(inner)]


def files_below(path: str, recursive: bool = True) -> list[tuple[str, int]]:
    """(URI, size) of the files of a folder, or of one file, sorted. Hidden ones and those in folders that begin with _ are left out."""
    system, inner, head = reached(path)
    about = system.get_file_info(inner)
    if about.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if about.type == fs.FileType.File:
        return [(head + inner, about.size)]
    found = system.get_file_info(fs.FileSelector(inner, recursive=recursive))
    own = [f for f in found if f.type == fs.FileType.File and not re.search(r"/[_.]", f.path[len(inner.rstrip("/")) :])]
    return sorted((head + f.path, f.size) for f in own)
