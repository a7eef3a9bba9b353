"""Files by URI inside tasks and for listings: local paths and whatever stores Arrow knows."""

from __future__ import annotations

import fnmatch

import pyarrow.fs as pafs


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def listed(uri: str, pattern: str = "*") -> list[pafs.FileInfo]:
    """The files of a folder and those in it whose name matches, or the file itself, in order of path; hidden and staged ones (names that start with ``_`` or ``.``) are left out."""
    fs, path = filesystem(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    if info.type == pafs.FileType.File:
        return [info]
    root = path.rstrip("/") + "/"
    found = [i for i in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if i.type == pafs.FileType.File]
    return sorted((i for i in found if fnmatch.fnmatch(i.base_name, pattern) and not any(p[:1] in "_." for p in i.path[len(root) :].split("/"))), key=lambda i: i.path)
