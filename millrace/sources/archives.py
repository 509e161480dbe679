"""Members of zip and tar archives."""

from __future__ import annotations

import io
import stat
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# Limits of one archive.
MAX_MEMBERS = 200_000
MAX_BYTES = 8 * 1024**3


@dataclass
class Entry:
    """One member of an archive, whatever its format."""

    name: str
    size: int
    kind: str  # "file", "folder", "link" or "other"
    read: Callable[[], bytes]


def _zip_kind(info: zipfile.ZipInfo) -> str:
    if stat.S_ISLNK(info.external_attr >> 16):
        return "link"
    return "folder" if info.is_dir() else "file"


def _tar_kind(info: tarfile.TarInfo) -> str:
    kinds = {"link": info.issym() or info.islnk(), "folder": info.isdir(), "file": info.isfile()}
    return next((kind for kind, true in kinds.items() if true), "other")


@contextmanager
def _opened(content: bytes) -> Iterator[list[Entry]]:
    """The entries of a zip or tar archive; they can be read while it is open."""
    data = io.BytesIO(content)
    if zipfile.is_zipfile(data):
        with zipfile.ZipFile(data) as archive:
            yield [
                Entry(i.filename, i.file_size, _zip_kind(i), partial(archive.read, i))
                for i in archive.infolist()
            ]
        return
    data.seek(0)
    with tarfile.open(fileobj=data, mode="r:*") as archive:
        yield [
            Entry(i.name, i.size, _tar_kind(i), lambda i=i: archive.extractfile(i).read())
            for i in archive.getmembers()
        ]


def _refusal(entries: list[Entry], max_members: int, max_bytes: int) -> str | None:
    """Why an archive is not unpacked, if there is a reason."""
    unpacked = sum(max(0, e.size) for e in entries)
    if len(entries) > max_members:
        return f"archive has {len(entries)} members, more than {max_members}"
    if unpacked > max_bytes:
        return f"archive unpacks to {unpacked} bytes, more than {max_bytes}"
    for entry in entries:
        path = PurePosixPath(entry.name.replace("\\", "/"))
        if path.is_absolute() or ".." in path.parts:
            return f"archive member leaves its folder: {entry.name}"
        if entry.kind in ("link", "other"):
            return f"archive member is a {entry.kind} and no plain file: {entry.name}"
    return None


def scan_archive_members(
    spark: SparkSession, path: str, max_members: int = MAX_MEMBERS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Members of all archives under ``path``: see ``unpack``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{zip,tar,tar.gz,tgz,tar.bz2}")
    return unpack(files.load(path).select("path", "content"), max_members, max_bytes)


def unpack(
    archives: DataFrame, max_members: int = MAX_MEMBERS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``(archive, member, relative, content)`` of all plain files in archives ``(path, content)``.

    Every member is checked before the first is read. One task reads one archive and passes its
    members on one by one. ``relative`` leaves out a single top folder.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"], strict=True):
                with _opened(content) as entries:
                    if refusal := _refusal(entries, max_members, max_bytes):
                        raise ValueError(refusal)
                    nested = [e.name.split("/", 1)[0] for e in entries if "/" in e.name]
                    tops = {top for top in nested if not top.startswith(".")}
                    strip = f"{next(iter(tops))}/" if len(tops) == 1 else ""
                    for entry in entries:
                        if entry.kind == "file":
                            yield pd.DataFrame(
                                {"archive": [archive], "member": [entry.name],
                                 "relative": [entry.name.removeprefix(strip)], "content": [entry.read()]}
                            )

    schema = "archive string, member string, relative string, content binary"
    return archives.select("path", "content").mapInPandas(work, schema)
