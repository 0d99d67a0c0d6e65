"""A tree of files of any size as a table of paths, sizes and hashes (A1): a data source that reads each file in chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from factloom.functions import text as T

#: Bytes of a file in memory at once; files that a partition lists itself; folders that the driver looks into to find partitions.
CHUNK, FILES, FOLDERS = 8 << 20, 1000, 2000


@dataclass
class Part(InputPartition):
    """Folders to walk down to the end, and single files."""

    folders: tuple[str, ...]
    files: tuple[tuple[str, int], ...]


def _open(root: str):  # noqa: ANN202
    """(file system, path of the root in it); a plain path is one of the machine."""
    from pyarrow import fs

    if root.startswith("file:"):
        root = "/" + root[5:].lstrip("/")
    system, path = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    return system, path.rstrip("/")


def _list(system, folder: str) -> tuple[list[str], list[tuple[str, int]]]:  # noqa: ANN001
    from pyarrow import fs

    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    # Files that a writer has hidden are none of the tree's.
    shown = [i for i in found if not i.base_name.startswith(("_", "."))]
    return [i.path for i in shown if i.type == fs.FileType.Directory], [(i.path, i.size) for i in shown if i.type == fs.FileType.File]


class RawTree(DataSource):
    """Options: path; media (a list of extensions to leave out, parted by commas)."""

    @classmethod
    def name(cls) -> str:
        return "rawtree"

    def schema(self) -> str:
        return "raw_path string, size long, sha256 string"

    def reader(self, schema) -> RawTreeReader:  # noqa: ANN001
        return RawTreeReader(self.options)


class RawTreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.media = tuple(f".{e}" for e in options.get("media", "").split(",") if e)
        self.prefixes: list[tuple[str, ...]] = []
        self.names: list[tuple[str, ...]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Prefixes and values of raw_path are looked at before a folder is listed or a file is read."""
        for f in filters:
            if getattr(f, "attribute", None) == ("raw_path",) and isinstance(f, StringStartsWith):
                self.prefixes.append((f.value,))
            elif getattr(f, "attribute", None) == ("raw_path",) and isinstance(f, EqualTo | In):
                self.names.append((f.value,) if isinstance(f, EqualTo) else tuple(f.value))
            else:
                yield f

    def _may_hold(self, folder: str) -> bool:
        """Can a file below the folder (relative, with a slash at its end) pass the filters?"""
        both = [*self.prefixes, *self.names]
        return all(any(x.startswith(folder) or folder.startswith(x) for x in own) for own in both)

    def _wanted(self, name: str) -> bool:
        given = all(name.startswith(p) for p in self.prefixes) and all(name in own for own in self.names)
        return given and not (self.media and name.lower().endswith(self.media))

    def partitions(self) -> list[Part]:
        """Folders are looked into, widest first, until there are enough of them to deal out; the tasks walk the rest."""
        system, root = _open(self.root)
        queue, files, looked = [root], [], 0
        while queue and looked < FOLDERS and len(queue) < FOLDERS:
            folders, own = _list(system, queue.pop(0))
            looked += 1
            files += [(p, n) for p, n in own if self._wanted(p[len(root) + 1 :])]
            queue += [d for d in folders if self._may_hold(d[len(root) + 1 :] + "/")]
        parts = [Part((d,), ()) for d in queue]
        return parts + [Part((), tuple(files[a : a + FILES])) for a in range(0, len(files), FILES)] or [Part((), ())]

    def read(self, partition: Part) -> Iterator[tuple[str, int, str]]:
        system, root = _open(self.root)
        queue = list(partition.folders)
        for path, _ in partition.files:
            yield self._hash(system, root, path)
        while queue:
            folders, files = _list(system, queue.pop())
            queue += [d for d in folders if self._may_hold(d[len(root) + 1 :] + "/")]
            for path, _ in files:
                if self._wanted(path[len(root) + 1 :]):
                    yield self._hash(system, root, path)

    def _hash(self, system, root: str, path: str) -> tuple[str, int, str]:  # noqa: ANN001
        h, n = hashlib.sha256(), 0
        with system.open_input_stream(path) as f:
            while chunk := f.read(CHUNK):
                h.update(chunk)
                n += len(chunk)
        return path[len(root) + 1 :], n, h.hexdigest()


def hash_raw_tree(spark: SparkSession, root: str, skip_media: bool = True) -> DataFrame:
    """(raw_path, tree, size, sha256) of all files under root, in bounded memory whatever their size.

    Filters on raw_path (equal, in, starts with) keep folders from being listed and files from being read. The file system is
    what pyarrow opens for the root's scheme; a plain path must be one that all machines see. Empty trees give no rows.
    """
    spark.dataSource.register(RawTree)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    read = spark.read.format("rawtree").option("path", root)
    rows = (read.option("media", ",".join(T.MEDIA_EXTENSIONS)) if skip_media else read).load()
    return rows.select("raw_path", T.tree_of(F.col("raw_path")).alias("tree"), "size", "sha256")
