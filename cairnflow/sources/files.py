"""One file per row: a data source writer that stages files in tasks and shows them only when all tasks are done."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: The list of a folder's files, written last.
LISTING = "_files.json"


@dataclass
class _Staged(WriterCommitMessage):
    folder: str
    names: list[str]


class _FileWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.stage = f"_staged-{uuid.uuid4().hex}"

    def _open(self) -> tuple[arrow_fs.FileSystem, str]:
        return arrow_fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (arrow_fs.LocalFileSystem(), self.path)

    def write(self, rows: Iterator[Row]) -> _Staged:
        fs, root = self._open()
        folder, names = f"{self.stage}/{uuid.uuid4().hex}", []  # one per attempt, so a repeated task never mixes with its first try
        for row in rows:
            name = row["filename"]
            if not name or name.startswith(("_", ".", "/")) or ".." in name.split("/") or posixpath.normpath(name) != name:
                raise ValueError(f"no name for a file: {name!r}")
            target = f"{root}/{folder}/{name}"
            fs.create_dir(posixpath.dirname(target), recursive=True)
            with fs.open_output_stream(target, compression=None) as out:
                out.write(bytes(row["content"] or b""))
            names.append(name)
        return _Staged(folder, names)

    def commit(self, messages: list[_Staged | None]) -> None:
        fs, root = self._open()
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.names]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError(f"several rows for one file: {sorted({n for n in names if names.count(n) > 1})[:5]}")
        fs.create_dir(root, recursive=True)
        old = [f.path[len(root) + 1 :] for f in fs.get_file_info(arrow_fs.FileSelector(root, recursive=True)) if f.type == arrow_fs.FileType.File]
        for m in done:
            for n in m.names:
                fs.create_dir(posixpath.dirname(f"{root}/{n}"), recursive=True)
                fs.move(f"{root}/{m.folder}/{n}", f"{root}/{n}")
        if self.overwrite:
            for n in set(old) - set(names):
                if not n.startswith("_"):
                    fs.delete_file(f"{root}/{n}")
        else:
            names += [n for n in old if not n.startswith("_") and n not in set(names)]
        with fs.open_output_stream(f"{root}/{LISTING}", compression=None) as out:
            out.write((json.dumps(sorted(names), indent=2) + "\n").encode())
        self._tidy("_staged-")  # and what tasks of an aborted run wrote after it was tidied: a folder has one writer at a time

    def abort(self, messages: list[_Staged | None]) -> None:
        self._tidy(self.stage)

    def _tidy(self, prefix: str) -> None:
        fs, root = self._open()
        for f in fs.get_file_info(arrow_fs.FileSelector(root, allow_not_found=True)):
            if f.base_name.startswith(prefix):
                fs.delete_dir(f.path)


class NamedFiles(DataSource):
    """df.write.format("named_files").mode("overwrite").save(path): every row (filename, content) becomes a file of the folder.

    Tasks write into a staging folder; when all have ended the files are moved to their names, with mode overwrite files of earlier runs
    whose names no row has are removed, and a listing is written last. A task that fails leaves the folder as it was. Names may have
    folders in them; empty, absolute, hidden or repeated names are errors.
    """

    @classmethod
    def name(cls):
        return "named_files"

    def schema(self):
        return "filename string, content binary"

    def writer(self, schema, overwrite):
        return _FileWriter(self.options["path"], overwrite)


def write_files(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """The rows (filename, content) of df as files under ``path``, a folder that driver and executors share."""
    register(df.sparkSession)
    df.select("filename", "content").write.format("named_files").mode("overwrite" if overwrite else "append").save(path)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedFiles)
