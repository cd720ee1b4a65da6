"""Files by ranges for the Python data sources: whatever pyarrow can open, on every executor alike."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

INDEX = "_index.json"

SCHEMES = "a local path that all executors share, or file:, hdfs:, s3:, gs: and the like, as pyarrow.fs knows them"


class Store:
    """A folder or file by its URI."""

    def __init__(self, uri: str):
        try:
            self.fs, self.root = pafs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else uri.replace("file:", "file://", 1)) if ":" in uri else (pafs.LocalFileSystem(), uri)
        except (pafs._fs.ArrowInvalid, OSError) as e:
            raise ValueError(f"{uri}: not a place this source can open ({SCHEMES})") from e
        self.root = self.root.rstrip("/")

    def at(self, name: str) -> str:
        return posixpath.join(self.root, name) if name else self.root

    def exists(self, name: str = "") -> bool:
        return self.fs.get_file_info(self.at(name)).type != pafs.FileType.NotFound

    def names(self, suffix: tuple[str, ...]) -> list[str]:
        """The root itself if it is a file ("" is its name), else the files directly in it with one of the suffixes."""
        info = self.fs.get_file_info(self.root)
        if info.type == pafs.FileType.File:
            return [""]
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        found = (f.base_name for f in self.fs.get_file_info(pafs.FileSelector(self.root)) if f.type == pafs.FileType.File)
        return sorted(n for n in found if n.lower().endswith(suffix) and not n.startswith(("_", ".")))

    def size(self, name: str) -> int:
        return self.fs.get_file_info(self.at(name)).size

    def ranges(self, name: str, spans: list[tuple[int, int]]) -> Iterator[bytes]:
        """The bytes at each (offset, length)."""
        with self.fs.open_input_file(self.at(name)) as f:
            for offset, length in spans:
                yield f.read_at(length, offset)

    def all(self, name: str) -> bytes:
        with self.fs.open_input_file(self.at(name)) as f:
            return f.read()

    def put(self, name: str, data: bytes) -> None:
        self.fs.create_dir(posixpath.dirname(self.at(name)), recursive=True)
        with self.fs.open_output_stream(self.at(name), compression=None) as f:
            f.write(data)

    def stream(self, name: str):
        self.fs.create_dir(posixpath.dirname(self.at(name)), recursive=True)
        return self.fs.open_output_stream(self.at(name), compression=None)

    def move(self, name: str, to: str) -> None:
        self.fs.move(self.at(name), self.at(to))

    def remove(self, *names: str) -> None:
        for name in names:
            if self.exists(name):
                self.fs.delete_file(self.at(name))

    def remove_folder(self, name: str) -> None:
        if self.exists(name):
            self.fs.delete_dir(self.at(name))


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: a name and whatever the index should say of it, for each file."""

    files: list


class FolderWriter(DataSourceArrowWriter):
    """Files of a folder with an index: tasks write into a folder of the job's own, the commit moves what the tasks that
    Spark reports have written and puts the index in place. Tasks that ran twice leave files under other names, which are
    not moved. Files of an earlier table at the path go last, once the new index names none of them."""

    def __init__(self, path: str, overwrite: bool, head: dict):
        self.path, self.head, self.job = path, head, uuid.uuid4().hex
        if not overwrite and Store(path).exists(INDEX):
            raise ValueError(f"{path} has a table already; use mode overwrite")

    def put(self, store: Store, name: str, data: bytes) -> str:
        """The name under which the file will stand."""
        stem, dot, tail = name.rpartition(".")
        name = f"{stem}-{uuid.uuid4().hex[:12]}{dot}{tail}"
        store.put(f"_temporary/{self.job}/{name}", data)
        return name

    def ordered(self, files: list[dict]) -> list[dict]:
        return sorted(files, key=lambda f: f["name"])

    def commit(self, messages: list[Written | None]) -> None:
        store = Store(self.path)
        before = [f["name"] for f in json.loads(store.all(INDEX))["files"]] if store.exists(INDEX) else []
        try:
            files = self.ordered([f for m in messages if m is not None for f in m.files])
        except ValueError:
            self.abort(messages)
            raise
        for f in files:
            store.move(f"_temporary/{self.job}/{f['name']}", f["name"])
        store.put(f"{INDEX}.{self.job}", json.dumps(self.head | {"files": files}).encode())
        store.move(f"{INDEX}.{self.job}", INDEX)
        store.remove(*before)
        store.remove_folder("_temporary")

    def abort(self, messages: list[Written | None]) -> None:
        Store(self.path).remove_folder(f"_temporary/{self.job}")
