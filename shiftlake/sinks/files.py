"""Small control files on whatever file system holds the tables."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ControlFiles:
    """Numbered JSON files in one folder; the highest number is the current one.

    A number is written once, by an atomic create. Two writers racing for the
    same number make one of them fail instead of losing an update.
    """

    def __init__(self, spark: SparkSession, folder: str, stem: str):
        self._hadoop = spark._jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()
        self._folder, self._stem = folder, stem
        self._fs = self._hadoop.fs.Path(folder).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.fs.Path(f"{self._folder}/{name}")

    def numbers(self) -> list[int]:
        folder = self._hadoop.fs.Path(self._folder)
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder) if s.getLen() > 0]
        prefix, ext = f"{self._stem}-", ".json"
        return sorted(int(n[len(prefix):-len(ext)]) for n in names if n.startswith(prefix) and n.endswith(ext))

    def read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self._stem}-{number:010d}.json"))
        try:
            raw = bytes(stream.readAllBytes())
        finally:
            stream.close()
        return json.loads(raw)

    def write(self, number: int, content: dict, overwrite: bool = False) -> None:
        """Claim the number by creating its file, which one writer only can do; with ``overwrite`` replace it.

        A reader that meets a claimed, not yet filled file passes over it (see ``numbers``).
        """
        target = self._path(f"{self._stem}-{number:010d}.json")
        try:
            stream = self._fs.create(target, overwrite)
        except Py4JJavaError as failed:
            if self._fs.exists(target):
                raise FileExistsError(f"{target} was written by someone else") from failed
            raise
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()

    def remove(self, number: int) -> None:
        self._fs.delete(self._path(f"{self._stem}-{number:010d}.json"), False)

    def remove_folder(self, folder: str) -> None:
        self._fs.delete(self._hadoop.fs.Path(folder), True)

    def children(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._hadoop.fs.Path(folder)) if s.isDirectory()]
