"""Small numbered notes beside the tables: what is committed, which days are finished."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """File calls on one folder of the cluster's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self.path = self._hadoop.Path(path)
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def __truediv__(self, name: str):
        return self._hadoop.Path(self.path, name)

    def entries(self) -> list[tuple[str, int]]:
        """(name, size) of everything in the folder, by one listing."""
        try:
            found = self.files.listStatus(self.path)
        except Exception as error:
            if "FileNotFoundException" in str(error):
                return []
            raise
        return sorted((e.getPath().getName(), e.getLen()) for e in found)

    def write(self, name: str, text: str) -> None:
        """Write a file under a passing name first, so that none is ever seen half."""
        passing = self / f"_{name}"
        out = self.files.create(passing, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.files.rename(passing, self / name)

    def read(self, name: str) -> str:
        stream = self.files.open(self / name)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.files.delete(self / name, True)


class Notes:
    """The newest of a folder's numbered notes counts; older ones go when it is written."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def _numbers(self) -> list[int]:
        return [int(n) for n, _ in self.folder.entries() if n.isdigit()]

    def latest(self) -> dict:
        numbers = self._numbers()
        return json.loads(self.folder.read(f"{max(numbers):09d}")) if numbers else {}

    def put(self, note: dict) -> None:
        numbers = self._numbers()
        self.folder.write(f"{max(numbers, default=0) + 1:09d}", json.dumps(note))
        for number in numbers:
            self.folder.delete(f"{number:09d}")
