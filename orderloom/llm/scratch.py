"""Tables an operator writes on its way, in the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from orderloom.sources.tables import shared_folder

# Spark can delete a finished query's shuffle files; every step here ends in a
# written table, so nothing reads them again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_made: list[Scratch] | None = None


@contextmanager
def collected() -> Iterator[list[Scratch]]:
    """The scratch folders that are opened inside, so that all they hold can go later."""
    global _made
    outer, _made = _made, []
    try:
        yield _made
    finally:
        _made = outer


def free_name(frame: DataFrame, base: str) -> str:
    """A column name that the frame does not have, in any letter case."""
    taken = {c.lower() for c in frame.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


class Scratch:
    """A folder of one operator run.

    ``store`` cuts the lineage: what follows reads the written table, so a
    lost executor costs at most the step that was running. ``drop`` removes a
    table that no later step reads; the result itself stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_folder(spark, name)
        self.step = 0
        self.paths: dict[str, str] = {}
        if _made is not None:
            _made.append(self)

    def store(self, name: str, frame: DataFrame) -> DataFrame:
        self.step += 1
        path = f"{self.root}/{self.step:03d}-{name}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            frame.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        self.paths[name] = path
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def finish(self, frame: DataFrame, name: str = "result") -> DataFrame:
        """Store the result and remove everything else."""
        result = self.store(name, frame)
        self.drop(*[other for other in self.paths if other != name])
        return result
