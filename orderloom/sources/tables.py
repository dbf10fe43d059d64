"""Where staging rows come from and where reports go."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.ledger import REPORTS, pending, settled, status_ledger
from orderloom.sources.commits import Commit, CommitLog
from orderloom.sources.notes import Folder

# The ledger entry of the version corrections.
VERSIONS = "versions"
# Commits that reopen a report, beside those that settle it.
AGAIN = "~again"
NO_DAY = "unknown"

INBOUND_SCHEMA = (
    "id bigint, json string, created timestamp, company_code string, "
    "transaction_type string, status string"
)


#: A document costs far more CPU than its bytes tell, so files are dealt out in small splits.
SPLIT_BYTES = 16 << 20
#: Settings of a run beside that. Tables are split by a few values, which needs no sort while that
#: many files may be open; a shuffle's files go with the execution that made them. A ledger's id
#: takes a byte of the share its column has of the file and some 40 in a broadcast, so what the
#: planner takes for small by its file is weighed up.
RUN_CONF = {
    "spark.sql.sources.fileCompressionFactor": "20",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def run_settings(spark: SparkSession):
    """The settings of a run, put back as they were afterwards."""
    given = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    wanted = {**RUN_CONF, "spark.sql.files.maxPartitionBytes": str(min(given, SPLIT_BYTES))}
    had = {key: spark.conf.get(key) for key in wanted if key in spark.conf.getAll}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in wanted:
            spark.conf.set(key, had[key]) if key in had else spark.conf.unset(key)


def read_inbound(spark: SparkSession, path: str) -> DataFrame:
    """The staging table from Parquet files."""
    return spark.read.schema(INBOUND_SCHEMA).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's checkpoint folder.

    Only a local session without that setting gets a temporary one.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="orderloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def po_bucket(buckets: int) -> Column:
    """Bucket of an order number, whose rows are looked up together."""
    return F.pmod(F.xxhash64(F.upper("company"), F.upper("customer_po")), F.lit(buckets))


class ReportStore:
    """Report tables under one folder, one partition per run.

    A run's partition counts only once the commit log names the run for that
    report, and writing it again replaces it, so a retry after a lost job
    neither loses nor repeats rows. Rows of reopened orders count only from the
    run that did them last.

    ``buckets`` divides the order numbers: a run reads the buckets it touches of
    the history, and writes a file for each. It stays the same for a store.
    """

    #: Tables that are read by order number, and pruned by its bucket.
    BUCKETED = ("orders", "corrections")

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.log = CommitLog(spark, self.root)
        self._pinned: list[Commit] | None = None

    # Commits

    def commits(self) -> list[Commit]:
        return self._pinned if self._pinned is not None else self.log.read()

    @contextmanager
    def pinned(self):
        """List the commits once; what is committed inside is added to the list."""
        outer = self._pinned
        if outer is None:
            self._pinned = self.log.read()
        try:
            with run_settings(self.spark):
                yield
        finally:
            self._pinned = outer

    def runs(self, report: str) -> list[str]:
        """Committed runs of a report, in the order of their commits."""
        return [c.run for c in self.commits() if c.report == report]

    def commit(self, report: str, source_ids: DataFrame, run: str, kind: str | None = None) -> None:
        """Enter the ids in the ledger and make the run count.

        The ids may bring a ``status`` and the ``arrival_day`` of their rows.
        """
        seq = 1 + max([c.seq for c in self.commits()], default=0)
        commit = self.write_ledger(source_ids, report, run, seq, kind)
        self.log.add(commit)
        if self._pinned is not None:
            self._pinned.append(commit)

    def write_ledger(
        self, source_ids: DataFrame, report: str, run: str, seq: int, kind: str | None = None
    ) -> Commit:
        """Ledger entries of a commit that is still to be logged."""
        entries = status_ledger(source_ids, report, run).drop("run").withColumn("seq", F.lit(seq))
        day = F.col("arrival_day") if "arrival_day" in entries.columns else F.lit(None)
        path = f"{self.root}/ledger/kind={kind or report}/run={run}"
        entries.withColumn("arrival_day", F.coalesce(day, F.lit(NO_DAY))).hint(
            "rebalance", F.col("arrival_day")
        ).write.mode("overwrite").partitionBy("arrival_day").parquet(path)
        names = [n for n, _ in Folder(self.spark, path).entries()]
        days = [n.removeprefix("arrival_day=") for n in names if n.startswith("arrival_day=")]
        return Commit(seq, kind or report, run, min(days, default=""), max(days, default=""))

    # Ledger

    def ledger(self, reports: list[str] | None = None, days: list[str] | None = None) -> DataFrame | None:
        """Committed entries, of some reports and arrival days, or None when there are none.

        Runs that hold none of the days are not even listed, other days of the
        rest are pruned as partitions.
        """
        wanted = [
            c
            for c in self.commits()
            if (reports is None or c.report.removesuffix(AGAIN) in reports)
            and c.first_day
            and c.meets(days)
        ]
        if not wanted:
            return None
        paths = [f"{self.root}/ledger/kind={c.report}/run={c.run}" for c in wanted]
        rows = self.spark.read.option("basePath", f"{self.root}/ledger").parquet(*paths)
        rows = rows.withColumns({c: F.col(c).cast("string") for c in ("run", "arrival_day")})
        return (rows if days is None else rows.filter(F.col("arrival_day").isin(days))).drop("kind")

    def reopen(self, source_ids: DataFrame, reports: list[str], name: str | None = None) -> None:
        """Make reports of some orders due again.

        The details stand for everything: with them, all reports of the order
        are done anew from its document. Other reports are built again from the
        lines that are kept. Until then their old rows are not shown.
        """
        name = name or f"reopened-{uuid.uuid4().hex}"
        if "details" in reports:
            reports = [*REPORTS, VERSIONS]
        ids = source_ids.select("source_id").distinct()
        known = self.ledger(["details"])
        if known is None:
            return
        dated = (
            settled(known, "details")
            .join(ids, "source_id", "left_semi")
            .select("source_id", "arrival_day", F.lit("Reopened").alias("status"))
        )
        # The details last: their pickup must find the reports already open.
        for report in reversed(reports):
            self.commit(report, dated, name, kind=report + AGAIN)

    def reopened(self, report: str) -> DataFrame | None:
        """Ids that were ever reopened for a report, with the run that did them last.

        The run is NULL while they are due. None when nothing was reopened.
        """
        if not self.runs(report + AGAIN):
            return None
        entries = self.ledger([report])
        again = entries.filter("status = 'Reopened'").select("source_id").distinct()
        done = settled(entries, report).groupBy("source_id").agg(F.max_by("run", "seq").alias("done_run"))
        return again.join(done, "source_id", "left")

    def reopened_days(self) -> list[str]:
        """Arrival days of orders whose details are due again; at most one value a day."""
        if not self.runs("details" + AGAIN):
            return []
        entries = self.ledger(["details"])
        again = entries.filter("status = 'Reopened'").select("source_id", "arrival_day").distinct()
        due = pending(again, entries, "details", key="source_id")
        return sorted(r[0] for r in due.select("arrival_day").distinct().collect())

    # Tables

    def write_report(
        self, table: str, rows: DataFrame, run: str, part_by: str | None = None
    ) -> None:
        """Replace a run's rows; ``part_by`` names a column of few values to split them by."""
        path = f"{self.root}/{table}/run={run}"
        if table not in self.BUCKETED:
            rows.write.mode("overwrite").parquet(path, partitionBy=part_by)
            return
        bucketed = rows.withColumn("po_bucket", po_bucket(self.buckets)).hint(
            "rebalance", F.col("po_bucket")
        )
        bucketed.write.mode("overwrite").partitionBy("po_bucket").parquet(path)
        if not any(n.startswith("po_bucket=") for n, _ in Folder(self.spark, path).entries()):
            # A partitioned write of nothing leaves no file to read the columns from.
            rows.limit(0).write.parquet(f"{path}/po_bucket=0")

    def write_part(self, table: str, rows: DataFrame, run: str, part: str) -> None:
        """Replace one part of a run, such as ``part=looked``."""
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/run={run}/{part}")

    def read_runs(self, table: str, runs: list[str]) -> DataFrame:
        """The given runs of a table; other partitions are not even listed."""
        paths = [f"{self.root}/{table}/run={run}" for run in runs]
        rows = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.withColumn("run", F.col("run").cast("string"))

    def read(self, table: str, report: str | None = None) -> DataFrame | None:
        """All rows of a table that count, or None when there are none."""
        report = report or table
        runs = self.runs(report)
        if not runs:
            return None
        rows, again = self.read_runs(table, runs), self.reopened(report)
        if again is None:
            return rows
        # Few ids are ever reopened; the planner sees how few.
        told = again.withColumn("again", F.lit(True))
        return (
            rows.join(told, "source_id", "left")
            .filter(F.col("again").isNull() | (F.col("run") == F.col("done_run")))
            .select(*rows.columns)
        )
