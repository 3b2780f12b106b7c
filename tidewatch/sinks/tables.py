"""Result tables as folders of parquet.

A micro-batch writes a folder of its own and writes the same folder again when it is repeated, so a restart
from a checkpoint leaves no row twice. Every query and checkpoint needs its own ``run`` label: the numbers
of a new checkpoint begin at zero again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.alerts import alert_rows
from tidewatch.operators.stats import stats_rows
from tidewatch.schemas import RISK_ALERTS, TRANSACTION_STATS, TableSpec

BatchWriter = Callable[[DataFrame, int], None]


def write_batches(path: str, run: str, rows: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    """For ``foreachBatch``: the rows of each batch in ``path/run=.../batch_id=...``. Errors stop the query,
    which goes on from its checkpoint."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows(batch).write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")

    return write


def append_alerts(path: str, detector: str, run: str) -> BatchWriter:
    """Alerts of one detector as ``risk_alerts`` rows."""
    return write_batches(f"{path}/detector={detector}", run, alert_rows)


_BATCH = ["detector", "run"]  # whose batches are numbered


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The compactions of a table that are whole, in order."""
    found = [n for n in folders(spark, path, "_compacted/version=") if has_file(spark, f"{path}/_compacted/version={n}/through/_SUCCESS")]
    return sorted(map(int, found))


def _appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows that no compaction has taken yet."""
    schema = f"{RISK_ALERTS.schema.toDDL()}, detector string, run string, batch_id bigint"
    rows = spark.read.schema(schema).parquet(path)  # folders that begin with _ are not part of it
    versions = _versions(spark, path)
    if not versions:
        return rows
    through = spark.read.parquet(f"{path}/_compacted/version={versions[-1]}/through")  # a row per detector and run
    rows = rows.join(F.broadcast(through), _BATCH, "left")
    return rows.where("through IS NULL OR batch_id > through").drop("through")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All rows that were appended: those of the newest compaction, and the batches after it."""
    names = RISK_ALERTS.schema.fieldNames()
    rows, versions = _appended(spark, path).select(*names), _versions(spark, path)
    if versions:
        rows = rows.unionByName(spark.read.schema(RISK_ALERTS.schema).parquet(f"{path}/_compacted/version={versions[-1]}/rows"))
    return rows


def compact_alerts(spark: SparkSession, path: str, clear: bool = False) -> None:
    """Put the rows of all folders together, next to them, by type. Streams may go on appending.

    What is put together are the batches that are there when this begins. It counts from the moment the list of them,
    the last batch of each detector and run, is whole; till then readers see the folders. A batch that is repeated later
    only writes its old folder. With ``clear`` the folders and compactions that the one before this had taken
    go, so that readers of that one are not disturbed.
    """
    versions = _versions(spark, path)
    next_version = max([0, *map(int, folders(spark, path, "_compacted/version="))]) + 1
    target = f"{path}/_compacted/version={next_version}"
    listed = [(d, r, int(n)) for d in folders(spark, path, "detector=") for r in folders(spark, path, f"detector={d}/run=")
              for n in folders(spark, path, f"detector={d}/run={r}/batch_id=") if has_file(spark, f"{path}/detector={d}/run={r}/batch_id={n}/_SUCCESS")]
    last: dict[tuple[str, str], int] = {}
    for detector, run, n in listed:
        last[detector, run] = max(n, last.get((detector, run), n))
    old = []
    if versions:
        before = f"{path}/_compacted/version={versions[-1]}"
        old = [(r.detector, r.run, r.through) for r in spark.read.parquet(f"{before}/through").collect()]
        for detector, run, n in old:
            last[detector, run] = max(n, last.get((detector, run), n))
    through = spark.createDataFrame([(*k, n) for k, n in last.items()], "detector string, run string, through bigint")
    rows = _appended(spark, path).join(F.broadcast(through), _BATCH).where("batch_id <= through")
    rows = rows.select(*RISK_ALERTS.schema.fieldNames())
    if versions:
        rows = rows.unionByName(spark.read.schema(RISK_ALERTS.schema).parquet(f"{before}/rows"))
    rows.hint("rebalance", "alert_type").sortWithinPartitions("alert_type", "alert_time").write.parquet(f"{target}/rows")
    through.coalesce(1).write.parquet(f"{target}/through")
    if clear:
        taken = {(d, r): n for d, r, n in old}
        for detector, run, n in listed:
            if n <= taken.get((detector, run), -1):
                remove(spark, f"{path}/detector={detector}/run={run}/batch_id={n}")
        for version in versions[:-1]:
            remove(spark, f"{path}/_compacted/version={version}")


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders below ``path``, wherever Spark can write; one level of
    folders is listed."""
    above, _, begin = f"{path}/{prefix}".rpartition("/")
    system, where = _folder(spark, above)
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where)]
    return [n.removeprefix(begin) for n in names if n.startswith(begin)]


def has_file(spark: SparkSession, path: str) -> bool:
    system, where = _folder(spark, path)
    return system.exists(where)


def make_folder(spark: SparkSession, path: str) -> None:
    system, where = _folder(spark, path)
    system.mkdirs(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _folder(spark, path)
    system.delete(where, True)


def upsert_stats(path: str, run: str) -> BatchWriter:
    """Window statistics as ``transaction_stats`` rows that replace earlier rows of the same window and
    category. A batch only adds its rows, in folders by day, then batch; ``read_stats`` picks the newest of each key, so
    no batch reads or rewrites what is stored."""

    def write(batch: DataFrame, batch_id: int) -> None:
        added = {"written_at": F.current_timestamp(), "day": F.to_date("window_start"), "run": F.lit(run), "batch_id": F.lit(batch_id)}
        writer = stats_rows(batch).withColumns(added).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "run", "batch_id").parquet(path)

    return write


def _newest(log: DataFrame) -> DataFrame:
    """The row that counts of each window and category."""
    key = list(TRANSACTION_STATS.key)
    values = [c for c in TRANSACTION_STATS.schema.fieldNames() if c not in key]
    newest = F.max_by(F.struct(*values), F.struct("written_at", "batch_id", F.col("run").cast("string"), *values))
    return log.groupBy(*key).agg(newest.alias("row")).select(*key, "row.*")


def read_stats(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The present rows, of some days if these are given: then only their folders are read. A filter on window or
    category reaches the files as well, as both are keys here. Rows of one key written at one time are told apart by
    run and batch, so a row is always one that was written."""
    log = spark.read.parquet(path)
    if first_day:
        log = log.where(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day:
        log = log.where(F.col("day") <= F.lit(last_day).cast("date"))
    return _newest(log)


def read_newest_stats(spark: SparkSession, path: str, least: int, condition: str = "true") -> DataFrame:
    """The present rows of the newest days that have at least ``least`` rows for which ``condition`` holds; all days
    if there are fewer. Goes back from the newest day, twice as many days at a time, and lists and opens the folders of
    those days only."""
    days = sorted(folders(spark, path, "day="), reverse=True)
    if not days:
        raise ValueError(f"no statistics are stored in {path}")
    back = 1
    while True:
        log = spark.read.option("basePath", path).parquet(*[f"{path}/day={d}" for d in days[:back]])
        rows = _newest(log).where(condition)
        if back >= len(days) or rows.limit(least).count() >= least:
            return rows
        back *= 2


def compact_stats(spark: SparkSession, path: str, target: str) -> None:
    """The present rows as a new table of the same layout, which later batches can go on writing to."""
    upsert_stats(target, "compacted")(read_stats(spark, path).hint("rebalance"), 0)


def is_there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


def create_or_truncate(spark: SparkSession, database: str, tables: dict[str, TableSpec]) -> str:
    """Create all tables if the database has none yet, otherwise empty those given that it has. Returns
    ``"created"`` or ``"truncated"``. Reloading them is the caller's next step."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    present = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    if present:
        for name in tables:
            if name in present:
                spark.sql(f"TRUNCATE TABLE {database}.{name}")
        return "truncated"
    for name, spec in tables.items():
        empty_table(spark, spec).write.format("parquet").saveAsTable(f"{database}.{name}")
    return "created"
