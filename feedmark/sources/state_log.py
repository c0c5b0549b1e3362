"""The retained state as a sorted base and a log of changes.

A run adds the rows it changed, not the whole state. The base is bucketed by key and sorted in its
buckets, so the comparison with a day's observations moves the day's rows and the changes since the base
only: above the base there is neither a shuffle nor a sort. The last changes of each key win over the base.
``compact`` folds changes into a new base; versions stay readable until ``expire`` removes them.

Folders below the root: ``base-<sequence>``, ``changes/sequence=<n>``, ``watermarks/sequence=<n>`` and ``commits``.
A run exists once its row in ``commits`` does; a rerun replaces what it wrote.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmark import model as m
from feedmark.operators import difference as d
from feedmark.sources.tables import STATE_FORMAT, STATE_SCHEMA, UNREADABLE

BUCKETS = 64
SORTED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"  # a bucket of one file is read as it is sorted
COMMITS = "sequence long, run_id string, format int, baseline_instant timestamp, base long, base_at string, buckets int, n_changes long"
CHANGES = f"{STATE_SCHEMA.strip()}, member string, gone boolean, sequence long"
_ROW = ("status", "fallen_since", *d._ATTRIBUTES)
_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


@dataclass(frozen=True)
class Version:
    """The state after a run, in its parts; or why there is none (``outcome`` other than ``ok``)."""

    outcome: str
    base: DataFrame | None = None  # STATE_COLUMNS, one row for each key, bucketed and sorted by key
    changes: DataFrame | None = None  # CHANGES since the base, any number of rows for a key
    watermarks: DataFrame | None = None
    baseline_instant: datetime | None = None
    run_id: str | None = None
    sequence: int | None = None
    error: str | None = None

    def latest(self) -> DataFrame:
        """KEY, changed: the last change of each key since the base."""
        row = F.struct("gone", *_ROW)
        return self.changes.groupBy(*d.KEY).agg(F.max_by(row, F.col("sequence")).alias("changed"))

    @property
    def indicators(self) -> DataFrame:
        """The state's rows. The base is read in place; only the changes move."""
        return _merged(self.base, self.latest()).where(F.col("before").isNotNull()).select(*d.KEY, "before.*").select(*d.STATE_COLUMNS)


def _merged(base: DataFrame, others: DataFrame) -> DataFrame:
    """KEY, before and the columns of ``others`` but ``changed``, which overrides the base."""
    held = base.select(*d.KEY, F.struct(*_ROW).alias("held"))
    changed = F.col("changed")
    kept = F.when(~changed["gone"], F.struct(*(changed[c].alias(c) for c in _ROW)))
    rest = [c for c in others.columns if c not in (*d.KEY, "changed")]
    before = F.when(changed.isNotNull(), kept).otherwise(F.col("held"))
    return held.join(others.hint("merge"), list(d.KEY), "full_outer").select(*d.KEY, *rest, before.alias("before"))


def compare(observed: DataFrame, version: Version) -> DataFrame:
    """As ``difference.compare``: (KEY, now, before). Today's rows and the changes are put together first,
    so the base takes part in one join, as it lies."""
    today = observed.groupBy(*d.KEY).agg(F.min(d._preference()).alias("now"))
    both = _merged(version.base, today.join(version.latest(), list(d.KEY), "full_outer"))
    return both.where(F.col("now").isNotNull() | F.col("before").isNotNull())  # keys that are gone stay in the log


def changes(compared: DataFrame, gate: DataFrame, mode: str, run_start: Column, retention_days: int = m.RETENTION_DAYS) -> DataFrame:
    """What the run changes: STATE_COLUMNS of the next row (of the last one where it is ``gone``), and its
    ``member`` of the published sets. A row that stays as it is is not there, unless it is a member."""
    return _changes(d.next_rows(compared, gate, mode, run_start, retention_days))


def _changes(rows: DataFrame) -> DataFrame:
    names = ("status", "fallen_since", *d._ATTRIBUTES)
    new, old = F.struct(*(F.col(f"next.{c}") for c in names)), F.struct(*(F.col(f"before.{c}") for c in names))
    gone = F.col("next").isNull()
    differs = F.when(gone, F.col("before").isNotNull()).otherwise(F.col("before").isNull() | ~new.eqNullSafe(old))
    row = F.when(gone, F.col("before")).otherwise(F.col("next"))
    told = rows.where(differs | F.col("member").isNotNull()).select(*d.KEY, row.alias("row"), "member", gone.alias("gone"), differs.alias("differs"))
    return told.select(*d.KEY, *(F.col("row")[c].alias(c) for c in names), "member", "gone", "differs").select(*d.STATE_COLUMNS, "member", "gone", "differs")


class StateLog:
    """Versions of the retained state below one root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        spark.conf.set(SORTED_SCANS, "true")

    # -- reading

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")

    def load(self, before: int | None = None) -> Version:
        """The last version, or the last one before a sequence number. Only a missing folder is an absent state."""
        if not exists(self.spark, f"{self.root}/commits"):
            return Version("absent")
        try:
            rows = self._commits()
            if before is not None:
                rows = rows.where(F.col("sequence") < before)
            last = rows.orderBy(F.desc("sequence"), F.desc("base")).first()
            if last is None:
                return Version("absent")
            if last["format"] > STATE_FORMAT:
                return Version("illegible", error=f"state format {last['format']}")
            base = self._base(last["base_at"], last["buckets"])
            changed = self._changes(last["base"], last["sequence"])
            marks = self.spark.read.schema("source string, watermark timestamp, sequence long").parquet(f"{self.root}/watermarks")
            marks = marks.where(F.col("sequence") == last["sequence"]).drop("sequence")
            outcome = "no_watermark" if marks.isEmpty() else "ok"
        except UNREADABLE as fault:
            return Version("illegible", error=str(fault))
        return Version(outcome, base, changed, marks, last["baseline_instant"], last["run_id"], last["sequence"])

    def _changes(self, after: int, upto: int) -> DataFrame:
        """Change sets of committed runs; a folder without its commit is one of a run that did not end."""
        if not exists(self.spark, f"{self.root}/changes"):
            return self.spark.createDataFrame([], CHANGES)
        every = self.spark.read.schema(CHANGES).parquet(f"{self.root}/changes")
        runs = self._commits().where((F.col("sequence") > after) & (F.col("sequence") <= upto)).select("sequence")
        numbers = [r[0] for r in runs.distinct().collect()]  # of the runs since the base; they prune the folders
        return every.where(F.col("sequence").isin(numbers)) if numbers else every.where(F.lit(False))

    def _base(self, at: str, buckets: int) -> DataFrame:
        """The base as a bucketed table. Its folder outlives the session; its declaration is made anew in each."""
        name = "feedmark_" + at.rsplit("-", 1)[-1]
        if not self.spark.catalog.tableExists(name):
            keys = ", ".join(d.KEY)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({STATE_SCHEMA}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{at}'"
            )
        return self.spark.table(name)

    # -- writing

    def _write_base(self, rows: DataFrame, sequence: int) -> str:
        at = f"{self.root}/base-{sequence}-{uuid.uuid4().hex}"
        # Each task writes the one bucket it holds, so a bucket is one sorted file.
        dealt = rows.select(*d.STATE_COLUMNS).repartition(self.buckets, *d.KEY)
        writer = dealt.write.format("parquet").bucketBy(self.buckets, *d.KEY).sortBy(*d.KEY)
        writer.option("path", at).mode("overwrite").saveAsTable("feedmark_" + at.rsplit("-", 1)[-1])
        return at

    def _commit(self, sequence: int, run_id: str, baseline: datetime, base: int, base_at: str, buckets: int, n: int) -> None:
        row = self.spark.createDataFrame([(sequence, run_id, STATE_FORMAT, baseline, base, base_at, buckets, n)], COMMITS)
        row.coalesce(1).write.options(**_DYNAMIC).mode("overwrite").partitionBy("sequence").parquet(f"{self.root}/commits")

    def _write_marks(self, watermarks: DataFrame, sequence: int) -> None:
        marks = watermarks.select("source", "watermark", F.lit(sequence).cast("long").alias("sequence")).coalesce(1)
        marks.write.options(**_DYNAMIC).mode("overwrite").partitionBy("sequence").parquet(f"{self.root}/watermarks")

    def begin(self, run_id: str, sequence: int, indicators: DataFrame, watermarks: DataFrame, baseline_instant: datetime) -> None:
        """A first base: ``indicators`` have one row for each key."""
        at = self._write_base(indicators, sequence)
        self._write_marks(watermarks, sequence)
        self._commit(sequence, run_id, baseline_instant, sequence, at, self.buckets, 0)

    def commit(self, run_id: str, sequence: int, changed: DataFrame, watermarks: DataFrame, baseline_instant: datetime) -> int:
        """Adds the run's changes (as ``changes`` gives them) to the version before it; returns how many runs
        have added theirs since the base."""
        prior = self._commits().where(F.col("sequence") < sequence).orderBy(F.desc("sequence")).first()
        rows = changed.where("differs").drop("differs").withColumn("sequence", F.lit(sequence).cast("long"))
        rows.write.options(**_DYNAMIC).mode("overwrite").partitionBy("sequence").parquet(f"{self.root}/changes")
        written = self.spark.read.schema(CHANGES).parquet(f"{self.root}/changes").where(F.col("sequence") == sequence)
        self._write_marks(watermarks, sequence)
        self._commit(sequence, run_id, baseline_instant, prior["base"], prior["base_at"], prior["buckets"], written.count())
        return self._commits().where((F.col("sequence") > prior["base"]) & (F.col("sequence") <= sequence)).count()

    def compact(self) -> bool:
        """Folds the changes since the base into a new base. Versions before it still name the old one."""
        version = self.load()
        if version.base is None:
            return False
        at = self._write_base(version.indicators, version.sequence)
        self._commit(version.sequence, version.run_id, version.baseline_instant, version.sequence, at, self.buckets, 0)
        return True

    def worth_compacting(self, share: float = 0.5) -> bool:
        """Whether the changes since the base have grown to ``share`` of its rows."""
        version = self.load()
        return version.base is not None and version.changes.count() > share * version.base.count()

    def expire(self, keep: int) -> list[str]:
        """Removes the folders that only versions before the last ``keep`` ones read; returns them."""
        commits = [tuple(r) for r in self._commits().select("sequence", "base", "base_at").orderBy("sequence").collect()]
        stay, go = commits[-keep:], commits[:-keep]
        oldest = min((base for _, base, _ in stay), default=0)
        bases = {at for _, _, at in stay}
        folders = sorted({at for _, _, at in go if at not in bases})
        for sequence, _, _ in go:
            folders += [f"{self.root}/commits/sequence={sequence}", f"{self.root}/watermarks/sequence={sequence}"]
            if sequence <= oldest:  # folded into every base that stays
                folders.append(f"{self.root}/changes/sequence={sequence}")
        for folder in folders:
            _remove(self.spark, folder)
            self.spark.sql(f"DROP TABLE IF EXISTS feedmark_{folder.rsplit('-', 1)[-1]}") if "/base-" in folder else None
        return folders


def _place(spark: SparkSession, folder: str):
    """Hadoop's file system, which knows the store, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    """Asked before reading: a read that fails is logged with its stack trace, though nothing is wrong."""
    store, path = _place(spark, folder)
    return store.exists(path)


def _remove(spark: SparkSession, folder: str) -> None:
    """A folder that is not there is no error."""
    store, path = _place(spark, folder)
    store.delete(path, True)
