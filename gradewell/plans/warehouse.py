"""Named tables and where they are kept.

Raw tables, the silver and star layers and the two KPI tables others build on
are stored once as Parquet in the shared folder and read from there by
everything above, so a KPI table reads the fact instead of repeating the
cleaning, and losing executors costs no more than the running stage.  The other
KPI tables are plain DataFrames; ``store`` writes them.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Collection, Mapping
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from gradewell.operators import cleaning, dimensions, enrichment, fact, quality, summary
from gradewell.operators.skew import ROWS_PER_TASK
from gradewell.plans import checks, cohorts, fields, modules, programme, progress, students
from gradewell.session import setting, shared_folder
from gradewell.sources import fixtures
from gradewell.sources.sinks import write_bucketed, write_table

Build = Callable[["Warehouse"], DataFrame]


def _stg_students_clean(w: Warehouse) -> DataFrame:
    rows, profile = cleaning.clean_rows(w.ref("students")), w.ref("student_profile")
    if w.by_student("stg_students_clean"):
        rows = rows.repartition(w.buckets, "student_id")
    return cleaning.attach_profile(rows, profile, w.rows_per_task)


def _enriched(w: Warehouse) -> DataFrame:
    profile = w.ref("student_profile")
    rows = enrichment.stg_students_with_credits(
        w.ref("stg_students_clean"),
        w.ref("dim_students"),
        w.ref("dim_modul"),
        cleaning.hot_students(profile, w.rows_per_task),
        cleaning.total_rows(profile),
        w.rows_per_task,
    )
    return rows.repartition(w.buckets, "student_id") if w.by_student("stg_students_with_credits") else rows


def _fact(w: Warehouse) -> DataFrame:
    rows = fact.fact_kpi(w.ref("stg_students_with_credits"), w.ref("dim_modul"), w.ref("dim_zeit"))
    return rows.repartition(w.buckets, "student_id") if w.by_student("fact_kpi") else rows


LAYERS: dict[str, Build] = {
    "student_profile": lambda w: cleaning.student_profile(cleaning.clean_rows(w.ref("students"))).repartition(
        w.buckets, "student_id"
    ),
    "stg_students_clean": _stg_students_clean,
    "dim_students": lambda w: dimensions.dim_students(w.ref("stg_students_clean")).repartition(w.buckets, "student_id"),
    "dim_modul": lambda w: dimensions.dim_modul(w.ref("module")),
    "stg_students_with_credits": _enriched,
    "dim_zeit": lambda w: dimensions.dim_zeit(w.ref("stg_students_with_credits")),
    "dim_students_with_credits": lambda w: dimensions.dim_students_with_credits(
        w.ref("stg_students_with_credits"), w.ref("dim_students")
    ),
    "fact_kpi": _fact,
    "study_progress_rows": lambda w: progress.study_progress_rows(
        w.ref("fact_kpi"), w.ref("dim_students"), w.by_student("fact_kpi")
    ),
    "student_summary": lambda w: summary.student_summary(w.ref("fact_kpi"), w.ref("dim_modul"), w.buckets),
    "student_kpi": lambda w: students.student_kpi(w.ref("student_summary")),
}

KPIS: dict[str, Build] = {
    "active_students_kpi": lambda w: progress.active_students_kpi(w.ref("stg_students_with_credits"), w.ref("dim_students")),
    "module_mark_kpi": lambda w: modules.module_mark_kpi(w.ref("fact_kpi")),
    "module_status_kpi": lambda w: modules.module_status_kpi(w.ref("fact_kpi")),
    "module_boxplot_kpi": lambda w: modules.module_boxplot_kpi(w.ref("fact_kpi")),
    "modul_kpi": lambda w: modules.modul_kpi(w.ref("fact_kpi"), w.ref("stg_students_with_credits"), w.ref("dim_modul")),
    "grade_development_kpi": lambda w: progress.grade_development_kpi(w.ref("fact_kpi"), w.ref("dim_zeit")),
    "study_progress_kpi": lambda w: progress.study_progress_kpi(w.ref("study_progress_rows")),
    "studienrichtung_mark_kpi": lambda w: students.studienrichtung_mark_kpi(w.ref("fact_kpi")),
    "student_kpi_ml": lambda w: students.student_kpi_ml(w.ref("student_kpi"), w.ref("student_ml")),
    "cohort_kpi": lambda w: cohorts.cohort_kpi(w.ref("student_summary"), w.ref("dim_students")),
    "studiengang_kpi": lambda w: programme.studiengang_kpi(
        w.ref("student_summary"), w.ref("dim_students"), w.ref("study_progress_rows")
    ),
    "studiengangsvergleich_kpi": lambda w: fields.studiengangsvergleich_kpi(
        w.ref("fact_kpi"), w.ref("dim_zeit"), w.ref("dim_students")
    ),
}

# Stored intermediates that are no table of their own.
INTERNAL = ("student_profile", "study_progress_rows", "student_summary")
#: Tables kept in buckets of a column, sorted by it, for joins and groups that do not move them.
BUCKETED = dict.fromkeys(
    ("student_profile", "stg_students_clean", "dim_students", "stg_students_with_credits", "fact_kpi", "student_summary"), "student_id"
)
#: Those with a row for every attempt.
ATTEMPTS = ("stg_students_clean", "stg_students_with_credits", "fact_kpi")
#: Bytes of Parquet input for one bucket: attempts that a task can sort in memory.
BUCKET_BYTES = 4 << 20
#: Tables whose attempts meet cells of their student: sides that lie by student need not be moved to lie by cell.
MEETING_CELLS = ("stg_students_with_credits",)
SPREAD_BY_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
MODELS: dict[str, Build] = {**LAYERS, **KPIS}


class Warehouse:
    """Tables by name over a set of raw tables ``students``, ``module`` and ``student_ml``."""

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, Callable[[], DataFrame]], folder: str | None = None,
        rows_per_task: int = ROWS_PER_TASK, scans: Collection[str] = (), buckets: int | None = None,
    ):
        """``scans`` names raw tables that are served as they are read: files that already hold what their reader
        returns, ids included, need no copy.  Others (numbered on reading, or derived) are stored first.
        ``buckets`` of the tables kept by student should follow the input; it is the number of shuffle partitions unless given."""
        self.spark = spark
        self.raw = raw
        self.scans = frozenset(scans)
        self.folder = folder or f"{shared_folder(spark)}/gradewell-{uuid.uuid4().hex}"
        self.rows_per_task = rows_per_task
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.catalogued: list[str] = []
        self.tables: dict[str, DataFrame] = {}
        self.counts: dict[str, quality.Counts] = {}
        self.none_hot: bool | None = None
        self.lock = threading.RLock()

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def ref(self, name: str) -> DataFrame:
        """A table by name; raw tables and layers are stored on first use."""
        with self.lock:
            if name not in self.tables:
                if name in self.scans:
                    self.tables[name] = self.raw[name]()
                elif name in self.raw or name in LAYERS:
                    self.tables[name] = self._stored(name) or self._write(name)
                else:
                    self.tables[name] = KPIS[name](self)
            return self.tables[name]

    def by_student(self, name: str) -> bool:
        """Whether a table is kept in buckets of the student; attempts are not if one student has too many of them for a task."""
        if name not in ATTEMPTS:
            return name in BUCKETED
        if self.none_hot is None:
            self.none_hot = cleaning.hot_students(self.ref("student_profile"), self.rows_per_task).isEmpty()
        return self.none_hot

    def _kept(self, name: str, rows: DataFrame) -> DataFrame:
        if not self.by_student(name):
            return write_table(rows, self.path(name))
        self.catalogued.append(f"gradewell_{name}_{uuid.uuid4().hex[:12]}")
        with setting(self.spark, SPREAD_BY_ALL_KEYS, "false") if name in MEETING_CELLS else nullcontext():
            return write_bucketed(rows, self.catalogued[-1], self.path(name), self.buckets, BUCKETED[name])

    def _write(self, name: str) -> DataFrame:
        """Build and store a table; the violations of its declared row checks are counted on the way and stored beside it."""
        build = self.raw[name]() if name in self.raw else MODELS[name](self)
        declared = checks.DECLARED.get(name)
        if declared is None or name in self.raw:
            return self._kept(name, build)
        build, found = quality.observed(build, declared)
        table = self._kept(name, build)
        self._keep(name, found())
        return table

    def _keep(self, name: str, found: quality.Counts) -> None:
        self.counts[name] = found
        rows = [(column, check, n) for (column, check), n in found.items()]
        kept = self.spark.createDataFrame(rows, "column_name string, check_name string, violations bigint")
        kept.coalesce(1).write.mode("overwrite").parquet(self.path(f"checks/{name}"))

    def violations(self, name: str) -> quality.Counts:
        """Violations of a table's declared row checks: known since it was written, here or by an earlier session."""
        with self.lock:
            table = self.store(name) if name in KPIS and name not in self.counts else self.ref(name)
            if name not in self.counts:
                kept = self._stored(f"checks/{name}")
                if kept is None:
                    self._keep(name, quality.counted(table, checks.DECLARED[name]))
                else:
                    self.counts[name] = {(r.column_name, r.check_name): r.violations for r in kept.collect()}
            return self.counts[name]

    def report(self) -> DataFrame:
        """Every declared check with its violations; only checks on keys read tables."""
        for name in checks.DECLARED:
            self.violations(name)
        return quality.report(self.ref, checks.DECLARED, self.violations)

    def _stored(self, name: str) -> DataFrame | None:
        """A table that an earlier session has written completely into this folder."""
        done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/_SUCCESS")
        exists = done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(done)
        return self.spark.read.parquet(self.path(name)) if exists else None

    def store(self, name: str) -> DataFrame:
        """Write a KPI table as well, and serve it from there."""
        with self.lock:
            if name in KPIS:
                self.tables[name] = self._write(name)
            return self.ref(name)

    def build_all(self) -> None:
        for name in MODELS:
            self.store(name)

    def drop(self) -> None:
        """Delete the stored tables; the next reference builds them again."""
        with self.lock:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            for table in self.catalogued:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.catalogued.clear()
            self.tables.clear()
            self.counts.clear()
            self.none_hot = None

    def views(self, prefix: str = "") -> None:
        """Register every model as a session view for SQL users."""
        for name in MODELS:
            self.ref(name).createOrReplaceTempView(prefix + name)


def content_summary(spark: SparkSession, paths: list[str]) -> tuple:
    """Bytes, number of files at any depth and time of each of ``paths``, to notice changed input.

    One call into the JVM per table: files are never listed on the Python side, however many there are.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    found = []
    for path in paths:
        p = hadoop.Path(path)
        system = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        summary = system.getContentSummary(p)
        found.append((path, summary.getLength(), summary.getFileCount(), system.getFileStatus(p).getModificationTime()))
    return tuple(found)


#: The open warehouse of every application and input folder, with the state of the input it was built from.
_open: dict[tuple, tuple[tuple, Warehouse]] = {}
_open_lock = threading.Lock()


def fixture_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over the derived exam data of ``folder``, one per session and input; one of changed input goes."""
    inputs = content_summary(spark, [f"{folder}/{n}.parquet" for n in fixtures.SOURCE_TABLES])
    key = (spark.sparkContext.applicationId, shared_folder(spark), folder)
    with _open_lock:
        state, warehouse = _open.get(key, (None, None))
        if state != inputs:
            if warehouse is not None:
                warehouse.drop()
            buckets = max(spark.sparkContext.defaultParallelism, -(-sum(size for _, size, _, _ in inputs) // BUCKET_BYTES))
            warehouse = Warehouse(
                spark,
                {
                    "students": lambda: fixtures.students(spark, folder, buckets),
                    "module": lambda: fixtures.module(spark, folder),
                    "student_ml": lambda: fixtures.student_ml(spark, folder),
                },
                buckets=buckets,
            )
            _open[key] = inputs, warehouse
        return warehouse
