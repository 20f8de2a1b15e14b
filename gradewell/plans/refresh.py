"""Stored layers that follow arriving exam records without a full build.

Everything the layers say about an attempt depends on the attempts of its student alone, the catalogue, and two facts
about the whole data: which terms there are and which is the latest.  So raw records and layers are stored in parts of
the hash of the student.  An arriving batch is written beside the earlier ones, the parts of its students are built
again by the functions of the full build, and only these parts are overwritten; files of other parts stay.  What needs
the whole data (numbers of terms, inactivity) is added on reading, from the few terms each part keeps.

Parts of one batch are built in one go, so a first load in few large batches suits it as well as daily small ones.  For
large ones, ``buckets`` keep the tables of a build by student within their parts as well: attempts are moved to their student
once, and every later table of the build is made where they lie.

A batch has a name and may be handed in again, after a failure or by a stream that goes on: it replaces itself.  One
writer at a time; a reader should open tables between two batches, as a part is replaced file by file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import ExitStack
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gradewell import types as t
from gradewell.functions import rules
from gradewell.operators import cleaning, dimensions, enrichment, fact
from gradewell.operators.skew import ROWS_PER_TASK
from gradewell.plans import checks
from gradewell.plans.warehouse import LAYERS, SPREAD_BY_ALL_KEYS, Warehouse
from gradewell.session import setting
from gradewell.sources.readers import conform
from gradewell.sources.sinks import create_bucketed_parts

#: Parts of every table; a part should be what a handful of tasks can build.
PARTS = 64
#: Tables kept in buckets of the student within their parts, if there are buckets.
STUDENT_TABLES = (
    "student_profile", "stg_students_clean", "dim_students", "stg_students_with_credits", "dim_students_with_credits", "fact_kpi"
)
#: Settings of a build by student: sides that lie by student are not moved to lie by cell; scans keep the buckets and parts
#: that are not written stay.
BY_STUDENT = {
    SPREAD_BY_ALL_KEYS: "false",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
Of = Callable[[str], DataFrame]


def every_term(spark: SparkSession) -> DataFrame:
    """All terms there can be, numbered by their place on the term axis, which new records do not change."""
    terms = spark.range(t.FIRST_YEAR, t.LAST_YEAR + 1).select(
        F.col("id").alias("year"), F.explode(F.array(*[F.lit(s) for s in t.SEMESTERS])).alias("semester_type")
    )
    return terms.withColumn("time_id", rules.term_index(F.col("year"), F.col("semester_type")))


class GrowingTables:
    """Silver layer, dimensions of students and terms, and fact over a growing set of exam records."""

    def __init__(
        self, spark: SparkSession, module: Callable[[], DataFrame], folder: str, parts: int = PARTS,
        rows_per_task: int = ROWS_PER_TASK, once: bool = False, buckets: int | None = None,
    ):
        """``module`` gives the catalogue; a new one needs :meth:`rebuild`, another number of parts a new folder.

        ``buckets`` of the student in a part suit batches that touch most parts and should follow their size: attempts that a
        task can sort.  Each is a file of its part.  The number may change from session to session.

        With ``once`` the layers hold equal records one time, by the smallest id, whichever batches brought them and
        however far apart; the stored records keep all of them.
        """
        self.spark = spark
        self.module = module
        self.folder = folder
        self.parts = parts
        self.rows_per_task = rows_per_task
        self.once = once
        self.buckets = buckets
        self.schemas: dict[str, T.StructType] = {"students": t.STUDENTS}

    def _builds(self, placed: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> dict[str, Callable[[Of], DataFrame]]:
        """The stored tables in the order they need each other; each reads the parts that are built again, no others.

        ``placed`` moves attempts to where the tables of a build have their student."""
        modules = lambda: dimensions.dim_modul(self.module())
        return {
            "student_profile": lambda of: cleaning.student_profile(cleaning.clean_rows(of("students"))),
            "stg_students_clean": lambda of: cleaning.attach_profile(
                placed(cleaning.clean_rows(of("students"))), of("student_profile"), self.rows_per_task
            ),
            "clean_terms": lambda of: self._terms(of("stg_students_clean")),
            "dim_students": lambda of: dimensions.dim_students(of("stg_students_clean")),
            "stg_students_with_credits": lambda of: enrichment.stg_students_with_credits(
                of("stg_students_clean"), of("dim_students"), modules(),
                cleaning.hot_students(of("student_profile"), self.rows_per_task),
                cleaning.total_rows(of("student_profile")), self.rows_per_task,
            ),
            "terms": lambda of: self._terms(of("stg_students_with_credits")),
            "dim_students_with_credits": lambda of: dimensions.dim_students_with_credits(
                of("stg_students_with_credits"), of("dim_students")
            ),
            "fact_kpi": lambda of: fact.fact_kpi(of("stg_students_with_credits"), modules(), every_term(self.spark)),
        }

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _parted(self, rows: DataFrame, student: str = "student_id") -> DataFrame:
        return rows.withColumn("part", F.pmod(F.xxhash64(F.col(student)), F.lit(self.parts)).cast("int"))

    def _terms(self, rows: DataFrame) -> DataFrame:
        """Terms of each part, at most ``MAX_TERMS``."""
        return self._parted(rows).select("part", "year", "semester_type").distinct()

    def _schema(self, name: str) -> T.StructType:
        """Columns of a stored table, known from its plan: a table without rows has no file that tells them."""
        if name not in self.schemas:
            rows = self._builds()[name](lambda needed: self.spark.createDataFrame([], self._schema(needed)))
            self.schemas[name] = rows.drop("part").schema
        return self.schemas[name]

    def _stored(self, name: str) -> DataFrame:
        layout = T.StructType(list(self._schema(name))).add("part", T.IntegerType())
        return self.spark.read.schema(layout.add("batch", T.StringType()) if name == "students" else layout).parquet(self.path(name))

    def _records(self, stored: DataFrame) -> DataFrame:
        """Records the layers are built from, with the columns of the raw table."""
        records = checks.dedupe_raw(stored) if self.once else stored
        return records.select(*t.STUDENTS.names)

    def _build(self, parts: list[int]) -> None:
        """Build the given parts of every table from all records of their students, and put them in their place."""
        kept: dict[str, DataFrame] = {}

        def of(name: str) -> DataFrame:
            if name in kept:
                return kept[name]
            found = self._stored(name).filter(F.col("part").isin(parts))
            return self._records(found) if name == "students" else found.drop("part")

        by_student = bool(self.buckets and parts)
        with ExitStack() as until_built:
            for key, value in BY_STUDENT.items() if by_student else ():
                until_built.enter_context(setting(self.spark, key, value))
            for name, build in self._builds(lambda rows: self._placed(rows) if by_student else rows).items():
                if not by_student or name not in STUDENT_TABLES:
                    self._write(name, build(of))
                    continue
                table = f"gradewell_{name}_{uuid.uuid4().hex[:12]}"
                until_built.callback(self.spark.sql, f"DROP TABLE IF EXISTS {table}")  # the files stay
                kept[name] = self._write_by_student(name, table, build(of))
                if name == "student_profile" and not cleaning.hot_students(kept[name], self.rows_per_task).isEmpty():
                    by_student = False  # attempts of a student that has too many for a task are spread instead
                    kept.clear()
                    until_built.close()

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, "student_id")

    def _write_by_student(self, name: str, table: str, rows: DataFrame) -> DataFrame:
        """Overwrite the parts of a table, each in buckets; returns the rows just written, as a table that knows its buckets."""
        parted = self._parted(self._placed(rows))  # not moved if the rows lie so already
        create_bucketed_parts(self.spark, table, parted.schema, self.path(name), "part", self.buckets, "student_id")
        parted.write.insertInto(table, overwrite=True)
        return self.spark.table(table).drop("part")

    def _write(self, name: str, rows: DataFrame) -> None:
        (
            (rows if "part" in rows.columns else self._parted(rows))
            .hint("rebalance", F.col("part"))  # a part larger than the others is written by several tasks
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part")
            .parquet(self.path(name))
        )
    def append(self, students: DataFrame, batch: str) -> int:
        """Take in raw records with unique ids; returns how many parts were built again.

        ``batch`` names them.  A batch handed in again has to bring the same records.
        """
        arrived = f"{self.path('students')}/batch={quote(batch, safe='')}"
        records = self._parted(conform(students, t.STUDENTS), "studentID")
        records.hint("rebalance", F.col("part")).write.mode("overwrite").partitionBy("part").parquet(arrived)
        layout = T.StructType(list(t.STUDENTS)).add("part", T.IntegerType())
        parts = [r.part for r in self.spark.read.schema(layout).parquet(arrived).select("part").distinct().collect()]
        self._build(parts)
        return len(parts)

    def rebuild(self) -> None:
        """Build all parts, after a change of the catalogue."""
        self.schemas = {"students": t.STUDENTS}
        self._build(list(range(self.parts)))

    def stream(self, arriving: str, checkpoint: str, files_per_trigger: int = 100) -> StreamingQuery:
        """Take in everything that has arrived as Parquet in a folder, each file once, also after a failure."""
        raw = self.spark.readStream.schema(t.STUDENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(arriving)
        return (
            raw.writeStream.foreachBatch(lambda rows, number: self.append(rows, f"stream-{number}") and None)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def ref(self, name: str) -> DataFrame:
        """A table as the full build of all records has it."""
        if name == "students":
            return self._records(self._stored(name))
        if name == "dim_zeit":
            return dimensions.dim_zeit(self._stored("terms"))
        rows = self._stored(name).drop("part")
        if name == "dim_students":
            latest = dimensions.current_semester_index(self._stored("clean_terms")).scalar()
            start = dimensions.start_index(F.col("year_of_matriculation"), F.col("semester_of_matriculation"))
            passes = F.col("graduation_flag").cast("int")
            return rows.withColumn("inactivity_flag", dimensions.inactivity_flag(latest, start, passes))
        if name == "fact_kpi":
            terms = self.ref("dim_zeit").select("time_id", rules.term_index(F.col("year"), F.col("semester_type")).alias("place"))
            found = rows.withColumnRenamed("time_id", "place").join(F.broadcast(terms), "place", "left")
            return found.select(*rows.columns)
        return rows

    def warehouse(self, student_ml: Callable[[], DataFrame], folder: str | None = None) -> Warehouse:
        """All KPI tables over the present state; open a new one after the next batch."""
        raw = {"students": lambda: self.ref("students"), "module": self.module, "student_ml": student_ml}
        opened = Warehouse(self.spark, raw, folder, self.rows_per_task, scans=("students",))
        served = [*self._builds(), "dim_zeit"]
        opened.tables.update({name: self.ref(name) for name in served if name in LAYERS})
        return opened
