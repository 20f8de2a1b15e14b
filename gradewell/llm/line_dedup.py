"""Line deduplication over levelled sorted runs of line hashes.

The store (:class:`LineRuns`) grows batch by batch.  The line keys of a batch, as 128-bit hashes with the number of
its documents that have them, are bucketed by hash, sorted in each bucket and merge-anti-joined with the runs: keys
that no run holds become a new run, counts of known keys go to a run of additions.  So a key is in one run of keys.
When a level holds ``fanout`` runs they are merged into one run of the next level, so a key is rewritten a logarithmic
number of times and lookups meet few runs.  Buckets of runs and batches agree, so no run is moved by a join.

Two uses: :meth:`LineRuns.new_lines` keeps what no earlier batch had, and adds the batch; :func:`drop_frequent` takes
a corpus whose batches have all been added and drops the lines of keys found in many documents.

Results that are defined: a null or empty text is one empty line, and keys shorter than ``min_chars`` (empty ones
included) are never dropped; every row is a document of its own, repeated ones too; a text that loses all lines
becomes empty; an empty table gives an empty result.  Input columns named like a result column give way to it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.llm.common import field, lower_ascii, packed, scratch, stored, unpacked
from gradewell.operators.skew import hot_keys, join_split

#: Runs of one level before they are merged.
FANOUT = 4
#: Batches of a stored table.  Every batch reads the runs before it, so more batches read more; these reach two levels.
BATCHES = 6
#: A list of keys up to this many rows (16 bytes each) is sent to every task; a longer one is joined by sorting.
BROADCAST_ROWS = 500_000
TRIM = " \t\n\x0b\f\r"
KEY = ["h1", "h2"]
RUN = "h1 bigint, h2 bigint, n bigint"


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(TRIM)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def hashed(keys: DataFrame, key: str) -> DataFrame:
    return keys.withColumns({"h1": F.xxhash64(key), "h2": F.xxhash64(F.lit("line"), F.col(key))})


def document_counts(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """Line keys of a batch (h1, h2) with the number of its documents that have them."""
    keys = F.array_distinct(F.transform(lines_of(field(text)), line_key))
    each = packed(docs).select(F.explode(keys).alias("key")).filter(F.length("key") >= min_chars)
    return hashed(each, "key").groupBy(*KEY).agg(F.count("*").alias("n"))


class LineRuns:
    """Levelled sorted runs of line hashes with document counts."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None) -> None:
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"llm_lines_{uuid.uuid4().hex[:12]}"
        self.folder = scratch(spark, "line-runs")
        self.levels: list[list[str]] = []  # keys, each in one run
        self.additions: list[list[str]] = []  # later counts of these keys
        self.written = 0

    def _write(self, run: DataFrame) -> str:
        table = f"{self.name}_{self.written}"
        self.written += 1
        (
            run.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", f"{self.folder}/{table}")
            .saveAsTable(table)
        )
        return table

    def _merged(self, tables: list[str]) -> DataFrame:
        """The runs as one, counts of equal keys added up.

        Files are read as they are: a union of bucketed scans must not pass for one partitioned by its keys.
        """
        files = self.spark.read.schema(RUN).parquet(*(f"{self.folder}/{table}" for table in tables))
        return files.groupBy(*KEY).agg(F.sum("n").alias("n"))

    def key_runs(self) -> list[str]:
        return [table for level in self.levels for table in level]

    def runs(self) -> list[str]:
        return self.key_runs() + [table for level in self.additions for table in level]

    def _place(self, levels: list[list[str]], level: int, table: str) -> None:
        if level == len(levels):
            levels.append([])
        levels[level].append(table)
        if len(levels[level]) >= self.fanout:
            full, levels[level] = levels[level], []
            merged = self._write(self._merged(full))
            self._drop(full)
            self._place(levels, level + 1, merged)

    def unknown(self, lines: DataFrame, tables: list[str]) -> DataFrame:
        """Rows whose key is in none of the runs; rows in the buckets of the runs are not moved, nor are the runs."""
        for table in tables:
            lines = lines.join(self.spark.table(table).select(*KEY).hint("merge"), KEY, "left_anti")
        return lines

    def _drop(self, tables: list[str]) -> None:
        """Delete merged runs; their tables are external, so the files go with the folder."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for table in tables:
            self.spark.sql(f"DROP TABLE {table}")
            path = hadoop.Path(f"{self.folder}/{table}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def add(self, batch: DataFrame, text: str = "text", min_chars: int = 1) -> None:
        """Add a batch of documents: its new keys as a run, the counts of keys some run holds as a run of additions."""
        counted = self._write(document_counts(batch, text, min_chars))
        known = self.key_runs()
        if not known:
            self._place(self.levels, 0, counted)
            return
        fresh = self._write(self.unknown(self.spark.table(counted), known))
        repeated = self._write(self.unknown(self.spark.table(counted), [fresh]))
        self._drop([counted])
        self._place(self.levels, 0, fresh)
        self._place(self.additions, 0, repeated)

    def compact(self) -> str | None:
        """Merge all runs into one; its table, or None if nothing was added."""
        tables = self.runs()
        if len(tables) > 1:
            merged = self._write(self._merged(tables))
            self._drop(tables)
            self.levels, self.additions = [[], [merged]], []
        return next(iter(self.runs()), None)

    def close(self) -> None:
        """Delete all runs, their names in the session catalog included."""
        self._drop(self.runs())
        self.levels, self.additions = [], []

    def new_lines(self, batch: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 1) -> DataFrame:
        """Lines of a batch (key, place, line) whose key is in no run yet; then the batch is added.

        The lines are sorted by hash once and merged with every run, none of which is moved.  Lines of one batch that
        share a key all stay.
        """
        placed = packed(batch).select(field(key).alias(key), F.posexplode(lines_of(field(text))).alias("place", "line"))
        lines = hashed(placed.withColumn("_key", line_key(F.col("line"))), "_key")
        lines = self.unknown(lines.repartition(self.buckets, *KEY), self.key_runs())
        fresh = stored(lines.drop("_key", *KEY), "new-lines")
        self.add(batch, text, min_chars)
        return fresh


def scan_batches(docs: DataFrame, batches: int = BATCHES) -> list[DataFrame]:
    """The scan of a stored table as batches of whole files, dealt by the hash of their names.

    Spark leaves out the files of other batches when it plans the scan; no file name comes here.  A frame that is no
    scan of files is one batch.
    """
    try:
        part = F.pmod(F.xxhash64(docs.metadataColumn("_metadata")["file_path"]), F.lit(batches))
        return [docs.filter(part == k) for k in range(batches)]
    except AnalysisException:
        return [docs]


def file_batches(spark: SparkSession, path: str, batches: int = BATCHES) -> list[DataFrame]:
    """A stored Parquet table in batches, see :func:`scan_batches`."""
    return scan_batches(spark.read.parquet(path), batches)


def frequent_keys(batches: list[DataFrame], min_docs: int, min_chars: int = 1, text: str = "text") -> DataFrame:
    """Keys (h1, h2) found in at least ``min_docs`` documents of all batches, with their counts n, stored."""
    spark = batches[0].sparkSession
    runs = LineRuns(spark)
    for batch in batches:
        runs.add(batch, text, min_chars)
    frequent = stored(spark.table(runs.compact()).filter(F.col("n") >= min_docs), "frequent-lines")
    runs.close()
    return frequent


def _without_frequent(docs: DataFrame, frequent: DataFrame, key: str, text: str) -> DataFrame:
    """The packed rows with _text, n_lines (before) and n_dropped.

    Lines meet the frequent keys as hashes; only the places to drop travel back to the documents, which they reach
    by the document's key and the hash of its text.
    """
    ident = ["_doc", "_t1", "_t2"]
    whole = packed(docs).withColumns(
        {"_doc": field(key), "_t1": F.xxhash64(field(text)), "_t2": F.xxhash64(F.lit("text"), field(text))}
    )
    lines = whole.select(*ident, F.posexplode(lines_of(field(text))).alias("place", "line"))
    lines = hashed(lines.withColumn("line", line_key(F.col("line"))), "line").drop("line")
    n_frequent, total = frequent.agg(F.count("*"), F.sum("n")).first()
    if n_frequent <= BROADCAST_ROWS:
        found = lines.join(F.broadcast(frequent.select(*KEY)), KEY)
    else:
        hot = hot_keys(frequent.withColumnRenamed("n", "n_rows"), KEY, F.lit(total))
        found = join_split(lines, frequent.select(*KEY), KEY, hot, "_doc, _t1")
    gone = (
        found.groupBy(*ident)
        .agg(F.collect_set("place").alias("gone"))
        .select(*(F.col(c).alias(f"{c}_g") for c in ident), "gone")
    )
    met = whole.join(gone, [F.col(c).eqNullSafe(F.col(f"{c}_g")) for c in ident], "left")
    split = met.withColumn("lines", lines_of(field(text)))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.array_join(F.transform(places, lambda p: F.get("lines", p)), "\n")
    return split.withColumns(
        {
            "_text": F.when(F.col("gone").isNull(), field(text)).otherwise(kept),
            "n_lines": F.size("lines").cast("bigint"),
            "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("bigint"),
        }
    )


def drop_frequent(docs: DataFrame, frequent: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input columns, the text without lines of a frequent key, n_lines (before) and n_dropped."""
    found = _without_frequent(docs, frequent, key, text).withColumnRenamed("_text", text)
    return unpacked(found, text, "n_lines", "n_dropped")


def strip(docs: DataFrame, frequent: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Exactly the input columns, the text without lines of a frequent key."""
    found = _without_frequent(docs, frequent, key, text)
    return found.select(*(F.col("_text").alias(c) if c == text else field(c).alias(c) for c in docs.columns))


def dedup_lines(
    docs: DataFrame, min_docs: int, min_chars: int = 1, batches: list[DataFrame] | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Drop every line whose key is found in at least ``min_docs`` documents.

    ``batches`` are the documents in parts, in any split of whole rows; by default one batch.
    """
    return drop_frequent(docs, frequent_keys(batches or [docs], min_docs, min_chars, text), key, text)
