"""Readers of the raw tables.  Every file source gets an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewell import types as t


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema``; unknown columns are left out."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def with_attempt_id(students: DataFrame) -> DataFrame:
    """Number raw records that have no id.

    The numbers follow the partitions of this very scan; store the result (the
    warehouse does) before anything else reads it.
    """
    if "attempt_id" in students.columns:
        return students
    return students.withColumn("attempt_id", F.monotonically_increasing_id())


def read_students(spark: SparkSession, path: str, fmt: str = "parquet", has_id: bool = True, **options: str) -> DataFrame:
    """Raw exam attempts with a unique ``attempt_id``, numbered here unless the files have one."""
    schema = t.STUDENTS if has_id else T.StructType([f for f in t.STUDENTS.fields if f.name != "attempt_id"])
    reader = spark.read.format(fmt).options(**options)
    return conform(with_attempt_id(reader.schema(schema).load(path)), t.STUDENTS)


def read_module_seed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Curriculum master data from a CSV file with a header line."""
    return spark.read.csv(path, schema=t.MODULE, header=True, encoding="UTF-8", mode="FAILFAST", **options)


def read_module_seed_lines(spark: SparkSession, path: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """Curriculum rows that parse, and the lines that do not with the file they are in; together they are all lines.

    A line is rejected if a value is not of its type or if it has more or fewer values than there are columns.
    """
    header = ",".join(f.name.replace(" ", "") for f in t.MODULE.fields)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    lines = lines.filter((F.trim("value") != "") & (F.translate("value", '"\ufeff ', "") != header))
    schema = T.StructType([*t.MODULE.fields, T.StructField("line", T.StringType())])
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "line", **options}
    parsed = lines.select("file", F.from_csv("value", schema.toDDL(), how).alias("row"))
    accepted = parsed.filter("row.line IS NULL").select(*(F.col("row").getField(f.name).alias(f.name) for f in t.MODULE.fields))
    return accepted, parsed.filter("row.line IS NOT NULL").select("file", F.col("row.line").alias("line"))


def read_student_ml(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return conform(spark.read.format(fmt).options(**options).schema(t.STUDENT_ML).load(path), t.STUDENT_ML)


def fields_of_study(spark: SparkSession) -> DataFrame:
    """Code and name of the fields of study (four fixed rows)."""
    return spark.createDataFrame(sorted(t.FIELDS_OF_STUDY.items()), schema=t.FIELD_LOOKUP)


def with_field_name(df: DataFrame, fields: DataFrame, code: str = "field_of_study") -> DataFrame:
    """Resolve the field code; unknown codes get a NULL name.

    ``fields`` may be any table of codes: its size is left to Spark's own check for broadcasts.
    """
    names = fields.select(F.col("strID").alias(code), F.col("studienrichtung").alias("field_name"))
    return df.join(names, code, "left")


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A database table in parallel ranges; needs the driver jar on the class path."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions), **options)
        .load()
    )
