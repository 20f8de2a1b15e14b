"""Exam data derived from order tables, for environments without exam records.

``lineitem`` rows become exam attempts, customers become students and part
brands become modules.  The rules below are fixed values of the fixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradewell import types as t

LINE_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
SOURCE_TABLES = ("lineitem", "orders", "part", "nation", "customer")


def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Lines of an order that the id scheme has room for.
MOST_LINES = 99


def _line_number(number: Column) -> Column:
    """The number itself; an order with more lines than ids stops the job."""
    too_many = F.raise_error(F.lit(f"an order has more than {MOST_LINES} lines")).cast("int")
    return F.when(number <= MOST_LINES, number).otherwise(too_many)


def _moved(rows: DataFrame, partitions: int | None, key: str) -> DataFrame:
    """Rows by a key, in a number of partitions that follows the input if one is given; else moving them is left to Spark."""
    return rows.repartition(partitions, key) if partitions else rows


def derive_students(lineitem: DataFrame, orders: DataFrame, part: DataFrame, partitions: int | None = None) -> DataFrame:
    """Exam attempts.  The id scheme leaves room for 99 lines per order, which
    bounds the numbering window; lines and orders share one exchange.  Grade and
    remark are made there, so that a line takes only what it needs to its part."""
    c = F.col
    in_order = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    numbered = _moved(lineitem.select("l_orderkey", *LINE_ORDER), partitions, "l_orderkey").select(
        "l_orderkey",
        "l_partkey",
        (F.col("l_orderkey") * 100 + _line_number(F.row_number().over(in_order))).alias("attempt_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.floor(F.col("l_discount") * 100 + 0.5).cast("int").alias("disc"),
        F.floor(F.col("l_tax") * 100 + 0.5).cast("int").alias("tax"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
    )
    digit = (c("qty") * 7 + c("disc")) % 10
    note = (
        F.when(c("qty") == 50, "10")
        .when(c("qty") == 49, "02.01.1900")
        .when(c("qty") == 48, "angemeldet")
        .when(c("qty") == 47, "bestanden")
        .when(c("qty") == 46, "0,0 mE")
        .when(c("qty") == 45, "1,3\r\n")
        .when(c("qty") == 44, F.lit(None))
        .when((c("rf") == "R") & (c("ls") == "F"), "5,0")
        .when((c("rf") == "R") & (c("tax") == 0), "5")
        .otherwise(F.concat((1 + c("qty") % 3).cast("string"), F.lit(","), digit.cast("string")))
    )
    remark = (
        F.when((c("disc") == 0) & (c("tax") < 2), "krank")
        .when((c("disc") == 0) & (c("tax") == 2), "nicht zugelassen")
        .when((c("disc") == 10) & (c("tax") < 2), "unentschuldigt gefehlt")
        .when((c("disc") == 10) & (c("tax") < 4), "abgemeldet")
        .when(c("disc") == 10, "anerkannt")
        .when((c("disc") == 5) & (c("tax") == 0), "mit Erfolg")
        .when((c("disc") == 5) & (c("tax") == 1), "kein Antrag")
    )
    lines = numbered.select("l_orderkey", "l_partkey", "attempt_id", note.alias("Note"), remark.alias("Vermerk"))
    dated = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("student_id"),
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
    )
    parts = part.select(
        F.col("p_partkey").alias("l_partkey"), "p_size", F.substring("p_brand", 7, 100).cast("int").alias("brand")
    )
    in_orders = lines.join(_moved(dated, partitions, "l_orderkey"), "l_orderkey").drop("l_orderkey")
    rows = _moved(in_orders, partitions, "l_partkey").join(_moved(parts, partitions, "l_partkey"), "l_partkey")
    name = F.concat(F.lit("Modul "), c("brand").cast("string"))
    modul = (
        F.when(c("p_size") == 50, "Wahlpflichtmodul (Ausnahme)")
        .when(c("p_size") == 49, "Zusatzmodul")
        .when(c("p_size") == 48, F.concat(name, F.lit(" PVL")))
        .when(c("p_size") == 47, F.concat(name, F.lit(" Beleg")))
        .when(c("p_size") == 46, "Forschungs-/Entwicklungsprojekt")
        .when(c("p_size") != 45, name)
    )
    number = (
        F.when(c("p_size").isin(50, 49, 46, 43), F.lit(None))
        .when(c("p_size") == 44, "Wahlpflichtmodul")
        .when(c("brand") == 11, t.THESIS)
        .otherwise(F.concat(F.lit("I1"), c("brand").cast("string")))
    )
    year = (
        F.when(c("attempt_id") % 97 == 0, 29)
        .when(c("attempt_id") % 89 == 0, F.lit(None))
        .otherwise((c("y") - 1995) % 3 + 11 + (c("student_id") % 9).cast("int"))
    )
    semester = F.when(c("m").between(3, 8), "SoSe").when(c("attempt_id") % 11 == 0, "WiSE").otherwise("WiSe")
    field = 71 + F.floor(c("student_id") / 9.0) % 3
    return rows.select(
        "attempt_id",
        c("student_id").alias("studentID"),
        modul.alias("Modul"),
        "Note",
        number.alias("Modulnummer"),
        year.cast("bigint").alias("Jahr"),
        semester.alias("Semester"),
        "Vermerk",
        field.cast("bigint").alias("Studienrichtung"),
    )


def derive_module(part: DataFrame, nation: DataFrame) -> DataFrame:
    """The curriculum: one row per module, regulations year, semester and field."""
    brands = part.select(F.substring("p_brand", 7, 100).cast("int").alias("n")).distinct()
    fields = nation.filter("n_nationkey < 4").select((F.col("n_nationkey") + 71).alias("sr"))
    c = F.col
    grid = (
        brands.withColumn("ab", F.explode(F.array(*[F.lit(y) for y in t.REGULATIONS])))
        .withColumn("sem", F.explode(F.array(*[F.lit(s) for s in t.SEMESTERS])))
        .withColumn("sr", F.explode(F.sequence(F.lit(71), F.lit(74))))
        .join(F.broadcast(fields), "sr", "left_semi")
        .filter(((c("n") + c("ab") + c("sr")) % 7 != 0) & ~((c("n") % 8 == 5) & (c("sem") == "SoSe")))
    )
    direction = F.when(c("sr") == 71, t.FIELDS_OF_STUDY[71])
    for code in (72, 73, 74):
        direction = direction.when(c("sr") == code, t.FIELDS_OF_STUDY[code])
    odd = c("n") % 2
    return grid.select(
        c("ab").alias("AbJahr"),
        c("sem").alias("AbSemester"),
        F.when(c("n") == 11, t.THESIS).otherwise(F.concat(F.lit("I1"), c("n").cast("string"))).alias("Modulnummer"),
        F.concat(F.lit("Modul "), c("n").cast("string")).alias("Modul"),
        F.concat(F.lit("M"), c("n").cast("string")).alias("Acronym"),
        F.when(c("n") % 4 == 0, "Wahlpflichtmodul").otherwise("Pflichtmodul").alias("Art"),
        F.when(c("n") == 11, 30).otherwise(5 * (1 + odd)).alias("Credits"),
        F.when(c("n") == 11, 4).otherwise(1 + c("n") % 3).alias("Semester"),
        (2 + 2 * odd).alias("Wochenstunden"),
        c("sr").alias("Studienrichtung"),
        direction.alias("Richtung"),
        F.concat(F.lit("Prof. "), (c("n") % 10).cast("string")).alias("Professor"),
        (c("n") % 3 == 0).alias("PVL"),
        (odd == 0).alias("APL"),
        (odd == 1).alias("schriftliche Prüfung"),
        (c("n") % 5 == 0).alias("mündliche Prüfung"),
    )


def derive_student_ml(customer: DataFrame) -> DataFrame:
    """Model scores for nine students in ten."""
    key = F.col("c_custkey")

    def text(a: int, b: int):
        return F.concat(F.lit("feature_"), (key % a).cast("string"), F.lit(":"), (key % b).cast("string"))

    return customer.filter(key % 10 != 0).select(
        key.alias("student_id"),
        (key % 2 == 0).alias("predicted_has_passed_degree"),
        ((50 + key % 50).cast("double") / 100).alias("has_passed_degree_confidence"),
        (key % 3 == 0).alias("predicted_inactivity"),
        ((50 + key % 41).cast("double") / 100).alias("inactivity_confidence"),
        text(7, 5).alias("lime_top5_inact"),
        text(6, 4).alias("lime_top5_pass"),
    )


def students(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    return derive_students(*[read_source(spark, folder, n) for n in ("lineitem", "orders", "part")], partitions)


def module(spark: SparkSession, folder: str) -> DataFrame:
    return derive_module(read_source(spark, folder, "part"), read_source(spark, folder, "nation"))


def student_ml(spark: SparkSession, folder: str) -> DataFrame:
    return derive_student_ml(read_source(spark, folder, "customer"))
