"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewell.session import shared_folder

#: Words of the quality rules, the fingerprints and the mix: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The ASCII white space itself.
BLANK = r"[\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one all executors share."""
    return f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read again: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> DataFrame:
    """Every input column inside one struct ``row``, out of the way of an operator's own columns."""
    return df.select(F.struct("*").alias("row"))


def field(name: str) -> Column:
    """A column of the packed input row."""
    return F.col("row").getField(name)


def unpacked(df: DataFrame, *names: str) -> DataFrame:
    """The input columns again, followed by ``names``; an input column of such a name, in any case, gives way."""
    given = df.schema["row"].dataType.names
    taken = {n.lower() for n in names}
    return df.select(
        *(F.col("row").getField(c).alias(c) for c in given if c.lower() not in taken), *(F.col(n) for n in names)
    )


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.length(text)  # all ASCII: the faster function does the same
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, letters, letters.lower()))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def content_key(text: Column) -> list[Column]:
    """128 bits that stand for a text; rows with equal texts share them."""
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit("second"), text).alias("_h2")]
