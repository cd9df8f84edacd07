"""Readers and writers. Parquet is the working format; CSV and JSON are for exchange."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replyloom import schemas
from replyloom.operators.metrics import in_label_order


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; columns are matched by the header.

    A file with quoted line breaks cannot be split, so a large export should arrive as many files and
    be ingested once to Parquet.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        # Nothing between two commas is null; "" is the empty text, which the default reads as null, too.
        .option("nullValue", "\u0000")
        .csv(path)
    )


PARENT = "in_response_to_tweet_id"


def written_id(text: Column) -> Column:
    """An id as tools write it: digits, perhaps with a fraction of zeros, as float columns get. Null where it is none."""
    return F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("bigint")


def read_tweets_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw message table. The parent id may be written as ``119240.0``; it is read digit by digit, never as a float.

    A parent that is no id becomes null; ``unread_parents`` counts those.
    """
    return _raw_tweets(spark, path).withColumn(PARENT, written_id(F.col(PARENT)))


def unread_parents(spark: SparkSession, path: str | list[str]) -> int:
    """Rows whose parent id is neither blank nor an id of 64 bits."""
    written = F.col(PARENT)
    bad = (F.trim(written) != "") & written_id(written).isNull()
    return _raw_tweets(spark, path).select(F.count_if(bad)).first()[0]


def _raw_tweets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = [T.StructField(f.name, T.StringType()) if f.name == PARENT else f for f in schemas.TWEETS]
    return read_csv(spark, path, T.StructType(text))


def ingest_tweets(spark: SparkSession, csv_path: str | list[str], parquet_path: str) -> DataFrame:
    """CSV to Parquet, once; every later step reads the columns it needs from there."""
    read_tweets_csv(spark, csv_path).write.mode("overwrite").parquet(parquet_path)
    return spark.read.schema(schemas.TWEETS).parquet(parquet_path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a stage's table and return it read back, so later stages start from the files."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        return read_csv(df.sparkSession, path, df.schema) if not partition_by else df
    writer.format(fmt).save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def write_records(records: DataFrame, path: str) -> None:
    """Nested conversations as JSON lines, nulls kept as in the record layout."""
    records.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CONVERSATIONS).json(path)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row metrics or statistics document as JSON; any other number of rows is an error."""
    whole = df.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("*")).alias("document"))
    checked = F.when(F.col("n") == 1, F.col("document")).otherwise(
        F.raise_error(F.concat(F.lit("a document has one row, not "), F.col("n").cast("string"))).cast(df.schema)
    )
    one = whole.select(checked.alias("document")).select("document.*")
    one.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_confusion(matrix: DataFrame, labels: Sequence[str], path: str) -> None:
    """Confusion matrix as one labelled CSV, rows and columns in list order."""
    ordered = in_label_order(matrix, labels).select(F.col("true_label").alias("true \\ predicted"), *labels)
    ordered.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy JSON (intent to entry) as one row per intent."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", T.MapType(T.StringType(), schemas.TAXONOMY_ENTRY))
    return text.select(F.explode(entries).alias("intent", "entry")).select("intent", "entry.*")


def taxonomy_rows(spark: SparkSession, taxonomy: Mapping[str, Mapping]) -> DataFrame:
    """The same rows from a mapping in memory."""
    entries = F.from_json(F.lit(json.dumps(taxonomy)), T.MapType(T.StringType(), schemas.TAXONOMY_ENTRY))
    return spark.range(1).select(F.explode(entries).alias("intent", "entry")).select("intent", "entry.*")


def write_taxonomy(taxonomy: DataFrame, path: str) -> None:
    """One JSON object keyed by intent."""
    entry = F.struct(*[f.name for f in schemas.TAXONOMY_ENTRY])
    document = taxonomy.agg(F.map_from_entries(F.collect_list(F.struct("intent", entry))).alias("taxonomy"))
    document.select(F.to_json("taxonomy").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def confusable_pairs(taxonomy: DataFrame) -> DataFrame:
    """(intent, confusable_with) rows."""
    return taxonomy.select("intent", F.explode("confusable_intents").alias("confusable_with"))
