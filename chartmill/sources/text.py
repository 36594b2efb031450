"""Reading CSV exports: every column a string, every row knowing its file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SOURCE_FILE = "_source_file"
CORRUPT = "_corrupt_record"
MALFORMED = "_malformed"


def file_name() -> Column:
    """Name of the file a row comes from; the reader reports it percent-encoded."""
    name = F.col("_metadata.file_name")
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), decoded).otherwise(name)


def read_csv_parts(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """One or many CSV files with a header as one frame of strings plus the file name.

    Quotes are doubled inside quoted text.  ``multi_line`` allows line breaks inside quotes but makes a
    file unsplittable.  A record with too few or too many fields keeps its text in ``_corrupt_record``.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line, "enforceSchema": False, "mode": "PERMISSIVE"}
    header = spark.read.csv(paths, inferSchema=False, **options).schema
    schema = T.StructType([*header.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return reader.csv(paths, **options).withColumn(SOURCE_FILE, file_name())


def line_stats(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file: lines without the header, those the CSV reader does not skip, and those that leave a quote open.

    The files are read as plain lines, independently of the CSV reader, which skips lines of blanks and
    control characters.  Where no line leaves a quote open, each filled line is a record.
    """
    filled = F.col("value").rlike(r"[^\x00-\x20]")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(paths).select(file_name().alias(SOURCE_FILE), filled.alias("_filled"), (quotes % 2 == 1).alias("_torn"))
    return lines.groupBy(SOURCE_FILE).agg(
        (F.count(F.lit(1)) - 1).alias("physical_lines"), (F.count_if("_filled") - 1).alias("filled_lines"),
        F.count_if("_torn").alias("torn_lines"),
    )


def flag_malformed(raw: DataFrame) -> DataFrame:
    """Replace the kept text of records with a wrong number of fields by a flag.

    The flag is stored with the rows, so that both are counted from what was written: the files are parsed
    once, and a task that had to be repeated counts nothing twice.
    """
    return raw.withColumn(MALFORMED, F.col(CORRUPT).isNotNull()).drop(CORRUPT)


def part_stats(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """Rows and bytes of each part, in the order of the number in the name."""
    files = spark.read.csv(paths, header=True, inferSchema=False, escape='"', multiLine=multi_line)
    per_file = files.select(
        file_name().alias(SOURCE_FILE), F.col("_metadata.file_size").alias("bytes")
    )
    return (
        per_file.groupBy(SOURCE_FILE)
        .agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"))
        .withColumn("part_number", part_number(F.col(SOURCE_FILE)))
        .orderBy(F.asc_nulls_first("part_number"), SOURCE_FILE)
    )


def part_number(name: Column) -> Column:
    """All digits of a part's name as one number: part 2 comes before part 10."""
    return F.regexp_replace(name, r"\D", "").try_cast("bigint")


def list_parts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files behind a path or pattern; only the listing is read, never the content."""
    listed = spark.read.format("binaryFile").load(paths)
    return listed.select(
        F.element_at(F.split("path", "/"), -1).alias("listed_name"),
        F.col("path").alias("listed_path"),
        F.col("length").alias("bytes"),
    ).withColumn("part_number", part_number(F.col("listed_name")))
