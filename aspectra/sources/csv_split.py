"""S7 for large files: a CSV whose quoted fields hold line ends, read by many tasks.

Spark splits a text file into blocks of lines but not a multi-line CSV. Here the lines are read in
blocks; a line opens a record where an even number of quote signs stands before it in the file. The
number before a block comes from the counts of the blocks before it (a row per block), the number
inside a block from a running sum over that block's lines. A record that runs over a block's end is
joined by the block and the line that open it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aspectra.sources.files import find_review_text_column


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): every record as text with the byte offset of the block and the line
    number in it where the record starts; blank lines between records are left out.

    Quotes inside a quoted field are doubled, and a field that holds quotes is quoted. A block holds
    ``spark.sql.files.maxPartitionBytes`` at most, and is what a task sorts."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("_id")
    )
    lines = lines.withColumn("_quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    in_block = Window.partitionBy("file", "block").orderBy("_id")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.select(
        "file", "block", "value", F.row_number().over(in_block).alias("line"), "_quotes",
        (F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2).alias("_before"),
    )
    # one row per block: quotes in it, and its last record start if the text before it holds an even or an odd number
    last = lambda odd: F.max(F.when(F.col("_before") == odd, F.struct("block", "line")))
    blocks = lines.groupBy("file", "block").agg(F.sum("_quotes").alias("n"), last(0).alias("_even"), last(1).alias("_odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("odd", F.coalesce(F.sum("n").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("_last", F.when(F.col("odd") == 0, F.col("_even")).otherwise(F.col("_odd")))
    blocks = blocks.select("file", "block", "odd", F.last("_last", ignorenulls=True).over(earlier).alias("open"))
    placed = lines.join(blocks, ["file", "block"])
    starts = F.when(F.col("_before") == F.col("odd"), F.struct("block", "line"))
    so_far = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("_start", F.coalesce(F.last(starts, ignorenulls=True).over(so_far), "open"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n")
    records = placed.groupBy("file", F.col("_start.block").alias("home"), F.col("_start.line").alias("first")).agg(text.alias("value"))
    records = records.select("file", F.col("home").alias("block"), F.col("first").alias("line"), F.regexp_replace("value", "\r$", "").alias("value"))
    return records.where("value <> ''")


def read_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """All columns, as strings, of CSV files with one header line each, in no particular order; all
    files have the columns of the first. Equal to the one-task reader with ``multiLine``."""
    columns = spark.read.option("header", True).option("escape", '"').csv(path).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    body = csv_records(spark, path).where("NOT (block = 0 AND line = 1)")
    row = F.from_csv("value", schema, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    return body.select(row.alias("row")).select("row.*")


def read_review_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """``read_review_csv`` for large files: the text column found by name, null texts dropped."""
    rows = read_csv_split(spark, path)
    col = find_review_text_column(rows.columns).replace("`", "``")
    return rows.select(F.col(f"`{col}`").alias("text")).dropna()
