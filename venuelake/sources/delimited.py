"""Delimited text files read line by line, so that one large file is split among tasks.

Every file has its own header. A pass over the lines finds it (a dictionary of one row per file), and the rows meet their file's
column positions in a join on the file, so files with other column orders go through one plan. A record is one
line: a line break inside quotes ends it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """value, file and at of every line below ``paths``. ``at`` orders the lines of a file: the block of the file a task reads, then the line in it."""
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return raw.select(F.ltrim(F.rtrim(F.col("value"), F.lit("\r")), F.lit("\ufeff")).alias("value"), F.col("_metadata.file_path").alias("file"), place.alias("at"))


def headers(lines: DataFrame, is_head: Column | None = None) -> DataFrame:
    """file, header, head_at and utf8 of each file with a line that is not blank.

    The header is the first line for which ``is_head`` holds, else the first line. ``utf8`` tells whether all lines of the file are valid UTF-8.
    One pass: each block of a file keeps its candidate and the set of its lines' validity, so no line is sorted, shuffled or read
    again. (Beside a set, Spark aggregates in a hash table of objects; text alone would be sorted.)
    """
    own = F.lit(True) if is_head is None else is_head
    block, line = F.col("at.block"), F.col("at.line")
    owned = F.when(own, line)
    of_block = lines.where(F.trim("value") != "").groupBy("file", block.alias("block")).agg(
        F.min(owned).alias("own"), F.min_by("value", owned).alias("own_text"), F.min(line).alias("any"), F.min_by("value", line).alias("any_text"),
        F.collect_set(F.is_valid_utf8("value")).alias("valid"))
    place = lambda of: F.struct(F.col("block"), F.col(of).alias("line"))
    first = lambda of: F.min(F.when(F.col(of).isNotNull(), F.struct(place(of).alias("at"), F.col(f"{of}_text").alias("text"))))
    found = of_block.groupBy("file").agg(F.coalesce(first("own"), first("any")).alias("head"), F.bool_and(~F.array_contains("valid", False)).alias("utf8"))
    return found.select("file", F.col("head.text").alias("header"), F.col("head.at").alias("head_at"), "utf8")


def rows_below(lines: DataFrame, heads: DataFrame, preamble: bool = False) -> DataFrame:
    """The lines of each file that are neither blank nor its header, with the columns of ``heads``. Files that are not UTF-8 are Latin-1.

    ``heads`` should be a stored table: its size is then known, and lines meet it where they are read. Places are comparable within one
    frame of lines only. So with a ``preamble`` ``lines`` must be stored too and ``heads`` come from them, and the
    lines up to the header go; else lines equal to the header go, wherever they stand.
    """
    below = F.col("at") > F.col("head_at") if preamble else F.col("value") != F.col("header")
    body = lines.join(heads, "file").where(below & (F.trim("value") != ""))
    return body.withColumn("value", F.when(F.col("utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))).drop("at", "head_at", "utf8", "header")


def csv_cells(line: Column) -> Column:
    """The cells of a CSV line of any width: quotes taken off, doubled quotes undone."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',(?:\s*"[^"]*(?:""[^"]*)*"[^,]*|[^,]*)'), F.lit(0))

    def plain(cell: Column) -> Column:
        body = F.substring(cell, F.lit(2), F.length(cell))
        quoted = F.regexp_extract(body, r'^\s*"([^"]*(?:""[^"]*)*)"', 1)
        return F.when(F.startswith(F.ltrim(body), F.lit('"')), F.replace(quoted, F.lit('""'), F.lit('"'))).otherwise(body)

    return F.transform(cells, plain)


def position(cells: Column, names: list[str]) -> Column:
    """The place (from 1) of the first of ``names`` that the header has; NULL if it has none."""
    return F.coalesce(*[F.nullif(F.array_position(cells, n), F.lit(0)) for n in names]).cast("int")
