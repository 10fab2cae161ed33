"""Readers for the raw statistics files. Every cell is read as text and parsed by the tidy plans."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SOURCE_ORDER

# Bits of a position: row inside its task, byte offset of the block in its file, and file.
ROW_BITS = 33
BLOCK_BITS = 46
FILE_BITS = 20
POSITION = "decimal(38,0)"


def _shift(bits: int) -> Column:
    return F.lit(str(1 << bits)).cast(POSITION)


def _files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files under the path(s) in name order; only their names are read."""
    listed = spark.read.format("binaryFile").load(path).select("_metadata.file_path")
    return sorted(row[0] for row in listed.collect())


def with_source_order(df: DataFrame, files: list[str]) -> DataFrame:
    """Add the position of each row in its files, as one number.

    File and block come from the scan's metadata; inside a block the row id grows in reading order,
    so the position sorts like the source even when a file is split over many tasks. One number,
    however many files there are, keeps the aggregates that order by it hash aggregates.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    own = [F.col(f"`{c}`") for c in df.columns]
    placed = df.select(
        *own,
        (F.col("_metadata.file_block_start").cast(POSITION) * _shift(ROW_BITS) + row.cast(POSITION)).alias("_row"),
        F.col("_metadata.file_path").alias("_file"),
    )
    # As long as the list of files, which the driver holds anyway to plan the scan.
    numbers = F.broadcast(df.sparkSession.createDataFrame(list(enumerate(files)), "_number long, _file string"))
    position = F.col("_number").cast(POSITION) * _shift(ROW_BITS + BLOCK_BITS) + F.col("_row")
    return placed.join(numbers, "_file").select(*own, position.cast(POSITION).alias(SOURCE_ORDER))


def long_order(sheet: int, year: Column, row: Column) -> Column:
    """Position of an unpivoted row: sheet by sheet, each year by year, each in row order."""
    years = F.lit(sheet * 10_000).cast(POSITION) + year.cast(POSITION)
    return (years * _shift(ROW_BITS + BLOCK_BITS + FILE_BITS) + row.cast(POSITION)).cast(POSITION)


def _first_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The first line of every file, by Hadoop's file systems: one small read each, on the driver."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    lines = {}
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        raw = path.getFileSystem(conf).open(path)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        stream = codec.createInputStream(raw) if codec else raw
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines[name] = reader.readLine() or ""
        reader.close()
    return lines


def _read_with_headers(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Delimited files by the names in their own headers: one scan per distinct header.

    A column that a file lacks is NULL in its rows.
    """
    files = _files(spark, path)
    groups: dict[str, list[str]] = {}
    for name, line in _first_lines(spark, files).items():
        groups.setdefault(line, []).append(name)
    if not groups:
        raise ValueError(f"no file under {path}")
    parts = [with_source_order(spark.read.csv(same, header=True, **options), files) for same in groups.values()]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    order = [SOURCE_ORDER]
    return whole.select(*[F.col(f"`{c}`") for c in whole.columns if c not in order], *order)


def read_wide_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tab-separated annual tables: one composite dimension column, one column per year.

    Headers are kept verbatim, with their trailing blanks and the ``\\TIME_PERIOD`` mark. Files may
    hold different years; they must list the same dimensions in the same order.
    """
    df = _read_with_headers(spark, path, sep="\t")
    others = [c for c in df.columns[1:] if "," in c]
    if others:
        raise ValueError(f"files with other dimensions than {df.columns[0]!r}: {others}")
    return df


def read_sdmx_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comma-separated statistics tables with a header, long or with ``YYYY_value`` columns."""
    return _read_with_headers(spark, path)


def read_sheet(spark: SparkSession, path: str, header_mark: str = "Substance") -> DataFrame:
    """One exported workbook sheet: free-form preamble rows, a header row, then data.

    The header row is found by its first cell and gives the number of columns; Spark would size the
    table by the first (short) preamble row.
    """
    files = _files(spark, path)
    if len(files) != 1:
        raise ValueError(f"a sheet is one file: {path}")
    # The header is the first line whose first cell, quoted or not, is the mark: found in Spark by the
    # least source position, however many lines before it look alike.
    first_cell = F.regexp_extract(F.col("value"), r'^\s*("(?:[^"]|"")*"|[^,]*)', 1)
    unquoted = F.regexp_replace(F.regexp_replace(F.trim(first_cell), r'^"|"$', ""), '""', '"')
    text = with_source_order(spark.read.text(path), files)
    found = text.filter(F.trim(unquoted) == header_mark).orderBy(SOURCE_ORDER).select("value").first()
    if found is None:
        raise ValueError(f"no row starting with {header_mark!r} in {path}")
    names = next(csv.reader([found["value"]]))
    cells = [f"c{i}" for i in range(len(names))]
    raw = spark.read.csv(path, schema=", ".join(f"{c} string" for c in cells), header=False)
    raw = with_source_order(raw, files)
    # The preamble precedes the header.
    header = raw.filter(F.trim("c0") == header_mark).agg(F.min(SOURCE_ORDER)).first()[0]
    named = [(c, name) for c, name in zip(cells, names) if name]
    return raw.filter(F.col(SOURCE_ORDER) > F.lit(header)).select(*[F.col(c).alias(n) for c, n in named], SOURCE_ORDER)


def read_sheets(spark: SparkSession, paths: Mapping[str, str], **options) -> dict[str, DataFrame]:
    """Several sheets, as ``{sheet name: DataFrame}`` in the given order."""
    return {sheet: read_sheet(spark, path, **options) for sheet, path in paths.items()}
