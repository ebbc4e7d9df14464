"""Archives: lines of zipped CSV members, names and periods, header and malformed lines."""

from __future__ import annotations

import io
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.schemas import KLINE_COLUMNS

#: `<symbol>-<interval or dataset>-<yyyy-mm or yyyy-mm-dd>`, as archives are named.
NAME = r"([^/]+)-([0-9]+[smhdwM]|metrics|fundingRate)-([0-9]{4}-[0-9]{2}(?:-[0-9]{2})?)\.zip$"


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(file, content) of the archives under a path; no match is an error when the path is read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def zip_lines(archives: DataFrame, skip_blank: bool = True, tell_empty: bool = False) -> DataFrame:
    """(file, line_no, line) of the first CSV member of each archive, decompressed as a stream.

    A byte order mark and line ends are removed. An archive without a CSV member has no lines, or with
    ``tell_empty`` a single one numbered -2 with a null text. A member is read to its end once before
    any of its lines counts: one that is damaged, encrypted or not UTF-8 gives a single line numbered -1
    with a null text, and never half of its lines.
    """

    def lines(content: bytes):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            member = next((n for n in z.namelist() if n.lower().endswith(".csv")), None)
            if tell_empty and not member:
                yield -2, None
            for counts in (False, True) if member else ():
                with io.TextIOWrapper(z.open(member), encoding="utf-8-sig", newline="\n") as text:
                    for i, line in enumerate(text):
                        if counts and (line.strip() or not skip_blank):
                            yield i, line.rstrip("\r\n")

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                rows: list = []
                try:
                    for row in lines(content.as_buffer().to_pybytes()):
                        rows.append(row)
                        if len(rows) == 50_000:
                            yield batch_of(file, rows)
                            rows = []
                except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, UnicodeDecodeError):
                    rows = [(-1, None)]  # RuntimeError: encrypted, or compressed in a way that isn't known
                if rows:
                    yield batch_of(file, rows)

    def batch_of(file, rows):
        numbers, texts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([file] * len(rows)), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], ["file", "line_no", "line"])

    return archives.select("file", "content").mapInArrow(run, "file string, line_no long, line string")


def rejected_archives(lines: DataFrame) -> DataFrame:
    """(file, reason) of archives that gave no line."""
    return lines.filter("line_no < 0").select("file", F.when(F.col("line_no") == -1, "damaged").otherwise("no CSV member").alias("reason"))


def is_header(line: Column) -> Column:
    """Any letter in the first field."""
    return F.split(line, ",")[0].rlike("[A-Za-z]")


def without_headers(lines: DataFrame) -> DataFrame:
    """Lines that are no header by the letter rule."""
    return lines.filter(~is_header(F.col("line")))


def merged_lines(lines: DataFrame, may_lack_header: bool = False) -> DataFrame:
    """Passthrough merge of files: is_header, file, line_no, line, with one header for all.

    Each file's first line is its header and the first file's one is kept. With
    ``may_lack_header`` (premium index files) a first line is a header only if it starts with
    ``open_time``; if the first file has none, the usual one is put there.
    """
    first = F.col("line_no") == 0
    head = first & F.trim("line").startswith("open_time") if may_lack_header else first
    one = lines.filter(first).agg(F.min_by("line", "file").alias("line"), F.min("file").alias("file")).filter("file is not null")
    if may_lack_header:
        one = one.withColumn("line", F.when(F.trim("line").startswith("open_time"), F.col("line")).otherwise(",".join(KLINE_COLUMNS)))
    header = one.select(F.lit(True).alias("is_header"), "file", F.lit(-1).cast("long").alias("line_no"), "line")
    return header.unionByName(lines.filter(F.col("line_no") >= 0).filter(~head).select(F.lit(False).alias("is_header"), "file", "line_no", "line"))


def is_malformed(line: Column, fields: int = 7) -> Column:
    return F.size(F.split(line, ",")) < fields


def kline_fields(lines: DataFrame, columns: list[str] = KLINE_COLUMNS) -> DataFrame:
    """Lines as text columns with file and line number; absent fields are null."""
    parts = F.split("line", ",")
    return lines.select("file", "line_no", *(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)))


def zip_klines(archives: DataFrame, strict: bool = False) -> DataFrame:
    """Typed klines of archives with or without a header; malformed lines and archives are left out.

    A value that isn't a number is null, or with ``strict`` an error that stops the job.
    """
    return klines_of(zip_lines(archives), strict)


def klines_of(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``zip_klines`` of lines that are there already."""
    good = without_headers(lines.filter("line_no >= 0")).filter(~is_malformed(F.col("line"), 12))
    rows = kline_fields(good)
    doubles = [c for c in KLINE_COLUMNS if c not in ("open_time", "close_time", "number_of_trades", "ignore")]
    if strict:
        kinds = {c: S.strict_number(F.col(c)) for c in doubles} | {c: F.col(c).cast("bigint") for c in ("open_time", "close_time")} | {"number_of_trades": S.strict_count(F.col("number_of_trades"))}
    else:
        kinds = {c: F.col(c).try_cast("double") for c in doubles} | {c: F.col(c).try_cast("bigint") for c in ("open_time", "close_time", "number_of_trades")}
    return rows.withColumns(kinds).drop("ignore")


def parse_names(files: DataFrame, column: str = "file") -> DataFrame:
    """Add symbol, kind (interval or dataset), period and daily of archive names; null where a name doesn't fit."""
    part = lambda i: F.nullif(F.regexp_extract(column, NAME, i), F.lit(""))
    return files.select("*", part(1).alias("symbol"), part(2).alias("kind"), part(3).alias("period"), (F.length(part(3)) == 10).alias("daily"))


def period_bounds(files: DataFrame) -> tuple | None:
    """First and last instant that the archives' names promise, as timestamps: one row to the driver, and nothing is unzipped."""
    named = parse_names(files.select("file")).filter("period is not null")
    start = F.to_date(F.when(F.col("daily"), F.col("period")).otherwise(F.concat("period", F.lit("-01"))))
    end = F.when(F.col("daily"), F.date_add(start, 1)).otherwise(F.add_months(start, 1))
    row = named.agg(F.min(start).cast("timestamp_ntz").alias("lo"), F.max(end).cast("timestamp_ntz").alias("hi")).first()
    return None if row.lo is None else (row.lo, row.hi)


def expected_periods(spans: DataFrame, daily: bool) -> DataFrame:
    """(symbol, period) for each month or day from ``start`` to ``end``, both included; none if end < start."""
    step, pattern = ("interval 1 day", "yyyy-MM-dd") if daily else ("interval 1 month", "yyyy-MM")
    start = F.col("start") if daily else F.trunc("start", "month")
    days = F.when(F.col("end") >= F.col("start"), F.sequence(start, F.col("end"), F.expr(step)))
    return spans.select("symbol", F.explode(days).alias("_d")).select("symbol", F.date_format("_d", pattern).alias("period"))


def missing_periods(expected: DataFrame, landed: DataFrame) -> DataFrame:
    return expected.join(landed.select("symbol", "period"), ["symbol", "period"], "left_anti")
