"""Files in and out: the panel as CSV or partitioned Parquet, score tables of several models."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffflow.operators.clean import strip
from staffflow.schema import HEADER_TO_NAME, NAME_TO_HEADER, NULL_TEXTS, PANEL

CORRUPT = "_corrupt_record"
# whole lines are parsed whatever columns are asked for, so the same lines count as broken
CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnPruning": "false",
    "columnNameOfCorruptRecord": CORRUPT,
    "escape": '"',
}
SCORE_COLUMNS = ["name", "employee_id", "churn_probability"]


class SourceError(ValueError):
    """A source that cannot be read as a table."""


def header_of(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Column names of a CSV source; reads the first line only, never infers types."""
    try:
        names = spark.read.option("header", True).option("multiLine", multi_line).csv(path).columns
    except AnalysisException as error:
        raise SourceError(f"cannot read {path}: {error.getCondition()}") from error
    if not names:
        raise SourceError(f"{path} is empty")
    return names


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, read by the file system alone; None of an empty one."""
    jvm = spark._jvm
    place, conf = jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        plain = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def quick_header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """``header_of`` without a job, where the first line says it all: no quoted breaks, marks, empty or repeated names."""
    line = first_line(spark, path)
    if line is None:
        raise SourceError(f"{path} is empty")
    names = next(csv.reader([line]), [])
    plain = line.isascii() and line.count('"') % 2 == 0 and "\\" not in line and '""' not in line
    if plain and names and all(names) and len({n.lower() for n in names}) == len(names):
        return names
    return header_of(spark, path, multi_line)


def files_of(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files below the paths, by Spark's own listing; no content is read."""
    try:
        listed = spark.read.format("binaryFile").load(paths).select("path")
        return sorted(r.path for r in listed.collect())
    except AnalysisException as error:
        raise SourceError(f"cannot read {paths}: {error.getCondition()}") from error


def text_schema(header: list[str]) -> T.StructType:
    """Every column as text, under the delivered headers."""
    return T.StructType([T.StructField(h, T.StringType()) for h in header])


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.try_to_date(value, "yyyy-MM-dd")
    if isinstance(kind, T.IntegralType):
        # whole numbers may be written as 31.0
        number = value.try_cast("double")
        return F.coalesce(value.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    return value.try_cast(kind)


def typed_panel(texts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Texts under the delivered headers to typed columns under ours.

    Tokens for null become null, values that do not cast become null, columns
    unknown to the panel stay text, columns in ``keep`` stay as they are.
    """
    out = []
    for header in texts.columns:
        if header in (keep or []):
            out.append(F.col(header))
            continue
        name = HEADER_TO_NAME.get(header, header)
        text = strip(F.col(f"`{header}`"))
        value = F.when(~text.isin(NULL_TEXTS), text)
        out.append((_typed(value, PANEL[name].dataType) if name in PANEL.fieldNames() else value).alias(name))
    return texts.select(*out)


def _layouts(spark: SparkSession, paths: str | list[str], multi_line: bool) -> dict[tuple[str, ...], list[str]]:
    """Files by their own header, so that every one is read by its column names."""
    groups: dict[tuple[str, ...], list[str]] = {}
    listed = [f for f in files_of(spark, paths) if not f.rpartition("/")[2].startswith(("_", "."))]
    with ThreadPoolExecutor(16) as pool:  # each opens a file and reads one line, without a job
        headers = list(pool.map(lambda f: quick_header(spark, f, multi_line), listed))
    for file, header in zip(listed, headers, strict=True):
        groups.setdefault(tuple(header), []).append(file)
    if not groups:
        raise SourceError(f"no files in {paths}")
    for header, files in groups.items():
        if "Employee_ID" not in header and "employee_id" not in header:
            raise SourceError(f"unknown layout in {files[0]}: {', '.join(header)}")
    return groups


def _lines(spark: SparkSession, paths: str | list[str], multi_line: bool) -> list[tuple[list[str], DataFrame]]:
    out = []
    for header, files in _layouts(spark, paths, multi_line).items():
        marked = text_schema(list(header)).add(CORRUPT, T.StringType())
        out.append((list(header), spark.read.schema(marked).options(**CSV_OPTIONS).option("multiLine", multi_line).csv(files)))
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_panel_csv(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, uploaded_at: str | None = None
) -> DataFrame:
    """Delivered CSV files as a typed table; every file is read by its own header.

    A short line is padded with nulls, of a long one the surplus is cut; ``csv_line_report``
    counts both. With ``multi_line`` a quoted value may hold line breaks; a file is then one task.
    ``uploaded_at`` names a column for the time each row's file was written.
    """
    parts = []
    for _, df in _lines(spark, path, multi_line):
        if uploaded_at:
            df = df.withColumn(uploaded_at, F.col("_metadata.file_modification_time"))
        parts.append(typed_panel(df.drop(CORRUPT), [uploaded_at] if uploaded_at else []))
    return _union(parts)


def corrupt_lines(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """(line, problem) of the lines that do not fit their header: ``short``, ``long`` or ``broken`` quotes."""
    parts = []
    for header, df in _lines(spark, path, multi_line):
        # a count would read the marker column alone, which the reader refuses: tie it to another
        tied = F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0
        bare = F.regexp_replace(CORRUPT, r'"([^"]|"")*"', "")
        fields = F.regexp_count(bare, F.lit(",")) + 1
        problem = F.when(F.contains(bare, F.lit('"')), "broken").when(fields < len(header), "short").when(fields > len(header), "long")
        line = F.col(CORRUPT).alias("line")
        parts.append(df.filter(F.col(CORRUPT).isNotNull() & tied).select(line, F.coalesce(problem, F.lit("broken")).alias("problem")))
    return _union(parts)


def csv_line_report(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """(problem, n_lines) for every kind of line that does not fit."""
    return corrupt_lines(spark, path, multi_line).groupBy("problem").agg(F.count(F.lit(1)).alias("n_lines"))


def write_panel(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet partitioned by year and month, or CSV under the delivered headers.

    The rebalance hint lets AQE split a large month over several files and merge
    small ones, so no month is written by one task.
    """
    if fmt == "csv":
        named = df.withColumnsRenamed({c: NAME_TO_HEADER.get(c, c) for c in df.columns})
        named.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    else:
        balanced = df.hint("rebalance", "year", "month")
        balanced.write.mode("overwrite").partitionBy("year", "month").parquet(path)


def read_panel(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def scan_scores_multi(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """One long table over the score files of several models, and why others were skipped."""
    parts, skipped = [], {}
    for model, path in paths.items():
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            skipped[model] = str(error.getCondition())
            continue
        missing = [c for c in SCORE_COLUMNS if c not in df.columns]
        if missing:
            skipped[model] = f"missing columns: {', '.join(missing)}"
            continue
        parts.append(df.select(*SCORE_COLUMNS, F.lit(model).alias("model")))
    if not parts:
        raise SourceError("no score table could be read")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, skipped
