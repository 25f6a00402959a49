"""Catalogs of named datasets, their splits, the order of their rows, and a report of what could be read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

REPORT_SCHEMA = "source string, status string, rows bigint, error string"
LOADED, FAILED, MISSING = "loaded", "failed", "missing"


@dataclass(frozen=True)
class Source:
    name: str
    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] | None = None


def _status(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getFileStatus(hadoop_path) if files.exists(hadoop_path) else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system the path belongs to, so any store works."""
    return _status(spark, path) is not None


def is_file(spark: SparkSession, path: str) -> bool:
    status = _status(spark, path)
    return status is not None and status.isFile()


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    df = spark.read.format(source.format).options(**dict(source.options)).load(source.path)
    df = source.prepare(df) if source.prepare else df
    return df.withColumn("source", F.lit(source.name))


def load_catalog(spark: SparkSession, catalog: Sequence[Source]) -> dict[str, DataFrame]:
    """Every entry as a table with its name in ``source``. Any unreadable entry is an error here."""
    return {s.name: read_source(spark, s) for s in catalog}


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and _has_map(kind.elementType))


def _hash_of_all(df: DataFrame) -> Column:
    """A hash that needs every value of a row; maps have none of their own."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def _read_any(spark: SparkSession, source: Source, options: Mapping[str, str]) -> DataFrame:
    """A source with the schema of the file that Spark asks for it, or of all files where that one tells none."""
    try:
        return spark.read.format(source.format).options(**options).load(source.path)
    except AnalysisException:
        return spark.read.format(source.format).options(**options, mergeSchema="true").load(source.path)


def file_report(spark: SparkSession, source: Source) -> DataFrame:
    """``source, file, status, rows, error`` of every Parquet file of a source, after reading all of its pages in tasks.

    Spark's reader leaves a file where it breaks: a file is ``failed`` if it has no readable footer or gives fewer rows than
    its footer names. Checksums of pages are verified where the writer left some (Spark's does); without them
    a changed byte shows only where the page can't be decoded. Columns that ``source.prepare`` drops are read too.
    Files beginning with ``_`` or ``.`` are no data. Where no file tells a schema, all are failed.
    """
    if source.format != "parquet":
        raise ValueError("only Parquet files tell how many rows they should have")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source.path)
    # names only: no content is read
    files = listed.select(F.col("_metadata.file_path").alias("file")).filter(~F.regexp_like("file", F.lit("/[_.][^/]*$")))
    options = {**dict(source.options), "ignoreCorruptFiles": "true", "parquet.page.verify-checksum.enabled": "true"}
    try:
        rows = _read_any(spark, source, options)
    except Exception as error:  # no file tells a schema
        failed = files.select(F.lit(source.name).alias("source"), "file", F.lit(FAILED).alias("status"))
        return failed.select("*", F.lit(None).cast("bigint").alias("rows"), F.lit(_first_line(error)).alias("error"))
    place = F.col("_metadata.file_path").alias("file")
    # a plain count would need no values; one of even hashes and one of odd hashes need them all
    even = F.pmod(_hash_of_all(rows), F.lit(2)) == 0
    read = rows.select(place, even.alias("even")).groupBy("file").agg((F.count_if("even") + F.count_if(~F.col("even"))).alias("n_read"))
    # needs no column, so it comes from the footers
    named = rows.select(place).groupBy("file").agg(F.count(F.lit(1)).alias("n_named"))
    found = files.join(named, "file", "left").join(read, "file", "left")
    n_read = F.coalesce("n_read", F.lit(0).cast("bigint"))
    whole = F.coalesce(n_read == F.col("n_named"), F.lit(False))
    short = F.concat(n_read.cast("string"), F.lit(" of "), F.col("n_named").cast("string"), F.lit(" rows can be read"))
    return found.select(
        F.lit(source.name).alias("source"),
        "file",
        F.when(whole, LOADED).otherwise(FAILED).alias("status"),
        F.when(whole, F.col("n_named")).alias("rows"),
        F.when(~whole, F.coalesce(short, F.lit("no rows in its footer, or no footer"))).alias("error"),
    )


def load_readable(spark: SparkSession, source: Source) -> tuple[DataFrame | None, DataFrame]:
    """The rows of the whole files of a source, and its ``file_report``. None where no file is whole.

    The paths of whole files go through the driver, as the list of files of every table does; rows don't.
    """
    report = file_report(spark, source)
    report = spark.createDataFrame(report.collect(), report.schema)
    whole = [r["file"] for r in report.filter(F.col("status") == LOADED).collect()]
    if not whole:
        return None, report
    options = dict(source.options) if is_file(spark, source.path) else {**dict(source.options), "basePath": source.path}
    df = spark.read.format(source.format).options(**options).load(whole)
    df = source.prepare(df) if source.prepare else df
    return df.withColumn("source", F.lit(source.name)), report


def read_in_order(
    spark: SparkSession, sources: Sequence[Source], order_column: str = "source_ord", position: str = "position"
) -> list[DataFrame]:
    """Every Parquet source with its place in the list and the place of each row inside the source, from 0.

    Rows count by file name, then by their place in the file, which is the order in which they were written. A file's
    first place is the sum of the rows of the files before it; that sum runs over one row per file, and no row of
    the sources is shuffled for it. Sorting by both columns gives the order of a concatenation of lists.
    """
    tables = []
    for number, source in enumerate(sources):
        rows = spark.read.format(source.format).options(**dict(source.options)).load(source.path)
        counts = rows.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
        before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        first = counts.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
        placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        placed = placed.join(first, "_file").withColumn(position, F.col("_first") + F.col("_row")).drop("_file", "_first", "_row")
        placed = source.prepare(placed) if source.prepare else placed
        tables.append(placed.withColumns({"source": F.lit(source.name), order_column: F.lit(number)}))
    return tables


def _first_line(error: Exception) -> str:
    return (str(error).splitlines() or [type(error).__name__])[0]


def load_with_report(
    spark: SparkSession, catalog: Sequence[Source], count: bool = True
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The readable entries, and one status row per entry. A failing entry does not stop the others.

    Rows are counted from footers; ``file_report`` reads every page of every file.
    """
    tables: dict[str, DataFrame] = {}
    report: list[tuple[str, str, int | None, str | None]] = []
    for source in catalog:
        try:
            if not path_exists(spark, source.path):
                report.append((source.name, MISSING, None, f"no such path: {source.path}"))
                continue
            df = read_source(spark, source)
            rows = df.count() if count else None
            tables[source.name] = df
            report.append((source.name, LOADED, rows, None))
        except Exception as error:  # whatever goes wrong with one source is its row in the report
            report.append((source.name, FAILED, None, _first_line(error)))
    return tables, spark.createDataFrame(report, REPORT_SCHEMA)


def save_dataset(df: DataFrame, path: str, split: str | None = None, mode: str = "errorifexists") -> None:
    """Parquet, one folder per split when there is a split column."""
    writer = df.write.mode(mode)
    if split is not None:
        writer = writer.partitionBy(split)
    writer.parquet(path)


def read_saved(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The saved datasets among the paths, in their order; paths that do not exist are left out."""
    return [spark.read.parquet(p) for p in paths if path_exists(spark, p)]


def choose_split(declared: Sequence[str], prefer: str = "train") -> str | None:
    if prefer in declared:
        return prefer
    return declared[0] if declared else None


def select_split(
    df: DataFrame, declared: Sequence[str], prefer: str = "train", column: str = "split"
) -> DataFrame:
    """The preferred split, else the first declared one, else the whole table.

    Tables have no order of splits, so their declared order is a parameter. The filter is on a literal and
    prunes folders when the table is stored by split.
    """
    chosen = choose_split(declared, prefer)
    if chosen is None or column not in df.columns:
        return df
    return df.filter(F.col(column) == chosen)
