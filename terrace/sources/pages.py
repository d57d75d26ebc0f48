"""Landed page files: reading them and keeping the unbroken prefix of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from terrace.schemas import RAW
from terrace.session import exists, make_folder, small_files
from terrace.sources import files as local

PAGE = "page"
FAILED = "page_failed"
_CORRUPT = "_corrupt_record"
# `page-0007.json`, `page_7.json` and the folder form `page=7/...` all name page 7. Other
# parts of the path do not count.
_PAGE_IN_FILE = r"page[-_=](\d+)[^/]*$"
_PAGE_FOLDER = r".*/page=(\d+)/"

# The option that bounds a micro-batch, and the files of a note if it is not set.
_MOST = "maxFilesPerTrigger"
_FILES_A_NOTE = 100_000
_NOTE = "file string, length long, modified timestamp"

_PLAIN_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


def _page_of(path: Column) -> Column:
    in_file = F.regexp_extract(path, _PAGE_IN_FILE, 1).try_cast("long")
    return F.coalesce(in_file, F.regexp_extract(path, _PAGE_FOLDER, 1).try_cast("long"))


def _page_schema(fields: StructType) -> StructType:
    return StructType([*fields.fields, StructField(_CORRUPT, StringType(), True)])


def _with_page(df: DataFrame, fields: StructType) -> DataFrame:
    return df.select(
        *fields.names,
        _page_of(F.col("_metadata.file_path")).alias(PAGE),
        F.col(_CORRUPT).isNotNull().alias(FAILED),
    )


def read_pages(
    spark: SparkSession, path: str | list[str], fields: StructType = RAW, multi_line: bool = True
) -> DataFrame:
    """Records of all page files with their page number.

    A page is a JSON array, or one object per line with `multi_line=False` (such
    files can be split among tasks). Fields are read as text: a quoted number under
    a numeric field would silently turn NULL. Missing fields are NULL, unknown ones
    are dropped, and text that is no JSON marks its row in `page_failed`. `page` is
    NULL where neither the file nor its `page=` folder is numbered.

    A JSON array is parsed by one task; large pages belong into the other form. The files of a
    folder on a local or mounted disk that has this form are listed and opened by tasks and parsed
    by Spark, so any number of them is read without one on the driver.
    """
    folder = local.local_folder(spark, path) if isinstance(path, str) and _in_tasks(fields, multi_line) else None
    if folder:
        files = local.as_spark_reads(local.list_files(spark, folder), folder)
        if not local.opened_by_spark_only(files):
            return _read_files(files, fields, local.reading_tasks(files))
    reader = spark.read.schema(_page_schema(fields)).option("columnNameOfCorruptRecord", _CORRUPT)
    with small_files(spark):
        return _with_page(reader.option("multiLine", multi_line).json(path), fields)


def _in_tasks(fields: StructType, multi_line: bool) -> bool:
    """Whether a text is parsed alike by the JSON reader and here: a line at a time, fields as text."""
    return not multi_line and all(isinstance(f.dataType, StringType) for f in fields)


def _read_files(files: DataFrame, fields: StructType, tasks: int) -> DataFrame:
    """Records of listed files (file, length), one object or array of objects a line."""
    lines = local.read_lines(files.select("file", "length", _page_of(F.col("file")).alias("page")), tasks)
    is_array = F.expr("startswith(trim(LEADING ' \t' FROM line), '[')")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    as_written = files.sparkSession.conf.get("spark.sql.json.enableExactStringParsing", "true") == "true"
    parsed = lines.select(
        "page",
        is_array.alias("is_array"),
        F.from_json(F.when(~is_array, F.col("line")), _page_schema(fields), options).alias("one"),
        F.from_json(F.when(is_array, F.col("line")), ArrayType(fields), {"mode": "PERMISSIVE"}).alias("many"),
        F.from_json(F.col("exact") if as_written else F.lit(None).cast("string"), ArrayType(fields), {"mode": "PERMISSIVE"}).alias("exact"),
    )

    def record(parsed: Column, number: Column, failed: Column) -> Column:
        exact = F.get("exact", number)
        own = [F.when(parsed[f.name].isNotNull(), F.coalesce(exact[f.name], parsed[f.name])).alias(f.name) for f in fields]
        return F.struct(*own, failed.alias(FAILED))

    failed = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], F.lit(True).alias(FAILED))
    broken = F.col("many").isNull() | F.exists("many", lambda r: r.isNull())
    many = F.transform("many", lambda r, number: record(r, number, F.lit(False)))
    one = record(F.col("one"), F.lit(0), F.col("one").isNull() | F.col("one")[_CORRUPT].isNotNull())
    records = F.when(~F.col("is_array"), F.array(one)).when(broken, F.array(failed)).otherwise(many)
    return parsed.select("page", F.inline(records)).select(*fields.names, F.col("page").alias(PAGE), FAILED)


def write_pages(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Records as JSON page files, one object per line, in one folder per value of `page`.

    On a local disk they have no checksum files beside them, as files of another program have none;
    a page is small, and its checksum file would cost half as much again. There the tasks write them
    without Hadoop, which would start a process for each file and folder.
    """
    path_there = local.local_path(rows.sparkSession, path)
    added = mode == "append" or (mode == "errorifexists" and not exists(rows.sparkSession, path))
    if path_there and added and len(rows.columns) > 1:
        local.write_json_folders(rows, path_there, PAGE)
        return
    rows.hint("rebalance", PAGE).write.mode(mode).options(**_PLAIN_FILES).partitionBy(PAGE).json(path)


def stream_pages(
    spark: SparkSession,
    path: str,
    fields: StructType = RAW,
    multi_line: bool = True,
    checkpoint: str | None = None,
    **options: object,
) -> DataFrame:
    """As `read_pages`, as a stream of the files that arrive.

    With the stream's `checkpoint` and what tasks can read, the files that are new now are listed by
    tasks and noted there, and the stream reads these notes: the driver would hold every file that
    ever arrived otherwise. A checkpoint that began without such notes goes on without.
    """
    log = f"{checkpoint.rstrip('/')}/page-files" if checkpoint else None
    noted = log is not None and exists(spark, log)
    if noted or (log and not exists(spark, f"{checkpoint.rstrip('/')}/offsets")):
        folder = local.local_folder(spark, path) if _in_tasks(fields, multi_line) and set(options) <= {_MOST} else None
        if folder and _note_files(spark, folder, log, int(options.get(_MOST, _FILES_A_NOTE)), noted):
            notes = spark.readStream.schema(_NOTE).options(**({_MOST: 1} if _MOST in options else {})).parquet(log)
            return _read_files(notes, fields, local.tasks_for(spark))
        if noted:
            raise ValueError(f"the stream of {checkpoint} cannot go on with pages of another form")
    reader = spark.readStream.schema(_page_schema(fields)).option("columnNameOfCorruptRecord", _CORRUPT)
    reader = reader.options(**options)
    with small_files(spark):
        return _with_page(reader.option("multiLine", multi_line).json(path), fields)


def _note_files(spark: SparkSession, folder: str, log: str, most: int, noted: bool) -> bool:
    """Add the files of a folder that are not in the log yet, oldest first, in notes of `most` files
    each; false if there are some that only Spark opens."""
    files = local.as_spark_reads(local.list_files(spark, folder), folder)
    if local.opened_by_spark_only(files):
        return False
    make_folder(spark, log)
    if noted:
        # Never a broadcast: paths are small as stored, and large in a table on the driver.
        files = files.join(spark.read.schema(_NOTE).parquet(log).select("file").hint("merge"), "file", "left_anti")
    if not files.isEmpty():
        ordered = files.select("file", "length", "modified").repartition(1).sortWithinPartitions("modified", "file")
        ordered.write.mode("append").option("maxRecordsPerFile", most).parquet(log)
    return True


def _files(spark: SparkSession, path: str) -> DataFrame:
    folder = local.local_folder(spark, path)
    if folder:
        return local.list_files(spark, folder)
    with small_files(spark):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def list_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page numbers of the files there, also of pages without a record.

    Only paths are read, never the content of a file.
    """
    return _files(spark, path).select(_page_of(F.col("file")).alias(PAGE), F.lit(False).alias(FAILED))


def list_page_files(spark: SparkSession, path: str) -> DataFrame:
    """file, length, modified and page of the files there; no content is read."""
    return _files(spark, path).select("file", "length", "modified", _page_of(F.col("file")).alias("page"))


def read_page_files(spark: SparkSession, files: DataFrame, fields: StructType = RAW, multi_line: bool = True) -> DataFrame:
    """As `read_pages`, of files as `list_page_files` has them.

    Their names come to the driver only where Spark must list them: on other file systems than local
    and mounted ones, for JSON arrays and for codecs that Python lacks."""
    others = ~F.startswith("file", F.lit(f"{local.SCHEME}/"))
    if _in_tasks(fields, multi_line) and files.filter(others).isEmpty() and not local.opened_by_spark_only(files):
        return _read_files(files, fields, local.reading_tasks(files))
    return read_pages(spark, [r.file for r in files.select("file").collect()], fields, multi_line)


def page_boundary(pages: DataFrame, total_pages: int | None = None, first_page: int = 1) -> DataFrame:
    """One row on the pages: `boundary`, the first page not to load; `pages_read`;
    `broken`, whether that page is wanted but missing or failed; `truncated`, whether it
    is or pages beyond it were seen; `unnumbered`, the rows without a page number;
    `skipped`, the rows of pages before the first.

    `pages` has a row per record or per page (`page`, `page_failed`). Pages count
    from `first_page`; the boundary is the first one that is absent or failed, at most
    `total_pages + 1`. With `total_pages=None` all pages seen are wanted.

    Every page seen marks itself and, if it is good, the page after it. A page that
    follows a good one and is not good itself is a gap, and the first gap is the
    boundary. That takes one pass over the records, combined on the map side, and no
    join; the page numbers are never gathered in one place.
    """
    wanted = F.col(PAGE).between(first_page, total_pages) if total_pages else F.col(PAGE) >= first_page
    seen = pages.groupBy(PAGE).agg(F.max(FAILED).alias("failed"), F.count("*").alias("n"))
    seen = seen.select(PAGE, (wanted & ~F.col("failed")).alias("good"), F.coalesce(F.col(PAGE) >= first_page, F.lit(False)).alias("counts"), "n")
    marks = seen.selectExpr(
        f"""stack(2, {PAGE}, good, false, if(counts, {PAGE}, NULL), if({PAGE} IS NULL, n, 0L), if(counts, 0L, n),
            {PAGE} + 1, false, good, CAST(NULL AS LONG), 0L, 0L)
        AS ({PAGE}, good, next, seen, unnumbered, skipped)"""
    )
    start = pages.sparkSession.range(first_page, first_page + 1, 1, 1).selectExpr("id", "false", "true", "cast(null AS long)", "0L", "0L")
    per_page = marks.union(start).groupBy(PAGE).agg(
        F.max("good").alias("good"),
        F.max("next").alias("next"),
        F.max("seen").alias("seen"),
        F.sum("unnumbered").alias("unnumbered"),
        F.sum("skipped").alias("skipped"),
    )
    # Pages below the first follow nothing and are followed by nothing.
    gap = F.when(F.col("next") & ~F.coalesce("good", F.lit(False)) & (F.col(PAGE) >= first_page), F.col(PAGE))
    last = F.coalesce(F.max("seen"), F.lit(0))
    wanted_last = F.lit(total_pages).cast("long") if total_pages else last
    return per_page.agg(
        F.min(gap).alias("boundary"),
        last.alias("_last"),
        wanted_last.alias("_wanted"),
        F.sum("unnumbered").alias("unnumbered"),
        # A NULL page counts as unnumbered only.
        F.sum(F.when(F.col(PAGE).isNotNull(), F.col("skipped")).otherwise(0)).alias("skipped"),
    ).select(
        "boundary",
        (F.col("boundary") - first_page).alias("pages_read"),
        (F.col("boundary") <= F.col("_wanted")).alias("broken"),
        (F.col("boundary") <= F.greatest("_wanted", "_last")).alias("truncated"),
        "unnumbered",
        "skipped",
    )


def keep_page_prefix(df: DataFrame, boundary: DataFrame) -> DataFrame:
    """Rows of the pages before the boundary, which reaches the scan as one value."""
    return df.filter(F.col(PAGE) < boundary.select("boundary").scalar())
