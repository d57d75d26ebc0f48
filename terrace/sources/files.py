"""Many small files of a local or mounted disk, listed, read and written by Spark's tasks.

Spark's own listing keeps every file on the driver, its readers spend some 2 ms on the settings of
each file, and Hadoop starts a process for each file and folder that it makes on such a disk. Here
a listing is a stored table, and files are opened in Python, so that the driver holds none of them.
Other file systems are left to Spark.
"""

from __future__ import annotations

import bz2
import gzip
import json
import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import _hadoop_path, remove, scratch_dir

FOUND = "path string, folder boolean, length long, modified long"
SCHEME = "file:"
# A larger file is read in parts by several tasks. A part is held in memory.
PART_BYTES = 16 * 1024 * 1024
# What opening a file costs, in bytes read meanwhile.
OPEN_BYTES = 32 * 1024
TASK_BYTES = 128 * 1024 * 1024
BATCH_BYTES = 1024 * 1024
# Endings that name a codec: of these Python opens some, Spark the others too.
_OPENERS = {".gz": gzip.open, ".bz2": bz2.open}
CODECS = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd")
_BOM = b"\xef\xbb\xbf"
_LINE_END = re.compile(rb"\r\n|\r|\n")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the tasks' Python opens it; None if it is none of a local or mounted disk, or a
    pattern of several."""
    if re.search(r"[*?\[\]{}]", path):
        return None
    files, target = _hadoop_path(spark, path)
    return files.makeQualified(target).toUri().getPath() if files.getUri().getScheme() == "file" else None


def local_folder(spark: SparkSession, path: str) -> str | None:
    """As `local_path`, of a folder that is there."""
    local = local_path(spark, path)
    if local is None:
        return None
    files, target = _hadoop_path(spark, path)
    return local if files.exists(target) and files.getFileStatus(target).isDirectory() else None


def tasks_for(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


# --- listing --------------------------------------------------------------------------


def _hidden(name: str) -> bool:
    """As Spark leaves files out."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str, deep: bool) -> Iterator[tuple[str, bool, int, int]]:
    with os.scandir(folder) as found:
        for entry in found:
            if _hidden(entry.name):
                continue
            if not entry.is_dir():
                try:
                    status = entry.stat()
                except FileNotFoundError:  # gone meanwhile, or a link to nothing
                    continue
                yield entry.path, False, status.st_size, status.st_mtime_ns // 1_000_000
            elif deep:
                yield from _entries(entry.path, True)
            else:
                yield entry.path, True, 0, 0


def _rows(rows: Iterator[tuple], names: list[str], most: int = 10_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names)


def _opened(deep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Folders replaced by what they hold, or by all files below them."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1]:
                    yield from _entries(row[0], deep)
                else:
                    yield row

    return lambda batches: _rows(entries(batches), ["path", "folder", "length", "modified"])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """file, length and modified of the files below a folder (its `local_folder`) as they are now,
    stored; no empty ones, and no hidden ones.

    The folder's own entries are listed by one task, those below by some tasks a core."""
    schema = "file string, length long, modified timestamp"
    found = spark.createDataFrame([(folder.rstrip("/") or "/", True, 0, 0)], FOUND).coalesce(1)
    found = found.mapInArrow(_opened(False), FOUND)
    for deep in (False, True):
        found = found.repartition(tasks_for(spark), "path").mapInArrow(_opened(deep), FOUND)
    path = f"{scratch_dir(spark, 'listing')}/files"
    found.filter("length > 0").select(F.concat(F.lit(SCHEME), "path").alias("file"), "length", F.timestamp_millis("modified").alias("modified")).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def as_spark_reads(files: DataFrame, folder: str) -> DataFrame:
    """Those files of a listing that Spark's reader takes of a folder: below `key=value` folders if
    there are such, else the folder's own."""
    below = F.substr("file", F.lit(len(SCHEME + folder.rstrip("/")) + 2))
    keyed = below.rlike("(^|/)[^/=]+=[^/]+/")
    return files.filter(keyed) if not files.filter(keyed).isEmpty() else files.filter(~below.contains("/"))


def has_ending(file: Column, endings: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for ending in endings:
        found = found | F.endswith(file, F.lit(ending))
    return found


def opened_by_spark_only(files: DataFrame) -> bool:
    """Whether there are files whose codec is not read here."""
    return not files.filter(has_ending(F.col("file"), tuple(c for c in CODECS if c not in _OPENERS and c != ".deflate"))).isEmpty()


# --- lines ----------------------------------------------------------------------------


def _blocks(path: str) -> Iterator[bytes]:
    """The bytes of a compressed file."""
    if path.endswith(".deflate"):
        with open(path, "rb") as file:
            packed = zlib.decompressobj()
            while block := file.read(BATCH_BYTES):
                yield packed.decompress(block)
            yield packed.flush()
    else:
        with _OPENERS[os.path.splitext(path)[1]](path, "rb") as file:
            while block := file.read(BATCH_BYTES):
                yield block


def _split(data: bytes) -> list[bytes]:
    return _LINE_END.split(data) if b"\r" in data else data.split(b"\n")


def _unpacked_lines(path: str) -> Iterator[list[bytes]]:
    rest, first = b"", True
    for block in _blocks(path):
        rest += block
        if first and len(rest) >= len(_BOM):
            rest, first = rest.removeprefix(_BOM), False
        # A last \r may be the half of a line end.
        *lines, rest = _split(rest[:-1]) if rest.endswith(b"\r") else _split(rest)
        rest += b"\r" if block.endswith(b"\r") else b""
        yield lines
    yield _split(rest.removeprefix(_BOM) if first else rest)


def lines_of(path: str, start: int, stop: int) -> list[bytes]:
    """The lines that begin behind `start`, or at it if it is 0, and not behind `stop`. So of a
    file in parts each line is in one of them."""
    with open(path, "rb") as file:
        file.seek(start)
        data = file.read(stop - start)
        first = _LINE_END.search(data) if start else None
        if start and not first:
            return []
        # On to the end of the line that lies across `stop` or begins there.
        tail = []
        while more := file.read(64 * 1024):
            end = _LINE_END.search(more)
            tail.append(more[: end.end()] if end else more)
            if end:
                if tail[-1].endswith(b"\r") and end.end() == len(more) and file.read(1) == b"\n":
                    tail.append(b"\n")
                break
    data = b"".join([data, *tail])
    if not start:
        return _split(data.removeprefix(_BOM))
    return _split(data[_LINE_END.search(data).end() :])


_QUOTED = r'"(?:[^"\\]|\\.)*"|\'(?:[^\'\\]|\\.)*\''
_FIELD = re.compile(rf"\s*({_QUOTED})\s*:\s*({_QUOTED}|[^\s,{{}}\[\]\"']+|(?=[\[{{]))\s*([,}}]?)", re.S)
_NESTED = re.compile(rf"{_QUOTED}|[\[\]{{}}]", re.S)
_SPACE = re.compile(r"\s*")
# A field with a value that `from_json` may write otherwise: no string, whole number or literal. The
# same within a string is found too.
_REWRITTEN = re.compile(rb"[\"']\s*:\s*(?![\s\"']|null|true|false|(?:0|-?[1-9][0-9]*)\s*[,}])")
# No JSON, and blank to `from_json`: a row of a broken line.
_BROKEN = "\x01"


def _nested_end(text: str, at: int) -> int:
    depth = 0
    for token in _NESTED.finditer(text, at):
        depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(token.group(), 0)
        if not depth:
            return token.end()
    raise ValueError(text)


def _unquoted_fields(text: str, at: int) -> tuple[dict[str, str], int]:
    """The texts of the fields of the object at a place whose values are no strings, and its end."""
    found: dict[str, str] = {}
    if text[at] != "{":
        raise ValueError(text)
    at = _SPACE.match(text, at + 1).end()
    if text[at] == "}":
        return found, at + 1
    while True:
        field = _FIELD.match(text, at)
        name, value, mark = field.groups()
        at = field.end()
        if not value:
            at = _nested_end(text, field.end(2))
            value = text[field.end(2) : at]
            at = _SPACE.match(text, at).end() + 1
            mark = text[at - 1]
        if "\\" in name:
            name = json.loads(name if name[0] == '"' else '"' + name[1:-1].replace('"', '\\"') + '"')
        else:
            name = name[1:-1]
        if value[0] not in "\"'":
            found[name] = value
        elif name in found:  # of fields of one name the last counts
            del found[name]
        if mark == "}":
            return found, at
        if mark != ",":
            raise ValueError(text)


def exact_texts(line: str) -> str | None:
    """For each object of a line the values that are no strings, as they are written there. The
    JSON reader keeps these texts (`2.50`, `{"a": 1}`) where `from_json` writes them anew."""
    try:
        at = _SPACE.match(line).end()
        if line[at] == "{":
            return json.dumps([_unquoted_fields(line, at)[0]])
        found, at = [], _SPACE.match(line, at + 1).end()
        while line[at] != "]":
            one, at = _unquoted_fields(line, at)
            found.append(one)
            at = _SPACE.match(line, at).end()
            if line[at] == ",":
                at = _SPACE.match(line, at + 1).end()
        return json.dumps(found)
    except (ValueError, IndexError, AttributeError):
        return None  # whether it is broken is for the parser to say


def _texts(lines: list[bytes]) -> pa.Array:
    try:
        return pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:

        def text(line: bytes) -> str:
            try:
                return line.decode()
            except UnicodeDecodeError:
                return _BROKEN

        return pa.array([text(line) for line in lines], pa.string())


def _exact(lines: list[bytes], texts: pa.Array) -> pa.Array:
    if not _REWRITTEN.search(b"\n".join(lines)):
        return pa.nulls(len(lines), pa.string())
    return pa.array([exact_texts(t.as_py()) if _REWRITTEN.search(line) else None for line, t in zip(lines, texts)], pa.string())


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, lines, size = [], [], 0

    def batch() -> pa.RecordBatch:
        texts = _texts(lines)
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), texts, _exact(lines, texts)], ["page", "line", "exact"])

    for part in batches:
        for file, page, start, stop in zip(*(c.to_pylist() for c in part.columns)):
            path = file.removeprefix(SCHEME)
            for own in _unpacked_lines(path) if path.endswith(CODECS) else [lines_of(path, start, stop)]:
                own = [line for line in own if line.strip(b" \t\r\n")]
                for at in range(0, len(own), 1000):
                    few = own[at : at + 1000]
                    lines += few
                    numbers += [page] * len(few)
                    size += sum(map(len, few))
                    if size >= BATCH_BYTES:
                        yield batch()
                        numbers, lines, size = [], [], 0
    if lines:
        yield batch()


def read_lines(files: DataFrame, tasks: int) -> DataFrame:
    """page, line and its `exact_texts` of all lines of the `files` (file, length, page), without
    blank ones."""
    packed = has_ending(F.col("file"), CODECS)
    last = F.when(packed, 0).otherwise(F.expr(f"greatest(length - 1, 0) DIV {PART_BYTES}"))
    parts = files.select("file", "length", "page", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("part"))
    parts = parts.select("file", "page", F.expr(f"part * {PART_BYTES}L").alias("start"), F.expr(f"least(length, (part + 1) * {PART_BYTES}L)").alias("stop"))
    return parts.repartition(tasks).mapInArrow(_read, "page long, line string, exact string")


def reading_tasks(files: DataFrame) -> int:
    """As many tasks as Spark would read these files with."""
    spark = files.sparkSession
    size = files.agg(F.sum(F.col("length") + OPEN_BYTES)).first()[0] or 0
    return max(1, -(-size // min(TASK_BYTES, max(OPEN_BYTES, size // spark.sparkContext.defaultParallelism))))


# --- writing --------------------------------------------------------------------------


def _folder_name(column: str, value: str | None) -> str:
    text = value if value else _NO_VALUE
    return f"{column}={_ESCAPED.sub(lambda c: f'%{ord(c.group()):02X}', text)}"


def _fresh(wanted: str, names: list[str]) -> str:
    while wanted in names:
        wanted += "_"
    return wanted


def _staged(stage: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (value, line), sorted by value, as a file each value below `stage`."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task = TaskContext.get()
        folder = f"{stage}/{task.partitionId()}-{task.taskAttemptId()}"
        os.makedirs(folder, exist_ok=True)
        file, held, number = None, None, 0
        try:
            for batch in batches:
                for value, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                    if file is None or value != held:
                        if file:
                            file.close()
                            yield f"{folder}/{number}", held, task.partitionId()
                        held, number = value, number + 1
                        file = open(f"{folder}/{number}", "wb")  # noqa: SIM115
                    file.write(line + b"\n")
        finally:
            if file:
                file.close()
        if file:
            yield f"{folder}/{number}", held, task.partitionId()

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("staged", pa.string()), ("value", pa.string()), ("part", pa.int32())])
        for batch in _rows(put(batches), schema.names):
            yield batch.cast(schema)

    return files


def _moved(path: str, column: str, write: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for staged, value, part in zip(*(c.to_pylist() for c in batch.columns)):
                folder = f"{path}/{_folder_name(column, value)}"
                name = f"{folder}/part-{part:05d}-{write}.json"
                os.makedirs(folder, exist_ok=True)
                try:
                    os.replace(staged, name)
                except FileNotFoundError:
                    if not os.path.exists(name):  # else moved by an attempt before
                        raise
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    return move


def write_json_folders(rows: DataFrame, path: str, column: str) -> None:
    """The rows as JSON lines in a folder of `path` (its `local_path`) for each value of `column`,
    as Spark's writer partitions them, added to what is there.

    The files come to their places when all are written; a task that runs again writes the same
    files. A value that is too big for one task is split among several, with a file each."""
    spark, write = rows.sparkSession, str(uuid.uuid4())
    path = path.rstrip("/")
    stage = f"{path}/_staging-{write}"
    # Blank and missing values share a folder.
    value = _fresh("value", rows.columns)
    valued = rows.withColumn(value, F.nullif(F.col(column).cast("string"), F.lit("")))
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != column]))
    ordered = valued.hint("rebalance", value).sortWithinPartitions(value).select(value, record.alias("line"))
    staged = ordered.mapInArrow(_staged(stage), "staged string, value string, part int")
    try:
        # The shuffle between them lets the moves begin when all files are written.
        staged.repartition(tasks_for(spark), "staged").mapInArrow(_moved(path, column, write), "n long").agg(F.sum("n")).first()
    finally:
        remove(spark, f"{SCHEME}{stage}")
    files, target = _hadoop_path(spark, f"{SCHEME}{path}/_SUCCESS")
    files.create(target, True).close()
