"""Page files, JSON paths and layer scans."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from terrace import schemas, sources
from terrace.sources import files, pages
from terrace.sources.json_map import path_steps
from terrace.streaming import land_new_pages


def _page(folder, number, text):
    folder.mkdir(exist_ok=True)
    content = text if isinstance(text, str) else json.dumps(text)
    (folder / f"page-{number:04d}.json").write_text(content)


def _record(key, **fields):
    return {"id": key, "name": f"n{key}", "unknown": [1, 2], **fields}


@pytest.fixture
def folder(tmp_path):
    # The parent folder's name must not be taken for a page number.
    return tmp_path / "page-99-in"


def test_array_pages(spark, folder):
    _page(folder, 1, [_record("a", longitude="-97.46818222"), _record("b", longitude=35.10)])
    _page(folder, 2, [])
    _page(folder, 3, [_record("c", longitude="")])
    df = sources.read_pages(spark, str(folder))
    assert df.columns == [*schemas.RAW.names, "page", "page_failed"]
    rows = {r.id: r for r in df.collect()}
    assert {k: r.page for k, r in rows.items()} == {"a": 1, "b": 1, "c": 3}
    assert rows["a"].longitude == "-97.46818222"
    assert float(rows["b"].longitude) == 35.1
    assert rows["c"].longitude == "" and rows["c"].phone is None
    assert not any(r.page_failed for r in rows.values())
    assert sorted(r.page for r in sources.list_pages(spark, str(folder)).collect()) == [1, 2, 3]


def test_corrupt_page_is_marked(spark, folder):
    _page(folder, 1, [_record("a")])
    _page(folder, 2, '[{"id": "b"}, {"id": ')
    df = sources.read_pages(spark, str(folder))
    assert {(r.page, r.page_failed) for r in df.collect()} >= {(1, False), (2, True)}


def test_line_pages_in_folders(spark, folder):
    for page in (1, 2):
        part = folder / f"page={page}"
        part.mkdir(parents=True)
        (part / "part-0.json").write_text(
            "\n".join(json.dumps(_record(f"{page}-{i}")) for i in range(3))
        )
    df = sources.read_pages(spark, str(folder), multi_line=False)
    assert sorted((r.page, r.id) for r in df.collect()) == [(p, f"{p}-{i}") for p in (1, 2) for i in range(3)]


def test_no_files(spark, folder):
    folder.mkdir()
    df = sources.read_pages(spark, str(folder))
    assert df.columns[: len(schemas.RAW)] == schemas.RAW.names
    assert df.count() == 0


@pytest.mark.parametrize(
    ("pages", "total", "expected"),
    [
        ([(1, False), (2, False), (4, False)], 10, (3, 2, True)),
        ([(1, False), (2, False), (4, False)], None, (3, 2, True)),
        ([(1, False), (2, False), (3, False)], 3, (4, 3, False)),
        ([(1, False), (2, False), (3, False)], None, (4, 3, False)),
        ([(1, False), (2, False), (3, False)], 2, (3, 2, False, True)),
        ([(1, False), (2, False), (3, False)], 10, (4, 3, True)),
        ([(1, False), (2, False), (2, True), (3, False)], None, (2, 1, True)),
        ([(1, True), (2, False)], None, (1, 0, True)),
        ([(2, False)], None, (1, 0, True)),
        ([(0, False), (1, False), (1, False)], 1, (2, 1, False)),
        ([], None, (1, 0, False)),
        ([], 10, (1, 0, True)),
    ],
)
def test_page_boundary(spark, pages, total, expected):
    df = spark.createDataFrame(pages, "page long, page_failed boolean")
    boundary = sources.page_boundary(df, total)
    # boundary, pages read, broken, truncated, rows without a number
    wanted = expected if len(expected) == 4 else (*expected, expected[2])
    assert tuple(boundary.first()) == (*wanted, 0, sum(p < 1 for p, _ in pages))
    kept = sources.keep_page_prefix(df, boundary)
    assert sorted(r.page for r in kept.collect()) == sorted(p for p, _ in pages if p < expected[0])


def test_all_pages_by_default_and_a_later_first_page(spark):
    df = spark.createDataFrame([(p, False) for p in [None, *range(1, 14)]], "page long, page_failed boolean")
    assert tuple(sources.page_boundary(df).first()) == (14, 13, False, False, 1, 0)
    assert tuple(sources.page_boundary(df, first_page=5).first()) == (14, 9, False, False, 1, 4)
    assert tuple(sources.page_boundary(df, first_page=15).first()) == (15, 0, False, False, 1, 13)


def test_numbers_are_taken_from_the_file_or_its_page_folder_only(spark, folder):
    _page(folder, 1, [_record("a")])
    (folder / "extra.json").write_text(json.dumps([_record("b")]))
    other = folder / "in"
    (other / "page=7").mkdir(parents=True)
    (other / "page=7" / "part-3.json").write_text(json.dumps([_record("c")]))
    rows = sources.read_pages(spark, f"{folder}/*.json").unionByName(sources.read_pages(spark, str(other)))
    assert {(r.id, r.page) for r in rows.collect()} == {("a", 1), ("b", None), ("c", 7)}
    assert {r.page for r in sources.list_pages(spark, str(folder)).collect()} == {1, 7, None}


def test_path_steps():
    assert path_steps("$['a']['b c']") == ["a", "b c"]
    assert path_steps("$.a.b_1") == ["a", "b_1"]
    for bad in ("a", "$", "$[0]", "$['a'][*]"):
        with pytest.raises(ValueError):
            path_steps(bad)
    with pytest.raises(ValueError):
        sources.mapping_schema({"$['a']": "x", "$['a']['b']": "y"})


def test_map_json(spark):
    text = '{"a": {"b": 1.50, "c": [1, 2]}, "d": "x", "e f": true}'
    df = spark.createDataFrame([(1, text), (2, "{}"), (3, None), (4, "no json")], "k int, j string")
    mapping = {"$['a']['b']": "ab", "$['a']['c']": "ac", "$['d']": "d", "$['e f']": "ef", "$.zz": "zz"}
    rows = {r.k: tuple(r)[2:] for r in sources.map_json(df, "j", mapping).collect()}
    # A number's text is its value: Spark writes it without the trailing zero.
    assert rows[1] == ("1.5", "[1,2]", "x", "true", None)
    assert rows[2] == rows[3] == rows[4] == (None,) * 5


def test_copy_mapping_has_the_sixteen_fields(spark, folder):
    _page(folder, 1, [{"id": 1, "state_province": "Iowa", "address_1": "x", "other": 1}])
    df = sources.read_mapped_json(spark, str(folder))
    assert df.schema == schemas.LANDING and len(df.columns) == 16
    row = df.first()
    assert (row.id, row.state_province, row.address_1, row.phone) == ("1", "Iowa", "x", None)


def test_newer_than(spark):
    source = spark.range(10).selectExpr("id", "timestamp_seconds(id DIV 2) AS ts")
    source = source.unionByName(spark.createDataFrame([(10, None), (11, None)], source.schema))
    # Row 7 has the mark's own stamp and came late; row 10 has no stamp and is known.
    done = source.filter("id <= 6 OR id = 10")
    new = sources.newer_than(source, done, "ts", ["id"])
    assert sorted(r.id for r in new.collect()) == [7, 8, 9, 11]
    assert sources.newer_than(source, done.limit(0), "ts", ["id"]).count() == 12


def test_a_landing_run_has_a_folder_of_its_own(spark, folder, tmp_path):
    landing, mark = str(tmp_path / "landing"), str(tmp_path / "mark")
    _page(folder, 1, [_record("a")])
    first = land_new_pages(spark, str(folder), landing, mark, run_id="r1")
    _page(folder, 2, [_record("b")])
    second = land_new_pages(spark, str(folder), landing, mark, run_id="r2")
    assert [[r.id for r in spark.read.parquet(p).collect()] for p in (first, second)] == [["a"], ["b"]]


def test_streamed_landing_takes_each_file_once(spark, folder, tmp_path):
    landing, mark = str(tmp_path / "landing"), str(tmp_path / "mark")

    def land():
        land_new_pages(spark, str(folder), landing, mark, max_files_per_batch=1)
        rows = sources.read_layer(spark, landing, schemas.struct_of("id")).collect()
        return sorted(r.id for r in rows)

    _page(folder, 1, [_record("a")])
    _page(folder, 2, [_record("b")])
    assert land() == ["a", "b"]
    assert land() == ["a", "b"]
    _page(folder, 3, [_record("c"), _record("d")])
    assert land() == ["a", "b", "c", "d"]


def _most_tasks(spark, group):
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    return max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s))


def _many_pages(spark, path, number):
    sources.write_pages(spark.range(number).select(F.col("id").cast("string").alias("id"), (F.col("id") + 1).alias("page")), path)


def test_many_folders_are_listed_by_some_tasks_a_core(spark, tmp_path):
    path, cores = str(tmp_path / "pages"), spark.sparkContext.defaultParallelism
    number = 5 * cores
    _many_pages(spark, path, number)
    for name, read in (("read", lambda: sources.read_pages(spark, path, multi_line=False)), ("list", lambda: sources.list_pages(spark, path))):
        spark.sparkContext.setJobGroup(f"{name}-pages", name)
        try:
            rows = read()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert _most_tasks(spark, f"{name}-pages") <= 4 * cores
        assert sorted(r.page for r in rows.select("page").collect()) == list(range(1, number + 1))
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"


def test_a_stream_of_many_folders_is_listed_by_some_tasks_a_core(spark, tmp_path, monkeypatch):
    path, cores = str(tmp_path / "pages"), spark.sparkContext.defaultParallelism
    _many_pages(spark, path, 5 * cores)
    started, start = [], DataStreamWriter.start

    def keep(self, *args, **options):
        started.append(start(self, *args, **options))
        return started[-1]

    monkeypatch.setattr(DataStreamWriter, "start", keep)
    landing = land_new_pages(spark, path, str(tmp_path / "landing"), str(tmp_path / "mark"), multi_line=False)
    assert spark.read.parquet(landing).count() == 5 * cores
    assert _most_tasks(spark, str(started[0].runId)) <= 4 * cores


def test_page_files_stand_alone(spark, tmp_path):
    path = tmp_path / "pages"
    _many_pages(spark, str(path), 3)
    assert [len(list((path / f"page={n}").iterdir())) for n in (1, 2, 3)] == [1, 1, 1]
    rows = sources.read_pages(spark, str(path), multi_line=False)
    assert sorted((r.id, r.page) for r in rows.collect()) == [("0", 1), ("1", 2), ("2", 3)]


# --- many files ------------------------------------------------------------------------

ODD_LINES = [
    b'{"id": "1", "name": 2.50, "unknown": [1]}',
    b"",
    b"  \t",
    b'\t {"id": {"a": [1, 2]}, "id2": 1}',
    b'{"id" : -0, "name":1e400}',
    b'{"id":00, "name": 1.0}',
    b'{"id": 12345678901234567890123, "name" : 1.50 }',
    b"{'id': 1.10, 'na\\u006de': {'a' :  'x}', \"b\": [ 1.0 , null]}}",
    b'{"id": 1.0, "id": "\\"id\\": 1.0", "name": false, "x": {}}',
    b'{"id": "k", "name": NaN}',
    b'{"id": 5 , "name": [ ] } ',
    b'{"id": 1.0,}',
    b'[{"id": 1.0, "name": {"z" :1}} , {"name": 2.0}, {}]',
    b'[{"id": "a"}, {"id": "b", "name": null}]',
    b' [{"id": "c"}]',
    b"[]",
    b"[1]",
    b"[null]",
    b'[{"id": "d"}, {"id": ',
    b'{"id": "e", ',
    b'{"id": "f", "name": {"x": ',
    b"null",
    b"7",
    b'"text"',
    b"no json",
    b"\x01",
    b'{"id": "g"} and more',
    '{"id": "\u00e9\u4e2d\U0001f600"}'.encode(),
    b'{"id": "\xff\xfe"}',
    b'{"_corrupt_record": "x", "id": "h"}',
    b"{}",
]


def _as_spark(spark, path, fields):
    reader = spark.read.schema(pages._page_schema(fields)).option("columnNameOfCorruptRecord", "_corrupt_record")
    return pages._with_page(reader.json(path), fields)


def _sorted(rows):
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("end", [b"\n", b"\r\n", b"\r"])
def test_lines_are_parsed_as_by_the_reader_of_files(spark, folder, end):
    (folder / "page=1").mkdir(parents=True)
    (folder / "page=2").mkdir()
    (folder / "page=1" / "a.json").write_bytes(b"\xef\xbb\xbf" + end.join(ODD_LINES))
    (folder / "page=2" / "b.json").write_bytes(end.join(ODD_LINES[::-1]) + end)
    (folder / "page=2" / "c.json.gz").write_bytes(gzip.compress(end.join(ODD_LINES)))
    (folder / "page=2" / "_left_out").write_bytes(ODD_LINES[0])
    (folder / "page=2" / "empty").write_bytes(b"")
    fields = schemas.struct_of("id name")
    rows = sources.read_pages(spark, str(folder), fields, multi_line=False)
    wanted = _as_spark(spark, str(folder), fields)
    assert rows.schema == wanted.schema
    assert _sorted(rows) == _sorted(wanted)
    assert rows.filter("NOT page_failed").count() > 20 < rows.filter("page_failed").count()


def test_the_driver_holds_no_page_file(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "pages")
    _many_pages(spark, path, 7)
    listed = sources.list_page_files(spark, path)

    def held(*args, **options):
        raise AssertionError("the files are listed on the driver")

    rows = sources.read_pages(spark, path, multi_line=False)
    monkeypatch.setattr(pages, "read_pages", held)
    for found in (rows, sources.list_pages(spark, path), sources.read_page_files(spark, listed, multi_line=False)):
        assert not [f for f in found.inputFiles() if "page=" in f]
        assert sorted(r.page for r in found.select("page").collect()) == list(range(1, 8))


def test_only_files_that_spark_reads_of_a_folder(spark, folder):
    (folder / "in" / "page=7").mkdir(parents=True)
    (folder / "page-1.json").write_text('{"id": "a"}\n')
    (folder / "other").mkdir()
    (folder / "other" / "page-2.json").write_text('{"id": "b"}\n')
    (folder / "in" / "page=7" / "x.json").write_text('{"id": "c"}\n')
    (folder / "in" / "page-3.json").write_text('{"id": "d"}\n')
    fields = schemas.struct_of("id")
    for path in (folder / "other", folder / "in"):
        assert _sorted(sources.read_pages(spark, str(path), fields, False)) == _sorted(_as_spark(spark, str(path), fields))
    assert {r.page for r in sources.list_pages(spark, str(folder)).collect()} == {1, 2, 3, 7}


def test_each_line_lies_in_one_part(tmp_path):
    draw, path = random.Random(3), tmp_path / "f"
    for _ in range(150):
        data = b"".join(draw.choice([b"a", b"bc", b"\n", b"\r", b"\r\n"]) for _ in range(draw.randrange(1, 30)))
        path.write_bytes(data)
        whole = [x for x in files._split(data) if x]
        for size in (1, 2, 3, 7, 50):
            parts = [files.lines_of(str(path), at, min(len(data), at + size)) for at in range(0, len(data), size)]
            assert [x for part in parts for x in part if x] == whole, (data, size)


def test_large_pages_are_read_in_parts(spark, folder, monkeypatch):
    monkeypatch.setattr(files, "PART_BYTES", 100)
    (folder / "page=1").mkdir(parents=True)
    (folder / "page=1" / "x.json").write_text("".join(json.dumps({"id": str(n), "name": "n" * (n % 300)}) + "\n" for n in range(500)))
    rows = sources.read_pages(spark, str(folder), schemas.struct_of("id name"), False)
    assert sorted((int(r.id), len(r.name), r.page) for r in rows.collect()) == [(n, n % 300, 1) for n in range(500)]


def test_page_folders_are_those_of_sparks_writer(spark, tmp_path):
    values = [None, "", "a b", "x/y", "50%", "p=q", "{[^]}'\"", "\u00e9", "\t", "z"]
    rows = spark.createDataFrame([(v, str(n), n if n % 2 else None) for n, v in enumerate(values * 3)], "page string, id string, n int")
    ours, theirs = tmp_path / "ours", tmp_path / "theirs"
    sources.write_pages(rows, str(ours))
    sources.write_pages(rows, str(ours), "append")
    rows.write.partitionBy("page").json(str(theirs))
    content = lambda at, copies: {f.name: sorted("".join(x.read_text() for x in f.glob("part-*")).splitlines() * copies) for f in at.iterdir() if f.is_dir()}
    assert content(ours, 1) == content(theirs, 2)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sources.write_pages(rows, str(ours))
    # They are not made by Hadoop, whose writer numbers the files of a task.
    assert not list(ours.rglob("*-c000*")) and not list(ours.glob("page=*/.*")) and not list(ours.glob("_staging*"))


def test_a_failed_write_leaves_no_page(spark, tmp_path):
    rows = spark.range(100).selectExpr("id + 1 AS page", "if(id = 77, raise_error('broken'), string(id)) AS id")
    with pytest.raises(Exception, match="broken"):
        sources.write_pages(rows, str(tmp_path / "pages"))
    assert not list(tmp_path.rglob("page=*")) and not list(tmp_path.rglob("_staging*"))

def _land(spark, tmp_path, **options):
    path = land_new_pages(spark, str(tmp_path / "pages"), str(tmp_path / "landing"), str(tmp_path / "mark"), schemas.struct_of("id"), False, **options)
    return sorted(int(r.id) for r in spark.read.parquet(path).select("id").collect())


def test_a_landing_stream_notes_its_files_instead_of_holding_them(spark, tmp_path):
    path = str(tmp_path / "pages")
    _many_pages(spark, path, 5)
    assert _land(spark, tmp_path, run_id="r1", max_files_per_batch=2) == list(range(5))
    assert sorted(p.name for p in (tmp_path / "landing" / "run_id=r1").iterdir()) == ["batch=0", "batch=1", "batch=2"]
    log = [f.read_text() for f in (tmp_path / "mark" / "sources" / "0").iterdir() if f.name.isdigit()]
    assert log and not any("page=" in text for text in log)
    rows = spark.createDataFrame([("7", 3), ("8", 9)], "id string, page long")
    sources.write_pages(rows, path, "append")
    assert _land(spark, tmp_path, run_id="r2") == [7, 8]
    assert spark.read.parquet(str(tmp_path / "mark" / "page-files")).count() == 7
    with pytest.raises(ValueError, match="another form"):
        land_new_pages(spark, path, str(tmp_path / "landing"), str(tmp_path / "mark"))


def test_a_checkpoint_without_notes_goes_on(spark, tmp_path):
    path = str(tmp_path / "pages")
    _many_pages(spark, path, 3)
    rows = sources.stream_pages(spark, path, schemas.struct_of("id"), False)
    writer = rows.writeStream.option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True)
    writer.format("parquet").option("path", str(tmp_path / "landing")).start().awaitTermination()
    sources.write_pages(spark.createDataFrame([("8", 9)], "id string, page long"), path, "append")
    assert _land(spark, tmp_path) == [0, 1, 2, 8]
    assert not (tmp_path / "mark" / "page-files").exists()
