"""Parquet layers, catalog tables and compaction."""

import glob

import pytest
from pyspark.sql import functions as F

from terrace import plans, schemas, sinks, sources
from terrace.session import scratch_dir
from terrace.sinks.zorder import cell_edges, cell_number, interleaved

SCHEMA = schemas.struct_of("id state")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("1", "01"), ("2", "1"), ("3", ""), ("4", None)]
    sinks.write_layer(spark.createDataFrame(rows, SCHEMA), path, by=["state"])
    # An empty and a missing state share a folder and both come back missing.
    assert _rows(sources.read_layer(spark, path, SCHEMA)) == [("1", "01"), ("2", "1"), ("3", None), ("4", None)]
    sinks.create_namespaces(spark)
    sinks.create_namespaces(spark)
    sinks.publish_table(spark, "silver.sink_test", "r1", path, SCHEMA, by=["state"])
    assert _rows(spark.table("spark_catalog.silver.sink_test"))[0] == ("1", "01")
    one = spark.table("silver.sink_test").filter("state = '01'")
    assert "PartitionFilters: [isnotnull(state" in one._jdf.queryExecution().executedPlan().toString()


def test_publish_moves_to_the_new_run_and_keeps_the_old_files(spark, tmp_path):
    sinks.create_namespaces(spark)
    for run, n in (("r1", 3), ("r2", 5)):
        path = str(tmp_path / run)
        sinks.write_layer(spark.range(n).toDF("id"), path)
        sinks.publish_table(spark, "gold.run_test", run, path, spark.range(1).toDF("id").schema)
        assert spark.sql("SELECT count(*) FROM gold.run_test").first()[0] == n
    assert spark.table("gold.run_test__r1").count() == 3


def test_publishing_again_leaves_the_table_under_the_view(spark, tmp_path):
    sinks.create_namespaces(spark)
    schema = spark.range(1).toDF("id").schema
    for run in ("2026-12-04", "2026-12-05", "2026-12-04"):
        path = str(tmp_path / run)
        if not glob.glob(path):
            sinks.write_layer(spark.range(int(run[-1])).toDF("id"), path)
        sinks.publish_table(spark, "gold.dated_test", run, path, schema)
        assert spark.table("gold.dated_test").count() == int(run[-1])
    assert spark.table("gold.dated_test__2026_x2d_12_x2d_05").count() == 5


def test_a_run_id_is_used_once(spark, tmp_path):
    sinks.write_layer(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_layer(spark.range(4), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_compaction_splits_a_hot_folder_without_clustering(spark, tmp_path):
    df = spark.range(20_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.when(F.col("id") % 10 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("state"),
    )
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    sinks.write_layer(df, source, by=["state"])
    assert sinks.compact(spark, source, target, SCHEMA, ["state"], file_bytes=100_000) > 8
    assert len(glob.glob(f"{target}/state=hot/*.parquet")) > 5
    assert sources.read_layer(spark, target, SCHEMA).exceptAll(df).isEmpty()



def test_one_file_per_small_partition(spark, tmp_path):
    df = spark.range(1000, numPartitions=8).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 10).cast("string").alias("state")
    )
    sinks.write_layer(df, str(tmp_path / "a"), by=["state"])
    sinks.write_layer(df, str(tmp_path / "b"), by=["state"], rebalance=False)
    assert len(glob.glob(f"{tmp_path}/a/*/*.parquet")) == 10
    assert len(glob.glob(f"{tmp_path}/b/*/*.parquet")) == 80


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(60_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("state"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        sinks.write_layer(df, str(tmp_path / "t"), by=["state"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/t/state=hot/*.parquet")) > 2
    assert sources.read_layer(spark, str(tmp_path / "t"), SCHEMA).count() == 60_000


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    df = spark.range(4000, numPartitions=8).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 5).cast("string").alias("state")
    )
    small, big = str(tmp_path / "small"), str(tmp_path / "big")
    sinks.write_layer(df, small, by=["state"], rebalance=False)
    assert sinks.compact(spark, small, big, SCHEMA, ["state"], ["id"]) == 1
    assert len(glob.glob(f"{small}/*/*.parquet")) == 40
    assert len(glob.glob(f"{big}/*/*.parquet")) == 5
    before, after = (sources.read_layer(spark, p, SCHEMA) for p in (small, big))
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
    split = sinks.compact(spark, small, str(tmp_path / "split"), SCHEMA, ["state"], ["id"], file_bytes=8000)
    assert split > 3
    assert sources.read_layer(spark, str(tmp_path / "split"), SCHEMA).count() == 4000
    flat = sinks.compact(spark, small, str(tmp_path / "flat"), SCHEMA)
    assert flat == 1 and len(glob.glob(f"{tmp_path}/flat/*.parquet")) == 1


def test_scans_prune_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, state string, name string")
    sinks.write_layer(df, path, by=["state"])
    scan = sources.read_layer(spark, path, df.schema).filter("state = 'a' AND id = '1'").select("id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "(state#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(id,1)" in plan and "ReadSchema: struct<id:string>" in plan


def test_scratch_lies_under_the_shared_folder():
    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    shared = Session(spark_checkpoint_dir="hdfs://shared/", spark_master="yarn")
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs://shared/terrace/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(spark_master="yarn"), "x")


def test_sql_on_published_gold_equals_the_kpis(spark, tmp_path):
    rows = [("n1", "micro", "s1", "c", "x", 3), ("n2", "micro", "s1", "c", "x", 1), ("n3", "pub", "s2", "c", "x", 2)]
    gold = spark.createDataFrame(
        rows, "name string, category string, state string, country string, city string, entity_count long"
    )
    path = str(tmp_path / "gold")
    sinks.write_layer(gold, path)
    sinks.create_namespaces(spark)
    sinks.publish_table(spark, "gold.kpi_test", "r1", path, gold.schema)
    table = spark.table("gold.kpi_test")
    by_state = spark.sql("SELECT state, sum(entity_count) n FROM gold.kpi_test GROUP BY state ORDER BY n DESC")
    assert by_state.collect() == plans.total_by(table, "state", out="n").collect()


@pytest.fixture(scope="module")
def gold(spark):
    rows = [
        ("b", "pub", "s1", "c", "x", 2),
        ("a", "pub", "s1", "c", "x", 2),
        ("c", "micro", "s1", "c", "x", 2),
        ("d", "micro", "s2", "c", "x", 1),
        ("e", "pub", "s2", "c", "x", 3),
        ("f", "pub", None, "c", "x", 4),
    ]
    return spark.createDataFrame(
        rows, "name string, category string, state string, country string, city string, entity_count long"
    )


def test_kpi_orders_and_ties(gold):
    assert [tuple(r) for r in plans.total_by(gold, "state").collect()] == [("s1", 6), (None, 4), ("s2", 4)]
    assert [tuple(r) for r in plans.total_by(gold, "category").collect()] == [("pub", 11), ("micro", 3)]
    assert [tuple(r) for r in plans.states_for_category(gold, "micro").collect()] == [("s1", 2), ("s2", 1)]
    shares = [tuple(r) for r in plans.share_within_state(gold, extra=["name"]).collect()]
    assert shares == [
        (None, "pub", "f", 4, 100.0),
        ("s1", "micro", "c", 2, 33.33),
        ("s1", "pub", "a", 2, 33.33),
        ("s1", "pub", "b", 2, 33.33),
        ("s2", "pub", "e", 3, 75.0),
        ("s2", "micro", "d", 1, 25.0),
    ]
    # In s1 the counts tie at the gold grain, so the first category wins there.
    assert [tuple(r) for r in plans.popular_categories(gold).collect()] == [("pub", 7, 2), ("micro", 2, 1)]
    summed = plans.category_grain(gold)
    assert [tuple(r) for r in plans.popular_categories(summed).collect()] == [("pub", 11, 3)]


# --- Z-order --------------------------------------------------------------------------


def _row_groups(path, column, value):
    """Row groups whose least and largest value allow the value, and all of them."""
    import pyarrow.parquet as pq

    may = n = 0
    for file in sorted(glob.glob(f"{path}/**/*.parquet", recursive=True)):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(at).statistics
            n += 1
            may += stats.min <= value <= stats.max
    return may, n


def test_zorder_leaves_out_row_groups_on_every_column(spark, tmp_path):
    schema = schemas.struct_of("a b c note", {"a": schemas.LongType(), "c": schemas.DoubleType()})
    df = spark.range(60_000, numPartitions=4).select(
        F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("a"),
        F.format_string("%05d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000))).alias("b"),
        F.rand(3).alias("c"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    source, z, lexicographic = (str(tmp_path / n) for n in ("source", "z", "lex"))
    sinks.write_layer(df, source)
    assert sinks.zorder(spark, source, z, schema, ["a", "b", "c"], file_bytes=60_000) > 60
    sinks.compact(spark, source, lexicographic, schema, cluster_by=["a", "b", "c"], file_bytes=60_000)
    before, after = (spark.read.schema(schema).parquet(p) for p in (source, z))
    assert before.exceptAll(after).isEmpty() and after.count() == 60_000
    for column, value in (("b", "05000"), ("c", 0.5)):
        (may, n), (plain, plain_n) = _row_groups(z, column, value), _row_groups(lexicographic, column, value)
        assert may / n < 0.5 * plain / plain_n
    # The first column of a sort is read least there; here it is no worse than the others.
    may, n = _row_groups(z, "a", 5_000)
    assert may / n < 0.5


def test_zorder_with_gaps_ties_and_one_value(spark, tmp_path):
    rows = [(None, "x", "s1"), ("a", None, "s1"), *[("hot", "hot", "s2")] * 3_000, ("b", "y", None)]
    schema = schemas.struct_of("a b state")
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    sinks.write_layer(spark.createDataFrame(rows, schema).repartition(3), source, by=["state"])
    sinks.zorder(spark, source, target, schema, ["a", "b"], ["state"], file_bytes=1_000)
    got = sources.read_layer(spark, target, schema)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)
    sinks.write_layer(spark.createDataFrame([], schema), str(tmp_path / "none"))
    sinks.zorder(spark, str(tmp_path / "none"), str(tmp_path / "out"), schema, ["a", "b"])
    assert spark.read.schema(schema).parquet(str(tmp_path / "out")).count() == 0


def test_cells_and_codes(spark):
    df = spark.range(1_000).select(F.col("id").alias("v"))
    edges = cell_edges(df, ["v"], 2)["v"]
    assert edges == [250, 500, 750]
    got = df.groupBy(cell_number("v", edges).alias("cell")).count().orderBy("cell").collect()
    assert [tuple(r) for r in got] == [(0, 250), (1, 250), (2, 250), (3, 250)]
    code = spark.range(1).select(interleaved([F.lit(0b10), F.lit(0b11)], 2)).first()[0]
    assert code == 0b1101
