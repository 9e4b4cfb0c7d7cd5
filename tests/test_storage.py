import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from saleslens.errors import QualityGateError, SchemaValidationError, SinkError, SourceError
from saleslens.operators.quality import quality_summary
from saleslens.operators.rollups import category_rollup
from saleslens.plans import catalog
from saleslens.plans.pipeline import GOLD, load_validated, run_pipeline
from saleslens.schema import SOURCE_COLUMNS
from saleslens.session import FREE_SHUFFLES, freed_shuffles
from saleslens.sources import files, layers, sinks
from saleslens.sources.dirt import dirty_raw
from saleslens.sources.star import TABLES, sales_wide, silver
from tests.conftest import TESTDATA, values


@pytest.fixture
def raw_csv(raw, tmp_path):
    return sinks.save_results(files.source_columns(raw), str(tmp_path / "raw.csv"), "csv")


def test_raw_file_round_trip(spark, raw, raw_csv):
    back = files.read_raw(spark, raw_csv)
    assert back.columns == raw.columns
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_raw_texts_survive_quotes_blanks_and_column_order(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text('Sales,Product Name,Extra,Region\n1.5,"a ""b"", c",1, East \nNA,x,2,\n')
    back = files.read_raw(spark, str(path))
    assert back.columns == ["sales", "product_name", "extra", "region"]
    assert values(back, *back.columns) == [("1.5", 'a "b", c', "1", " East "), (None, "x", "2", None)]


def test_source_errors(spark, tmp_path):
    with pytest.raises(SourceError, match="nothing to read"):
        files.read_table(spark, str(tmp_path / "none.parquet"))
    with pytest.raises(SourceError, match="no reader"):
        files.read_table(spark, str(tmp_path / "data.xlsx"))


def test_load_validated(spark, raw, raw_csv, tmp_path):
    frame, reports = load_validated(spark, raw_csv)
    assert frame.count() == 11 and reports["dates"].count() == 2
    bad = sinks.save_results(files.source_columns(raw.drop("sales")), str(tmp_path / "bad.csv"), "csv")
    with pytest.raises(SchemaValidationError):
        load_validated(spark, bad)


def test_names_map_both_ways(raw):
    assert files.source_columns(raw).columns == SOURCE_COLUMNS
    assert files.sanitize_columns(files.source_columns(raw)).columns == raw.columns


def test_sinks(spark, lines, tmp_path):
    rollup = category_rollup(lines)
    path = sinks.write_gold("category", rollup, str(tmp_path))
    gold = files.read_gold(spark, path, rollup.schema)
    assert values(gold, *gold.columns) == values(rollup, *rollup.columns)
    with pytest.raises(SinkError):
        sinks.save_results(rollup, str(tmp_path / "x"), "xlsx")
    with pytest.raises(SinkError):
        sinks.save_results(rollup, str(tmp_path / "x"), "delta")


def test_round_trip_check_finds_changes(lines, tmp_path):
    path = sinks.write_silver(lines, str(tmp_path / "silver"))
    assert sinks.verify_roundtrip(lines, path).first().matches
    changed = lines.withColumn("quantity", F.expr("if(row_id = 1, 99, quantity)"))
    row = sinks.verify_roundtrip(changed, path).first()
    assert (row.rows_lost, row.rows_added, row.matches) == (1, 1, False)
    assert not sinks.verify_roundtrip(lines.drop("city"), path).first().matches


def test_partitioned_table_prunes(spark, lines, tmp_path):
    table = sinks.write_partitioned(lines, "lines_test", str(tmp_path / "table"))
    assert "lines_test" in sinks.list_tables(spark)
    paper = spark.table("lines_test").where("category = 'Paper'")
    assert table.count() == 10 and paper.count() == 4
    plan = paper._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan
    spark.sql("DROP TABLE lines_test")


def test_compaction_keeps_rows_and_splits_hot_keys(spark, lines, tmp_path):
    source = sinks.write_silver(lines.repartition(8), str(tmp_path / "many"))
    target = sinks.compact(spark, source, str(tmp_path / "one"))
    compacted = spark.read.parquet(target)
    assert compacted.exceptAll(lines).count() == 0 and len(compacted.inputFiles()) == 1
    hot = lines.withColumns({"category": F.lit("a"), "region": F.lit("b")})
    source = sinks.write_silver(hot, str(tmp_path / "hot"))
    size = sinks.stored_bytes(spark, source)
    target = sinks.compact(spark, source, str(tmp_path / "split"), file_bytes=size // 4)
    assert len(spark.read.parquet(target).inputFiles()) >= 3


def test_compaction_bounds_what_a_task_sorts(spark, tmp_path):
    rows = spark.range(100_000).selectExpr("'c' AS category", "'r' AS region", "concat('o', id % 7919) AS order_id")
    source = sinks.write_silver(rows, str(tmp_path / "even"))
    compacted = spark.read.parquet(sinks.compact(spark, source, str(tmp_path / "bounded"), sort_bytes=2 * 2**20))
    held = [r["count"] for r in compacted.groupBy(F.input_file_name()).count().collect()]
    assert sum(held) == 100_000 and max(held) < 100_000 // 2


def test_snapshots(spark, lines, tmp_path):
    path = str(tmp_path / "versions")
    sinks.write_snapshot(lines, path, 0)
    sinks.write_snapshot(lines.where("is_loss"), path, 1)
    sinks.write_snapshot(lines.where("not is_loss"), path, 1)
    assert sinks.read_version(spark, path, 0).exceptAll(lines).count() == 0
    assert values(sinks.history(spark, path), "snapshot_id", "rows") == [(1, 8), (0, 10)]
    with pytest.raises(SourceError):
        sinks.read_version(spark, path, 7)


def test_layers(spark, lines, tmp_path):
    paths = layers.layer_paths(f"file:{tmp_path}/lake")
    assert paths["gold"] == f"file:{tmp_path}/lake/gold"
    assert layers.layer_paths(layers.azure_base("acct", "box"))["silver"] == "abfss://box@acct.dfs.core.windows.net/silver"
    sinks.write_silver(lines.coalesce(1), f"{paths['silver']}/lines")
    sinks.write_gold("kpi", category_rollup(lines).coalesce(1), paths["gold"])
    rows = layers.layer_rows(spark, f"file:{tmp_path}/lake")
    assert values(rows, "layer", "rows") == [("bronze", 0), ("dashboard", 0), ("gold", 3), ("silver", 10)]
    inventory = layers.layer_inventory(spark, f"file:{tmp_path}/lake")
    assert values(inventory, "layer", "files") == [("bronze", 0), ("dashboard", 0), ("gold", 1), ("silver", 1)]
    assert all((r.bytes > 0) == (r.files > 0) for r in inventory.collect())


def test_layers_below_a_folder_of_the_same_name(spark, lines, tmp_path):
    base = f"{tmp_path}/lake/gold/lake"
    sinks.write_silver(lines.coalesce(1), f"{base}/silver/lines")
    sinks.write_silver(lines.coalesce(1), f"{base}/output/charts/lines")
    inventory = layers.layer_inventory(spark, base)
    assert values(inventory.where("files > 0"), "layer", "files") == [("silver", 1)]
    blobs = layers.layer_inventory(spark, base, layers.BLOB_LAYERS)
    assert values(blobs.where("files > 0"), "layer", "files") == [("charts", 1)]


@pytest.mark.parametrize("text", ["Sales,Profit\n1,2,3\n", "Sales,Profit\n1\n"])
def test_rows_with_too_many_or_few_fields_stop_the_read(spark, tmp_path, text):
    (tmp_path / "odd.csv").write_text(text)
    for multi_line in (True, False):
        frame = files.read_raw(spark, str(tmp_path / "odd.csv"), multi_line=multi_line)
        with pytest.raises(Exception, match="(?i)malformed"):
            frame.select("sales").collect()


def test_files_with_other_column_orders_stop_the_read(spark, tmp_path):
    folder = tmp_path / "raw.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Row ID,Sales,Profit\n1,10,2\n")
    (folder / "b.csv").write_text("Row ID,Profit,Sales\n2,3,20\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_raw(spark, str(folder)).select("sales").collect()


def test_compressed_files_are_counted_and_read_whole(spark, raw, tmp_path, monkeypatch):
    """Texts with line breaks and quotes come back, and no compressed file holds more rows than one task should read."""
    monkeypatch.setattr(sinks, "ROWS_OF_COMPRESSED", 4)
    odd = raw.withColumn("city", F.concat(F.lit('a "b",\n'), "city"))
    path = sinks.save_results(files.source_columns(odd.coalesce(1)), f"{tmp_path}/lake/bronze/lines", "csv", "lz4")
    held = [line.count() for line in (files.read_table(spark, f, "csv", multiLine=True) for f in spark.read.text(path).inputFiles())]
    assert sorted(held) == [3, 4, 4]
    back = files.read_raw(spark, path)
    assert back.exceptAll(odd).isEmpty() and odd.exceptAll(back).isEmpty()
    rows = {r.layer: r.rows for r in layers.layer_rows(spark, f"file:{tmp_path}/lake").collect()}
    assert rows["bronze"] == 11


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    """Values stay the same, and the other files are split among tasks."""
    folder = tmp_path / "raw x.csv"
    folder.mkdir()
    plain = "".join(f'{i},"a ""b"" {i}",{i}\n' for i in range(400))
    (folder / "a b.csv").write_text("Row ID,Product Name,Sales\n" + plain)
    (folder / "c.csv").write_text('Row ID,Product Name,Sales\n900,"two\nlines",1\n901,"three\r\n\nlines",2\n')
    assert [f.rsplit("/", 1)[-1] for f in files.files_with_line_breaks(spark, str(folder))] == ["c.csv"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        frame = files.read_raw(spark, str(folder))
        assert frame.rdd.getNumPartitions() > 3
        whole = files.read_raw(spark, str(folder), multi_line=True)
        assert whole.rdd.getNumPartitions() <= 2
        rows = {r.row_id: r.product_name for r in frame.collect()}
        assert rows == {r.row_id: r.product_name for r in whole.collect()} and len(rows) == 402
        assert rows["7"] == 'a "b" 7' and rows["900"] == "two\nlines"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_of_equal_tables_are_read_once(spark, lines, tmp_path):
    path = sinks.write_silver(lines, str(tmp_path / "t"))
    compared = sinks.verify_roundtrip(lines, path)
    assert str(tmp_path) not in compared._jdf.queryExecution().toString()
    assert tuple(compared.first()) == (10, 10, len(lines.columns), len(lines.columns), 0, 0, True)


def test_a_version_is_made_from_the_one_before(spark, monkeypatch):
    written = []
    write = sinks.write_snapshot
    monkeypatch.setattr(sinks, "write_snapshot", lambda frame, path, version: written.append(frame) or write(frame, path, version))
    path = catalog._snapshots(spark, f"{TESTDATA}/sf0.001")
    assert "lineitem" not in written[1]._jdf.queryExecution().toString()
    first, second = (sinks.read_version(spark, path, v) for v in (0, 1))
    assert first.count() == silver(spark, f"{TESTDATA}/sf0.001").count()
    assert first.where("not is_loss").exceptAll(second).isEmpty() and second.where("is_loss").isEmpty()


def test_derived_columns_of_a_partitioned_table_are_added_behind_the_shuffle(spark, monkeypatch):
    moved, write = [], sinks.write_partitioned
    monkeypatch.setattr(sinks, "write_partitioned", lambda frame, *a, **k: moved.append(frame.columns) or write(frame, *a, **k))
    found = catalog.queries()["write_partitioned"](spark, f"{TESTDATA}/sf0.001")
    assert "profit_margin" not in moved[0] and "order_year" in moved[0]
    lines = silver(spark, f"{TESTDATA}/sf0.001")
    assert found.agg(F.sum("lines")).first()[0] == lines.count()


def test_line_breaks_survive(spark, tmp_path):
    frame = spark.createDataFrame([("a\nb", 1), ("c", 2)], "product_name string, quantity int")
    gold = files.read_gold(spark, sinks.write_gold("x", frame, str(tmp_path)), frame.schema)
    assert values(gold, *gold.columns) == [("a\nb", 1), ("c", 2)]
    path = sinks.save_results(files.source_columns(frame), str(tmp_path / "raw.csv"), "csv")
    assert values(files.read_raw(spark, path), "product_name", "quantity") == [("a\nb", "1"), ("c", "2")]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_raw(spark, path, multi_line=False).collect()


def test_scratch_is_fresh_and_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = (layers.scratch_folder(spark, "x") for _ in range(2))
    assert first != second
    assert shared is None or first.startswith(shared)


def test_scratch_can_be_cleared(spark, lines):
    path = sinks.write_silver(lines, layers.scratch_folder(spark, "x"))
    layers.clear_scratch(spark)
    with pytest.raises(SourceError):
        files.read_silver(spark, path)
    layers.clear_scratch(spark)


def test_pipeline(spark, raw_csv, tmp_path):
    base = str(tmp_path / "lake")
    with pytest.raises(QualityGateError, match="at least 1000 rows"):
        run_pipeline(spark, raw_csv, base)
    gold = {name: GOLD[name] for name in ("category_performance", "kpi_summary")}
    log = run_pipeline(spark, raw_csv, base, gold, enforce_gate=False)
    assert values(log, "raw_rows", "clean_rows", "total_sales") == [(11, 10, 1750.0)]
    stored = spark.read.option("header", True).csv(f"{base}/gold/category_performance")
    assert stored.count() == 3
    again = run_pipeline(spark, raw_csv, base, gold, enforce_gate=False)
    assert again.count() == 1
    assert run_pipeline(spark, raw_csv, base, gold, enforce_gate=False, run_id="second").count() == 2
    assert spark.read.parquet(f"{base}/bronze/lines").count() == 11
    for name, rows in {"validation/dates": 2, "validation/quality": 21, "gate/basic": 9}.items():
        assert spark.read.option("header", True).csv(f"{base}/gold/{name}").count() == rows


def test_dimension_keys_are_unique_so_no_line_is_lost_or_doubled(spark):
    folder = f"{TESTDATA}/sf0.001"
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    assert sales_wide(spark, folder).count() == lines
    for table, key in {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey", "region": "r_regionkey", "part": "p_partkey"}.items():
        frame = spark.read.parquet(f"{folder}/{table}.parquet")
        assert frame.select(key).distinct().count() == frame.count()


def test_leaving_out_joins_changes_no_value(spark):
    folder = f"{TESTDATA}/sf0.001"
    columns = ["row_id", "product_id", "sales", "profit", "is_loss"]
    few, all_columns = silver(spark, folder, columns), silver(spark, folder).select(*columns)
    assert few.exceptAll(all_columns).count() == 0


@pytest.fixture
def star(spark, tmp_path):
    """Tables of 40 lines in 11 orders; an order, a part and a customer are missing, one part comes twice, one key is null."""
    day = "timestamp_ntz '2021-03-04 00:00:00'"
    values_of = {
        "lineitem": (40, ["id % 11", "if(id = 7, null, id % 6)", "int(id)", "double(id % 5)", "id * 10.25d", "0.05d", day]),
        "orders": (10, ["id", "id % 4", day, "'1-URGENT'"]),
        "customer": (3, ["id", "'Name ' || id", "int(id)", "'HOME'"]),
        "nation": (3, ["int(id)", "'N' || id", "0"]),
        "region": (1, ["int(id)", "'R' || id"]),
        "part": (6, ["greatest(id, 1)", "'P' || id", "'B'", "'T' || id % 2", "id * 1.5d"]),
    }
    for name, (rows, columns) in values_of.items():
        names = [c.split()[0] for c in TABLES[name].split(", ")]
        spark.range(rows).selectExpr(*columns).toDF(*names).write.parquet(f"{tmp_path}/star/{name}.parquet")
    return f"{tmp_path}/star"


def test_orders_are_joined_last(spark, star):
    """Every line once per part row with its key, and the wide columns of orders go through no second shuffle."""
    wide = sales_wide(spark, star)
    assert wide.count() == 40 + spark.read.parquet(f"{star}/lineitem.parquet").where("l_partkey = 1").count()
    assert wide.where("customer_id is null").count() == 3 and wide.where("product_name is null").count() == 7 + 1
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("= o_orderkey") < plan.index("= p_partkey")


def _local_bytes(spark) -> int:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for folder in folders for f in Path(folder).rglob("shuffle_*"))


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    before, setting = _local_bytes(spark), spark.conf.get(FREE_SHUFFLES, None)
    rows = spark.range(200_000).selectExpr("uuid() AS order_id", "'c' AS category", "'r' AS region")
    path = sinks.save_results(rows.repartition(8, "order_id"), str(tmp_path / "t"))
    sinks.compact(spark, path, str(tmp_path / "c"), sort_bytes=2**22)
    for _ in range(40):  # they are deleted in the background
        if _local_bytes(spark) < before + 2**20:
            break
        time.sleep(0.25)
    assert _local_bytes(spark) < before + 2**20
    with freed_shuffles(spark), freed_shuffles(spark):
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert spark.conf.get(FREE_SHUFFLES, None) == setting
    assert spark.read.parquet(str(tmp_path / "c")).count() == 200_000


def test_stored_files_are_small(spark, star, raw_csv, tmp_path):
    base = str(tmp_path / "lake")
    run_pipeline(spark, raw_csv, base, {}, enforce_gate=False)
    stored = [f.name for table in ("bronze/lines", "silver/kept", "silver/lines") for f in Path(base, table).glob("*.parquet")]
    assert stored and all(f.endswith(".zstd.parquet") for f in stored)


def test_raw_files_of_the_queries_are_compressed(spark, star):
    """`load_validated` and `run_pipeline` read the same rows as before from files of a fifth of the size."""
    path = catalog._raw_file(spark, star)
    assert all(f.endswith(".csv.gz") for f in spark.read.text(path).inputFiles())
    back, rows = files.read_raw(spark, path), dirty_raw(spark, star)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    assert load_validated(spark, path)[1]["figures"].where("column = 'rows'").first().figure == rows.count()


def test_quality_summary_shuffles_one_fingerprint_a_row(raw):
    plan = quality_summary(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_print") == 1


def test_compaction_sorts_what_fits_a_task(spark, tmp_path):
    """A task of an executor with 10 GB and 4 cores has about 0.85 GB; rows that take 0.6 GB are not sorted by one."""
    texts = [f"'x' AS t{i}" for i in range(19)]
    rows = spark.range(1_200_000).selectExpr("'c' AS category", "'r' AS region", "string(id) AS order_id", *texts)
    source = sinks.write_silver(rows, str(tmp_path / "wide"))
    compacted = spark.read.parquet(sinks.compact(spark, source, str(tmp_path / "sorted")))
    held = [r["count"] for r in compacted.groupBy(F.input_file_name()).count().collect()]
    assert sum(held) == 1_200_000 and max(held) < 1_000_000


def test_layers_are_made_from_one_star_join(spark, star, monkeypatch):
    written, write = {}, sinks.save_results
    monkeypatch.setattr(sinks, "save_results", lambda frame, path, *a, **k: written.update({path: frame}) or write(frame, path, *a, **k))
    rows = {r.layer: r.rows for r in catalog.queries()["layer_inventory"](spark, star).collect()}
    joined = {path.split("/")[-2] for path, frame in written.items() if "l_orderkey" in frame._jdf.queryExecution().toString()}
    assert len(written) == 3 and joined == {"silver"}
    assert (rows["silver"], rows["bronze"]) == (silver(spark, star).count(), dirty_raw(spark, star).count())
    bronze = files.read_raw(spark, next(path for path in written if "/bronze/" in path))
    wanted = dirty_raw(spark, star)
    assert bronze.exceptAll(wanted).isEmpty() and wanted.exceptAll(bronze).isEmpty()
