"""Sources and sinks: CSV and parquet round trips, the batch job, streaming ingest."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tremor import schema
from tremor.operators import clean as C
from tremor.operators import stats
from tremor.plans.etl import run_etl, run_etl_csv
from tremor.sources import catalog as src
from tremor.sources import fixture, sinks
from tremor.streaming.ingest import start_ingest


def test_csv_round_trip_strings(spark, tmp_dir):
    raw = fixture.raw_catalog(spark, SF_SMALL)
    sinks.export_csv(raw, f"{tmp_dir}/raw")
    back = src.read_raw_csv(spark, f"{tmp_dir}/raw")
    assert all(t == "string" for _, t in back.dtypes)
    assert back.count() == raw.count()
    assert C.clean(back).count() == C.clean(raw).count()
    typed = src.read_typed_csv(spark, f"{tmp_dir}/raw")
    assert dict(typed.dtypes)["Magnitude"] == "double"


def test_catalog_store_partitioned_and_pruned(spark, tmp_dir):
    cat = C.clean(fixture.raw_catalog(spark, SF_SMALL))
    sinks.write_catalog(cat, f"{tmp_dir}/quakes")
    years = sorted(d for d in os.listdir(f"{tmp_dir}/quakes") if d.startswith("Year="))
    assert len(years) == cat.select("Year").distinct().count()
    back = src.read_catalog(spark, f"{tmp_dir}/quakes")
    assert back.count() == cat.count()
    one = back.where(F.col("Year") == 1996)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1996" in plan
    typed = src.read_catalog_of_type(spark, f"{tmp_dir}/quakes")
    assert "PushedFilters: [IsNotNull(Type), EqualTo(Type,Earthquake)]" in typed._jdf.queryExecution().executedPlan().toString()


def test_store_key_dropped(spark, tmp_dir):
    df = spark.createDataFrame([("x", 1)], "_id string, Year int")
    df.write.parquet(f"{tmp_dir}/store")
    assert src.read_catalog(spark, f"{tmp_dir}/store").columns == ["Year"]


def test_points_frame(spark):
    p = src.points_frame(spark, [(1, 35.6762, 139.6503, 10.5)])
    assert p.schema == schema.POINT


def test_batch_job_end_to_end(spark, tmp_dir):
    raw = fixture.raw_training(spark, SF_SMALL)
    feed = fixture.raw_feed(spark, SF_SMALL)
    res = run_etl(spark, raw, feed, f"{tmp_dir}/out")
    freq = spark.read.parquet(res.yearly_path)
    assert sorted(freq.columns) == sorted(["Year", "Counts", "Avg_Magnitude", "Max_Magnitude"])
    cols = ["Year", "Counts", "Avg_Magnitude", "Max_Magnitude"]
    norm = lambda df: sorted((r[0], r[1], round(r[2], 9), r[3]) for r in df.select(*cols).collect())
    assert norm(freq) == norm(stats.yearly_stats(raw))
    cat = spark.read.parquet(res.catalog_path)
    assert sorted(cat.columns) == sorted([*(c.name for c in schema.QUAKE.fields), "Network"])
    assert cat.count() == C.clean(raw).count()
    preds = spark.read.parquet(res.predictions_path)
    assert preds.columns == ["Latitude", "Longitude", "Pred_Magnitude", "Year", "RMSE"]
    assert 0 < res.rmse < 2
    assert src.load_model(res.model_path) is not None


def test_batch_job_from_csv(spark, tmp_dir):
    sinks.export_csv(fixture.raw_training(spark, SF_SMALL), f"{tmp_dir}/db")
    sinks.export_csv(fixture.raw_feed(spark, SF_SMALL), f"{tmp_dir}/q")
    res = run_etl_csv(spark, f"{tmp_dir}/db", f"{tmp_dir}/q", f"{tmp_dir}/out", model_name="LinearRegression")
    assert res.rmse > 0


def test_streaming_ingest_matches_batch(spark, tmp_dir):
    raw = fixture.raw_catalog(spark, SF_SMALL)
    land = f"{tmp_dir}/landing"
    sinks.export_csv(raw.where(F.col("ID") < "eq_5"), f"{land}/part1")
    q = start_ingest(spark, f"{land}/*/*.csv", f"{tmp_dir}/store", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    first = spark.read.parquet(f"{tmp_dir}/store").count()
    sinks.export_csv(raw.where(F.col("ID") >= "eq_5"), f"{land}/part2")
    q = start_ingest(spark, f"{land}/*/*.csv", f"{tmp_dir}/store", f"{tmp_dir}/ckpt")
    q.awaitTermination(120)
    total = spark.read.parquet(f"{tmp_dir}/store").count()
    assert 0 < first < total == C.clean(raw).count()


README_ORDER = ["Date", "Latitude", "Longitude", "Depth", "Magnitude", "Type", "ID"]


def two_rows(spark):
    rows = [("15/01/2023", "35.6762", "139.6503", "10.5", "5.2", "Earthquake", "eq_001"), ("16/01/2023", "1.0", "2.0", "3.0", "4.0", "Earthquake", "eq_002")]
    return spark.createDataFrame(rows, schema.strings(README_ORDER))


def test_csv_columns_bind_by_header_name(spark, tmp_dir):
    sinks.export_csv(two_rows(spark), f"{tmp_dir}/a")
    picked = src.read_raw_csv(spark, f"{tmp_dir}/a", schema.strings(list(reversed(README_ORDER))))
    assert picked.where("ID = 'eq_001' and Latitude = '35.6762'").count() == 1
    assert C.clean(picked).count() == C.clean(src.read_raw_csv(spark, f"{tmp_dir}/a")).count() == 2


def test_csv_missing_column_and_mixed_headers_fail(spark, tmp_dir):
    sinks.export_csv(two_rows(spark).drop("Depth"), f"{tmp_dir}/a")
    with pytest.raises(ValueError, match="Depth"):
        src.read_raw_csv(spark, f"{tmp_dir}/a", schema.strings(README_ORDER))
    sinks.export_csv(two_rows(spark).coalesce(1), f"{tmp_dir}/mixed/one")
    sinks.export_csv(two_rows(spark).coalesce(1).select(*reversed(README_ORDER)), f"{tmp_dir}/mixed/two")
    with pytest.raises(Exception, match="(?i)header"):
        src.read_raw_csv(spark, f"{tmp_dir}/mixed/*").collect()


def test_ingest_binds_by_header_and_refuses_missing_columns(spark, tmp_dir):
    sinks.export_csv(two_rows(spark), f"{tmp_dir}/in/a")
    start_ingest(spark, f"{tmp_dir}/in/*/*.csv", f"{tmp_dir}/store", f"{tmp_dir}/ckpt").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/store").count() == 2
    sinks.export_csv(two_rows(spark).drop("Magnitude"), f"{tmp_dir}/bad/a")
    with pytest.raises(C.MissingColumns):
        start_ingest(spark, f"{tmp_dir}/bad/*/*.csv", f"{tmp_dir}/store2", f"{tmp_dir}/ckpt2")


def test_other_columns_survive_cleaning_and_count_as_missing(spark):
    rows = two_rows(spark).withColumn("Felt Reports", F.when(F.col("ID") == "eq_001", F.lit("12"))).withColumn("Status", F.lit(None).cast("string"))
    cat = C.clean(rows)
    assert "Felt Reports" in cat.columns and "Status" not in cat.columns
    assert [r.ID for r in cat.collect()] == ["eq_001"]


def test_store_is_rebuilt_when_a_file_below_changes(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/t/deep")
    for name in ("a", "deep/b"):
        with open(f"{tmp_dir}/t/{name}", "w") as f:
            f.write("x")
    before = fixture.signature(spark, f"{tmp_dir}/t")
    os.utime(f"{tmp_dir}/t/deep/b", (1, 1))
    assert fixture.signature(spark, f"{tmp_dir}/t") != before


def test_scratch_tables_and_stores_can_be_dropped(spark, tmp_dir):
    from tremor.plans import store
    from tremor.scratch import drop_scratch, scratch_table

    t = scratch_table(spark.range(5).toDF("x"), "t")
    path = t.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and t.count() == 5
    drop_scratch(t, None)
    assert not os.path.exists(path)
    store.curated_store(spark, SF_SMALL)
    store.drop_stores(spark, keep=SF_SMALL)
    assert store.year_counts(spark, SF_SMALL).agg(F.sum("Count")).first()[0] == store.curated_store(spark, SF_SMALL).count()


def test_a_failed_writer_leaves_the_old_version_readable(spark, tmp_dir):
    from tremor.sources import versions

    root = f"{tmp_dir}/t"
    good = spark.range(100).selectExpr("id as n", "id % 5 as Year", "'x' as Type", "cast(id as string) as ID")
    sinks.replace_catalog(good, root)
    # Dies half-way: some tasks have written their files by then.
    bad = spark.range(0, 400, 1, 8).selectExpr("if(id > 300, raise_error('killed'), id) as id")
    with pytest.raises(Exception, match="killed"):
        sinks.replace_table(bad, root)
    assert sorted(r.n for r in src.read_catalog(spark, root).collect()) == list(range(100))
    # Dies between its last file and the manifest.
    sinks.write_table(spark.range(7), f"{root}/v-99999999999999999999-dead")
    assert src.read_catalog(spark, root).count() == 100
    # A reader that opened the old version goes on after the swap.
    opened = src.read_catalog(spark, root)
    sinks.replace_table(spark.range(3), root)
    assert opened.count() == 100 and src.read_catalog(spark, root).count() == 3
    first, second = versions.manifest(spark, root)
    sinks.replace_table(spark.range(4), root)
    assert versions.manifest(spark, root)[1] == first and not os.path.exists(f"{root}/{second}")
    assert src.read_catalog(spark, f"{tmp_dir}/t").count() == 4
    with pytest.raises(RuntimeError):
        versions.publish(spark, root, lambda path: None)


def test_the_batch_job_can_run_again_over_its_outputs(spark, tmp_dir):
    raw, feed = fixture.raw_training(spark, SF_SMALL), fixture.raw_feed(spark, SF_SMALL)
    one = run_etl(spark, raw.limit(500), feed, f"{tmp_dir}/out", model_name="DecisionTree")
    two = run_etl(spark, raw, feed, f"{tmp_dir}/out", model_name="DecisionTree")
    assert src.read_catalog(spark, one.catalog_path).count() < src.read_catalog(spark, f"{tmp_dir}/out/quakes").count()
    assert src.read_catalog(spark, f"{tmp_dir}/out/quakes").count() == src.read_catalog(spark, two.catalog_path).count()
    assert src.load_model(f"{tmp_dir}/out/model") == src.load_model(two.model_path)


def test_a_hot_year_is_spread_over_tasks(spark, tmp_dir):
    rows = spark.range(40_000).selectExpr("cast(id as string) as ID", "if(id % 3 = 0, 2000 + id % 7, 1999) as Year", "'Earthquake' as Type")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_catalog(rows, f"{tmp_dir}/q")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(f"{tmp_dir}/q/Year=1999") if f.endswith(".parquet")]
    assert len(files) >= 4


DOCUMENT = "ID string, Magnitude double, Type string, Year int"


@pytest.fixture()
def documents_of(spark, tmp_dir):
    import json

    from tremor.sources import documents

    def made(rows, split):
        os.makedirs(f"{tmp_dir}/d/deep")
        for k, part in enumerate((rows[::2], rows[1::2])):
            with open(f"{tmp_dir}/d/{'deep/' * k}part-{k}.json", "w") as f:
                f.write("\n".join(json.dumps(r) for r in part) + "\n" * (k + 1))
        open(f"{tmp_dir}/d/_SUCCESS", "w").close()
        with open(f"{tmp_dir}/d/.hidden.json", "w") as f:
            f.write("no json")
        documents.register(spark)
        return spark.read.format(documents.FORMAT).schema(DOCUMENT).option("splitBytes", split).load(f"{tmp_dir}/d")

    return made


def test_document_source_reads_each_line_once(documents_of):
    rows = [{"ID": f"é{i}" * (1 + i % 40), "Magnitude": None if i % 9 == 0 else i / 7, "Type": "Earthquake" if i % 3 else "Blast", "Other": i} for i in range(60)]
    df = documents_of(rows, 900)
    assert df.rdd.getNumPartitions() > 4
    got = df.collect()
    assert len(got) == 60 and {(r.ID, r.Magnitude, r.Type, r.Year) for r in got} == {(r["ID"], r["Magnitude"], r["Type"], None) for r in rows}


@pytest.mark.parametrize("text", [b"", b"a", b"a\n", b"\n\n", b"one\ntwo\n\nthree", b"x" * 9000 + b"\ny\n" + b"z" * 5000])
def test_every_line_is_in_one_range(text):
    import io

    from tremor.sources.documents import whole_lines

    for width in (1, 2, 3, 7, 4095, 4096, 4097, 20_000):
        if len(text) / width > 4000:
            continue
        parts = [b"".join(whole_lines(io.BytesIO(text), a, min(a + width, len(text)), 5)) for a in range(0, len(text), width)]
        assert b"".join(parts) == text
        assert all(p.endswith(b"\n") for p in [p for p in parts if p][:-1])


def test_document_source_gets_the_filters(spark, documents_of):
    rows = [{"ID": str(i), "Magnitude": i / 10, "Type": ["Earthquake", "Blast", None][i % 3], "Year": 1990 + i % 20} for i in range(200)]
    df = documents_of(rows, 500)
    typed = df.where("Type = 'Earthquake' and Magnitude >= 5 and Year in (1995, 1996, 1999) and ID like '%4%'")
    want = [r["ID"] for r in rows if r["Type"] == "Earthquake" and r["Magnitude"] >= 5 and r["Year"] in (1995, 1996, 1999) and "4" in r["ID"]]
    assert sorted(r.ID for r in typed.collect()) == sorted(want)
    plan = typed._jdf.queryExecution().executedPlan().toString()
    above = [line for line in plan.splitlines() if "Filter " in line and "BatchScan" not in line]
    assert not any("Earthquake" in line or "5.0" in line for line in above), plan  # Spark has no such filter left
    assert df.where("Type <> 'Blast'").count() == sum(r["Type"] == "Earthquake" for r in rows)
    assert df.where("Type is null").count() == sum(r["Type"] is None for r in rows)


def test_document_source_says_what_it_takes():
    from pyspark.sql import datasource as ds

    from tremor.sources import documents

    reader = documents.DocumentReader(schema.QUAKE, {"path": "/nowhere"})
    asked = [ds.EqualTo(("Type",), "Earthquake"), ds.StringContains(("ID",), "x"), ds.IsNotNull(("Type",)), ds.EqualTo(("a", "b"), 1), ds.Not(ds.EqualTo(("Type",), "x"))]
    assert list(reader.pushFilters(asked)) == [asked[1], asked[3], asked[4]]
    assert reader.filters == [asked[0], asked[2]]
