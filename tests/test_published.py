"""Packs that stay readable while they are replaced; sketches that read new files only."""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit import health, sources as IO
from cohortkit.operators.sketches import ScanState
from cohortkit.session import materialize
from cohortkit.sources.published import _Files


def packs(spark, n, bad=False):
    rows = spark.range(n).select(F.col("id").cast("string").alias("patient_id"), F.when(F.col("id") % 2 == 0, "train").otherwise("val").alias("split"))
    late = F.when(F.col("id") > n - 2, F.raise_error(F.lit("broken off")).cast("string")).otherwise(F.lit("x"))
    return rows.withColumn("w", F.lit(1.5)) if not bad else spark.range(n).select(
        F.col("id").cast("string").alias("patient_id"), F.when(F.col("id") % 2 == 0, "train").otherwise("val").alias("split"), late.alias("w"))


def test_a_write_that_fails_leaves_the_former_packs(spark, tmp_path):
    path = str(tmp_path / "out")
    for write, at in ((IO.write_packs, "protocol=temporal"), (IO.write_membership, "protocol=temporal")):
        write(packs(spark, 10), path, "temporal")
        before = spark.read.parquet(path).count()
        with pytest.raises(Exception, match="broken off"):
            write(packs(spark, 400, bad=True).select("w", "split", F.col("w").alias("patient_id")), path, "temporal")
        assert spark.read.parquet(path).count() == before == 10
        assert os.listdir(path) == [at]
    table = str(tmp_path / "t")
    IO.write_table(packs(spark, 10), table)
    with pytest.raises(Exception, match="broken off"):
        IO.write_table(packs(spark, 400, bad=True), table)
    assert spark.read.parquet(table).count() == 10
    IO.write_table(spark.read.parquet(table).where("split = 'val'"), table)  # even from itself
    assert spark.read.parquet(table).count() == 5


def test_an_exchange_that_broke_off_is_mended(spark, tmp_path):
    path = str(tmp_path / "out")
    IO.write_packs(packs(spark, 10), path, "temporal")
    files = _Files(spark, path)
    files.rename(f"{path}/protocol=temporal", f"{path}/_former-protocol=temporal")  # ended before the new folder came
    IO.recover(spark, f"{path}/protocol=temporal")
    assert spark.read.parquet(path).count() == 10 and os.listdir(path) == ["protocol=temporal"]
    files.rename(f"{path}/protocol=temporal", f"{path}/_former-protocol=temporal")
    IO.write_packs(packs(spark, 4), path, "temporal")
    assert spark.read.parquet(path).count() == 4 and os.listdir(path) == ["protocol=temporal"]


def test_versions_and_their_records(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError, match="no published"):
        IO.read_published(spark, path, "packs")
    assert [IO.publish(packs(spark, n), path, "packs", note=f"{n} rows") for n in (10, 20)] == [1, 2]
    reader = IO.read_published(spark, path, "packs")
    with pytest.raises(Exception, match="broken off"):
        IO.publish(packs(spark, 400, bad=True), path, "packs")
    assert IO.read_published(spark, path, "packs").count() == reader.count() == 20
    assert IO.read_published(spark, path, "packs", 1).count() == 10
    # another writer took the next number, and one record is still empty
    files = _Files(spark, path)
    assert not files.create(f"{path}/packs/_commits/000000002.json", "{}")
    assert files.create(f"{path}/packs/_commits/000000003.json", "")
    assert IO.read_published(spark, path, "packs").count() == 20
    assert IO.publish(packs(spark, 30), path, "packs", fmt="csv") == 4
    back = IO.read_published(spark, path, "packs")
    assert back.count() == 30 and dict(back.dtypes)["w"] == "double"
    assert reader.count() == 20  # a reader that began before goes on
    assert len(IO.vacuum(spark, path, "packs", keep=1)) == 2
    assert [c["version"] for c in IO.commits(spark, path, "packs")] == [4]
    assert IO.read_published(spark, path, "packs").count() == 30


def test_sketches_read_new_files_only(spark, tmp_path):
    table, state = str(tmp_path / "t"), str(tmp_path / "s")
    rows = spark.range(30_000).select(
        (F.col("id") % 9000).cast("string").alias("text"), F.when(F.col("id") % 4 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"),
        F.lit(None).cast("string").alias("none"))
    scans = ScanState(spark, table, state)
    rows.limit(10_000).coalesce(2).write.parquet(table)
    assert scans.update() > 0 and scans.update() == 0
    first = scans.files().count()
    rows.coalesce(3).write.mode("append").parquet(table)
    assert scans.update() == scans.files().count() - first
    report = {r["column"]: r for r in scans.report().collect()}
    whole = spark.read.parquet(table)
    assert report["text"]["n_rows"] == whole.count() == 40_000 and report["none"]["n_present"] == 0
    assert report["text"]["n_levels"] == pytest.approx(9000, rel=0.04) and report["none"]["n_levels"] == 0
    there = whole.where("NOT isnan(x)")
    assert report["x"]["n_present"] == there.count() and report["x"]["high"] == there.agg(F.max("x")).first()[0]
    assert report["x"]["quantiles"][1] == pytest.approx(there.agg(F.percentile("x", 0.5)).first()[0], rel=0.02)
    assert report["text"]["quantiles"] is None
    # a file that goes, or changes, does not count
    gone = sorted(p for p in os.listdir(table) if p.endswith(".parquet"))[0]
    os.remove(os.path.join(table, gone))
    left = spark.read.parquet(table).count()
    assert scans.update() == 0 and scans.report().first()["n_rows"] == left


def scans_of(spark, path, action):
    """How many executed plans of an action read the files below ``path``."""
    store = spark._jsparkSession.sharedState().statusStore()
    last = max((store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())), default=-1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        action()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    found = [store.executionsList().apply(i) for i in range(store.executionsList().size())]
    return sum(path in e.physicalPlanDescription() for e in found if e.executionId() > last)


def test_health_reads_the_table_twice(spark, tmp_path):
    path = str(tmp_path / "table_for_health")
    spark.range(500).select(
        F.col("id").alias("patientunitstayid"), (F.col("id") % 3).cast("int").alias("mortality"), F.sin("id").alias("x"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 9).cast("string")).alias("gender")).write.parquet(path)
    df = spark.read.parquet(path)

    def action():
        report = health(df, "mortality")
        for part in report.values():
            if hasattr(part, "collect"):
                part.collect()
        assert report["duplicates"].first()["n_duplicates"] == 0
        assert sorted(map(tuple, report["cardinality"].where("kind = 'categorical'").collect())) == [("gender", "categorical", 9, False)]
        assert {r["value"]: r["n_rows"] for r in report["target"].collect()} == {0: 167, 1: 167, 2: 166}

    assert scans_of(spark, path, action) == 2


def test_health_of_repeated_rows_and_odd_types(spark):
    rows = [(1, -0.0, "a"), (1, 0.0, "a"), (2, None, "b" * 100), (2, None, "b" * 100), (None, float("nan"), None)]
    df = materialize(spark.createDataFrame(rows, "user_id LONG, y DOUBLE, s STRING"))
    report = health(df, "y")
    assert report["duplicates"].first()["n_duplicates"] == 2 and report["structure"].first()["unique_ids"] == 2
    assert {(r["value"], r["n_rows"]) for r in report["target"].collect()} == {(0.0, 2)}
    assert report["sample"].collect()[0]["user_id"] == 1
    listed = materialize(spark.createDataFrame([([1],), ([1],), ([2],)], "id ARRAY<INT>"))
    assert health(listed, "none")["structure"].first()["unique_ids"] == 2


def test_a_protocol_in_versions(spark, tmp_path):
    from cohortkit import run_protocol

    rows = spark.range(60).select(
        F.col("id").cast("string").alias("patient_id"), F.lit("s").alias("site_id"), (F.col("id") % 2).cast("int").alias("mortality"),
        F.sin("id").alias("x"))
    path = str(tmp_path / "ready")
    for seed in (1, 2):
        result = run_protocol(rows, seed=seed, path=path, versions=True)
    packs = IO.read_published(spark, f"{path}/packs", result.protocol)
    assert packs.count() == 60 and set(packs.columns) == set(result.packs.columns)
    members = [{r["patient_id"]: r["split"] for r in IO.read_published(spark, f"{path}/splits", result.protocol, v).collect()} for v in (1, 2)]
    assert members[0] != members[1] and members[1] == {r["patient_id"]: r["split"] for r in packs.collect()}


def test_folders_beside_a_target():
    from cohortkit.sources.published import _beside

    for target, want in (("out", "_x-out"), ("a/out/", "a/_x-out"), ("/out", "/_x-out"), ("hdfs://h/a/out", "hdfs://h/a/_x-out"), ("file:/out", "file:/_x-out")):
        assert _beside(target, "_x-") == want and _beside(target, "_s-", "7").endswith("_s-7")


def test_relative_paths(spark, tmp_path):
    import uuid

    # The session's working folder is this process's; a name of its own there is deleted again.
    name = f"cohortkit-test-{uuid.uuid4().hex}"
    files = _Files(spark, name)
    try:
        for n in (3, 2):
            IO.write_table(spark.range(n), name)
        assert spark.read.parquet(name).count() == 2 and not [f for f in os.listdir(".") if f.startswith(("_staged-", "_former-"))]
    finally:
        files.delete(name)
