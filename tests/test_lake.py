"""What the layers write, and what they leave to be read from the tables."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from gondola.operators import silver
from gondola.plans.lake import Lake
from gondola.session import shared_dir
from gondola.sources import adapter, writers


@pytest.fixture()
def fresh_lake(spark, sf_dir, monkeypatch):
    monkeypatch.setattr("gondola.plans.lake._WRITTEN", {})
    return Lake(spark, sf_dir)


def written(spark):
    return set(glob.glob(f"{shared_dir(spark)}/*"))


def test_records_and_answers_are_views(spark, fresh_lake):
    before = written(spark)
    for df in (fresh_lake.obs, fresh_lake.graphql, fresh_lake.search_hits, fresh_lake.html):
        assert df.count() > 0
    assert written(spark) == before


def test_bronze_documents_need_no_silver(spark, fresh_lake):
    before = written(spark)
    docs = fresh_lake.audit("bronze")
    assert docs.filter("layer != 'bronze'").isEmpty() and not docs.isEmpty()
    names = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in written(spark) - before]
    assert names == ["audit-bronze"]
    assert {r[0] for r in fresh_lake.audit().select("layer").distinct().collect()} == {
        "bronze", "silver"}


def test_payloads_are_compressed_and_whole(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "PAYLOADS_PER_FILE", 100)
    sent = adapter.search_hit_payloads(spark, sf_dir).drop("record_id").limit(1000)
    sent = spark.createDataFrame(sent.collect(), sent.schema).coalesce(1)
    path = writers.write_raw_payloads(sent, str(tmp_path / "raw"))
    assert len(glob.glob(f"{path}/*.json.gz")) == 10
    back = writers.read_payloads(spark, path).select(*sent.columns)
    assert back.exceptAll(sent).isEmpty() and back.count() == 1000


def shuffled_columns(df):
    """Column names that go into each shuffle of a plan."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")
    return [set(re.findall(r"([a-z_]+)#", line)) for line in re.findall(
        r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def test_wide_records_are_not_shuffled_before_they_are_used(fresh_lake):
    """Narrow rows meet markets, then products, by one plan at every size of the tables."""
    shuffles = shuffled_columns(fresh_lake.obs)
    lines = [c for c in shuffles if "l_orderkey" in c]
    assert lines and all("market" in c and not c & {"product_name", "_slug", "p_name"}
                         for c in lines)


def test_kept_records_shuffle_no_made_columns(spark, fresh_lake):
    lone = fresh_lake.obs.limit(300)
    odd = lone.withColumns({c: F.lit(None).cast(lone.schema[c].dataType)
                            for c in ("market", "product_name", "ean", "price", "collected_at")})
    rows = spark.createDataFrame(lone.union(lone).union(odd).collect(), lone.schema)
    plain, kept = silver.deduplicate(silver.normalize(rows)), silver.normalize_kept(rows)
    assert kept.dtypes == plain.dtypes
    assert kept.count() == plain.count() < 300
    assert kept.exceptAll(plain).isEmpty() and plain.exceptAll(kept).isEmpty()
    made = {"brand_normalized", "category_normalized", "quality_flags", "unit_normalized"}
    shuffles = shuffled_columns(kept)
    assert shuffles and not any(c & made for c in shuffles)


def test_landed_records_are_dealt_before_columns_are_added(spark, fresh_lake, tmp_path, monkeypatch):
    seen = []
    append = writers.write_partitioned

    def watched(df, *args):
        seen.extend(c for c in shuffled_columns(df) if "bronze_run_id" in c)
        return append(df, *args)
    monkeypatch.setattr(writers, "write_partitioned", watched)
    path = fresh_lake.land_bronze(str(tmp_path / "bronze"))
    back = writers.read_bronze(spark, path)
    assert back.count() == fresh_lake.obs.count()
    assert len(seen) == 1 and "record_id" in seen[0]
    assert not seen[0] & {"bronze_ingestion_timestamp", "year", "bronze_data_version"}
    folders = back.select("market", "year", "month", "run_id").distinct().count()
    assert len(glob.glob(f"{path}/*/*/*/*/*/*.parquet")) == folders


def test_landed_texts_are_made_after_rows_are_dealt(spark, fresh_lake, tmp_path, monkeypatch):
    seen = []
    append = writers.write_partitioned

    def watched(df, *args):
        seen.extend(c for c in shuffled_columns(df) if "bronze_run_id" in c)
        return append(df, *args)
    monkeypatch.setattr(writers, "write_partitioned", watched)
    back = writers.read_bronze(spark, fresh_lake.land_bronze(str(tmp_path / "bronze")))
    assert len(seen) == 1 and "p_name" in seen[0]
    assert not seen[0] & {"product_name", "source_url", "image_url", "sku", "ean", "search_term"}
    names = [c for c in fresh_lake.obs.columns if c not in ("collected_at", "run_ts")]
    sent, landed = fresh_lake.obs.select(*names), back.select(*names)
    assert sent.exceptAll(landed).isEmpty() and landed.exceptAll(sent).isEmpty()


def test_the_id_of_a_landed_record_is_dealt_as_its_columns(spark, fresh_lake, tmp_path, monkeypatch):
    seen = []
    append = writers.write_partitioned

    def watched(df, *args):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        rest = text[text.index("RebalancePartitions"):]
        seen.append((rest.count("concat_ws(-, cast(l_orderkey"), "struct(l_orderkey" in rest))
        return append(df, *args)
    monkeypatch.setattr(writers, "write_partitioned", watched)
    back = writers.read_bronze(spark, fresh_lake.land_bronze(str(tmp_path / "bronze")))
    assert seen == [(0, True)]
    sent, landed = fresh_lake.obs.select("record_id"), back.select("record_id")
    assert sent.exceptAll(landed).isEmpty() and landed.exceptAll(sent).isEmpty()


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def stored():
        dirs = [d.getPath() for d in files.diskBlockManager().localDirs()]
        return {p for d in dirs for p in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before = stored()
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("p"))
    writers.write_partitioned(df, str(tmp_path / "out"), ["p"], "gzip")
    assert stored() <= before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5000
