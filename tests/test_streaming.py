"""Incremental runs take each payload file once."""

from pyspark.sql import functions as F

from gondola.sources import adapter, writers
from gondola.streaming import ingest


def test_two_runs_take_each_file_once(spark, sf_dir, tmp_path):
    src, root, ck = (str(tmp_path / n) for n in ("in", "bronze", "ck"))
    graphql = adapter.graphql_payloads(spark, sf_dir).drop("record_id").limit(300)
    pages = adapter.html_payloads(spark, sf_dir).drop("record_id").limit(200)
    want = 0
    for part in (graphql, pages):
        part = part.cache()
        writers.write_raw_payloads(part, src)
        want += ingest.records(part).count()
        ingest.ingest_new(spark, src, root, ck).awaitTermination()
        assert ingest.landed(spark, root).count() == want
    got = ingest.landed(spark, root)
    assert got.select("run_id").distinct().count() == 2
    assert got.filter(F.col("market").isNull() | F.col("record_id").isNull()).isEmpty()


def test_unknown_kinds_are_kept(spark, sf_dir, tmp_path):
    src, root, ck = (str(tmp_path / n) for n in ("in", "bronze", "ck"))
    part = adapter.graphql_payloads(spark, sf_dir).drop("record_id").limit(20)
    strange = part.limit(3).withColumn("raw_response_type", F.lit("xml_response"))
    none = part.limit(2).withColumn("raw_response_type", F.lit(None).cast("string"))
    writers.write_raw_payloads(part.unionByName(strange).unionByName(none), src)
    ingest.ingest_new(spark, src, root, ck).awaitTermination()
    assert spark.read.json(ingest.unparsed_path(root)).count() == 5
