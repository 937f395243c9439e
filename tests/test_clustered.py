from gondola.plans import clustered


def test_tables_clustered_alike_join_without_an_exchange(spark, lake, tmp_path):
    with clustered.native_tables(spark, str(tmp_path / "native"), lake.bronze, 4) as tables:
        joined = clustered.with_newest(spark, tables)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert plan.count("Bucketed: true") == 2
        assert joined.count() == lake.bronze.count()
        day = "DATE '1996-03-01'"
        pruned = joined.filter(f"collected_date = {day}")
        assert "PartitionFilters: [isnotnull(collected_date" in (
            pruned._jdf.queryExecution().executedPlan().toString())
        names = list(tables.values())
    left = {t.name for t in spark.catalog.listTables()}
    assert not left & set(names)
