import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from gondola.operators import silver


def test_parents_and_children_of_a_raw_category(spark):
    rows = [(1, " Leites "), (2, "queijos"), (3, "Bebidas"), (4, "bebidas lácteas"), (5, None),
            (6, "laticínios")]
    df = spark.createDataFrame(rows, "record_id int, category string")
    got = {tuple(r) for r in silver.category_levels(df, ["record_id"]).collect()}
    assert got == {(1, "Laticínios", "Leites", 1), (2, "Laticínios", "Queijos", 1),
                   (3, "Bebidas", None, 0), (3, "Bebidas Não Alcoólicas", None, 0),
                   (4, "Bebidas", None, 0), (4, "Laticínios", None, 0),
                   (5, "Uncategorized", None, 0), (6, "Laticínios", None, 0)}


def test_dimension_of_any_depth(spark):
    edges = spark.createDataFrame(
        [("Laticínios", "Queijos"), ("Queijos", "Bebidas Lácteas"), ("Bebidas", "Sucos"),
         ("Bebidas", "Bebidas Lácteas"), ("Sucos", "Suco de Uva")], "parent string, child string")
    closure = {tuple(r) for r in silver.category_closure(edges).collect()}
    assert closure == {("Queijos", "Laticínios", 1), ("Bebidas Lácteas", "Queijos", 1),
                       ("Bebidas Lácteas", "Laticínios", 2), ("Bebidas Lácteas", "Bebidas", 1),
                       ("Sucos", "Bebidas", 1), ("Suco de Uva", "Sucos", 1),
                       ("Suco de Uva", "Bebidas", 2)}
    rows = [(1, "bebidas lácteas"), (1, "bebidas lácteas"), (2, "suco de uva"), (3, "sucos"), (4, "")]
    df = spark.createDataFrame(rows, "record_id int, category string")
    got = sorted(map(tuple, silver.category_levels(df, ["record_id"], edges).collect()))
    assert got == [(1, "Bebidas", "Bebidas Lácteas", 1)] * 2 + [
        (1, "Laticínios", "Bebidas Lácteas", 2)] * 2 + [
        (2, "Bebidas", "Suco de Uva", 2), (3, "Bebidas", "Sucos", 1), (4, "Uncategorized", None, 0)]


def test_a_cycle_is_an_error(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, child string")
    with pytest.raises((PySparkException, Py4JJavaError), match="ecursi"):
        silver.category_closure(edges).collect()


def test_given_records_have_children_and_two_standards(lake):
    levels = silver.category_levels(lake.silver, ["record_id"])
    children = {r["child"] for r in levels.select("child").distinct().collect()}
    assert {"Leites", "Queijos", None} <= children
    assert levels.groupBy("record_id").count().filter("count = 2").count() > 0
