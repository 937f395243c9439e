import json
from collections import Counter

from pyspark.sql import functions as F

from gondola.operators import json_paths


def brute(rows):
    found = Counter()

    def walk(k, path, v):
        kind = ("VOID" if v is None else "BOOLEAN" if isinstance(v, bool) else "BIGINT"
                if isinstance(v, int) else "DECIMAL" if isinstance(v, float) else
                "STRING" if isinstance(v, str) else "ARRAY" if isinstance(v, list) else "OBJECT")
        found[k, path, kind] += 1
        for key, x in (v.items() if isinstance(v, dict) else []):
            walk(k, f"{path}.{key}", x)
        for x in (v if isinstance(v, list) else []):
            walk(k, f"{path}[]", x)

    for k, text in rows:
        if text is None:
            continue
        try:
            value = json.loads(text)
        except ValueError:
            found[k, None, "MALFORMED"] += 1
            continue
        walk(k, "$", value)
    return found


ROWS = [("a", '{"x":[1,{"y":"s [}"}],"z":null,"n":1.5,"b":true}'), ("a", '{"x":[]}'),
        ("a", '{"x":[[[]],{},{"y":{"z":[1,"two"]}}]}'), ("b", "{bad"), ("b", None), ("b", ""),
        ("b", "3"), ("b", "null"), (None, '["\\"[", "\\\\"]'), ("b", '{"x":'),
        ("b", "[" * 2000), ("a", '{"x":[1]}'), ("a", '{"x":[1]}')]


def of(spark, rows):
    df = spark.createDataFrame(rows, "k string, raw string")
    return {(r["k"], r["path"], r["type"]): r["values"]
            for r in json_paths.json_paths(df, "raw", ["k"]).collect()}


def test_all_paths_types_and_damage(spark):
    assert of(spark, ROWS) == brute(ROWS)
    assert of(spark, ROWS)["b", None, "MALFORMED"] == 4


def test_deep_texts_go_on_from_a_checkpoint(spark, monkeypatch):
    monkeypatch.setattr(json_paths, "LEVELS", 2)
    deep = [("d", '{"a":' * 7 + "[1,2]" + "}" * 7), *ROWS]
    got = of(spark, deep)
    assert got == brute(deep)


def test_no_rows_and_no_containers(spark):
    assert of(spark, [("a", None)]) == {}
    assert of(spark, [("a", "1"), ("a", "x")]) == {("a", "$", "BIGINT"): 1, ("a", None, "MALFORMED"): 1}


NUMBERS = ["0", "-7", "12", "999999999999999999", "-9223372036854775808", "9223372036854775808",
           "12345678901234567890", "0.0", "-1.50", "12.34", "100.000", "1.0e3", "2E-7", "-5e+2",
           "12345678901234567890.5", "0.1234567890123456789", "123456789012345678.123456789012345678"]


def typed(spark, texts):
    """Type of each text alone, as VARIANT has it."""
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.selectExpr(
        "regexp_extract(schema_of_variant(try_parse_json(t)), '^[A-Z_]+', 0)").collect()]


def test_a_shape_keeps_types_and_keys(spark):
    for n, kind in zip(NUMBERS, typed(spark, NUMBERS), strict=True):
        # a long number before another scalar, and a key that looks like a number
        got = of(spark, [("a", f'{{"12.5" : [{n}, "1.5\\"", {n}], "b\\"1":{n},"e":true}}')])
        assert got == {("a", "$", "OBJECT"): 1, ("a", "$.12.5", "ARRAY"): 1,
                       ("a", "$.12.5[]", kind): 2, ("a", "$.12.5[]", "STRING"): 1,
                       ("a", '$.b"1', kind): 1, ("a", "$.e", "BOOLEAN"): 1}


def test_texts_of_one_shape_are_unfolded_once(spark):
    texts = [f'{{"a":{i},"b":["x{i}",{i}.25,{{"c":"\\\\\\"{i}"}}],"d":{i}e2}}' for i in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    shapes = df.select(json_paths.shape(F.col("t")).alias("s")).distinct()
    assert shapes.count() == 1
    text = shapes.select(json_paths.text_of(F.col("s"))).first()[0]
    assert text == '{"a":0,"b":["",0.5,{"c":""}],"d":1e0}'
    assert set(of(spark, [("a", t) for t in texts]).values()) == {200}


def test_one_text_in_many_is_damaged(spark):
    rows = [("a", '{"x":"1"}'), ("a", '{"x":"2"'), ("a", '{"x":"3"}'), ("a", '{"x":01}'),
            ("a", '{"x":1,"x":2}'), ("a", '{"x":"\x01"}')]
    assert of(spark, rows) == {("a", "$", "OBJECT"): 2, ("a", "$.x", "STRING"): 2,
                               ("a", None, "MALFORMED"): 4}
