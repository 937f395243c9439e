"""Limits of shares come from the tail of the group, not from a least spread."""

from gondola.llm import quality_rules


def test_outliers_of_zero_heavy_groups_go(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    lines = lambda k, n: "\n".join(["same line"] * n + [f"u{k} v{i}" for i in range(40)])
    rows = [(k, words(k), "en", "a") for k in range(299)]
    rows += [(1000, lines(0, 20), "en", "a")]  # a third of its lines come before
    rows += [(2000 + k, lines(k, 20 + k % 2), "en", "b") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(df, tail=99).collect()}
    assert not got[1000]["base_failed"] and got[1000]["over_line_share"]
    assert got[1000]["over_repeat_share"] and not got[1000]["kept"]
    assert sum(not r["kept"] for r in got.values()) == 1  # usual in the other source
    old = {r["doc_id"]: r for r in quality_rules.quality_rules(df).collect()}
    assert old[1000].asDict().keys() == got[1000].asDict().keys() - {
        f"over_{m}" for m in (*quality_rules.SHARES, *quality_rules.SIZES)}
