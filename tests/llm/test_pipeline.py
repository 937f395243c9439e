"""The pipeline's stages against brute force on the smallest tables."""

import numpy as np
import public_tokenizers as tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gondola.llm import decontaminate
from gondola.llm.frames import TEXT, map_text, read, stored
from tests.llm.test_jaccard_join import brute


def test_stages_one_by_one(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "token_files":
            assert out.columns == docs.columns
            assert out.exceptAll(docs).isEmpty()
        kept[name] = docs, out
        docs = out
    # near duplicates: the smallest id of every group, by all pairs
    before, after = kept["near_duplicates"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    want = {d for d, _, c in brute(rows, 5, 80, 100) if c == d}
    assert {r[0] for r in after.select("doc_id").collect()} == want
    # decontamination: no window of the benchmark is left, and nothing else went
    before, after = kept["benchmark_decontamination"]
    windows = {tuple(w) for r in read(spark, sf_dir, "benchmark").collect()
               for w in decontaminate.windows(decontaminate.words(r["text"].encode()), 10)}
    def dirty(text):
        found = decontaminate.words((text or "").encode())
        return any(tuple(found[k:k + n]) in windows for n in {len(w) for w in windows}
                   for k in range(len(found) - n + 1))
    want = {r["doc_id"] for r in before.collect() if not dirty(r["text"])}
    assert {r[0] for r in after.select("doc_id").collect()} == want
    # the mix keeps every row, and the token files follow its order
    before, after = kept["mix_sources"]
    assert before.exceptAll(after).isEmpty()
    mixed, index = kept["token_files"]
    order = [r for r in mixed.select("doc_id", "text", F.col("_metadata.file_name").alias("f"),
                                     F.col("_metadata.row_index").alias("i"))
             .orderBy("f", "i").collect()]
    tk = Tokenizer.from_file(tokenizers.path(corpus_pipeline.TOKENIZER))
    start, found = 0, {r["doc_id"]: r for r in index.collect()}
    assert len(found) == len(order)
    for r in order:
        n = len(tk.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        assert (found[r["doc_id"]]["start"], found[r["doc_id"]]["n_tokens"]) == (start, n)
        start += n
    # toxic documents go, clean ones stay
    before, after = kept["toxicity"]
    labels = read(spark, sf_dir, "labels").filter("toxic = 0").select("doc_id")
    clean = before.join(labels, "doc_id").count()
    assert after.join(labels, "doc_id").count() >= 0.97 * clean
    assert np.isfinite(start)


def test_run_is_the_stages(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert got.count() == got.select("doc_id").distinct().count() > 0


NAMES = ["score", "predicted", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
         "item_ids", "hit_spans", "component_id", "n_shingles", "mix_slot", "mix_position",
         "mix_source_block", "start", "n_tokens", "ids_crc32", "_id", "_s", "_at", "_row", "_doc",
         "_rank", "_part", "_file", "toxic"]


def odd_documents(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, text, "en", "a"), (3, text, "en", "a"),
            (4, text, None, None), (None, "no id here", "de", "b"), (None, None, None, None),
            (5, "long words " * 20_000, "fr", "b"), (6, "short", "en", None), (7, "\n \t", "es", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return docs.select("*", F.length("text").cast("bigint").alias("n_chars"),
                       *[F.concat(F.lit(f"own {n} "), F.coalesce(F.col("doc_id"), F.lit(0)))
                         .alias(n) for n in NAMES])


def odd_tables(spark, path, docs, labels, benchmark):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return str(path)


def test_stages_keep_the_columns_of_odd_documents(spark, tmp_path):
    docs = odd_documents(spark)
    sf = odd_tables(spark, tmp_path, docs, [(1, 0), (3, 1), (None, 1), (9, 1)],
                    [(1, "short"), (2, None), (None, "no such words at all")])
    left = {"toxicity": 10, "near_duplicates": 9, "benchmark_decontamination": 8, "mix_sources": 8}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, sf), f"odd-{name}")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert out.exceptAll(docs).isEmpty() and out.count() == left[name]
        docs = out
    index = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert index.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(index.collect(), key=lambda r: r["start"])
    assert len(rows) == 8 and all(a["start"] + a["n_tokens"] == b["start"]
                                  for a, b in zip(rows, rows[1:]))


def test_stages_on_empty_tables(spark, tmp_path):
    docs = odd_documents(spark)
    sf = odd_tables(spark, tmp_path, docs, [], [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), sf)
        assert out.count() == 0
        if name not in ("near_duplicates", "token_files"):
            assert stored(stage(spark, docs, sf), f"bare-{name}").count() == docs.count()


def test_the_toxicity_stage_sends_each_text_once(spark, tmp_path):
    """Rows carry their text; no second copy of it goes to the Python workers."""
    docs = odd_documents(spark)
    sf = odd_tables(spark, tmp_path, docs, [(1, 0), (3, 1)], [])
    plan = corpus_pipeline.toxicity_filter(spark, docs, sf)._jdf.queryExecution()
    assert "MapInArrow" in plan.executedPlan().toString()
    assert TEXT not in plan.analyzed().toString()


def test_a_text_inside_a_kept_row_is_read_there(spark):
    docs = odd_documents(spark)
    rows = docs.select(F.struct(*docs.columns).alias("row"))

    def size():
        return lambda value: (-1 if value is None else len(value),)
    found = map_text(rows.coalesce(1), "n int", size, "row.text", ["row"])
    plain = map_text(docs.coalesce(1), "n int", size, "text")
    assert found.select("row.*", "n").exceptAll(plain).isEmpty()
    assert found.count() == plain.count() == docs.count()
