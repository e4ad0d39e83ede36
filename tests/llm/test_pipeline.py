"""The pipeline on a small table with planted cases, and each stage's promises about columns and rows."""

import random

from test_text_operators import SCHEMA, brute_components, prose

import corpus_pipeline
from lexiquarry.llm import mixing


def test_stages_on_planted_cases(spark, tmp_path):
    rng = random.Random(11)
    rows = {k: prose(rng, rng.randint(90, 140)) for k in range(200)}
    junk, passage = set(range(0, 200, 10)), prose(rng, 70)
    item = prose(rng, 30)
    for k in junk:
        rows[k] = rows[k].replace(" ", " | ")
    copies = {101: 1, 102: 1, 103: 2}
    for k, of in copies.items():
        words = rows[of].split()
        words[len(words) // 2] = "changed"
        rows[k] = " ".join(words) if k != 102 else rows[of]
    for k in (51, 61, 71):
        rows[k] = f"{rows[k]} {passage} {prose(rng, 20)}"
    rows[81] = f"{rows[81]} {item} end"
    spark.createDataFrame([(k, t, "en", f"s{k % 3}", len(t)) for k, t in rows.items()], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k not in junk), 0) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    kept = set(rows) - junk
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/stage{n}")
        docs = spark.read.parquet(f"{tmp_path}/stage{n}")
        after = {r.doc_id: r.text for r in docs.collect()}
        if n < 4:
            assert docs.columns == columns and docs.count() == len(after)
        if n == 1:
            kept = {i for i, (_, root) in brute_components(list(before.items()), 5).items() if i == root}
            assert not kept & set(copies)
        if n == 2:
            changed = {k for k in after if after[k] != before[k]}
            assert changed == {61, 71} and all(passage not in after[k] for k in changed)
        if n == 3:
            kept = kept - {81}
        if n < 4:
            assert set(after) == kept, name
        else:
            want = mixing.allocate(spark.read.parquet(f"{tmp_path}/stage3"))
            assert {r.doc_id: r.taken for r in docs.collect()} == {r.doc_id: r.taken for r in want.where("taken > 0").collect()}
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def write_tables(spark, folder, docs, labels, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_empty_tables(spark, tmp_path):
    write_tables(spark, tmp_path, spark.createDataFrame([], SCHEMA), [], [])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_nulls_repeats_and_clashing_columns(spark, tmp_path):
    rng = random.Random(5)
    text = prose(rng, 80)
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, prose(rng, 40)), (None, prose(rng, 30)), (4, prose(rng, 9000)), (5, "one"), (6, prose(rng, 60))]
    clash = "score double, rep long, kept boolean, digests string, row_key string, size int, taken int, source_size int, rank int, label string, __id string"
    df = spark.createDataFrame([(i, t, "en", None if i == 5 else "s", len(t or ""), None, 1, True, "x", "k", 7, 7, 7, 7, "l", "i") for i, t in rows], f"{SCHEMA}, {clash}")
    write_tables(spark, tmp_path, df, [(1, 1, 0), (None, 0, 0), (6, None, None)], [(0, None), (None, "")])
    docs = df
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/stage{n}")
        docs = spark.read.parquet(f"{tmp_path}/stage{n}")
        if n < 4:
            assert docs.columns == df.columns
    kept = spark.read.parquet(f"{tmp_path}/stage3")
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "3", "4", "5", "6", "None", "None"]
    assert kept.where("doc_id = 4").first().digests == "x" and docs.where("doc_id = 4").first().rank == 7
