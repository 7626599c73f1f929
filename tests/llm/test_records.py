"""Sharding, chat formatting, components and the pipeline."""

import random
import zlib

from pyspark.sql import functions as F

import corpus_pipeline
from rankwright.llm import chat, sharding
from rankwright.llm.components import components


def test_shards_follow_weights_and_only_the_new_one_gains(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), F.lit(1).alias("slot"))
    out = sharding.shard_records(rows, "doc_id", [1.0, 2.0, 0.0, 1.0], added=[4.0]).collect()
    sizes = [sum(r.shard == s for r in out) for s in range(4)]
    assert sizes[2] == 0 and abs(sizes[1] - 2000) < 200 and abs(sizes[0] - 1000) < 150
    moved = [r for r in out if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {4} and abs(len(moved) - 2000) < 200
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert all(r.size == len(f"t{r.doc_id}") + 16 and r.text_crc32 == zlib.crc32(f"t{r.doc_id}".encode()) for r in out)


def test_shards_of_nulls_repeated_rows_and_none(spark):
    rows = spark.createDataFrame([(1, "é"), (1, "é"), (None, None), (None, "x"), (2, "")], "doc_id long, text string")
    out = sharding.shard_records(rows, "doc_id", [1.0] * 3).collect()
    assert len(out) == 5 and all(r.grown_shard is None for r in out)
    assert len({r.shard for r in out if r.doc_id is None}) == 1 and len({r.shard for r in out if r.doc_id == 1}) == 1
    assert sorted(r.size for r in out) == [16, 16, 17, 18, 18]
    assert sharding.shard_records(rows.limit(0), "doc_id", [1.0] * 3).count() == 0


SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_chats_read_back_what_was_written(spark):
    r = random.Random(8)
    signs = ["\\", "### ", "</turn>", "\n", "User: ", "a", ":", "<", "#", "$1", "é", "</turn>\n"]
    rows = []
    for c in range(60):
        for t in range(r.randint(1, 6)):
            role = r.choice(["system", "user", "assistant", "tool:x\\", "Assistant", None, ""])
            rows.append((c, t, role, r.choice([None, "", "".join(r.choice(signs) for _ in range(r.randint(1, 30)))]), "x"))
    rows.append((99, 0, "user", "long \\ text </turn> " * 50_000, "x"))
    out = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    out = out.withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("learned", chat.read_learned(F.col("segments")))
    for got in out.collect():
        turns = [(x[2] or "", x[3] or "") for x in rows if x[0] == got.conv_id]
        assert [(t.role, t.text) for t in got.back] == turns
        assert got.learned == "".join(t for role, t in turns if role == "assistant")
        assert got.formatted == "".join(s.text for s in got.segments)


def test_turn_order_is_validated(spark):
    cases = {1: "su a", 2: "ua", 3: "uaua", 4: "uu", 5: "a", 6: "uau", 7: "sa", 8: "usa"}
    names = {"s": "system", "u": "user", "a": "assistant"}
    rows = [(c, i, names[x], "t", "") for c, text in cases.items() for i, x in enumerate(text.replace(" ", ""))]
    got = {r.conv_id: (r.valid, r.first_invalid) for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (True, None), 4: (False, 1), 5: (False, 0), 6: (False, 3), 7: (False, 1), 8: (False, 1)}


def test_ties_null_conversations_and_no_rows(spark):
    rows = spark.createDataFrame([(None, 0, "user", "b", ""), (None, 0, "user", "a", ""), (None, None, "user", "c", "")], SCHEMA)
    out = chat.format_chats(rows).collect()
    assert len(out) == 1 and out[0].formatted == "### User: c</turn>\n### User: a</turn>\n### User: b</turn>\n"
    assert chat.format_chats(rows.limit(0)).count() == 0


def test_components_equal_union_find(spark):
    r = random.Random(11)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(600, i) for i in range(500, 600)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    table = spark.createDataFrame([*links, (None, 3), (5, None)], "a long, b long")
    got = {x.node: x.component for x in components(table, "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert components(table.limit(0), "a", "b").count() == 0


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(n)) + "."


def test_pipeline_stages_take_effect(spark, tmp_path):
    passage = " ".join(words(s, 9) for s in range(7))
    clean = words(50, 80)
    texts = {1: clean, 2: clean, 3: " ".join([*clean.split()[:-1], "other."]), 4: f"{words(51, 70)}\n{passage}", 5: f"{words(52, 70)}\n{passage}",
             6: "AB!! " * 100, 7: None, 8: f"{words(53, 70)}\nAll rights reserved."}
    rows = [(i, t, "en", "s", len(t or ""), "extra") for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string").write.parquet(f"{tmp_path}/documents.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 3:
            assert docs.columns == corpus_pipeline.COLUMNS
            kept.append({r.doc_id: r.text for r in docs.collect()})
    assert set(kept[0]) == {1, 2, 3, 4, 5, 8} and kept[0][8] == words(53, 70)
    assert set(kept[1]) == {1, 4, 5, 8}
    assert kept[2] == {1: clean, 4: texts[4], 5: words(52, 70) + "\n", 8: words(53, 70)}
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {1, 4, 5, 8}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_pipeline_of_null_ids_repeated_rows_and_no_rows(spark, tmp_path):
    passage = " ".join(words(s, 9) for s in range(7))
    clean, other, third = words(60, 80), words(61, 80), f"{words(62, 70)}\n{passage}"
    texts = [(None, clean), (None, clean), (3, other), (3, other), (3, third), (None, f"{words(63, 70)}\n{passage}"), (None, None), (4, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], schema).coalesce(1)
    distinct = corpus_pipeline.near_duplicate_groups(spark, rows, "")
    got = sorted(((r.doc_id, r.text) for r in distinct.collect()), key=str)
    assert got == sorted([(None, clean), (3, other), (3, third), texts[5], (None, None), (4, "")], key=str)

    cleaned = corpus_pipeline.repeated_passages(spark, rows.filter("text is not null"), "")
    kept = [(r.doc_id, r.text) for r in cleaned.collect()]
    assert kept.count((None, clean)) == 1 and kept.count((3, other)) == 1 and kept.count(texts[5]) == 1
    assert sorted(t.strip() for _, t in kept) == sorted([clean, "", other, "", words(62, 70), texts[5][1], ""])

    for name, table in {"some": rows, "none": rows.limit(0)}.items():
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert {r.doc_id for r in out.select("doc_id").collect()} == ({None, 3} if name == "some" else set())
