"""Prefix BPE, packing, the Katz model and exact top-k on small cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwright.llm import bpe, katz, packing, topk
from rankwright.llm.common import word_bpe_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(word_bpe_path())
    found.no_padding()
    found.no_truncation()
    return found


def odd_texts():
    r = random.Random(2)
    signs = "abcdefghijklmnopqrstuvwxyz  '.,!?0123éüßñ日😀<|>\x1f\x85ΣİA"
    texts = ["".join(r.choice(signs) for _ in range(r.randint(1, 60))) for _ in range(400)]
    texts += ["".join(r.choice("aeinrst") for _ in range(r.randint(1, 30))) for _ in range(400)]
    texts += ["", "don't I'LL", "a<|endoftext|>b", "<|ENDOFTEXT|>", "ΣΑΣ ΟΔΥΣΣΕΥΣ", "é", "x\x1cy\x85z", "</w> a</w>", "hello " * 5000]
    return texts


def test_prefix_encoding_and_decoding_equal_the_library(spark, library):
    texts = odd_texts()
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(-1, None, "x"), (0, texts[0], "x")], "doc_id long, text string, ids string")
    out = bpe.encode_texts(rows, word_bpe_path()).collect()
    assert len(out) == len(texts) + 2
    for row in out:
        ids = library.encode(texts[row.doc_id] if row.doc_id >= 0 else "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_texts(rows.limit(0), word_bpe_path()).count() == 0


def test_packing_covers_every_id_once(spark, library):
    r = random.Random(4)
    texts = [" ".join(r.choice(["one", "two", "three"]) for _ in range(r.choice([0, 3, 50, 700, 5000]))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1001, "")]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, offset int").coalesce(2)
    out = packing.pack_documents(table, word_bpe_path()).collect()
    windows, pieces = defaultdict(list), defaultdict(list)
    for p in out:
        windows[p.sequence_id].append(p)
        pieces[p.doc_id].append(p)
        assert len(p.ids) == 4 * p.length > 0
    for found in windows.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    for i, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        found = sorted(pieces[i], key=lambda p: p.start)
        assert b"".join(p.ids for p in found) == np.array(ids, "<u4").tobytes()
        assert [p.start for p in found] == np.cumsum([0, *(p.length for p in found)])[:-1].tolist()
        assert {p.doc_tokens for p in found} == {len(ids)}
    assert len(pieces[1000]) == 1 and len(pieces[1001]) == 2
    fills = [sum(p.length for p in found) for found in windows.values()]
    assert sum(f < 2048 for f in fills) <= 2  # one partial window a partition
    assert packing.pack_documents(table.limit(0), word_bpe_path()).count() == 0


def test_levels_minimise_the_sum_of_squares():
    r = random.Random(7)
    size = 40
    packer, levels = packing.SumOfSquares(size), Counter()
    for i in range(500):
        length = r.randint(1, size)

        def after(level):
            new = Counter(levels)
            if level:
                new[level] -= 1
            if level + length < size:
                new[level + length] += 1
            return sum(n * n for n in new.values())

        level = packer.level_for(length)
        options = [0, *(h for h, n in levels.items() if n > 0 and h + length <= size)]
        assert level in options and after(level) == min(map(after, options))
        packer.place(packing.Piece(i, 0, b"\0" * (4 * length)))
        if level:
            levels[level] -= 1
        if level + length < size:
            levels[level + length] += 1


def brute_katz(rows, trained):
    tokens = [(t or "").encode().lower().split() + [b" E"] for _, t in rows]
    counts, pairs, contexts = Counter(), Counter(), Counter()
    for found, train in zip(tokens, trained, strict=True):
        before = b" S"
        for word in found if train else ():
            counts[word] += 1
            pairs[before, word] += 1
            contexts[before] += 1
            before = word
    n, z = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    of = Counter(pairs.values())
    d = katz.discounts([of[i] for i in range(1, katz.TURING + 2)])
    value = lambda r: d.small[r - 1] if r <= katz.TURING else r - d.constant
    left, seen = defaultdict(float), defaultdict(float)
    for (v, w), r in pairs.items():
        left[v] += r - value(r)
        seen[v] += (counts[w] + 0.5) / z

    def p(w, v):
        if pairs[v, w]:
            return value(pairs[v, w]) / contexts[v]
        alpha = left[v] / contexts[v] / (1 - seen[v]) if contexts[v] else 1.0
        return alpha * (counts[w] + 0.5) / z

    for v in list(contexts)[:50]:  # all words and the unknown type after v
        assert math.isclose(sum(p(w, v) for w in counts) + p(b" unknown", v), 1, rel_tol=1e-9)
    out = []
    for found in tokens:
        before, base, score = b" S", 0.0, 0.0
        for word in found:
            base += math.log10((counts[word] + 0.5) / z)
            score += math.log10(p(word, before))
            before = word
        out.append((len(found), sum(counts[w] > 0 for w in found), n, base, score))
    return out


@pytest.mark.parametrize("tokens_of_a_block", [katz.BLOCK_TOKENS, 150])
def test_katz_scores_equal_brute_force(spark, monkeypatch, tokens_of_a_block):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", tokens_of_a_block)  # few tokens: many blocks and split words
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "the", "THE"] * 10
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "never seen words"), (203, "the " * 3000)]
    table = spark.createDataFrame([(*x, "q") for x in rows], "doc_id long, text string, train string")
    trained = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    out = {x.doc_id: x for x in katz.score_documents(table, F.crc32(F.col("doc_id").cast("string")) % 5 != 1).collect()}
    assert len(out) == len(rows)
    for (i, _), train, expected in zip(rows, trained, brute_katz(rows, trained), strict=True):
        x = out[i]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (not train, *expected[:3])
        assert math.isclose(x.base_score, expected[3], abs_tol=1e-8) and math.isclose(x.score, expected[4], abs_tol=1e-8)


def test_katz_without_training_rows_with_null_keys_and_no_rows(spark):
    table = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    out = katz.score_documents(table, F.lit(False)).collect()
    assert sorted(str(x.doc_id) for x in out) == ["1", "1", "None"]
    assert {(x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in out} == {(3, 0, 0, 0.0, 0.0)}
    assert katz.score_documents(table.limit(0), F.lit(True)).count() == 0


def test_top_k_equals_brute_force_with_ties(spark):
    r = np.random.default_rng(6)
    vectors = np.round(r.normal(0, 0.4, (700, 16)), 2).astype(np.float32)
    vectors[100:400] = vectors[100]  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(2000, None), (2050, [float("nan")] * 16), (2100, [None] * 16), (None, [1.0] * 16), (2150, [float("inf")] * 16), (2200, [1.0] * 3)]
    table = spark.createDataFrame([(*x, 1, 2) for x in rows + bad + rows[:5]], "vec_id long, embedding array<float>, rank int, score int")
    got = defaultdict(list)
    for x in topk.top_k(table, "vec_id % 50 = 0", k=5).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    whole = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    for q in range(0, 700, 50):
        score = whole @ whole[q]
        best = [i for i in np.lexsort((np.arange(700), -score)) if i != q][:5]
        assert got[q] == [(k + 1, i, score[i]) for k, i in enumerate(best)]
    assert set(got) == set(range(0, 700, 50))


def test_top_k_of_few_rows_and_none(spark):
    table = spark.createDataFrame([(0, [1.0]), (3, [0.5]), (7, [0.5])], "vec_id long, embedding array<double>")
    out = topk.top_k(table, "vec_id % 50 = 0", k=5).orderBy("rank").collect()
    assert [(x.rank, x.vec_id, x.score) for x in out] == [(1, 3, 32768), (2, 7, 32768)]
    assert topk.top_k(table.limit(0), "vec_id % 50 = 0").count() == 0


def test_bounds_close_nearly_all_queries_before_the_lists_end():
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids = table["vec_id"].to_numpy()
    vectors = np.floor(256 * np.stack(table["embedding"].to_numpy()).astype(np.float64)).astype(np.int64)
    asked, closed = np.flatnonzero(ids % 50 == 0), {}
    found = topk.block_top_k(vectors[asked], ids[asked], vectors, ids, 5, closed)
    for q, best, score in found:
        exact = vectors @ vectors[asked[q[0]]]
        order = [i for i in np.lexsort((ids, -exact)) if i != asked[q[0]]][:5]
        assert best.tolist() == order and score.tolist() == exact[order].tolist()
    assert len(found) == len(asked) == sum(closed.values())
    assert sum(n for share, n in closed.items() if share < 1) >= 0.9 * len(asked)
