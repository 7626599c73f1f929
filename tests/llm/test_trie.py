"""The node table against a dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rankwright.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, d1 string"
BLANK = " \t\n\x0b\x0c\r"


def n_words(text):
    for c in BLANK:
        text = text.replace(c, " ")
    return sum(bool(w) for w in text.split(" "))


def expected(rows, every, most):
    """All nodes by definition. Ties of a turn must agree in role and text."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1) if every else 0
        lender = c - int(np.fmod(c, every)) if every else c
        whole[c] = (own[lender][:h] if lender in own else []) + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * n_words(p[-1][1]) if p else 0
    ends = {p: hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == list(p)).encode()).hexdigest() for p, m in members.items()}
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], ends[p]) for p, m in members.items()
    )


def random_rows(seed, convs=120):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-30, 4 * convs), convs):
        for t in range(r.choice([1, 2, 3, 6, 12, 40])):
            text = r.choice([None, "", "a", "b c", "b c", "d\x1fe\xa0f g\nh", "same words again"])
            rows.append((c, t if t else r.choice([None, 0]), r.choice(["user", "user", "assistant", None]), text))
    rows += [(500_000 + i, t, "user", f"common {t}") for i in range(60) for t in range(9)]
    rows += [(None, 1, "user", "nobody"), (900_000, 3, "user", "twice"), (900_000, 3, "user", "twice")]
    rows += [(900_001, t, "user", "a long one " * 3) for t in range(700)]
    return rows


def answer(frame, **options):
    return sorted(map(tuple, trie.prefix_trie(frame, **options).collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize(("every", "most", "block"), [(0, 0, 4096), (20, 3, 4096), (20, 3, 4), (5, 2, 1)])
def test_nodes_equal_those_of_a_dictionary(spark, every, most, block):
    rows = random_rows(every + block)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert answer(frame, every=every, most=most, block=block) == expected(rows, every, most)


def test_ends_join_ranges_of_ids_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS_WIDTH", 7)
    rows = [(c, 0, "user", "all the same") for c in range(-25, 300, 3)] + [(1000, 0, "user", "other")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert answer(frame) == expected(rows, 0, 0)


def test_null_texts_and_no_rows(spark):
    rows = [(1, None, None, None), (1, 2, "", ""), (2, None, "", None)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert answer(frame) == expected(rows, 0, 0) and len(answer(frame)) == 3
    assert answer(frame.limit(0)) == []


def test_slots_are_minimal_and_perfect():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 20_000):
        keys = [r.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2)]
        keys[0][: n // 2] = 7  # half a key in common
        table = trie.MinimalHash(*keys)
        assert sorted(table.slots(*keys).tolist()) == list(range(n))
    other = table.slots(r.integers(0, 1 << 63, 500, dtype=np.uint64), r.integers(0, 1 << 63, 500, dtype=np.uint64))
    assert ((other >= -1) & (other < 20_000)).all()


def test_a_shared_digest_is_an_error():
    rows = {"conv": [1, 2], "block": [0, 0], "depth": [0, 0], "length": [0, 0], "n_words": [0, 5], "g1": [3, 3], "g2": [4, 4]}
    shard = pa.table({**rows, "carried": [False, False], "shard": [0, 0]})
    with pytest.raises(ArithmeticError):
        trie.shard_table(shard, 8)
