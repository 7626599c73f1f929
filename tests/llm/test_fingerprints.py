"""Paragraph sketches against sets of paragraphs, and neighbours against a sorted list."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rankwright.llm import fingerprints as fp
from rankwright.llm import neighbours
from rankwright.llm.queries import queries

BLANK = b" \t\n\r\x0b\x0c"


def scramble(x):
    m = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def paragraphs(text):
    """The definition byte by byte: a bag of stripped paragraphs."""
    data, found, piece = text.encode(), [], b""
    for i, byte in enumerate(data):
        if byte == 10:
            found.append(piece)
            piece = b""
            continue
        piece += bytes([byte])
        at_end = i + 1 == len(data) or data[i + 1] in BLANK
        if byte not in BLANK and at_end:
            tail = (b"\n" * 8 + data[: i + 1])[-8:]
            if scramble(int.from_bytes(tail, "big")) % fp.WORDS == 0:
                found.append(piece)
                piece = b""
    found.append(piece)
    return Counter(p.strip(BLANK) for p in found if p.strip(BLANK))


def likeness(a, b):
    both = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / both if both else 1.0


def texts(seed, n):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé日") for _ in range(r.randint(1, 9))) for _ in range(60)]

    def one():
        return "".join(r.choice(words) + r.choice([" ", " ", " ", "\n", "\t", "\n\n", " \r\n"]) for _ in range(r.choice([0, 1, 3, 30, 200])))

    return [one() for _ in range(n)]


def test_paragraphs_are_counted_as_defined():
    found = [*texts(1, 40), "", "\n", "a", "same line\n" * 300, "x" * 5000, "no end " * 4000]
    digests, counts = fp.paragraph_digests([t.encode() for t in found])
    assert counts.tolist() == [sum(paragraphs(t).values()) for t in found]
    at = 0
    for t, n in zip(found, counts, strict=True):
        expected = [
            scramble((xxhash.xxh3_64_intdigest(p) + k * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
            for p, times in paragraphs(t).items() for k in range(times)
        ]
        assert sorted(digests[at : at + n].tolist()) == sorted(expected)
        at += n
    assert fp.paragraph_digests([])[1].tolist() == []


def test_peeling_finds_just_what_differs_and_grows_until_it_does():
    r = np.random.default_rng(4)
    sizes = [(0, 0, 0), (0, 0, 5), (3, 0, 0), (50, 2, 3), (400, 9, 0), (5, 300, 200), (0, 5000, 4000), (9000, 1, 1)]
    keys = [r.integers(0, 1 << 63, sum(s), dtype=np.uint64) for s in sizes]
    both = [(np.concatenate([k[: s[0] + s[1]] for k, s in zip(keys, sizes)]), np.array([s[0] + s[1] for s in sizes]))]
    new = [np.concatenate([k[: s[0]], k[s[0] + s[1] :]]) for k, s in zip(keys, sizes)]
    both.append((np.concatenate(new), np.array([len(x) for x in new])))
    pair, digest, side, used = fp.differences(*both)
    for i, (common, lost, gained) in enumerate(sizes):
        assert sorted(digest[(pair == i) & (side == 1)].tolist()) == sorted(keys[i][common : common + lost].tolist())
        assert sorted(digest[(pair == i) & (side == -1)].tolist()) == sorted(keys[i][common + lost :].tolist())
    assert used[3] == fp.CELLS and used[6] >= fp.CELLS * fp.GROWTH**4


def test_versions_against_bags_of_paragraphs(spark):
    old = [*texts(2, 30), "", "one\n" * 400, "a\nb\nc"]
    r = random.Random(9)
    new = [t[: len(t) // 2] + r.choice(texts(3, 9)) + t[len(t) // 2 :] for t in old]
    rows = [(i if i else None, a, b, "x", 1) for i, (a, b) in enumerate(zip(old, new, strict=True))]
    rows += [(1000, None, "", "x", 1), (1001, "", "a b", "x", 1), (1001, "", "a b", "x", 1)]
    table = spark.createDataFrame(rows, "id long, text string, other string, fingerprint string, n int").coalesce(2)
    out = fp.compare_versions(table, ["id"], "text", ["other", "text"]).collect()
    assert len(out) == len(rows)
    for r in out:
        a, b = next((x[1] or "", x[2]) for x in rows if x[0] == r.id)
        bags = paragraphs(a), paragraphs(b)
        assert r.other_likeness == pytest.approx(likeness(*bags)) and r.text_likeness == 1.0
        assert (len(r.other_lost), len(r.other_gained)) == (sum((bags[0] - bags[1]).values()), sum((bags[1] - bags[0]).values()))
        assert r.fingerprint == r.text_fingerprint and (r.fingerprint == r.other_fingerprint) == (bags[0] == bags[1])
        stored = fp.read_difference(r.fingerprint, r.other_fingerprint)
        assert (stored is None) == (r.other_cells > fp.CELLS)
        assert stored is None or stored == (r.other_lost, r.other_gained)
    assert fp.compare_versions(table.limit(0), ["id"], "text", ["other"]).count() == 0


def test_an_insertion_changes_only_what_is_near_it():
    long = " ".join(texts(5, 60)).replace("\n", " ")
    a, b = paragraphs(long), paragraphs("inserted words " + long)
    assert sum((a - b).values()) <= 2


@pytest.mark.parametrize("partitions", ["1", "4", "50"])
def test_every_row_meets_the_next_one(spark, partitions, monkeypatch):
    monkeypatch.setattr(neighbours, "SAMPLED", 2)
    r = random.Random(6)
    rows = [(r.choice([None, 5, 5, 5, r.randrange(-99, 99)]), f"t{r.randrange(80)}") for _ in range(400)] + [(5, "same")] * 30
    table = spark.createDataFrame([(*x, 1) for x in rows], "k long, text string, next int").repartition(7).drop("next")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = neighbours.with_next(table, "k", "text", "next").collect()
        none = neighbours.with_next(table.limit(0), "k", "text", "next").count()
        alone = neighbours.with_next(spark.createDataFrame([(1, "a")], "k long, text string"), "k", "text", "next").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ties = {t: h for t, h in spark.createDataFrame([(t,) for t in {x[1] for x in rows}], "t string").select("t", F.xxhash64("t")).collect()}
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, ties[x[1]]))
    expected = Counter((*x, order[(i + 1) % len(order)][1]) for i, x in enumerate(order))
    assert Counter((g.k, g.text, g.next) for g in got) == expected
    assert none == 0 and [(x.k, x.next) for x in alone] == [(1, "a")]


def test_query_against_plain_python(spark):
    import pyarrow.parquet as pq

    folder = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"] or "") for r in pq.read_table(f"{folder}/documents.parquet").to_pylist())
    got = {r.doc_id: r for r in queries()["op12_invertible_bloom_fingerprints"](spark, folder).collect()}
    assert len(got) == len(docs)
    same = {}
    for i, (key, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        row, bag = got[key], paragraphs(text)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_edited == pytest.approx(likeness(bag, paragraphs(edited)))
        assert row.near_next == pytest.approx(likeness(bag, paragraphs(after)))
        assert same.setdefault(text, row.fingerprint) == row.fingerprint
    near = [r for r in got.values() if r.n_chars > 100]
    assert sum(r.near_edited > r.near_next for r in near) > 0.95 * len(near)
