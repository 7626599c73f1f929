"""Cuts on words of bytes against plain string cutting, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankwright.llm import middle

SCHEMA = "doc_id long, text string, n long, form string, output int"


def units(text, unit):
    return list(text) if unit == "char" else re.findall(r"[^\n]*\n|[^\n]+", text)


def plain_cut(text, key, unit="line", seed=7, percent=100, spm=50):
    """The definition, on strings: n, form, prefix, middle, output."""
    hexed = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    found = units(text, unit)
    n = len(found)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(found[:a]), "".join(found[a:b]), "".join(found[b:])
    if not text or any(x in text for x in middle.SENTINELS) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    r = random.Random(3)
    signs = ["\n", "\n", "a", "é", "日", "😀", "<", "P>", "S", " ", "\r", "\x85", " ", "\x00", "\x8a", "Ċ"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(1, 40))) for _ in range(600)]
    texts += ["", "\n", "\n\n\n", "a", "<P>x", "x<S>\ny", "a<\nP>b", "ends in <\n<P", "日" * 9 + "\n" + "é" * 7]
    texts += ["\n".join(f"line {i} é" for i in range(60_000)), "x" * 300_000]
    return texts


@pytest.mark.parametrize("unit", middle.UNITS)
def test_output_equals_plain_cutting_and_reads_back(spark, unit):
    texts = odd_texts()
    rows = spark.createDataFrame([(i, t, -1, "x", 5) for i, t in enumerate(texts)], SCHEMA)
    done = middle.fill_in_middle(rows, unit=unit)
    done = done.withColumn("back", middle.restore_text(F.col("output"), F.col("form"))).collect()
    assert len(done) == len(texts) and {r.form for r in done} == {"plain", "psm", "spm"}
    for r in done:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_cut(texts[r.doc_id], r.doc_id, unit)
        assert r.back == texts[r.doc_id]


def test_rates_other_sentinels_and_the_seed(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a\nb<P>\n"), "id").alias("text"))
    signs = ("[pre]", "(suf)", "{mid}")
    done = middle.fill_in_middle(rows, seed=3, percent=60, spm_percent=25, sentinels=signs)
    done = done.withColumn("back", middle.restore_text(F.col("output"), F.col("form"), signs)).collect()
    assert all(r.back == f"a\nb<P>\n{r.doc_id}" for r in done)
    share = {f: sum(r.form == f for r in done) / 2000 for f in ("plain", "spm", "psm")}
    assert abs(share["plain"] - 0.4) < 0.04 and abs(share["spm"] - 0.15) < 0.03
    for wrong in (("<P>", "<P>", "<M>"), ("a", "ba", "c"), ("<P>", "", "<M>"), ("<P", "<P>", "<M>")):
        with pytest.raises(ValueError, match="sentinel"):
            middle.fill_in_middle(rows, sentinels=wrong)
    with pytest.raises(ValueError, match="unit"):
        middle.fill_in_middle(rows, unit="word")


def test_nulls_repeated_rows_and_no_rows(spark):
    rows = spark.createDataFrame([(None, "a\nb", 1, "f", 0), (None, "a\nb", 1, "f", 0), (3, None, 1, "f", 0), (4, "", 1, "f", 0)], SCHEMA)
    got = sorted(map(tuple, middle.fill_in_middle(rows).collect()), key=str)
    n, form, p, m, output = plain_cut("a\nb", "")
    assert got == sorted([(None, n, form, p, m, output)] * 2 + [(3, 0, "plain", None, None, ""), (4, 0, "plain", None, None, "")], key=str)
    assert middle.fill_in_middle(rows.limit(0)).count() == 0


def test_marks_rank_and_select():
    r = np.random.default_rng(5)
    data = r.choice(np.array([10, 9, 11, 0x8A, 0, 255, 0x80, 65], np.uint8), 8 * 50)
    for marks, expected in ((middle.line_marks, data == 10), (middle.lead_marks, (data & 0xC0) != 0x80)):
        found, places = middle.Marks(marks(data.view("<u8"))), np.flatnonzero(expected)
        assert (found.select(np.arange(len(places))) == places).all()
        at = np.arange(len(data))
        assert (found.rank(at) == np.concatenate([[0], np.cumsum(expected)])[:-1]).all()


def test_slices_do_not_change_the_cuts(monkeypatch):
    texts = odd_texts()[:300]
    draws = [pa.array(np.random.default_rng(s).integers(0, 1 << 32, 300)) for s in (1, 2)]
    whole = middle.cut_texts(pa.array(texts), *draws)
    monkeypatch.setattr(middle, "SLICE_BYTES", 1)
    assert middle.cut_texts(pa.array(["zz", *texts])[1:], *draws).equals(whole)
    assert len(middle.cut_texts(pa.array([], pa.string()), *[x[:0] for x in draws])) == 0
