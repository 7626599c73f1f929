"""Fill-in-the-middle: cut a text at two unit ends and move the middle behind the rest.

The cuts are found on 64-bit words of the UTF-8 bytes. Arithmetic on a whole word marks
the bytes that end a unit, a bit count per word and their running sum lead to the word
that holds the k-th mark, and a multiplication inside that word to its byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import settled, ship_package

SENTINELS = ("<P>", "<S>", "<M>")
UNITS = ("line", "char")
#: Bytes of text that are marked at a time; results do not depend on it.
SLICE_BYTES = 1 << 22

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_ONE, _SEVEN, _EIGHT = np.uint64(1), np.uint64(7), np.uint64(8)
_BREAK = 0x0A


def line_marks(words: np.ndarray) -> np.ndarray:
    """0x80 in every byte that holds a line break; no carry leaves a byte."""
    rest = words ^ (_ONES * np.uint64(_BREAK))
    return ~(((rest & _LOW7) + _LOW7) | rest | _LOW7)


def lead_marks(words: np.ndarray) -> np.ndarray:
    """0x80 in every byte that begins a code point, which is any but 10xxxxxx."""
    return _HIGH & ~(words & ~(words << _ONE))


class Marks:
    """Marked bytes with their running counts: how many before a byte, and where the k-th is."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before each position."""
        word = at >> 3
        lower = (_ONE << ((at & 7).astype(np.uint64) * _EIGHT)) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & lower)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Positions of the marks numbered ``k``, from 0; each must exist."""
        word = np.searchsorted(self.before, k, side="right") - 1
        wanted = (k - self.before[word] + 1).astype(np.uint64)
        upto = (self.marks[word] >> _SEVEN) * _ONES  # marks up to and with each byte of the word
        reached = ((upto | _HIGH) - wanted * _ONES) & _HIGH  # bytes that have the wanted number
        return (word << 3) + 8 - np.bitwise_count(reached)


def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray, h1: np.ndarray, h2: np.ndarray, unit: str) -> tuple:
    """Units, and code points before the first cut and between the cuts, of texts in one byte array.

    ``data`` is a multiple of eight bytes with at least one to spare; texts are
    ``data[start:end]``. The cuts come after h1 and h2 units, modulo the units and one.
    """
    words = data.view("<u8")
    leads = Marks(lead_marks(words))
    first_lead = leads.rank(start)
    if unit == "char":
        n = leads.rank(end) - first_lead
    else:
        breaks = Marks(line_marks(words))
        first_break = breaks.rank(start)
        n_breaks = breaks.rank(end) - first_break
        n = n_breaks + ((end > start) & (data[np.maximum(end - 1, 0)] != _BREAK))

    def place(k: np.ndarray) -> np.ndarray:
        """The byte after the first k units."""
        at = np.where(k == 0, start, end)
        inner = (k > 0) & (k < n)
        if unit == "char":
            at[inner] = leads.select((first_lead + k)[inner])
        else:
            at[inner] = breaks.select((first_break + k - 1)[inner]) + 1
        return at

    a, b = h1 % (n + 1), h2 % (n + 1)
    prefix = leads.rank(place(np.minimum(a, b))) - first_lead
    middle = leads.rank(place(np.maximum(a, b))) - first_lead - prefix
    return n, prefix, middle


def _slices(sizes: np.ndarray):
    """Ranges of rows of about SLICE_BYTES, one row at least."""
    at, upto = 0, np.concatenate([[0], np.cumsum(sizes)])
    while at < len(sizes):
        last = max(at + 1, int(np.searchsorted(upto, upto[at] + SLICE_BYTES, side="right")) - 1)
        yield at, last
        at = last


def cut_texts(texts: pa.Array, h1: pa.Array, h2: pa.Array, unit: str = "line") -> pa.Array:
    """Per text a struct of ``n``, ``prefix`` and ``middle`` (code points)."""
    raw = texts.cast(pa.large_string())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    whole = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    first, second = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (h1, h2))
    parts = [[], [], []]
    for a, b in _slices(np.diff(offsets)):
        base, size = offsets[a], int(offsets[b] - offsets[a])
        data = np.zeros((size >> 3) * 8 + 8, np.uint8)
        data[:size] = whole[base : base + size]
        found = cut(data, offsets[a:b] - base, offsets[a + 1 : b + 1] - base, first[a:b], second[a:b], unit)
        for part, values in zip(parts, found, strict=True):
            part.append(values)
    columns = [pa.array(np.concatenate(part) if part else np.zeros(0), pa.int64()) for part in parts]
    return pa.StructArray.from_arrays(columns, ["n", "prefix", "middle"])


def _check(sentinels: tuple[str, str, str]) -> None:
    """Refuse sentinels that could arise where one meets a text, and then not be read back."""
    inner = [s[1:] for s in sentinels]
    if len(set(sentinels)) < 3 or not all(sentinels) or any(s[0] in rest for s in sentinels for rest in inner):
        raise ValueError("sentinels must differ, and none may begin with a character that is inside one")
    if any(a != b and a.startswith(b) for a in sentinels for b in sentinels):
        raise ValueError("no sentinel may begin with another one")


def fill_in_middle(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 7,
    unit: str = "line",
    percent: int = 100,
    spm_percent: int = 50,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """``key``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every row.

    The SHA-256 of ``seed``, a colon and the key as text decides: its first two 8-digit
    groups give the cuts (after h1 and h2 units, modulo n + 1), the third whether the row
    is transformed (``percent``), the fourth whether the suffix comes first
    (``spm_percent``). A unit is a line with its break, or a code point. Texts that
    are empty or hold a sentinel stay plain: their output is the text, and their
    character counts are null.

    Null texts are empty; null keys hash as the empty text, so they share their draw;
    repeated rows give repeated rows; an empty table gives none. Other columns are left
    out. A task holds one batch of texts, and marks SLICE_BYTES or one text of it at a time.
    """
    _check(sentinels)
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    ship_package(documents.sparkSession)

    @F.arrow_udf("n long, prefix long, middle long")
    def cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        return cut_texts(texts, h1, h2, unit)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"), digest.alias("_digest"))
    held = F.lit(False)
    for sentinel in sentinels:
        held = held | F.contains("_text", F.lit(sentinel))
    plain = (F.col("_text") == "") | held | (draws[2] % 100 >= percent)
    form = F.when(plain, "plain").when(draws[3] % 100 < spm_percent, "spm").otherwise("psm")
    placed = settled(rows.withColumns({"_cut": cuts("_text", draws[0], draws[1]), "form": form}), ["_cut", "form"])
    prefix, middle = F.col("_cut.prefix").cast("int"), F.col("_cut.middle").cast("int")
    parts = {
        "prefix": F.substring("_text", F.lit(1), prefix),
        "middle": F.substring("_text", prefix + 1, middle),
        "suffix": F.substring("_text", prefix + middle + 1, F.length("_text")),
    }
    p, s, m = (F.lit(x) for x in sentinels)
    output = (
        F.when(F.col("form") == "psm", F.concat(p, parts["prefix"], s, parts["suffix"], m, parts["middle"]))
        .when(F.col("form") == "spm", F.concat(s, parts["suffix"], p, parts["prefix"], m, parts["middle"]))
        .otherwise(F.col("_text"))
    )
    moved = F.col("form") != "plain"
    return placed.select(
        F.col("_key").alias(key),
        F.col("_cut.n").alias("n"),
        "form",
        F.when(moved, F.col("_cut.prefix")).alias("prefix_chars"),
        F.when(moved, F.col("_cut.middle")).alias("middle_chars"),
        output.alias("output"),
    )


def restore_text(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text an output was made of. Each sentinel is in a transformed output once."""
    p, s, m = sentinels

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    middle = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
