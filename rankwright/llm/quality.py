"""Line-first quality rules: clean line by line, then reject what lost too much.

Each line is judged alone: symbols, shouting, a repeated word, navigation,
boilerplate, a missing end of sentence. Lines that fail are removed. A document
that loses more than a set share of its words is rejected; the others keep the
lines that passed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import BLANK, NOT_BLANK, settled, whole_text, words


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules. Shares are per word of the line."""

    max_symbols: float = 0.1  # characters of `symbols` per word
    symbols: str = "[#*$%&|<>{}]"
    max_ends: float = 0.5  # sentence ends (! ? .) per word, from `ends_from` words on
    ends_from: int = 8
    min_distinct: float = 0.2  # distinct words per word, from `distinct_from` words on
    distinct_from: int = 20
    navigation: str = r"^\W*((home|menu|login|log in|sign in|sign up|search|next|previous|back|share|print|top|contact us|about us)\W*){2,}$"
    boilerplate: str = (
        r"all rights reserved|terms (of use|and conditions)|privacy policy|use of cookies|accept cookies"
        r"|enable javascript|lorem ipsum|^\W*(licensed under|released under|this work is licensed under)"
    )
    #: A line ends a sentence if its last sign is one of these, closing marks aside.
    sentence_end: str = r"[.!?…。！？:;][\"'”’»)\]]*$"
    prose_from: int = 12  # words from which a line may also break off
    max_lost: float = 0.5  # of the document's words
    free_symbols: int | None = None  # groups of `symbols` behind a line's mark that count nothing; None counts each sign
    boilerplate_below: int | None = None  # words from which a line is no boilerplate
    boilerplate_share: float = 0.0  # characters of `boilerplate` per character of the line
    goes_on: int | None = None  # lines below in which a line's sentence may end
    wrapped_from: int = 4  # words from which a line goes on whatever sign the next begins with
    mark: str = r"^\s*([-*+•>]|#{1,6}|[0-9]{1,3}[.)])\s+"  # of a list item, a heading, a quotation


#: For whole corpora: what clean one-line, wrapped, listed and Markdown texts have passes.
#: ``op6_line_rules`` keeps the plain rules, which its SQL states.
CORPUS_RULES = LineRules(
    boilerplate=r"all rights reserved|terms (of use|and conditions)|privacy policy|use of cookies|accept cookies"
    r"|enable javascript|lorem ipsum|^\W*(licensed under|released under|this work is licensed under).*",
    free_symbols=2,
    boilerplate_below=25,
    boilerplate_share=0.3,
    goes_on=8,
)


def base_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with the counts of whole texts the base rule reads.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``;
    null and empty texts count 0 throughout. A window counts as repeated if its three
    words stand at two places of the text; all words of such windows are counted once.

    Windows are compared within the row, by sorting one number per window: some
    bits of its hash above its position. Neighbours that agree in the hash are
    compared word by word, so a chance agreement repeats nothing.
    """
    content = whole_text(text)
    lines = F.filter(F.split(content, "\n"), lambda line: line.rlike(NOT_BLANK))
    counted = (
        documents.withColumn("_text", content)
        .withColumn("_words", words(F.col("_text")))
        .withColumn("_lines", lines)
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace("_text", f"{BLANK}+", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace("_text", "[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    )
    # Position bits: 24 hold any text below 16 million words, 31 any array.
    bits = F.when(F.col("n_words") < 1 << 24, F.lit(24)).otherwise(F.lit(31))
    hashed = F.expr(
        """transform(sequence(0, size(_words) - 3),
             i -> shiftleft(shiftright(xxhash64(_words[i], _words[i + 1], _words[i + 2]), _bits), _bits) | i)"""
    )
    place = "cast({} & (shiftleft(1L, _bits) - 1) as int)"
    p, q = place.format("x"), place.format("y")
    same = f"""shiftright(x, _bits) = shiftright(y, _bits) and _words[{p}] = _words[{q}]
               and _words[{p} + 1] = _words[{q} + 1] and _words[{p} + 2] = _words[{q} + 2]"""
    before = same.replace("y", "_windows[i - 1]").replace("arra_windows[i - 1]", "array")
    after = same.replace("y", "_windows[i + 1]").replace("arra_windows[i + 1]", "array")
    found = F.expr(
        f"""sort_array(transform(
              filter(_windows, (x, i) -> (i > 0 and {before}) or (i < size(_windows) - 1 and {after})),
              x -> {p}))"""
    )
    covered = F.expr(
        """aggregate(_found, named_struct('n', 0L, 'to', -1), (acc, at) -> named_struct(
              'n', acc.n + (at + 3 - greatest(at, acc.to)), 'to', at + 3), acc -> acc.n)"""
    )
    full = (
        counted.withColumn("_bits", bits)
        .withColumn("_windows", F.when(F.col("n_words") >= 3, F.sort_array(hashed)).otherwise(F.array().cast("array<bigint>")))
        .withColumn("_found", found)
        .withColumn("n_repeat_words", covered)
        .drop("_text", "_words", "_lines", "_bits", "_windows", "_found")
    )
    return settled(full, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def line_fault(line: Column, rules: LineRules, goes_on: Column | None = None, own: Column | None = None) -> Column:
    """The first rule a line breaks, or null if it passes. Blank lines pass.

    ``goes_on``: whether the lines below end the line's sentence. ``own``: its words, where
    they are known; an expression over a line is otherwise run as often as it is named.
    """
    own = words(line) if own is None else own
    n = F.size(own)
    if rules.free_symbols is None:
        symbols = _count(line, rules.symbols) > rules.max_symbols * n
    else:
        groups = F.regexp_count(F.regexp_replace(line, rules.mark, ""), F.lit(f"{rules.symbols}+"))
        symbols = (groups > rules.free_symbols) & (groups > rules.max_symbols * n)
    boilerplate = line.rlike(f"(?i){rules.boilerplate}")
    if rules.boilerplate_below is not None:
        boilerplate = (n < rules.boilerplate_below) & boilerplate
    if rules.boilerplate_share:
        boilerplate &= _count(line, f"(?i){rules.boilerplate}") >= rules.boilerplate_share * F.length(line)
    unended = (n < rules.prose_from) & ~F.rtrim(line).rlike(rules.sentence_end)
    if goes_on is not None:
        unended &= ~goes_on
    return (
        F.when(n == 0, None)
        .when(symbols, "symbols")
        .when(line.rlike(f"(?i){rules.navigation}"), "navigation")
        .when(boilerplate, "boilerplate")
        .when(unended, "punctuation")
        .when((n >= rules.ends_from) & (F.regexp_count(line, F.lit("[.!?]+")) > rules.max_ends * n), "shouting")
        .when((n >= rules.distinct_from) & (F.size(F.array_distinct(own)) < rules.min_distinct * n), "repetition")
    )


def _goes_on(line: Column, i: Column, rules: LineRules) -> Column:
    """Whether line ``i`` of ``_lines`` is marked, or its sentence ends in the lines below.

    Those are the next few up to a blank one. Either the next begins with a small
    letter, or the line has the words of a wrapped line or a verse.
    """
    below = F.slice("_ends", i + 2, rules.goes_on)
    ended = F.aggregate(below, F.lit(0), lambda done, x: F.when(done != 0, done).otherwise(x)) == 1
    size = F.size(line["words"])
    follows = F.get(F.col("_lines"), i + 1)["line"].rlike(r"^\W*\p{Ll}") | (size >= rules.wrapped_from)
    return (line["line"].rlike(rules.mark) & (size > 2)) | (ended & F.coalesce(follows, F.lit(False)))


def clean_lines(documents: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """``documents`` with ``clean_text``, ``kept_words``, ``line_faults`` and ``line_verdict``.

    ``line_faults`` is an array of (line, rule) over the removed lines, by position
    from 0; ``line_verdict`` is false if more than ``max_lost`` of the words went.
    A text without words, null included, loses nothing and passes; its clean text is
    empty. Repeated rows are judged alike. Row-wise: nothing is shuffled.
    """
    lines = F.transform(F.split(whole_text(text), "\n"), lambda line: F.struct(line.alias("line"), words(line).alias("words")))

    def judged_line(line: Column, goes_on: Column | None = None) -> Column:
        fault = line_fault(line["line"], rules, goes_on, line["words"])
        return F.struct(line["line"].alias("line"), F.size(line["words"]).alias("n"), fault.alias("fault"))

    def total(judged: Column) -> Column:  # words lie in lines
        return F.aggregate(judged, F.lit(0).cast("long"), lambda n, x: n + x["n"])

    if rules.goes_on is None:
        counted, verdicts = documents, F.transform(lines, lambda line: judged_line(line))
    else:
        ended = F.transform(
            "_lines",
            lambda x: F.when(~x["line"].rlike(NOT_BLANK), -1)
            .when(x["line"].rlike(rules.sentence_end.removesuffix("$") + r"(\s|$)") | (F.size(x["words"]) >= rules.prose_from), 1)
            .otherwise(0),
        )
        counted = settled(settled(documents.withColumn("_lines", lines), ["_lines"]).withColumn("_ends", ended), ["_ends"])
        verdicts = F.transform("_lines", lambda line, i: judged_line(line, _goes_on(line, i, rules)))
    judged = (
        counted.withColumn("_judged", verdicts)
        .withColumn("_n", total(F.col("_judged")))
        .withColumn(
            "clean_text",
            F.array_join(F.transform(F.filter("_judged", lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n"),
        )
        .withColumn("kept_words", total(F.filter("_judged", lambda x: x["fault"].isNull())))
        .withColumn(
            "line_faults",
            F.filter(
                F.transform("_judged", lambda x, i: F.struct(i.alias("line"), x["fault"].alias("rule"))),
                lambda x: x["rule"].isNotNull(),
            ),
        )
        .withColumn("line_verdict", F.col("_n") - F.col("kept_words") <= rules.max_lost * F.col("_n"))
        .drop("_n", "_judged", "_lines", "_ends")
    )
    return settled(judged, ["clean_text", "kept_words", "line_faults", "line_verdict"])


def judge_documents(documents: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """Base counts, cleaned lines and the verdict ``kept`` of every document.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated
    windows. ``kept``: not ``base_failed`` and ``line_verdict``.
    """
    counted = base_counts(documents, text)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = clean_lines(counted, rules, text).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("line_verdict"))
