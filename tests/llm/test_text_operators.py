"""Quality rules, sentence spans, near-duplicates and main text on small cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rankwright.llm import html, minhash, quality, spans

SCHEMA = "doc_id long, text string, kept string, n_words string, id string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def docs(spark, *texts, first=0):
    """Documents with extra columns whose names the operators also use."""
    return spark.createDataFrame([(first + i, t, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(n)) + "."


def counts(text):
    found, places, covered = WORD.findall(text), {}, set()
    for i in range(len(found) - 2):
        places.setdefault(tuple(found[i : i + 3]), []).append(i)
    for at in places.values():
        if len(at) > 1:
            for i in at:
                covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("rules", [quality.LineRules(), quality.CORPUS_RULES])
def test_the_words_of_a_line_are_found_once(spark, rules):
    cleaned = quality.clean_lines(docs(spark, "One line here.\n\nAnd one more, of seven words.", "", None), rules)
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_remove(split(") == 1
    assert [r.kept_words for r in cleaned.orderBy("doc_id").collect()] == [9, 0, 0]


def test_base_counts_equal_brute_force(spark):
    r = random.Random(1)
    texts = ["".join(r.choice("ab \t\n\x0b\xa0é#|") for _ in range(r.randint(0, 200))) for _ in range(150)]
    texts += ["", " ", "a", "a b", "a b c", "a b c a b c", "x " * 3000, "\n\n", None]
    rows = quality.base_counts(docs(spark, *texts)).collect()
    for row in rows:
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert got == counts(row.text or ""), row.text


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("Home | About us | Contact us", "symbols"),
        ("Home Login Search", "navigation"),
        ("All rights reserved.", "boilerplate"),
        ("Three small words", "punctuation"),
        ("A plain sentence of words.", None),
        ("one two three four five six seven eight nine ten eleven twelve", None),
        ("AB!! CD!! EF!! GH!! IJ!! KL!! MN!! OP!!", "shouting"),
        ("of " * 30 + "it.", "repetition"),
        ("  \t", None),
    ],
)
def test_line_rules(spark, line, rule):
    got = spark.range(1).select(quality.line_fault(F.lit(line), quality.LineRules()).alias("f")).first().f
    assert got == rule


def test_documents_that_lose_too_much_are_rejected(spark):
    good, bad = prose(1, 60), "Menu | Item | Other"
    texts = [f"{good}\n{bad}", "\n".join([prose(2, 50), *["No end here"] * 40]), "short.", None, f"{good}\n{bad}"]
    rows = {r.doc_id: r for r in quality.judge_documents(docs(spark, *texts)).collect()}
    assert [rows[i].kept for i in range(5)] == [True, False, False, False, True]
    assert rows[0].clean_text == good and [tuple(x) for x in rows[0].line_faults] == [(1, "symbols")]
    assert rows[1].line_verdict is False and rows[2].line_verdict is True and rows[3].clean_text == ""
    assert quality.judge_documents(docs(spark, "a").limit(0)).count() == 0
    assert quality.judge_documents(docs(spark, *texts)).filter("kept").count() == 2


def test_spans_keep_the_first_passage_and_remove_the_others(spark):
    passage = " ".join(prose(s, 9) for s in range(7))
    long_line = prose(50, 70)
    texts = [f"{prose(20, 30)}\n{passage}\n{prose(21, 12)}", f"{prose(22, 30)}\n{passage}\n{prose(23, 12)}", f"{passage}\n{passage}", None, "",
             long_line, f"{prose(24, 12)}\n{long_line}\n{prose(25, 9)}", prose(26, 30), prose(26, 30)]
    rows = {r.doc_id: r for r in spans.remove_repeats(docs(spark, *texts)).collect()}
    assert rows[0].clean_text == texts[0] and rows[5].clean_text == long_line
    assert rows[1].clean_text == f"{prose(22, 30)}\n{prose(23, 12)}"
    assert rows[2].clean_text.strip() == "" and rows[3].clean_text == "" and rows[4].clean_text == ""
    assert rows[6].clean_text == f"{prose(24, 12)}\n{prose(25, 9)}"
    assert rows[7].clean_text == rows[8].clean_text == texts[7]  # below the least run
    assert [tuple(x) for x in rows[1].removed] == [(len(prose(22, 30)) + 1, len(prose(22, 30)) + len(passage) + 2)]


def test_spans_equal_brute_force(spark):
    r = random.Random(5)
    stock = [" ".join(prose(100 + i, r.randint(4, 20)) for _ in range(1)) for i in range(30)]
    texts = ["\n".join(r.choice(stock) for _ in range(r.randint(0, 14))) for _ in range(60)]
    rules = spans.SpanRules()
    first, found = {}, []
    for i, text in enumerate(texts):
        for a, b, digest in spans.text_spans(text, rules):
            found.append((digest, (i, a, b)))
            first[digest] = min(first.get(digest, (i, a, b)), (i, a, b))
    cut = {i: set() for i in range(len(texts))}
    for digest, at in found:
        if at != first[digest]:
            cut[at[0]].update(range(at[1], at[2]))
    for row in spans.remove_repeats(docs(spark, *texts)).collect():
        assert row.clean_text == "".join(c for k, c in enumerate(row.text) if k not in cut[row.doc_id])


def test_repeated_keys_nulls_and_empty_tables_for_spans(spark):
    text = " ".join(prose(s, 9) for s in range(7))
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    out = [(r.doc_id, r.clean_text) for r in spans.remove_repeats(rows).collect()]
    assert sorted(out, key=str) == sorted([(1, text), (1, text), (None, text), (2, "")], key=str)
    assert spans.remove_repeats(docs(spark, "a").limit(0)).count() == 0


def brute_components(texts, width, percent):
    sets = {}
    for i, text in enumerate(texts):
        found = (text or "").encode().lower().split()
        k = min(width, len(found))
        sets[i] = {tuple(found[j : j + k]) for j in range(len(found) - k + 1)} if found else set()
    name = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and name[i] != name[j]:
                low, high = sorted((name[i], name[j]))
                name = {k: low if v == high else v for k, v in name.items()}
    return {i: (len(s), name[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    r = random.Random(9)
    texts = [None, "", " \n", "One", "one", "two words", "Two  words", "a b c", "é É"]
    for family in range(12):
        base = prose(family, 90).split()
        for _ in range(r.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 6])):
                copy[r.randrange(len(copy))] = f"w{r.randrange(1000)}"
            texts.append(" ".join(copy))
    expected = brute_components(texts, width, percent)
    rows = minhash.near_duplicates(docs(spark, *texts), width=width, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(texts)


def test_near_duplicates_with_null_keys_repeated_rows_and_no_rows(spark):
    text = prose(1, 40)
    rows = spark.createDataFrame([(5, text), (5, text), (None, text), (7, text.upper()), (9, None)], "doc_id long, text string")
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(rows).collect()), key=str)
    assert out == sorted([(5, 5, True), (5, 5, True), (None, None, True), (7, 5, False), (9, 9, True)], key=str)
    assert minhash.near_duplicates(docs(spark, "a").limit(0)).count() == 0


def test_every_bin_of_a_sketch_fills_and_similar_sets_agree():
    import numpy as np

    r = np.random.default_rng(3)
    a = r.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:340], r.integers(0, 2**63, 60).astype(np.uint64)])
    one = a[:1]
    out = minhash.sketches([a, b, one], 240)
    assert (out != np.iinfo(np.uint64).max).all()
    true = len(set(a) & set(b)) / len(set(a) | set(b))
    assert abs((out[0] == out[1]).mean() - true) < 0.12


def test_main_text(spark):
    page = (
        '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        '<nav><a href="/x">menu</a></nav><div class="ad">Buy now</div><article><header><h1>Head &amp; line</h1></header>'
        "<p><b>One&nbsp;  two\n three.<br><p>a &lt; b<aside>side</aside><form>mail <input></form></p>"
        '<section id="comments"><p>nice</p></section></article><footer>&copy; site</footer>'
    )
    plain = (
        '<div class="header">Site</div><div><p>' + "Long text of an unmarked page. " * 6 + "</p><p>Short.</p></div>"
        '<div class="sidebar"><a href="x">links and more</a></div><div class="comments">Nice, thank you all!</div>'
    )
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", plain, "x"), (5, "u", "bare text", "x"),
            (6, "u", "<p", "x"), (7, "u", "<p>" + "word " * 200_000, "x"), (1, "u", page, "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = sorted(((r.page_id, r.text, r.n_chars) for r in html.extract_pages(table).collect()))
    expected = "Head & line\nOne two three.\na < b"
    assert out[0] == out[1] == (1, expected, len(expected))
    assert [t for _, t, _ in out[2:4]] == ["", ""]
    assert out[4][1] == ("Long text of an unmarked page. " * 6).strip() + "\nShort."
    assert out[5][1] == "bare text" and out[7][2] == 200_000 * 5 - 1
    assert html.extract_pages(table.limit(0)).count() == 0


def words_of(seed, n):
    return prose(seed, n)[:-1].split()


def test_spans_find_passages_at_any_offset_and_inside_other_sentences(spark):
    shared = words_of(300, 500)
    texts = [" ".join(shared)] + [" ".join(words_of(301 + i, i) + shared + words_of(340 + i, 7)) for i in range(1, 18)]
    kept = ["", *(" ".join(words_of(301 + i, i) + words_of(340 + i, 7)) for i in range(1, 18))]
    for at, sizes in enumerate(([20] * 3, [30] * 2, [15] * 4, [51])):
        passage = " ".join(prose(400 + 10 * at + i, n) for i, n in enumerate(sizes))
        passage = passage[:-1]
        for k in range(3):
            seed = 500 + 20 * at + 2 * k
            texts.append(f"{prose(seed, 9 + k)[:-1]} {passage} {prose(seed + 1, 11)}")
            kept.append(f"{prose(seed, 9 + k)[:-1]} {prose(seed + 1, 11)}" if k else texts[-1])
    kept[0] = texts[0]
    rows = {r.doc_id: r.clean_text for r in spans.remove_repeats(docs(spark, *texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == kept


def test_spans_of_a_very_long_text(spark):
    stock = [" ".join(prose(2000 + i, 30) for _ in range(2)) for i in range(40)]
    own = [" ".join(prose(3000 + i, 25) for _ in range(1)) for i in range(1200)]
    long_text = "\n".join(f"{x}\n{stock[i % 40]}" for i, x in enumerate(own))
    assert len(long_text.split()) > 90_000
    rows = {r.doc_id: r for r in spans.remove_repeats(docs(spark, long_text, "\n".join(stock))).collect()}
    assert rows[1].clean_text.strip() == "" and len(rows[0].removed) == 1200 - 40
    assert rows[0].clean_text == "\n".join(f"{x}\n{stock[i]}" if i < 40 else x for i, x in enumerate(own)) + "\n"


ARTICLE = "<h1>Title of it</h1><p>" + "A sentence of the article stands here. " * 9 + "</p><p>Its last words.</p>"
ARTICLE_TEXT = "Title of it\n" + ("A sentence of the article stands here. " * 9).strip() + "\nIts last words."


@pytest.mark.parametrize(
    "before",
    ['<body class="has-sidebar">', '<body class="no-sidebar search">', '<body><div class="elementor-widget-text-editor">', '<div class="overflow-hidden">',
     '<div style="overflow: hidden">', '<article class="post related">', '<main id="widget">', '<div class="side">', '<div data-x="hidden">'],
)
def test_names_do_not_lose_the_article(before):
    assert html.main_text(f"<html>{before}{ARTICLE}") == ARTICLE_TEXT


def test_sections_and_headings_whose_anchors_sound_like_menus_stay():
    page = f'<article>{ARTICLE}<section id="related-work"><h2 id="search-algorithms">Search</h2><p>Words.</p></section>'
    assert html.main_text(page) == f"{ARTICLE_TEXT}\nSearch\nWords."
    for other in ('class="main-menu"', 'class="ad-slot-7"', 'class="related-posts"', "hidden", 'style="color:red; display:none"', 'role="search"'):
        assert html.main_text(f"<article>{ARTICLE}<div {other}>Other words</div></article>") == ARTICLE_TEXT


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=utf-8><body>{ARTICLE}",
        f'<head><script>var t = "<p>no</p>";</script><link rel=x>{ARTICLE}',
        f"<svg width='1' />{ARTICLE}<object data=x>", f"<svg/><select name=x>{ARTICLE}<svg><text>no</text></svg>",
        f"{ARTICLE}<script>var t = '<p>no</p>'",
    ],
)
def test_unclosed_and_self_closed_elements_lose_nothing(page):
    assert html.main_text(page) == ARTICLE_TEXT


def test_teasers_marked_as_articles_do_not_hide_the_text():
    teasers = "".join(f'<article class="card"><a href="/{i}">Teaser {i}</a></article>' for i in range(3))
    assert html.main_text(f"<body><div>{ARTICLE}</div>{teasers}").startswith(ARTICLE_TEXT)
    assert html.main_text(f"<body><p>Site of a name</p><article>{ARTICLE}</article>") == ARTICLE_TEXT


def test_lines_with_many_links_stay_within_an_unmarked_text():
    items = [f'<li>Read more <a href="/{i}">in this part {i}</a></li>' for i in range(6)]
    out = html.main_text(f"<div>{ARTICLE}<ul>{''.join(items)}</ul>{ARTICLE}</div>")
    assert out == "\n".join([ARTICLE_TEXT, *(f"Read more in this part {i}" for i in range(6)), ARTICLE_TEXT])


def test_clean_documents_are_kept_by_the_pipeline(spark):
    import textwrap

    import corpus_pipeline

    plain = " ".join(prose(s, 11).capitalize() for s in range(700, 708))
    one_line = f"{plain} They read the privacy policy, the terms of use, and All rights reserved. {plain[:90]}"
    wrapped = "\n".join(textwrap.wrap(plain, 60))
    verse = "\n\n".join("\n".join([*(prose(720 + 4 * k + i, 6)[:-1].title() for i in range(3)), prose(760 + k, 5).title()]) for k in range(5))
    sentences = [f"{prose(s, 7).capitalize()}" for s in range(780, 790)]
    markdown = "# A heading\n\n" + "\n".join(f"* **{x.split()[0]}** is {x[:-1]}" for x in sentences)
    percent = "\n".join(f"{x[:-1]} rose 5% last year." for x in sentences)
    clean = [one_line, wrapped, verse, markdown, percent]
    junk = ["\n".join(["No end here"] * 40), "\n".join(["Home | About us | Contact us"] * 40), "\n".join(f"{x} All rights reserved." for x in ["Site"] * 40)]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, table, "").collect()}
    assert rows == dict(enumerate(clean))


def scramble(x):
    m = (1 << 64) - 1
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return x ^ (x >> 31)


def polynomial(word):
    """A word's hash, letter by letter."""
    return scramble(sum((ord(c) + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(word.lower())) & ((1 << 64) - 1))


def test_hashed_words_and_pieces_equal_the_sentences():
    r = random.Random(21)
    signs = ["a", "bc", "déf", ".", "!", "?)", '."', "…", " ", " ", "  ", "\n", "\r\n", "\t", "\x1f", "\xa0", "。", "x.y", "」"]
    for _ in range(1500):
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 120)))
        parts = spans.sentences(text, 4)
        hashes, counts = spans._hashed(text, 4)
        assert counts == [len(p[2].split(" ")) for p in parts]
        assert hashes.tolist() == [polynomial(w) for p in parts for w in p[2].split(" ")]


def repeated_by_brute_force(texts, rules):
    """Code points that go, from words alone: sentence runs and chosen windows, with nothing of the operator's."""
    m = (1 << 64) - 1

    def ends(token, gap):
        stripped = token.rstrip("\"'”’»)]")
        return stripped != "" and stripped[-1] in ".!?…。！？" or "\n" in gap

    places = {}
    for key, text in enumerate(texts):
        tokens = [(x.group(), x.start(), x.end()) for x in re.finditer(r"\S+", text)]
        edges, since = [0], 0
        for i, (token, _, stop) in enumerate(tokens):
            gap = text[stop : tokens[i + 1][1]] if i + 1 < len(tokens) else "\n"
            if ends(token, gap) or i + 1 - since == rules.longest:
                edges.append(i + 1)
                since = i + 1
        edges = sorted(set(edges))
        chosen = set()
        for i, a in enumerate(edges):
            b = next((b for b in edges[i + rules.min_sentences :] if b - a >= rules.min_words), None)
            if b is not None and b - a < rules.sure:
                chosen.add((a, b))
        sums = [sum(polynomial(t[0]) * pow(0x9E3779B97F4A7C15, j, 1 << 64) for j, t in enumerate(tokens[i : i + rules.min_words])) & m
                for i in range(len(tokens) - rules.min_words + 1)]
        if len(tokens) >= rules.sure:
            hashes = [scramble(x) for x in sums]
            for i in range(len(hashes) - rules.neighbours + 1):
                near = hashes[i : i + rules.neighbours]
                chosen.add((i + near.index(min(near)), i + near.index(min(near)) + rules.min_words))
        words = [t[0].lower() for t in tokens]
        for a, b in chosen:
            places.setdefault(tuple(words[a:b]), []).append((key, a, b))
        texts[key] = (text, tokens, words)
    gone = [set() for _ in texts]
    for found in places.values():
        found.sort(key=lambda x: (x[0], x[1]))
        of, first, last = found[0]
        for key, a, b in found[1:]:
            text, tokens, words = texts[key]
            other = texts[of][2]
            reach, left, right = rules.neighbours, 0, 0
            while left < reach and a - left > 0 and first - left > 0 and words[a - left - 1] == other[first - left - 1]:
                left += 1
            while right < reach and b + right < len(words) and last + right < len(other) and words[b + right] == other[last + right]:
                right += 1
            stop = tokens[b + right][1] if b + right < len(tokens) else len(text)
            gone[key].update(range(tokens[a - left][1] if a - left else 0, stop))
    return gone


def test_what_goes_equals_a_brute_force_of_its_own(spark):
    r = random.Random(31)
    rules = spans.SpanRules(min_sentences=2, min_words=6, longest=5, sure=9)
    vocabulary = ["one", "Two", "three", "four", "five", "six", "seven", "é8", "nine", "ten", "eleven", "twelve"]
    shared = [" ".join(r.choice(vocabulary) + r.choice(["", "", "", ".", "!"]) for _ in range(14)) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = [r.choice([r.choice(shared), " ".join(f"w{r.randrange(10_000)}" for _ in range(r.randint(1, 12)))]) for _ in range(r.randint(0, 5))]
        texts.append(r.choice([" ", ". ", "\n"]).join(parts))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in spans.remove_repeats(rows, rules).collect()}
    gone = repeated_by_brute_force(list(texts), rules)
    assert any(gone)
    for key, text in enumerate(texts):
        assert {i for x in got[key].removed for i in range(x.start, x.end)} >= gone[key]
        assert got[key].clean_text == "".join(c for i, c in enumerate(text) if not any(x.start <= i < x.end for x in got[key].removed))
        # Candidates that lie apart from the same text are merged before they grow, so a little more may go, never a word that is new.
        more = {i for x in got[key].removed for i in range(x.start, x.end)} - gone[key]
        assert not any(w.startswith("w") for w in "".join(text[i] if i in more else " " for i in range(len(text))).split())


def test_surge_and_dive_equal_a_plain_reading():
    r = random.Random(41)
    for _ in range(2000):
        n, rules = r.randint(0, 14), html.BlockRules(window=r.randint(1, 4), surge=r.choice([1, 5, 20]))
        weights = [r.choice([0, 0, 1, 3, 9, 30]) for _ in range(n)]
        lasting = [r.choice([w, w, w + 2]) for w in weights]

        def over(values, i, k=rules.min_words):
            return sum(values[i : i + k])

        need = rules.surge if any(over(weights, i) >= rules.surge for i in range(n)) else 1
        text, expected = False, []
        for i in range(n):
            text = over(lasting, i) > 0 and (text or (weights[i] > 0 and over(weights, i) >= need))
            expected.append(text)
        runs = html.surge_and_dive(weights, lasting, rules)
        assert [any(a <= i < b for a, b in runs) for i in range(n)] == expected


def test_pages_without_their_marks_give_the_same_text():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"])["html"].to_pylist()
    same = [html.main_text(p) == html.main_text(re.sub(r"<(/?)(article|main)\b", r"<\1div", p)) for p in pages]
    assert len(same) == 2500 and sum(same) >= 0.98 * len(same)


def test_a_mark_weighs_but_does_not_decide():
    prose_ = "A sentence of the article that is long enough to weigh something on its own, whatever its neighbours are."
    beside = "Another text of some length that stands beside the mark, which no name or tag tells apart from the article, goes on here."
    short = "A note of few words."
    page = f"<article><p>{prose_}</p><p>{prose_}</p></article><div>{short}</div><div>{short}</div><div>{short}</div><div>{beside}</div>"
    assert html.main_text(page).splitlines() == [prose_, prose_]
    longer = page + "".join(f"<div>{beside}</div>" for _ in range(3))
    assert beside in html.main_text(longer)


def test_span_probes_equal_a_plain_reading():
    """The places that are joined: short runs, and of every 12 neighbouring windows the one with the smallest hash."""
    import random

    import numpy as np

    from rankwright.llm import spans

    r, rules = random.Random(7), spans.SpanRules()
    for _ in range(60):
        text = " ".join(r.choice(["a", "bb", "c.", "dé", "𝒳!", "e\n"]) for _ in range(r.choice([0, 30, 45, 60, 400])))
        hashed, counts = spans._hashed(text, rules.longest)
        _, at, size = spans._probes(text, rules)
        edges = [0, *np.cumsum(counts).tolist()]
        want = {(edges[a], edges[b] - edges[a]) for a, b in spans._forward(counts, rules) if edges[b] - edges[a] < rules.sure}
        if len(hashed) >= rules.sure:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * spans._powers(spans._BASE, len(hashed)), dtype=np.uint64)])
            back, k = spans._powers(spans._INVERSE, len(hashed)), rules.min_words
            windows = spans._mixed((sums[k:] - sums[:-k]) * back[: len(hashed) - k + 1]).tolist()
            for i in range(len(windows) - rules.neighbours + 1):
                near = windows[i : i + rules.neighbours]
                want.add((i + near.index(min(near)), k))
        assert list(zip(at.tolist(), size.tolist(), strict=True)) == (sorted(want) if len(hashed) >= rules.min_words else [])
