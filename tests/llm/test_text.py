"""Quality, decontamination, toxicity, main text, URL rules and language against brute force and held-out labels."""

import datetime as dt
import random
import zlib

import numpy as np
import pytest
from compare import difference, duck
from cases import docs, no_docs, prose  # noqa: F401

import corpus_pipeline
from shoplake.llm import decontaminate, html_text, langid, quality, queries, toxicity, url_rules

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name]) is None


# --- quality ------------------------------------------------------------------------------------------------------------
def slow_repeats(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})


def test_ledger(docs, no_docs):
    rows = quality.judged(quality.ledger(docs)).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id not in (13, None)}
    assert by[7].n_words == by[6].n_words == by[8].n_words == 0 and by[7].base_failed and not by[7].kept
    assert (by[11].n_words, by[11].n_repeat_words, by[11].base_failed) == (500, 500, True)
    assert (by[10].n_words, by[10].word_chars) == (1, 200_000)
    assert by[1].kept and by[9].kept and not by[12].kept
    assert quality.ledger(no_docs).count() == 0


def test_repeated_words(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 60))) for _ in range(60)]
    rows = quality.measured(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r.n_repeat_words == slow_repeats(texts[r.doc_id].split()) for r in rows)


def test_ablations(docs):
    entries = quality.ledger(docs).cache()
    failed = [r.failed for r in entries.collect()]
    for r in quality.ablations(entries).collect():
        mask, bit = quality.POLICIES[r.policy], quality.BITS[r.rule]
        assert r.documents == len(failed) and r.rejected == sum(f & mask != 0 for f in failed)
        assert (r.by_rule, r.only_rule) == (sum(f & bit != 0 for f in failed), sum(f & mask == bit for f in failed))


# --- decontamination ----------------------------------------------------------------------------------------------------
ITEM = "If a train leaves Boston with 45 passengers and 30 kg of freight at 7 am, how many passengers does Alice see?"
CASES = [
    (1, f"Some words before. {ITEM} And after.", True),
    (2, "ok: if a train leaves Paris with 99 passengers and 12 lb of freight at 7 am, how many passengers does Bob see", True),
    (3, "if a train leaves Paris with 45 passengers and 45 kg of freight at 45 am, how many passengers does Paris see", False),
    (4, "If a boat leaves port with 45 men and 30 kg of rope at noon, how many of them does anyone ever see again?", False),
    (5, None, False),
    (6, "", False),
    (7, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16", False),
]


def test_reparameterised_questions(spark, docs, no_docs):
    table = spark.createDataFrame([(i, t, "x") for i, t, _ in CASES], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(70, ITEM), (71, None), (72, ""), (73, "1 2 3 4 5 6 7 8 9 10")], "item_id long, text string")
    found = {(r.doc, r.item_id): r for r in decontaminate.leaks(table, items).collect()}
    assert set(found) == {(i, 70) for i, _, leak in CASES if leak}
    assert not found[1, 70].reparameterised and found[2, 70].reparameterised
    kept = decontaminate.without_leaks(table, items)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]
    assert decontaminate.without_leaks(docs, items).count() == docs.count()
    assert decontaminate.leaks(docs, items.limit(0)).count() == decontaminate.leaks(no_docs, items).count() == 0


def found_leaks(spark, texts, items):
    """Numbers of the texts and items that meet."""
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    listed = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc, r.item_id) for r in decontaminate.leaks(table, listed).collect()}


def test_names_that_open_sentences(spark):
    item = "Alice has 12 apples. Alice gives 5 apples to Tom. Alice buys 3 more apples. How many apples does Alice have?"
    renamed = item.replace("Alice", "Bob")
    spelled = renamed.replace("12", "twelve").replace("5", "three").replace("3 more", "seven more")
    other = "Bob has 12 pears. They cost 5 coins each at noon. Carol buys 3 more pears. How many pears does Dan have?"
    first = "Maria walks 4 miles every day. Maria rests on each seventh day of the week."
    texts = [renamed, f"Some words before: {spelled}", other, first.replace("Maria", "Pedro")]
    assert found_leaks(spark, texts, [item, first]) == {(0, 0), (1, 0), (3, 1)}


def test_items_without_a_template(spark):
    items = [
        "What is the capital of France?",
        "12 + 7 * 3 - 45 / 9 + 6 * 8 - 2",
        "The Old Man And The Sea By Ernest Hemingway",
        "Tom sees Alice and Bob in Rome, Paris, London, Berlin, Madrid and Oslo.",
    ]
    around = [f"Some words stand before it. {item} And some more of them after." for item in items]
    other = ["What is the price of this thing in any of the shops that are open today?", "12 7 3 45 9 6 8 2 and 12 - 7 * 3 - 45 / 9 + 6 * 8 - 2", "The Old House And The River By Someone Else"]
    texts = [*around, *(a.lower() for a in around), *other]
    n = len(items)
    assert found_leaks(spark, texts, items) == {(k + n * low, k) for k in range(n) for low in (0, 1)}


def test_passages_of_long_items(spark):
    def words(seed, n):
        draw = random.Random(seed)
        return ["".join(draw.choice(["ka", "lo", "mi", "tu", "re"]) for _ in range(5)) for _ in range(n)]

    long, middle = words(1, 200), words(2, 59)
    named = "then every one of them went out there to see Alice and they all gave back the old books which Alice had never read at home or in the school before then".split()
    boxes = "he packs 7 boxes of the best pens into a bag and gives 7 pencils to each child who asks"
    items = [" ".join(x) for x in (long, middle, named)] + [boxes]
    texts = [" ".join([*words(9, 30), *x, *words(8, 30)]) for x in (long[70:130], middle[20:40], long[70:82])]
    texts += [items[2].replace("Alice", "Mary Ann"), boxes.replace("7 boxes", "9 boxes")]
    assert found_leaks(spark, texts, items) == {(0, 0), (1, 1), (3, 2), (4, 3)}


def test_alignments_are_chained():
    def meeting(place, at):
        return {"place": place, "at": at, "slots": [], "item_slots": []}

    row = [meeting(p, p - 3 - (p > 20)) for p in (*range(10, 15), *range(24, 28))]
    assert max(map(len, decontaminate._aligned(row))) == 9 and decontaminate._longest_run(row) == 5
    assert max(map(len, decontaminate._aligned([meeting(p, 5) for p in range(9)]))) == 1


def test_planted_passages(spark):
    """Every document that holds an item's text is found, and no other."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    holds = {(d, i) for d, t in docs.items() for i, b in items.items() if b and b in t}
    assert holds and {(r.doc_id, r.item_id) for r in queries.op2_decontamination(spark, SF).collect()} == holds


# --- toxicity -----------------------------------------------------------------------------------------------------------
def test_neighbours_are_exact():
    rng = np.random.default_rng(4)
    n, terms = 300, 40
    matrix = rng.random((n, terms)) * (rng.random((n, terms)) < 0.08)
    matrix[:40] = matrix[40:80]  # ties
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix /= np.where(norm > 0, norm, 1)
    text, term = np.nonzero(matrix)
    index = toxicity.BlockMaxIndex(text, term, matrix[text, term], n, terms)
    for k in range(60):
        where = np.flatnonzero(matrix[k])
        near, cosine, _ = index.nearest(where, matrix[k, where], 10)
        exact = matrix @ matrix[k]
        assert np.allclose(cosine, np.sort(exact[exact > 0])[::-1][: len(cosine)]) and np.allclose(exact[near], cosine)
        assert len(cosine) == min(10, (exact > 0).sum())


def test_terms_are_looked_up_in_their_slot():
    """Every hash has its number among the terms or none, also where several terms share the bits that they are looked up by."""
    rng = np.random.default_rng(8)
    hashes = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    crowded = np.uint64(5 << 50) + np.arange(0, 400, 2, dtype=np.uint64)
    ends = np.array([0, 2**64 - 1], np.uint64)
    terms = np.unique(np.concatenate([hashes, crowded, ends]))
    asked = np.concatenate([terms[::-1], crowded + np.uint64(1), rng.integers(0, 2**64, 500, dtype=np.uint64)])
    known, term = toxicity.Vocabulary(terms, np.ones(len(terms))).terms(asked)
    place = {int(h): i for i, h in enumerate(terms)}
    assert dict(zip(known.tolist(), term.tolist())) == {i: place[int(h)] for i, h in enumerate(asked) if int(h) in place}
    known, term = toxicity.Vocabulary(terms[:0], np.ones(0)).terms(asked)
    assert len(known) == len(term) == 0


def test_bytes_are_summed_once_for_all_terms(monkeypatch):
    calls = []
    plain = toxicity.spans_hash
    monkeypatch.setattr(toxicity, "spans_hash", lambda *a: calls.append(1) or plain(*a))
    of, hashes = toxicity.term_hashes([b"abcd abcdef", b"", b"abcdz"])
    # Whole words, then beginnings of four and five bytes; a word and a beginning of equal bytes are two terms.
    assert of.tolist() == [0, 0, 2, 0, 2, 0] and len(set(hashes.tolist())) == 5 and hashes[3] == hashes[4]
    assert len(calls) == 1


def test_frequent_terms_bound_the_search_from_the_start():
    """A text whose frequent terms already rule out most blocks visits no others, and what it finds is exact."""
    rng = np.random.default_rng(6)
    n, terms, group = 640, 12, 40
    matrix = np.zeros((n, terms + n))
    matrix[np.arange(n), 1 + np.arange(n) // group % (terms - 1)] = 1.0
    matrix[:, 0] = 0.2  # all have it, so no block is ruled out by having nothing in common
    matrix[np.arange(n), terms + np.arange(n)] = matrix[np.arange(n), terms + (np.arange(n) + 1) % n] = 0.05 + 0.05 * rng.random(n)
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    text, term = np.nonzero(matrix)
    index = toxicity.BlockMaxIndex(text, term, matrix[text, term], n, matrix.shape[1])
    for k in range(0, n, 7):
        where = np.flatnonzero(matrix[k])
        near, cosine, visited = index.nearest(where, matrix[k, where], 10, without=k)
        exact = matrix @ matrix[k]
        exact[k] = 0
        assert np.allclose(cosine, np.sort(exact)[::-1][:10]) and np.allclose(exact[near], cosine) and k not in near
        assert visited < toxicity.FIRST_BLOCKS


def test_toxic_words_are_learned(spark):
    draw = random.Random(5)
    bad = ["grobblax", "grobblish", "snurfle"]
    rows = []
    for i in range(1200):
        toxic = draw.random() < 0.15
        words = prose(10_000 + i, 40).split() + ([draw.choice(bad)] * 2 if toxic else [])
        draw.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    table = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(5000, None, "x"), (5001, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, None if i == 3 else toxic) for i, _, toxic in rows] + [(None, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score(table, toxicity.fit(table, labels)).collect()}
    held = [(found[i].predicted, toxic) for i, _, toxic in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert sum(p == t for p, t in held) >= 0.98 * len(held)
    assert found[5000].predicted == found[5001].predicted == 0 and 0 <= found[5000].score < 0.1
    assert any(found[i].evidence for i, _, toxic in rows if toxic)


def test_a_hundred_rare_toxic_words(spark):
    """Each toxic example has one of a hundred words that few others have; every term counts, so all of them are found."""
    draw = random.Random(11)
    rows = []
    for i in range(5400):
        toxic = i % 2
        words = prose(50_000 + i, 12).split() + ([f"gr{draw.randrange(100):02d}xx"] if toxic else [])
        draw.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.score(table.drop("toxic"), toxicity.fit(table.drop("toxic"), table.drop("text"))).collect()
    held = [(r.predicted, r.doc_id % 2) for r in found if r.held_out]
    assert sum(p for p, t in held if t) >= 0.9 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.1 * sum(1 - t for _, t in held)


def test_documents_with_a_term_are_counted_over_all_rows(spark):
    texts = ["abc abc def", "ABC", None, "", "xyz", "abc", "abc"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    terms, _, _ = toxicity.terms_of([b"abc def", b"only here"])
    held, documents = toxicity._frequencies(table, terms)
    of = {w: int(held[np.searchsorted(terms, toxicity.terms_of([w.encode()])[0][0])]) for w in ("abc", "def", "here")}
    assert of == {"abc": 4, "def": 1, "here": 0} and documents == len(texts)
    held, documents = toxicity._frequencies(table.limit(0), terms)
    assert not held.any() and documents == 0


def test_toxicity_without_labels(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert toxicity.score(docs, model).filter("predicted = 0").count() == docs.count()
    assert toxicity.score(no_docs, model).count() == 0


# --- main text ----------------------------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><div class="ad">Buy now, really.</div><main><h1>Head &amp; tail</h1><p><b>First  one.<br>
<p>Second&nbsp;one, with <i>markup</i>.</p><!-- <p>no</p> --><aside>See also</aside><ul><li>Point one<li>Point two</ul><div class="comments"><p>I disagree.</p></div>
</main><form><input name=q><button>Go</button></form><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html_text.extract(PAGE) == "Head & tail\nFirst one.\nSecond one, with markup.\nPoint one\nPoint two"
    unmarked = PAGE.replace("main>", "div>").replace("Second&nbsp;one", "A far longer second paragraph; it has many words, commas, and stops. More of it")
    assert "many words, commas" in html_text.extract(unmarked) and "Buy now" not in html_text.extract(unmarked)


LONG = "A long paragraph of the page, with words, commas, and stops. It goes on for a while, as body text does, and then it ends."


@pytest.mark.parametrize("layout", ["single has-sidebar", "right-sidebar no-comments"])
@pytest.mark.parametrize("container", ["article", "div"])
def test_layout_classes(layout, container):
    inner = f"<{container}><div class='article-header'><h1>Head of it</h1></div><p>{LONG}</p><p>{LONG}</p></{container}>"
    side = "<div class='sidebar'>Buy now, really.</div>"
    lines = ([] if container == "div" else ["Head of it"]) + [LONG, LONG]
    assert html_text.extract(f"<body class='{layout}'><div class='content with-sidebar'>{inner}</div>{side}</body>").split("\n") == lines


def test_ratios_decide_beside_containers():
    cards = "<article><a href='/x'>More of it</a></article>" * 3
    body = f"<div><h1>Head of it</h1><p>{LONG}</p><ul><li>Point one<li>Point two</ul><p>{LONG}</p></div>"
    assert html_text.extract(f"<body>{body}{cards}</body>").startswith(f"Head of it\n{LONG}\nPoint one\nPoint two\n{LONG}")
    inside = f"<article><h1>Head of it</h1><div>Share this</div><p>{LONG}</p><p class='note'>Short one.</p><div>Follow us</div></article><div>Other things.</div>"
    assert html_text.extract(f"<body>{inside}</body>") == f"Head of it\n{LONG}\nShort one."


def test_unmarked_page():
    page = f"<body><div class='menu'><a href='/'>Home</a></div><div><h2>Head of it</h2><p>{LONG}</p><h3>Next</h3><p>See <a href='/x'>this</a>, {LONG}</p></div><div class='footer'>Imprint</div></body>"
    assert html_text.extract(page) == f"Head of it\n{LONG}\nNext\nSee this, {LONG}"


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<p>a<b", "<!--", "<script>x", "</p></div>", "<a href='x>y", "&#xD800;&bogus;&amp", "<p " + "a" * 100_000])
def test_broken_pages(html):
    assert isinstance(html_text.extract(html), str)


def test_pages_table(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, "t"), (2, "v", "<p>" + "word, " * 100_000, "t")]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(found) == 4 and all(r.n_chars == len(r.text) for r in found)
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- URL rules ----------------------------------------------------------------------------------------------------------
def test_captures_are_judged_by_the_day(spark):
    day = dt.date
    entries = [("example.com", True, day(2024, 1, 10)), ("Example.com", False, day(2024, 3, 5)), ("a.example.com", True, day(2024, 2, 1)), ("b.org/x", True, day(2024, 1, 1)), ("b.org/x", False, day(2024, 1, 1)), ("b.org/x", False, day(2024, 1, 20)), (None, True, day(2024, 1, 1)), ("c.net", None, None)]
    captures = [
        (1, "http://www.example.com/p", day(2024, 1, 9)), (2, "http://www.example.com/p", day(2024, 1, 10)), (3, "HTTPS://A.EXAMPLE.COM:80/", day(2024, 2, 1)),
        (4, "http://a.example.com", day(2030, 1, 1)), (5, "http://www.example.com", day(2024, 3, 5)), (6, "http://b.org/x/y", day(2024, 1, 19)), (7, "http://b.org/xy", day(2024, 1, 19)),
        (8, "http://b.org/x", day(2024, 1, 20)), (9, None, day(2024, 1, 1)), (10, "junk", day(2024, 1, 1)), (11, "http://example.com", None), (2, "http://www.example.com/p", day(2024, 1, 10)), (None, "http://example.com", day(2024, 2, 1)),
    ]
    table = spark.createDataFrame([(*c, "x") for c in captures], "page_id long, url string, fetched_on date, entry string")
    listed = spark.createDataFrame(entries, "entry string, listed boolean, changed_on date")
    found = url_rules.evaluate(table, listed).collect()
    assert len(found) == len(captures)
    assert sorted(((r.page_id or 0), r.entry) for r in found if r.blocked) == [(0, "example.com"), (2, "example.com"), (2, "example.com"), (3, "a.example.com"), (4, "a.example.com"), (6, "b.org/x")]
    assert url_rules.evaluate(table, listed.limit(0)).filter("blocked").count() == 0
    assert url_rules.evaluate(table.limit(0), listed).count() == 0


def test_paths_of_entries(spark):
    day = dt.date(2024, 1, 1)
    entries = ["B.org/News", "b.org/en/spam", "HTTP://user@C.net:80/a/B/?q=1#top", "d.com/x/y/z", "d.com/x", "http://e.com"]
    urls = {
        "http://b.org/News": "b.org/News", "http://b.org/news": None, "https://B.ORG/en/spam/1.html?x=1": "b.org/en/spam", "http://b.org/en/spammer": None, "http://b.org/en": None,
        "https://c.net/a/B/c": "c.net/a/B", "https://c.net/a/b": None, "http://d.com/x/y/z/": "d.com/x/y/z", "http://d.com/x/y": "d.com/x", "http://www.e.com/p": "e.com", "http://e.com?q=/a": "e.com",
    }
    table = spark.createDataFrame([(i, u, day) for i, u in enumerate(urls)], "page_id long, url string, fetched_on date")
    listed = spark.createDataFrame([(e, True, day) for e in entries], "entry string, listed boolean, changed_on date")
    assert {r.url: r.entry for r in url_rules.evaluate(table, listed).collect()} == urls


# --- language -----------------------------------------------------------------------------------------------------------
def mixed(seed, parts):
    draw = random.Random(seed)
    roots = {"aa": ["ka", "lo", "mi", "ku"], "bb": ["sch", "ung", "ber", "ein"], "cc": ["eau", "oui", "ent", "que"]}
    return " ".join("".join(draw.choice(roots[lang]) for _ in range(draw.randint(1, 3))) for lang, n in parts for _ in range(n))


def test_marginals_are_exact():
    rng = np.random.default_rng(6)
    field = langid.Field(["a", "b", "c"], np.zeros((1, 3)), np.zeros(0, np.uint64), np.zeros((1, 3)), rng.normal(size=(3, 3)))
    sizes = [0, 1, 5, 32, 33, 150, 0]
    of, scores = np.repeat(np.arange(len(sizes)), sizes), rng.normal(size=(sum(sizes), 3)) * 3
    found = field.marginals(scores, of, len(sizes))
    at = 0
    for k, n in enumerate(sizes):
        s = scores[at : at + n]
        at += n
        if not n:
            continue
        ahead, behind = [np.exp(s[0])], [np.ones(3)]
        for t in range(1, n):
            x = (ahead[-1] @ np.exp(field.transitions)) * np.exp(s[t])
            ahead.append(x / x.sum())
        for t in range(n - 1, 0, -1):
            x = np.exp(field.transitions) @ (np.exp(s[t]) * behind[0])
            behind.insert(0, x / x.sum())
        both = np.array([a * b / (a @ b) for a, b in zip(ahead, behind, strict=True)])
        assert np.allclose(found[k], both.mean(axis=0))


def test_slope_is_the_gradient():
    rng = np.random.default_rng(7)
    scores, gold, moves = rng.normal(size=(2, 4, 3)), rng.integers(0, 3, (2, 4)), rng.normal(size=(3, 3))

    def likelihood(s, m):
        total = 0.0
        for x, g in zip(s, gold, strict=True):
            paths = [sum(x[t, p[t]] for t in range(4)) + sum(m[p[t], p[t + 1]] for t in range(3)) for p in np.ndindex(3, 3, 3, 3)]
            total += sum(x[t, g[t]] for t in range(4)) + sum(m[g[t], g[t + 1]] for t in range(3)) - np.log(np.exp(paths).sum())
        return total

    slope, moved = langid._slope(scores, gold, moves)
    for where in ((0, 1, 2), (1, 3, 0)):
        step = np.zeros_like(scores)
        step[where] = 1e-5
        assert np.isclose((likelihood(scores + step, moves) - likelihood(scores - step, moves)) / 2e-5, slope[where], atol=1e-5)
    step = np.zeros_like(moves)
    step[1, 2] = 1e-5
    assert np.isclose((likelihood(scores, moves + step) - likelihood(scores, moves - step)) / 2e-5, moved[1, 2], atol=1e-5)


def test_languages(spark, docs, no_docs):
    rows = [(i, mixed(i, [(lang, 40)]), lang) for i in range(240) for lang in [("aa", "bb", "cc")[i % 3]]]
    rows += [(1000, mixed(1, [("aa", 60), ("bb", 30)]), None), (1001, mixed(2, [("cc", 5), ("bb", 70), ("aa", 10)]), None), (1002, None, "aa"), (1003, "12 -- !", "aa"), (1004, "—", None), (None, mixed(3, [("cc", 30)]), "cc")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    field = langid.fit(table)
    found = {r.doc_id: r for r in langid.predict(table, field).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows[:240])
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows[:240])
    assert [found[i].lang_pred for i in (1000, 1001, 1002, 1003, 1004, None)] == ["aa", "bb", "und", "und", "und", "cc"]
    assert found[1000].score < found[1].score and found[1002].score == 0
    kept = langid.with_language(table, field)
    assert kept.columns == table.columns and kept.count() == len(rows) - 3
    assert langid.predict(docs, langid.fit(no_docs)).filter("lang_pred <> 'und'").count() == 0
    assert langid.predict(no_docs, field).count() == langid.with_language(no_docs, field).count() == 0


def test_every_language_is_a_label(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, " ".join([f"{chr(97 + k // 8)}{chr(105 + k % 8)}"] * 6), f"l{k}") for n, i in enumerate(ids[:244]) for k in [n % 61]]
    rows += [(i, "zyzzyx qoppaq " * 2000, "long") for i in ids[244:247]]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = langid.fit(table)
    assert set(field.labels) == {r[2] for r in rows} and len(field.labels) == 62
    assert langid.predict(table.filter("lang = 'long'"), field).filter("lang_pred = 'long'").count() == 3


def test_held_out_languages(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r.lang_pred == truth[r.doc_id] for r in queries.op10_language_crf(spark, SF).collect() if r.held_out]
    assert sum(held) >= 0.99 * len(held)


# --- pipeline -----------------------------------------------------------------------------------------------------------
def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns, name
        assert after.count() > 0.9 * before.count(), name
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def test_stages_on_awkward_rows(spark, docs, no_docs):
    for table in (docs, no_docs):
        step = table
        for _, stage in corpus_pipeline.STAGES[1:]:
            step = stage(spark, step, SF)
        assert step.count() >= (table is docs)
