"""Column names, ties, copies, stray dates and page layouts that once broke an operator or its contract."""

import datetime as dt
import random

import pytest
from cases import prose
from pyspark.sql import functions as F

from shoplake.llm import chunks, decontaminate, langid, simhash, url_rules
from shoplake.llm.html_text import extract

ODD = "doc_id long, text string, `source url` string, `source-url` string, `a.b` int, _doc long, _tie long, _n long, row string, `x``y` map<string,int>"


def odd_docs(spark, texts):
    rows = [(i, t, f"u{k}", "v", k, 1, 2, 3, "r", {"k": k}) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, ODD)


def test_stages_take_columns_of_any_name(spark):
    texts = [(1, prose(1, 80)), (2, prose(1, 80)), (3, prose(3, 80)), (4, prose(4, 20) + " " + prose(3, 60)), (5, prose(5, 60))]
    docs = odd_docs(spark, texts)
    items = spark.createDataFrame([(1, prose(5, 40))], "item_id long, text string")
    lang = docs.select("doc_id", "text", F.lit("en").alias("lang"))
    for made in (
        langid.with_language(docs, langid.fit(lang), 0.0),
        simhash.keep_first(docs),
        chunks.without_repeats(docs),
        decontaminate.without_leaks(docs, items),
    ):
        assert made.columns == docs.columns
        assert {r.doc_id for r in made.collect()} <= {1, 2, 3, 4, 5}
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == [1, 3, 4, 5]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, items).collect()) == [1, 2, 3, 4]
    assert sorted(r.doc_id for r in chunks.without_repeats(docs).collect()) == [1, 3, 4, 5]


@pytest.mark.parametrize("turn", [False, True])
def test_rows_that_differ_elsewhere_keep_the_same_one(spark, turn):
    rows = [(1, "a b c d", "en", "s1"), (1, "a b c d", "de", "s0"), (1, "a b c d", "en", "s0"), (2, "x y z w v", "fr", "s2")]
    docs = spark.createDataFrame(rows[::-1] if turn else rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert sorted(map(tuple, simhash.keep_first(docs).collect())) == [rows[1], rows[3]]


def test_a_hundred_thousand_copies_of_one_row(spark):
    text = prose(1, 120)
    copies = spark.range(100_000, numPartitions=4).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    others = spark.createDataFrame([(3, "start here " + prose(1, 120)), (9, prose(1, 120) + " the end of it"), (8, prose(8, 50))], "doc_id long, text string")
    docs = copies.unionByName(others)
    kept = simhash.keep_first(docs)
    assert kept.filter("doc_id = 7").count() <= 1
    found = chunks.remove_repeats(docs)
    counts = {r["d"]: r["n"] for r in found.groupBy(F.col("row.doc_id").alias("d")).agg(F.count_if(F.size("spans") > 0).alias("n")).collect()}
    # The passage stays in the document with the smallest number, and is taken out of every copy.
    assert counts == {3: 0, 7: 100_000, 8: 0, 9: 1}
    assert found.filter("row.doc_id = 7").select("text", "spans").distinct().count() == 1


def test_a_stray_date_costs_a_month(spark):
    captures = spark.createDataFrame(
        [(1, "http://a.org/x", dt.date(2024, 1, 5)), (2, "http://a.org/", dt.date(9999, 12, 31)), (3, "http://a.org/", dt.date(2023, 1, 5)), (4, "http://b.org/", dt.date(1, 1, 1))],
        "page_id long, url string, fetched_on date",
    )
    entries = spark.createDataFrame([(f"{h}.org", True, dt.date(2024, 1, 2)) for h in "abcdefgh"], "entry string, listed boolean, changed_on date")
    found = {r.page_id: r.blocked for r in url_rules.evaluate(captures, entries).collect()}
    assert found == {1: True, 2: True, 3: False, 4: False}


def test_captures_by_the_thousand_each_come_back(spark):
    captures = spark.range(50_000, numPartitions=4).select(F.lit(1).cast("long").alias("page_id"), F.lit("http://a.org/x").alias("url"), F.lit("2024-01-05").cast("date").alias("fetched_on"))
    entries = spark.createDataFrame([("a.org", True, dt.date(2024, 1, 5)), ("a.org", False, dt.date(2024, 1, 6))], "entry string, listed boolean, changed_on date")
    found = url_rules.evaluate(captures, entries)
    assert found.filter("blocked").count() == found.count() == 50_000


def evaluated_plainly(captures, entries):
    """Every capture against every entry, by whole URL parts."""
    days = {}
    for entry, listed, on in entries:
        host, *path = entry.split("/")
        key = "/".join([host.lower(), *(p for p in path if p)])
        days.setdefault(key, {})[on] = days.get(key, {}).get(on, False) or listed
    out = []
    for page, url, on in captures:
        host, *path = url.removeprefix("http://").split("/")
        labels, path = host.lower().split("."), [p for p in path if p]
        names = ["/".join([host.lower(), *path[:k]]) for k in range(len(path), -1, -1)]
        names += [".".join(labels[k:]) for k in range(1, len(labels) - 1)]
        hit = next((n for n in names if n in days and [v for d, v in sorted(days[n].items()) if d <= on][-1:] == [True]), None)
        out.append((page, hit is not None, hit))
    return sorted(out)


def test_rules_against_every_entry_by_case_and_depth(spark):
    day = dt.date(2024, 1, 1)
    urls = ["a.org", "a.org/News", "a.org/news", "A.org/en/Spam/1", "x.a.org/en", "y.x.a.org/en/spam", "b.org/q", "b.org/Q/r/s", "c.co/z"]
    captures = [(k * 10 + d, f"http://{u}", day + dt.timedelta(30 * d)) for k, u in enumerate(urls) for d in range(5)]
    names = ["a.org/News", "A.ORG/en/Spam", "x.a.org", "b.org/Q/r", "b.org", "y.x.a.org/en", "c.co"]
    entries = [(n, (k + j) % 3 != 0, day + dt.timedelta(17 * j + 5 * k)) for k, n in enumerate(names) for j in range(6)]
    found = url_rules.evaluate(
        spark.createDataFrame(captures, "page_id long, url string, fetched_on date"), spark.createDataFrame(entries, "entry string, listed boolean, changed_on date")
    )
    assert sorted((r.page_id, r.blocked, r.entry) for r in found.collect()) == evaluated_plainly(captures, entries)


# --- pages -----------------------------------------------------------------------------------------------------------------
BODY = "".join(f"<p>Sentence number {k} of the article, which is long enough, says something; and more.</p>" for k in range(3))
LINES = [f"Sentence number {k} of the article, which is long enough, says something; and more." for k in range(3)]
THREAD = "".join(f"<p>Reader {k} writes, at some length, what they think of it all, again and again.</p>" for k in range(12))


@pytest.mark.parametrize(
    "page",
    [
        "<article>{body}</article><div id='comments'>{thread}</div>",
        "<article>{body}</article><section class=\"comments\"><h2>Comments</h2>{thread}</section>",
        "<article>{body}<div class='comment-list'>{thread}</div></article>",
        "<main>{body}<ol class='comments'><li><article class='comment'>{thread}</article></li></ol></main>",
        "<article>{body}</article><div id=disqus_thread>{thread}</div>",
    ],
)
def test_comments_go_whatever_their_share(page):
    assert extract(f"<html><body>{page.format(body=BODY, thread=THREAD)}</body></html>").split("\n") == LINES


@pytest.mark.parametrize("layout", ["no-comments", "has-comments single", "comments-open", "with-comments has-sidebar"])
def test_layout_words_about_comments_are_not_comments(layout):
    assert extract(f"<body class='{layout}'><div class='{layout}'><article>{BODY}</article></div></body>").split("\n") == LINES


def test_tables_links_and_details_of_an_article_stay():
    page = (
        f"<body><nav><a href=x>Home</a><a href=y>All</a></nav><article>{BODY}<table><caption>Sales</caption><tr><th>Year</th><th>Sum</th></tr>"
        "<tr><td>2023</td><td>1.5</td></tr></table><p><a href=z>See the whole report here</a></p>"
        "<details><summary>How it was counted</summary>By hand.</details></article><footer>Imprint</footer></body>"
    )
    assert extract(page).split("\n") == [*LINES, "Sales", "Year", "Sum", "2023", "1.5", "See the whole report here", "How it was counted", "By hand."]


def test_white_space_of_any_kind_is_one_space():
    assert extract("<article><p>　One two   three .　</p></article>") == "One two three ."


def ratios_plainly(nodes):
    """Fused ratios, node by node and path by path."""
    import math

    from shoplake.llm.html_text import NAMED, OUTSIDE, PUNCTUATION, SIGMA

    key = [(n.path, n.inside, n.poor, n.named) for n in nodes]
    ratio = {}
    for k in set(key):
        own = [n for n, o in zip(nodes, key, strict=True) if o == k]
        length = sum(len(n.text.strip()) for n in own) / len(own)
        ratio[k] = length * (1 + sum(len(PUNCTUATION.findall(n.text)) for n in own) / len(own))
    smooth = []
    for i in range(len(nodes)):
        near = [(math.exp(-0.5 * (d / SIGMA) ** 2), ratio[key[i + d]]) for d in range(-3, 4) if 0 <= i + d < len(nodes)]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    marked = any(n.inside and not n.poor for n in nodes)
    fused = {}
    for k in set(key):
        own = [s for s, o in zip(smooth, key, strict=True) if o == k]
        weight = (not k[2]) * (NAMED if k[3] else 1) * (OUTSIDE if marked and not k[1] else 1)
        fused[k] = math.sqrt(ratio[k] * sum(own) / len(own)) * weight
    return [fused[k] for k in key]


def test_ratios_against_sums_by_hand(spark):
    from shoplake.llm.html_text import _BLANKS, _ratios, text_nodes

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(60).collect()
    for html in [*(p.html for p in pages if p.html), f"<body><div class=ad>Buy</div>{BODY}<div class='side'>x</div>{THREAD}</body>"]:
        nodes = [n for n in text_nodes(html) if n.text.strip(_BLANKS)]
        if nodes:
            of, fused, _ = _ratios(nodes)
            assert [fused[p] for p in of] == pytest.approx(ratios_plainly(nodes))


# --- benchmark items ---------------------------------------------------------------------------------------------------------
CHINESE = "小明有十二个苹果，他给了小红五个，又买了三个。现在小明一共有多少个苹果？"
THAI = "สมชายมีแอปเปิลสิบสองลูกเขาให้เพื่อนไปห้าลูกแล้วซื้อเพิ่มอีกสามลูกตอนนี้เขามีกี่ลูก"
CYRILLIC = "В коробке лежит 12 яблок, а Пётр взял из неё 5 штук и отдал их Марии. Сколько яблок осталось в коробке у Петра после этого?"
GREEK = "Στο κουτί υπάρχουν 12 μήλα και ο Γιώργος πήρε 5 από αυτά για τη Μαρία. Πόσα μήλα έμειναν στο κουτί στο τέλος;"


def found_in(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc, r.item_id, r.reparameterised) for r in decontaminate.leaks(docs, bench).collect())


@pytest.mark.parametrize("item", [CHINESE, THAI])
def test_items_in_scripts_without_blanks(spark, item):
    around = "这是另一段完全不同的文字，与题目没有任何关系。" if item == CHINESE else "ข้อความนี้ไม่เกี่ยวข้องกับโจทย์ข้างต้นเลย"
    texts = [around + item + around, prose(1, 30) + " " + item, around * 3, prose(2, 60)]
    assert [x[:2] for x in found_in(spark, texts, [item])] == [(0, 0), (1, 0)]


def test_items_in_cyrillic_and_greek(spark):
    renamed = CYRILLIC.replace("12", "30").replace("5", "7").replace("Пётр", "Иван").replace("Марии", "Анне").replace("Петра", "Ивана")
    greek = GREEK.replace("12", "40").replace("5", "6").replace("Γιώργος", "Νίκος").replace("Μαρία", "Ελένη")
    texts = [CYRILLIC, CYRILLIC.upper(), renamed, "Начало. " + CYRILLIC.lower(), GREEK, greek, "Совсем другой текст о погоде в городе и о том, что было вчера вечером."]
    found = found_in(spark, texts, [CYRILLIC, GREEK])
    assert [x[:2] for x in found] == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 1)]
    assert {x[0] for x in found if x[2]} >= {2, 5}


def test_lower_case_is_that_of_unicode():
    import numpy as np

    for first, last in ((0x41, 0x5A), (0xC0, 0xDE), (0x391, 0x3A9), (0x410, 0x42F), (0x401, 0x401)):
        for code in range(first, last + 1):
            text = chr(code)
            if text.lower() != text and len(text.lower().encode()) == len(text.encode()):
                made = decontaminate.lowered(np.frombuffer(f"x{text}x".encode(), np.uint8)).tobytes().decode()
                assert made == f"x{text.lower()}x"
    same = "éßяё ωσ 中 ×"
    assert decontaminate.lowered(np.frombuffer(same.encode(), np.uint8)).tobytes().decode() == same


def test_short_items_fill_a_line_or_a_sentence(spark):
    texts = [
        "We went to Paris in spring and again in autumn.",
        "Question 1\nParis\nQuestion 2",
        "I forgot. What is the capital of France? I asked.",
        "She told me what is the capital of France when it rains, more or less.",
        "What is the capital of France",
    ]
    found = found_in(spark, texts, ["Paris", "What is the capital of France?", "again"])
    assert [x[:2] for x in found] == [(1, 0), (2, 1), (4, 1)]


def windows_plainly(text):
    """Exact 8-token windows of a lower-cased text, by a regular expression."""
    import re

    tokens = re.findall(r"\d+(?:[.,]\d+)*|\w+", text.lower())
    return {tuple(tokens[k : k + 8]) for k in range(len(tokens) - 7)}


def stemmed(draw, n):
    """Items and documents in which stems of 9 to 14 tokens are held by many, whole items by some, and one document has no number."""

    def words(k):
        return ["".join(draw.choice(["ka", "lo", "mi", "tu", "re"]) for _ in range(4)) for _ in range(k)]

    stems = [words(k) for k in (9, 11, 14)]
    items = [[*draw.choice(stems), *words(draw.choice([2, 9, 24]))] for _ in range(n)] + [words(30), stems[0]]
    texts = []
    for k in range(n):
        part = draw.choice([draw.choice(stems), draw.choice(items), draw.choice(items)[:16], [*stems[0], *words(3), *stems[1]]])
        texts.append((None if k % 7 == 3 else k, " ".join([*words(15), *part, *words(15)])))
    return texts + texts[:3], [" ".join(x) for x in items]


@pytest.mark.parametrize("seed", [1, 2])
def test_search_from_rare_windows_loses_nothing(spark, monkeypatch, seed):
    texts, items = stemmed(random.Random(seed), 40)
    table = spark.createDataFrame(texts, "doc_id long, text string")
    listed = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = sorted(map(str, decontaminate.leaks(table, listed).collect()))
    by_rarity, marked = decontaminate._by_rarity, []

    def from_all(*args):
        made = by_rarity(*args)
        marked.append(made.filter("shared").count())
        return made.withColumn("shared", F.lit(False))

    monkeypatch.setattr(decontaminate, "_by_rarity", from_all)
    assert sorted(map(str, decontaminate.leaks(table, listed).collect())) == found
    assert marked[0] > 0 and any("doc=None" in x for x in found)


def test_a_shared_stem_forms_no_pairs(spark, monkeypatch):
    """Documents that hold but the stem of many items meet none of them while pairs are gathered."""
    stem = "all of the old books in this house were"
    items = [f"{stem} read by some {a} and {b} who came here late in those years" for a in ("men", "boys", "girls") for b in ("cats", "dogs", "birds")]
    table = spark.createDataFrame([(k, f"we heard that {stem} gone by day {k} or so") for k in range(50)], "doc_id long, text string")
    listed = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    stored, cut = {}, decontaminate.cut

    def kept(df, label):
        stored[label] = cut(df, label)
        return stored[label]

    monkeypatch.setattr(decontaminate, "cut", kept)
    assert decontaminate.leaks(table, listed).count() == 0
    assert stored["windows-seen"].count() >= 50 and stored["meetings"].count() == 0


def test_templates_against_plain_windows(spark):
    """Items with other numbers and names: each is found where the plain windows of the masked texts meet often enough."""
    import random
    import re

    draw, names = random.Random(4), ["Anna", "Boris", "Clara", "David", "Emma", "Felix"]
    stems = [f"yesterday {{n}} bought {{a}} {w} boxes of pens for {{b}} friends at the {v} market and kept {{c}} of them in the {u} drawer" for w, v, u in zip("red blue green large small".split(), "old new far near main".split(), "top low left right wide".split(), strict=True)]

    def fill(stem):
        return stem.format(n=draw.choice(names), a=draw.randint(2, 99), b=draw.randint(2, 99), c=draw.randint(2, 99))

    items = [fill(s) for s in stems]
    texts = [prose(k, 20).lower() + " . " + fill(stems[k % 5]) + " . " + prose(50 + k, 20).lower() if k % 2 else prose(k, 60) for k in range(30)]

    def masked(text):
        return windows_plainly(re.sub(r"\d+", "0", re.sub("|".join(names), "name", text)))

    expected = [(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if len(masked(t) & masked(item)) >= 0.3 * len(masked(item))]
    assert len(expected) == 15
    assert [x[:2] for x in found_in(spark, texts, items)] == expected


# --- the pipeline -------------------------------------------------------------------------------------------------------------
def test_pipeline_against_its_stages_and_cleans_up(spark):
    """Every stage's result by a plain rule on its own input, and the packed pieces of what is left."""
    import corpus_pipeline
    from shoplake.llm.common import cut, table
    from shoplake.session import scratch_made

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = cut(stage(spark, docs, sf), name)
        assert made.columns == docs.columns
        before, after = ({r.doc_id: r.text for r in df.collect()} for df in (docs, made))
        assert set(after) <= set(before)
        kept[name] = (before, after)
        docs = made
    before, after = kept["language_id"]
    assert all(not any(c.isalpha() for c in before[d] or "") or len(before[d].split()) < 12 for d in set(before) - set(after))
    before, after = kept["simhash_near_dedup"]
    prints = {r.doc_id: (r.fp, r.root) for r in simhash.near_duplicates(spark.createDataFrame([*before.items()], "doc_id long, text string")).collect()}
    linked = {a: {b for b in prints if bin((prints[a][0] ^ prints[b][0]) & (1 << 64) - 1).count("1") <= 2} for a in prints}
    roots = {}
    for d in sorted(prints):  # smallest number that can be reached
        seen, todo = {d}, [d]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        roots[d] = min(seen)
    assert set(after) == set(roots.values())
    before, after = kept["substring_dedup"]
    words = {d: t.split() for d, t in before.items()}
    places = {}
    for d in sorted(words):
        for k in range(len(words[d]) - 49):
            places.setdefault(tuple(words[d][k : k + 50]), []).append(d)
    repeats = {g: ds for g, ds in places.items() if len(set(ds)) > 1}
    joined = {d: " ".join((t or "").split()) for d, t in after.items()}
    # A passage of 50 words is whole in one document at most; texts without one are as they were.
    assert all(sum(" ".join(g) in joined.get(d, "") for d in set(ds)) <= 1 for g, ds in repeats.items())
    before, after = kept["decontamination"]
    items = [" ".join(r.text.lower().split()) for r in table(spark, sf, "benchmark").collect()]
    holds = {d for d, t in before.items() if any(i in " ".join(t.lower().split()) for i in items if len(i.split()) >= 8)}
    assert not holds & set(after)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    start = len(scratch_made(spark))
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, packed))
    # The last stage's input and what it stored itself are left.
    left = [f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in scratch_made(spark)[start:]]
    assert left[0] == "llm-decontamination" and not {"llm-language_id", "llm-chunk-counts", "llm-simhash-rows"} & set(left)
