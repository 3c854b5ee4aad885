"""Mixing, the conversation trie and alignment, against plain versions that hold everything at once."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from cases import SCHEMA, docs, documents, no_docs, prose  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from test_tokens import ODD, plain

from shoplake.llm import alignment, mixing, prefix_trie
from shoplake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- mixing --------------------------------------------------------------------------------------------------------------
def filled(sizes, weights, share=1.5, epochs=2.0):
    """Targets by dealing the excess anew, source by source."""
    total, targets = share * sum(sizes), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        rest = total - sum(targets[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        over = {i for i in free if weight and rest * weights[i] / weight >= epochs * sizes[i]}
        for i in over:
            targets[i] = epochs * sizes[i]
        if not over:
            for i in free:
                targets[i] = rest * weights[i] / weight if weight else 0.0
            break
        free -= over
    return targets


@pytest.mark.parametrize("sizes", [[10, 1000, 10_000], [5, 0, 7], [0, 0], [1, 10, 100, 1000, 10_000, 100_000], [3]])
def test_targets_by_water_filling(spark, sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    rows = [(f"s{i}", n, float(w)) for i, (n, w) in enumerate(zip(sizes, weights, strict=True))]
    found = mixing.water_fill(spark.createDataFrame(rows, "source string, source_size long, weight double")).orderBy("source").collect()
    assert [r.target for r in found] == pytest.approx(filled(sizes, weights))


def test_sources_are_ranked_by_code_point(spark):
    names = ["b", "a", "Z", "é", "𝒳", "￿", "", None, *(f"s{i}" for i in range(300))]
    df = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long").repartition(5)
    found = [r.source for r in mixing.ranked(df).orderBy("rank").collect()]
    assert found == [*sorted(n for n in names if n is not None), None]


def check_mix(rows, found):
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = [*sorted(s for s in size if s is not None), *([None] if None in size else [])]
    targets = filled([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    assert len(found) == len(rows)
    assert (found["taken"] <= 2 * found["size"]).all() and (found["taken"] >= 0).all()
    by = {(n, round(t, 3)): part for (n, t), part in found.groupby(["source_size", "target"])}
    for source, target in zip(order, targets, strict=True):
        part = by[size[source], round(target, 3)]
        whole = part["size"].max()
        assert abs(part["taken"].sum() - target) <= whole / 2 + 1 or len(by) < len(order)
    return dict(zip(order, targets, strict=True))


def test_mix_on_awkward_rows(spark, docs, no_docs):
    found = mixing.mixed(docs).toPandas()
    check_mix([(r[0], r[1], r[3]) for r in documents()], found)
    assert mixing.mixed(no_docs).collect() == []


def test_reruns_agree_and_seeds_differ(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    first, again = mixing.mixed(df), mixing.mixed(df.repartition(7))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    other = mixing.mixed(df, seed=12)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))


def test_mix_of_thousands_of_copies(spark):
    """One row 20,000 times: some are taken once more, and only places of the second kind tell them apart."""
    same = spark.range(20_000, numPartitions=4).selectExpr("5L AS doc_id", "'one two three' AS text", "'a' AS source")
    other = spark.range(3000, numPartitions=2).selectExpr("id + 10 AS doc_id", "repeat('w ', 1 + id % 50) AS text", "'b' AS source")
    found = mixing.mixed(same.unionByName(other), weights=(1, 1), share=0.9).toPandas()
    part = found[found.doc_id == 5]
    assert len(part) == 20_000 and len(found) == 23_000
    assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 3
    rest = found[found.doc_id != 5]
    assert abs(rest["taken"].sum() - rest["target"].iloc[0]) <= 3


def test_sizes_are_read_digit_by_digit(spark, monkeypatch):
    """With small windows the places' later digits are needed too; the sums still come out."""
    monkeypatch.setattr(mixing, "MOST", 4)
    monkeypatch.setattr(mixing, "FEWEST", 2)
    df = spark.range(6000, numPartitions=3).selectExpr("id AS doc_id", "repeat('w ', 1 + id % 9) AS text", "CAST(id % 2 AS string) AS source")
    found = mixing.mixed(df).toPandas()
    for _, part in found.groupby("target"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 9


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=40), st.floats(0, 1))
def test_first_fit_comes_near(sizes, share):
    left = share * sum(sizes)
    group = pd.DataFrame({"doc_id": range(len(sizes)), "size": sizes, "u": range(len(sizes)), "v": 0, "left": left, "whole": 1, "source_size": sum(sizes), "target": left})
    found = mixing.first_fit(group)
    extra = found["taken"] - found["size"]
    assert set(extra) <= {0, *sizes}
    # No document would have been too long by itself and still come nearer.
    assert abs(extra.sum() - left) <= max(sizes) / 2 + 1e-6


# --- conversations ----------------------------------------------------------------------------------------------------------
def trie_of(rows):
    """The trie's nodes with every prefix of every conversation held in a table."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    made = {}
    for conv, turns in own.items():
        turns.sort()
        h = zlib.crc32(str(conv).encode()) % 9
        made[conv] = tuple(t[3:] for t in sorted(own.get(conv - conv % 5, []))[:h] + turns[h:])
    members, ends, kids, leaves, saved = (defaultdict(list) for _ in range(5))
    for conv, turns in made.items():
        ends[turns].append(conv)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    kids, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, m in members.items():
        sha = hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], sha))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, node binary, shard long, `last id` long"


def turns(seed, conversations=300):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randint(1, 14)):
            text = draw.choice(["x", "é", "", None]) if draw.random() < 0.15 else "x"
            role = draw.choice(["u", "a", None]) if draw.random() < 0.1 else "u"
            rows.append((None if draw.random() < 0.01 else conv, None if draw.random() < 0.05 else turn, role, text))
    rows += [(7000 + k, 0, "u", "x") for k in range(5000)] + [(-3, 0, "u", "q"), (-7, 1, "u", "q"), (50_000, 0, "u", "long " * 50_000)]
    rows += [(60_000, k % 3, "a", f"t{k % 40}") for k in range(900)]  # a very long conversation with ties and repeated rows
    return rows


@pytest.mark.parametrize(("parts", "nodes"), [(1, 400_000), (9, 400_000), (4, 40), (3, 1)])
def test_trie_is_that_of_all_prefixes(spark, monkeypatch, parts, nodes):
    monkeypatch.setattr(prefix_trie, "SHARD_NODES", nodes)
    rows = turns(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(*r, b"n", 1, 2) for r in rows], TURNS).repartition(3)
        found = sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == trie_of(rows)


def test_shards_are_cut_where_asked(monkeypatch):
    """The limit reaches the tasks' own code: a run of sequences is cut into several shards, each whole."""
    import pyarrow as pa

    class Context:
        def partitionId(self):
            return 2

    monkeypatch.setattr(prefix_trie, "SHARD_NODES", 5)
    monkeypatch.setattr(prefix_trie, "TaskContext", type("T", (), {"get": staticmethod(Context)}))
    keys = [b"".join(bytes([c]) * 16 for c in s) for s in (b"", b"a", b"ab", b"abc", b"abd", b"b", b"bcdefgh", b"c")]
    sizes = [[1] * (len(k) // 16) for k in keys]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(sizes, pa.list_(pa.int64())), pa.array([1] * 8, pa.int64()), pa.array(range(8), pa.int64()), pa.array(["e"] * 8)],
        ["key", "sizes", "n", "least", "ends"],
    )
    made = list(prefix_trie._shards([batch.slice(0, 3), batch.slice(3)]))
    assert len(made) >= 3
    assert [b.column(0)[0].as_py() - (2 << 32) for b in made] == list(range(len(made)))
    assert sum(x is not None for b in made for x in b.column(10).to_pylist()) == 8


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    alone = spark.createDataFrame([(None, 1, "u", "x", None, None, None)], TURNS)
    assert prefix_trie.conversation_trie(alone).collect() == []


def test_conversation_without_turns_ends_at_the_root(spark):
    # Conversation 1 has fewer turns than it borrows, and the one it would borrow from is not there.
    conv = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    rows = [(conv, 0, "u", "x"), (200, 0, "u", "y")]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], TURNS)
    assert sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=str) == trie_of(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(1, 3))
def test_findclose(depths, tail):
    opened, bits = 0, [1]
    for d in depths:
        while opened > d:
            bits.append(0)
            opened -= 1
        bits.append(1)
        opened += 1
    bits += [0] * (opened + 1)
    found = prefix_trie.Parens(np.array(bits, np.int8)).findclose(np.flatnonzero(bits))
    stack, close = [], {}
    for at, bit in enumerate(bits):
        if bit:
            stack.append(at)
        else:
            close[stack.pop()] = at
    assert found.tolist() == [close[at] for at in np.flatnonzero(bits)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-9, 9), min_size=1, max_size=60), st.data())
def test_range_minima(values, data):
    ranges = [(a, data.draw(st.integers(a + 1, len(values)))) for a in data.draw(st.lists(st.integers(0, len(values) - 1), max_size=20))]
    first, last = (np.array([r[k] for r in ranges], np.int64) for k in (0, 1))
    found = prefix_trie.range_minima(np.array(values, np.int64), first, last)
    assert found.tolist() == [min(values[a:b]) for a, b in ranges]


# --- alignment ----------------------------------------------------------------------------------------------------------------
TOOL = sentencepiece.SentencePieceProcessor(model_file=B)


def bytes_b(i):
    return bytes([int(TOOL.id_to_piece(i)[3:5], 16)]) if TOOL.is_byte(i) else TOOL.id_to_piece(i).replace("▁", " ").encode()


def aligned_plainly(rows, bytes_a):
    out, counts = [], Counter()
    for doc, text in rows:
        a, b = (plain(A, " " + text), TOOL.encode(text)) if text else ([], [])
        parts_a, parts_b = [bytes_a[i] for i in a], [bytes_b(i) for i in b]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            out.append((doc, [], [], [], Counter()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in parts_a]).tolist(), np.cumsum([len(x) for x in parts_b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        groups = [([], []) for _ in cuts]
        for side, ids, of in ((0, a, of_a), (1, b, of_b)):
            for i, g in zip(ids, of, strict=True):
                groups[g][side].append(i)
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        counts.update(links.keys())
        out.append((doc, a, b, groups, links))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    found = []
    for doc, a, b, groups, links in out:
        text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in groups)
        n_best = sum(n for p, n in links.items() if counts[p] == best[p[0]])
        total = sum(n * counts[p] for p, n in links.items())
        found.append((doc, len(a), len(b), len(groups), sum(links.values()), n_best, total, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def bytes_a():
    import json

    plain(A, "x")
    from test_tokens import TOOLS

    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    return {i: bytes(code[c] for c in token) for token, i in json.loads(TOOLS[A].to_str())["model"]["vocab"].items() if all(c in code for c in token)}


MORE = ["x\r\n y;\r\n\r\r z", "end;\r", "a▁b", "a\xa0b　c  d", "中文 字字 字字", "   ", "\t\t a", "😀😀 😀", "​﻿ x", "</s> <0x0A> <unk>", "();\r x = {\r"]


def test_alignment_is_that_of_whole_texts(spark, docs, no_docs, bytes_a):
    found = sorted(map(tuple, alignment.alignment(docs, A, B).collect()), key=str)
    assert found == aligned_plainly([(r[0], r[1]) for r in documents()], bytes_a)
    odd = list(enumerate([*ODD, *MORE, None, *MORE]))
    df = spark.createDataFrame(odd, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, alignment.alignment(df, A, B).collect()), key=str) == aligned_plainly(odd, bytes_a)
    assert alignment.alignment(no_docs, A, B).collect() == []


def test_alignment_with_little_memory(bytes_a, monkeypatch):
    """Texts longer than what is looked up at once, chunks that close early, and a memory that is emptied on the way."""
    for name, value in (("PIECES_AT_ONCE", 40), ("MOST_KNOWN", 120), ("CHUNK_BYTES", 3000), ("LINKS_AT_ONCE", 50)):
        monkeypatch.setattr(alignment, name, value)
    tool = alignment.Aligner(A, B)
    rows = [(k, prose(k % 7, 5 + 17 * k % 130)) for k in range(30)] + list(enumerate(MORE))
    writer, made = alignment._Writer(tool, 0), []
    for at in range(0, len(rows), 4):
        made += writer.add(*(list(x) for x in zip(*rows[at : at + 4], strict=True)))
    made += writer.close()
    chunks = {b.column(0)[0].as_py(): b for b in made if b.column(8)[0].is_valid}
    assert len(chunks) > 5
    counts = Counter()
    for b in chunks.values():
        counts.update(dict(zip(b.column(8)[0].as_py(), b.column(9)[0].as_py(), strict=True)))
    best = Counter()
    for pair, n in counts.items():
        best[pair >> 16] = max(best[pair >> 16], n)
    found = []
    for b in made:
        if b.column(8)[0].is_valid:
            continue
        head = chunks[b.column(0)[0].as_py()]
        pairs, ends, of, times = (head.column(k)[0].as_py() for k in (8, 10, 11, 12))
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        row, unit = alignment.unpacked(b.column(7))
        sums, tops = Counter(), Counter()
        for r, u in zip(row.tolist(), unit.tolist(), strict=True):
            for k in range(*spans[u]):
                sums[r] += times[k] * counts[pairs[of[k]]]
                tops[r] += times[k] * (counts[pairs[of[k]]] == best[pairs[of[k]] >> 16])
        for r in range(b.num_rows):
            doc, *numbers, sha = (b.column(k)[r].as_py() for k in range(1, 7))
            found.append((doc, *numbers, tops[r], sums[r], sha))
    assert sorted(found, key=str) == aligned_plainly(rows, bytes_a)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40), st.lists(st.integers(1, 4), max_size=40))
def test_pointer_jumping_labels_components(a, b):
    a_ends = np.cumsum(a)
    b_ends = np.unique(np.append(np.cumsum(b)[np.cumsum(b) < a_ends[-1]] if b else [], a_ends[-1])).astype(np.int64)
    label = alignment.jump(a_ends, b_ends)
    group = np.searchsorted(sorted({*a_ends.tolist()} & {*b_ends.tolist()}), np.concatenate([a_ends, b_ends]))
    # Equal labels are equal groups, and a label is the group's last token.
    assert len(set(zip(label.tolist(), group.tolist(), strict=True))) == len(set(label.tolist())) == len(set(group.tolist()))
    assert all(np.concatenate([a_ends, b_ends])[t] == np.concatenate([a_ends, b_ends])[group == g].max() for t, g in zip(label, group, strict=True))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**24 - 1), max_size=30), max_size=10))
def test_packed_round_trip(units):
    units = [sorted(u) for u in units]
    flat, counts = np.array([x for u in units for x in u], np.int64), np.array([len(u) for u in units], np.int64)
    row, unit = alignment.unpacked(alignment.packed(flat, counts))
    assert unit.tolist() == flat.tolist() and row.tolist() == [k for k, u in enumerate(units) for _ in u]


@pytest.mark.parametrize("name", ["op11_water_filling", "op12_prefix_trie", "op13_token_alignment"])
def test_queries_return_their_contract(spark, name):
    want = {
        "op11_water_filling": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
        "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
        "op13_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    }[name]
    found = QUERIES[name](spark, SF)
    assert [f"{n} {t}" for n, t in found.dtypes] == want.split(", ")
    assert found.count() > 0
