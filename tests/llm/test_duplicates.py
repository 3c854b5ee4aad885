"""SimHash, components and substring deduplication against brute force."""

import itertools
import random
import re

import numpy as np
import xxhash
from cases import docs, no_docs, prose  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplake.llm import chunks, simhash
from shoplake.llm.components import components


def slow_fingerprint(text):
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAéÉ \t\x0b\x1c.b"), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(3)
    links = [(k, k + 1) for k in range(100, 180)] + [(500, 500 + k) for k in range(1, 60)] + [(draw.randrange(1000, 1200), draw.randrange(1000, 1200)) for _ in range(90)]
    links = [(b, a) if draw.random() < 0.5 else (a, b) for a, b in links if a != b] + [(-5, 7), (7, -5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == roots({n for e in links for n in e}, links)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def crowded_prints():
    """Random fingerprints, pairs near each other, and a crowd around one point."""
    draw = random.Random(8)
    out = [draw.getrandbits(64) for _ in range(150)]
    out += [p ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for p in out[:60]]
    centre = draw.getrandbits(64)
    for _ in range(120):
        p = centre
        for _ in range(draw.randrange(6)):
            p ^= 1 << draw.randrange(64)
        out.append(p)
    return sorted(set(out))


def test_links_connect_all_within_the_distance(spark):
    prints = crowded_prints()
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    table = spark.createDataFrame([(signed[p],) for p in prints], "fp long")
    for distance, crowd in itertools.product((0, 1, 2), (5, 10_000)):
        near = [(signed[a], signed[b]) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= distance]
        found = [tuple(r) for r in simhash.links(table, distance, crowd).collect()]
        assert roots(signed.values(), found) == roots(signed.values(), near)


def test_fit_obeys_the_pigeonhole_sum():
    values = np.random.default_rng(1).integers(0, 2**63, 2000, dtype=np.uint64)
    for n in (0, 1000, 10**7, 10**9, 10**11):
        for distance in (0, 1, 2):
            parts = simhash.fit(values, n, distance)
            # Partitions left out count as -1 each; what is left must reach the sum with at least as many.
            assert sum(p.threshold + 1 for p in parts) >= distance + 1
            assert len({b for p in parts for b in p.bits}) == sum(len(p.bits) for p in parts)


def test_near_duplicates(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    prints = [slow_fingerprint(t) for _, t in docs.select("doc_id", "text").collect()]
    assert sorted(r.fp % (1 << 64) for r in rows) == sorted(prints)
    near = [(a, b) for a, b in itertools.combinations(sorted(set(prints)), 2) if (a ^ b).bit_count() <= 2]
    root, least = roots(set(prints), near), {}
    for r in rows:
        if r.doc_id is not None:
            key = root[r.fp % (1 << 64)]
            least[key] = min(least.get(key, r.doc_id), r.doc_id)
    assert all(r.component_id == least.get(root[r.fp % (1 << 64)]) for r in rows)


def test_one_of_each_group_stays(docs, no_docs):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 7 not in ids and 6 in ids and 8 not in ids
    assert ids.count(13) == 2  # one of each text
    assert len(ids) == len({r.root for r in simhash.near_duplicates(docs).collect()})
    assert simhash.keep_first(no_docs).count() == 0


def test_cuts_do_not_depend_on_what_is_far():
    passage = prose(50, 200)
    digests = []
    for before, after in (("", ""), (prose(51, 33) + " ", ""), (prose(52, 8) + "\n", " " + prose(53, 5))):
        data = (before + passage + after).encode()
        of, first, end, _ = chunks.cut_words([prose(54, 20).encode(), data])
        digests.append({data[a:b] for t, a, b in zip(of, first, end, strict=True) if t == 1})
    for other in digests[1:]:
        assert len(digests[0] & other) >= len(digests[0]) - 4


def test_chunks_cover_the_text():
    for text in (prose(1, 300), "the " * 1000, "x" * 100_000, " \n ", "", "é\n\nü  a"):
        _, first, end, words = chunks.cut_words([text.encode()])
        joined = " ".join(text.encode()[a:b].decode() for a, b in zip(first, end, strict=True))
        assert joined.split() == text.split()
        assert words.sum() == len(text.split()) and (words <= chunks.LONGEST).all()


def test_passages(docs, no_docs):
    rows = chunks.repeated_passages(docs).collect()
    found = {(r.doc_id, r.first_doc_id) for r in rows}
    assert {(2, 1), (3, 1), (5, 4), (None, 1)} <= found
    assert not {1, 4, 6, 7, 9, 10, 12} & {r.doc_id for r in rows}
    texts = {r.doc_id: r.text for r in docs.filter("doc_id = 5").collect()}
    (r,) = [r for r in rows if r.doc_id == 5]
    assert texts[5].encode()[r.start_byte : r.end_byte].decode().strip() in prose(99, 70)
    assert 50 <= r.n_words <= 70
    assert chunks.repeated_passages(no_docs).count() == 0


def test_removal_keeps_first_places_and_other_columns(docs, no_docs):
    kept = chunks.without_repeats(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert 1 in ids and 2 not in ids  # nothing of a copy is left
    assert ids.count(6) == ids.count(7) == 1  # untouched, empty as they are
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == whole[r.doc_id] for r in rows if r.doc_id in (1, 4, 6, 7, 9, 10, 12, 20))
    (five,) = [r for r in rows if r.doc_id == 5]
    assert five.text.startswith(prose(6, 80)) and len(five.text.split()) < 110 and five.n_chars == len(five.text)
    assert chunks.without_repeats(no_docs).count() == 0
