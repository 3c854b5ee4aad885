"""Benchmark decontamination over template windows.

Texts and benchmark items are turned into templates: numbers, names and units give way to typed placeholders, other words are
lower-cased. Windows of ``WINDOW`` template tokens are hash-joined. A document's windows on one item must line up
(the same distance between their places, or one that a few tokens more or less explain), and most slots that the placeholders left must be
filled consistently: what stands in one slot value's place stands in all of them. So a question that comes back with other numbers or names is found like a
verbatim copy, and a chance meeting of placeholders is not. A capitalised word that opens a sentence may be a name or not;
windows that hold such words are compared in both readings. Every window is also compared by its exact tokens, whatever they are; windows
with few words only so. An item of fewer tokens than a window is looked for in windows of its own size that fill a line or a
sentence. Case is folded in Latin, Greek and Cyrillic script; characters of scripts without blanks are tokens of their own. Units and numbers in
words are English.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplake.llm.common import BYTE_CODES, array, cut, joined, mapped, packed_rows, runs, slices, spans_hash, text_key, texts_of

WINDOW = 8
#: Of a window's tokens, at least so many must be words to be compared as a template: placeholders alone are no evidence.
LEAST_WORDS = 4
#: Aligned windows of an item that a document must have, as a share of the item's windows.
LEAST_SHARE = 0.3
#: Or so many of them in a row: 13 tokens.
LEAST_RUN = 6
#: Tokens by which the distance of places may change within one alignment, each time.
SHIFT = 8
#: Of an alignment's pairs of slot values, at most this share, and one pair anyway, may contradict the others.
MOST_ODD = 1 / 3
#: Places of the table of benchmark windows that tasks look windows up in before the join: a bound on its size.
TABLE_BITS = 22

#: Units that count as such after a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yard yards mile miles g kg mg gram grams kilogram kilograms t ton tons lb lbs pound pounds oz "
    "l ml liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents percent kmh mph hz khz mhz ghz kb mb gb tb w kw mw v a c f k"
).split()
#: Numbers as words, with the figures they stand for.
NUMBER_WORDS = {
    word: str(value)
    for value, word in [
        *enumerate(
            "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
        ),
        *((10 * k, word) for k, word in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)),
        (100, "hundred"),
        (1000, "thousand"),
        (1_000_000, "million"),
        (1_000_000_000, "billion"),
    ]
}
NUMBER, NAME, UNIT = 1, 2, 3

_WORD, _DIGIT, _UPPER = (np.zeros(256, bool) for _ in range(3))
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT[48:58] = True
_UPPER[65:91] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: After these, with or without white space, a capital letter begins a sentence and is no sign of a name.
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;\n\"()[]{}*#-")] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r")] = True
#: Make an expression of figures; figures without them are a list, which is no evidence.
_SIGN = np.zeros(256, bool)
_SIGN[list(b"+-*/=<>^%")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True
#: Joins the digits on both sides to one number.
_INSIDE = np.zeros(256, bool)
_INSIDE[list(b".,")] = True


#: Scripts that write words without blanks between them (Thai to Khmer, kana, Han, their extensions), as code points.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: Signs beyond ASCII that end a sentence; all others, and white space, only part words.
_ENDS = re.compile("[。．！？；：…‼⁇⁈⁉؟۔।॥։]")
_SIGNS = re.compile(r"[^\w\s\x00-\x7f]|[^\S\x00-\x7f]")
#: Letters of two bytes whose capitals have the same number of bytes: lead byte, first and last capital, what lower case adds to the second
#: byte, and lead byte and subtrahend where that leaves its range.
_CASED = ((0xC3, 0x80, 0x9E, 0x20), (0xCE, 0x91, 0xA9, 0x20), (0xD0, 0x90, 0xAF, 0x20))


def spaced(text: str) -> str:
    """A text with its characters told apart as ASCII has them: signs beyond it as blanks or stops, and each character of a script
    without blanks as a word of its own."""
    if text.isascii():
        return text
    return _SIGNS.sub(" ", _ENDS.sub(" . ", _UNSPACED.sub(r" \g<0> ", text)))


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the two-byte Latin, Greek and Cyrillic letters."""
    out = _LOWER[data]
    before = np.zeros(len(data), np.uint8)
    before[1:] = data[:-1]
    for lead, first, last, step in _CASED:
        at = np.flatnonzero((before == lead) & (data >= first) & (data <= last) & ~((lead == 0xC3) & (data == 0x97)))
        moved = data[at].astype(np.int64) + step
        # Past the end of its range a letter goes on under the next lead byte.
        over = moved > 0xBF
        out[at] = np.where(over, moved - 0x40, moved)
        out[at[over] - 1] = lead + 1
    yo = np.flatnonzero((before == 0xD0) & (data == 0x81))
    out[yo], out[yo - 1] = 0x91, 0xD1
    return out


def _word_hash(words: list[str]) -> np.ndarray:
    data, offsets = joined([w.encode() for w in words])
    return spans_hash(BYTE_CODES[data], offsets[:-1], offsets[1:] - 1)


_UNIT_HASHES = np.sort(_word_hash(UNITS))
_SPELLED = _word_hash(list(NUMBER_WORDS))
_FIGURES = _word_hash(list(NUMBER_WORDS.values()))[np.argsort(_SPELLED)]
_SPELLED.sort()


#: The codes of placeholders, by kind.
_MARKS = np.array([0, 0x1D3F5A77C1, 0x2E9B6C88D3, 0x3FA77D99E5], np.uint64)


class Templates:
    """The template tokens of many texts.

    ``of``: text number of each token; ``start``, ``end``: its bytes in ``data``; ``kind``: 0 for a word, else the placeholder;
    ``code``: what templates are compared by; ``exact``: a hash of the lower-cased token; ``value``: the same with numbers in figures;
    ``opens``: whether it is a word that may be a name, as it is capitalised where a sentence begins.
    """

    def __init__(self, texts: list[bytes]):
        data, offsets = joined(texts)
        small = lowered(data)
        word = _WORD[data]
        if len(data) > 2:
            word = word.copy()
            word[1:-1] |= _INSIDE[data[1:-1]] & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
        start, end = runs(word)
        self.data, self.start, self.end, self.small = data, start, end, small
        self.of = np.searchsorted(offsets, start, side="right") - 1
        self.offsets = offsets
        self.exact = spans_hash(BYTE_CODES[small], start, end)
        if not len(start):
            self.kind, self.code, self.value, self.opens = np.zeros(0, np.int64), self.exact, self.exact, np.zeros(0, bool)
            self.figure = self.begins = self.ends = self.opens
            return
        numeric = np.concatenate([[0], np.cumsum(_DIGIT[data] | _INSIDE[data])])
        all_digits = _DIGIT[data[start]] & (numeric[end] - numeric[start] == end - start)
        at = np.minimum(np.searchsorted(_SPELLED, self.exact), len(_SPELLED) - 1)
        spelled = _SPELLED[at] == self.exact
        self.value = np.where(spelled, _FIGURES[at], self.exact)
        number = all_digits | spelled
        self.figure = all_digits
        after_number = np.zeros(len(start), bool)
        after_number[1:] = number[:-1] & (self.of[1:] == self.of[:-1]) & (start[1:] - end[:-1] <= 1)
        at = np.minimum(np.searchsorted(_UNIT_HASHES, self.exact), len(_UNIT_HASHES) - 1)
        unit = after_number & (_UNIT_HASHES[at] == self.exact)
        changed = np.append(small != data, np.zeros(3, bool))
        wide = (data[start] >= 0xC3) & (data[start] <= 0xD1)
        capital = changed[start] | (wide & changed[start + 1])
        second = start + 1 + wide
        # Before the word, past one blank: the beginning of the text, or a stop.
        before = np.maximum(start - 1, 0)
        before = np.where(_BLANK[data[before]] & (before > offsets[self.of]), before - 1, before)
        opening = (start == offsets[self.of]) | _STOP[data[before]]
        # Text in capitals throughout has no names to tell apart.
        shouted = (changed[second] | ((np.append(data, np.zeros(3, np.uint8))[second] >= 0xC3) & changed[second + 1])) & (second < end)
        name = capital & ~opening & ~shouted
        self.kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, 0)))
        self.opens = (self.kind == 0) & capital & opening & ~shouted
        self.code = np.where(self.kind > 0, _MARKS[self.kind], self.exact)
        # Past one blank behind the word: the end of the text, or a stop.
        behind = np.where(_BLANK[data[end]], np.minimum(end + 1, len(data) - 1), end)
        self.begins, self.ends = opening, (end >= offsets[self.of + 1] - 1) | _STOP[data[end]] | _STOP[data[behind]]

    def windows(self, size: int = WINDOW, least_words: int = LEAST_WORDS, shorter: bool = False) -> tuple[np.ndarray, ...]:
        """First token, size, hash and reading of every window that lies in one text, and whether it can be compared as a template.

        In reading 0 a sentence's first word is a word. Windows with such words that are capitalised come in reading 1 as well, where
        those are names. Both need enough words. In reading 2 all tokens are exact, and in a window of nothing but figures the signs
        between them too; figures without a sign have none. With ``shorter`` a text of fewer tokens is one window; else it has none.
        """
        n = len(self.code)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.uint64), none, none.astype(bool)
        first_of = np.flatnonzero(np.concatenate([[True], self.of[1:] != self.of[:-1]]))
        last = np.append(first_of[1:], n)
        short = (last - first_of < size) & shorter
        first = np.flatnonzero(np.arange(n) + size <= np.repeat(last, last - first_of))
        ends = first + size
        first, ends = np.append(first, first_of[short]), np.append(ends, last[short])

        def count(what: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(what)])
            return sums[ends] - sums[first]

        words, names = count(self.kind == 0), count(self.opens)
        plain, named = words >= least_words, (names > 0) & (words - names >= least_words)
        figures = count(self.figure) == ends - first
        exact = ~figures & (~plain | (words < ends - first))
        signs = np.concatenate([[0], np.cumsum(_SIGN[self.data])])
        signed = np.flatnonzero(figures)
        signed = signed[signs[self.start[ends[signed] - 1]] > signs[self.end[first[signed]]]]
        hashes = [
            spans_hash(self.code, first[plain], ends[plain]),
            spans_hash(np.where(self.opens, _MARKS[NAME], self.code), first[named], ends[named]),
            spans_hash(self.exact, first[exact], ends[exact]),
        ]
        if len(signed):
            seen = ~_SPACE[self.small]
            before = np.concatenate([[0], np.cumsum(seen)])
            hashes.append(spans_hash(BYTE_CODES[self.small[seen]], before[self.start[first[signed]]], before[self.end[ends[signed] - 1]]))
        parts = [np.flatnonzero(plain), np.flatnonzero(named), np.flatnonzero(exact), signed]
        picked = np.concatenate(parts)
        reading = np.repeat([0, 1, 2, 2], [len(x) for x in parts])
        return first[picked], (ends - first)[picked], np.concatenate(hashes), reading, (plain | named)[picked]

    def slots(self, first: int, size: int, reading: int) -> list[int]:
        """The values of a window's placeholder tokens, in order."""
        if reading == 2:
            return []
        stop = first + size
        held = self.kind[first:stop] > 0
        if reading:
            held = held | self.opens[first:stop]
        return self.value[first:stop][held].view(np.int64).tolist()


WINDOWS = "doc long, tie long, window long, place int, slots array<long>, size int, worded boolean"


def _windows(batches: Iterator[pa.RecordBatch], sizes: list[int], least_words: int, table: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The windows of some sizes that ``table`` has; without one, all windows of the only size and texts of fewer tokens."""
    for batch in slices(batches):
        made = Templates([spaced(t).encode() for t in texts_of(batch)])
        for size in sizes:
            first, length, hashes, reading, worded = made.windows(size, least_words, table is None)
            if table is not None:
                kept = table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
                if size < WINDOW and len(first):
                    # So few words are an item only where they fill a line or a sentence.
                    kept &= made.begins[first] & made.ends[first + length - 1]
                first, length, hashes, reading, worded = first[kept], length[kept], hashes[kept], reading[kept], worded[kept]
            of = made.of[first]
            begin = np.searchsorted(made.of, of)
            slots = [made.slots(*x) for x in zip(first.tolist(), length.tolist(), reading.tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(of)), batch.column(2).take(pa.array(of)), array(hashes.view(np.int64), pa.int64())]
            columns += [array((first - begin).astype(np.int32), pa.int32()), array(slots, pa.list_(pa.int64()))]
            columns += [array(length.astype(np.int32), pa.int32()), array(worded, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "tie", "window", "place", "slots", "size", "worded"])


def _consistent(meets: list[dict]) -> bool:
    """Whether one value stands in for the same value over the windows' slots, both ways, for enough of the pairs of values.

    Of pairs that contradict each other the more frequent one counts, then the one that is the same on both sides.
    """
    pairs = Counter(p for m in meets for p in zip(m["slots"], m["item_slots"], strict=True))
    there, back, odd = {}, {}, 0
    for x, y in sorted(pairs, key=lambda p: (-pairs[p], p[0] != p[1], p)):
        if x in there or y in back:
            odd += 1
        else:
            there[x], back[y] = y, x
    return odd <= max(1, MOST_ODD * len(pairs))


def _aligned(meets: list[dict]) -> Iterator[list[dict]]:
    """The meetings at each distance between the two places, and chains of them over neighbouring distances.

    A chain goes forward in both texts. Each meeting is put on the longest chain that ends at most ``SHIFT`` tokens off.
    """
    by: dict[int, list[dict]] = {}
    ends: dict[int, tuple] = {}
    extended: set[int] = set()
    for m in meets:
        d = m["place"] - m["at"]
        by.setdefault(d, []).append(m)
        near = (ends[k] for k in range(d - SHIFT, d + SHIFT + 1) if k in ends)
        longest = max((e for e in near if e[1]["at"] < m["at"] and e[1]["place"] < m["place"]), key=lambda e: e[0], default=None)
        if longest:
            extended.add(id(longest))
        if d in ends and ends[d] is not longest and id(ends[d]) not in extended:
            yield _chain(ends[d])
        ends[d] = (longest[0] + 1 if longest else 1, m, longest)
    yield from by.values()
    for e in ends.values():
        if id(e) not in extended:
            yield _chain(e)


def _chain(end: tuple | None) -> list[dict]:
    out = []
    while end:
        out.append(end[1])
        end = end[2]
    return out[::-1]


def _longest_run(meets: list[dict]) -> int:
    """The most meetings in a row, one token further in both texts each."""
    run = most = 1
    for a, b in zip(meets, meets[1:]):
        run = run + 1 if b["at"] - a["at"] == b["place"] - a["place"] == 1 else 1
        most = max(most, run)
    return most


def _met(meets: list[dict]) -> list[dict]:
    """One meeting for each pair of places: that of the template, if it has slots, else that of the exact tokens."""
    best: dict[tuple[int, int], dict] = {}
    for m in meets:
        where = m["place"], m["at"]
        if where not in best or (not m["slots"], len(m["slots"])) < (not best[where]["slots"], len(best[where]["slots"])):
            best[where] = m
    return [best[where] for where in sorted(best)]


FOUND = "doc long, tie long, item_id long, n_windows long, n_item_windows long, reparameterised boolean"


def _judged(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for row in batch.to_pylist():
            best, changed = 0, False
            for meets in _aligned(_met(row["meets"])):
                n, worded = len(meets), sum(m["worded"] for m in meets)
                if n <= best or (n < share * row["n_item"] and worded < max(1, share * row["n_worded"]) and _longest_run(meets) < LEAST_RUN):
                    continue
                if _consistent(meets):
                    best, changed = n, any(m["slots"] != m["item_slots"] for m in meets)
            if best:
                for column, value in zip(out, (row["doc"], row["tie"], row["item_id"], best, row["n_item"], changed), strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 5 + [pa.bool_()]
        names = ["doc", "tie", "item_id", "n_windows", "n_item_windows", "reparameterised"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, least_words: int = LEAST_WORDS, share: float = LEAST_SHARE) -> DataFrame:
    """A row for each document (doc, tie: its doc_id and a hash of its text) and benchmark item it holds.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are not read. NULL and empty texts, and items
    that are lists of figures without a word or a sign, match nothing. An item of fewer tokens than a window is one window of its
    own size, and is found where it fills a line or a sentence. Items with one text each count. Repeated rows of a document
    give one row. Empty tables give no rows. An item counts as held at a share of all its windows or of those that can be
    compared as templates, or at ``LEAST_RUN`` windows in a row, so a passage of a long item is enough.

    Tasks look each window up in a bit table of fixed size first, so few windows are shuffled; the join decides. It starts from
    each item's rarer windows (``_by_rarity``). Meetings are gathered per document and item, which the two texts' lengths bound.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("tie"))
    items = cut(mapped(items, lambda b: _windows(b, [size], least_words, None), WINDOWS), "benchmark-windows")
    bucket = F.shiftrightunsigned("window", 64 - TABLE_BITS)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[items.select(bucket.alias("b")).distinct().toArrow().column(0).to_numpy()] = True
    packed = np.packbits(table)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _windows(batches, sizes, least_words, np.unpackbits(packed).astype(bool))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("tie"))
    seen = cut(mapped(rows, look, WINDOWS).drop("size", "worded"), "windows-seen")
    counts = items.groupBy(F.col("doc").alias("item_id")).agg(
        F.count_distinct("place").alias("n_item"), F.count_distinct(F.when(F.col("worded"), F.col("place"))).alias("n_worded")
    )
    theirs = cut(_by_rarity(items, counts, share), "benchmark-by-rarity")
    meeting = F.struct("place", "at", "slots", "item_slots", "worded").alias("m")
    names = ["doc", "tie", "item_id"]
    telling = cut(seen.join(theirs.filter("NOT shared"), "window").select(*names, meeting), "meetings")
    pairs = telling.select(*names).distinct().join(theirs.filter("shared"), "item_id")
    same = F.col("p.doc").eqNullSafe(F.col("s.doc")) & (F.col("p.tie") == F.col("s.tie")) & (F.col("p.window") == F.col("s.window"))
    meets = telling.unionByName(pairs.alias("p").join(seen.alias("s"), same).select("p.doc", "p.tie", "item_id", meeting))
    pairs = meets.groupBy(*names).agg(F.collect_list("m").alias("meets")).join(counts, "item_id")
    return mapped(pairs.select(*names, "meets", "n_item", "n_worded"), lambda b: _judged(b, share), FOUND)


def _by_rarity(items: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """Windows of the items, with whether a window is ``shared``: left out where documents that may hold the item are looked for.

    A document that holds an item meets it at ``least`` places or more, so it meets one beside the ``least - 1`` places whose windows
    most items have. Those are joined only to the pairs found by the others, so items with one stem don't each meet all
    documents with it. Places whose windows no other item has stay, as they form no more pairs than there are copies.
    """
    some = F.ceil(F.lit(share) * F.col("n_item")), F.when(F.col("n_worded") > 0, F.ceil(F.lit(share) * F.col("n_worded")))
    least = counts.select("item_id", F.greatest(F.lit(1), F.least(*some, F.lit(LEAST_RUN))).alias("least"))
    held = items.groupBy("window").agg(F.count_distinct("doc").alias("n_holders"))
    windows = items.select(F.col("doc").alias("item_id"), "window", F.col("place").alias("at"), F.col("slots").alias("item_slots"), "worded").join(held, "window")
    places = windows.groupBy("item_id", "at").agg(F.max("n_holders").alias("most"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("most"), "at"))
    common = places.withColumn("rank", rank).join(least, "item_id").filter("rank < least AND most > 1").select("item_id", "at", F.lit(True).alias("shared"))
    return windows.drop("n_holders").join(common, ["item_id", "at"], "left").withColumn("shared", F.coalesce("shared", F.lit(False)))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no benchmark item."""
    found = cut(leaks(docs, benchmark).select(F.col("doc").alias("_doc"), F.col("tie").alias("_tie")).distinct(), "leaks")
    rows = packed_rows(docs)
    return rows.join(found, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("tie") == F.col("_tie")), "left_anti").select("row.*")
