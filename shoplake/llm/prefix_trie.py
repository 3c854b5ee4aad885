"""Prefix trie of conversations, as balanced parentheses.

Distinct conversations are sorted by their turns' digests and cut into shards. A shard's part of the trie is a sequence of
parentheses, one pair for each node in depth-first order. The excess of opened over closed ones is kept with the minima of its
blocks and a tree over those: the close of a node is the first place behind its open where the excess falls below, which delimits its
subtree. Ranks of the pair ``()`` count a subtree's leaves, and cumulative arrays give its members and savings.

Neighbouring shards share the path on which they were cut. Nodes on a shard's first and last path are passed on as partial
sums under a digest of their prefix and merged; all others are whole within their shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import cut, from_counts, mapped

#: Nodes that close a shard (a conversation with more turns is a shard of its own): they bound a task's memory.
SHARD_NODES = 400_000
#: Conversation ids are joined for their digest in runs of this many consecutive numbers.
RUN_BITS = 12
#: Bytes of a turn's digest.
WIDTH = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_MOST = np.iinfo(np.int64).max


# --- balanced parentheses --------------------------------------------------------------------------------------------------
class Parens:
    """A balanced sequence of parentheses (1 opens, 0 closes) with range minima of its excess."""

    BLOCK = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(bits.astype(np.int32) * 2 - 1, dtype=np.int32)
        self.opened = np.cumsum(bits, dtype=np.int64)
        leaf = np.zeros(len(bits), bool)
        leaf[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.leaves = np.cumsum(leaf, dtype=np.int64)
        blocks = -(-len(bits) // self.BLOCK)
        self.padded = np.full(blocks * self.BLOCK, np.iinfo(np.int32).max, np.int32)
        self.padded[: len(bits)] = self.excess
        self.width = 1 << max(0, blocks - 1).bit_length()
        self.tree = np.full(2 * self.width, np.iinfo(np.int32).max, np.int32)
        self.tree[self.width : self.width + blocks] = self.padded.reshape(-1, self.BLOCK).min(1)
        level = self.width
        while level > 1:
            self.tree[level // 2 : level] = self.tree[level : 2 * level].reshape(-1, 2).min(1)
            level //= 2

    def _in_block(self, block: np.ndarray, least: np.ndarray, after: np.ndarray) -> np.ndarray:
        """First place of each block behind ``after`` whose excess is ``least`` or lower; -1 where there is none."""
        found = np.empty(len(block), np.int64)
        for at in range(0, len(block), 1 << 15):
            some = slice(at, at + (1 << 15))
            place = block[some, None] * self.BLOCK + np.arange(self.BLOCK)
            hit = (self.padded[place] <= least[some, None]) & (place > after[some, None])
            found[some] = np.where(hit.any(1), place[:, 0] + hit.argmax(1), -1)
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where each of the parentheses opened at ``opens`` is closed."""
        least, block = self.excess[opens] - 1, opens // self.BLOCK
        found = self._in_block(block, least, opens)
        rest = np.flatnonzero(found < 0)
        node, want = self.width + block[rest], least[rest]
        climbing = np.arange(len(rest))
        while len(climbing):
            # Up, until the right neighbour's minimum is low enough.
            here = node[climbing]
            right = (here & 1) == 0
            over = right & (self.tree[np.where(right, here + 1, here)] <= want[climbing])
            node[climbing] = np.where(over, here + 1, here >> 1)
            climbing = climbing[~over]
        while len(down := np.flatnonzero(node < self.width)):
            left = 2 * node[down]
            node[down] = np.where(self.tree[left] <= want[down], left, left + 1)
        found[rest] = self._in_block(node - self.width, want, np.full(len(rest), -1))
        return found


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first:last]`` for each range; ranges are not empty."""
    out, length = np.empty(len(first), np.int64), last - first
    level = np.frexp(length.astype(float))[1] - 1
    table = values
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[first[at]], table[last[at] - (1 << k)])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    return out


# --- a shard ------------------------------------------------------------------------------------------------------------------
#: Nodes. ``node`` is set for those on the first or last path, whose numbers are partial; ``parent`` for those with such a parent.
NODES = (
    "shard long, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, bytes long, path_bytes long, on_first boolean, on_last boolean, tip boolean"
)
_NAMES = [c.split()[0] for c in NODES.split(", ")]


def _common(a: bytes, b: bytes) -> int:
    """How many leading turns two sequences share."""
    size = min(len(a), len(b))
    for at in range(0, size, WIDTH):
        if a[at : at + WIDTH] != b[at : at + WIDTH]:
            return at // WIDTH
    return size // WIDTH


def _path_keys(key: bytes) -> list[bytes]:
    """A digest of each prefix of a sequence, the empty one first."""
    state = hashlib.md5(usedforsecurity=False)
    keys = [state.digest()]
    for at in range(0, len(key), WIDTH):
        state.update(key[at : at + WIDTH])
        keys.append(state.copy().digest())
    return keys


def shard_nodes(shard: int, keys: list[bytes], sizes: np.ndarray, n: np.ndarray, least: np.ndarray, ends: pa.Array) -> pa.RecordBatch:
    """The nodes of a sorted run of distinct sequences; ``sizes`` are the bytes of all their turns, one after the other."""
    length = np.array([len(k) // WIDTH for k in keys], np.int64)
    shared = np.array([-1, *map(_common, keys[:-1], keys[1:])], np.int64)
    opened = length - shared
    seq = np.repeat(np.arange(len(keys)), opened)
    depth = from_counts(opened) + shared[seq] + 1
    total = len(depth)
    before = np.cumsum(length) - length
    size = np.where(depth > 0, np.append(sizes, 0)[before[seq] + depth - 1], 0)
    tips = np.cumsum(opened) - 1
    times, ending = np.zeros(total, np.int64), np.full(total, -1, np.int64)
    times[tips], ending[tips] = n, np.arange(len(keys))

    closed = np.append(0, depth[:-1] - depth[1:] + 1)
    place = np.arange(total) + np.cumsum(closed)
    bits = np.zeros(2 * total, np.int8)
    bits[place] = 1
    parens = Parens(bits)
    close = parens.findclose(place)
    end = parens.opened[close]  # the first node behind the subtree
    n_leaves = parens.leaves[close] - np.where(place > 0, parens.leaves[place - 1], 0)
    members = np.append(0, np.cumsum(times))
    n_convs = members[end] - members[:-1]
    savings = np.append(0, np.cumsum((n_convs - 1) * size))
    saved = savings[end] - savings[:-1]
    low = range_minima(least, seq, np.append(seq, len(keys))[end])

    # A node's parent is the last node before it that is one level higher.
    by_depth = np.argsort(depth, kind="stable")
    code = depth[by_depth] * total + by_depth
    parent = by_depth[np.maximum(np.searchsorted(code, (depth - 1) * total + np.arange(total)) - 1, 0)]
    on_first, on_last = np.arange(total) <= length[0], end == total
    spine = on_first | on_last
    inner = depth > 0
    whole = inner & ~spine
    n_children = np.bincount(parent[whole], minlength=total)

    names = np.full(total, -1, np.int64)
    first_keys, last_keys = _path_keys(keys[0]), _path_keys(keys[-1])
    names[on_first] = np.arange(len(first_keys))
    names[on_last] = len(first_keys) + np.arange(len(last_keys))
    name = pa.array(first_keys + last_keys, pa.binary())
    path_bytes = np.zeros(total, np.int64)
    path_bytes[on_first] = np.cumsum(size[on_first])
    to_spine = inner & spine[parent]

    def some(values: pa.Array, at: np.ndarray, there: np.ndarray) -> pa.Array:
        return values.take(pa.array(np.where(there, at, 0), pa.int64(), mask=~there))

    tip = np.zeros(total, bool)
    tip[-1] = True
    columns = [
        pa.array(np.full(total, shard), pa.int64()),
        some(name, names, spine),
        some(name, names[parent], to_spine),
        pa.array(low, pa.int64()),
        pa.array(depth, pa.int64()),
        pa.array(low[parent], pa.int64(), mask=~inner | to_spine),
        *(pa.array(x, pa.int64()) for x in (n_convs, n_children, n_leaves, saved)),
        some(ends, ending, ending >= 0),
        pa.array(size, pa.int64()),
        pa.array(path_bytes, pa.int64()),
        *(pa.array(x, pa.bool_()) for x in (on_first, on_last, tip)),
    ]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted sequences of a task in shards of bounded size."""
    shard, held, nodes = TaskContext.get().partitionId() << 32, [], 0

    def close() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        key, sizes, n, least, ends = (rows.column(k).combine_chunks() for k in range(5))
        flat = sizes.flatten().to_numpy()
        return shard_nodes(shard, key.to_pylist(), flat, n.to_numpy(), least.to_numpy(), ends)

    for batch in batches:
        depth = np.cumsum(batch.column(1).value_lengths().to_numpy() + 1)
        at = 0
        while at < batch.num_rows:
            done = depth[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(depth, done + SHARD_NODES - nodes, side="right")))
            held.append(batch.slice(at, to - at))
            nodes, at = nodes + int(depth[to - 1] - done), to
            if nodes >= SHARD_NODES or at < batch.num_rows:
                yield close()
                shard, held, nodes = shard + 1, [], 0
    if held:
        yield close()


# --- conversations --------------------------------------------------------------------------------------------------------------
def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each as a digest of role and text with the text's bytes.

    Of a turn's number, NULL comes first; turns with one number are in the order of their digests. NULL role or text is empty.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("d"), F.octet_length(text).cast("long").alias("n"))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("x"))
    ordered = F.sort_array(F.collect_list("x"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"))).alias("turns"))


def branched(made: DataFrame, block: int = 5, most: int = 9) -> DataFrame:
    """Conversations as variants of others: each begins with the first h turns of the conversation whose number is the next lower
    multiple of ``block``, and goes on with its own turns after its first h; h is the CRC-32 of its number modulo ``most``.

    A conversation is looked up by ``block`` others at most, and only its first turns are.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(block))
    heads = made.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_head"))
    found = made.withColumn("_h", h).join(heads, base == F.col("_base"), "left")
    none = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return found.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")), own).alias("turns"))


def _sha_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for all runs of an id; runs come in order and are read one after the other."""
    last, state = None, None
    for batch in batches:
        ids, out = [], []
        for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if id_ != last:
                if state:
                    ids.append(last)
                    out.append(state.hexdigest())
                last, state = id_, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(out, pa.string())], ["id", "ends"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["id", "ends"])


def distinct_sequences(rebuilt: DataFrame) -> DataFrame:
    """Each sequence of turns once: ``key`` (digests end to end), ``sizes``, how many conversations have it, the least of their
    numbers and the digest of all of them.

    Numbers are joined in runs before they are brought together, so a sequence that very many conversations share costs a row
    for each 4,096 numbers; only the digest, which can't be split, reads its runs in one task, one by one.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda x: x["d"]), ""))
    rows = rebuilt.select("conv_id", key.alias("key"), F.transform("turns", lambda x: x["n"]).alias("sizes"))
    id_ = F.unhex(F.md5("key")).alias("id")
    numbers = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    runs = rows.groupBy(id_, F.shiftright("conv_id", RUN_BITS).alias("run")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), numbers.alias("numbers"), F.first("key").alias("key"), F.first("sizes").alias("sizes")
    )
    runs = cut(runs, "trie-runs")
    whole = runs.groupBy("id").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.count("*").alias("runs"), F.min("numbers").alias("numbers"),
        F.first("key").alias("key"), F.first("sizes").alias("sizes"),
    )
    several = runs.join(whole.filter("runs > 1").select("id"), "id", "left_semi").select("id", "run", "numbers")
    several = several.repartition("id").sortWithinPartitions("id", "run").select("id", "numbers")
    digests = mapped(several, _sha_of_runs, "id binary, ends string")
    one = F.when(F.col("runs") == 1, F.sha2("numbers", 256))
    return whole.join(digests, "id", "left").select("key", "sizes", "n", "least", F.coalesce(one, "ends").alias("ends"))


def _merged(spine: DataFrame) -> DataFrame:
    """Nodes on which shards were cut, put together.

    Members and children add up. A node that an earlier shard has too was counted there: its text counts once, for itself
    and for all on its path. A shard's last node is no leaf if another shard continues it.
    """
    nodes = spine.groupBy("node").agg(F.min("shard").alias("first_shard"), F.sum("n_children").alias("own"), F.max("parent").alias("parent"))
    under = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("under"))
    nodes = nodes.join(under, "node", "left").select("node", "first_shard", (F.col("own") + F.coalesce("under", F.lit(0))).alias("children"))
    rows = spine.drop("n_children").join(nodes, "node").withColumn("again", F.col("on_first") & (F.col("shard") > F.col("first_shard")))
    shards = rows.groupBy("shard").agg(
        F.max(F.when(F.col("again"), F.col("path_bytes"))).alias("shared_bytes"), F.max(F.col("tip") & (F.col("children") > 0)).alias("goes_on")
    )
    rows = rows.join(shards, "shard")
    twice = F.when(F.col("again"), F.col("shared_bytes") - F.col("path_bytes") + F.col("bytes")).otherwise(F.lit(0))
    return rows.groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.max("children").alias("n_children"),
        F.sum(F.col("n_leaves") - (F.col("on_last") & F.col("goes_on")).cast("long")).alias("n_leaves"),
        F.sum(F.col("saved_tokens") + twice).alias("saved_tokens"),
        F.max("ends").alias("ends"),
    )


def _published(parent_conv_id: Column) -> list[Column | str]:
    ends = F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    return ["conv_id", "depth", parent_conv_id.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", ends]


def trie(rebuilt: DataFrame) -> DataFrame:
    """A row for each node of the prefix trie of conversations (conv_id, turns as of ``sequences``; a number occurs once).

    conv_id, the smallest member; depth; parent_conv_id, NULL for the root; n_convs, members; n_children; n_leaves; saved_tokens, the
    bytes that sharing saves in the subtree; ends_sha256, of the numbers of the conversations that end there. A conversation
    without turns ends at the root. Without conversations there is no node. A conversation's digests, 16 bytes a turn, must
    fit a task; texts are not carried along.
    """
    ordered = cut(distinct_sequences(rebuilt), "trie-sequences").repartitionByRange("key").sortWithinPartitions("key")
    nodes = cut(mapped(ordered.select("key", "sizes", "n", "least", "ends"), _shards, NODES), "trie-nodes")
    # A path or two for each shard.
    spine = cut(_merged(nodes.filter("node IS NOT NULL")), "trie-spine")
    whole = nodes.filter("node IS NULL")
    inside = whole.filter("parent IS NULL").select(*_published(F.col("parent_conv_id")))
    columns = ["parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    beside = whole.filter("parent IS NOT NULL").select(*columns).unionByName(spine.select(*columns))
    above = spine.select(F.col("node").alias("_node"), F.col("conv_id").alias("_above"))
    return inside.unionByName(beside.join(above, F.col("parent") == F.col("_node"), "left").select(*_published(F.col("_above"))))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``branched`` conversations (conv_id, turn, role, text; other columns are not read).

    Rows without a conv_id belong to no conversation and are left out. Repeated rows are turns of their own.
    """
    return trie(branched(cut(sequences(conversations), "trie-turns")))


OP12_SQL = r"""
WITH bits AS (SELECT list(list_reduce([CAST(i AS UBIGINT)] || list_transform(range(8), lambda z: CAST(0 AS UBIGINT)),
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, md5(CAST(strlen(r) AS VARCHAR) || ':' || r || x)) AS s FROM turns GROUP BY conv_id),
how AS (SELECT conv_id, s, CAST(xor(list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT)),
      lambda a, b: xor(a >> 8, t[CAST(xor(a & 255, b) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 9 AS BIGINT) AS h FROM own, bits),
rebuilt AS (SELECT o.conv_id, list_concat(CASE WHEN b.s IS NULL THEN o.s[1:0] ELSE b.s[1:o.h] END, o.s[o.h + 1:]) AS s
      FROM how o LEFT JOIN own b ON b.conv_id = o.conv_id - ((o.conv_id % 5) + 5) % 5),
member AS (SELECT conv_id, s[1:d] AS k, d = len(s) AS ending FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
node AS (SELECT k, len(k) AS depth, min(conv_id) AS conv_id, count(*) AS n, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ending) AS ends FROM member GROUP BY k),
child AS (SELECT k[1:depth - 1] AS k, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
whole AS (SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN depth > 0 THEN (n.n - 1) * strlen(n.k[depth].x) ELSE 0 END AS saved FROM node n LEFT JOIN child c ON c.k = n.k),
sums AS (SELECT k, sum(saved) AS saved, sum(leaf) AS leaves FROM (SELECT k[1:d] AS k, saved, leaf FROM
      (SELECT k, saved, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, unnest(range(0, depth + 1)) AS d FROM whole)) GROUP BY k)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(w.n AS BIGINT) AS n_convs, CAST(w.n_children AS BIGINT) AS n_children,
      CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM whole w JOIN sums s ON s.k = w.k LEFT JOIN node p ON w.depth > 0 AND p.k = w.k[1:w.depth - 1]
"""
