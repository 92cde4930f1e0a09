"""Conversation prefix trie: which turns conversations have in common from the start.

Conversations are sequences of turns. Sorted, the members of each shared prefix lie side by side: an interval in which all
neighbours have at least so many first turns in common. A sparse table holds the least of these common lengths over
every run of 2^k rows, so each prefix finds the left and the right end of its interval by two binary searches of its own.

Sequences are sorted over the cluster and dealt out by range. A task cuts its range into slices of bounded size, knowing
the rows next to each; a node whose interval ends within a slice is whole, one that reaches over an end gives a part for each
slice, and the parts of a node are added up. A conversation longer than DEPTH turns is cut into segments that hang below
the node of all turns before them, so no row is long, whatever a conversation holds.

A node needs no walk of its subtree: words that its conversations save are, row by row, those that a row has in common with the one
before it, and leaves are the rows whose next does not carry on; both are sums over the interval.

Turns are in order of number, a null one first; those of one number are ordered by a hash of role and text. Null role or
text is empty. Rows of null conv_id are left out, as a node is named by ids. Repeated rows are turns of their own. Texts of any
length count whole, as 128 bits of hash. Other columns are ignored. No rows give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetstate.operators.scan import running

from .common import settle, table

#: Turns of a segment. Rows and turns of a slice. Ids of a piece of a list that is hashed over several slices.
DEPTH, SLICE_ROWS, SLICE_TURNS, PIECE_IDS = 256, 1 << 15, 1 << 18, 256
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()

_KEY = ["depth", "p1", "p2"]
_NODE = pa.schema(
    [("kind", pa.int8()), ("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("q1", pa.int64()), ("q2", pa.int64())]
    + [(n, pa.int64()) for n in ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("first", pa.int64()), ("piece", pa.string())]
)
_NODE_DDL = (
    "kind tinyint, depth bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, first bigint, piece string"
)
WHOLE, PART, PIECE = 0, 1, 2


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, words): two hashes of role and text, and the words of the text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(text("role"), text("text")).alias("h1"),
        F.xxhash64(text("text"), F.lit(1), text("role")).alias("h2"),
        F.regexp_count(text("text"), F.lit(WORD)).cast("bigint").alias("words"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """`turn_rows` with `depth`, the place of each turn in its conversation, from 1."""
    one = rows.withColumn("one", F.lit(1).cast("bigint"))
    return running(one, "conv_id", ["turn", "h1", "h2"], sums=["one"]).select(
        "conv_id", F.col("one_so_far").alias("depth"), "h1", "h2", "words"
    )


def lent(rows: DataFrame, block: int = 20, most: int = 4) -> DataFrame:
    """`turn_rows` as sequences that begin with turns lent by the first conversation of their block.

    Conversation c begins with the first h turns of c - c % block (all if fewer, none if it is absent), h being the unsigned
    crc32 of its id modulo `most`; its own turns after the first h follow. A conversation without turns keeps one row of depth 0.
    """
    share = lambda c: F.crc32(c.cast("string").cast("binary")) % most
    order = Window.partitionBy("conv_id").orderBy("turn", "h1", "h2")
    # Spark keeps the first rows of each id before the shuffle too, so a long conversation costs few rows a task.
    firsts = rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") < most)
    firsts = firsts.select(F.col("conv_id").alias("lender"), "nth", "h1", "h2", "words")
    takers = rows.select("conv_id").distinct().withColumn("h", share(F.col("conv_id"))).filter("h > 0")
    takers = takers.withColumn("lender", F.col("conv_id") - F.col("conv_id") % block)
    taken = takers.join(firsts, "lender").filter(F.col("nth") <= F.col("h"))
    long = lambda v: F.lit(v).cast("bigint")
    both = rows.select("conv_id", long(0).alias("taken"), long(1).alias("own"), F.col("turn").cast("bigint").alias("turn"), "h1", "h2", "words").unionByName(
        taken.select("conv_id", long(1).alias("taken"), long(0).alias("own"), F.col("nth").cast("bigint").alias("turn"), "h1", "h2", "words")
    )
    counted = running(both, "conv_id", ["own", "turn", "h1", "h2"], sums=["taken", "own"])
    h = share(F.col("conv_id"))
    stays = (F.col("own") == 0) | (F.col("own_so_far") > h)
    depth = F.when(stays, F.col("taken_so_far") + F.greatest(F.col("own_so_far") - h, long(0))).otherwise(long(0))
    return counted.select("conv_id", depth.alias("depth"), "h1", "h2", "words")


def _xor(els: Column, field: str) -> Column:
    return F.aggregate(els, F.lit(0).cast("bigint"), lambda x, e: x.bitwiseXOR(e[field]))


def _segments(sequences: DataFrame, depth: int) -> DataFrame:
    """Rows of at most `depth` turns: (conv_id, seg, p1, p2, key, words, more). p1 and p2 name the node a segment hangs
    below; `more` says that another segment follows."""
    place, turn = F.col("depth"), F.col("depth") - 1
    seg = F.call_function("div", F.greatest(turn, F.lit(0)), F.lit(depth))
    # The first turn of a segment is also seen by the one before it, so that this knows whether it is the last.
    segs = F.when((seg > 0) & (turn % depth == 0), F.array(seg - 1, seg)).otherwise(F.array(seg))
    element = F.when(
        place > 0,
        F.struct("depth", F.xxhash64("depth", "h1", "h2").alias("t1"), F.xxhash64("h2", "depth", "h1").alias("t2"), "words"),
    )
    listed = sequences.select("conv_id", F.explode(segs).alias("seg"), element.alias("e"))
    listed = listed.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list("e")).alias("els"))
    cut = listed.select("conv_id", "seg", F.slice("els", 1, depth).alias("els"), (F.size("els") > depth).alias("more"))
    cut = settle(
        cut.select(
            "conv_id", "seg", "more",
            F.flatten(F.transform("els", lambda e: F.array(e["t1"], e["t2"]))).alias("key"),
            F.transform("els", lambda e: e["words"]).alias("words"),
            _xor(F.col("els"), "t1").alias("x1"), _xor(F.col("els"), "t2").alias("x2"),
        )
    )
    zero = F.lit(0).cast("bigint")
    short = cut.filter((F.col("seg") == 0) & ~F.col("more")).select("*", zero.alias("p1"), zero.alias("p2"))
    long = cut.filter((F.col("seg") > 0) | F.col("more"))
    if not long.isEmpty():
        long = running(long, "conv_id", ["seg"], xors=["x1", "x2"])
        long = long.withColumn("p1", F.col("x1_so_far").bitwiseXOR(F.col("x1"))).withColumn("p2", F.col("x2_so_far").bitwiseXOR(F.col("x2")))
        short = short.unionByName(long.select(*short.columns))
    return short.drop("x1", "x2")


_SORT = ["seg", "p1", "p2", "key", "more", "conv_id"]


def _sorted(segments: DataFrame) -> tuple[DataFrame, dict]:
    """Segments sorted over the cluster, and for each range the rows just before and after it: two rows a range."""
    ranged = settle(segments.repartitionByRange(*_SORT).sortWithinPartitions(*_SORT))
    ends = ranged.select(*_SORT[:4]).mapInArrow(_ends, "place int, last boolean, seg bigint, p1 bigint, p2 bigint, key array<bigint>")
    found = sorted(ends.collect(), key=lambda r: (r["place"], r["last"]))
    beside: dict = {}
    for one, two in zip(found[1::2], found[2::2]):
        beside[one["place"], True] = (two["seg"], two["p1"], two["p2"], list(two["key"]))
        beside[two["place"], False] = (one["seg"], one["p1"], one["p2"], list(one["key"]))
    return ranged, beside


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, first, last = TaskContext.get().partitionId(), None, None
    for batch in batches:
        if batch.num_rows:
            first = batch.slice(0, 1) if first is None else first
            last = batch.slice(batch.num_rows - 1, 1)
    for is_last, row in ((False, first), (True, last)):
        if row is not None:
            columns = [pa.array([number], pa.int32()), pa.array([is_last]), *(c.cast(pa.int64()) for c in row.columns[:3]), row.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "last", "seg", "p1", "p2", "key"])


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Turns that two rows of terms have in common at the start."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) // 2 if len(differ) else n // 2


class SparseTable:
    """Least value of any run of an array, from those of all runs of 2^k."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (step := 1 << len(self.levels)) <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[: len(values) - step + 1], below[step // 2 : len(values) - step // 2 + 1]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of values[lo..hi], both with."""
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << k) + 1])
        return out

    def extents(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row around `at` between which all common lengths are `depth` or more. values[i] is that of rows i - 1, i."""
        left, right, n = at.copy(), at.copy(), len(self.levels[0])
        for k in reversed(range(len(self.levels))):
            step, level = 1 << k, self.levels[k]
            lo = np.maximum(left - step + 1, 0)
            left -= np.where((left >= step) & (level[np.minimum(lo, len(level) - 1)] >= depth), step, 0)
            hi = right + 1
            right += np.where((right + step < n) & (level[np.minimum(hi, len(level) - 1)] >= depth), step, 0)
        return left, right


class _Slice:
    """Sorted rows with their neighbours on both sides."""

    def __init__(self, rows: pa.Table, before, after):
        number = lambda c: rows.column(c).to_numpy().astype(np.int64)
        self.n, self.conv = rows.num_rows, number("conv_id")
        self.group = np.stack([number("seg"), number("p1"), number("p2")], axis=1)
        self.more = rows.column("more").to_numpy(zero_copy_only=False).astype(bool)
        key, words = rows.column("key").combine_chunks(), rows.column("words").combine_chunks()
        starts = key.offsets.to_numpy().astype(np.int64)
        self.terms = key.values.to_numpy()[: starts[-1]]
        self.terms, starts = self.terms[starts[0] :], starts - starts[0]
        at = words.offsets.to_numpy()
        flat = words.values.to_numpy()[at[0] : at[-1]].astype(np.int64)
        self.starts = starts // 2
        self.length = np.diff(self.starts)
        self.word_sums = np.concatenate([[0], np.cumsum(flat)])
        self.common = self._common()
        edge = lambda row, i: common_length(np.array(row[3], dtype=np.int64), self._row(i)) if row and tuple(self.group[i]) == row[:3] else -1
        self.before, self.after = edge(before, 0), edge(after, self.n - 1)
        deep = lambda c: number(c) if c in rows.column_names else np.zeros(self.n, dtype=np.int64)
        self.below = deep("below")
        follows = np.append(self.common[1:], self.after)
        self.true = np.append(self.before, self.common[1:])
        self.leaf = np.where(self.more, deep("leaf_below"), follows < self.length).astype(np.int64)
        self.shared = self._words(np.arange(self.n), np.maximum(self.true, 0))

    def _row(self, i: int) -> np.ndarray:
        return self.terms[2 * self.starts[i] : 2 * self.starts[i + 1]]

    def edge(self, i: int) -> tuple:
        return (*(int(x) for x in self.group[i]), self._row(i))

    def _words(self, row: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Words of the first turns of a row."""
        return self.word_sums[self.starts[row] + turns] - self.word_sums[self.starts[row]]

    def _common(self) -> np.ndarray:
        """Turns that each row has in common with the one before, -1 if they hang below different nodes."""
        out = np.full(self.n, -1, dtype=np.int64)
        if self.n > 1:
            together = (self.group[1:] == self.group[:-1]).all(axis=1)
            least = np.where(together, np.minimum(self.length[1:], self.length[:-1]), 0)
            pair = np.repeat(np.arange(self.n - 1), least)
            ends = np.cumsum(least)
            turn = np.arange(len(pair)) - np.repeat(ends - least, least)
            a, b = 2 * (self.starts[pair] + turn), 2 * (self.starts[pair + 1] + turn)
            differ = np.flatnonzero((self.terms[a] != self.terms[b]) | (self.terms[a + 1] != self.terms[b + 1]))
            found = least.copy()
            where, first = np.unique(pair[differ], return_index=True)
            found[where] = turn[differ[first]]
            out[1:] = np.where(together, found, -1)
        return out

    def nodes(self, depth: int) -> list[pa.RecordBatch]:
        """All nodes of the slice: whole ones, parts of others, and pieces of the lists of ids that end at such."""
        n, table = self.n, SparseTable(self.common)
        ids = SparseTable(self.conv)
        seg = self.group[:, 0]
        # A prefix stands for itself where it first occurs: at depths over what its row has in common with the one before.
        least = np.append(0, self.common[1:] + 1)
        many = np.maximum(self.length - least + 1, 0)
        row = np.repeat(np.arange(n), many)
        d = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + least[row]
        left, right = table.extents(row, d)
        opens = lambda lo, hi, d: ((lo == 0) & (self.before >= d), (hi == n - 1) & (self.after >= d))
        open_left, open_right = opens(left, right, d)
        hangs = (d == 0) & (seg[row] > 0)  # all it has to tell is how many children the node above has
        sums = lambda x: np.concatenate([[0], np.cumsum(x)])
        within = lambda total, lo: total[right + 1] - total[lo]
        later = left + 1 - open_left  # rows that have the prefix in common with the one before
        base = np.where(d > 0, self._words(left, np.maximum(d - 1, 0)), 0)
        saved = within(sums(self.shared), later) - (right + 1 - later) * base + within(sums(self.below), left)
        goes_on = np.flatnonzero(self.length > self.true)
        branch = np.sort(self.true[goes_on] * (n + 1) + goes_on)
        children = np.searchsorted(branch, d * (n + 1) + right, side="right") - np.searchsorted(branch, d * (n + 1) + later)
        children = children + (~open_left & (self.length[left] > d))
        part = open_left | open_right | hangs | ((d == depth) & (within(sums(self.more), left) > 0))
        conv = ids.least(left, right)
        # Names: the exclusive or of the terms up to a depth, on top of the node that the segment hangs below.
        name = [np.concatenate([[0], np.bitwise_xor.accumulate(self.terms[i::2])]) for i in (0, 1)]
        named = lambda i, d: name[i][self.starts[left] + d] ^ name[i][self.starts[left]] ^ self.group[left, i + 1]
        names, up = (named(0, d), named(1, d)), np.maximum(d - 1, 0)
        parent_left, parent_right = table.extents(left, up)
        unknown = opens(parent_left, parent_right, up)
        unknown = unknown[0] | unknown[1] | (d == 0) | ((up == 0) & (seg[left] > 0))
        parent = ids.least(parent_left, parent_right)
        # Ids that end at a node are the first rows of its interval, in order.
        same = np.append(False, (self.common[1:] == self.length[1:]) & (self.length[1:] == self.length[:-1]) & (self.more[1:] == self.more[:-1]))
        run = np.cumsum(~same)
        stop = np.searchsorted(run, run, side="right")
        digests, pieces = [EMPTY] * len(row), []
        for i in np.flatnonzero((self.length[left] == d) & ~self.more[left] & ~hangs):
            members = self.conv[left[i] : stop[left[i]]]
            if not part[i]:
                digests[i] = hashlib.sha256(",".join(map(str, members.tolist())).encode()).hexdigest()
                continue
            for lo in range(0, len(members), PIECE_IDS):
                some = members[lo : lo + PIECE_IDS].tolist()
                pieces.append((seg[left[i]] * depth + d[i], names[0][i], names[1][i], some[0], ",".join(map(str, some))))
        shown = lambda x, mask: pa.array(x.astype(np.int64), mask=mask)
        nothing = lambda x: np.where(hangs, 0, x)
        out = [
            pa.array(np.where(part, PART, WHOLE).astype(np.int8)),
            pa.array(seg[left] * depth + d), pa.array(names[0]), pa.array(names[1]),
            shown(named(0, up), d == 0), shown(named(1, up), d == 0),
            shown(conv, hangs), shown(parent, unknown),
            pa.array(nothing(right - left + 1)), pa.array(children.astype(np.int64)), pa.array(nothing(within(sums(self.leaf), left))), pa.array(nothing(saved)),
            pa.array([None if p else x for p, x in zip(part.tolist(), digests)], pa.string()), pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.string()),
        ]
        batches = [pa.RecordBatch.from_arrays(out, schema=_NODE)]
        if pieces:
            columns = dict(zip(("depth", "p1", "p2", "first", "piece"), zip(*pieces)))
            blank = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(pieces), f.type) for f in _NODE]
            blank[0] = pa.array(np.full(len(pieces), PIECE, dtype=np.int8))
            batches.append(pa.RecordBatch.from_arrays(blank, schema=_NODE))
        return batches


def _slices(batches: Iterator[pa.RecordBatch], beside: dict, rows: int, turns: int) -> Iterator[_Slice]:
    """A sorted range in slices of bounded size."""
    number = TaskContext.get().partitionId()
    before, held = beside.get((number, False)), None

    def pieces():
        for batch in batches:
            size = np.cumsum(np.diff(batch.column("key").offsets.to_numpy()) // 2)
            lo = 0
            while lo < batch.num_rows:
                spent = int(size[lo - 1]) if lo else 0
                hi = min(lo + rows, max(lo + 1, int(np.searchsorted(size, spent + turns, side="right"))))
                yield batch.slice(lo, hi - lo)
                lo = hi

    def flush(held, after):
        return _Slice(pa.Table.from_batches(held), before, after)

    held, many, length = [], 0, 0
    for piece in pieces():
        size = piece.column("key").offsets.to_numpy()
        size = int(size[-1] - size[0]) // 2
        if held and (many + piece.num_rows > rows or length + size > turns):
            first = piece.slice(0, 1)
            after = (*(int(first.column(c)[0].as_py()) for c in _SORT[:3]), first.column("key")[0].as_py())
            done = flush(held, after)
            yield done
            before, held, many, length = done.edge(done.n - 1), [], 0, 0
        held.append(piece)
        many, length = many + piece.num_rows, length + size
    if held:
        yield flush(held, beside.get((number, True)))


def _nodes(batches: Iterator[pa.RecordBatch], beside, depth: int, rows: int, turns: int) -> Iterator[pa.RecordBatch]:
    for part in _slices(batches, beside.value, rows, turns):
        yield from part.nodes(depth)


def _tails(batches: Iterator[pa.RecordBatch], beside, rows: int, turns: int) -> Iterator[pa.RecordBatch]:
    """Of segments after the first: words in common with the row before, and whether a leaf ends here."""
    for part in _slices(batches, beside.value, rows, turns):
        columns = [part.conv, part.group[:, 0], -part.group[:, 0], part.shared, np.where(part.more, 0, part.leaf)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["conv_id", "seg", "down", "shared", "leaf"])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's list, whose pieces come in order; only the digest is held."""
    key, digest = None, None

    def done():
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([digest.hexdigest()])], names=[*_KEY, "ends"])

    for batch in batches:
        for *new, piece in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "piece"))):
            if new != key:
                if key is not None:
                    yield done()
                key, digest = new, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    if key is not None:
        yield done()


def _below(segments: DataFrame, rows: int, turns: int) -> DataFrame:
    """What the later segments of a long conversation add to the nodes of an earlier one: words and leaves, by (conv_id, seg)."""
    context = segments.sparkSession.sparkContext
    ranged, beside = _sorted(segments.filter("seg > 0"))
    tails = ranged.mapInArrow(
        partial(_tails, beside=context.broadcast(beside), rows=rows, turns=turns), "conv_id bigint, seg bigint, down bigint, shared bigint, leaf bigint"
    )
    # Segment s takes what segments s + 1 and on have.
    taken = running(tails, "conv_id", ["down"], sums=["shared", "leaf"])
    return taken.select("conv_id", (F.col("seg") - 1).alias("seg"), F.col("shared_so_far").alias("below"), F.col("leaf_so_far").alias("leaf_below"))


def prefix_nodes(sequences: DataFrame, depth: int = DEPTH, rows: int = SLICE_ROWS, turns: int = SLICE_TURNS) -> DataFrame:
    """The nodes of the trie of `sequences` (conv_id, depth, h1, h2, words), one row for each turn of a conversation, or one of
    depth 0 for a conversation without turns.

    Columns: conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    context = sequences.sparkSession.sparkContext
    segments = _segments(sequences, depth)
    if not segments.filter("seg > 0").isEmpty():
        segments = segments.join(_below(segments, rows, turns), ["conv_id", "seg"], "left").fillna(0, ["below", "leaf_below"])
    ranged, beside = _sorted(segments)
    found = settle(ranged.mapInArrow(partial(_nodes, beside=context.broadcast(beside), depth=depth, rows=rows, turns=turns), _NODE_DDL))
    totals = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    parts = found.filter(F.col("kind") == PART).groupBy(*_KEY).agg(
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"), *[F.sum(c).alias(c) for c in totals]
    )
    pieces = found.filter(F.col("kind") == PIECE).select(*_KEY, "first", "piece")
    ends = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_hash_pieces, "depth bigint, p1 bigint, p2 bigint, ends string")
    merged = settle(parts.join(ends, _KEY, "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(EMPTY))).drop("ends"))
    whole = found.filter(F.col("kind") == WHOLE)
    out = ["conv_id", "depth", "parent_conv_id", *totals, "ends_sha256"]
    named = whole.select(*_KEY, "q1", "q2", *out[:1], *out[2:]).unionByName(merged.select(*_KEY, "q1", "q2", *out[:1], *out[2:]))
    # Only nodes whose parent is in parts need to look its name up; a part that knows it saw all of it.
    lost = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    above = merged.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("upper"))
    orphans = named.filter(lost).join(above, ["depth", "q1", "q2"], "left").withColumn("parent_conv_id", F.col("upper"))
    return named.filter(~lost).select(out).unionByName(orphans.select(out))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_nodes(lent(settle(turn_rows(turns))))


ORACLE_OP11 = r"""
WITH t AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (  -- the last two bits of crc32, bit by bit
  SELECT conv_id, turns, conv_id - conv_id % 20 AS lender,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
  FROM t),
s AS (
  SELECT c.conv_id, list_concat(coalesce(l.turns[1:c.h], []), c.turns[c.h + 1:]) AS seq
  FROM c LEFT JOIN t l ON l.conv_id = c.lender),
p AS (SELECT conv_id, len(seq) AS size, unnest(range(0, len(seq) + 1)) AS d, seq FROM s),
n AS (
  SELECT d, seq[:d] AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends_sha256,
    any_value(CASE WHEN d > 0 THEN len(regexp_extract_all(seq[d]['text'], '[^\x20\x09-\x0D]+')) ELSE 0 END) AS words
  FROM p GROUP BY d, seq[:d]),
k AS (SELECT d - 1 AS d, node[:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.d = n.d AND k.node = n.node),
b AS (
  SELECT a.d, a.node, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.words) AS saved_tokens
  FROM f a JOIN (SELECT *, unnest(range(0, d + 1)) AS above FROM f) x ON a.d = x.above AND a.node = x.node[:x.above] GROUP BY a.d, a.node)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN b ON b.d = f.d AND b.node = f.node LEFT JOIN f up ON up.d = f.d - 1 AND up.node = f.node[:f.d - 1]
"""
