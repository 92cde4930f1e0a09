"""The prefix trie against plain dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fleetstate.llm import prefixes
from fleetstate.llm.prefixes import SparseTable, lent, prefix_nodes, turn_rows

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def words(text: str) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def sequences(rows) -> dict:
    own: dict = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    return own


def rebuilt(own: dict) -> dict:
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    return out


def brute(seqs: dict) -> set:
    members, ends, children = {}, {}, {}
    for conv, turns in seqs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
            if d:
                children.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))
        ends.setdefault(tuple(turns), []).append(conv)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, ())
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * words(node[-1][1]) if node else 0)
    return {
        (
            min(c), len(n), min(members[n[:-1]]) if n else None, len(c), len(children.get(n, ())), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest(),
        )
        for n, c in members.items()
    }


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(nodes) -> set:
    rows = [tuple(r) for r in nodes.select(COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed: int, convs: int, longest: int, vocabulary: int):
    rng, rows = random.Random(seed), []
    for conv in range(convs):
        kind = rng.random()
        size = 0 if kind < 0.05 else rng.randint(1, longest)
        text = [f"t{rng.randrange(vocabulary)} x" if rng.random() < 0.9 else "" for _ in range(size)]
        if kind > 0.6:
            text = [f"t{i % 2}" for i in range(size)]
        rows += [(conv, i, "user" if i % 2 else None, t if t else None) for i, t in enumerate(text)]
    rng.shuffle(rows)
    return rows


def test_extents_equal_a_scan():
    rng = np.random.default_rng(3)
    values = rng.integers(-1, 5, 200)
    table = SparseTable(values)
    at, depth = rng.integers(0, 200, 500), rng.integers(0, 5, 500)
    left, right = table.extents(at, depth)
    for i in range(500):
        lo = hi = at[i]
        while lo > 0 and values[lo] >= depth[i]:
            lo -= 1
        while hi < 199 and values[hi + 1] >= depth[i]:
            hi += 1
        assert (left[i], right[i]) == (lo, hi)
        assert table.least(left[i : i + 1], right[i : i + 1])[0] == values[lo : hi + 1].min()


@pytest.mark.parametrize("depth, rows, turns", [(256, 1 << 15, 1 << 18), (3, 4, 9), (2, 1, 1)])
def test_nodes_equal_brute_force_whatever_the_cut(spark, depth, rows, turns):
    data = made(depth, 60, 9, 2)
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    seqs = prefixes.placed(prefixes.settle(turn_rows(frame)))
    assert found(prefix_nodes(seqs, depth, rows, turns)) == brute(sequences(data))


def test_lent_turns_empty_conversations_and_repeats(spark):
    data = [r for r in made(9, 90, 6, 3) if r[0] not in (20, 33)] + [(7, 0, "user", "same")] * 5 + [(None, 1, "user", "nobody")]
    data += [(1000, None, "user", "first"), (1000, 0, "user", "second"), (1003, 5, None, None)]
    frame = prefixes.settle(spark.createDataFrame(data, SCHEMA))
    assert found(prefix_nodes(lent(turn_rows(frame)), 2, 5, 8)) == brute(rebuilt(sequences(data)))


def test_one_long_conversation_and_many_copies(spark):
    data = [(0, i, "user", f"{i % 7} a b") for i in range(3000)] + [(5, i, "user", f"{i % 7} a b") for i in range(2000)]
    data += [(c, 0, "user", "copy") for c in range(100, 1100)]
    frame = spark.createDataFrame(data, SCHEMA)
    seqs = prefixes.placed(prefixes.settle(turn_rows(frame)))
    assert found(prefix_nodes(seqs, 256, 50, 1000)) == brute(sequences(data))


def test_empty_table_clashing_columns_and_long_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_nodes(lent(turn_rows(empty))).collect() == []
    data = [(1, 0, "user", "word " * 100_000), (1, 1, "user", None), (2, 0, "user", "word " * 100_000)]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in data], SCHEMA + ", depth int, key int, seg int")
    seqs = prefixes.placed(turn_rows(frame))
    assert found(prefix_nodes(seqs)) == brute(sequences(data))


def test_query_equals_brute_force_on_the_given_table(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(prefixes.op11_prefix_trie(spark, SF_DIR)) == brute(rebuilt(sequences(data)))
