"""SimHash near-duplicates: a self-join of a binary trie of fingerprints under a Hamming budget.

Nulls, empty texts and texts without words have fingerprint zero, which links like any other. Repeated rows are rows of
their own and share a component. A null id takes part, but is never a component's name unless the whole component has
no other. Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, settle, table
from .components import Forest, components

#: Fingerprints under one node of the top of the trie, on average.
NODE_ROWS = 1 << 15
#: Pairs of trie nodes held at once while a task goes down the trie.
FRONTIER = 1 << 17
#: Pairs of nodes with no more fingerprint pairs than this are compared outright.
LEAF_PAIRS = 64


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The SimHash of one text: words between ASCII white space, XXH64 (seed 42) of their n-grams, majority per bit."""
    if not text:
        return 0
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    spans = zip([0, *(ends[: len(words) - size] + 1).tolist()], ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), dtype=U64, count=len(words) - size + 1)
    # Few bits at a time: long texts must not take 64 times their hashes in memory.
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[lo : lo + (1 << 14)].byteswap().view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        prints = np.fromiter((fingerprint_of(texts[i].as_py(), shingle) for i in range(len(texts))), dtype=U64, count=len(texts))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "th", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, th, fp): a hash of each text, and its fingerprint as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text")).mapInArrow(
        partial(_fingerprint_batches, shingle=shingle), f"doc_id {kind}, th bigint, fp bigint"
    )


def trie_links(keys: np.ndarray, split: int, depth: int, used: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in `keys` that span the components of "differs in at most `budget` bits".

    `keys` are sorted, unsigned and distinct. With split = 0 the trie under depth `depth` is joined with itself; else
    the first `split` keys are one node and the rest another, whose paths differ in `used` bits. A node is a range of
    the sorted keys. A pair of nodes goes on to the pairs of its children, adding a differing bit where the children
    are unlike, and ends where the budget is exceeded, where a node is empty, or where all its keys are linked by now.
    """
    n = len(keys)
    forest = Forest(n)
    first = (0, n, 0, n, 0) if split == 0 else (0, split, split, n, used)
    stack = [(depth, np.array([first], dtype=np.int64))]
    while stack:
        level, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            stack.append((level, pairs[FRONTIER:]))
            pairs = pairs[:FRONTIER]
        lo1, hi1, lo2, hi2, err = pairs.T
        alive = ~forest.joined(lo1, hi1, lo2, hi2)
        if level >= 64:  # both nodes are single keys: the path has counted every bit
            forest.link(lo1[alive], lo2[alive])
            continue
        lo1, hi1, lo2, hi2, err = pairs[alive].T
        if not len(lo1):
            continue
        leaf = (hi1 - lo1) * (hi2 - lo2) <= LEAF_PAIRS
        if leaf.any():
            _compare(keys, forest, lo1[leaf], hi1[leaf], lo2[leaf], hi2[leaf], budget)
        go = ~leaf
        lo1, hi1, lo2, hi2, err = lo1[go], hi1[go], lo2[go], hi2[go], err[go]
        if not len(lo1):
            continue
        bit = U64(1) << U64(63 - level)
        below = (keys[lo1] & ~(bit | (bit - U64(1)))) | bit
        mid1 = np.clip(np.searchsorted(keys, below), lo1, hi1)
        below = (keys[lo2] & ~(bit | (bit - U64(1)))) | bit
        mid2 = np.clip(np.searchsorted(keys, below), lo2, hi2)
        itself = lo1 == lo2
        children = [
            np.stack([lo1, mid1, lo2, mid2, err], axis=1),
            np.stack([mid1, hi1, mid2, hi2, err], axis=1),
            np.stack([lo1, mid1, mid2, hi2, err + 1], axis=1),
            np.stack([mid1, hi1, lo2, mid2, err + 1], axis=1)[~itself],
        ]
        down = np.concatenate(children[::-1])
        keep = (down[:, 0] < down[:, 1]) & (down[:, 2] < down[:, 3]) & (down[:, 4] <= budget)
        keep &= ~((down[:, 0] == down[:, 2]) & (down[:, 1] - down[:, 0] < 2))
        # Nodes with themselves last, so that they come off the stack first and link close groups early.
        down = down[keep]
        order = np.argsort(down[:, 0] == down[:, 2], kind="stable")
        stack += [(level + 1, part) for part in np.array_split(down[order], max(1, -(-len(down) // FRONTIER))) if len(part)]
    low = forest.name
    moved = np.flatnonzero(low != np.arange(n))
    return moved, low[moved]


def _compare(keys, forest, lo1, hi1, lo2, hi2, budget) -> None:
    """All keys of each first node with all keys of its second."""
    for part in range(0, len(lo1), 1 << 15):
        a, b, c, d = (x[part : part + (1 << 15)] for x in (lo1, hi1, lo2, hi2))
        width, total = d - c, (b - a) * (d - c)
        of = np.repeat(np.arange(len(a)), total)
        nth = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        left, right = a[of] + nth // width[of], c[of] + nth % width[of]
        near = np.bitwise_count(keys[left] ^ keys[right]) <= budget
        near &= left != right
        if near.any():
            forest.link(left[near], right[near])


def _join_nodes(key: tuple, rows: pd.DataFrame, top: int, budget: int) -> pd.DataFrame:
    """Join the fingerprints under two nodes of the top of the trie (or of one with itself)."""
    keys = np.sort(rows["fp"].to_numpy().astype(np.int64).view(U64))
    one, two = int(key[0]), int(key[1])
    split = 0 if one == two else int(np.searchsorted(keys >> U64(64 - top), U64(two)))
    if one != two and split in (0, len(keys)):
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    a, b = trie_links(keys, split, top, (one ^ two).bit_count(), budget)
    return pd.DataFrame({"a": keys[a].view(np.int64), "b": keys[b].view(np.int64)})


def near_links(prints: DataFrame, budget: int = 4, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b): links that span the components of distinct fingerprints (column fp) within `budget` bits.

    The top of the trie is cut where a node holds about `node_rows` fingerprints. Pairs of such nodes whose paths differ
    in at most `budget` bits are joined independently, each in a task of its own; all further levels are inside the
    tasks. A task returns fewer links than it has fingerprints, however many pairs are near.
    """
    n = prints.count()
    top = min(16, max(4, (max(n, 1) // node_rows).bit_length()))
    masks = [sum(1 << i for i in bits) for size in range(budget + 1) for bits in combinations(range(top), size)]
    node = F.shiftrightunsigned("fp", 64 - top)
    pairs = prints.select("fp", node.alias("node"), F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("mask"))
    other = F.col("node").bitwiseXOR(F.col("mask"))
    pairs = pairs.select("fp", F.least("node", other).alias("one"), F.greatest("node", other).alias("two"))
    return pairs.groupBy("one", "two").applyInPandas(partial(_join_nodes, top=top, budget=budget), "a bigint, b bigint")


def simhash_components(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """(doc_id, th, fp, component, component_id) for each row of `docs`.

    component_id is the least id that its fingerprint can reach, component the least fingerprint; th is a hash of the text.

    Copies meet in one distinct fingerprint before the join, so a group of copies costs as much as one text.
    """
    rows = settle(fingerprints(docs, shingle))
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = components(near_links(classes.select("fp"), budget))
    grouped = classes.join(linked, classes["fp"] == linked["node"], "left").select(
        F.col("fp").alias("print"), "least", F.coalesce("component", "fp").alias("component")
    )
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    # Kept for a join of its own below, in which Spark can split a fingerprint that very many rows share.
    named = settle(grouped.select("print", "component").join(names, "component"))
    return rows.join(named, rows["fp"] == named["print"], "left").select("doc_id", "th", "fp", "component", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, budget: int = 4) -> DataFrame:
    """One row of `docs` for each component: the one with the least id (a null id only if there is no other)."""
    found = simhash_components(docs, shingle, budget)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("least")
    chosen = found.groupBy("component").agg(least).select(F.col("least.doc_id").alias("id"), F.col("least.th").alias("th"))
    chosen = chosen.select(F.col("id").alias("kept_id"), F.col("th").alias("kept_th"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    kept = rows.join(chosen, rows["id"].eqNullSafe(chosen["kept_id"]) & (rows["th"] == chosen["kept_th"]), "left_semi")
    # Rows of equal id and text are copies too.
    first = F.row_number().over(Window.partitionBy("id", "th").orderBy(F.lit(0)))
    return kept.withColumn("nth", first).filter("nth = 1").select("row.*")


def op3_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
