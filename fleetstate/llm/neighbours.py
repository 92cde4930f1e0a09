"""Embedding near-dedup: an exact metric range join of unit vectors.

Vectors of equal label (not null) and equal length link if their cosine, in double precision, reaches the threshold.
Pivots, drawn by hash from large groups, part a group into the cells of their nearest pivot. On the unit sphere the
threshold is a chord r. Between the cells of two pivots lies the plane of what is equally far from both; by the triangle inequality
a vector farther than r from it has no neighbour on its other side. So it is replicated only to cells whose plane is nearer
than that (in many dimensions these are far fewer than the cells whose pivot is near), and of each two cells only to one.
Cells then join on their own, their own vectors with each other and with replicas: these are cut into blocks by hash, and each
pair of blocks is a task of bounded size that returns a count per vector and the links that span its components, never all
pairs.

Equal vectors of a label are joined once, as a class with a size. Vectors that are null, zero or empty, or hold null or
non-finite components, or have no label, link with nothing: 0 links, a component of their own. An empty table gives no rows. Repeated rows, and rows
that share an id, are vectors of their own. A null id is passed over as a component's name unless there is no other.
Other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, table
from .components import Forest, components

THRESHOLD = 0.98
#: Vectors of a block, and of a cell that needs no cutting. Pivots: a bound of what the driver draws and sends out.
BLOCK_ROWS, MOST_PIVOTS = 2048, 512


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(vectors) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square overflows."""
    x = np.stack(vectors).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _cells(batches, pivots, chord: float):
    """Each vector in the cell of its nearest pivot, and as a replica in the lesser of the cells it may have links to."""
    centres = pivots.value
    for rows in batches:
        out = []
        for (label, size), part in rows.groupby(["label", "size"], sort=False):
            centre = centres.get((label, size))
            if centre is None:
                out.append(part.assign(cell=0, own=True))
                continue
            apart = np.sqrt(np.maximum(2 - 2 * centre @ centre.T, 0))
            for lo in range(0, len(part), 4096):
                piece = part.iloc[lo : lo + 4096]
                squares = np.maximum(2 - 2 * _unit(piece["v"]) @ centre.T, 0)
                home = squares.argmin(axis=1)
                nearest = squares[np.arange(len(piece)), home]
                # Distance to the plane between two cells is the difference of squares over twice that of the pivots. 1e-6 for
                # rounding: it only replicates more.
                reach = squares - nearest[:, None] <= 2 * apart[home] * (chord + 1e-6) + 1e-6
                reach &= np.arange(squares.shape[1])[None, :] < home[:, None]
                row, cell = np.nonzero(reach)
                out.append(piece.assign(cell=home, own=True))
                out.append(piece.iloc[row].assign(cell=cell, own=False))
        if out:
            yield pd.concat(out)[["label", "size", "cell", "own", "cid", "n", "v"]]


def _join_blocks(key, rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Count the links between two blocks of a cell (or within one), and span their components."""
    one, two = key[3], key[4]
    rows = rows.sort_values(["block", "cid"], ignore_index=True)
    split = int((rows["block"] == one).sum()) if one != two else 0
    unit = _unit(rows["v"])
    size, many = rows["n"].to_numpy(), len(rows)
    links, forest = np.zeros(many, dtype=np.int64), Forest(many)
    left = np.arange(split if one != two else many)
    right = slice(split, many)
    for lo in range(0, len(left), 512):
        at = left[lo : lo + 512]
        cos = unit[at] @ unit[right].T
        # Close calls are worked out again as the plain quotient, whose rounding does not depend on the block.
        for i, j in zip(*np.nonzero(np.abs(cos - threshold) < 1e-9)):
            a, b = (np.asarray(rows["v"][k], dtype=np.float64) for k in (at[i], split + j))
            cos[i, j] = np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b)))
        near = cos >= threshold
        if one == two:
            near &= np.arange(many)[None, :] > at[:, None]
        if near.any():
            links[at] += near @ size[right]
            links[right] += size[at] @ near
            i, j = np.nonzero(near)
            forest.link(at[i], split + j)
    cid = rows["cid"].to_numpy()
    some, moved = np.flatnonzero(links), np.flatnonzero(forest.name != np.arange(many))
    return pd.DataFrame(
        {
            "a": np.concatenate([cid[some], cid[moved]]),
            "b": np.concatenate([np.full(len(some), None, dtype=object), cid[forest.name[moved]]]),
            "links": np.concatenate([links[some], np.zeros(len(moved), dtype=np.int64)]),
        }
    )


def _tiles(cells: DataFrame) -> DataFrame:
    """Each vector with every pair of blocks that it is compared in: blocks of a cell's own vectors, numbered first, with each
    other, and with blocks of replicas."""
    place = ["label", "size", "cell"]
    blocks = lambda met: F.ceil(F.count(F.when(met, 1)) / BLOCK_ROWS).cast("int")
    many = cells.groupBy(*place).agg(blocks(F.col("own")).alias("own_blocks"), blocks(~F.col("own")).alias("more_blocks"))
    hashed = F.xxhash64("cid")
    block = F.when(F.col("own"), F.pmod(hashed, F.col("own_blocks"))).otherwise(
        F.col("own_blocks") + F.pmod(hashed, F.greatest("more_blocks", F.lit(1)))
    )
    last = F.when(F.col("own"), F.col("own_blocks") + F.col("more_blocks")).otherwise(F.col("own_blocks")) - 1
    # A cell may have replicas alone: they are own somewhere else, and meet there.
    cut = cells.join(many.filter("own_blocks > 0"), place).withColumn("block", block.cast("int"))
    tiles = cut.withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    return tiles.select(*place, F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "cid", "n", "v")


def _draw_pivots(classes: DataFrame, groups: DataFrame) -> dict:
    """Unit pivots for each group of more than a block: a share of its vectors by hash, MOST_PIVOTS in all at most."""
    large = groups.filter(F.col("count") > BLOCK_ROWS)
    rows = large.agg(F.sum("count")).first()[0] or 0
    if not rows:
        return {}
    many = min(MOST_PIVOTS, -(-rows // BLOCK_ROWS))
    drawn = classes.join(large, ["label", "size"], "left_semi").orderBy(F.xxhash64("cid"), "cid").limit(many)
    out: dict = {}
    for row in drawn.select("label", "size", "v").collect():
        out.setdefault((row["label"], row["size"]), []).append(row["v"])
    return {key: _unit([np.asarray(v) for v in vectors]) for key, vectors in out.items()}


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id) for each row of `vectors` (vec_id, embedding, label)."""
    zero = F.lit(0.0).cast(vectors.schema["embedding"].dataType.elementType)
    plain = F.transform("embedding", lambda x: x + zero)  # no negative zeros
    cid = F.when(
        F.col("label").isNotNull() & _usable(F.col("embedding")),
        F.concat(F.hex(F.xxhash64("label", plain)), F.lit("-"), F.hex(F.xxhash64(plain, F.lit(7), "label"))),
    )
    rows = vectors.select("vec_id", "label", plain.alias("v"), cid.alias("cid"))
    classes = settle(
        rows.filter(F.col("cid").isNotNull())
        .groupBy("cid", "label", "v")
        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
        .withColumn("size", F.size("v"))
    )
    pivots = vectors.sparkSession.sparkContext.broadcast(_draw_pivots(classes, classes.groupBy("label", "size").count()))
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    chord = float(np.sqrt(2 - 2 * threshold))
    cells = settle(
        classes.select("label", "size", "cid", "n", "v").mapInPandas(
            partial(_cells, pivots=pivots, chord=chord),
            f"label {kinds['label']}, size int, cell int, own boolean, cid string, n bigint, v {kinds['v']}",
        )
    )
    place, tiles = ["label", "size", "cell"], _tiles(cells)
    joined = settle(
        tiles.groupBy(*place, "one", "two").applyInPandas(partial(_join_blocks, threshold=threshold), "a string, b string, links bigint")
    )
    counts = joined.filter("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    named = components(joined.filter("b is not null").select("a", "b"))
    size = classes.select("cid", "n", "least")
    grouped = size.join(named, size["cid"] == named["node"]).select("cid", "component", "least")
    names = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    renamed = grouped.join(names, "component").select(F.col("cid").alias("node"), "component_id")
    found = (
        size.join(renamed, size["cid"] == renamed["node"], "left")
        .join(counts, size["cid"] == counts["a"], "left")
        .select(
            F.col("cid").alias("class"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    return (
        rows.select("vec_id", "cid")
        .join(found, F.col("cid") == F.col("class"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE_OP1 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
"""
