"""Benchmark decontamination by winnowing: which words of which documents also stand in a benchmark item.

A window is `window` consecutive words of an item (all of its words, if it has fewer). Of every `window` consecutive
words, on both sides, the k-gram with the least hash is kept; both sides keep the same one, so every shared window has
a shared fingerprint. Fingerprints are joined, the k-grams themselves are compared, and a hit is extended word by word
both ways; it counts if it then covers a window. Items shorter than a window have one fingerprint, all their words.

Null and empty texts have no words and no hits. Repeated rows are rows of their own; so are rows that share an id. An
item without an id marks words, but is not counted among the items. Extra columns are ignored. Without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, U64, Chunk, chunks, mix, settle, span_hashes, table

#: Words of a window, and of the k-grams that are hashed. A window holds window - gram + 1 of them.
WINDOW, GRAM = 10, 5
#: Bits of the filter over benchmark fingerprints: 1 MB, whatever the benchmark's size. It only spares shuffling
#: fingerprints that no item has; a fuller one lets more of them through.
FILTER_BITS = 23

_GRAMS = "array<struct<fp: bigint, gram: string, pos: int, before: array<string>, after: array<string>>>"
_ARROW_GRAMS = pa.list_(
    pa.struct(
        [
            ("fp", pa.int64()),
            ("gram", pa.string()),
            ("pos", pa.int32()),
            ("before", pa.list_(pa.string())),
            ("after", pa.list_(pa.string())),
        ]
    )
)
_STEP = U64(0xD6E8FEB86659FD93)


def _rolling(words: np.ndarray, k: int, salt: int) -> np.ndarray:
    """Hash of each k consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    out = np.full(n, U64(salt))
    for i in range(k):
        out = out * _STEP + words[i : i + n]
    return mix(out)


def _chosen(grams: np.ndarray, stops: np.ndarray, width: int, gram: int) -> np.ndarray:
    """Places of the k-grams that are least (the last of equals) among `width` consecutive ones of a text."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    least, place = grams[:n].copy(), np.arange(n)
    for i in range(1, width):
        lower = grams[i : i + n] <= least
        least[lower] = grams[i : i + n][lower]
        place[lower] = np.flatnonzero(lower) + i
    whole = np.arange(n) + width + gram - 1 <= stops[:n]
    return np.unique(place[whole])


def _found(chunk: Chunk, shorts: list[int], wanted: np.ndarray | None, window: int, gram: int, item_side: bool):
    """For each text of a chunk, its number of words and its fingerprints (those that the filter lets through)."""
    starts, ends, bounds = chunk.words(ALNUM)
    counts = np.diff(bounds)
    words = span_hashes(chunk.data, starts, ends)
    owner = np.repeat(np.arange(len(counts)), counts)
    stops = bounds[1:][owner] if len(owner) else np.empty(0, dtype=np.int64)
    picked: list[list[dict]] = [[] for _ in counts]

    def text(i: int, j: int) -> str:
        return " ".join(chunk.data[starts[x] : ends[x]].tobytes().decode("utf-8", "replace") for x in range(i, j))

    def passing(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        if wanted is None:
            return places
        slot = hashes[places] & U64((1 << FILTER_BITS) - 1)
        return places[(wanted[slot >> U64(6)] >> (slot & U64(63))) & U64(1) == 1]

    around = window - gram
    hashes = _rolling(words, gram, gram)
    for i in passing(hashes, _chosen(hashes, stops, window - gram + 1, gram)).tolist():
        of = owner[i]
        lo, hi = max(int(bounds[of]), i - around), min(int(bounds[of + 1]), i + gram + around)
        before = [text(x, x + 1) for x in range(i - 1, lo - 1, -1)]
        after = [text(x, x + 1) for x in range(i + gram, hi)]
        picked[of].append(_gram(hashes[i], text(i, i + gram), i - int(bounds[of]), before, after))
    for m in shorts:
        hashes = _rolling(words, m, (1 << 32) + m)
        if item_side:
            places = bounds[:-1][counts == m]
        else:
            places = np.flatnonzero(np.arange(len(hashes)) + m <= stops[: len(hashes)])
        for i in passing(hashes, places).tolist():
            picked[owner[i]].append(_gram(hashes[i], text(i, i + m), i - int(bounds[owner[i]]), [], []))
    return counts, picked


def _gram(fp, gram: str, pos: int, before: list[str], after: list[str]) -> dict:
    return {"fp": int(np.int64(fp.view(np.int64))), "gram": gram, "pos": pos, "before": before, "after": after}


def _gram_batches(batches: Iterator[pa.RecordBatch], shorts, wanted, window: int, gram: int) -> Iterator[pa.RecordBatch]:
    bits = None if wanted is None else wanted.value
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            ids = batch.column(0).slice(chunk.rows.start, chunk.rows.stop - chunk.rows.start)
            lengths = range(1, window) if shorts is None else shorts
            counts, picked = _found(chunk, list(lengths), bits, window, gram, shorts is None)
            yield pa.record_batch(
                [ids, pa.array(counts.astype(np.int64)), pa.array(picked, type=_ARROW_GRAMS)], names=["id", "n_words", "grams"]
            )


def _scan(texts: DataFrame, id_column: str, shorts: list[int] | None, wanted, window: int, gram: int) -> DataFrame:
    """(id, n_words, grams). shorts None: the benchmark's side, where short texts are one fingerprint."""
    kind = texts.schema[id_column].dataType.simpleString()
    rows = texts.select(F.col(id_column).alias("id"), F.col("text").cast("string").alias("text"))
    scan = partial(_gram_batches, shorts=shorts, wanted=wanted, window=window, gram=gram)
    return rows.mapInArrow(scan, f"id {kind}, n_words bigint, grams {_GRAMS}")


def _filter_words(grams: DataFrame) -> np.ndarray:
    """The filter's bits: at most 2^17 rows come to the driver, whatever the benchmark's size."""
    slot = F.col("fp").bitwiseAND((1 << FILTER_BITS) - 1)
    bit = F.expr("shiftleft(1L, cast(fp & 63 as int))")
    rows = grams.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for row in rows:
        out[row["word"]] = row["bits"]
    return out.view(U64)


def _common(a: Column, b: Column, most: int) -> Column:
    """How many leading entries of two arrays are equal."""
    equal = [
        ((F.size(a) >= i) & (F.size(b) >= i) & (F.slice(a, 1, i) == F.slice(b, 1, i))).cast("int") for i in range(1, most + 1)
    ]
    return reduce(Column.__add__, equal, F.lit(0))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, item_ids (sorted strings), spans (merged, in words)."""
    spark = docs.sparkSession
    item_rows = settle(_scan(items, "item_id", None, None, window, gram))
    shape = F.when(F.col("n_words") < window, F.col("n_words")).otherwise(window)
    item_grams = item_rows.select(F.col("id").cast("string").alias("item_id"), shape.alias("need"), F.inline("grams"))
    shorts = [r[0] for r in item_rows.filter((F.col("n_words") > 0) & (F.col("n_words") < window)).select("n_words").distinct().collect()]
    wanted = spark.sparkContext.broadcast(_filter_words(item_grams))
    # The scan of the documents is kept with a number for each row: repeated and null ids need no care from here on.
    scan = _scan(docs, "doc_id", sorted(shorts), wanted, window, gram)
    rows = settle(scan.withColumn("row", F.monotonically_increasing_id()))
    doc_grams = rows.select("row", F.inline("grams"))
    d, i, most = doc_grams.alias("d"), item_grams.alias("i"), window - gram
    left, right = (_common(F.col(f"d.{side}"), F.col(f"i.{side}"), most) for side in ("before", "after"))
    # Short items have gram strings of `need` words and no surroundings; others have `gram` words.
    size = F.when(F.col("i.need") < window, F.col("i.need")).otherwise(gram)
    hits = d.join(i, (F.col("d.fp") == F.col("i.fp")) & (F.col("d.gram") == F.col("i.gram"))).select(
        "d.row", "i.item_id", "i.need", "d.pos", size.alias("size"), left.alias("left"), right.alias("right")
    )
    hits = hits.filter(F.col("left") + F.col("size") + F.col("right") >= F.col("need")).select(
        "row", "item_id", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("size") + F.col("right")).alias("stop")
    )
    found = hits.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    spans = _merged(hits).groupBy("row").agg(
        F.sum(F.col("stop") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans")
    )
    none = F.array().cast("array<string>")
    return (
        rows.select("row", F.col("id").alias("doc_id"), "n_words")
        .join(found, "row", "left")
        .join(spans, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("item_ids", none).alias("item_ids"),
            F.coalesce("spans", F.array().cast("array<struct<start: bigint, stop: bigint>>")).alias("spans"),
        )
    )


def _merged(hits: DataFrame) -> DataFrame:
    """(row, start, stop): overlapping and adjoining spans of a row made one."""
    from pyspark.sql import Window

    spans = hits.groupBy("row", F.col("start").cast("bigint").alias("start")).agg(F.max("stop").cast("bigint").alias("stop"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.coalesce(F.col("start") > F.max("stop").over(before), F.lit(True)).cast("int")
    numbered = spans.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(so_far))
    return numbered.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of `docs` that share no window with an item.

    Only documents with a hit take part in the second step, which finds them again by id and text.
    """
    text = F.xxhash64(F.col("text").cast("string"))
    keyed = docs.select(F.struct("doc_id", text.alias("th")).alias("doc_id"), "text")
    dirty = contamination(keyed, items, window, gram).filter("n_hit > 0").select("doc_id.*").distinct()
    dirty = dirty.select(F.col("doc_id").alias("dirty_id"), F.col("th").alias("dirty_th"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").alias("id"), text.alias("th"))
    clean = rows.join(dirty, rows["id"].eqNullSafe(dirty["dirty_id"]) & (rows["th"] == dirty["dirty_th"]), "left_anti")
    return clean.select("row.*")


def op2_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_OP2 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, g)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
