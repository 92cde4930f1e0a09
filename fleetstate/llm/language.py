"""Language identification by a byte convolutional network over the windows of a whole text.

A text is cut into windows of fixed length, each with the first bytes of the next so that nothing is lost at a cut; the
network scores every window, and the text's scores are the means of its windows', by their length. Learned from a
bounded sample of the labelled texts that are not held out, as many of each language as there are, up to a limit that
falls with the number of languages.

`und`, with score 0, is the answer for a null text, a text without any letter, and for all texts if there is nothing to
learn from. Rows of equal text get equal answers. Every language is learned, however many there are.
Other columns are kept unless they bear a name of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytenet import _REACH, WINDOW, ByteNet, softmax, train
from .common import Chunk, chunks, first_under, held_out, kept_share, schema_with, table

#: Bounds of the training sample: texts of a language, windows of a text, texts of all languages, but these of each at least.
TEXTS_PER_LANGUAGE, WINDOWS_PER_TEXT, TEXTS, LEAST_TEXTS = 1500, 4, 300_000, 100
#: Scores of windows, and of texts, held at once.
SCORES = 1 << 22
FOLDS = 5
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    net: ByteNet | None


def windows_of(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, the text of each, bytes of each that are its own)."""
    size = np.diff(chunk.bounds)
    many = -(-size // WINDOW)
    of = np.repeat(np.arange(len(size)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start, stop = chunk.bounds[:-1][of] + nth * WINDOW, chunk.bounds[1:][of]
    at = start[:, None] + np.arange(WINDOW + _REACH - 1)[None, :]
    inside = at < stop[:, None]
    out = np.where(inside, chunk.data[np.minimum(at, max(0, len(chunk.data) - 1))], 0) if len(at) else np.zeros(at.shape, np.uint8)
    return out.astype(np.uint8), of, np.minimum(stop - start, WINDOW)


def has_letter(chunk: Chunk) -> np.ndarray:
    """Whether each text has a letter of any script."""
    data, bounds = chunk.data, chunk.bounds
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    found = np.diff(np.concatenate([[0], np.cumsum(ascii_letter)])[bounds]) > 0
    beyond = np.diff(np.concatenate([[0], np.cumsum(data >= 128)])[bounds]) > 0
    for i in np.flatnonzero(~found & beyond):
        found[i] = any(c.isalpha() for c in data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def _window_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The windows of each text that teach, one after the other: `most` at most."""
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            windows, of, _ = windows_of(chunk)
            many = np.bincount(of, minlength=len(chunk.bounds) - 1)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            # Evenly spread over the whole text.
            step = -(-many // most)
            take = np.flatnonzero(nth % np.maximum(step, 1)[of] == 0)
            ends = np.cumsum(np.bincount(of[take], minlength=len(many)))
            body = [w.tobytes() for w in np.split(windows[take], ends[:-1])]
            part = batch.slice(chunk.rows.start, len(many))
            yield pa.record_batch([part.column("id"), part.column("place"), pa.array(body, pa.binary())], names=["id", "place", "bytes"])


def fit(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, per_text: int = WINDOWS_PER_TEXT) -> LanguageModel:
    """Learn from texts with a language that are not held out; at most `per_language` texts of each, first by hash, and
    `per_text` windows of each text, spread evenly over all of it."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, 0))
    # Repeated rows of an id and language count once, so that no window or sample grows with them.
    known = known.select("doc_id", F.col("lang").cast("string").alias("lang")).distinct()
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], None)
    most = min(per_language, max(LEAST_TEXTS, TEXTS // len(languages)))
    shares = [(x, i, kept_share(sizes[x], most)) for i, x in enumerate(languages)]
    numbered = docs.sparkSession.createDataFrame(shares, "lang string, place int, share double")
    drawn = first_under(known.join(F.broadcast(numbered), "lang"), "lang", F.col("share"), most)
    # At most `most` short rows of each language are sent to the tasks, so that no text is shuffled.
    drawn = drawn.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), "place")
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(drawn), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("label"))).select("id", "place", "text")
    windows = texts.mapInArrow(partial(_window_batches, most=per_text), schema_with(texts, ("text",), "bytes binary"))
    # One row of an id and language, the same one whatever their order.
    rows = windows.groupBy("id", "place").agg(F.min("bytes").alias("bytes")).select("place", "bytes").collect()
    size = WINDOW + _REACH - 1
    rows = [(r["place"], bytes(r["bytes"][i : i + size])) for r in rows for i in range(0, len(r["bytes"]), size)]
    rows.sort()  # the same model whatever the order of rows
    if not rows:
        return LanguageModel([], None)
    x = np.frombuffer(b"".join(w for _, w in rows), dtype=np.uint8).reshape(len(rows), -1)
    y = np.array([place for place, _ in rows])
    learned = np.unique(y)
    return LanguageModel([languages[i] for i in learned], train(x, np.searchsorted(learned, y), len(learned)))


def predict(model: LanguageModel, chunk: Chunk) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text of a chunk."""
    n = len(chunk.bounds) - 1
    letters = has_letter(chunk)
    if model.net is None:
        return [UNKNOWN] * n, np.zeros(n)
    windows, of, size = windows_of(chunk)
    best, score, room = np.zeros(n, dtype=np.int64), np.zeros(n), max(1, SCORES // len(model.languages))
    for lo in range(0, n, room):
        sums = np.zeros((min(room, n - lo), len(model.languages)))
        first, last = np.searchsorted(of, [lo, lo + room])
        for at in range(first, last, room):
            part = slice(at, min(at + room, last))
            np.add.at(sums, of[part] - lo, model.net.logits(windows[part]).astype(np.float64) * size[part, None])
        shares = softmax(sums / np.maximum(np.diff(chunk.bounds[lo : lo + len(sums) + 1]), 1)[:, None])
        best[lo : lo + room] = shares.argmax(axis=1)
        score[lo : lo + room] = shares.max(axis=1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())]
    return names, np.where(letters, score, 0.0)


def _predict_batches(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [n for n in batch.schema.names if n != "_text"]
        for chunk in chunks(batch.column("_text")):
            names, scores = predict(model.value, chunk)
            part = batch.slice(chunk.rows.start, len(names))
            yield pa.record_batch(
                [*(part.column(n) for n in rest), pa.array(names, pa.string()), pa.array(scores)], names=[*rest, "lang_pred", "score"]
            )


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The columns of `docs` but its text, with lang_pred and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("text", "lang_pred", "score", "_text")]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(partial(_predict_batches, model=sent), schema_with(rows, ("_text",), "lang_pred string, score double"))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), FOLDS, 0).alias("held_out"), "lang_pred", "score")
