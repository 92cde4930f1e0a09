"""Toxicity scores: boosted trees over dense features of a text, with isotonic calibration.

Features: densities and counts of lexicon words and stems, their nearness to words of the second person, capitals,
punctuation, and signs of obfuscation (symbols and digits inside words, spaced-out and drawn-out letters), and lexicon
words that show once symbols are taken out and digits read as letters. The lexicon is learned: words, and stems of some
lengths, that stand in toxic documents far more often than in others.

Lexicon, trees and calibration are learned from three separate parts of a bounded sample of the labelled documents, by
hash of the id, evenly from both classes and weighted back to their shares. Held-out documents teach nothing.

Null and empty texts have all features zero and a score like any other. Rows of equal text have equal scores. Labels
other than 0 and 1 are ignored; of several labels of a document the greatest counts. Without labels of both classes
all scores are the share of label 1 (0 if there is none). Other columns of the documents are kept unless they bear a
name of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .boost import Trees, fit_isotonic, fit_trees
from .common import ALNUM, LOWER, SPACED, U64, Chunk, chunks, first_by_hash, held_out, prefix_hashes, released, schema_with, settle, table

#: Documents of each class in the training sample, words and stems in the lexicon: bounds of what meets on the driver.
SAMPLE_PER_CLASS, LEXICON_SIZE = 12_000, 1_500
#: Bytes of the stems; None: the whole word.
STEMS = (None, 4, 5, 6)
#: Documents a lexicon entry must stand in, and its log odds of being in a toxic one.
LEAST_DOCS, LEAST_ODDS = 5, 2.5
#: Words between a lexicon word and one of the second person.
NEAR = 5
FOLDS = 5

# Words of the second person in the corpus languages.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes"
# Symbols read as letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

FEATURES = (
    "log_words", "word_density", "word_count", "stem_density", "stem_count", "odds_density", "odds_most", "hidden_density",
    "hidden_count", "near_second_person", "second_person_density", "capital_letters", "capital_words", "punctuation",
    "exclamation", "repeated_punctuation", "mixed_words", "symbols_in_words", "drawn_out_letters", "single_letters",
)

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[33:127] = True
_PUNCTUATION &= ~(_LETTER | _DIGIT)
_UNMASK = LOWER.copy()
for _symbol, _letter in LOOKALIKES.items():
    _UNMASK[ord(_symbol)] = ord(_letter)


@dataclass
class Lexicon:
    """For the whole word and each stem length, sorted hashes of the entries and their log odds."""

    hashes: list[np.ndarray]
    odds: list[np.ndarray]

    @classmethod
    def of(cls, entries: list[tuple[int, str, float]]) -> Lexicon:
        """entries: place in STEMS, bytes (as Latin-1 text), log odds."""
        hashes, odds = [], []
        for kind in range(len(STEMS)):
            own = [(e.encode("latin-1"), o) for k, e, o in entries if k == kind]
            keys = np.array([prefix_hashes(np.frombuffer(e, np.uint8), np.array([0]), np.array([len(e)]), (None,))[0][0] for e, _ in own], dtype=U64)
            order = np.argsort(keys)
            hashes.append(keys[order])
            odds.append(np.array([o for _, o in own], dtype=np.float64)[order])
        return cls(hashes, odds)

    def weigh(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each word is an entry, its greatest log odds as a word or stem)."""
        most = np.zeros(len(starts))
        word = np.zeros(len(starts), dtype=bool)
        for kind, hashes in enumerate(prefix_hashes(data, starts, ends, STEMS)):
            keys = self.hashes[kind]
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = keys[at] == hashes
            if STEMS[kind] is None:
                word = hit
            else:
                hit &= ends - starts >= STEMS[kind]
            most[hit] = np.maximum(most[hit], self.odds[kind][at[hit]])
        return word, most


def _second_person() -> np.ndarray:
    words = [w.encode() for w in SECOND_PERSON.split()]
    return np.sort([prefix_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]), (None,))[0][0] for w in words])


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of `flags` in each stretch between bounds."""
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])
    return np.diff(upto[bounds])


def features(chunk: Chunk, lexicon: Lexicon) -> np.ndarray:
    """One row of FEATURES for each text of a chunk that is not lower-cased."""
    data, bounds = chunk.data, chunk.bounds
    small = Chunk(chunk.rows, LOWER[data], bounds)
    starts, ends, cuts = small.words(ALNUM)
    n_words, n_bytes = np.diff(cuts), np.diff(bounds)
    words, size = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    whole, odds = lexicon.weigh(small.data, starts, ends)
    hit = odds > 0
    person = np.isin(prefix_hashes(small.data, starts, ends, (None,))[0], _second_person())
    # Second person within NEAR words, in the same text.
    of = np.repeat(np.arange(len(n_words)), n_words)
    upto = np.concatenate([[0], np.cumsum(person)])
    i = np.arange(len(starts))
    lo, hi = np.maximum(i - NEAR, cuts[:-1][of]), np.minimum(i + NEAR + 1, cuts[1:][of])
    near = hit & (upto[hi] > upto[lo])
    most = np.zeros(len(n_words))
    np.maximum.at(most, of[hit], odds[hit])
    letter, digit, mark = _LETTER[data], _DIGIT[data], _PUNCTUATION[data]
    first = np.zeros(len(data), dtype=bool)
    first[bounds[:-1][bounds[:-1] < len(data)]] = True
    prior = np.concatenate([[0], data[:-1]]).astype(np.uint8)[: len(data)]
    again = (data == prior) & ~first
    drawn = again & letter & np.concatenate([[False], again[:-1]])[: len(data)]
    follow = np.concatenate([data[1:], [32]]).astype(np.uint8)[: len(data)]
    odd = (mark | digit) & _LETTER[prior] & ~first & SPACED[follow]
    capital = _UPPER[data]
    per_word = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[np.stack([starts, ends])], axis=0)[0]
    length = ends - starts
    capitals, digits = per_word(capital), per_word(digit)
    hidden = _hidden(chunk, lexicon, odd)
    text = [
        np.log1p(n_words),
        _sums(whole, cuts) / words,
        np.log1p(_sums(whole, cuts)),
        _sums(hit, cuts) / words,
        np.log1p(_sums(hit, cuts)),
        _sums(odds, cuts) / words,
        most,
        hidden / words,
        np.log1p(hidden),
        _sums(near, cuts) / np.maximum(_sums(hit, cuts), 1),
        _sums(person, cuts) / words,
        _sums(capital, bounds) / np.maximum(_sums(letter, bounds), 1),
        _sums((capitals == length) & (length > 2), cuts) / words,
        _sums(mark, bounds) / size,
        _sums((data == 33) | (data == 63), bounds) / size,
        _sums(again & mark, bounds) / size,
        _sums((digits > 0) & (digits < length), cuts) / words,
        _sums(odd & mark, bounds) / size,
        _sums(drawn, bounds) / size,
        _sums(length == 1, cuts) / words,
    ]
    return np.stack(text, axis=1)


def _hidden(chunk: Chunk, lexicon: Lexicon, odd: np.ndarray) -> np.ndarray:
    """Per text, lexicon words among the words with symbols or digits inside, once those are read as letters or dropped."""
    starts, ends, cuts = chunk.words(SPACED)
    upto = np.concatenate([[0], np.cumsum(odd)])
    odd_word = np.flatnonzero(upto[ends] > upto[starts])
    if not len(odd_word):
        return np.zeros(len(chunk.bounds) - 1)
    size = ends[odd_word] - starts[odd_word]
    base = np.concatenate([[0], np.cumsum(size)])
    body = _UNMASK[chunk.data[np.repeat(starts[odd_word] - base[:-1], size) + np.arange(base[-1])]]
    keep = ALNUM[body]
    left = np.concatenate([[0], np.cumsum(keep)])[base]
    full = np.flatnonzero(np.diff(left))
    _, odds = lexicon.weigh(body[keep], left[:-1][full], left[1:][full])
    of = np.searchsorted(cuts, odd_word[full], side="right") - 1
    return np.bincount(of[odds > 0], minlength=len(chunk.bounds) - 1).astype(float)


def _entry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word and stem, the weight and number of toxic and of other texts that it stands in, chunk by chunk."""
    for batch in batches:
        toxic, weight = batch.column("y").to_numpy(), batch.column("w").to_numpy()
        for chunk in chunks(batch.column("text")):
            starts, ends, cuts = chunk.words(ALNUM)
            of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)) + chunk.rows.start
            for kind, hashes in enumerate(prefix_hashes(chunk.data, starts, ends, STEMS)):
                fit = np.flatnonzero(ends - starts >= (STEMS[kind] or 3))
                pairs = pd.DataFrame({"h": hashes[fit], "of": of[fit], "at": fit}).drop_duplicates(["h", "of"])
                pairs["t"], pairs["c"] = toxic[pairs["of"]] * weight[pairs["of"]], (1 - toxic[pairs["of"]]) * weight[pairs["of"]]
                pairs["n"] = toxic[pairs["of"]].astype("int64")
                sums = pairs.groupby("h").agg(at=("at", "first"), t=("t", "sum"), c=("c", "sum"), n=("n", "sum"))
                at = sums["at"].to_numpy()
                stop = ends[at] if STEMS[kind] is None else starts[at] + STEMS[kind]
                entry = [chunk.data[a:b].tobytes().decode("latin-1") for a, b in zip(starts[at], stop)]
                yield pa.record_batch(
                    [pa.array(np.full(len(at), kind, np.int32)), pa.array(entry, pa.string()), *(pa.array(sums[c].to_numpy()) for c in "tcn")],
                    names=["kind", "entry", "t", "c", "n"],
                )


def _feature_batches(batches: Iterator[pa.RecordBatch], lexicon) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text"), lower=False):
            rows = features(chunk, lexicon.value)
            part = batch.slice(chunk.rows.start, len(rows))
            x = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))
            yield pa.record_batch([part.column("part"), part.column("y"), part.column("w"), x], names=["part", "y", "w", "x"])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    curve: tuple[np.ndarray, np.ndarray]
    share: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(rows), self.share)
        raw = self.trees.raw(rows)
        # The curve has steps; a little of the raw score keeps the order within a step.
        return np.clip(0.998 * np.interp(raw, *self.curve) + 0.002 / (1 + np.exp(-raw)), 0.0, 1.0)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """((text, y, w, part), documents of each class): at most `per_class` labelled documents of each, none held out."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, 0))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = first_by_hash(known, "y", sizes, per_class)
    weights = F.when(F.col("y") == 1, max(1.0, sizes.get(1, 0) / per_class)).otherwise(max(1.0, sizes.get(0, 0) / per_class))
    # Parts in turn by hash order: two fifths teach the lexicon, two the trees, one the calibration.
    part = F.expr("case when nth % 5 < 2 then 0 when nth % 5 < 4 then 1 else 2 end")
    picked = taken.select(F.col("doc_id").alias("id"), "y", weights.alias("w"), part.alias("part"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # At most two times per_class short rows: small enough to send to every task, so no text is shuffled.
    found = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("id")).drop("id")
    # Of several texts of one id that of the least hash, whatever the order of rows.
    one = found.groupBy("doc_id", "y", "w", "part").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("text", "y", "w", "part"), sizes


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    sample, sizes = training_sample(docs, labels, label)
    nothing = Lexicon.of([])
    total = sum(sizes.values())
    if len([n for n in sizes.values() if n]) < 2:
        return Model(nothing, None, (np.zeros(1), np.zeros(1)), sizes.get(1, 0) / total if total else 0.0)
    sample = settle(sample)
    context = docs.sparkSession.sparkContext
    counts = sample.filter("part = 0").select("text", "y", "w").mapInArrow(_entry_batches, "kind int, entry string, t double, c double, n bigint")
    counts = counts.groupBy("kind", "entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum("n").alias("n"))
    odds = F.log((F.col("t") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("c") + 0.5) / (sizes[0] + 1.0))
    best = counts.withColumn("odds", odds).filter((F.col("n") >= LEAST_DOCS) & (F.col("odds") >= LEAST_ODDS))
    entries = best.orderBy(F.desc(F.col("n") * F.col("odds")), "kind", "entry").limit(LEXICON_SIZE).collect()
    lexicon = Lexicon.of([(r["kind"], r["entry"], r["odds"]) for r in entries])
    sent = context.broadcast(lexicon)
    rows = sample.filter("part > 0").mapInArrow(partial(_feature_batches, lexicon=sent), "part int, y int, w double, x array<double>").collect()
    part, y = np.array([r["part"] for r in rows]), np.array([r["y"] for r in rows], dtype=float)
    w, x = np.array([r["w"] for r in rows]), np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    order = np.lexsort((*x.T, y, part))  # the same model whatever the order of rows
    part, y, w, x = part[order], y[order], w[order], x[order]
    if len(np.unique(y[part == 1])) < 2 or not (part == 2).any():
        return Model(lexicon, None, (np.zeros(1), np.zeros(1)), sizes[1] / total)
    trees = fit_trees(x[part == 1], y[part == 1], w[part == 1])
    return Model(lexicon, trees, fit_isotonic(trees.raw(x[part == 2]), y[part == 2], w[part == 2]), sizes[1] / total)


def _score_batches(batches: Iterator[pa.RecordBatch], model, inside: int = -1) -> Iterator[pa.RecordBatch]:
    """The text is in `_text`, or, so that it need not come twice, in field `inside` of `row`."""
    for batch in batches:
        rest = [n for n in batch.schema.names if n != "_text"]
        for chunk in chunks(batch.column("_text") if inside < 0 else batch.column("row").field(inside), lower=False):
            scores = model.value.score(features(chunk, model.value.lexicon))
            part = batch.slice(chunk.rows.start, len(scores))
            yield pa.record_batch([*(part.column(n) for n in rest), pa.array(scores)], names=[*rest, "score"])


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of `docs` but its text, with score, and predicted: 1 from 0.5 on."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("text", "score", "predicted", "_text")]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], F.col("text").cast("string").alias("_text"))
    scored = rows.mapInArrow(partial(released, work=_score_batches, model=sent), schema_with(rows, ("_text",), "score double"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that score under one half."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    if "text" not in docs.columns or not isinstance(docs.schema["text"].dataType, StringType):
        scored = toxicity_scores(docs.select(row.alias("row"), F.col("text").cast("string").alias("text")), model)
        return scored.filter("predicted = 0").select("row.*")
    sent, rows = docs.sparkSession.sparkContext.broadcast(model), docs.select(row.alias("row"))
    score = partial(released, work=_score_batches, model=sent, inside=docs.columns.index("text"))
    return rows.mapInArrow(score, schema_with(rows, (), "score double")).filter("score < 0.5").select("row.*")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, 0).alias("held_out"), "score", "predicted")
