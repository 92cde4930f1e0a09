"""Learned operators: held-out accuracy, language-model scores against brute force, edge cases."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetstate.llm import boost, bytenet, language, scoring, toxicity
from fleetstate.llm.common import chunks
from fleetstate.llm.eliasfano import EliasFano

SF_DIR = "/root/testdata/sf0.01"
ODD = [(None, None), (1, None), (2, ""), (3, " \n"), (4, "!!! 123"), (5, "漢字"), (6, "word " * 50_000), (6, "word")]


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def area(y, score):
    order = np.argsort(score)
    rank = np.empty(len(y))
    values, place, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[place]
    del order, values
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_trees_learn_and_calibration_rises():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 4))
    y = (x[:, 0] * x[:, 1] > 0.3).astype(float)
    w = np.ones(len(y))
    trees = boost.fit_trees(x[:2000], y[:2000], w[:2000])
    raw = trees.raw(x)
    assert area(y[3000:], raw[3000:]) > 0.98
    xs, ps = boost.fit_isotonic(raw[2000:3000], y[2000:3000], w[2000:3000])
    assert (np.diff(xs) >= 0).all() and (np.diff(ps) >= 0).all() and 0 <= ps.min() and ps.max() <= 1


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    """Documents whose toxic ones hold stems of a few words, some of them masked."""
    rng = random.Random(4)
    rows, labels = [], []
    clean = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(800)]
    for i in range(1500):
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 120))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["scoundrel", "knavish" + rng.choice(clean), "you dunce", "sc0undr3l"]))
        rows.append((i, " ".join(words), "lang"))
        if i % 10:
            labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, {r[0]: r[2] for r in labels}


def test_toxicity_on_held_out_documents(spark, toxic_corpus):
    docs, labels, rows, truth = toxic_corpus
    model = toxicity.fit(docs, labels)
    scored = {r.doc_id: r for r in toxicity.toxicity_scores(docs, model).collect()}
    held = [i for i in truth if fold(i, 5) == 0]
    y, s = np.array([truth[i] for i in held]), np.array([scored[i].score for i in held])
    assert area(y, s) > 0.97 and (s >= 0).all() and (s <= 1).all()
    assert np.mean([scored[i].predicted == truth[i] for i in held]) > 0.95
    # Held-out labels teach nothing.
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, toxicity.fit(docs, flipped)).collect()}
    assert again == {i: r.score for i, r in scored.items()}
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in scored.items() if r.predicted == 0}


def test_dropping_toxic_texts_sends_each_text_once(spark, toxic_corpus):
    docs, labels = toxic_corpus[:2]
    model = toxicity.fit(docs, labels)
    wide = docs.withColumn("more.of", F.lit(1))
    kept = toxicity.drop_toxic(wide, model)
    assert kept.dtypes == wide.dtypes and "_text" not in kept._jdf.queryExecution().toString()
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect()}
    expected = sorted((r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] < 0.5)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == expected
    binary = docs.select("doc_id", F.col("text").cast("binary").alias("text"))  # cast for the score only
    rows = toxicity.drop_toxic(binary, model)
    assert rows.dtypes == binary.dtypes and sorted((r.doc_id, bytes(r.text).decode()) for r in rows.collect()) == expected


def test_toxicity_of_odd_texts(spark, toxic_corpus):
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    for labels in (toxic_corpus[1], toxic_corpus[1].filter("toxic = 0"), toxic_corpus[1].limit(0)):
        found = toxicity.toxicity_scores(odd, toxicity.fit(toxic_corpus[0], labels)).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.toxicity_scores(odd.limit(0), toxicity.fit(odd.limit(0), toxic_corpus[1])).collect() == []
    null_labels = spark.createDataFrame([(None, None, None), (1, 1, 7)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(odd, null_labels).share == 0.0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit(docs, per_language=300)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = language.identify(docs.select("doc_id", "text"), model).collect()
    held = [r for r in found if fold(r.doc_id, 5) == 0]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    odd = language.identify(spark.createDataFrame([(*r, 1) for r in ODD], "doc_id long, text string, score int"), model).collect()
    assert [r.lang_pred for r in odd if r.doc_id in (None, 1, 2, 3, 4)] == ["und"] * 5
    assert all(r.lang_pred in model.languages and 0 < r.score <= 1 for r in odd if r.doc_id in (5, 6))
    # A text longer than many windows is scored as a whole.
    long = next(r.text for r in docs.filter("lang = 'fr'").collect()) * 30
    assert language.identify(spark.createDataFrame([(1, long)], "doc_id long, text string"), model).first().lang_pred == "fr"


def test_language_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    found = language.identify(docs.drop("lang"), language.fit(docs)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2
    assert language.identify(docs.limit(0), language.fit(docs.limit(0))).collect() == []


def test_every_language_is_learned(spark, monkeypatch):
    """More languages than a batch has rows, each with an alphabet of its own."""
    monkeypatch.setattr(language, "train", partial(language.train, steps=300))
    rng = random.Random(2)
    text = lambda k: "".join(rng.choice([chr(0x4E00 + 64 * k + i) for i in range(4)]) for _ in range(40))
    rows = [(i, text(i % 210), f"l{i % 210}") for i in range(210 * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == sorted({r[2] for r in rows})
    found = language.identify(docs.select("doc_id", "text"), model).collect()
    truth = {r[0]: r[2] for r in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in found]) > 0.9


def test_repeated_ids_teach_once_under_their_own_language(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "train", lambda x, y, classes: seen.append([(bytes(w).rstrip(b"\0").decode(), int(c)) for w, c in zip(x, y)]))
    ids = [i for i in range(20) if fold(i, 5)][:4]
    rows = [(ids[0], "one", "a")] * 50 + [(ids[0], "none", None), (ids[0], "two", "b"), (ids[1], "three", "b"), (ids[2], None, "b")]
    rows += [(ids[3], "x", "a"), (ids[3], "y", "a"), (None, "null", "a")]
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert seen == [[("one", 0), ("x", 0), ("three", 1), ("two", 1)]]


def test_elias_fano_equals_search():
    r = np.random.default_rng(3)
    for _ in range(120):
        n, top = int(r.integers(0, 300)), [2, 10, 1000, 1 << 20, 1 << 40, (1 << 64) - 1][r.integers(6)]
        values = np.unique(r.integers(0, top, size=n, dtype=np.uint64, endpoint=True))
        levels = EliasFano.build(values, top + 1)
        assert (levels.get(np.arange(len(values))) == values).all()
        asked = np.concatenate([values, r.integers(0, top, size=100, dtype=np.uint64, endpoint=True)])
        places = {int(v): i for i, v in enumerate(values)}
        assert levels.find(asked).tolist() == [places.get(int(x), -1) for x in asked]


def test_elias_fano_reads_few_values_a_search(monkeypatch):
    r = np.random.default_rng(5)
    values = np.unique(r.integers(0, 1 << 40, 20000).astype(np.uint64))
    near = np.uint64(1 << 39) + np.arange(1000, dtype=np.uint64)  # one bucket, over many words of the unary bits
    for rows in (values, np.unique(np.concatenate([values, near]))):
        levels, read, low = EliasFano.build(rows, 1 << 40), [], EliasFano._low
        monkeypatch.setattr(EliasFano, "_low", lambda self, i: read.append(len(i)) or low(self, i))
        assert (levels.find(rows) == np.arange(len(rows))).all()
        if len(rows) == len(values):
            assert sum(read) < 1.8 * len(rows)
        assert (levels.find(rows, np.zeros(len(rows), np.int64), np.arange(len(rows))) == -1).all()  # the end is before the value
        monkeypatch.setattr(EliasFano, "_low", low)
        missing = near + np.uint64(1000)
        assert (levels.find(missing) == np.where(np.isin(missing, rows), np.searchsorted(rows, missing), -1)).all()


def scores_by_hand(rows):
    split = lambda t: [*(t or "").encode().lower().split(), None]
    count, pair, context, after = (collections.Counter() for _ in range(4))
    for doc_id, text in rows:
        if doc_id is None or fold(doc_id, 7) != 2:
            before = 0
            for token in split(text):
                count[token] += 1
                after[before] += not pair[before, token]
                pair[before, token] += 1
                context[before] += 1
                before = token
    n, v = sum(count.values()), len(count)
    for doc_id, text in rows:
        tokens, before, score = split(text), 0, 0.0
        for token in tokens:
            alone = max(count[token], 1) / (n + 1)
            part = max(pair[before, token] - 0.75, 0) + 0.75 * after[before] * alone
            score += math.log10(part / context[before] if context[before] else alone)
            before = token
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens)
        yield str(doc_id), len(tokens), sum(count[t] > 0 for t in tokens), n, base, score


@pytest.mark.parametrize("shard_tokens", [1 << 20, 300])
def test_scores_equal_brute_force(spark, shard_tokens):
    """With many shards the frequent words are split over several."""
    rng = random.Random(6)
    words = ["the"] * 40 + [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(80)] + ODD + [(7, "the w1 The")] * 3
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, held int")
    found = scoring.score_texts(df.repartition(3), scoring.held_out(F.col("doc_id"), 7, 2), shard_tokens, order=2).collect()
    got = sorted(found, key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    expected = sorted(scores_by_hand(rows), key=lambda r: (r[0], r[1], r[4]))
    assert [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens) for r in got] == [e[:4] for e in expected]
    for r, e in zip(got, expected):
        assert abs(r.base_score - e[4]) < 1e-8 * max(1, abs(e[4]))
        assert abs(r.score - e[5]) < 2e-4 * r.n_tokens
        assert r.held_out == (r.doc_id is not None and fold(r.doc_id, 7) == 2)


def scores_of_order(rows, order):
    """Interpolated absolute discounting by recursion over contexts of all lengths."""
    after, alone = collections.defaultdict(collections.Counter), collections.Counter()
    split = lambda t: [0, *(t or "").encode().lower().split(), None]
    for doc_id, text in rows:
        if doc_id is None or fold(doc_id, 7) != 2:
            tokens = split(text)
            for i in range(1, len(tokens)):
                alone[tokens[i]] += 1
                for k in range(1, min(order - 1, i) + 1):
                    after[tuple(tokens[i - k : i])][tokens[i]] += 1
    count = {context: sum(words.values()) for context, words in after.items()}
    n = sum(alone.values())

    def chance(context, word):
        if not context:
            return max(alone[word], 1) / (n + 1)
        shorter = chance(context[1:], word)
        if context not in count:
            return shorter
        return (max(after[context][word] - 0.75, 0) + 0.75 * len(after[context]) * shorter) / count[context]

    for doc_id, text in rows:
        tokens = split(text)
        yield str(doc_id), len(tokens) - 1, sum(math.log10(chance(tuple(tokens[max(0, i - order + 1) : i]), tokens[i])) for i in range(1, len(tokens)))


@pytest.mark.parametrize("shard_tokens, order", [(1 << 20, 3), (300, 3), (300, 4)])
def test_scores_of_higher_orders_equal_brute_force(spark, shard_tokens, order):
    rng = random.Random(8)
    words = ["the"] * 12 + [f"w{i}" for i in range(20)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(120)] + ODD + [(7, "the w1 The")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = scoring.score_texts(df.repartition(3), scoring.held_out(F.col("doc_id"), 7, 2), shard_tokens, order=order).collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in found)
    for r, e in zip(got, sorted(scores_of_order(rows, order)), strict=True):
        assert r[:2] == e[:2] and abs(r[2] - e[2]) < 1e-4 * order * r[1]
    assert scoring.ORDER >= 3


def hot(names, splits, pairs=()):
    return scoring._Hot(names, splits, np.array(pairs, dtype=np.uint64))


def test_start_of_many_short_texts_is_split():
    texts = [f"w{i} and w{i + 1}" for i in range(400)]
    words, splits = scoring._splits([(9, 1200)], texts=len(texts), tokens=1600, shards=8, share=scoring.HOT_SHARE)
    assert words.tolist() == [9, int(scoring.START)] and splits.tolist() == [8, 8]
    (chunk,) = chunks(pa.array(texts))
    layout = scoring._Layout.of(chunk, 3, 8, hot(words, splits))
    pairs = layout.levels[0]
    start = layout.names[layout.context[pairs.parent]] == scoring.START
    assert start.sum() == 400 and np.bincount(pairs.shard[start], minlength=8).max() < 100
    assert scoring._splits([], texts=1, tokens=1 << 20, shards=8, share=scoring.HOT_SHARE)[0].tolist() == []


def test_hot_pairs_are_split_and_shards_are_level():
    """A pair makes up a tenth of the text; no shard of 256 has much more than the others."""
    rng = random.Random(4)
    texts = [" ".join("of the" if rng.random() < 0.07 else f"w{int(rng.paretovariate(0.4)) % 50_000}" for _ in range(500)) for _ in range(800)]
    batch = pa.record_batch([pa.array([False] * len(texts)), pa.array(texts)], names=["held", "text"])
    shards, tokens = 256, 0
    for pair in (True, False):
        found: list = []
        for rows in scoring._hot_batches(iter([batch]), scoring.HOT_PART / shards):
            tokens = sum(rows.column("tokens").to_pylist())
            found += [(w % (1 << 64), p, n) for w, p, n, *_ in zip(*(c.to_pylist() for c in rows.columns)) if n and (pair or not p)]
        names, splits = scoring._splits([(w, n) for w, _, n in found], len(texts), tokens, shards, scoring.HOT_PART / shards)
        (chunk,) = chunks(pa.array(texts), most=1 << 30)
        layout = scoring._Layout.of(chunk, 3, shards, hot(names, splits, sorted(w for w, p, _ in found if p)))
        load = sum(np.bincount(level.shard, minlength=shards) for level in layout.levels)
        assert (load.max() / load.mean() <= 1.5) == pair, load.max() / load.mean()


@pytest.mark.parametrize("shard_tokens", [1 << 20, 200])
def test_scores_after_a_shuffle_and_with_hot_pairs(spark, shard_tokens):
    """The input comes out of a shuffle; one pair of words, and one first word, stand in every text."""
    rng = random.Random(12)
    rows = [(i, "start of the " + " ".join(rng.choice(["of the", "x", f"w{i % 9}", "of"]) for _ in range(rng.randrange(30)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).groupBy("doc_id").agg(F.max("text").alias("text"))
    found = scoring.score_texts(df, scoring.held_out(F.col("doc_id"), 7, 2), shard_tokens).collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in found)
    for r, e in zip(got, sorted(scores_of_order(rows, 3)), strict=True):
        assert r[:2] == e[:2] and abs(r[2] - e[2]) < 3e-4 * r[1]
    base = {e[0]: e[4] for e in scores_by_hand(rows)}
    assert all(abs(r.base_score - base[str(r.doc_id)]) < 1e-8 * abs(r.base_score) for r in found)


def test_scores_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scoring.score_texts(empty, F.lit(False)).collect() == []
    (row,) = scoring.score_texts(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(True)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_isotonic_fit_equals_the_greatest_of_least_means():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(1, 40))
        raw, y, w = rng.integers(0, 12, n).astype(float), rng.integers(0, 2, n), rng.uniform(0.5, 3, n)
        xs, ps = boost.fit_isotonic(raw, y, w)
        at = np.unique(raw)
        value = np.array([np.average(y[raw == x], weights=w[raw == x]) for x in at])
        mass = np.array([w[raw == x].sum() for x in at])
        for i, x in enumerate(at):
            want = max(min(np.average(value[a : b + 1], weights=mass[a : b + 1]) for b in range(i, len(at))) for a in range(i + 1))
            assert abs(np.interp(x, xs, ps) - want) < 1e-12


def test_tree_splits_equal_an_exhaustive_search():
    rng = np.random.default_rng(9)
    x = np.stack([rng.normal(size=90), rng.integers(0, 4, 90), rng.uniform(size=90)], axis=1)
    y, w = (x[:, 0] + x[:, 1] > 1.5).astype(float), rng.uniform(0.5, 2, 90)
    trees = boost.fit_trees(x, y, w, trees=3, depth=2, rate=0.3, bins=16, least=4)
    scale, raw = w / w.mean(), np.full(90, trees.start)
    assert abs(trees.start - np.log(np.average(y, weights=w) / (1 - np.average(y, weights=w)))) < 1e-12
    for t in range(3):
        p = 1 / (1 + np.exp(-raw))
        g, h = scale * (p - y), scale * p * (1 - p)
        part = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + 1)
        nodes = {0: np.ones(90, dtype=bool)}
        for node in (0, 1, 2):
            rows, best, chosen = nodes[node], 1e-9, (0, np.inf)
            for f in range(3):
                for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 17)[1:-1])):
                    low, high = rows & (x[:, f] <= cut), rows & (x[:, f] > cut)
                    gain = part(low) + part(high) - part(rows)
                    if min(low.sum(), high.sum()) >= 4 and gain > best + 1e-12:
                        best, chosen = gain, (f, cut)
            assert (trees.feature[t, node], trees.cut[t, node]) == chosen
            nodes[2 * node + 1], nodes[2 * node + 2] = rows & (x[:, chosen[0]] <= chosen[1]), rows & (x[:, chosen[0]] > chosen[1])
        for leaf in range(4):
            rows = nodes[3 + leaf]
            assert abs(trees.leaf[t, leaf] + 0.3 * g[rows].sum() / (h[rows].sum() + 1)) < 1e-12
            raw[rows] += trees.leaf[t, leaf]
    assert np.allclose(trees.raw(x), raw)


def plain_features(text, words_of, stems_of):
    """The features of an ASCII text, one character and word at a time. `words_of`, `stems_of`: log odds of entries."""
    tokens = re.findall(r"[0-9a-z]+", text.lower())
    found = [(m.start(), m.end()) for m in re.finditer(r"[0-9a-z]+", text.lower())]

    def weigh(word):
        return max([words_of.get(word, 0)] + [stems_of.get(word[:n], 0) for n in (4, 5, 6) if len(word) >= n])

    n, size = max(len(tokens), 1), max(len(text), 1)
    odds = [weigh(t) for t in tokens]
    hit, person = [o > 0 for o in odds], [t in toxicity.SECOND_PERSON.split() for t in tokens]
    near = sum(hit[i] and any(person[max(0, i - 5) : i + 6]) for i in range(len(tokens)))
    mark = [33 <= ord(c) < 127 and not c.isalnum() for c in text]
    inside = [(mark[i] or text[i].isdigit()) and i > 0 and text[i - 1].isalpha() and i + 1 < len(text) and not text[i + 1].isspace() for i in range(len(text))]
    hidden = 0
    for m in re.finditer(r"\S+", text):
        if any(inside[m.start() : m.end()]):
            plain = "".join(toxicity.LOOKALIKES.get(c, c) for c in m.group().lower())
            hidden += weigh(re.sub(r"[^0-9a-z]", "", plain)) > 0
    letters = sum(c.isalpha() for c in text)
    raw = [text[a:b] for a, b in found]
    return [
        np.log1p(len(tokens)), sum(t in words_of for t in tokens) / n, np.log1p(sum(t in words_of for t in tokens)), sum(hit) / n, np.log1p(sum(hit)),
        sum(odds) / n, max(odds, default=0), hidden / n, np.log1p(hidden), near / max(sum(hit), 1), sum(person) / n,
        sum(c.isupper() for c in text) / max(letters, 1), sum(r.isupper() and r.isalpha() and len(r) > 2 for r in raw) / n,
        sum(mark) / size, sum(c in "!?" for c in text) / size, sum(mark[i] and i > 0 and text[i] == text[i - 1] for i in range(len(text))) / size,
        sum(any(c.isdigit() for c in r) and not r.isdigit() for r in raw) / n, sum(i and m for i, m in zip(inside, mark)) / size,
        sum(i > 1 and c.isalpha() and c == text[i - 1] == text[i - 2] for i, c in enumerate(text)) / size, sum(len(r) == 1 for r in raw) / n,
    ]


def test_features_equal_a_plain_loop():
    words, stems = {"grobnik": 3.0, "fool": 2.6}, {"grob": 2.7, "zarna": 4.0}
    entries = [(0, w, o) for w, o in words.items()] + [(toxicity.STEMS.index(len(s)), s, o) for s, o in stems.items()]
    lexicon = toxicity.Lexicon.of(entries)
    rng = random.Random(2)
    pieces = ["grobnik", "GR0BNIK!!", "f00l", "fo.ol,", "zarnation", "you", "YOUR", "it's", "aaargh", "x", "A", "ABC", "12", "b4d", "!!", "?!", "a--b", "so...", "grobs"]
    texts = ["", " ", "\n!!\n"] + ["".join(rng.choice(pieces) + rng.choice([" ", " ", "\n", ""]) for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    got = np.concatenate([toxicity.features(c, lexicon) for c in chunks(pa.array(texts), lower=False, most=500)])
    want = np.array([plain_features(t, words, stems) for t in texts])
    for i, name in enumerate(toxicity.FEATURES):
        assert np.allclose(got[:, i], want[:, i], atol=1e-12), (name, texts[int(np.abs(got[:, i] - want[:, i]).argmax())])


def test_slopes_of_the_net_equal_finite_differences():
    rng = np.random.default_rng(7)
    net = bytenet.ByteNet.new(3, 4)
    net = bytenet.ByteNet(*(p.astype(np.float64) for p in net.parts()))
    x = rng.integers(1, 256, (6, bytenet.WINDOW + max(bytenet.WIDTHS) - 1)).astype(np.uint8)
    x[2, 40:] = 0
    want = np.array([0, 1, 2, 0, 1, 2])

    def loss():
        top, _ = net.pooled(x)
        return -np.log(bytenet.softmax(top @ net.out + net.out_bias)[np.arange(6), want]).mean()

    for part, slope in zip(net.parts(), net.slopes(x, want)):
        steep = np.argsort(-np.abs(slope).ravel())[:12]
        for i in steep:
            place = np.unravel_index(i, part.shape)
            kept = part[place]
            part[place] = kept + 1e-6
            up = loss()
            part[place] = kept - 1e-6
            down = loss()
            part[place] = kept
            assert abs((up - down) / 2e-6 - slope[place]) < 1e-5 * max(1, abs(slope[place]))


def test_the_text_that_teaches_does_not_hang_on_the_order_of_rows(spark):
    ids = [i for i in range(200) if fold(i, 5)][:40]
    rows = [(i, f"text {i} {k}") for i in ids for k in range(3)]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    seen = []
    for order in (rows, rows[::-1]):
        sample, _ = toxicity.training_sample(spark.createDataFrame(order, "doc_id long, text string").repartition(5), labels, "toxic")
        seen.append(sorted(r.text for r in sample.collect()))
    assert seen[0] == seen[1] and len(seen[0]) == len(ids)
