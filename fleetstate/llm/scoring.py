"""Language-model scores: an n-gram model of all training texts, in Elias-Fano tries by shard.

Tokens are words between ASCII white space, A-Z in lower case, and one end per text. The model is interpolated absolute
discounting up to an order: P(w|uv) = max(c(uvw) - D, 0) / c(uv) + D t(uv) / c(uv) P(w|v), t(uv) being the number of
different words after uv, and so on down to P(w) = max(c(w), 1) / (N + 1), where all unknown words are one. After a
context never seen it is the probability after the context without its first word. No context goes beyond a text's start.

Nothing is held or sent whole. A chunk of texts sends its different n-grams, with their training counts, to the shards of
their first words. A shard adds up what all chunks send, lays its part of the model out as a trie, looks up the n-grams of
each chunk, and answers in the order it was asked: counts of the first words, and quantised probabilities and weights. The
parts of a sum P(w|uv) lie in the shards of u, v and w, so a chunk puts it together, and adds up its texts. Every word
of a chunk comes before something, so the answers hold the counts of all its words. First words with a great share of all
tokens, the start of a text too, are split over several shards by the second; a chunk asks all of these and adds up what they count.
At order 3 frequent pairs are contexts of their own, split by the third word; at higher orders a pair is not split.

A null text is empty; an empty one has its end only. Repeated rows are texts of their own, and count twice in training.
Without training texts all scores are 0. Words are told apart by 64 bits of hash. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACED, U64, Chunk, chunks, held_out, mix, settle, span_hashes, table
from .eliasfano import Trie, chances

DISCOUNT = 0.75
#: Words of the longest n-grams of the query.
ORDER = 3
#: Bytes of text in a chunk, training tokens of a shard.
CHUNK, SHARD_TOKENS = 1 << 24, 3_000_000
#: Contexts with a greater share of the training tokens, or that would fill a greater part of a shard, are split over shards in
#: such parts. Bytes of text to a token, for a first guess of their number.
HOT_SHARE, HOT_PART, BYTES_OF_TOKEN = 1 / 2048, 1 / 16, 6
#: Keys of the start of a text, as a context, and of its end, as a token.
START, END = U64(0x5354415254), U64(0x454E44)
FOLDS, FOLD = 7, 2

_ROWS = "chunk bigint, part int, body binary, texts array<struct<id: {id}, held: boolean>>"


_KINDS = [np.dtype(c) for c in ("u1", "u2", "u4", "u8", "i8")]


def _pack(*arrays: np.ndarray, wide: int = 4) -> bytes:
    """Arrays of whole numbers as compressed bytes: of those `wide` bytes or more wide first all lowest bytes, then the next."""
    head = np.array([len(arrays), wide, *(x for a in arrays for x in (len(a), _KINDS.index(a.dtype)))], dtype=np.int64)
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if a.itemsize >= wide and len(a) else a.tobytes() for a in arrays)
    body = b"".join([head.tobytes(), *planes])
    return np.int64(len(body)).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(blob: bytes, first: int = 0, after: int | None = None) -> list[np.ndarray]:
    """The arrays, or those from `first` to before `after`."""
    body = pa.decompress(blob[8:], int(np.frombuffer(blob, np.int64, 1)[0]), codec="zstd", asbytes=True)
    many, wide = np.frombuffer(body, np.int64, 2).tolist()
    head = np.frombuffer(body, np.int64, 2 * many, 16).reshape(many, 2)
    out, at = [], 16 + 16 * many
    for i, (n, kind) in enumerate(head.tolist()):
        size = _KINDS[kind].itemsize
        if first <= i and (after is None or i < after):
            planes = np.frombuffer(body, np.uint8, n * size, at)
            out.append(planes.view(_KINDS[kind]) if size < max(2, wide) else np.ascontiguousarray(planes.reshape(size, n).T).view(_KINDS[kind]).reshape(n))
        at += n * size
    return out


def _rising(x: np.ndarray) -> np.ndarray:
    """Different values, rising: numpy's own way by hashes takes longer."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])[: len(x)]]


def _small(x: np.ndarray) -> np.ndarray:
    """Unsigned, no wider than needed."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


class _Level:
    """The n-grams of one order in a chunk: last word, shard, and places of the n-grams without their last word (`parent`)
    and without their first (`suffix`), all by shard, parent and word; `node` has the place of each token's, or -1."""

    def __init__(self, word: np.ndarray, shard: np.ndarray, parent: np.ndarray, suffix: np.ndarray | None, node: np.ndarray):
        self.word, self.shard, self.parent, self.suffix = word.astype(np.int32), shard.astype(np.int32), parent.astype(np.int32), suffix
        self.node = node.astype(np.int32)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values, rising, and the place of each value among them, in less memory than numpy's own."""
    by = np.argsort(codes).astype(np.int32)
    codes = codes[by]  # sorted
    new = np.append(True, codes[1:] != codes[:-1])[: len(codes)]
    place = np.empty(len(codes), dtype=np.int32)
    place[by] = np.cumsum(new, dtype=np.int32) - 1
    return codes[new], place


def _words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different words by hash, rising; the place of each word of the chunk among them; words of each text)."""
    hashes, sizes, lo = [], [], 0
    while lo < len(chunk.bounds) - 1:  # some texts at a time
        hi = max(lo + 1, int(np.searchsorted(chunk.bounds, chunk.bounds[lo] + (1 << 20), side="right")) - 1)
        data = chunk.data[chunk.bounds[lo] : chunk.bounds[hi]]
        starts, ends, cuts = Chunk(slice(lo, hi), data, chunk.bounds[lo : hi + 1] - chunk.bounds[lo]).words(SPACED)
        hashes.append(span_hashes(data, starts, ends))
        sizes.append(np.diff(cuts))
        lo = hi
    keys, place = _distinct(np.concatenate([np.empty(0, dtype=U64), *hashes]))
    return keys, place, np.concatenate([np.empty(0, dtype=np.int64), *sizes])


@dataclass(frozen=True)
class _Hot:
    """Contexts with a great share of the tokens, by name, over how many shards each is split, and those of them that are pairs."""

    names: np.ndarray
    splits: np.ndarray
    pairs: np.ndarray


def pair_names(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Names of pairs of words, as contexts."""
    return mix(one * U64(0x9E3779B97F4A7C15) + mix(two ^ U64(0x50414952)))


class _Layout:
    """The n-grams of a chunk, level by level, by shard and by their words, the same way whenever it is worked out."""

    @classmethod
    def of(cls, chunk: Chunk, order: int, shards: int, hot: _Hot) -> _Layout:
        return cls(*_words(chunk), order, shards, hot)

    def __init__(self, keys: np.ndarray, place: np.ndarray, sizes: np.ndarray, order: int, shards: int, hot: _Hot):
        """`keys`: the different words, rising; `place`: which of them each word of the texts is; `sizes`: words of each text."""
        self.sizes = sizes
        texts, n, words = len(sizes), len(place), len(keys)
        self.names = np.concatenate([keys, [START, END]]).astype(U64)
        # One token after the other: a text's first follows the start, its last is the end.
        self.text = np.repeat(np.arange(texts, dtype=np.int32), self.sizes + 1)
        self.token = np.full(n + texts, words + 1, dtype=np.int32)
        before = np.full(n + texts, words, dtype=np.int32)
        of = np.arange(n, dtype=np.int32) + np.repeat(np.arange(texts, dtype=np.int32), self.sizes)
        self.token[of] = place
        before[of + 1] = place  # the place after a word is in the same text, as each text has an end
        del of, place
        first = np.cumsum(self.sizes + 1) - self.sizes - 1
        nth = np.arange(n + texts, dtype=np.int32) - np.repeat(first.astype(np.int32), self.sizes + 1)
        # Where a hot pair goes before, it is a context like a word, and the n-gram of three is a pair of the first level.
        self.extra, pairs = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        if order == 3 and len(hot.pairs):
            at = np.flatnonzero(nth >= 1)
            name = pair_names(self.names[before[at - 1]], self.names[before[at]])
            found = np.minimum(np.searchsorted(hot.pairs, name), len(hot.pairs) - 1)
            inside = hot.pairs[found] == name
            self.extra = at[inside]
            present, pairs = np.unique(found[inside], return_inverse=True)
            self.names = np.concatenate([self.names, hot.pairs[present]])
        size = len(self.names)
        codes = np.concatenate([before, (words + 2 + pairs).astype(np.int32)]).astype(np.int64)
        del before, pairs
        codes *= size
        codes[: n + texts] += self.token
        codes[n + texts :] += self.token[self.extra]
        pair, node = _distinct(codes)
        del codes
        context, word = (pair // size).astype(np.int32), (pair % size).astype(np.int32)
        del pair
        # Shards: by the context; for hot ones also by the word.
        home = (mix(self.names) % U64(shards)).astype(np.int64)
        split = np.ones(size, dtype=np.int64)
        if len(hot.names):
            at = np.minimum(np.searchsorted(hot.names, self.names), len(hot.names) - 1)
            split = np.where(hot.names[at] == self.names, hot.splits[at], 1)
        shard = (home[context] + (mix(self.names[word] ^ U64(0xA5)) % split[context].astype(U64)).astype(np.int64)) % shards
        # A context is asked about in all its shards, also where it has no pair.
        asked, many = np.flatnonzero(np.bincount(context, minlength=size)), split
        every = np.repeat(asked, many[asked])
        part = np.arange(len(every)) - np.repeat(np.cumsum(many[asked]) - many[asked], many[asked])
        where = (home[every] + part) % shards
        by = np.lexsort((every, where))
        self.context, self.context_shard = every[by], where[by]
        by = np.argsort(shard, kind="stable")  # pairs are by context and word already
        rank = np.empty(len(by), dtype=np.int32)
        rank[by] = np.arange(len(by), dtype=np.int32)
        slot = self.context_shard * size + self.context
        parent = np.searchsorted(slot, shard[by] * size + context[by])
        self.words, self.extra_node = words, rank[node[n + texts :]]
        self.levels = [_Level(word[by], shard[by], parent, None, rank[node[: n + texts]])]
        del rank, node, context, word, shard, by, parent
        # A longer n-gram goes where the one without its last word is; a text's first tokens have none.
        plain = np.ones(n + texts, dtype=bool)
        plain[self.extra] = False
        for least in range(1, order - 1):
            last, at = self.levels[-1], np.flatnonzero((nth >= least) & plain).astype(np.int32)
            codes = last.node[at - 1].astype(np.int64)
            codes *= size
            codes += self.token[at]
            gram, index = _distinct(codes)
            del codes
            parent, word = (gram // size).astype(np.int32), (gram % size).astype(np.int32)
            del gram
            suffix = np.empty(len(word), dtype=np.int32)
            suffix[index] = last.node[at]
            node = np.full(n + texts, -1, dtype=np.int32)
            node[at] = index
            self.levels.append(_Level(word, last.shard[parent], parent, suffix, node))

    def questions(self, learn: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """For each shard asked: contexts and words (by differences), then for each level the n-grams of each parent, and
        their last words' places and training counts."""
        taught = learn[self.text]
        counts = [np.bincount(x.node[taught & (x.node >= 0)], minlength=len(x.word)) for x in self.levels]
        counts[0] += np.bincount(self.extra_node[taught[self.extra]], minlength=len(counts[0]))
        for shard in np.unique(self.context_shard).tolist():
            lo, hi = np.searchsorted(self.context_shard, [shard, shard + 1])
            spans = [tuple(np.searchsorted(x.shard, [shard, shard + 1])) for x in self.levels]
            words, place = np.unique(np.concatenate([x.word[a:b] for x, (a, b) in zip(self.levels, spans)]), return_inverse=True)
            body, at = [_steps(self.names[self.context[lo:hi]]), _steps(self.names[words])], 0
            for x, n, (a, b) in zip(self.levels, counts, spans):
                body += [_small(np.bincount(x.parent[a:b] - lo, minlength=hi - lo)), _small(place[at : at + b - a]), _small(n[a:b])]
                lo, hi, at = a, b, at + b - a
            yield shard, _pack(*body, wide=2)


def _steps(names: np.ndarray) -> np.ndarray:
    """Differences of names, the first to 0; their sums (of 64 bits) are the names again."""
    return np.diff(names, prepend=U64(0))


def _names(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=U64)


def _chunk_id(batch_ids: np.ndarray, chunk: Chunk) -> int:
    """A number for a chunk that any run of the task gives it again: from the row numbers of its texts."""
    return int(batch_ids[chunk.rows.start])


def _question_batches(batches: Iterator[pa.RecordBatch], order: int, shards: int, hot, keep: bool, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("id", id_type), ("held", pa.bool_())]))
    for batch in batches:
        numbers = batch.column("row").to_numpy()
        held = batch.column("held").to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column("text"), most=CHUNK):
            name = _chunk_id(numbers, chunk)
            if keep:  # the text, which is smaller than its words' hashes and numbers, and than its layout
                ids = batch.column("doc_id").slice(chunk.rows.start, len(chunk.bounds) - 1).to_pylist()
                body = _pack(chunk.data, _small(np.diff(chunk.bounds)))
                texts = [{"id": i, "held": bool(h)} for i, h in zip(ids, held[chunk.rows])]
                columns = [pa.array([name]), pa.array([-1], pa.int32()), pa.array([body], pa.binary()), pa.array([texts], kind)]
                yield pa.record_batch(columns, names=["chunk", "part", "body", "texts"])
                continue
            for shard, body in _Layout.of(chunk, order, shards, hot.value).questions(~held[chunk.rows]):
                columns = [pa.array([name]), pa.array([shard], pa.int32()), pa.array([body], pa.binary())]
                yield pa.record_batch(columns, names=["chunk", "part", "body"])


def _answer(rows: pd.DataFrame, hot) -> pd.DataFrame:
    """One shard: build the trie level by level from all questions, which are unpacked one at a time, and answer each. One
    row more says how many words it counts."""
    bodies = rows["body"].tolist()
    depth = (len(_unpack(bodies[0])) - 2) // 3
    own, used = [], []
    for body in bodies:
        context, names, many, index, count, *deeper = _unpack(body)
        own.append(_rising(np.repeat(_names(context), many)[count > 0]))
        taught = np.zeros(len(names), dtype=bool)
        for i, n in zip([index, *deeper[1::3]], [count, *deeper[2::3]]):
            taught[i[n > 0]] = True
        used.append(_names(names)[taught])
    own = _rising(np.concatenate(own))
    trie = Trie(own, _rising(np.concatenate(used)), DISCOUNT)
    del used
    words, place, out = [], [], [[] for _ in bodies]
    for body in bodies:
        context, names = _unpack(body, 0, 2)
        words.append(trie.words.find(_names(names)).astype(np.int32))
        place.append(trie.roots.find(_names(context)).astype(np.int32))
    for i in range(depth):
        keys, counts, asked = [], [], []
        for body, at, word in zip(bodies, place, words):
            many, index, count = _unpack(body, 2 + 3 * i, 5 + 3 * i)
            asked.append((many.copy(), index.copy()))  # not with all of the body that they lie in
            seen = np.flatnonzero(count)
            keys.append(np.repeat(at, many)[seen].astype(U64) * U64(trie.size) + word[index[seen]].astype(U64))
            counts.append(count[seen])
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        trie.grow(keys, counts)
        del keys, counts
        level = trie.levels[i]
        for nth, (many, index) in enumerate(asked):
            at = place[nth]
            if i:
                out[nth].append(np.where(at >= 0, level.weight[at] if len(level.weight) else 0, 0).astype(np.uint16))
            else:
                out[nth] += [_small(x) for x in trie.contexts(at)]
            found = trie.find(i, at, many, words[nth][index])
            out[nth].append(np.where(found >= 0, level.code[found] if len(level.code) else 0, 0).astype(np.uint16))
            place[nth] = found.astype(np.int32)
    own = own[(own != START) & ~np.isin(own, hot.value.names)]
    part = int(rows["part"].iloc[0])
    return pd.DataFrame(
        {
            "chunk": [*rows["chunk"], -1 - part],
            "part": np.array([*rows["part"], -2], dtype=np.int32),
            "body": [*(_pack(*answers) for answers in out), _pack(np.array([len(own)], dtype=np.int64))],
        }
    )


def _sum_texts(rows: pd.DataFrame, order: int, shards: int, hot, tokens: int, ends: int) -> pd.DataFrame:
    """One chunk: its texts' sums from their words and what the shards answered."""
    rows = rows.sort_values("part", kind="stable", ignore_index=True)
    first = int(rows["part"].iloc[0])
    if first == -2:  # a shard's number of words
        n = sum(int(_unpack(b)[0][0]) for b in rows["body"])
        return pd.DataFrame({"id": [None], "held": [None], "n_tokens": [0], "n_known": [0], "base": [0.0], "score": [0.0], "words": [n]})
    data, sizes = _unpack(rows["body"].iloc[0])
    bounds = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
    layout = _Layout.of(Chunk(slice(0, len(sizes)), data, bounds), order, shards, hot.value)
    del data
    answers = [np.concatenate(a) for a in zip(*(_unpack(b) for b in rows["body"].iloc[1:]))]
    n, words, texts = len(layout.names), layout.words, len(sizes)
    # Counts and numbers of successors by context; a hot one's come in parts.
    place, pairs = layout.context, layout.levels[0]
    total, many = np.bincount(place, answers[0], n), np.bincount(place, answers[1], n)
    alone = total[: words + 2].copy()
    alone[words + 1] = ends  # the end is no context
    unigram = np.maximum(alone, 1) / (tokens + 1)
    before, after = place[pairs.parent], unigram[pairs.word]
    base = np.maximum(total[before], 1)
    # A shard's probabilities are those in its own part of a context.
    kept = chances(answers[2]) * answers[0][pairs.parent]
    chance = np.where(total[before] > 0, (kept + DISCOUNT * many[before] * after) / base, after)
    if len(layout.extra):  # what follows a hot pair falls back on what follows its second word
        longer, index = np.unique(layout.extra_node, return_index=True)
        shorter = chance[pairs.node[layout.extra[index]]]
        of = before[longer]
        chance[longer] = np.where(total[of] > 0, (kept[longer] + DISCOUNT * many[of] * shorter) / base[longer], shorter)
    logs = np.log10(chance)[pairs.node]
    logs[layout.extra] = np.log10(chance)[layout.extra_node]
    for level, weight, code in zip(layout.levels[1:], answers[3::2], answers[4::2]):
        shorter, left = chance[level.suffix], chances(weight)[level.parent]
        chance = np.where(left > 0, chances(code) + left * shorter, shorter)
        have = level.node >= 0
        logs[have] = np.log10(chance)[level.node[have]]
    word_logs = np.where(np.arange(words + 2) < words, np.log10(alone + 1), 0.0)
    known = ((alone > 0) & (np.arange(words + 2) < words)).astype(np.int64)
    entries = rows["texts"].iloc[0]
    return pd.DataFrame(
        {
            "id": [e["id"] for e in entries],
            "held": [e["held"] for e in entries],
            "n_tokens": layout.sizes.astype(np.int64) + 1,
            "n_known": np.bincount(layout.text, known[layout.token], texts).astype(np.int64) + int(ends > 0),
            "base": np.bincount(layout.text, word_logs[layout.token], texts) + np.log10(ends + 1),
            "score": np.bincount(layout.text, logs, texts),
            "words": 0,
        }
    )


def _hot_batches(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Training tokens and texts, and the words and pairs of words with a great share of a chunk's tokens."""
    for batch in batches:
        held = batch.column("held").to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column("text")):
            starts, ends, cuts = chunk.words(SPACED)
            learn = ~held[chunk.rows]
            sizes = np.diff(cuts)
            taught = np.repeat(learn, sizes)
            hashes = span_hashes(chunk.data, starts, ends)
            before = np.concatenate([[START], hashes[:-1]]).astype(U64)[: len(hashes)]
            before[cuts[:-1][sizes > 0]] = START
            tokens = int(taught.sum() + learn.sum())
            found, counts, is_pair = [], [], []
            for pair, names in ((False, hashes[taught]), (True, pair_names(before, hashes)[taught])):
                names, n = np.unique(names, return_counts=True)
                some = n >= share / 2 * tokens
                found.append(names[some])
                counts.append(n[some])
                is_pair.append(np.full(int(some.sum()), pair))
            rows = sum(map(len, found))
            yield pa.record_batch(
                [
                    pa.array(np.append(np.concatenate(found), U64(0)).view(np.int64)),
                    pa.array(np.append(np.concatenate(is_pair), False)),
                    pa.array(np.append(np.concatenate(counts), 0)),
                    pa.array(np.append(np.zeros(rows, np.int64), tokens)),
                    pa.array(np.append(np.zeros(rows, np.int64), int(learn.sum()))),
                ],
                names=["word", "pair", "n", "tokens", "texts"],
            )


def _splits(often: list[tuple[int, int]], texts: int, tokens: int, shards: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Contexts with a great share of all tokens, rising, and over how many shards each is split: frequent words and pairs, and the
    start of a text, which comes before as many tokens as there are texts."""
    if texts and texts >= share * tokens:
        often = [*often, (int(START), texts)]
    often = sorted(often)
    splits = [min(shards, 1 + int(n * shards / tokens / HOT_PART)) for _, n in often]
    return np.array([w for w, _ in often], dtype=U64), np.array(splits, dtype=np.int64)


def score_texts(docs: DataFrame, held: Column, shard_tokens: int = SHARD_TOKENS, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); texts that are `held` out teach nothing.

    `docs` is read three times. Each time the texts of a partition are put in order of id and hash, so that the chunks are
    the same ones, whatever order the rows come in.
    """
    if order < 2:
        raise ValueError(f"order {order}: a model has contexts of one word at least")
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", held.alias("held"), F.col("text").cast("string").alias("text"))
    # A context that would fill a part of a shard is hot. Shards are known by their size only once tokens are counted.
    size = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    share = min(HOT_SHARE, HOT_PART * shard_tokens / max(1, size / BYTES_OF_TOKEN))
    counting = rows.select("held", "text").mapInArrow(
        partial(_hot_batches, share=share), "word bigint, pair boolean, n bigint, tokens bigint, texts bigint"
    )
    counted = settle(counting)
    sums = counted.agg(F.sum("tokens").alias("tokens"), F.sum("texts").alias("texts")).first()
    tokens, texts = int(sums["tokens"] or 0), int(sums["texts"] or 0)
    shards = max(1, -(-tokens // shard_tokens))
    # By their share there are fewer than 2 / share of the words, and as many pairs: some hundred bytes for each shard.
    often = counted.filter("n > 0").groupBy("word", "pair").agg(F.sum("n").alias("n")).filter(F.col("n") >= share * tokens)
    found = [(int(U64(r["word"] % (1 << 64))), r["pair"], r["n"]) for r in often.collect() if order == 3 or not r["pair"]]
    names, splits = _splits([(w, n) for w, _, n in found], texts, tokens, shards, share)
    pairs = np.sort(np.array([w for w, pair, _ in found if pair], dtype=U64))
    hot = docs.sparkSession.sparkContext.broadcast(_Hot(names, splits, pairs))

    numbered = rows.sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ask = partial(_question_batches, order=order, shards=shards, hot=hot, id_type=to_arrow_type(kind))
    questions = numbered.mapInArrow(partial(ask, keep=False), "chunk bigint, part int, body binary")
    answers = questions.groupBy("part").applyInPandas(partial(_answer, hot=hot), "chunk bigint, part int, body binary")
    schema = _ROWS.format(id=kind.simpleString())
    kept = numbered.mapInArrow(partial(ask, keep=True), schema)
    together = kept.unionByName(answers, allowMissingColumns=True)
    out = f"id {kind.simpleString()}, held boolean, n_tokens bigint, n_known bigint, base double, score double, words bigint"
    scored = settle(together.groupBy("chunk").applyInPandas(partial(_sum_texts, order=order, shards=shards, hot=hot, tokens=tokens, ends=texts), out))
    hot_words = int(((names != START) & ~np.isin(names, pairs)).sum())
    distinct = int(scored.agg(F.sum("words")).first()[0] or 0) + hot_words + int(texts > 0)
    spread = float(np.log10(tokens + distinct + 1))
    return scored.filter("held is not null").select(
        F.col("id").alias("doc_id"),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(spread)).alias("base_score"),
        "score",
    )


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, held_out(F.col("doc_id"), FOLDS, FOLD), order=ORDER)
