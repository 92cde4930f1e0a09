"""SentencePiece encoding by sampling, and decoding.

A text is a path through the lattice of vocabulary pieces. Paths are sampled, not searched: a forward pass sums the
weight of all paths to each place, a backward pass draws one piece after the other from the end, each in proportion to
the weight of the paths it closes. The draw at a place depends on the seed, the row's key and the place alone, so the
same row gets the same pieces on any cluster, in any batch, in any order. Decoding gives back the text byte by byte.

A vocabulary of merges has ranks instead of probabilities; a piece of rank r has weight 1 / (r + 10) to the power of
`sharpness` (greater: closer to the best path). A character outside the vocabulary is spelled as its bytes.

A null text has null pieces, an empty one has none. Rows with equal key and text get equal pieces. Any length of text or
word is handled whole. Other columns are kept unless they bear a name of the result.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, _powers, chunks, mix, released, schema_with, span_hashes, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text for which the lattice of distinct words is laid out at once.
LATTICE_BYTES = 3 << 20
#: Longer words are walked one by one.
LONG_WORD = 256
#: Distinct words of a lattice: 16 bits number them.
WORDS = 1 << 16
#: Log weight of a byte of a character that the vocabulary lacks.
BYTE_WEIGHT = -20.0
_SPACE = 0x20
#: The slot of a hash: the highest 20 bits of a product.
_SPREAD, _SLOT = U64(0x9FB21C651E98DF25), U64(44)
_RESULT = ("ids", "n_pieces", "lossless")


@dataclass
class Vocabulary:
    """Pieces as bytes (the mark of a word's start is a space); `weight` is a log weight, -inf where not for text."""

    pieces: list[bytes]
    weight: np.ndarray
    byte_ids: np.ndarray
    sharpness: float = 1.0

    @classmethod
    def load(cls, path: str, sharpness: float = 1.0) -> Vocabulary:
        """Read a model file. It is read on the driver only; tasks get the table, a few MB whatever the corpus."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, weight, byte_ids = [], [], np.full(256, -1, dtype=np.int32)
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                byte_ids[value] = i
                pieces.append(bytes([value]))
                weight.append(-math.inf)
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                pieces.append(b"")
                weight.append(-math.inf)
            else:
                if "▁" in piece.lstrip("▁"):
                    raise ValueError(f"piece {piece!r} goes on into a next word")
                pieces.append(piece.replace("▁", " ").encode())
                weight.append(-sharpness * math.log(10.0 - model.get_score(i)))
        if (byte_ids < 0).any():
            raise ValueError("the vocabulary has no bytes to fall back to")
        return cls(pieces, np.array(weight), byte_ids, sharpness)

    def prepare(self) -> Vocabulary:
        """Lookup tables, made once in each task's process."""
        if not hasattr(self, "keys"):
            lengths = np.array([len(p) for p in self.pieces])
            self.lengths = lengths
            self.bytes = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)
            self.offsets = np.concatenate([[0], np.cumsum(lengths)])
            ids = np.flatnonzero(np.isfinite(self.weight) & (lengths > 0))
            starts, ends = self.offsets[:-1][ids], self.offsets[1:][ids]
            power, inverse = _powers(len(self.bytes) + 1)
            sums = np.zeros(len(self.bytes) + 1, dtype=U64)
            np.cumsum((self.bytes.astype(U64) + U64(1)) * power[: len(self.bytes)], out=sums[1:])
            spans = (sums[ends] - sums[starts]) * inverse[starts]
            order = np.lexsort((spans, spans * _SPREAD >> _SLOT))
            self.keys, self.key_ids = spans[order], ids[order].astype(np.int32)
            if len(np.unique(spans)) < len(spans):
                raise ValueError("two pieces are equal or share a hash")
            # By slot: whether it has keys, and where they begin.
            slots, first = np.unique(self.keys * _SPREAD >> _SLOT, return_index=True)
            self.seen, self.slot = np.zeros(1 << 20, dtype=bool), np.zeros(1 << 20, dtype=np.int32)
            self.seen[slots], self.slot[slots] = True, first
            self.longest_slot = int(np.diff(np.append(first, len(self.keys))).max(initial=1))
            self.sizes = np.unique(lengths[ids])
            self.of = {self.pieces[i]: (int(i), float(self.weight[i])) for i in ids}
        return self

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `hashes` (sums of bytes by powers of the hash base) that are pieces, and the pieces' ids."""
        slots = hashes * _SPREAD >> _SLOT
        maybe = np.flatnonzero(self.seen[slots])
        hashes, at = hashes[maybe], self.slot[slots[maybe]]
        hit = self.keys[at] == hashes
        for _ in range(self.longest_slot - 1):
            left = np.flatnonzero(~hit)
            at[left] = np.minimum(at[left] + 1, len(self.keys) - 1)
            hit[left] = self.keys[at[left]] == hashes[left]
        return maybe[hit], self.key_ids[at[hit]]


_LOADED: dict[int, Vocabulary] = {}


def _uniform(row_seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Draws in [0, 1) for places of rows."""
    return (mix(row_seed ^ mix(place.astype(U64) + U64(1))) >> U64(11)).astype(np.float64) * 2.0**-53


def _spelled(vocab: Vocabulary, data: np.ndarray) -> np.ndarray:
    """Which bytes belong to characters that are no piece."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    width = np.diff(np.append(lead, len(data)))
    known = np.array([bytes([b]) in vocab.of for b in range(256)])[data[lead]]
    wide = np.flatnonzero(width > 1)
    power, inverse = _powers(int(width.max(initial=1)) + 1)
    chars = np.zeros(len(wide), dtype=U64)
    for i in range(int(width.max(initial=1))):
        more = np.flatnonzero(width[wide] > i)
        chars[more] += (data[lead[wide[more]] + i].astype(U64) + U64(1)) * power[i]
    known[wide] = False
    known[wide[vocab.find(chars)[0]]] = True
    return np.repeat(~known, width)


class _Lattice:
    """All paths through some distinct words, no more than WORDS, the longest first, with the edges by end.

    The words are gone through side by side: the ends after the same number of bytes of all words that long are together, in
    order of word. So what leads to them is worked out for all at once, from what the ends before them have.
    """

    def __init__(self, vocab: Vocabulary, data: np.ndarray, spelled: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        deepest = int(sizes[0])
        ends = np.searchsorted(-sizes, -np.arange(deepest + 1), side="right")  # words of so many bytes or more
        ends[0] = 0
        self.base = np.cumsum(ends) - ends
        power, inverse = _powers(deepest + 1)
        steps = vocab.sizes[::-1].tolist()
        sums, totals = [np.zeros(len(starts), dtype=U64)], [np.zeros(len(starts))]
        heads, counts, bounds, pieces, lengths, edges = [], [], [], [], [], 0
        for depth in range(1, deepest + 1):
            n = int(ends[depth])
            byte = data[starts[:n] + (depth - 1)]
            row = sums[-1][:n] + (byte.astype(U64) + U64(1)) * power[depth - 1]
            words, ids, ways, size = [], [], [], []
            for step in steps:  # the longest first: edges of an end are by where they begin
                if step > depth:
                    continue
                word, found = vocab.find((row - sums[depth - step][:n]) * inverse[depth - step])
                words.append(word)
                ids.append(found)
                ways.append(totals[depth - step][word] + vocab.weight[found])
                size.append(np.full(len(word), step, dtype=np.uint8))
            word = np.flatnonzero(spelled[starts[:n] + (depth - 1)])
            if len(word):
                words.append(word)
                ids.append(vocab.byte_ids[byte[word]])
                ways.append(totals[depth - 1][word] + BYTE_WEIGHT)
                size.append(np.ones(len(word), dtype=np.uint8))
            word, way = np.concatenate(words).astype(np.uint16), np.concatenate(ways)
            by = np.argsort(word, kind="stable")
            by = by[way[by] > -np.inf]
            word, way = word[by], way[by]
            count = np.bincount(word, minlength=n)
            total = np.full(n, -np.inf)
            if len(by):
                some = np.flatnonzero(count)
                head, many = (np.cumsum(count) - count)[some], count[some]
                top = np.maximum.reduceat(way, head)
                share = np.exp(way - np.repeat(top, many))
                whole = np.add.reduceat(share, head)
                total[some] = top + np.log(whole)
                share /= np.repeat(whole, many)
                upto = np.cumsum(share)
                # The share is counted from the end's first edge; ends are whole numbers apart.
                upto -= np.repeat(upto[head] - share[head], many)
                bounds.append(np.minimum(upto, 1.0) + (word + self.base[depth]))
                pieces.append(np.concatenate(ids)[by])
                lengths.append(np.concatenate(size)[by])
            heads.append(edges + np.cumsum(count) - count)
            counts.append(count)
            edges += len(by)
            sums.append(row)
            totals.append(total)
            if depth >= steps[0]:
                sums[depth - steps[0]] = totals[depth - steps[0]] = None  # no piece begins there any more
        self.bound, self.piece, self.length = np.concatenate(bounds), np.concatenate(pieces), np.concatenate(lengths)
        self.head, self.tail = np.concatenate(heads), np.concatenate(heads) + np.concatenate(counts) - 1

    def draw(self, word: np.ndarray, depth: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge for the end after `depth` bytes of each word."""
        r = self.base[depth] + word
        at = np.searchsorted(self.bound, r + u, side="right")
        return np.clip(at, self.head[r], self.tail[r])


def _walk(vocab: Vocabulary, word: bytes, seed: int, place: int) -> list[int]:
    """Sample the pieces of one long word that starts at `place` of its text."""
    n, most = len(word), int(vocab.sizes[-1])
    total = array("d", [-math.inf]) * (n + 1)
    total[0] = 0.0
    spelled = bytearray(n + 1)  # ends of the bytes of characters that are no piece
    i = -1
    for j in range(n + 1):
        if j == n or word[j] & 0xC0 != 0x80:
            if i >= 0 and word[i:j] not in vocab.of:
                spelled[i + 1 : j + 1] = b"\1" * (j - i)
            i = j

    def edges(e: int) -> list[tuple[int, int, float]]:
        # Looked up again for the draw, which visits few places: only the totals of all are kept.
        found = [(e - 1, int(vocab.byte_ids[word[e - 1]]), BYTE_WEIGHT)] if spelled[e] else []
        for b in range(max(0, e - most), e):
            hit = vocab.of.get(word[b:e])
            if hit and total[b] > -math.inf:
                found.append((b, *hit))
        return found

    for e in range(1, n + 1):
        ways = [total[b] + w for b, _, w in edges(e)]
        top = max(ways, default=-math.inf)
        if top > -math.inf:
            total[e] = top + math.log(sum(math.exp(x - top) for x in ways))
    u = _uniform(np.full(n + 1, seed, dtype=U64), np.arange(place, place + n + 1))
    out, e = [], n
    while e:
        left = u[e]
        for b, piece, w in sorted(edges(e)):
            left -= math.exp(total[b] + w - total[e])
            if left < 0:
                break
        out.append(piece)
        e = b
    return out[::-1]


def encode_chunk(vocab: Vocabulary, data: np.ndarray, bounds: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds of ids) for texts laid end to end, each with a space put before it unless empty."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int32), np.zeros(len(bounds), dtype=np.int64)
    space = data == _SPACE
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[bounds[:-1][bounds[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    stops = np.append(starts[1:], n)
    row = np.searchsorted(bounds, starts, side="right") - 1
    long = stops - starts > LONG_WORD
    short = np.flatnonzero(~long)
    _, where, word = np.unique(span_hashes(data, starts, stops)[short], return_index=True, return_inverse=True)
    sizes = (stops - starts)[short][where]
    longest = np.argsort(-sizes, kind="stable")
    nth = np.empty(len(longest), dtype=np.int64)
    nth[longest] = np.arange(len(longest))
    where, sizes, word = starts[short][where][longest], sizes[longest], nth[word]
    by_word = np.argsort(word, kind="stable")  # so that draws go through a lattice from front to back
    steps: list[tuple[int, np.ndarray, np.ndarray]] = []
    count = np.zeros(len(starts), dtype=np.int64)
    spelled = _spelled(vocab, data)
    for first in range(0, len(sizes), WORDS):
        some = slice(first, first + WORDS)
        lattice = _Lattice(vocab, data, spelled, where[some], sizes[some])
        here = by_word[slice(*np.searchsorted(word[by_word], [first, first + WORDS]))]
        live, at = short[here], word[here] - first
        depth, base, seed = sizes[word[here]], starts[live] - bounds[row[live]], seeds[row[live]]
        k = 0
        while len(live):
            edge = lattice.draw(at, depth, _uniform(seed, base + depth))
            steps.append((k, live, lattice.piece[edge]))
            count[live] += 1
            depth = depth - lattice.length[edge]
            go = depth > 0
            live, at, depth, base, seed, k = live[go], at[go], depth[go], base[go], seed[go], k + 1
    walked = {}
    for i in np.flatnonzero(long).tolist():
        place = int(starts[i] - bounds[row[i]])
        walked[i] = _walk(vocab, data[starts[i] : stops[i]].tobytes(), int(seeds[row[i]]), place)
        count[i] = len(walked[i])
    upto = np.concatenate([[0], np.cumsum(count)])
    ids = np.empty(upto[-1], dtype=np.int32)
    for k, live, piece in steps:
        ids[upto[live + 1] - 1 - k] = piece
    for i, found in walked.items():
        ids[upto[i] : upto[i + 1]] = found
    return ids, upto[np.searchsorted(starts, bounds)]


def decode_ids(vocab: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of the texts of pieces laid end to end; the space before each text is gone."""
    size = vocab.lengths[ids]
    upto = np.concatenate([[0], np.cumsum(size)])
    data = vocab.bytes[np.repeat(vocab.offsets[:-1][ids] - upto[:-1], size) + np.arange(upto[-1])]
    edges = upto[bounds]
    lead = edges[:-1][edges[1:] > edges[:-1]]
    lead = lead[data[lead] == _SPACE]
    keep = np.ones(len(data), dtype=bool)
    keep[lead] = False
    return data[keep], edges - np.searchsorted(lead, edges)


def _padded(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put a space before each text that is not empty."""
    full = np.diff(bounds) > 0
    return np.insert(data, bounds[:-1][full], _SPACE), bounds + np.concatenate([[0], np.cumsum(full)])


def _encode_batches(batches: Iterator[pa.RecordBatch], vocab) -> Iterator[pa.RecordBatch]:
    vocab = vocab.value.prepare()
    for batch in batches:
        texts, seeds = batch.column("_text"), batch.column("_seed").to_numpy(zero_copy_only=False).view(U64)
        rest = [n for n in batch.schema.names if n not in ("_text", "_seed")]
        for chunk in chunks(texts, lower=False, most=LATTICE_BYTES):
            data, bounds = _padded(chunk.data, chunk.bounds)
            ids, cuts = encode_chunk(vocab, data, bounds, seeds[chunk.rows])
            back, edges = decode_ids(vocab, ids, cuts)
            same = np.diff(edges) == np.diff(chunk.bounds)
            if same.all():
                wrong = np.flatnonzero(back != chunk.data)
                same[np.searchsorted(chunk.bounds, wrong, side="right") - 1] = False
            else:  # cannot be, unless decoding lost something: compare text by text
                pairs = zip(np.split(back, edges[1:-1]), np.split(chunk.data, chunk.bounds[1:-1]))
                same = np.array([np.array_equal(a, b) for a, b in pairs])
            n = chunk.rows.stop - chunk.rows.start
            null = texts.slice(chunk.rows.start, n).is_null()
            lists = pa.ListArray.from_arrays(pa.array(cuts, type=pa.int32()), pa.array(ids), mask=null)
            sizes = pa.array(np.diff(cuts), mask=null.to_numpy(zero_copy_only=False))
            columns = [batch.column(name).slice(chunk.rows.start, n) for name in rest]
            yield pa.record_batch([*columns, lists, sizes, pa.array(same)], names=[*rest, *_RESULT])


def encode(docs: DataFrame, model: str = MODEL, seed: int = 0, sharpness: float = 1.0, key: str = "doc_id") -> DataFrame:
    """The columns of `docs` but its text, with ids, n_pieces, and lossless: whether decoding gave back the text."""
    vocab = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model, sharpness))
    rest = [c for c in docs.columns if c not in ("text", *_RESULT, "_text", "_seed")]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in rest],
        F.col("text").cast("string").alias("_text"),
        F.xxhash64(F.lit(seed).cast("bigint"), F.col(f"`{key}`").cast("string")).alias("_seed"),
    )
    more = "ids array<int>, n_pieces bigint, lossless boolean"
    return rows.mapInArrow(partial(released, work=_encode_batches, vocab=vocab), schema_with(rows, ("_text", "_seed"), more))


def _decode_batches(batches: Iterator[pa.RecordBatch], vocab) -> Iterator[pa.RecordBatch]:
    vocab = vocab.value.prepare()
    for batch in batches:
        lists = batch.column("ids")
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        data, edges = decode_ids(vocab, lists.flatten().to_numpy(zero_copy_only=False), cuts)
        body = data.tobytes()
        null = lists.is_null().to_pylist()
        texts = [None if gone else body[a:b].decode() for gone, a, b in zip(null, edges[:-1].tolist(), edges[1:].tolist())]
        rest = [n for n in batch.schema.names if n != "ids"]
        yield pa.record_batch([*[batch.column(n) for n in rest], pa.array(texts, type=pa.string())], names=[*rest, "text"])


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The columns of `encoded` with the text in place of ids. Ids of control pieces stand for nothing."""
    vocab = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    rows = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c != "text"])
    return rows.mapInArrow(partial(_decode_batches, vocab=vocab), schema_with(rows, ("ids",), "text string"))


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
