"""Best-fit packing: token sequences of one length, filled by minimum bin slack.

Documents are encoded, closed by an end token, and cut only where longer than a sequence. Each sequence is then the fullest
combination of pieces that are left: it takes the longest piece, and subset sums of the other lengths, held as bits of one
number, give the fullest filling of the room beside it, which is removed.

Pieces of one length are alike, so the choice is made over the counts of lengths, at most as many as a sequence has tokens,
however many pieces there are; a combination is used again as long as its pieces last, which is what choosing anew would
give. The n-th piece of a length has its sequence and place by arithmetic: no piece is shuffled for it, and there are no
groups. Places of pieces are counted per partition, and the counts of the partitions before come from a small table.

Null text is empty: a document of the end token alone. Rows are documents of their own, also where they share an id or a
text. A text is encoded whole, by words that no token of the vocabulary crosses; a run of letters is encoded in one go,
however long. Other columns are ignored. An empty table gives no sequences.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, chunks, mix, settle, span_hashes, table

SIZE, END = 2048, 0
#: Words and tokens that a task remembers; then it starts afresh.
CACHED_WORDS, CACHED_TOKENS = 1 << 20, 1 << 23
#: Rows of the table of offsets (24 bytes each) up to which it is sent to all tasks; a larger one is joined by shuffle.
SENT_ROWS = 1 << 20

_U64 = np.uint64


# Classes of bytes: white space, ASCII letters, ASCII digits, other ASCII, the apostrophe, and bytes beyond ASCII.
_CLASS = np.full(256, 5, dtype=np.int8)
_CLASS[:128] = 3
for _bytes, _kind in ((b"\t\n\x0b\x0c\r ", 0), (bytes([*range(65, 91), *range(97, 123)]), 1), (b"0123456789", 2), (b"'", 4)):
    _CLASS[list(_bytes)] = _kind
# No token crosses from one class to another, but for marks that may combine with what is before them (beyond ASCII) and
# for what may follow an apostrophe. [i, j]: whether a word begins at a byte of class j after one of class i.
_BEGINS = np.zeros((6, 6), dtype=bool)
_BEGINS[0, 1:] = True
for _i, _j in ((1, 2), (2, 1), (1, 3), (1, 4), (2, 3), (2, 4), (3, 1), (3, 2), (4, 2)):
    _BEGINS[_i, _j] = True
_BEGINS = _BEGINS.ravel()


def words(data: np.ndarray, bounds: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes that are encoded on their own, and for each text the number of runs before it.

    `whole`: only white space separates.
    """
    kind = _CLASS[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    inside = kind > 0
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[1:-1] = inside[1:] & ~inside[:-1] if whole else _BEGINS[kind[:-1] * 6 + kind[1:]]
    begins[edges] = inside[edges]
    stops = begins.copy()
    stops[:-1] |= ~inside
    stops[bounds] = True
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(inside & stops[1:]) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII capitals in small letters, but where a mark beyond ASCII follows: the vocabulary composes before it lowers."""
    plain = np.append(data[1:] < 128, True)
    return np.where(plain, LOWER[data], data)


class Encoder:
    """Token ids of texts by a vocabulary of small letters whose tokens cross neither white space nor kinds of characters:
    every different word is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Bytes that hold any id.
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.final = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.final[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.key, self.check = np.empty(0, dtype=_U64), np.empty(0, dtype=_U64)
        self.at, self.many = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Some ids, and for each word where its own begin in them and how many it has."""
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
        alpha = np.fromiter(map(str.isalpha, texts), dtype=bool, count=len(texts))
        at, many, pool, size = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64), [], 0
        # Words of letters are one run each, so that many are encoded as one text; the last token of each is marked.
        rest, letters = [np.flatnonzero(~alpha)], np.flatnonzero(alpha)
        for lo in range(0, len(letters), 4096):
            some = letters[lo : lo + 4096]
            (one,) = self.tokenizer.encode_batch_fast([" ".join([texts[i] for i in some])], add_special_tokens=False)
            tokens = np.array(one.ids, dtype=np.uint32)
            stops = np.flatnonzero(self.final[tokens]) + 1
            if len(stops) != len(some):
                rest.append(some)
                continue
            many[some] = np.diff(stops, prepend=0)
            at[some] = size + stops - many[some]
            pool.append(tokens)
            size += len(tokens)
        rest = np.concatenate(rest)
        for lo in range(0, len(rest), 4096):
            some = rest[lo : lo + 4096]
            for i, one in zip(some, self.tokenizer.encode_batch_fast([texts[i] for i in some], add_special_tokens=False)):
                pool.append(np.array(one.ids, dtype=np.uint32))
                at[i], many[i] = size, len(pool[-1])
                size += len(pool[-1])
        return np.concatenate([np.empty(0, dtype=np.uint32), *pool]), at, many

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and the number of ids before each text (one more at the end)."""
        small = lower(data)
        raw = small.tobytes()
        whole = any(mark in raw for mark in self.special)  # the string of a special token in some text
        small = data if whole else small
        starts, ends, at = words(small, bounds, whole)
        ids, many = self._words(small, starts, ends)
        return ids, np.concatenate([[0], np.cumsum(many)])[at]

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        if len(self.key) > CACHED_WORDS or len(self.ids) > CACHED_TOKENS:
            self.forget()
        key, check = span_hashes(data, starts, ends), _check(data, starts, ends)
        new, first, word = np.unique(key, return_index=True, return_inverse=True)
        place = np.searchsorted(self.key, new)
        known = place < len(self.key)
        known[known] = self.key[place[known]] == new[known]
        if not known.all():
            missing, first, fresh = new[~known], first[~known], place[~known]
            ids, at, many = self._encode(data, starts[first], ends[first])
            self.key, self.check = np.insert(self.key, fresh, missing), np.insert(self.check, fresh, check[first])
            self.at, self.many = np.insert(self.at, fresh, len(self.ids) + at), np.insert(self.many, fresh, many)
            self.ids = np.concatenate([self.ids, ids])
            place = place + np.cumsum(~known) - ~known
        at, many, pool = self.at[place][word], self.many[place][word], self.ids
        other = np.flatnonzero(self.check[place][word] != check)
        if len(other):  # another word of the same hash
            ids, own, length = self._encode(data, starts[other], ends[other])
            at[other], many[other] = len(pool) + own, length
            pool = np.concatenate([pool, ids])
        stop = np.cumsum(many)
        return pool[np.repeat(at - (stop - many), many) + np.arange(int(stop[-1]))], many


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


def _check(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length, first and last eight bytes of words, mixed: a second hash that shares nothing with the first."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=_U64)
    short = np.minimum(size, 8)
    head = eight[starts] & masks[short]
    return mix(head ^ mix(eight[ends - short] & masks[short]) ^ size.astype(_U64))


def _pieces(batches: Iterator[pa.RecordBatch], path: str, size: int, end: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Pieces of documents, with the number of this partition and their place among its pieces of the same length."""
    encode, number = encoder(path), TaskContext.get().partitionId()
    seen = np.zeros(size + 1, dtype=np.int64)
    for batch in batches:
        for chunk in chunks(batch.column("text"), lower=False):
            ids, bounds = encode(chunk.data, chunk.bounds)
            ids = np.insert(ids, bounds[1:], end)
            tokens = np.diff(bounds) + 1
            pieces = -(-tokens // size)
            doc = np.repeat(np.arange(len(tokens)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * size
            length = np.minimum(size, tokens[doc] - start)
            order = np.argsort(length, kind="stable")
            sorted_length = length[order]
            group = np.searchsorted(sorted_length, sorted_length)
            nth = np.empty(len(doc), dtype=np.int64)
            nth[order] = np.arange(len(doc)) - group + seen[sorted_length]
            seen += np.bincount(length, minlength=size + 1)
            offsets = np.concatenate([[0], np.cumsum(length)])
            width = encode.width
            raw = pa.py_buffer(ids.astype(f"<u{width}"))
            body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(offsets * width), raw])
            doc_id = batch.column("doc_id").slice(chunk.rows.start, chunk.rows.stop - chunk.rows.start).take(pa.array(doc)).cast(id_type)
            columns = [doc_id, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), body.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.full(len(doc), number, dtype=np.int32)), pa.array(nth)], names=["doc_id", "piece", "start", "length", "body", "part", "nth"]
            )


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """How many of each length fill `room` best, of those that `counts` has. `lengths` are in falling order.

    Bit s of a number says whether some pieces add up to s. Of equal fillings one with long pieces is taken.
    """
    bits, mask, steps = 1, (2 << room) - 1, []
    for length in lengths:
        most = min(counts[length], room // length)
        if not most:
            continue
        steps.append((length, most, bits))
        step = 1
        while most:
            now = min(step, most)
            bits |= (bits << (now * length)) & mask
            most, step = most - now, 2 * step
        if bits >> room:
            break
    left, taken = bits.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        many = next(k for k in range(most + 1) if left >= k * length and before >> (left - k * length) & 1)
        if many:
            taken[length] = many
            left -= many * length
    return taken


def combinations(counts: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Minimum bin slack over counts of lengths: (number of sequences, pieces of each length in one)."""
    left = {k: n for k, n in counts.items() if n}
    lengths, out = sorted(left, reverse=True), []
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        chosen = fullest(left, lengths, size - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        for k, n in chosen.items():
            left[k] -= times * n
        lengths = [k for k in lengths if left[k]]
        out.append((times, chosen))
    return out


class Plan:
    """Where the n-th piece of each length goes."""

    def __init__(self, counts: dict[int, int], size: int):
        self.by_length: dict[int, list[list[int]]] = {}
        self.sequences, used = 0, dict.fromkeys(counts, 0)
        for times, chosen in combinations(counts, size):
            offset = 0
            for length in sorted(chosen, reverse=True):
                many = chosen[length]
                rows = self.by_length.setdefault(length, [[], [], [], []])
                for row, value in zip(rows, (used[length], many, offset, self.sequences)):
                    row.append(value)
                used[length] += times * many
                offset += many * length
            self.sequences += times

    def place(self, length: int, nth: int) -> tuple[int, int]:
        first, many, offset, sequence = self.by_length[length]
        i = bisect_right(first, nth) - 1
        turn, copy = divmod(nth - first[i], many[i])
        return sequence[i] + turn, offset[i] + copy * length


def _place(batches: Iterator[pa.RecordBatch], plan, width: int) -> Iterator[pa.RecordBatch]:
    place = plan.value.place
    for batch in batches:
        nth = (batch.column("nth").to_numpy() + batch.column("before").to_numpy()).tolist()
        placed = [place(k, n) for k, n in zip(batch.column("length").to_pylist(), nth)]
        body = batch.column("body").cast(pa.large_binary())
        offsets = np.frombuffer(body.buffers()[1], dtype=np.int64)[body.offset : body.offset + len(body) + 1]
        raw = np.frombuffer(body.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        ids = raw.view(f"<u{width}").astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(((offsets - offsets[0]) // width).astype(np.int32)), pa.array(ids))
        sequence, offset = zip(*placed) if placed else ((), ())
        columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length")]
        yield pa.RecordBatch.from_arrays(
            [*columns, lists, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
        )


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of each piece of `docs` (doc_id, text)."""
    from pyspark.sql.pandas.types import to_arrow_type

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    kind = docs.schema["doc_id"].dataType
    spark = docs.sparkSession
    names = f"doc_id {kind.simpleString()}, piece int, start bigint, length bigint"
    cut = partial(_pieces, path=path, size=size, end=end, id_type=to_arrow_type(kind))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    pieces = settle(docs.select("doc_id", text).mapInArrow(cut, f"{names}, body binary, part int, nth bigint"))
    counts = settle(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    plan = Plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    if counts.count() <= SENT_ROWS:
        before = F.broadcast(before)
    place = partial(_place, plan=spark.sparkContext.broadcast(plan), width=encoder(path).width)
    return pieces.join(before, ["part", "length"]).select("doc_id", "piece", "start", "length", "body", "nth", "before").mapInArrow(
        place, f"{names}, ids array<int>, sequence_id bigint, offset bigint"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the tokens of each sequence in order. A group has no more than a sequence holds."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets, ids = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        kept = [batch.column(c) for c in batch.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], names=[*(c for c in batch.schema.names if c != "ids"), "ids_crc32"])


def op12_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema if f.name != "ids")
    return packed.mapInArrow(_digest, f"{fields}, ids_crc32 bigint")
