"""Lexical retrieval packing: neighbours by BM25 fill each training sequence.

Documents are tokenized where they are read, and land as token ids. Document
frequencies and the mean length are counted over all of them, then the second
moments of their idf-weighted tokens, then where they lie along the principal
axes. A document's content code says on which side of the median it lies, the
axis of most variance first. The rows are range-partitioned by code, so that
documents alike in content lie side by side
wherever they were read, and a range of a few hundred thousand tokens is a
shard. A shard has an inverted index from token ids to the documents that hold
them, with BM25 weights of the corpus. The document at the head of a sequence is
the query: its unused neighbours fill the sequence by falling score, the last
one is cut at the end, and its rest heads the next sequence. A sequence that a
shard leaves open is filled from the next shard of the task, and what a task
leaves at its end is cut into powers of two, so nothing is padded.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import small_batches
from .phases import Phases
from .words import SEPARATOR, chunks, hashes, mix, text_array, text_buffer

#: BM25's usual saturation and length weight.
K1, B = 1.2, 0.75
#: Distinct parts of words that a worker remembers the token ids of before it starts anew, also if they have four times as many ids.
REMEMBERED = 1 << 20
#: Bytes of text that are parted at once: about 30 bytes of memory each.
TEXT_BYTES = 1 << 20
#: Words that are tokenized as one text.
JOINED = 512
#: The normalizer, and the splits after it, of tokenizers whose words fall into parts by kinds of characters.
NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PARTS = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Axes of the content code, and columns that tokens are hashed into to find them.
AXES, COLUMNS = 24, 1024
#: Steps of a unit in moments and along the axes: whole numbers, whose sums are exact in any order.
STEPS = 1 << 11
#: Tokens of a shard and of a task.
SHARD_TOKENS, TASK_TOKENS = 1 << 19, 1 << 23


#: Kinds of bytes: white space, ASCII letters, ASCII digits, the rest of ASCII, and all others.
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[0x21:0x7F] = MARK
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KIND[0x30:0x3A] = DIGIT
KIND[SEPARATOR] = SPACE
#: Second bytes of the letters U+00C0 to U+00FF, which 0xC3 leads; they are composed and have no other form.
LATIN = np.zeros(256, bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False


@dataclass(frozen=True)
class Pieces:
    """Parts of words, without what lies between them: bytes, starts, which are plain, and the first of each row, and the number of all."""

    data: np.ndarray
    starts: np.ndarray
    plain: np.ndarray
    first: np.ndarray


def pieces(data: np.ndarray, offsets: np.ndarray, split: bool) -> Pieces:
    """The words of all rows; with ``split`` parted where ASCII and Latin-1 letters, digits and other ASCII characters meet, and between digits.

    Plain parts have such characters only and are lower-cased. Words with ``'``, which
    may join letters, or ``<``, which may open a token of its own, are neither
    split nor plain, and no part ends beside a character of another kind, which
    the normalizer may compose with its neighbour.
    """
    kind = KIND[data]
    row = np.zeros(len(data), bool)
    row[offsets[:-1][offsets[:-1] < len(data)]] = True
    if split:
        lead = np.flatnonzero(data[:-1] == 0xC3)
        lead = lead[LATIN[data[lead + 1]] & ~row[lead + 1]]
        kind[lead] = kind[lead + 1] = LETTER
    solid = kind != SPACE
    fresh = row  # bytes that don't go on with the word of the byte before
    fresh[1:] |= ~solid[:-1]
    data, kind, fresh = data[solid], kind[solid], fresh[solid]
    first = np.append(0, np.cumsum(solid, dtype=np.int32))[offsets]  # bytes before each row
    words = np.flatnonzero(fresh)
    if split and len(words):
        cut = kind[1:] != kind[:-1]
        cut |= kind[1:] == DIGIT
        odd = kind == OTHER
        marks = np.flatnonzero((data == 0x27) | (data == 0x3C))
        if len(marks):
            whole = np.zeros(len(words), bool)
            whole[np.searchsorted(words, marks, "right") - 1] = True
            odd |= np.repeat(whole, np.diff(np.append(words, len(data))))
        some = odd.any()
        if some:
            cut &= ~(odd[1:] | odd[:-1])
        fresh[1:] |= cut
        starts = np.flatnonzero(fresh)
        plain = ~np.logical_or.reduceat(odd, starts) if some else np.ones(len(starts), bool)
        low = (data >= 0x41) & (data <= 0x5A)
        second = np.flatnonzero(data[:-1] == 0xC3) + 1
        low[second[(data[second] <= 0x9E) & (kind[second] == LETTER) & (kind[second - 1] == LETTER)]] = True
        if some:
            low &= np.repeat(plain, np.diff(np.append(starts, len(data))))
        data = data + (low.view(np.uint8) << 5)
    else:
        starts, plain = words, np.zeros(len(words), bool)
    return Pieces(data, starts, plain, np.searchsorted(starts, first))


class WordTokens:
    """Token ids of words, remembered by their parts' hashes for the life of a Python worker.

    Only right for tokenizers that split at white space first and drop it. If the
    tokenizer then parts letters, digits and other characters as ``PARTS`` says,
    so do the words here, and parts of ``pieces``' plain bytes reach its merges
    without the normalizer's and the pattern's work, lower-cased before.
    """

    _of: dict[str, WordTokens] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        model, added = self.tokenizer.model, self.tokenizer.get_added_tokens_decoder().values()
        self.split = (
            isinstance(model, models.BPE)
            and bool(model.end_of_word_suffix)
            and not model.dropout
            and [x and json.loads(x.__getstate__()) for x in self.steps] == [NORMAL, PARTS]
            and all("<" in t.content for t in added)
        )
        if self.split:
            self.plain_steps = normalizers.Sequence([]), pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.last[[i for t, i in self.tokenizer.get_vocab(False).items() if t.endswith(model.end_of_word_suffix)]] = True
        self.clear()

    @classmethod
    def of(cls, path: str) -> WordTokens:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def clear(self) -> None:
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words one after the other, and how many each has; a token belongs to the word it starts in."""
        ids, size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for part, found in self._batches(texts):
            ends = np.cumsum([len(t) + 1 for t in part])
            start = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(found))[::2]
            ids.append(np.array(found.ids, np.int32))
            size.append(np.bincount(np.searchsorted(ends, start, "right"), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(size)

    def encoded_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain parts; each ends with the only token that says it is the last one."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ids, size, wrong = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], False
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.plain_steps
        try:
            for part, found in self._batches(texts):
                ids.append(np.array(found.ids, np.int32))
                ends = np.flatnonzero(self.last[ids[-1]]) + 1
                size.append(np.diff(ends, prepend=0))
                wrong |= len(ends) != len(part) or ends[-1] != len(ids[-1])
        finally:
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.steps
        return self.encoded(texts) if wrong else (np.concatenate(ids), np.concatenate(size))

    def _batches(self, texts: list[str]) -> Iterator[tuple[list[str], object]]:
        """Parts of ``texts`` and what the tokenizer makes of each, a few thousand words at a time."""
        for lo in range(0, len(texts), 16 * JOINED):
            parts = [texts[i : i + JOINED] for i in range(lo, min(lo + 16 * JOINED, len(texts)), JOINED)]
            yield from zip(parts, self.tokenizer.encode_batch([" ".join(p) for p in parts], add_special_tokens=False))

    def learn(self, keys: np.ndarray, texts: list[str], plain: np.ndarray) -> None:
        """Remember the parts ``texts`` by their sorted ``keys``."""
        order = np.argsort(~plain, kind="stable")
        n = int(plain.sum())
        texts = [texts[i] for i in order.tolist()]
        (a, m), (b, k) = self.encoded_plain(texts[:n]), self.encoded(texts[n:])
        size = np.append(m, k).astype(np.int32)
        begin = (len(self.ids) + np.cumsum(size) - size).astype(np.int32)
        self.ids = np.concatenate([self.ids, a, b])
        back = np.argsort(order)  # keys come sorted
        at = np.searchsorted(self.keys, keys)
        self.begin, self.size = np.insert(self.begin, at, begin[back]), np.insert(self.size, at, size[back])
        self.keys = np.insert(self.keys, at, keys)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows, each followed by ``end``, and the rows' offsets in them."""
        found = pieces(data, offsets, self.split)
        seen = pa.Array.from_buffers(pa.large_binary(), len(found.starts), [None, pa.py_buffer(np.append(found.starts, len(found.data))), pa.py_buffer(found.data)]).dictionary_encode()
        words, back = seen.dictionary, seen.indices.to_numpy()
        keys = hashes(*text_buffer(words))
        order = np.argsort(keys)
        keys = keys[order]
        if len(self.keys) + len(keys) > REMEMBERED or len(self.ids) > 4 * REMEMBERED:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            plain = np.zeros(len(keys), bool)
            plain[back] = found.plain
            texts = words.take(pa.array(order[new])).to_pylist()
            self.learn(keys[new], [t.decode("utf-8", "replace") for t in texts], plain[order[new]])
            at = np.searchsorted(self.keys, keys)
        own = np.empty(len(keys), np.int64)
        own[order] = at
        size = self.size[own][back]
        after = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=after[1:])
        bounds = after[found.first] + np.arange(len(offsets))
        kind = np.int32 if len(self.ids) + after[-1] < 1 << 31 else np.int64
        index = np.repeat((self.begin[own][back] - after[:-1]).astype(kind), size)
        index += np.arange(after[-1], dtype=kind)
        out = np.full(int(bounds[-1]), end, np.int32)
        inner = np.ones(len(out), bool)
        inner[bounds[1:] - 1] = False
        out[inner] = self.ids[index]
        return out, bounds


@dataclass(frozen=True)
class Corpus:
    """BM25's numbers of all documents: each token's idf, and the mean length."""

    idf: np.ndarray
    mean: float


@dataclass(frozen=True)
class Router:
    """Each token's hashed column and signed weight, the axes over the columns, and the medians along them in ``STEPS``."""

    column: np.ndarray
    weight: np.ndarray
    axes: np.ndarray
    medians: np.ndarray

    @classmethod
    def flat(cls, idf: np.ndarray) -> Router:
        """Columns and weights alone, from each token's idf."""
        number = np.arange(1, len(idf) + 1, dtype=np.uint64)
        column = (mix(number) % np.uint64(COLUMNS)).astype(np.int64)
        weight = np.where(mix(number + np.uint64(len(idf))) & np.uint64(1), idf, -idf)
        return cls(column, weight, np.eye(COLUMNS)[:, :AXES], np.zeros(AXES, np.int64))

    def vectors(self, ids: np.ndarray, bounds: np.ndarray, step: int) -> Iterator[np.ndarray]:
        """Unit vectors of the documents' hashed tokens, ``step`` documents at a time."""
        for lo in range(0, len(bounds) - 1, step):
            hi = min(lo + step, len(bounds) - 1)
            own = ids[bounds[lo] : bounds[hi]]
            doc = np.repeat(np.arange(0, (hi - lo) * COLUMNS, COLUMNS), np.diff(bounds[lo : hi + 1]))
            x = np.bincount(doc + self.column[own], self.weight[own], (hi - lo) * COLUMNS).reshape(hi - lo, COLUMNS)
            yield x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)

    def places(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where each document lies along the axes, from -STEPS to STEPS; in small products, which take no threads of their own."""
        found = [np.rint(x @ self.axes * STEPS).astype(np.int64) for x in self.vectors(ids, bounds, 20)]
        return np.clip(np.concatenate([np.zeros((0, AXES), np.int64), *found]), -STEPS, STEPS)

    def codes(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return (self.places(ids, bounds) > self.medians) @ (1 << np.arange(AXES)[::-1])


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, sorted, and how often each is there; sorting alone takes a fraction of np.unique's hashing."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    begin = np.flatnonzero(new)
    return values[begin], np.diff(np.append(begin, len(values)))


class Shard:
    """An inverted index of a shard's documents: postings by token, each with its BM25 weight.

    The weights follow ``corpus``, or the shard itself if none is given.
    """

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, corpus: Corpus | None = None):
        n = len(bounds) - 1
        self.used = np.zeros(n, bool)
        length = np.diff(bounds)
        doc = np.repeat(np.arange(n), length)
        key, times = distinct(ids.astype(np.int64) * n + doc)
        self.term, self.doc = key // n, key % n
        df = np.bincount(self.term)
        idf = np.log1p((n - df + 0.5) / (df + 0.5)) if corpus is None else corpus.idf
        norm = K1 * (1 - B + B * length / (length.mean() if corpus is None else corpus.mean))
        self.weight = idf[self.term] * times * (K1 + 1) / (times + norm[self.doc])
        self.begin = np.searchsorted(self.term, np.arange(len(df) + 1))

    def neighbours(self, query: np.ndarray) -> np.ndarray:
        """Unused documents by falling score for the query's distinct tokens; ties in order."""
        terms, _ = distinct(query)
        terms = terms[terms < len(self.begin) - 1]
        size = self.begin[terms + 1] - self.begin[terms]
        at = np.repeat(self.begin[terms] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        score = np.bincount(self.doc[at], self.weight[at], len(self.used))
        free = np.flatnonzero(~self.used)
        return free[np.argsort(-score[free], kind="stable")]


class Packer:
    """Pieces of sequences of ``size`` tokens, in the order in which they are cut."""

    def __init__(self, size: int, numbers: Iterator[int]):
        self.size, self.numbers = size, numbers
        self.sequence, self.filled = next(numbers), 0
        self.query: np.ndarray | None = None
        self.pieces: list[tuple] = []

    def add(self, doc: object, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            if not self.filled:
                self.query = ids
            n = min(len(ids) - start, self.size - self.filled)
            self.pieces.append((doc, start, ids[start : start + n], len(ids), self.sequence, self.filled))
            start, self.filled = start + n, self.filled + n
            if self.filled == self.size:
                self.sequence, self.filled = next(self.numbers), 0

    def fill(self, shard: Shard, docs: list, ids: np.ndarray, bounds: np.ndarray) -> None:
        """All of the shard's documents, each sequence's in the order of its query's neighbours."""
        left = len(docs)
        while left:
            if not self.filled:  # a new seed
                order = [int(np.argmin(shard.used))]
            else:
                order = shard.neighbours(self.query).tolist()
            before = self.sequence
            for d in order:
                shard.used[d] = True
                left -= 1
                self.add(docs[d], ids[bounds[d] : bounds[d + 1]])
                if self.sequence != before:
                    break

    def close(self) -> None:
        """Cut the open sequence into powers of two, the largest first."""
        if not self.filled:
            return
        tail = [p for p in self.pieces if p[4] == self.sequence]
        done = [p for p in self.pieces if p[4] != self.sequence]
        left = self.filled
        room, offset, sequence = 1 << left.bit_length() - 1, 0, self.sequence
        for doc, start, ids, total, _, _ in tail:
            at = 0
            while at < len(ids):
                if not room:
                    room, offset, sequence = 1 << left.bit_length() - 1, 0, next(self.numbers)
                n = min(len(ids) - at, room)
                done.append((doc, start + at, ids[at : at + n], total, sequence, offset))
                at, offset, room, left = at + n, offset + n, room - n, left - n
        self.pieces = done


def _tokens(path: str, end: int, width: np.dtype):
    """doc_id and ids of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens.of(path)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch["text"], TEXT_BYTES):
                ids, bounds = tokens.encode(data, offsets, end)
                raw = text_array(ids.astype(width).view(np.uint8), bounds * width.itemsize, binary=True)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(lo, hi - lo), raw], ["doc_id", "ids"])

    return run


def _ids(column: pa.Array, width: np.dtype) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, ids, bounds) of a chunk of landed documents."""
    for lo, hi, data, offsets in chunks(column):
        yield lo, hi, data.view(width).astype(np.int32), offsets // width.itemsize


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc_ids, bytes, offsets) of about ``size`` bytes of ids, wherever the batches end."""
    rest = None
    for batch in batches:
        rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        begin, n = 0, len(rest)
        for lo, hi, data, offsets in chunks(rest["ids"], size):
            begin = lo
            if hi < n:
                yield rest["doc_id"].slice(lo, hi - lo), data, offsets
        rest = rest.slice(begin) if n else None
    for lo, hi, data, offsets in chunks(rest["ids"], size) if rest is not None else ():
        yield rest["doc_id"].slice(lo, hi - lo), data, offsets


def _moments(width: np.dtype, router):
    """For each column, its sums of products with all columns and, last, its own sum, over the documents' vectors in ``STEPS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((COLUMNS, COLUMNS + 1))
        for batch in batches:
            for _, _, ids, bounds in _ids(batch["ids"], width):
                for x in router.value.vectors(ids, bounds, 256):
                    x = np.rint(x * STEPS)
                    total[:, :-1] += x.T @ x
                    total[:, -1] += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(COLUMNS)), pa.array([r.tobytes() for r in total], pa.binary())], ["number", "sums"])

    return run


def _added(rows: pa.Table) -> pa.Table:
    sums = sum(np.frombuffer(r.as_buffer()) for chunk in rows["sums"].chunks for r in chunk)
    return pa.table({"number": rows["number"][:1], "sums": pa.array([sums.tobytes()], pa.binary())})


def _at_places(width: np.dtype, router):
    """How many documents lie at each place of each axis."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = 2 * STEPS + 1
        n = np.zeros(AXES * wide, np.int64)
        for batch in batches:
            for _, _, ids, bounds in _ids(batch["ids"], width):
                n += np.bincount((router.value.places(ids, bounds) + STEPS + np.arange(AXES) * wide).ravel(), minlength=AXES * wide)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen // wide), pa.array(seen % wide - STEPS), pa.array(n[seen])], ["axis", "place", "n"])

    return run


def _coded(width: np.dtype, router):
    """The landed rows with their content codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = [router.value.codes(ids, bounds) for _, _, ids, bounds in _ids(batch["ids"], width)]
            code = pa.array(np.concatenate([np.zeros(0, np.int64), *code]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], code, batch["place"], batch["ids"]], ["doc_id", "code", "place", "ids"])

    return run


def _frequencies(tokens: int, width: np.dtype):
    """The number of documents that hold each token; number -1 has all documents' tokens, -2 the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows, total = np.zeros(tokens, np.int64), 0, 0
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch["ids"]):
                ids = data.view(width).astype(np.int64)
                doc = np.repeat(np.arange(hi - lo) * tokens, np.diff(offsets) // width.itemsize)
                df += np.bincount(distinct(doc + ids)[0] % tokens, minlength=tokens)
                rows, total = rows + hi - lo, total + len(ids)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, [-1, -2])), pa.array(np.append(df[seen], [total, rows]))], ["number", "n"])

    return run


def _pack(width: np.dtype, size: int, shard_tokens: int, kind: pa.DataType, corpus):
    def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
        ids = [p[2] for p in pieces]
        bounds = np.append(0, np.cumsum([4 * len(i) for i in ids])).astype(np.int64)
        data = np.concatenate(ids).astype("<u4").view(np.uint8) if ids else np.zeros(0, np.uint8)
        column = lambda k: pa.array([p[k] for p in pieces], pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pieces], kind), column(1), pa.array([len(i) for i in ids], pa.int64()), text_array(data, bounds, binary=True), column(3), column(4), column(5)],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        packer = Packer(size, iter(range(first, first + (1 << 32))))
        for docs, data, offsets in _shards(batches, shard_tokens * width.itemsize):
            ids, bounds = data.view(width).astype(np.int32), offsets // width.itemsize
            packer.fill(Shard(ids, bounds, corpus.value), docs.to_pylist(), ids, bounds)
            # pieces of the open sequence wait, as it may be cut once more
            done = [p for p in packer.pieces if p[4] != packer.sequence]
            packer.pieces = [p for p in packer.pieces if p[4] == packer.sequence]
            if done:
                yield batch_of(done)
        packer.close()
        if packer.pieces:
            yield batch_of(packer.pieces)

    return run


def _router(landed: DataFrame, width: np.dtype, df: np.ndarray, rows: int) -> Router:
    """The principal axes of all documents' unit vectors, and the medians of all documents along them.

    A task keeps one matrix of moments, so there are as many tasks as cores; the
    driver gets one sum of the matrices and the counts of places.
    """
    spark = landed.sparkSession
    router = Router.flat(np.log((1 + rows) / (1 + df)))
    few = landed.select("ids").coalesce(max(spark.sparkContext.defaultParallelism, 1))
    shape = "number long, sums binary"
    sums = few.mapInArrow(_moments(width, spark.sparkContext.broadcast(router)), shape).groupBy("number").applyInArrow(_added, shape).toArrow()
    total = np.zeros((COLUMNS, COLUMNS + 1))
    for number, row in zip(sums["number"].to_pylist(), sums["sums"].to_pylist()):
        total[number] = np.frombuffer(row)
    if rows > 1:
        _, axes = np.linalg.eigh(total[:, :-1] - np.outer(total[:, -1], total[:, -1]) / rows)
        router = replace(router, axes=np.ascontiguousarray(axes[:, ::-1][:, :AXES]))
    counts = landed.select("ids").mapInArrow(_at_places(width, spark.sparkContext.broadcast(router)), "axis long, place long, n long")
    found = counts.groupBy("axis", "place").agg(F.sum("n").alias("n")).toArrow()
    axis, place, n = (found[c].to_numpy() for c in ("axis", "place", "n"))
    medians = np.zeros(AXES, np.int64)
    for k in range(AXES if rows else 0):
        own = np.flatnonzero(axis == k)
        own = own[np.argsort(place[own])]
        medians[k] = place[own[np.searchsorted(np.cumsum(n[own]), (rows + 1) // 2)]]
    return replace(router, medians=medians)


def pack(docs: DataFrame, tokenizer: str, end: int = 2, size: int = 4096, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): one row per piece.

    A document's ids are those of the tokenizer file ``tokenizer`` (which every
    executor can read), then ``end``; null text counts as empty. ``ids`` holds the
    piece as little-endian unsigned 32-bit numbers. Sequences have ``size`` ids,
    but for those at the end of a task, whose lengths are powers of two. Every
    row is a document of its own, also one that repeats a doc_id or has none. An
    empty table gives an empty one; other columns are ignored.

    Axes, medians, document frequencies and mean length are those of all rows, and
    every row is coded and indexed. Rows of one code are
    ordered by doc_id and place, so a hot code is split over ranges and shards like
    any other. A shard has about ``shard_tokens`` tokens, a longer document one of its own.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    phases = Phases(spark, "packing")
    small_batches(spark)
    tokens = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end + 1)
    width = np.dtype("<u2" if tokens <= 1 << 16 else "<u4")
    docs = docs.select("doc_id", "text")
    kind = "string" if docs.schema["doc_id"].dataType.simpleString() == "string" else "long"
    docs = docs.withColumn("doc_id", F.col("doc_id").cast(kind))
    landed = docs.mapInArrow(_tokens(tokenizer, end, width), f"doc_id {kind}, ids binary")
    landed = phases.land(landed.withColumn("place", F.monotonically_increasing_id()), "tokens")
    sums = landed.select("ids").mapInArrow(_frequencies(tokens, width), "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    number, n = sums["number"].to_numpy(), sums["n"].to_numpy()
    total, rows = int(n[number == -1].sum()), int(n[number == -2].sum())
    df = np.zeros(tokens)
    df[number[number >= 0]] = n[number >= 0]
    corpus = spark.sparkContext.broadcast(Corpus(np.log1p((rows - df + 0.5) / (df + 0.5)), total / max(rows, 1)))
    tasks = max(-(-total // TASK_TOKENS), min(spark.sparkContext.defaultParallelism, -(-total // shard_tokens)), 1)
    router = spark.sparkContext.broadcast(_router(landed, width, df, rows))
    coded = landed.mapInArrow(_coded(width, router), f"doc_id {kind}, code long, place long, ids binary")
    near = coded.repartitionByRange(tasks, "code", "doc_id", "place").sortWithinPartitions("code", "doc_id", "place")
    return near.select("doc_id", "ids").mapInArrow(
        _pack(width, size, shard_tokens, pa.string() if kind == "string" else pa.int64(), corpus),
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def default_tokenizer() -> str:
    """The installed file of the public tokenizer that the packing query names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
