"""Packing of documents into windows by Karmarkar-Karp multiway differencing.

A document's tokens, with the end id, are cut into whole windows and a rest, and the rest
into pieces of ``piece`` tokens and a last one of at most as many. Only the pieces' lengths are shuffled, dealt by
a hash of document and position. A task collects batches of pieces whose total is that of
``ways`` windows less ``slack``, and differences each batch into as many windows: every
piece starts as a partition with one filled part; the two partitions with the largest
imbalance are merged so that the fullest part of one meets the emptiest of the other,
until one partition is left. Its parts are the windows. If one exceeds the capacity, the
batch is differenced again with one window more.

Memory of a task is one batch and ``pool`` waiting pieces. Its order follows from the
hash, so a task that is run again gives the same windows.

Defined cases: null text is empty and has one token, the end id. Null ids pass through.
Repeated rows are packed each. Damaged UTF-8 counts as U+FFFD. Documents of any length are cut. Empty tables give empty
results. Other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measure_rollup.llm.token_alignment import byte_letters

CAPACITY = 2048
PIECE = 256
WAYS = 32
SLACK = 20  # tokens a window
POOL = 256
END = 1
MEMORY = 160_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"
_ENCODERS: dict[str, "Encoder"] = {}
_LETTERS = {byte: letter for letter, byte in byte_letters().items()}

# Words that NFC leaves alone and that are lowered letter by letter, as the library does:
# printable ASCII and the Latin letters from U+00C0 to U+017F without U+0130.
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+").fullmatch
# White space and controls that two libraries might take in two ways.
_ODD = re.compile(
    "[\\x00-\\x08\\x0e-\\x1f\\x7f-\\xa0 ᠎ -‏ -  -⁤　﻿]"
).search
# What the library's pattern cuts such words into, when lowered.
_PARTS = re.compile("[a-zß-ſ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-z0-9ß-ſ \\t\\n\\r]+").findall
# Texts of such words and white space that any library takes as such.
_PLAIN_TEXT = re.compile("[!-~À-ÖØ-öø-įı-ſ \\t\\n\\r]*").fullmatch


class Encoder:
    """The ids of texts, little-endian in 4 bytes each, by the library.

    What the tokenizer's pattern cuts a text into is encoded apart and kept, up to ``memory`` of
    these parts; words with other letters than Latin ones are encoded whole and kept: the pattern
    never joins across white space. It must be BPE with word ends and lower case; another file is
    encoded text by text.
    """

    def __init__(self, tokenizer: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.by_word = getattr(self.model, "end_of_word_suffix", None) == "</w>"
        self.memory = memory
        self.words: dict[str, bytes] = {}
        self.parts = _Parts(self.model, memory)

    def __call__(self, text: str) -> bytes:
        if self.by_word and "<|" not in text and _PLAIN_TEXT(text):
            return b"".join(map(self.parts.__getitem__, _PARTS(text.lower())))
        if not self.by_word or _ODD(text):
            return self._whole(text)
        words, known = text.split(), self.words
        missing = set(words).difference(known)
        if missing:
            if len(known) + len(missing) > self.memory:
                known.clear()
                missing = set(words)
            for word in missing:
                known[word] = self._word(word)
        return b"".join(map(known.__getitem__, words))

    def forget(self) -> None:
        self.words.clear()
        self.parts.clear()

    def _whole(self, text: str) -> bytes:
        return _packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if "<|" in word or not _PLAIN(word):
            return self._whole(word)
        return b"".join(map(self.parts.__getitem__, _PARTS(word.lower())))


class _Parts(dict):
    """The ids of lowered parts of words, made when they are asked for; up to ``memory`` of them."""

    def __init__(self, model, memory: int):
        self.tokenize, self.memory = model.tokenize, memory

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.memory:
            self.clear()
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(_LETTERS)
        ids = self[part] = _packed([t.id for t in self.tokenize(letters)])
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encoder(tokenizer: str) -> Encoder:
    """One per Python worker."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = Encoder(tokenizer)
    return _ENCODERS[tokenizer]


def cut(tokens: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: whole windows, then pieces, then what is left.

    The last pieces have all lengths, with which differencing evens out the windows.
    """
    whole = tokens // capacity * capacity
    starts = [*range(0, whole, capacity), *range(whole, tokens, piece)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], tokens])]


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(column.split()[0], pa.int64()) for column in ddl.split(", ")])


def pieces(
    docs: DataFrame, tokenizer: str, end: int = END, capacity: int = CAPACITY, piece: int = PIECE
) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens."""
    last = end.to_bytes(4, "little")
    schema = _schema(PIECES)

    def tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        try:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                    ids = encode(text.as_py()) + last
                    for start, length in cut(len(ids) // 4, capacity, piece):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc_id, start, length, crc, len(ids) // 4))
                yield _columns(rows, schema)
        finally:
            encode.forget()  # the worker may go on to other stages

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8(F.coalesce("text", F.lit(""))).alias("text")
    )
    return texts.mapInArrow(tokenize, PIECES)


def difference(lengths: list[int], ways: int) -> list[list[int]]:
    """The items' indexes in ``ways`` parts of near-equal total, by multiway differencing."""
    # a part is (total, items), items a nested pair; parts are kept fullest first
    heap = [
        (-length, i, [(length, i)] + [(0, None)] * (ways - 1)) for i, length in enumerate(lengths)
    ]
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        merged = [
            (a + b, y if x is None else x if y is None else (x, y))
            for (a, x), (b, y) in zip(one, reversed(other))
        ]
        merged.sort(key=lambda part: -part[0])
        order += 1
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], order, merged))
    return [_items(items) for _, items in heap[0][2]] if heap else []


def _items(nested) -> list[int]:
    found, waiting = [], [nested]
    while waiting:
        item = waiting.pop()
        if isinstance(item, tuple):
            waiting += item
        elif item is not None:
            found.append(item)
    return found


def windows(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """As few windows as differencing fits the items into; none exceeds the capacity."""
    ways = max(1, -(-sum(lengths) // capacity))
    while True:
        parts = difference(lengths, ways)
        if all(sum(lengths[i] for i in part) <= capacity for part in parts):
            return [part for part in parts if part]
        ways += 1


def batches_of(
    rows: Iterable[tuple], capacity: int = CAPACITY, ways: int = WAYS, slack: int = SLACK, pool: int = POOL
) -> Iterator[list[tuple]]:
    """Rows (length, ...) in batches that nearly fill ``ways`` windows; the last holds what is left."""
    waiting: list[tuple] = []  # sorted by length
    batch: list[tuple] = []
    gap = target = ways * (capacity - slack)
    for row in rows:
        insort(waiting, row, key=lambda r: r[0])
        if len(waiting) < pool:
            continue
        # the middle keeps long and short pieces for the end of a batch
        row = waiting.pop(len(waiting) // 2)
        if row[0] <= gap:
            batch.append(row)
            gap -= row[0]
        else:
            insort(waiting, row, key=lambda r: r[0])
            while (best := bisect_right(waiting, gap, key=lambda r: r[0])) > 0:
                batch.append(waiting.pop(best - 1))
                gap -= batch[-1][0]
            yield batch
            batch, gap = [], target
    for row in reversed(waiting):
        if row[0] > gap:
            yield batch
            batch, gap = [], target
        batch.append(row)
        gap -= row[0]
    if batch:
        yield batch


def pack(
    cut_pieces: DataFrame, capacity: int = CAPACITY, ways: int = WAYS, slack: int = SLACK, pool: int = POOL
) -> DataFrame:
    """``cut_pieces`` with sequence_id and offset."""
    schema = _schema(PLACED)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 36
        whole: list[tuple] = []

        def parts_of_windows() -> Iterator[tuple]:
            """Pieces as (length, doc_id, start, ids_crc32, doc_tokens); whole windows are set aside."""
            names = ("length", "doc_id", "start", "ids_crc32", "doc_tokens")
            for batch in batches:
                for row in zip(*(batch[name].to_pylist() for name in names)):
                    if row[0] == capacity:
                        whole.append(row)
                    else:
                        yield row

        def placed(sequences: Iterable[list[tuple]]) -> pa.RecordBatch:
            nonlocal sequence
            out = []
            for rows in sequences:
                offset = 0
                for length, doc_id, start, crc, tokens in rows:
                    out.append((doc_id, start, length, crc, tokens, sequence, offset))
                    offset += length
                sequence += 1
            return _columns(out, schema)

        for rows in batches_of(parts_of_windows(), capacity, ways, slack, pool):
            found = windows([row[0] for row in rows], capacity)
            yield placed([[rows[i] for i in part] for part in found] + [[row] for row in whole])
            whole.clear()
        yield placed([row] for row in whole)

    order = F.xxhash64("doc_id", "start")
    dealt = cut_pieces.withColumn("deal", order).repartition("deal")
    ordered = dealt.sortWithinPartitions("deal", "doc_id", "start", "length", "ids_crc32").drop("deal")
    return ordered.mapInArrow(place, PLACED)


def pack_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece."""
    return pack(pieces(docs, tokenizer))
