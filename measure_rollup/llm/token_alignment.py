"""Alignment of two tokenizers over a corpus, by windows between white-space tokens.

Every text is tokenised whole by a byte-level tokenizer A and a piece tokenizer B. Both must
give back the bytes of the text with one space in front. Where a token of A and a token of B
end at the same byte and the next ones carry the mark of a space, the text is cut: these
verified shared ends are anchors, and what lies between two of them is a window, known by its
token ids alone. Windows repeat like words do, so groups and links of a segment are computed
once and kept by its text (``MEMORY`` of them, rather those that come again; the result does not
depend on it).

A group ends wherever tokens of both end. A link is a pair of an A and a B token whose byte
ranges overlap. The count of a pair of ids is the number of links of the whole corpus with it.

The corpus-wide counts are sums over distinct pairs of ids, not over texts:

* A task writes its texts in chunks. A text holds the numbers of its distinct segments in the chunk
  and how often each occurs; a chunk holds, once, the pairs of ids that its segments' links have, and
  how many links each has in it. So a pair that is in every text of the corpus is one row per chunk.
* The numbers of a pair are summed over chunks, and compared with those of its B id.
* These sums go back to the chunks, where each segment adds up those of its links, and each text
  those of its segments.

The join by pair sends what makes up ``1 / SHARE`` of all rows or more, at most
``SHARE`` keys, to every task, and the rest by its key, so that no key is hot.

Defined cases: texts that are null, empty, damaged UTF-8, or that one of the tokenizers does
not give back, have no tokens: zeros, and an empty string for the digest. Null ids pass
through, and repeated rows are rows of their own. Texts of any length are one window if they
have no anchor; segments longer than ``LONG`` are not kept for long. Empty tables give empty
results. Other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import struct
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as Over
from pyspark.sql import functions as F

from measure_rollup.llm.scratch import Scratch

MEMORY = 100_000  # segments a task knows
LONG = 64  # characters
CHARACTERS = 1_000_000  # that are encoded at once, unless a single text has more
TEXTS = 512
CHUNK_TEXTS = 16_384
CHUNK_SEGMENTS = 131_072
CHUNK_BYTES = 1 << 25  # of what a chunk's segments and texts hold
LINKED = 65_536  # segments whose links are computed at once
JOINED = 256  # plain words that B encodes as one text
SHARE = 100_000

_SPACE = 0x20
#: White space of any library, and what might be taken for it, never ends a segment.
_BORDER = re.compile(r"(?<=[^\s\x00-\x20\x7f-\xa0\u180e\u200b-\u200f\u2028-\u202f\u2060-\u2064\ufeff])(?= )").split
#: Printable ASCII and the Latin letters from U+00C0 to U+017F; and a segment of one space and these.
_PLAIN = re.compile("[ -~À-ÖØ-öø-ſ]+").fullmatch
_WORD = re.compile(" [!-~À-ÖØ-öø-ſ]+").fullmatch
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>").fullmatch
_TEXTS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " places array<int>, times array<int>, sizes array<int>, held array<int>, links array<long>, numbers array<long>"
)
_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_id", pa.int64()),
        *((name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()),
        *((name, pa.list_(pa.int32())) for name in ("places", "times", "sizes", "held")),
        *((name, pa.list_(pa.int64())) for name in ("links", "numbers")),
    ]
)
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
_PAIRS: dict[tuple[str, str], "Pair"] = {}

Window = tuple[Sequence[int], Sequence[int]]  # ids of A and of B


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for the
    letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(other)}


#: What is known of a segment: its windows, packed; numbers of A and B tokens; the text of its
#: groups; numbers of groups and links. None if its tokens do not give it back.
Entry = tuple[tuple[bytes, ...], int, int, bytes, int, int] | None


class Pair:
    """Both tokenizers, the bytes of their tokens, and the segments known so far.

    Texts are encoded by segment where that gives what encoding them whole gives: A's pattern
    never joins what is no white space to a space after it, and no piece of B holds the mark of
    a space behind another character. ``Pair`` checks both files for this. A segment ends
    where a character that is no white space, of whatever library, is followed by a space;
    its end is then an anchor, and a text's windows are those of its segments.
    """

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=pieces)
        letters = byte_letters()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = [
            bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode()
            for t in (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        ]
        self.b_bytes = [_piece_bytes(name) for name in names]
        self.a_sizes, self.b_sizes = ([len(t) for t in tokens] for tokens in (self.a_bytes, self.b_bytes))
        self.a_widths, self.b_widths = np.array(self.a_sizes), np.array(self.b_sizes)
        #: Ids as groups hold them: before another of their tokenizer, before B's, and at the end.
        self.names = [b"%d%c" % (i, c) for i in range(max(len(self.a_bytes), len(self.b_bytes))) for c in b",|;"]
        self.name_widths = np.array([len(n) for n in self.names])
        self.size, self.code = (2, "H") if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else (4, "I")
        self.lone_space = [self.b.piece_to_id("▁")]
        self.splits = (
            _by_pattern(json.loads(self.a.to_str()))
            and self.b.normalize(" \ufb01  A\u030a ") == "▁▁\ufb01▁▁A\u030a▁"
            and not any("▁" in name.lstrip("▁") for name in names)
            and self.b_bytes[self.lone_space[0]] == b" "
        )
        self.quick = _by_rank(json.loads(self.a.to_str()), letters)
        self.known: dict[str, Entry] = {}
        self.again: set[str] = set()  # those asked for again since some were last forgotten

    def segments(self, text: str) -> list[str]:
        """Pieces of a space and the text, each beginning with a space."""
        return _BORDER(" " + text) if self.splits and "▁" not in text else [" " + text]

    def learn(self, segments: Iterable[str]) -> None:
        """Make all of these known. If that is too many, those that came once only are forgotten."""
        segments = set(segments)
        here = segments & self.known.keys()
        missing = list(segments - here)
        self.again |= here
        if len(self.known) + len(missing) > MEMORY:
            kept = here if len(self.again) + len(missing) > MEMORY else self.again
            entries = {s: self.known[s] for s in kept if s in self.known}
            self.forget()
            self.known.update(entries)
        words, simple, other = [], [], []
        joined = self.splits and self.quick is not None
        for s in missing:
            (words if joined and _WORD(s) else other if " " in s[1:] else simple).append(s)
        if words:
            self.known.update(zip(words, self._words(words)))
        for some in (simple, other):
            if some:
                self.known.update(zip(some, self._listed(some, some is simple)))

    def forget(self) -> None:
        self.known.clear()
        self.again.clear()

    def _encode_a(self, segments: list[str]) -> list[list[int]]:
        """By the same merges in tiktoken, where no library can take a character for another class."""
        if self.quick is None:
            return [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        quick = self.quick.encode_ordinary
        ids = [quick(s) if _PLAIN(s) else None for s in segments]
        other = [n for n, found in enumerate(ids) if found is None]
        for n, e in zip(other, self.a.encode_batch_fast([segments[n] for n in other], add_special_tokens=False)):
            ids[n] = e.ids
        return ids

    def _words(self, segments: list[str]) -> list[Entry]:
        """Plain words are encoded joined: as a text they are cut into the same segments, which changes no token."""
        text = "".join(segments)
        a = self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        parts = ["".join(segments[n : n + JOINED])[1:] for n in range(0, len(segments), JOINED)]
        b = np.array(list(chain.from_iterable(self.b.encode(parts, num_threads=1))), np.int64)
        borders = np.cumsum(list(map(len, segments) if text.isascii() else [len(s.encode()) for s in segments]))
        return self._entries(text.encode(), borders, a, b) or self._listed(segments, True)

    def _listed(self, segments: list[str], simple: bool) -> list[Entry]:
        """Segments that are encoded one by one."""
        a = self._encode_a(segments)
        b = [ids or self.lone_space for ids in self.b.encode([s[1:] for s in segments], num_threads=1)]
        datas = [s.encode() for s in segments]
        flat_a, flat_b = (np.array(list(chain.from_iterable(ids)), np.int64) for ids in (a, b))
        entries = self._entries(b"".join(datas), np.cumsum(list(map(len, datas))), flat_a, flat_b) if simple else None
        return entries or list(map(self._entry, datas, a, b))

    def _entries(self, whole: bytes, borders: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[Entry] | None:
        """Segments that are single windows and end at ``borders``; None if tokens do not give each of them back."""
        if (
            b"".join(map(self.a_bytes.__getitem__, a.tolist())) != whole
            or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != whole
        ):
            return None
        ends_a, ends_b = np.cumsum(self.a_widths[a]), np.cumsum(self.b_widths[b])
        in_a, in_b = (np.zeros(len(whole) + 1, bool) for _ in "ab")
        in_a[ends_a], in_b[ends_b] = True, True
        if not (in_a[borders] & in_b[borders]).all():  # the tokens only agree with all of it together
            return None
        shared_a, shared_b = in_b[ends_a], in_a[ends_b]
        cuts_a, cuts_b = np.flatnonzero(shared_a) + 1, np.flatnonzero(shared_b) + 1
        # a group's tokens of A, then those of B
        place_a = np.arange(len(a)) + np.concatenate(([0], cuts_b))[np.cumsum(shared_a) - shared_a]
        place_b = np.arange(len(b)) + cuts_a[np.cumsum(shared_b) - shared_b]
        names = np.empty(len(a) + len(b), np.int64)
        names[place_a], names[place_b] = 3 * a + shared_a, 3 * b + 2 * shared_b
        text = b"".join(map(self.names.__getitem__, names.tolist()))
        to_a, to_b = (np.searchsorted(ends, borders, side="right") for ends in (ends_a, ends_b))
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        groups = np.diff(np.cumsum(shared_b)[to_b - 1], prepend=0)
        text_ends = np.cumsum(self.name_widths[names])[place_b[to_b - 1]].tolist()
        header = 4 // self.size
        sizes = n_a + n_b + header
        to = np.cumsum(sizes)
        start = to - sizes
        words = np.empty(int(to[-1]), f"<u{self.size}")
        words[start] = n_a & 0xFFFF if header == 2 else n_a
        if header == 2:
            words[start + 1] = n_a >> 16
        words[np.arange(len(a)) + np.repeat(start + header - (to_a - n_a), n_a)] = a
        words[np.arange(len(b)) + np.repeat(to - to_b, n_b)] = b
        packed, to = words.tobytes(), (self.size * to).tolist()
        # every token end of either but the shared ones begins one more link
        return [
            ((packed[i:j],), x, y, text[k : m - 1], n, x + y - n)
            for i, j, k, m, x, y, n in zip(
                [0, *to], to, [0, *text_ends], text_ends, n_a.tolist(), n_b.tolist(), groups.tolist()
            )
        ]

    def _entry(self, data: bytes, a: list[int], b: list[int]) -> Entry:
        if (
            b"".join(map(self.a_bytes.__getitem__, a)) != data
            or b"".join(map(self.b_bytes.__getitem__, b)) != data
        ):
            return None
        windows = self.cut(data, a, b)
        texts, n_groups, n_links = zip(*(self.describe(*window) for window in windows))
        packed = tuple([self.pack(*window) for window in windows])
        return packed, len(a), len(b), ";".join(texts).encode(), sum(n_groups), sum(n_links)

    def describe(self, a: list[int], b: list[int]) -> tuple[str, int, int]:
        """The text of a window's groups, and the numbers of groups and links."""
        ends_a = accumulate(map(self.a_sizes.__getitem__, a))
        ends_b = accumulate(map(self.b_sizes.__getitem__, b))
        place = {end: n for n, end in enumerate(ends_a, 1)}
        groups, i, k = [], 0, 0
        for m, end in enumerate(ends_b, 1):
            if end in place:
                j = place[end]
                groups.append(",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m])))
                i, k = j, m
        # every token end of either but the shared ones begins one more link
        return ";".join(groups), len(groups), len(a) + len(b) - len(groups)

    def cut(self, data: bytes, a: list[int], b: list[int]) -> list[Window]:
        """The ids between anchors."""
        ends_a, ends_b = (list(accumulate([sizes[i] for i in ids])) for sizes, ids in ((self.a_sizes, a), (self.b_sizes, b)))
        place = {end: n for n, end in enumerate(ends_a, 1)}
        cuts = [
            (place[end], n) for n, end in enumerate(ends_b, 1) if end in place and end < len(data) and data[end] == _SPACE
        ]
        return [(a[i:j], b[k:m]) for (i, k), (j, m) in zip([(0, 0), *cuts], [*cuts, (len(a), len(b))])]

    def pack(self, a: Sequence[int], b: Sequence[int]) -> bytes:
        return struct.pack(f"<I{len(a) + len(b)}{self.code}", len(a), *a, *b)

    def unpack(self, packed: bytes) -> Window:
        count, *ids = struct.unpack(f"<I{(len(packed) - 4) // self.size}{self.code}", packed)
        return ids[:count], ids[count:]

    def links(self, packed: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows' pairs of tokens that overlap, in order: ids of A and B, and the window's place."""
        words = np.frombuffer(b"".join(packed.to_pylist()), f"<u{self.size}").astype(np.int64)
        sizes = pc.binary_length(packed).to_numpy() // self.size
        start = np.cumsum(sizes) - sizes
        header = 4 // self.size
        n_a = words[start] if header == 1 else words[start] | words[start + 1] << 16
        place = np.arange(len(words)) - np.repeat(start, sizes) - header
        in_a = place < np.repeat(n_a, sizes)
        a, b = words[(place >= 0) & in_a], words[(place >= 0) & ~in_a]
        # a window has as many bytes in both, so the ends go on from one window to the next
        ends_a, ends_b = np.cumsum(self.a_widths[a]), np.cumsum(self.b_widths[b])
        borders = ends_a[np.cumsum(n_a) - 1]
        in_a, in_b, last = (np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, bool) for _ in range(3))
        in_a[ends_a], in_b[ends_b], last[borders] = True, True, True
        ends = np.flatnonzero(in_a | in_b)  # each is the end of what one pair shares
        # how many tokens, and windows, end before
        a_at, b_at, place = (np.cumsum(at := ended[ends]) - at for ended in (in_a, in_b, last))
        return a[a_at], b[b_at], place


def _by_rank(tokenizer: dict, letters: dict[str, int]):
    """The same merges in tiktoken, which is faster; None if ids are not in the order of merges."""
    import public_tokenizers
    import tiktoken

    vocabulary, merges = tokenizer["model"].get("vocab", {}), tokenizer["model"].get("merges", [])
    made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    base = [vocabulary.get(letter) for letter in letters]
    if not _by_pattern(tokenizer) or sorted(b for b in base if b is not None) != list(range(256)):
        return None
    if [vocabulary.get(t) for t in made] != list(range(256, 256 + len(made))):
        return None
    ranks = {bytes(map(letters.__getitem__, t)): vocabulary[t] for t in (*letters, *made)}
    return tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _by_pattern(tokenizer: dict) -> bool:
    """Whether a tokenizer's file cuts texts by the byte-level pattern and changes nothing before."""
    before = tokenizer.get("pre_tokenizer") or {}
    return tokenizer.get("normalizer") is None and before.get("type") == "ByteLevel" and bool(before.get("use_regex"))


def _piece_bytes(piece: str) -> bytes:
    byte = _BYTE_PIECE(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


def pair(byte_level: str, pieces: str) -> Pair:
    """One per Python worker."""
    if (byte_level, pieces) not in _PAIRS:
        _PAIRS[byte_level, pieces] = Pair(byte_level, pieces)
    return _PAIRS[byte_level, pieces]


class _Chunk:
    """Texts, their distinct segments and the links of these, until there are enough for a batch."""

    def __init__(self, number: int, both: Pair):
        self.number, self.both = number, both
        self.known: dict[str, int] = {}  # the number of a segment here
        self.counts = np.zeros((4, 1 << 12), np.int64)  # A and B tokens, groups, links; no tokens if not given back
        self.texts: list[bytes] = []  # of their groups
        self.windows: list[bytes] = []
        self.owners = array("i")  # the segment of each window
        self.columns = {name: [] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        self.ends, self.places, self.times = array("i"), array("i"), array("i")
        self.size = 0

    def learn(self, segments: set[str]) -> None:
        """Number those that are new here."""
        new = list(segments.difference(self.known))
        if not new:
            return
        self.both.learn(new)
        first, entries = len(self.known), [self.both.known[s] for s in new]
        self.known.update(zip(new, range(first, first + len(new))))
        if first + len(new) > self.counts.shape[1]:
            more = np.zeros((4, 2 * (first + len(new))), np.int64)
            more[:, :first] = self.counts[:, :first]
            self.counts = more
        blank = ((), 0, 0, b"", 0, 0)
        windows, n_a, n_b, texts, groups, links = zip(*[e or blank for e in entries])
        self.counts[:, first : first + len(new)] = n_a, n_b, groups, links
        self.texts += texts
        if all(len(w) == 1 for w in windows):
            self.windows += [w for w, in windows]
            self.owners.extend(range(first, first + len(new)))
        else:
            self.windows += chain.from_iterable(windows)
            self.owners.extend(n for n, some in enumerate(windows, first) for _ in some)
        self.size += sum(map(len, texts)) + sum(map(len, new))

    def add(self, ids: list, cut: list[list[str]]) -> None:
        """Texts by their segments."""
        flat = list(chain.from_iterable(cut))
        self.learn(set(flat))
        codes = list(map(self.known.__getitem__, flat))
        ends = np.cumsum([0, *map(len, cut)])
        of = np.array(codes, np.int64)
        counts = np.zeros((4, len(of) + 1), np.int64)
        np.cumsum(self.counts[:, of], axis=1, out=counts[:, 1:])
        bad = np.concatenate(([0], np.cumsum(self.counts[0, of] == 0)))
        # a text that is not given back, in whichever segment, has no tokens
        whole = (bad[ends[1:]] == bad[ends[:-1]]) & (ends[1:] > ends[:-1])
        sums = (counts[:, ends[1:]] - counts[:, ends[:-1]]) * whole
        columns = self.columns
        for name, column in zip(("n_a", "n_b", "n_groups", "n_links"), sums):
            columns[name] += column.tolist()
        columns["doc_id"] += ids
        borders = ends.tolist()
        text = self.texts.__getitem__
        columns["groups_sha256"] += [
            hashlib.sha256(b";".join(map(text, codes[i:j]))).hexdigest() if good else ""
            for i, j, good in zip(borders, borders[1:], whole.tolist())
        ]
        row = np.repeat(np.arange(len(cut)), np.diff(ends))
        distinct, times = np.unique((row << 32 | of)[whole[row]], return_counts=True)
        self.ends.extend((len(self.places) + np.searchsorted(distinct >> 32, np.arange(1, len(cut) + 1))).tolist())
        self.places.frombytes((distinct & 0xFFFFFFFF).astype(np.int32).tobytes())
        self.times.frombytes(times.astype(np.int32).tobytes())
        self.size += 8 * len(times)

    @property
    def full(self) -> bool:
        return len(self.ends) >= CHUNK_TEXTS or len(self.known) >= CHUNK_SEGMENTS or self.size >= CHUNK_BYTES

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        """The links of the segments, in order, and how many each segment has."""
        links, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        of = np.array(self.owners, np.int64)
        for at in range(0, len(of), LINKED):
            a, b, place = self.both.links(pa.array(self.windows[at : at + LINKED], pa.binary()))
            links.append(a << 32 | b)
            owners.append(of[at + place])
        return np.concatenate(links), np.bincount(np.concatenate(owners), minlength=len(self.known))

    def batch(self) -> pa.RecordBatch:
        rows = len(self.ends)
        links, sizes = self.linked()
        distinct, held = np.unique(links, return_inverse=True)
        places, times = np.array(self.places, np.int32), np.array(self.times, np.int32)
        often = np.zeros(len(self.known), np.int64)
        np.add.at(often, places, times)
        numbers = np.zeros(len(distinct), np.int64)
        np.add.at(numbers, held, np.repeat(often, sizes))
        ends = pa.array(np.concatenate(([0], np.array(self.ends, np.int32))).astype(np.int32))

        def once(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
            """What is with the chunk's first text."""
            offsets = np.full(rows + 1, len(values), np.int32)
            offsets[0] = 0
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))

        columns = [
            pa.array(np.full(rows, self.number)),
            *(pa.array(self.columns[f.name], f.type) for f in list(_ARROW)[1:7]),
            *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in (places, times)),
            *(once(x, pa.int32()) for x in (sizes, held)),
            *(once(x, pa.int64()) for x in (distinct, numbers)),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _some(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Ids and texts, few enough to be encoded at once."""
    for batch in batches:
        rows = zip(batch["doc_id"].to_pylist(), (t.as_py() for t in batch["text"]))
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[1] or "")
            if len(held) == TEXTS or size >= CHARACTERS:
                yield held
                held, size = [], 0
        if held:
            yield held


def _tokenised(byte_level: str, pieces: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(byte_level, pieces)
        gc.disable()  # what is kept has no cycles, and there is much of it
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number, both)
        try:
            for rows in _some(batches):
                chunk.add([doc_id for doc_id, _ in rows], [both.segments(text) if text else [] for _, text in rows])
                if chunk.full:
                    yield chunk.batch()
                    number += 1
                    chunk = _Chunk(number, both)
                known = both.known
                for segment in [s for s in known if len(s) > LONG] if len(known) > MEMORY // 2 else ():
                    del known[segment]
            if chunk.ends:
                yield chunk.batch()
        finally:
            both.forget()  # the worker may outlive the stage
            gc.enable()

    return run


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of the values between each two of ``ends``."""
    running = np.concatenate(([0], np.cumsum(values)))
    return running[ends[1:]] - running[ends[:-1]]


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists, and where each begins and ends."""
    lists = column.combine_chunks()
    ends = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(), ends - ends[0]


def _summed(texts: pa.Table, sums: pa.Table) -> pa.Table:
    """The sums over each text's links, from those of the chunk's pairs of ids."""
    place = sums["place"].to_numpy()
    (sizes, _), (held, _), (times, _) = (_flat(texts[name]) for name in ("sizes", "held", "times"))
    places, ends = _flat(texts["places"])
    borders = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    total = {}
    for name in ("n_best", "count_sum"):
        of = np.zeros(int(place.max(initial=-1)) + 1, np.int64)
        of[place] = sums[name].to_numpy()
        total[name] = _sums(_sums(of[held], borders)[places] * times, ends)
    kept = {c: texts[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**kept, **total, "groups_sha256": texts["groups_sha256"]})


def _joined(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join with ``table``, whose column ``held`` has the number of ``rows`` of a key.

    The numbers add up to ``total``, so at most ``SHARE`` keys are sent to all tasks.
    """
    is_hot = F.col("held") * SHARE >= total
    hot = F.broadcast(table.filter(is_hot).drop("held"))
    rest = table.filter(~is_hot).drop("held")
    cold = rows.join(F.broadcast(table.filter(is_hot).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(rest, key))


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``.

    ``byte_level``: a byte-level ``.json`` of tokenizers; ``pieces``: a ``.model`` of
    sentencepiece that puts a space in front. Every executor has both files.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    stored = scratch.store

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(F.is_valid_utf8("text"), F.col("text")).alias("text")
    )
    texts = stored(rows.mapInArrow(_tokenised(byte_level, pieces), _TEXTS), "texts")
    held = texts.select("chunk", F.posexplode(F.arrays_zip("links", "numbers")).alias("place", "w")).select(
        "chunk", "place", F.col("w.links").alias("link"), F.col("w.numbers").alias("number")
    )
    counts = held.groupBy("link").agg(F.sum("number").alias("count"), F.count("*").alias("held"))
    # a token of B has at most as many pairs as A has tokens
    best = F.col("count") == F.max("count").over(Over.partitionBy("b"))
    counts = counts.withColumn("b", F.col("link").bitwiseAND(0xFFFFFFFF)).select(
        "link", best.cast("long").alias("n_best"), F.col("count").alias("count_sum"), "held"
    )
    counts = stored(counts, "counts")
    n_held = counts.agg(F.sum("held")).first()[0] or 0
    sums = _joined(held.select("chunk", "place", "link"), counts, "link", n_held)
    left = spark.read.schema(_TEXTS).parquet(f"{scratch.path}/texts").drop("links", "numbers")
    return (
        left.groupBy("chunk")
        .cogroup(sums.select("chunk", "place", "n_best", "count_sum").groupBy("chunk"))
        .applyInArrow(_summed, _RESULT)
    )
