"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is an embedding of the word joined with the largest value, by dimension,
among embeddings of its character n-grams (both by hash bucket). The network reads a
window of ``WINDOW`` words in both directions, weighs the states by attention and gives
the window a logit. Windows overlap by half and cover the text, its last words included.
A document's score is that of its worst window, calibrated on the training documents.
A run of more than ``LONG`` word characters (texts without spaces, words joined by
underscores) is read whole, as half-overlapping pieces of ``PIECE`` that each count as a word.

Training knows the documents' labels only. It takes at most ``rows`` documents of each
label, and fewer once these hold ``total`` characters, each of them whole. All weights, embeddings
included, start at random and are learned by gradients alone: a fourth of a step's windows are
drawn from toxic documents, evenly by document, the others from the clean ones, and some words
are blanked out; every other step knows words by their n-grams only, as it will be with unseen ones, and a fourth of the documents is read
a second time as one run without spaces. Most windows of a toxic document are harmless; what they share with clean
ones cancels out, and what is left is what makes documents toxic. Embeddings are stepped by one scale for the
whole table, not by entry, so that a word seen once is not learned by heart. Scores are calibrated on
a fourth of the documents, by a network that has not seen them.

In a task, the inputs of up to ``MEMORY`` words are kept, already multiplied with the
network's input weights.

Defined cases: damaged UTF-8 is read with replacement characters. Null text, empty text and text without words score as the least toxic
training document does. Without labelled documents of both labels every score is the share of toxic ones, or 0.
Rows without an id are scored, held out and not learned from. Repeated rows are scored
each. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measure_rollup.llm.samples import held_out, sample, within

WINDOW = 24
STRIDE = WINDOW // 2
LONG, PIECE = 64, 16  # characters: of the longest run that is one word; of the pieces of a longer one
WORDS, GRAMS = 1 << 16, 1 << 17  # hash buckets
WORD_DIM, GRAM_DIM, HIDDEN = 6, 10, 8
INPUT = WORD_DIM + GRAM_DIM
GATES = 3 * HIDDEN
ROWS = 1_000
TOTAL = 20_000_000  # characters of a label's documents to learn from
STEPS, BATCH = 400, 128  # windows a step, a fourth of them from toxic documents
RATE, EMBEDDING_RATE = 0.02, 0.5  # of a weight; of a whole table of embeddings
BLANK = 0.1  # of the words, in training
DECAY = 1e-3  # of the embeddings a step uses
SEEN = 0.98  # of the past, in the mean of squared gradients
MEMORY = 150_000
CHUNK = 150_000  # words scored at once

_words = re.compile(r"\w+").findall

Weights = dict[str, np.ndarray]


class Network(NamedTuple):
    weights: Weights
    scale: float
    shift: float
    floor: float  # logit of a text without words: the least of the training documents


def words_of(text: str) -> list[str]:
    found = _words(text.lower())
    if max(map(len, found), default=0) <= LONG:
        return found
    return [piece for word in found for piece in pieces(word)]


def pieces(word: str) -> list[str]:
    """A run of more than ``LONG`` characters as half-overlapping pieces; the last one ends with the run."""
    if len(word) <= LONG:
        return [word]
    starts = [*range(0, len(word) - PIECE, PIECE // 2), len(word) - PIECE]
    return [word[start : start + PIECE] for start in starts]


def gram_buckets(word: str) -> list[int]:
    """Buckets of the word's character n-grams of three and four, its borders included."""
    marked = f"<{word}>"
    found = [marked[i : i + n] for n in (3, 4) for i in range(len(marked) - n + 1)] or [marked]
    return [zlib.crc32(gram.encode("utf-8", "replace")) % GRAMS for gram in found]


def word_bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % WORDS


class Vocabulary(NamedTuple):
    """Buckets of distinct words: of the word, and of its n-grams one word after the other."""

    words: np.ndarray
    grams: np.ndarray
    starts: np.ndarray


def vocabulary(words: Iterable[str]) -> Vocabulary:
    buckets, grams, starts = [], [], []
    for word in words:
        buckets.append(word_bucket(word))
        starts.append(len(grams))
        grams += gram_buckets(word)
    return Vocabulary(np.array(buckets, int), np.array(grams, int), np.array(starts, int))


def inputs(known: Vocabulary, weights: Weights) -> np.ndarray:
    if not len(known.words):
        return np.zeros((0, INPUT), np.float32)
    chars = np.maximum.reduceat(weights["grams"][known.grams], known.starts, axis=0)
    return np.concatenate((weights["words"][known.words], chars), axis=1)


def window_starts(n: int) -> list[int]:
    """Windows of a text of ``n`` words: half-overlapping; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    starts = list(range(0, n - WINDOW + 1, STRIDE))
    return starts if starts[-1] == n - WINDOW else [*starts, n - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    """In place; by exp, which numpy has in vector form for 32-bit floats."""
    x *= 2
    _sigmoid(x)
    x *= 2
    x -= 1
    return x


def _read(projected: np.ndarray, ids: np.ndarray, mask: np.ndarray | None, recur: np.ndarray, tape: list | None):
    """States after each column of ``ids``; ``projected``: the words' inputs to the gates."""
    n, width = ids.shape
    states = np.empty((width, n, HIDDEN), np.float32)
    state = np.zeros((n, HIDDEN), np.float32)
    for t in range(width):
        gates = projected[ids[:, t]]
        past = state @ recur
        gates[:, : 2 * HIDDEN] += past[:, : 2 * HIDDEN]
        both = _sigmoid(np.ascontiguousarray(gates[:, : 2 * HIDDEN]))
        keep, reset = both[:, :HIDDEN], both[:, HIDDEN:]
        new = _tanh(gates[:, 2 * HIDDEN :] + reset * past[:, 2 * HIDDEN :])
        following = new + keep * (state - new)
        if mask is not None:
            following = np.where(mask[:, t, None], following, state)
        if tape is not None:
            tape.append((state, keep, reset, new, past[:, 2 * HIDDEN :]))
        state = states[t] = following
    return states


def _pool(states: np.ndarray, mask: np.ndarray | None, weights: Weights):
    """Logits by attention over states (word, window, direction's hidden)."""
    focus = states @ weights["focus"]
    if mask is not None:
        focus = np.where(mask.T, focus, -1e9)
    focus = np.exp(focus - focus.max(axis=0))
    focus /= focus.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", focus, states)
    return pooled @ weights["out"] + weights["bias"], focus, pooled


def logits(ids: np.ndarray, mask: np.ndarray | None, forward: np.ndarray, backward: np.ndarray, weights: Weights):
    ahead = _read(forward, ids, mask, weights["recur_f"], None)
    back = _read(backward, ids[:, ::-1], None if mask is None else mask[:, ::-1], weights["recur_b"], None)
    return _pool(np.concatenate((ahead, back[::-1]), axis=2), mask, weights)[0]


def projections(known: Vocabulary, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    x = inputs(known, weights)
    return x @ weights["in_f"] + weights["gate_f"], x @ weights["in_b"] + weights["gate_b"]


def _back(d_states, tape, mask, recur):
    """Gradients of the gates' inputs by column, and of the recurrent weights."""
    d_recur = np.zeros_like(recur)
    d_gates = []
    d_next = np.zeros_like(d_states[0])
    for t in range(len(tape) - 1, -1, -1):
        state, keep, reset, new, past = tape[t]
        d = d_states[t] + d_next
        on = d if mask is None else np.where(mask[:, t, None], d, 0)
        d_new = on * (1 - keep) * (1 - new * new)
        d_keep = on * (state - new) * keep * (1 - keep)
        d_reset = d_new * past * reset * (1 - reset)
        d_past = np.concatenate((d_keep, d_reset, d_new * reset), axis=1)
        d_recur += state.T @ d_past
        d_next = on * keep + d_past @ recur.T + (d - on)
        d_gates.append(np.concatenate((d_keep, d_reset, d_new), axis=1))
    return d_gates[::-1], d_recur


def gradients(ids, mask, labels, share, known: Vocabulary, weights: Weights) -> tuple[Weights, float]:
    """Of the weighted mean log loss of windows; ``ids`` index ``known``."""
    used, local = np.unique(ids, return_inverse=True)
    local = local.reshape(ids.shape)
    counts = np.diff(np.append(known.starts, len(known.grams)))[used]
    grams = np.concatenate([known.grams[known.starts[i] : known.starts[i] + c] for i, c in zip(used, counts)])
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    part = Vocabulary(known.words[used], grams, starts)
    x = inputs(part, weights)
    tapes: tuple[list, list] = ([], [])
    reverse = None if mask is None else mask[:, ::-1]
    ahead = _read(x @ weights["in_f"] + weights["gate_f"], local, mask, weights["recur_f"], tapes[0])
    back = _read(x @ weights["in_b"] + weights["gate_b"], local[:, ::-1], reverse, weights["recur_b"], tapes[1])
    states = np.concatenate((ahead, back[::-1]), axis=2)
    logit, focus, pooled = _pool(states, mask, weights)
    p = _sigmoid(logit.copy())
    loss = float(-(share * (labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7))).mean())
    d = (share * (p - labels) / len(labels)).astype(np.float32)

    out: Weights = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
    d_pooled = d[:, None] * weights["out"]
    d_focus = np.einsum("nh,tnh->tn", d_pooled, states)
    d_focus = focus * (d_focus - (focus * d_focus).sum(axis=0))
    out["focus"] = np.einsum("tn,tnh->h", d_focus, states)
    d_states = focus[:, :, None] * d_pooled + d_focus[:, :, None] * weights["focus"]
    gates_f, out["recur_f"] = _back(d_states[:, :, :HIDDEN], tapes[0], mask, weights["recur_f"])
    gates_b, out["recur_b"] = _back(d_states[::-1, :, HIDDEN:], tapes[1], reverse, weights["recur_b"])
    d_x = np.zeros_like(x)
    for name, gates in (("f", np.stack(gates_f, 1)), ("b", np.stack(gates_b, 1)[:, ::-1])):
        flat = gates.reshape(-1, GATES)
        by_word = np.zeros((len(used), GATES), np.float32)
        np.add.at(by_word, local.ravel(), flat)
        out[f"in_{name}"], out[f"gate_{name}"] = x.T @ by_word, flat.sum(axis=0)
        d_x += by_word @ weights[f"in_{name}"].T
    out["words"] = (part.words, d_x[:, :WORD_DIM])
    # the largest n-gram of each dimension gets its gradient
    values = weights["grams"][grams]
    owner = np.repeat(np.arange(len(used)), counts)
    largest = values == x[owner, WORD_DIM:]
    out["grams"] = (grams, np.where(largest, d_x[owner, WORD_DIM:], 0))
    return out, loss


def initial(rng) -> Weights:
    """Small random weights."""
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    weights = {
        "words": normal(WORDS, WORD_DIM, scale=0.02),
        "grams": normal(GRAMS, GRAM_DIM, scale=0.02),
        "focus": normal(2 * HIDDEN, scale=0.3),
        "out": normal(2 * HIDDEN, scale=0.3),
        "bias": np.zeros(1, np.float32),
    }
    for name in "fb":
        weights[f"in_{name}"] = normal(INPUT, GATES, scale=0.3)
        weights[f"recur_{name}"] = normal(HIDDEN, GATES, scale=0.3)
        weights[f"gate_{name}"] = np.zeros(GATES, np.float32)
    return weights


def _windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all windows, their lengths, and the text each belongs to."""
    rows, lengths, owners = [], [], []
    for k, ids in enumerate(texts):
        for start in window_starts(len(ids)):
            part = ids[start : start + WINDOW]
            rows.append(np.pad(part, (0, WINDOW - len(part))))
            lengths.append(len(part))
            owners.append(k)
    return np.array(rows).reshape(-1, WINDOW), np.array(lengths, int), np.array(owners, int)


def _mask(lengths: np.ndarray) -> np.ndarray | None:
    if (lengths == WINDOW).all():
        return None
    return np.arange(WINDOW) < np.maximum(lengths, 1)[:, None]


def train(texts: list[str], labels: np.ndarray, toxic: float | None = None, seed: int = 0) -> Network:
    """``toxic``: the share of toxic documents that scores are calibrated for; by default that of ``labels``."""
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.0
        zero = initial(np.random.default_rng(seed))
        return Network(zero, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))), 0.0)
    n = len(labels)
    turn = np.zeros(n, int)
    for label in (0, 1):
        turn[labels == label] = np.arange((labels == label).sum()) % 4
    aside = turn == 3
    # a fourth is read without spaces too, since some texts have none
    read = [words_of(t) for t in texts]
    joined = np.flatnonzero(turn == 1)
    read += [words_of("_".join(read[k])) for k in joined]
    labels = np.concatenate((labels, labels[joined]))
    index: dict[str, int] = {"": 0}
    coded = [np.array([index.setdefault(w, len(index)) for w in words], int) for words in read]
    known = vocabulary(index)
    windows = _windows(coded)
    weights = _fitted(windows, labels, np.ones(len(coded), bool), known, seed)
    top = _tops(windows, len(coded), known, weights)[:n]
    judged, told = top, labels[:n]
    if len(np.unique(told[aside])) == 2:  # else too few for a part of their own
        others = np.append(~aside, np.ones(len(joined), bool))
        judged = _tops(windows, len(coded), known, _fitted(windows, labels, others, known, seed))[:n][aside]
        told = told[aside]
    scale, shift = _calibrate(judged, told, toxic or float(labels[:n].mean()))
    return Network(weights, scale, shift, float(top.min()))


def _fitted(windows, labels: np.ndarray, used: np.ndarray, known: Vocabulary, seed: int) -> Weights:
    """Weights learned from the windows of the ``used`` documents."""
    ids, lengths, owners = windows
    rng = np.random.default_rng(seed)
    weights = initial(rng)
    of_label = labels[owners]
    usable = (lengths > 0) & used[owners]
    clean = np.flatnonzero(usable & (of_label == 0))
    toxic = np.unique(owners[usable & (of_label == 1)])
    if not len(clean) or not len(toxic):
        return weights
    first, number = np.searchsorted(owners, toxic), np.bincount(owners)[toxic]
    past: dict[str, float | np.ndarray] = {}
    for step in range(STEPS):
        pick = rng.integers(len(toxic), size=BATCH // 4)
        rows = first[pick] + (rng.random(len(pick)) * number[pick]).astype(int)
        rows = np.concatenate((rows, rng.choice(clean, BATCH - len(rows))))
        batch = np.where(rng.random((BATCH, WINDOW)) < BLANK, 0, ids[rows])
        share = np.where(of_label[rows] == 1, 2.0, 2 / 3).astype(np.float32)
        # every other step reads words as if they were unseen, by their characters alone
        read = known._replace(words=rng.integers(WORDS, size=len(known.words))) if step % 2 else known
        found = gradients(batch, _mask(lengths[rows]), of_label[rows], share, read, weights)[0]
        if step % 2:
            del found["words"]
        _step(weights, found, past, step + 1, RATE * (1 - step / STEPS))
    return weights


def _tops(windows, n: int, known: Vocabulary, weights: Weights) -> np.ndarray:
    """Largest logit of each text's windows."""
    ids, lengths, owners = windows
    top = np.full(n, -np.inf)
    np.maximum.at(top, owners, _all_logits(ids, lengths, known, weights))
    return top


def _step(weights: Weights, found, past: dict[str, float | np.ndarray], step: int, rate: float) -> None:
    """Gradients over the root of their mean square: of each weight, and of a table of embeddings as a whole."""
    for name, g in found.items():
        if isinstance(g, tuple):
            rows, inverse = np.unique(g[0], return_inverse=True)
            total = np.zeros((len(rows), g[1].shape[1]), np.float32)
            np.add.at(total, inverse, g[1])
            past[name] = SEEN * past.get(name, 0.0) + (1 - SEEN) * float((total * total).sum())
            size = np.sqrt(past[name] / (1 - SEEN**step)) + 1e-12
            rise = EMBEDDING_RATE * rate / RATE
            weights[name][rows] = (1 - DECAY) * (weights[name][rows] - rise * total / size)
        else:
            past[name] = SEEN * past.get(name, 0.0) + (1 - SEEN) * g * g
            weights[name] -= (rate * g / (np.sqrt(past[name] / (1 - SEEN**step)) + 1e-6)).astype(np.float32)


def _all_logits(ids, lengths, known: Vocabulary, weights: Weights) -> np.ndarray:
    forward, backward = projections(known, weights)
    out = np.empty(len(ids), np.float32)
    for full in (True, False):
        rows = np.flatnonzero((lengths == WINDOW) == full)
        for at in range(0, len(rows), 8192):
            pick = rows[at : at + 8192]
            out[pick] = logits(ids[pick], None if full else _mask(lengths[pick]), forward, backward, weights)
    return out


def _calibrate(top: np.ndarray, labels: np.ndarray, toxic: float) -> tuple[float, float]:
    """Logistic regression on documents' largest logits, as if the share ``toxic`` were toxic."""
    weight = np.where(labels == 1, toxic / labels.mean(), (1 - toxic) / (1 - labels.mean()))
    centre, spread = float(top.mean()), float(top.std()) + 1e-3
    x = (top - centre) / spread
    scale, shift = 1.0, 0.0
    for _ in range(1000):
        p = 1 / (1 + np.exp(-np.clip(scale * x + shift, -60, 60)))
        error = weight * (labels - p)
        scale += 1.0 * float((error * x).mean() - 1e-4 * scale)
        shift += 1.0 * float(error.mean())
    scale = max(scale, 1e-3) / spread
    return scale, shift - scale * centre


class Scorer:
    """Scores texts; keeps the projected inputs of up to ``memory`` words."""

    def __init__(self, network: Network, memory: int = MEMORY):
        self.network, self.memory = network, memory
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.forward, self.backward = (
            np.empty((0, GATES), np.float32),
            np.empty((0, GATES), np.float32),
        )
        self._project([""])

    def _project(self, words: list[str]) -> None:
        f, b = projections(vocabulary(words), self.network.weights)
        n = len(self.index)
        if n > len(self.forward):  # room is doubled, so that adding stays cheap
            room = max(n, 2 * len(self.forward))
            self.forward, self.backward = (
                np.concatenate((old, np.empty((room - len(old), GATES), np.float32)))
                for old in (self.forward, self.backward)
            )
        self.forward[n - len(words) : n], self.backward[n - len(words) : n] = f, b

    def _ids(self, words: list[str]) -> np.ndarray:
        index = self.index
        missing = list(dict.fromkeys(w for w in words if w not in index))
        for word in missing:
            index[word] = len(index)
        if missing:
            self._project(missing)
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def scores(self, texts: Iterable[str]) -> Iterator[float]:
        """A text at a time is split; windows of many texts are read at once."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            words = words_of(text)
            if group and size + len(words) > CHUNK:
                yield from self._group(group)
                group, size = [], 0
            group.append(words)
            size += len(words)
        if group:
            yield from self._group(group)

    def _group(self, group: list[list[str]]) -> list[float]:
        if len(self.index) > self.memory:
            self._forget()
        flat = [w for words in group for w in words]
        coded = self._ids(flat) if flat else np.zeros(0, np.int64)
        ends = np.cumsum([len(words) for words in group])
        full, full_owner, short, short_owner = [], [], [], []
        for k, end in enumerate(ends):
            n = len(group[k])
            starts = np.array(window_starts(n)) + end - n
            if n >= WINDOW:
                full.append(starts)
                full_owner.append(np.full(len(starts), k))
            elif n:
                short.append(np.pad(coded[end - n : end], (0, WINDOW - n)))
                short_owner.append(k)
        top = np.full(len(group), -np.inf, np.float32)
        top[[not words for words in group]] = self.network.floor
        weights = self.network.weights
        if full:
            at, owner = np.concatenate(full), np.concatenate(full_owner)
            for i in range(0, len(at), 8192):
                ids = coded[at[i : i + 8192, None] + np.arange(WINDOW)]
                np.maximum.at(top, owner[i : i + 8192], logits(ids, None, self.forward, self.backward, weights))
        if short:
            sizes = np.array([len(group[k]) for k in short_owner])
            mask = np.arange(WINDOW) < sizes[:, None]
            top[short_owner] = logits(np.array(short), mask, self.forward, self.backward, weights)
        raw = np.clip(self.network.scale * top.astype(float) + self.network.shift, -60, 60)
        return (1 / (1 + np.exp(-raw))).tolist()


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS, total: int = TOTAL) -> Network:
    """A network from a sample of the documents that are not held out."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)")
    known = known.filter(~held_out(F.col("doc_id"), 3, 1))
    present = docs.filter("text is not null").select("doc_id")
    chosen = F.broadcast(sample(known.join(present, "doc_id", "left_semi"), "label", rows))
    texts = docs.select("doc_id", F.make_valid_utf8("text").alias("text")).filter("text is not null")
    found = (
        within(texts.join(chosen, "doc_id").withColumn("size", F.length("text")), "label", "size", total)
        .select("doc_id", "label", "text")
        .toPandas()  # at most rows texts of each label, of about total characters together
        .sort_values(["doc_id", "label", "text"])
    )
    toxic = known.agg(F.avg("label")).first()[0]
    return train(found["text"].tolist(), found["label"].to_numpy(), toxic)


def score_toxicity(docs: DataFrame, network: Network, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold``) per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size, a few MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            scores = np.fromiter(scorer.scores(t.as_py() for t in batch["text"]), float)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(scores),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        F.make_valid_utf8(F.coalesce("text", F.lit(""))).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out; score all."""
    return score_toxicity(docs, learn(docs, labels))
