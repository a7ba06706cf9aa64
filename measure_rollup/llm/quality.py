"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is labelled good or bad. A line's score for either label comes from its own
features and those of the lines before and after it; a transition score ties its label
to that of the line before. Forward and backward sums give each line's marginal
probability of being good. A document's quality is the mean of its lines' marginals,
weighted by their length, and calibrated on the training documents.

The field is trained in numpy, by gradient ascent on the likelihood of line labels, from
at most ``rows`` documents of each label, and of fewer once these hold ``total`` bytes; their
lines take the document's label. Documents are learned from and scored whole. Only
features of training lines, never their texts, come to the driver.

Features are computed on the UTF-8 bytes of many documents at once, about ``CHUNK`` bytes
or one document at a time.

Defined cases: texts are read as bytes, damaged UTF-8 too. Null and empty texts have one empty line. Without labelled documents of
both labels every score is the share of good ones, or 0.5 without any. Rows without an
id are scored, held out and not learned from. Repeated rows are scored each; repeated
labels are used as often as they come. Empty tables give empty results. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measure_rollup.llm.samples import held_out, sample, within

ROWS = 1_500
TOTAL = 10_000_000  # bytes of a label's documents to learn from
CHUNK = 1 << 20
STEPS = 300
OWN = 14  # features of a line

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CLASSES = {
    "symbols": b"#$%&*@^~<>{}[]=+\\/_`",
    "bars": b"|",
    "digits": b"0123456789",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "stops": b".,;:",
    "shouts": b"!?",
}
_MEMBER = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()}
_MEMBER["other"] = np.arange(256) >= 128


class Field(NamedTuple):
    node: np.ndarray  # weights of a line's features, good minus bad
    same: float  # score of a line having the label of the line before
    scale: float  # of the calibration
    shift: float


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[ends] - total[starts]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes, and each text's number of lines."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - starts
    last = np.cumsum([len(text) + 1 for text in texts]) - 1
    per_text = np.diff(np.concatenate(([0], np.searchsorted(ends, last) + 1)))

    space = _SPACE[data]
    begins = ~space & np.concatenate(([True], space[:-1]))
    word_start = np.flatnonzero(begins)
    words = _sums(begins, starts, ends)
    share = np.maximum(lengths, 1)
    parts = {name: _sums(member[data], starts, ends) / share for name, member in _MEMBER.items()}
    repeats = np.zeros(len(data), dtype=np.int64)
    if len(word_start):
        # a word's hash: its bytes times powers by place; equal words have equal hashes
        place = np.arange(len(data)) - np.maximum.accumulate(np.where(begins, np.arange(len(data)), 0))
        weight = np.where(space, 0, data).astype(np.uint64) * _POWERS[place % len(_POWERS)]
        hashes = np.add.reduceat(weight, word_start)
        again = hashes[1:] == hashes[:-1]
        repeats[word_start[1:]] = again
    repeated = _sums(repeats, starts, ends) / np.maximum(words, 1)
    size = np.log1p(lengths)
    letters = np.maximum(parts["upper"] + parts["lower"] + parts["other"], 1e-3)
    features = np.stack(
        [
            np.ones(len(lengths)),
            size / 5,
            (lengths == 0).astype(float),
            np.minimum(lengths / np.maximum(words, 1), 40) / 10,
            _root(parts["symbols"]),
            _root(parts["bars"]),
            _root(parts["digits"]),
            parts["upper"] / letters,
            _root(parts["shouts"]),
            _root(parts["stops"]),
            _root(repeated),
            (repeated > 0.25).astype(float),
            parts["lower"],
            parts["other"],
        ],
        axis=1,
    )
    return features, lengths, per_text


_POWERS = np.random.default_rng(8).integers(1, 1 << 62, 64, dtype=np.uint64) | np.uint64(1)


def _root(values: np.ndarray) -> np.ndarray:
    """Small shares are told apart better than large ones."""
    return np.sqrt(np.minimum(values, 1))


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Own features, and those of the lines before and after; zeros beyond a text's ends."""
    before = np.concatenate((np.zeros((1, features.shape[1])), features[:-1])) if len(features) else features
    after = np.concatenate((features[1:], np.zeros((1, features.shape[1])))) if len(features) else features
    last = np.cumsum(per_text)
    before[np.concatenate(([0], last[:-1]))] = 0
    after[last - 1] = 0
    return np.concatenate((features, before, after), axis=1)


def _padded(values: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts by lines, and which places are lines."""
    width = int(per_text.max())
    mask = np.arange(width) < per_text[:, None]
    out = np.zeros((len(per_text), width))
    out[mask] = values
    return out, mask


def forward_backward(scores: np.ndarray, mask: np.ndarray, same: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For good-minus-bad ``scores`` of texts by lines: log odds of good, log partition, and
    the probability that a line has the label of the line before.

    Works on log odds: with two labels and one transition score a message is one number.
    """

    def message(odds: np.ndarray) -> np.ndarray:
        return np.logaddexp(odds + same, 0) - np.logaddexp(odds, same)

    texts, width = scores.shape
    left, right = np.zeros_like(scores), np.zeros_like(scores)
    partition = np.logaddexp(scores[:, 0], 0)
    left[:, 0] = scores[:, 0]
    for j in range(1, width):
        came = left[:, j - 1]
        on = mask[:, j]
        left[:, j] = np.where(on, scores[:, j] + message(came), 0)
        # log of the sum over both labels, given the sums before
        good, bad = np.logaddexp(came + same, 0), np.logaddexp(came, same)
        step = np.logaddexp(good + scores[:, j], bad) - np.logaddexp(came, 0)
        partition += np.where(on, step, 0)
    for j in range(width - 2, -1, -1):
        right[:, j] = np.where(mask[:, j + 1], message(right[:, j + 1] + scores[:, j + 1]), 0)
    odds = left + right
    pair = np.zeros_like(scores)
    if width > 1:
        a, b = left[:, :-1], right[:, 1:] + scores[:, 1:]
        equal = np.logaddexp(a + b, 0) + same
        differ = np.logaddexp(a, b)
        pair[:, 1:] = np.where(mask[:, 1:], 1 / (1 + np.exp(np.clip(differ - equal, -700, 700))), 0)
    return odds, partition, pair


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def qualities(features: np.ndarray, lengths: np.ndarray, per_text: np.ndarray, field: Field) -> np.ndarray:
    """Length-weighted mean marginal of each text, before calibration.

    Texts are taken in groups of similar numbers of lines, so that padding at most doubles them.
    """
    scores = with_neighbours(features, per_text) @ field.node
    out = np.empty(len(per_text))
    ends = np.cumsum(per_text)
    group = np.ceil(np.log2(per_text)).astype(int)
    for g in np.unique(group):
        chosen = np.flatnonzero(group == g)
        lines = np.concatenate([np.arange(ends[i] - per_text[i], ends[i]) for i in chosen])
        padded, mask = _padded(scores[lines], per_text[chosen])
        odds, _, _ = forward_backward(padded, mask, field.same)
        weight, _ = _padded(lengths[lines] + 1.0, per_text[chosen])
        out[chosen] = (_sigmoid(odds) * weight).sum(axis=1) / weight.sum(axis=1)
    return out


def train(
    features: np.ndarray, lengths: np.ndarray, per_text: np.ndarray, labels: np.ndarray, steps: int = STEPS
) -> Field:
    """Adam on the mean log likelihood of the lines, each document counting the same."""
    good = float(labels.mean()) if len(labels) else 0.5
    base = float(np.log((good + 1e-6) / (1 - good + 1e-6)))
    if not len(labels) or not 0 < good < 1:
        return Field(np.zeros(3 * OWN), 0.0, 0.0, base)
    inputs = with_neighbours(features, per_text)
    rng = np.random.default_rng(0)
    ends = np.cumsum(per_text)
    share = np.where(labels == 1, 0.5 / good, 0.5 / (1 - good))  # both labels weigh the same
    parameters = np.zeros(3 * OWN + 1)
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    order = np.argsort(per_text, kind="stable")
    batches = np.array_split(order, max(1, len(order) // 64))
    for step in range(1, steps + 1):
        chosen = batches[rng.integers(len(batches))]
        lines = np.concatenate([np.arange(ends[i] - per_text[i], ends[i]) for i in chosen])
        padded, mask = _padded(inputs[lines] @ parameters[:-1], per_text[chosen])
        odds, _, pair = forward_backward(padded, mask, parameters[-1])
        weight = (share[chosen] / per_text[chosen])[:, None]
        error = np.where(mask, labels[chosen][:, None] - _sigmoid(odds), 0) * weight
        gradient = np.append(inputs[lines].T @ error[mask], ((mask[:, 1:] - pair[:, 1:]) * weight).sum())
        gradient = gradient / len(chosen) - 1e-4 * parameters
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        parameters += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    field = Field(parameters[:-1], float(parameters[-1]), 1.0, 0.0)
    raw = _logit(qualities(features, lengths, per_text, field))
    scale, shift = 1.0, 0.0
    for _ in range(500):  # logistic calibration, in the proportions of the training documents
        error = labels - _sigmoid(scale * raw + shift)
        scale += 0.3 * float((error * raw).mean() - 1e-4 * scale)
        shift += 0.3 * float(error.mean())
    return field._replace(scale=max(scale, 1e-3), shift=shift)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def chunks(texts: Iterable[bytes], size: int = CHUNK) -> Iterator[list[bytes]]:
    found, total = [], 0
    for text in texts:
        if found and total + len(text) > size:
            yield found
            found, total = [], 0
        found.append(text)
        total += len(text) + 1
    if found:
        yield found


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS, total: int = TOTAL) -> Field:
    """A field from a sample of the documents that are not held out."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)")
    chosen = F.broadcast(sample(known.filter(~held_out(F.col("doc_id"), 5, 0)), "label", rows))

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, label, text in zip(
                batch["doc_id"].to_pylist(), batch["label"].to_pylist(), batch["text"].to_pylist()
            ):
                features, lengths, _ = line_features([text])
                part = np.column_stack((features, lengths)).astype(np.float32)
                out.append((doc_id, label, part.tobytes()))
            columns = zip(*out) if out else [()] * 3
            types = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "label", "lines"]
            )

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = (
        within(texts.join(chosen, "doc_id").withColumn("size", F.octet_length("text")), "label", "size", total)
        .select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
        .mapInArrow(describe, "doc_id long, label int, lines binary")
        .toPandas()  # at most rows documents of each label, of about total bytes together
        .sort_values(["doc_id", "label", "lines"])
    )
    parts = [np.frombuffer(x, np.float32).reshape(-1, OWN + 1) for x in found["lines"]]
    if not parts:
        return train(np.zeros((0, OWN)), np.zeros(0), np.zeros(0, int), np.zeros(0))
    whole = np.concatenate(parts).astype(float)
    per_text = np.array([len(p) for p in parts])
    return train(whole[:, :OWN], whole[:, OWN], per_text, found["label"].to_numpy(dtype=float))


def score(texts: Iterable[bytes], field: Field) -> Iterator[np.ndarray]:
    for part in chunks(texts):
        raw = _logit(qualities(*line_features(part), field))
        yield _sigmoid(field.scale * raw + field.shift)


def score_quality(docs: DataFrame, field: Field, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold``) per row of ``docs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (text.as_py() for text in batch["text"])
            scores = np.concatenate([*score(texts, field), np.zeros(0)])
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
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out; score all."""
    return score_quality(docs, learn(docs, labels))
