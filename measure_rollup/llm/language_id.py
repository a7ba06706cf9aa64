"""Language identification by rank-order profiles.

A profile is a text's ``size`` most frequent n-grams of one to three letters, by rank.
Letters are lowered; whatever stands between two words counts as one space. A
document's distance to a language is the sum over its profile of how far each n-gram is
out of place in the language's profile; an n-gram that the language lacks counts
``size``. The language at the least distance is predicted; of equal ones, the first by
name.

Profiles are learned from at most ``per_language`` documents of each language, whose
n-grams Spark counts; they are ``size`` rows a language. Every document is compared
whole.

Defined cases: text that is null or has no letter gives ``und`` and score 0, as does
every text if no language was learned. Rows without an id are compared and not learned
from; repeated rows are compared each. Rows with a null language are not learned from.
Equally frequent n-grams rank by their code points. Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from measure_rollup.llm.batches import few_rows
from measure_rollup.llm.samples import held_out, sample

SIZE = 400
PER_LANGUAGE = 1_000
SHARPNESS = 60.0  # of the score: weights are exp(-SHARPNESS * distance / largest distance)
UNKNOWN = "und"
_BITS = 21  # of a code point


class Profiles(NamedTuple):
    languages: list[str]
    grams: np.ndarray  # all profiles' n-grams, sorted
    ranks: np.ndarray  # by n-gram and language; -1 where the language lacks it
    size: int


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


_LETTERS: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points of the lowered letters, with one 0 before, after and between words."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    is_letter = _LETTERS[0][points]
    if not is_letter.any():
        return np.zeros(0, dtype=np.int64)
    points = np.where(is_letter, points, 0).astype(np.int64)
    points = np.concatenate(([0], points, [0]))
    keep = np.concatenate(([True], (points[1:] != 0) | (points[:-1] != 0)))
    points = points[keep]
    return points[:-1] if len(points) > 1 and points[-1] == 0 and points[-2] == 0 else points


def grams(points: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of one to three code points that hold a letter."""
    two = (points[:-1] << _BITS) | points[1:]
    three = (points[:-2] << 2 * _BITS) | two[1:]
    return np.concatenate((points[points > 0], two, three))


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    points = letters(text)
    if not len(points):
        return points, points
    found = np.sort(grams(points))
    starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
    return found[starts], np.diff(np.concatenate((starts, [len(found)])))


def profile(text: str, size: int = SIZE) -> np.ndarray:
    """The most frequent n-grams, most frequent first; equals by code."""
    found, times = counts(text)
    if len(found) > size:  # all that are as frequent as the last that has a place
        least = np.partition(times, len(times) - size)[len(times) - size]
        found, times = found[times >= least], times[times >= least]
    return found[np.argsort(-times, kind="stable")][:size]


def distances(ordered: np.ndarray, known: Profiles) -> np.ndarray:
    """Out-of-place distance to each language, as a part of the largest one."""
    at = np.searchsorted(known.grams, ordered)
    at[at == len(known.grams)] = 0
    ranks = known.ranks[at]
    lacks = (known.grams[at] != ordered)[:, None] | (ranks < 0)
    out = np.abs(ranks - np.arange(len(ordered))[:, None])
    return np.where(lacks, known.size, out).sum(axis=0) / (known.size * len(ordered))


def predict(text: str | None, known: Profiles) -> tuple[str, float, float]:
    """Language, score and the distance to it."""
    ordered = profile(text or "", known.size)
    if not len(ordered) or not known.languages:
        return UNKNOWN, 0.0, 1.0
    far = distances(ordered, known)
    best = int(np.argmin(far))
    weights = np.exp(-SHARPNESS * (far - far[best]))
    return known.languages[best], float(1 / weights.sum()), float(far[best])


def learn(docs: DataFrame, size: int = SIZE, per_language: int = PER_LANGUAGE) -> Profiles:
    """Profiles of the languages in ``lang``, from a sample of ``docs``."""
    rows = docs.select("doc_id", "lang").filter("lang is not null and doc_id is not null")
    # bounded: at most per_language ids a language
    chosen = F.broadcast(sample(rows, "lang", per_language).select("doc_id").distinct())
    texts = docs.select("doc_id", "lang", F.make_valid_utf8("text").alias("text"))
    texts = texts.filter("lang is not null and text is not null")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                found, times = counts(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(times)],
                    names=["lang", "gram", "times"],
                )

    counted = (
        texts.join(chosen, "doc_id", "left_semi")
        .select("lang", "text")
        .mapInArrow(count, "lang string, gram long, times long")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
    )
    order = Window.partitionBy("lang").orderBy(F.col("times").desc(), "gram")
    top = counted.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < size)
    found = top.select("lang", "gram", "rank").toPandas()  # size rows a language
    languages = sorted(found["lang"].unique())
    known = np.unique(found["gram"].to_numpy(dtype=np.int64))
    ranks = np.full((max(1, len(known)), len(languages)), -1, dtype=np.int64)
    columns = {lang: i for i, lang in enumerate(languages)}
    ranks[np.searchsorted(known, found["gram"]), [columns[x] for x in found["lang"]]] = found["rank"]
    return Profiles(languages, known if len(known) else np.zeros(1, np.int64), ranks, size)


def identify(docs: DataFrame, known: Profiles) -> DataFrame:
    """doc_id, held_out, lang_pred, score and distance per row of ``docs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(text.as_py(), known) for text in batch["text"]]
            langs, scores, far = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(far, pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "distance"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.make_valid_utf8("text").alias("text"),
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, distance double"
    return rows.mapInArrow(run, schema)


def language_of(docs: DataFrame) -> DataFrame:
    """Profiles from the documents that are not held out; then all documents' languages."""
    return identify(docs, learn(docs.filter(~held_out(F.col("doc_id"), 5, 0))))


def in_a_known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share an n-gram with a learned profile, with all their columns.

    What has no letter, or no n-gram of any learned language, goes. If no language is
    learned, only what has no letter goes.
    """
    known = learn(docs.filter(~held_out(F.col("doc_id"), 5, 0)))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            mask = []
            for text in batch["text"].cast(pa.binary()):
                ordered = profile((text.as_py() or b"").decode("utf-8", "replace"), known.size)
                mask.append(
                    bool(len(ordered))
                    and (not known.languages or bool(distances(ordered, known).min() < 1))
                )
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
