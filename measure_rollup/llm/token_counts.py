"""Token counts through a cache of digests.

The cache is a Parquet table ``version, digest, n_tokens``: the digest of the tokenizer's
file, the digest of the normalised content, and the count. Documents are joined to it by
both digests; only the distinct contents without an entry are encoded, and their counts
are appended. A job that fails while it appends leaves no entry (Spark's committer),
and entries written twice by jobs that run side by side are equal and are read as one.

Normalised content is the text in UTF-8, null as empty: nothing that would change a
count is normalised away.

Inside a task, counts of words are kept in a bounded memory. This is exact for a
SentencePiece BPE model with identity normalisation in which no piece holds the mark of
a space after another character: no merge then crosses the border between a word and
the spaces after it. ``WordCounter`` checks the model for this, and encodes whole texts
if it does not hold, as it does for texts that hold the mark itself.

Defined cases: null and empty texts have 0 tokens. Repeated rows are counted each, from
one entry. Null ids pass through. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMORY = 250_000
_MARK = "▁"
_SEGMENT = re.compile(r" *[^ ]+| +")
_COUNTERS: dict[str, "WordCounter"] = {}


def version_of(tokenizer: str) -> str:
    """The digest of a tokenizer's file."""
    with open(tokenizer, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


class WordCounter:
    """Counts tokens of texts; keeps the counts of up to ``memory`` words."""

    def __init__(self, tokenizer: str, memory: int = MEMORY):
        if tokenizer.endswith(".json"):
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(tokenizer)
            model.no_truncation()
            model.no_padding()
            self._lengths = lambda texts: [
                len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)
            ]
            self.splits = False
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=tokenizer)
            self._lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
            # every space is kept, as is every other character, and one is put in front
            identity = model.normalize(" \ufb01  A\u030a ") == "▁▁\ufb01▁▁A\u030a▁"
            self.splits = identity and not any(_MARK in piece.lstrip(_MARK) for piece in pieces)
        self.memory = memory
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self._lengths(texts)
        return [self._lengths([t])[0] if _MARK in t else self._count(t) for t in texts]

    def _count(self, text: str) -> int:
        """By segment: a word with the spaces before it, the first of which the model adds itself."""
        if not text:
            return 0
        words = (" " + text).split(" ")[1:]
        if "" in words:  # runs of spaces
            words = [s[1:] for s in _SEGMENT.findall(" " + text)]
        known = self.known
        missing = list(set(words).difference(known))
        if missing:
            if len(known) + len(missing) > self.memory:
                known.clear()
                missing = list(set(words))
            known.update(zip(missing, self._segment_lengths(missing)))
        return sum(map(known.__getitem__, words))

    def _segment_lengths(self, segments: list[str]) -> list[int]:
        """A lone space in front of nothing is one token, but the library gives none for no text."""
        return [n if s else 1 for s, n in zip(segments, self._lengths(segments))]


def counter(tokenizer: str) -> WordCounter:
    """One per Python worker."""
    if tokenizer not in _COUNTERS:
        _COUNTERS[tokenizer] = WordCounter(tokenizer)
    return _COUNTERS[tokenizer]


def _encode(misses: DataFrame, tokenizer: str) -> DataFrame:
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = counter(tokenizer)
        for batch in batches:
            yield pd.DataFrame(
                {"digest": batch["digest"], "n_tokens": known.counts(batch["content"].tolist())}
            )

    return misses.select("digest", "content").mapInPandas(count, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit``) per row of ``docs``.

    ``tokenizer``: a file that every executor has, ``.json`` for tokenizers or ``.model``
    for sentencepiece. ``cache``: a folder that every executor reaches; made if missing.
    """
    spark = docs.sparkSession
    version = version_of(tokenizer)
    content = F.make_valid_utf8(F.coalesce("text", F.lit("")))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
        content.alias("content"),
    )
    schema = "version string, digest binary, n_tokens long"
    # a first write of no rows makes the folder, so that it can be read
    spark.createDataFrame([], schema).write.mode("append").parquet(cache)
    stored = (
        spark.read.schema(schema)
        .parquet(cache)
        .filter(F.col("version") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    misses = (
        rows.select("digest", "content")
        .dropDuplicates(["digest"])  # in each task first, so that a hot text is sent once by each
        .join(stored.select("digest"), "digest", "left_anti")
    )
    _encode(misses, tokenizer).select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode(
        "append"
    ).parquet(cache)
    spark.catalog.refreshByPath(cache)
    filled = (
        spark.read.schema(schema)
        .parquet(cache)
        .filter(F.col("version") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return (
        rows.select("doc_id", "n_bytes", "digest")
        .join(filled, "digest")
        .select(
            "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
        )
    )
