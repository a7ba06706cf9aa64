"""Mixing sources to target weights by iterative proportional fitting.

Documents are put in cells of source, language and topic, and their tokens (words
between white space) are summed by cell. The cells' token weights are raked: in turn each
margin's weights are scaled to its target, until no margin's share is more than
``TOLERANCE`` off. The margins of the raked weights then agree with all targets, and the
cells keep their interactions. Where targets contradict each other (a value that occurs in
one cell only, wanted at two different shares) no weights meet them all: raking stops when
a round takes less than a tenth off the error, and ``margins`` names what is off.

A cell's factor is its raked over its observed weight. The sample's size is stated: ``rate``
of all tokens. A document's probability is its cell's factor times one number for all
cells, at most 1, and that number is such that the expected tokens are ``rate`` of all. Cells
that would need more than all their documents give all, and the others make up for it, so a
rare value moves the others by its own size only. Where no cell is exhausted the sample's
expected margins are the targets; ``margins`` reports the expected ones. A document stays if a hash of its
id, as a part of 2^32, is below its probability.

Targets: of each margin either given shares by value, or the observed shares to a power
and normalised (1 keeps them, 0 makes them equal). Values without a given share get none.

Raking works on the table of cells with joins and sums, so the number of sources is not
bounded; each step is written to the checkpoint folder. Topics are rules on the text,
see ``topic``.

Defined cases: null sources, languages and topics are values of their own; null text is
empty. Documents without tokens take their cell's probability; a cell without tokens has
the factor 1, and as probability the number of all cells. Where the cells that are wanted
hold less than ``rate`` of all tokens, all of theirs stay. A target that no observed cell can meet is left out and the others are
normalised. Rows without an id are drawn like an id of their own, alike; repeated rows stay
or go together. Empty tables give empty results. Other columns pass through ``mix``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measure_rollup.sources import new_folder
from measure_rollup.sources.shared import settle

MARGINS = ("source", "lang", "topic")
POWERS = {"source": 0.7, "lang": 0.85, "topic": 0.95}
RATE = 0.5  # of the tokens, in the sample
TOLERANCE = 1e-7  # of a margin's share
FALL = 0.9  # of the error, after a round that is worth another
DIGITS = 9  # of factors and probabilities

_WORD = r"[^ \t\n\x0B\f\r]+"


def topic(text: Column) -> Column:
    """table, license, contact or prose: the first whose mark the text holds."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("icense")), "license")
        .when(F.contains(text, F.lit("@")), "contact")
        .otherwise("prose")
    )


def draw(doc_id: Column) -> Column:
    """A number from 0 to 1 that follows from the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def _value(name: str) -> Column:
    """Null becomes a value that no other has."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def described(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, and the margins' values as s, l and t."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        "lang",
        topic(text).alias("topic"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("n_tokens"),
    )
    return rows.select("*", *(_value(name).alias(f"_{name}") for name in MARGINS))


def targets(cells: DataFrame, name: str, wanted: Mapping[str, float] | float) -> DataFrame:
    """A margin's values and target shares, which sum to 1 over those with tokens."""
    column = f"_{name}"
    seen = cells.groupBy(column).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    if isinstance(wanted, Mapping):
        given = F.create_map(*(F.lit(x) for k, v in wanted.items() for x in (f"={k}", float(v))))
        share = F.coalesce(given[F.col(column)], F.lit(0.0))
    else:
        share = F.pow(F.col("tokens") / F.lit(_total(seen, "tokens")), F.lit(float(wanted)))
    seen = seen.select(column, share.alias("share"))
    return seen.select(column, (F.col("share") / F.lit(_total(seen, "share"))).alias("target"))


def _total(df: DataFrame, column: str) -> float:
    """A sum, one number; 1 if it is nothing, which then divides no row."""
    return float(df.agg(F.sum(column)).first()[0] or 1)


def rake(cells: DataFrame, wanted: Mapping[str, Mapping[str, float] | float] = POWERS) -> DataFrame:
    """``cells`` with the margins' targets and their factor: the raked weight over the observed one.

    A cell carries its targets, so a step is one sum over a margin, which is combined before
    the shuffle, and one join back. What a margin holds before it is scaled says how far off it is.
    """
    aimed = cells.filter("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for name in MARGINS:
        aim = targets(cells, name, wanted[name]).withColumnRenamed("target", f"{name}_target")
        aimed = aimed.join(aim, f"_{name}")
    raked = settle(aimed)
    size, before = _total(raked, "weight"), None
    while True:
        raked = raked.withColumn("off", F.lit(0.0))
        for k, name in enumerate(MARGINS):
            held = raked.groupBy(f"_{name}").agg(F.sum("weight").alias("held"))
            scaled = F.when(F.col("held") > 0, F.col("weight") * F.col(f"{name}_target") / F.col("held"))
            # the first step of all starts from tokens, the others from shares
            part = F.col("held") / F.lit(size if before is None and k == 0 else 1.0)
            off = F.greatest("off", F.abs(part - F.col(f"{name}_target")))
            raked = raked.join(held, f"_{name}").withColumns({"off": off, "weight": F.coalesce(scaled, F.lit(0.0))})
            raked = settle(raked.select(*aimed.columns, "off"))
        error = raked.agg(F.max("off")).first()[0]
        if error is None or error <= TOLERANCE or (before is not None and error > FALL * before):
            break
        before = error
    factor = F.round(F.col("weight") / (F.col("tokens") / F.lit(_total(raked, "tokens"))), DIGITS)
    return raked.select(*cells.columns, *(f"{name}_target" for name in MARGINS), factor.alias("factor"))


def multiplier(factors: DataFrame, wanted: float) -> float:
    """The number by which factors become probabilities, so that ``wanted`` tokens are expected.

    It grows until no further cell is exhausted; with few cells or many, each step is one sum.
    """
    if not factors.agg(F.sum(F.col("tokens") * F.col("factor"))).first()[0]:
        return 1.0
    number, exhausted = 0.0, -1
    while True:
        spent = F.col("factor") * F.lit(number) >= 1
        whole, rest, cells = factors.agg(
            F.sum(F.when(spent, F.col("tokens")).otherwise(0)),
            F.sum(F.when(spent, 0.0).otherwise(F.col("tokens") * F.col("factor"))),
            F.sum(F.when(spent, 1).otherwise(0)),
        ).first()
        if cells == exhausted or not rest:
            return number
        number, exhausted = max(number, (wanted - float(whole)) / rest), cells


def _calibrated(docs: DataFrame, wanted, rate: float) -> tuple[DataFrame, DataFrame]:
    """The described documents, and a small stored table of cells and probabilities."""
    keys = [f"_{name}" for name in MARGINS]
    rows = described(docs)
    cells = settle(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")))
    factors = settle(rake(cells, wanted))
    number = multiplier(factors, rate * _total(cells, "tokens"))
    factor = F.coalesce("factor", F.lit(1.0))
    weighed = cells.join(factors.drop("tokens"), keys, "left").select(
        *keys,
        "tokens",
        *(f"{name}_target" for name in MARGINS),
        factor.alias("factor"),
        F.round(F.least(F.lit(1.0), factor * F.lit(number)), DIGITS).alias("probability"),
    )
    path = new_folder(docs.sparkSession, "cells")
    weighed.write.parquet(path)
    return rows, docs.sparkSession.read.schema(weighed.schema).parquet(path)


def mixed(
    docs: DataFrame, wanted: Mapping[str, Mapping[str, float] | float] = POWERS, rate: float = RATE
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, factor, probability and kept per row of ``docs``."""
    rows, cells = _calibrated(docs, wanted, rate)
    keys = [f"_{name}" for name in MARGINS]
    return rows.join(cells, keys).select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "n_tokens",
        "factor",
        "probability",
        (draw(F.col("doc_id")) < F.col("probability")).alias("kept"),
    )


def margins(
    docs: DataFrame, wanted: Mapping[str, Mapping[str, float] | float] = POWERS, rate: float = RATE
) -> DataFrame:
    """margin, value, target, raked and expected: shares of a value as wanted, after raking, and in the sample.

    ``raked`` differs from ``target`` where targets contradict each other, ``expected`` from
    ``raked`` where cells are exhausted. A null value of a margin is null here too.
    """
    _, cells = _calibrated(docs, wanted, rate)
    cells = cells.filter("tokens > 0")
    raked, drawn = F.col("tokens") * F.col("factor"), F.col("tokens") * F.col("probability")
    totals = cells.agg(F.sum(raked), F.sum(drawn)).first()
    found = [
        cells.groupBy(f"_{name}").agg(
            F.first(f"{name}_target").alias("target"),
            (F.sum(raked) / F.lit(float(totals[0] or 1))).alias("raked"),
            (F.sum(drawn) / F.lit(float(totals[1] or 1))).alias("expected"),
        ).select(
            F.lit(name).alias("margin"),
            F.when(F.col(f"_{name}") != "null", F.expr(f"substring(_{name}, 2)")).alias("value"),
            "target",
            "raked",
            "expected",
        )
        for name in MARGINS
    ]
    return found[0].union(found[1]).union(found[2])


def mix(
    docs: DataFrame, wanted: Mapping[str, Mapping[str, float] | float] = POWERS, rate: float = RATE
) -> DataFrame:
    """The rows of ``docs`` that are sampled, with all their columns."""
    _, cells = _calibrated(docs, wanted, rate)
    whole = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    text = F.coalesce("row.text", F.lit(""))
    placed = whole.select(
        "row",
        *(_value(f"row.{name}").alias(f"_{name}") for name in MARGINS if name != "topic"),
        F.concat(F.lit("="), topic(text)).alias("_topic"),
    )
    joined = placed.join(cells, [f"_{name}" for name in MARGINS])
    return joined.filter(draw(F.col("row.doc_id")) < F.col("probability")).select("row.*")
