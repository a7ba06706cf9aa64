"""Chat formatting by incremental rendering of a template that is a black box.

A template is any function from turns (role, text) to one string. It is asked for every
prefix of a conversation, and consecutive outputs are compared:

* If the output for n turns begins with that for n - 1, the rest is the span of turn n.
  Otherwise the template has rewritten its history at turn n.
* Within its span, a turn's text lies between what two renderings with other texts in its
  place have in common at both ends.

The loss mask of a conversation is the text of its assistant turns. Where a template rewrites
its history, no single output holds every turn as it was rendered, so such a conversation is
given as several examples: each holds the turns up to an assistant turn at which, or after
which, something was rewritten, and masks only the text of the assistant turns that end it.
A template that loses a text (the text's place cannot be found) is an error.

``marked`` is the template of the registered query. It marks turns with their role and an end,
and puts a backslash in front of each backslash, each ``#`` that begins a ``###``, and each
``</turn>`` of a text or role, which ``parse`` takes off again.

Conversations are dealt by id, and rows are streamed in the order of (id, turn), so a task
holds one conversation. Time grows with the square of a conversation's number of turns, as
every prefix is rendered; the template keeps nothing between calls.

Defined cases: a null text or role is empty. Turns are in the order of ``turn``, null first,
then of role and text; repeated rows are turns of their own. Rows with a null id are one
conversation. Damaged UTF-8 becomes U+FFFD. Empty tables give empty results. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]  # role, text
Template = Callable[[list[Turn]], str]
Span = tuple[int, int]

ASSISTANT = "assistant"
_END = "</turn>\n"
_NAMED = {"user": "User", "assistant": "Assistant", "system": "System"}
_ROLES = {heading: role for role, heading in _NAMED.items()}
_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### (=?)((?:[^\\:]|\\.)*): ((?:\\.|(?!</turn>)[^\\])*+)</turn>\n", re.DOTALL)

FORMATTED = (
    "conv_id long, example int, formatted string, spans array<struct<start:long,end:long>>,"
    " loss array<struct<start:long,end:long>>, rewritten array<int>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("example", pa.int32()),
        ("formatted", pa.string()),
        ("spans", _SPANS),
        ("loss", _SPANS),
        ("rewritten", pa.list_(pa.int32())),
    ]
)
BATCH = 256
BATCH_CHARACTERS = 4_000_000


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _heading(role: str) -> str:
    """Known roles by name, others as they are behind an equals sign."""
    return _NAMED.get(role) or "=" + escape(role).replace(":", "\\:")


def marked(turns: list[Turn]) -> str:
    return "".join([f"### {_heading(role)}: {escape(text)}{_END}" for role, text in turns])


def parse(formatted: str) -> list[Turn]:
    """The turns of what :func:`marked` gave."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        other, heading, text = found.groups()
        turns.append((unescape(heading) if other else _ROLES[heading], unescape(text)))
        at = found.end()
    return turns


class Example(NamedTuple):
    formatted: str
    spans: list[Span]  # of the turns; empty where history was rewritten
    loss: list[Span]
    rewritten: list[int]  # turns (from 0) at which the output before was changed


def _agree(one: str, other: str, most: int, side: int) -> int:
    """Up to ``most`` characters that both share at their starts (``side`` 1) or ends (-1); by bisection."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        if side > 0:
            same = one[low:middle] == other[low:middle]
        else:
            same = one[len(one) - middle : len(one) - low] == other[len(other) - middle : len(other) - low]
        low, high = (middle, high) if same else (low, middle - 1)
    return low


def _ends(one: str, other: str) -> tuple[int, int]:
    """How long two strings agree from the start, and from the end of what is left."""
    shorter = min(len(one), len(other))
    start = _agree(one, other, shorter, 1)
    return start, _agree(one, other, shorter - start, -1)


def text_span(template: Template, before: list[Turn], turn: Turn, output: str) -> Span:
    """Where the text of ``turn``, the last one, lies in ``output``.

    Two probes that share no character at either end show what surrounds a text. If a probe is
    not there as it was given, or something else surrounds the text, its place is not known.
    """
    role, _ = turn
    frame, other = (template([*before, (role, probe)]) for probe in ("0a1", "2b3"))
    start, end = _ends(frame, other)
    if (
        frame[start : len(frame) - end] != "0a1"
        or len(output) < start + end
        or output[:start] != frame[:start]
        or output[len(output) - end :] != frame[len(frame) - end :]
    ):
        raise ValueError(f"the template does not keep the text of turn {len(before)}")
    return start, len(output) - end


def render(template: Template, turns: list[Turn]) -> list[Example]:
    """The conversation as one example, or several where the template rewrites its history."""
    output, spans, texts = "", [], {}
    rewritten, kept = [], []
    for n, turn in enumerate(turns):
        now = template(turns[: n + 1])
        if not now.startswith(output):
            rewritten.append(n)
            if texts:  # what was to be learned so far is not in later outputs
                kept.append((output, list(texts.values()), n))
            spans, texts = [], {}
        elif not rewritten:
            spans.append((len(output), len(now)))
        if turn[0] == ASSISTANT:
            texts[n] = text_span(template, turns[:n], turn, now)
        output = now
    examples = [Example(text, [], loss, [at]) for text, loss, at in kept]
    if texts or not kept:
        examples.append(Example(output, [] if rewritten else spans, list(texts.values()), rewritten))
    return examples


def _formatted(template: Template):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row for b in batches for row in zip(*(b[c].to_pylist() for c in ("conv_id", "role", "text")))
        )
        made, size = [], 0
        for conv_id, turns in groupby(rows, key=lambda row: row[0]):
            for n, example in enumerate(render(template, [turn[1:] for turn in turns])):
                spans, loss = ([{"start": a, "end": b} for a, b in x] for x in (example.spans, example.loss))
                made.append((conv_id, n, example.formatted, spans, loss, example.rewritten))
                size += len(example.formatted)
            if len(made) >= BATCH or size >= BATCH_CHARACTERS:
                yield batch(made)
                made, size = [], 0
        if made:
            yield batch(made)

    return run


def format_chats(conversations: DataFrame, template: Template = marked) -> DataFrame:
    """conv_id, example, formatted, spans and loss (code points), rewritten per conversation.

    ``conversations``: conv_id, turn, role, text.
    """
    text, role = (F.make_valid_utf8(F.coalesce(c, F.lit(""))).alias(c) for c in ("text", "role"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(_formatted(template), FORMATTED)
    )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv_id, formatted, loss in zip(*(batch[c].to_pylist() for c in ("conv_id", "formatted", "loss"))):
            turns = parse(formatted)
            learned = "".join([unescape(formatted[span["start"] : span["end"]]) for span in loss])
            whole = "".join([f"{role}\n{text}\n" for role, text in turns])
            digest, loss_digest = (hashlib.sha256(x.encode()).hexdigest() for x in (whole, learned))
            out.append((conv_id, len(turns), digest, len(learned), loss_digest, len(formatted)))
        columns = list(zip(*out)) or [()] * 6
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked texts, read from the output of ``format_chats`` with ``marked`` alone.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of every turn), loss_chars
    and loss_sha256 (the masked texts), formatted_chars.
    """
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        _digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
