"""Chat formatting by incremental black-box rendering (operator 3).

A template is any function from turns to a string. Successive prefixes of a conversation are rendered and compared:
if each output begins with the one before, what it adds is the span of the new turn; if not, the template rewrites
history, and the conversation is marked so and has no spans. Rendering a turn once more with a probe in place of
its text shows where in the span the text stands, so the loss mask covers the assistants' texts and nothing else.

A conversation of more than ``block_turns`` turns is put out in blocks of that many. A template may say in its
attribute ``lookback`` on how many turns before it the rendering of a turn can depend; then a block is rendered after
that many turns (``OVERLAP`` at least, so that a rewrite near the border is seen too), and neither memory nor work grow
with the square of a conversation. A template that says nothing may depend on all: each block is rendered after the
whole conversation so far, so that its output is the template's own at any length, at the price of holding the
conversation and rendering each of its prefixes.
Rows are dealt by conversation and read in the order of their turns.

Defined results: a null text or role is empty; rows with a null conversation form one; ties in a conversation's turns
are ordered by role and text, and every row counts as a turn; other columns are ignored; of an empty table no rows come.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared

Turns = list[tuple[str, str]]
PROBE = "\ue000"
BLOCK_TURNS, OVERLAP = 256, 16

_ESCAPE = re.compile(r"[\\#<]")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    """No control string is left: their first characters get a backslash, as backslashes do."""
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def turn_template(turns: Turns) -> str:
    """``### Role: text</turn>`` a turn, the role's first letter as it is and both parts escaped."""
    return "".join(f"### {escape(role).replace(':', chr(92) + ':')}: {escape(text)}</turn>\n" for role, text in turns)


turn_template.lookback = 0  # a turn is rendered the same wherever it stands


def parse_turns(formatted: str) -> Turns:
    """The turns of a formatted text; raises if it is not the template's output."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at character {at}")
    return turns


def render(turns: Turns, template: Callable[[Turns], str], loss_role: str = "assistant", history: Turns | None = None) -> tuple[str, bool, list[tuple[int, int]], list[tuple[int, int]]]:
    """(output, rewrites history, span of each turn, spans of the loss mask), spans as (start, length) in characters.

    With a history, the output and its spans begin after what the template says of it alone.
    """
    if history:
        head = len(template(history))
        output, rewrites, spans, loss = render(turns, lambda own: template([*history, *own]), loss_role)
        return (output if rewrites else output[head:]), rewrites, [(a - head, n) for a, n in spans], [(a - head, n) for a, n in loss]
    before, spans, loss = template([]), [], []
    for k in range(1, len(turns) + 1):
        output = template(turns[:k])
        if not output.startswith(before):
            return template(turns), True, [], []
        spans.append((len(before), len(output) - len(before)))
        role, text = turns[k - 1]
        if role == loss_role:
            probed = template([*turns[: k - 1], (role, PROBE)])
            at = probed.find(PROBE, len(before))
            if not probed.startswith(before) or at < 0:
                return template(turns), True, [], []
            after = len(probed) - at - len(PROBE)
            loss.append((at, len(output) - after - at))
        before = output
    return before, False, spans, loss


FORMATTED = "conv_id long, block int, formatted string, rewrites boolean, turn_spans array<struct<start:long,length:long>>, loss_spans array<struct<start:long,length:long>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("block", pa.int32()), ("formatted", pa.string()), ("rewrites", pa.bool_()), ("turn_spans", _SPAN), ("loss_spans", _SPAN)])


def format_conversations(turns: DataFrame, template: Callable[[Turns], str] = turn_template, loss_role: str = "assistant", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each block of a conversation: the formatted text, the turns' spans and the loss mask."""
    spark = turns.sparkSession
    lookback = getattr(template, "lookback", None)
    keep = None if lookback is None else max(OVERLAP, lookback)
    shared.small_batches(spark)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), shared.text_or_empty("role").alias("role"), shared.text_or_empty("text").alias("text"))
    rows = rows.repartition(shared.parallelism(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def row(conv: int | None, block: int, own: Turns, history: Turns) -> tuple:
        output, rewrites, spans, loss = render(own, template, loss_role, history)
        pairs = lambda x: [{"start": a, "length": n} for a, n in x]
        return conv, block, output, rewrites, pairs(spans), pairs(loss)

    def run(batches: Iterator[pa.RecordBatch]):
        conv, block, own, history, out, size = None, 0, [], [], [], 0
        for batch in batches:
            for c, r, t in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if own and (c != conv or len(own) == block_turns):
                    out.append(row(conv, block, own, history))
                    size += len(out[-1][2])
                    past = [*history, *own]
                    block, own, history = (0, [], []) if c != conv else (block + 1, [], past if keep is None else past[-keep:])
                conv = c
                own.append((r, t))
                if size > 4 << 20:
                    yield _batch(out, _FORMATTED)
                    out, size = [], 0
        if own:
            out.append(row(conv, block, own, history))
        if out:
            yield _batch(out, _FORMATTED)

    return rows.mapInArrow(shared.frugal(run), FORMATTED)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digests(formatted: DataFrame) -> DataFrame:
    """Of each conversation in formatted text: its turns and the text under its loss mask, read back and hashed."""
    spark = formatted.sparkSession
    rows = formatted.repartition(shared.parallelism(spark), "conv_id").sortWithinPartitions("conv_id", "block")

    def run(batches):
        state = None

        def closed():
            conv, n, turns, chars, loss, size = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in batches:
            out = []
            for conv, text, spans in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_spans"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        out.append(closed())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, own in parse_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{own}\n".encode())
                for span in spans:
                    own = unescape(text[span["start"] : span["start"] + span["length"]])
                    state[3] += len(own)
                    state[4].update(own.encode())
                state[5] += len(text)
            if out:
                yield _batch(out, _DIGEST)
        if state is not None:
            yield _batch([closed()], _DIGEST)

    return rows.mapInArrow(shared.frugal(run), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: A conversation that holds the template's own control strings.
PLANTED = r"\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: all ``conversations`` and the planted one, formatted, written, and read back."""
    given = shared.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text"))
    return digests(shared.staged(spark, format_conversations(given.unionByName(planted)), shared.work_dir(spark, "chat")))
