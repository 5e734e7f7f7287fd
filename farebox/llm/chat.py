"""Conversations as training text, with the span of every turn found by rendering alone.

A template is a black box: a function from a list of (role, text) to a string.
Prefixes of a conversation that grow by one turn are rendered, and each output is
compared with the one before: what it adds is the span of the new turn. A template
whose output does not begin with the one before rewrites history and is reported.

Conversations are cut into blocks of ``context`` turns, rendered with the block
before them, so that a conversation of any length is spread over tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from farebox.llm.frames import mapped

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

CONTEXT = 32
LEARNED = ("assistant",)
# fixed values of the default template: what opens and ends a turn, and the escape
OPEN, CLOSE, ESCAPE = "###", "</turn>", "\\"

_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]+|\\.)*+): ((?:[^\\<]+|\\\\|\\###|\\</turn>|<(?!/turn>))*+)</turn>\n", re.S)


def escape(text: str) -> str:
    """``text`` without a control string of its own; :func:`unescape` undoes it."""
    return text.replace(ESCAPE, ESCAPE * 2).replace(OPEN, ESCAPE + OPEN).replace(CLOSE, ESCAPE + CLOSE)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def template(turns: Turns) -> str:
    """One ``### role: text</turn>`` line per turn."""
    return "".join(f"{OPEN} {escape(role).replace(':', ESCAPE + ':')}: {escape(text)}{CLOSE}\n" for role, text in turns)


def parse(formatted: str) -> Turns:
    """The turns in the default template's output."""
    out, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return out


def _frame(render: Template, before: Turns, size: int, role: str) -> tuple[str, str]:
    """What the template puts before and after a text of this role: two renderings that differ in the text only."""
    a, b = (render([*before, (role, x)])[size:] for x in "ab")
    head = len(commonprefix([a, b]))
    return a[:head], a[head + 1 :]


def locate(render: Template, turns: Turns, known: int, learned: tuple[str, ...], frames: dict) -> tuple[list[str], list[tuple[int, int] | None], bool]:
    """(pieces, learned part of each piece, whether history was rewritten) of the turns behind the first ``known``.

    ``frames`` remembers what stands around the texts of a role; it is used
    again only where it is found again.
    """
    out, pieces, parts, rewritten = render(turns[:known]) if known else "", [], [], False
    for i in range(known, len(turns)):
        new = render(turns[: i + 1])
        if not new.startswith(out):
            rewritten = True
        piece, part = new[len(out) :], None
        role = turns[i][0]
        if role in learned and not rewritten:
            head, tail = frames.get((role, i == 0), (None, None))
            if head is None or len(piece) < len(head) + len(tail) or not (piece.startswith(head) and piece.endswith(tail)):
                head, tail = frames[role, i == 0] = _frame(render, turns[:i], len(out), role)
            part = len(head), len(piece) - len(tail)
        pieces.append(piece)
        parts.append(part)
        out = new
    if rewritten:
        return [out] if not known else [], [], True
    return pieces, parts, False


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
BLOCK = pa.schema([
    ("block", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(SPAN)), ("loss", pa.list_(SPAN)), ("rewritten", pa.bool_()),
])
BLOCK_DDL = (
    "block bigint, formatted string, spans array<struct<start: bigint, end: bigint>>, "
    "loss array<struct<start: bigint, end: bigint>>, rewritten boolean"
)


def _block_row(render: Template, turns: Turns, known: int, learned: tuple[str, ...], frames: dict) -> dict:
    pieces, parts, rewritten = locate(render, turns, known, learned, frames)
    if rewritten:
        return {"formatted": pieces[0] if pieces else None, "spans": [], "loss": [], "rewritten": True}
    spans, loss, at = [], [], 0
    for piece, part in zip(pieces, parts, strict=True):
        spans.append({"start": at, "end": at + len(piece)})
        if part is not None:
            loss.append({"start": at + part[0], "end": at + part[1]})
        at += len(piece)
    return {"formatted": "".join(pieces), "spans": spans, "loss": loss, "rewritten": False}


def format_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    render: Template = template, learned: tuple[str, ...] = LEARNED, context: int = CONTEXT,
) -> DataFrame:
    """(conv, block, formatted, spans, loss, rewritten): a row per conversation and block of ``context`` turns.

    A conversation's text is that of its blocks in order; ``spans`` are the
    turns' places in the block's text, in code points, and ``loss`` those of the
    texts of ``learned`` roles, without what the template puts around them.
    Where the template rewrites history, ``rewritten`` is true and no span is
    given; the text is then the last rendering, or null if the conversation has
    several blocks. What a template makes of a turn may depend on the
    ``context`` turns before it, at least, and no more.

    Turns go by number, then role and text; rows that repeat a turn are turns of
    their own. A null number comes first, a null role or text is empty, and rows
    with a null conversation are one conversation. Other columns are not kept.
    """
    key = df.schema[conv].dataType
    rows = df.select(
        F.col(conv).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("x")
    )
    own = Window.partitionBy("c")
    placed = rows.select(
        "c", "r", "x", (F.row_number().over(own.orderBy("t", "r", "x")) - 1).cast("bigint").alias("i"), F.count("*").over(own).alias("n")
    ).withColumn("b", F.expr(f"i DIV {context}"))
    # a turn is also context of the next block, if there is one
    dealt = placed.select(
        "c", "r", "x", "i", F.explode(F.when((F.col("b") + 1) * context < F.col("n"), F.array("b", F.col("b") + 1)).otherwise(F.array("b"))).alias("block")
    )
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = dealt.repartition(n, "c", "block").sortWithinPartitions("c", "block", "i").select("c", "block", "i", "r", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames: dict = {}
        held: list[tuple] = []
        kind = None

        def resolve() -> pa.RecordBatch:
            c, block = held[0][:2]
            known = sum(1 for h in held if h[2] < block * context)
            row = _block_row(render, [(h[3], h[4]) for h in held], known, learned, frames) | {"block": block}
            cells = [pa.array([c], kind), *(pa.array([row[f.name]], f.type) for f in BLOCK)]
            return pa.RecordBatch.from_arrays(cells, names=[conv, *BLOCK.names])

        ready: list[pa.RecordBatch] = []
        for batch in batches:
            kind = batch.schema.field(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:2] != held[0][:2]:
                    ready.append(resolve())
                    held = []
                    if len(ready) >= 256:
                        yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                        ready = []
                held.append(row)
        if held:
            ready.append(resolve())
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    return mapped(sorted_rows, run, f"`{conv}` {key.simpleString()}, {BLOCK_DDL}")


READ_DDL = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def read_back(blocks: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all read from the formatted blocks.

    The blocks of a conversation stream through its digests in order, one at a
    time: a digest of a whole conversation cannot be had in parts. Made for the
    default template; blocks whose history was rewritten are refused.
    """
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = blocks.select(F.col(conv).alias("c"), "block", "formatted", "loss", "rewritten").repartition(n, "c").sortWithinPartitions("c", "block")
    key = blocks.schema[conv].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state = None
        kind = None

        def close() -> None:
            c, counts, turns, loss = state
            done.append((c, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

        def flush() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, _, formatted, loss, rewritten in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if rewritten:
                    raise ValueError(f"conversation {c}: the template rewrites history")
                if state is None or c != state[0]:
                    if state is not None:
                        close()
                    state = (c, [0, 0, 0], hashlib.sha256(), hashlib.sha256())
                _, counts, turns_hash, loss_hash = state
                for role, text in parse(formatted):
                    counts[0] += 1
                    turns_hash.update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"] : span["end"]])
                    counts[1] += len(text)
                    loss_hash.update(text.encode())
                counts[2] += len(formatted)
            if len(done) >= 1000:
                yield flush()
                done = []
        if state is not None:
            close()
        if done:
            yield flush()

    return mapped(rows, run, f"`{conv}` {key.simpleString()}, {READ_DDL}")
