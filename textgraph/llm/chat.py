"""Chat formatting by incremental rendering of a template that is only called, never read.

A template is a function from turns ``[(role, text), ...]`` to a string. For each
turn the prefix that ends with it is rendered and compared with the prefix before.
If the older output is how the newer one begins, the rest is the span of the turn;
if not, the template rewrites history, the conversation is marked so, and the span
begins where the two outputs part. Rendering a turn once more with a mark for its
text shows where in the span the text stands. So the loss mask needs no knowledge
of the template.

Rows are sorted by conversation and turn. A template takes a conversation whole, so one
must fit in the memory of a task. Every prefix is rendered from the first turn on. In a
conversation of more than ``WINDOW`` turns that takes time by the square of its length, so
there the turns are first rendered in windows of that many, and the spans joined so far
are compared with the true prefix at the end of each window. Only where all are equal do
the windows stand; else, or where the template refuses a window, prefixes are rendered one by one.

Defined results: a null text or role is empty; equal turn numbers go by role, then
text, nulls first; a null conversation id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textgraph.llm.tables import table

Turns = list[tuple[str, str]]
WINDOW = 256
MARK = "\ue000"
# The control strings of the template.
START, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"


def escape(text: str) -> str:
    """No control string can stand in the result: each ``<``, ``[`` and backslash gets a backslash before it."""
    return re.sub(r"([\\<\[])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\([\\<\[])", r"\1", text)


def render(turns: Turns) -> str:
    """The template: a role and a text for each turn, between control strings; roles and texts are escaped."""
    parts = []
    for role, text in turns:
        body = f"{escape(role)}{START}{escape(text)}"
        parts.append(f"{body}{END}\n" if role == "assistant" else f"{OPEN} {body} {CLOSE}\n")
    return "".join(parts)


TURN = re.compile(r"(?:\[INST\] (?P<asker>(?:[^\\<\[]|\\.)*)<s>(?P<asked>(?:[^\\<\[]|\\.)*) \[/INST\]\n|(?P<role>(?:[^\\<\[]|\\.)*)<s>(?P<text>(?:[^\\<\[]|\\.)*)</s>\n)", re.S)


def read_back(formatted: str) -> Turns:
    """The turns of an output of ``render``."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        role, text = (m["asker"], m["asked"]) if m["asker"] is not None else (m["role"], m["text"])
        turns.append((unescape(role), unescape(text)))
        at = m.end()
    return turns


class Spans:
    """Locates the turns of one conversation as they come; ``before`` is output that is there already."""

    def __init__(self, template: Callable[[Turns], str], before: str = ""):
        self.template, self.before = template, before
        self.turns: Turns = []
        self.rewrites = False

    def add(self, role: str, text: str) -> tuple[str, int, int]:
        """The output that the turn adds, and where its text begins and ends in that."""
        self.turns.append((role, text))
        output = self.template(self.turns)
        shared = len(self.before)
        if not output.startswith(self.before):
            self.rewrites = True
            shared = next((i for i, (a, b) in enumerate(zip(output, self.before)) if a != b), min(len(output), len(self.before)))
        span = output[shared:]
        mark = MARK
        while mark in span or mark in role:
            mark += MARK
        marked = self.template([*self.turns[:-1], (role, mark)])[shared:]
        start = marked.find(mark)
        if start < 0:  # the template leaves the text out, or changes what stands before it
            start = stop = 0
        else:
            stop = len(span) - (len(marked) - start - len(mark))
        self.before = output
        return span, start, max(start, stop)


def in_windows(turns: Turns, template: Callable[[Turns], str], window: int) -> list[tuple[str, int, int, bool]] | None:
    """As ``located``, from renderings of a window's turns alone; None where they do not make up
    the prefix that ends with each window, rendered from the first turn on."""
    found, joined = [], ""
    for at in range(0, len(turns), window):
        try:
            spans = Spans(template, template([]) if at else "")
            part = [spans.add(*turn) for turn in turns[at : at + window]]
        except Exception:  # a template may refuse what does not begin as a conversation does
            return None
        joined += "".join(output for output, _, _ in part)
        if spans.rewrites or template(turns[: at + window]) != joined:
            return None
        found += [(*span, False) for span in part]
    return found


def located(turns: Turns, template: Callable[[Turns], str], window: int = WINDOW) -> list[tuple[str, int, int, bool]]:
    """By turn the output that it adds, where its text begins and ends in that, and whether history was rewritten so far."""
    found = in_windows(turns, template, window) if len(turns) > window else None
    if found is None:
        spans = Spans(template)
        found = [(*spans.add(*turn), spans.rewrites) for turn in turns]
    return found


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Turns]]:
    """``(conv_id, turns)`` of rows in order."""
    now, turns = None, []
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if turns and conv != now:
                yield now, turns
                turns = []
            now = conv
            turns.append((role or "", text or ""))
    if turns:
        yield now, turns


def by_conversation(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """Turns dealt by conversation and in order."""
    order = ["conv_id", "turn", "role", "text"]
    dealt = turns.select(*order)
    dealt = dealt.repartition("conv_id") if partitions is None else dealt.repartition(partitions, "conv_id")
    return dealt.sortWithinPartitions(*order)


def format_turns(turns: DataFrame, template: Callable[[Turns], str] = render, window: int = WINDOW) -> DataFrame:
    """``(conv_id, position, role, formatted, text_start, text_end, in_loss, rewrites)``: the
    output of each turn, and where its text stands in it. Assistant texts are in the loss."""

    id_type = turns.schema["conv_id"].dataType
    kinds = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    names = ["conv_id", "position", "role", "formatted", "text_start", "text_end", "in_loss", "rewrites"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(col, kind) for col, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for conv, said in conversations(batches):
            for position, ((role, _), span) in enumerate(zip(said, located(said, template, window), strict=True)):
                output, start, stop, rewrites = span
                rows.append((conv, position, role, output, start, stop, role == "assistant", rewrites))
                size += len(output)
                if size > 1 << 20 or len(rows) >= 4096:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    schema = f"conv_id {id_type.simpleString()}, position bigint, role string, formatted string, text_start bigint, text_end bigint, in_loss boolean, rewrites boolean"
    return by_conversation(turns).mapInArrow(work, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation of ``format_turns``, read back from its output.

    The rows of ``formatted`` must still lie as it returns them: those of a
    conversation in order, in one partition.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    kind = to_arrow_type(formatted.schema["conv_id"].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(7)]
        now = None
        state: list | None = None

        def close() -> None:
            n, turns, loss, loss_chars, chars, rewrites = state
            for col, value in zip(out, (now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, rewrites), strict=True):
                col.append(value)

        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "text_start", "text_end", "in_loss", "rewrites"))
            for conv, output, start, stop, in_loss, rewrites in zip(*cols, strict=True):
                if state is None or conv != now:
                    if state is not None:
                        close()
                    now, state = conv, [0, hashlib.sha256(), hashlib.sha256(), 0, 0, False]
                for role, text in read_back(output):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if in_loss:
                    text = unescape(output[start:stop])
                    state[2].update(text.encode("utf-8", "surrogatepass"))
                    state[3] += len(text)
                state[4] += len(output)
                state[5] |= rewrites
        if state is not None:
            close()
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"])

    return formatted.mapInArrow(work, f"conv_id {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewrites boolean")


def op7_chat(spark, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one (-7) whose texts hold control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast(given.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return digests(format_turns(given.unionByName(own)))
