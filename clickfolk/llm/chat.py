"""Chat formatting with a template that is a black box: a function from turns to one string.

Each prefix of the turns is rendered and compared with the one before: what was added is the turn's span. If the
earlier output is not a prefix of the later one, the template rewrites history. Within a span the text is found by
rendering the turn once more with a mark in the text's place: what stands before and after the mark is the template's.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk.llm.texts import travels

travels(__name__)

Turns = list[tuple[str, str]]

# fixed values: the control strings of the default template
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]")
_CONTROL = re.compile("|".join(["\\\\", *map(re.escape, CONTROL)]))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

OUT = ("conv_id bigint, n_turns bigint, formatted string, "
       "spans array<struct<role:string,start:bigint,end:bigint,text_start:bigint,text_end:bigint>>, "
       "turns array<struct<role:string,text:string>>, loss_texts array<string>, rewrites_history boolean")


def escape(text: str) -> str:
    """Break control strings with a backslash after their first character; a backslash is doubled."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: Turns) -> str:
    """The default template: user turns in instruction marks, assistant turns after a blank, others with their role."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f" {escape(text)}</s>")
        else:
            out.append(f"<s>{escape(role)}[ROLE] {escape(text)}</s>")
    return "".join(out)


def read_back(formatted: str) -> Turns:
    """The turns a string of the default template says; no control string stands inside a text."""
    turns, at = [], 0

    def until(stop: str, begin: int) -> tuple[str, int]:
        end = formatted.index(stop, begin)
        return unescape(formatted[begin:end]), end + len(stop)

    while at < len(formatted):
        if formatted.startswith("[INST] ", at):
            role = "user"
            text, at = until(" [/INST]", at + 7)
        elif formatted.startswith("<s>", at):
            role, at = until("[ROLE] ", at + 3)
            text, at = until("</s>", at)
        else:
            role = "assistant"
            text, at = until("</s>", at + 1)
        turns.append((role, text))
    return turns


def locate(turns: Turns, template: Callable[[Turns], str]) -> tuple[str, list[tuple | None], bool]:
    """Final output, per turn (start, end, text start, text end), and whether any step rewrote history.

    Where history was rewritten, a turn whose place in the final output cannot be told has no span.
    """
    used = {c for _, text in turns for c in text}
    mark = next(chr(c) for c in range(0xE000, 0x110000) if chr(c) not in used)
    before, spans, rewrites = template([]), [], False
    for k, (role, text) in enumerate(turns):
        now = template(turns[: k + 1])
        if not now.startswith(before):
            rewrites = True
        marked = template([*turns[:k], (role, mark)])
        if marked.startswith(before) and now.startswith(before) and marked.count(mark) == 1:
            head = marked.index(mark)
            tail = len(marked) - head - 1
            spans.append((len(before), len(now), head, len(now) - tail))
        else:
            spans.append(None)
        before = now
    if rewrites:  # spans seen on the way may have moved
        spans = []
        for k, (role, text) in enumerate(turns):
            marked = template([*turns[:k], (role, mark), *turns[k + 1:]])
            head = marked.find(mark)
            tail = len(marked) - head - 1
            fits = head >= 0 and marked.count(mark) == 1 and before.startswith(marked[:head]) and (
                not tail or before.endswith(marked[head + 1:])) and head + tail <= len(before)
            spans.append((None, None, head, len(before) - tail) if fits else None)
    return before, spans, rewrites


def _formatting(template: Callable[[Turns], str], reader: Callable[[str], Turns], undo: Callable[[str], str],
                learned: frozenset[str]):
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
        ("spans", pa.list_(pa.struct([("role", pa.string()), *[(n, pa.int64()) for n in ("start", "end", "text_start", "text_end")]]))),
        ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
        ("loss_texts", pa.list_(pa.string())), ("rewrites_history", pa.bool_())])

    def one(conv: int | None, turns: Turns) -> dict:
        formatted, spans, rewrites = locate(turns, template)
        names = ("start", "end", "text_start", "text_end")
        told = [{"role": role, **dict(zip(names, span or (None,) * 4))} for (role, _), span in zip(turns, spans)]
        loss = [undo(formatted[span[2]:span[3]]) for (role, _), span in zip(turns, spans) if role in learned and span]
        return {"conv_id": conv, "n_turns": len(turns), "formatted": formatted, "spans": told,
                "turns": [{"role": r, "text": t} for r, t in reader(formatted)], "loss_texts": loss,
                "rewrites_history": rewrites}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turns, out, size = None, [], [], 0
        for batch in batches:
            for conv, role, text in zip(*[batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]):
                if turns and conv != current:
                    out.append(one(current, turns))
                    size += len(out[-1]["formatted"])
                    turns = []
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                current = conv
                turns.append((role or "", text or ""))
        if turns:
            out.append(one(current, turns))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def format_chats(rows: DataFrame, template: Callable[[Turns], str] = render, reader: Callable[[str], Turns] = read_back,
                 undo: Callable[[str], str] = unescape, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: formatted string, spans of turns and texts, turns read back, texts under the loss mask.

    ``rows``: ``conv_id, turn, role, text``. Turns go by ``turn``, equal ones by role, then text; a repeated row is a
    turn of its own. A null text or role is an empty one, null turns come first, rows with a null ``conv_id`` form one
    conversation. An empty table gives an empty result. Rows are sorted and streamed; a task holds one conversation,
    which is one string in the result, and renders each of its prefixes, as the method asks.
    """
    narrow = rows.select(F.col("conv_id").cast("bigint"), "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_formatting(template, reader, undo, frozenset(learned)), OUT)


def digests(chats: DataFrame) -> DataFrame:
    """Fixed-size columns of ``format_chats``."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss: Column = F.array_join("loss_texts", "")
    return chats.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
