"""Chat formatting with a grammar that reads back exactly what was written.

A conversation is a series of turns, each between an opening and a closing mark:

    <<SYS>>\\n text \\n<</SYS>>\\n\\n    a system turn
    [INST] text [/INST]               a user turn
    <s> text </s>                     an assistant turn
    [ROLE] role [SAYS] text [/ROLE]   a turn of any other role

No text may hold a mark, so the parser is deterministic: the next mark closes the turn or is an
error. Turns are rendered as they are and parsed again. Where the recovered turns are not the
source, the turns that do not survive are escaped and the text is rendered and parsed anew, until both are identical:
a backslash goes behind the first sign of every mark, and one more where there are backslashes
already, and the parser takes one away. All other text is written as it is.

Rows are put in order by range partitions of (conversation, turn, role, text), so a conversation that holds
any share of all rows is written by many tasks. They write segments of whole turns, each of
about SEGMENT signs, with the places of the assistant's texts as the loss mask. Reading takes a
segment at a time. A digest over a conversation has to see its text in order; a conversation that
lies in one segment is read where it stands, the others (two per task, and long ones) are
gathered by id and streamed through, so one task may read a long one but never holds it.

Results for odd input: a null text or role is an empty one, and an empty role is a role like any
other; rows without a conversation are one conversation; rows without a turn come first; rows of
the same turn stand in order of role and text; a table without rows gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import by_value, text_of, written

# Opening and closing mark of the known roles; of any other role, with the mark between role and text.
ROLES = {"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
ANY_ROLE = ("[ROLE] ", " [SAYS] ", " [/ROLE]")
LEARNT = "assistant"
SEGMENT = 1 << 20

ANGLE, SQUARE = r"s>|/s>|<SYS>>|</SYS>>", r"INST\]|/INST\]|ROLE\]|SAYS\]|/ROLE\]"
MARK = re.compile(rf"<(?:{ANGLE})|\[(?:{SQUARE})")
TO_ESCAPE = re.compile(rf"<(?=\\*(?:{ANGLE}))|\[(?=\\*(?:{SQUARE}))")
ESCAPED = re.compile(rf"(<(?=\\+(?:{ANGLE}))|\[(?=\\+(?:{SQUARE})))\\")
OPENS = {opening.strip(): (role, opening, closing) for role, (opening, closing) in ROLES.items()}

SEGMENTS = "conv_id long, part int, segment long, whole boolean, text string, loss array<struct<start:long,length:long>>"
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
TURNS = "conv_id long, part int, segment long, place long, role string, text string"


class Conflict(ValueError):
    """A text that is not of the grammar."""


def escape(text: str) -> str:
    return TO_ESCAPE.sub(lambda sign: sign[0] + "\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int]:
    """One turn, and where its text starts; role and text are taken as they are."""
    if role in ROLES:
        before, after = ROLES[role]
    else:
        before, after = f"{ANY_ROLE[0]}{role}{ANY_ROLE[1]}", ANY_ROLE[2]
    return before + text + after, len(before)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns (role, text) of rendered text."""
    marks = MARK.finditer(text)
    turns, at = [], 0

    def upto(closing: str, start: int) -> tuple[str, int]:
        """Text from `start` up to the next mark, which has to be `closing`; and where that ends."""
        mark = next(marks, None)
        if mark is None or mark[0] != closing.strip():
            raise Conflict(f"no {closing.strip()} at {start}")
        begin = mark.start() - (len(closing) - len(closing.lstrip()))
        end = begin + len(closing)
        if begin < start or text[begin:end] != closing:
            raise Conflict(f"no {closing!r} at {begin}")
        return unescape(text[start:begin]), end

    while at < len(text):
        mark = next(marks, None)
        if mark is None or mark.start() != at:
            raise Conflict(f"no turn at {at}")
        if mark[0] in OPENS:
            role, opening, closing = OPENS[mark[0]]
        else:
            role, opening, closing = None, ANY_ROLE[0], ANY_ROLE[2]
        if not text.startswith(opening, at):
            raise Conflict(f"no turn at {at}")
        at += len(opening)
        if role is None:
            role, at = upto(ANY_ROLE[1], at)
        said, at = upto(closing, at)
        turns.append((role, said))
    return turns


def settle(turns: list[tuple[str, str]]) -> list[tuple[str, int, int]]:
    """Every turn rendered, with start and length of its text, such that parsing gives back the turns."""
    now = list(turns)
    while True:
        rendered = [render(*turn) for turn in now]
        try:
            if parse("".join(text for text, _ in rendered)) == turns:
                return [(text, start, len(said)) for (text, start), (_, said) in zip(rendered, now, strict=True)]
        except Conflict:
            pass
        conflicts = 0
        for k, (text, _) in enumerate(rendered):
            try:
                survives = parse(text) == [turns[k]]
            except Conflict:
                survives = False
            if not survives:
                conflicts += 1
                now[k] = (now[k][0] if now[k][0] in ROLES else escape(now[k][0]), escape(now[k][1]))
        if not conflicts:
            raise Conflict("turns survive one by one, but not together")


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType], size=lambda row: 200) -> Iterator[pa.RecordBatch]:
    held, total = [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for row in rows:
        held.append(row)
        total += size(row)
        if total >= 4 * SEGMENT:
            yield batch()
            held, total = [], 0
    if held:
        yield batch()


def _write(segment_chars: int):
    names = ["conv_id", "part", "segment", "whole", "text", "loss"]
    span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.list_(span)]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        conv, turns, chars, number, first = None, [], 0, 0, True

        def closed(whole: bool) -> tuple:
            texts, loss, at = [], [], 0
            for (role, _), (text, start, length) in zip(turns, settle(turns), strict=True):
                if role == LEARNT:
                    loss.append({"start": at + start, "length": length})
                texts.append(text)
                at += len(text)
            return conv, part, number, whole, "".join(texts), loss

        for batch in batches:
            for here, role, text in zip(*(batch.column(c) for c in ("conv_id", "role", "text")), strict=True):
                here, role, text = here.as_py(), role.as_py(), text.as_py()
                if turns and (here != conv or chars >= segment_chars):
                    # Neighbouring tasks may have more of the first and of the last conversation.
                    yield closed(here != conv and number == 0 and not first)
                    first = first and here == conv
                    number = number + 1 if here == conv else 0
                    turns, chars = [], 0
                conv = here
                turns.append((role, text))
                chars += len(text)
        if turns:
            yield closed(False)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(segments(batches), names, kinds, lambda row: len(row[4]) + 100)

    return task


def format_chats(chats: DataFrame, segment_chars: int = SEGMENT, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, segment, whole, text, loss): formatted conversations in segments of whole turns.

    The segments of a conversation in order of part and segment are its text; `loss` holds the
    spans of the assistant's texts in the segment, in code points. `whole` says that a segment is
    known to be all of its conversation. The table is written when this is called.
    """
    by_value(__name__)
    rows = chats.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        text_of(F.col(f"`{role_col}`")).alias("role"), text_of(F.col(f"`{text_col}`")).alias("text"))
    order = ["conv_id", "turn", "role", "hash"]
    ranged = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return written(ranged.select("conv_id", "role", "text").mapInArrow(_write(segment_chars), SEGMENTS), "chats")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in READ.split(", ")]
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]

    def rows() -> Iterator[tuple]:
        conv, state = None, None
        for batch in batches:
            for here, text, loss in zip(*(batch.column(c) for c in ("conv_id", "text", "loss")), strict=True):
                here, text = here.as_py(), text.as_py()
                if state is None or here != conv:
                    if state:
                        yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                    conv, state = here, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in loss.as_py():
                    learnt = unescape(text[span["start"]:span["start"] + span["length"]])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(text)
        if state:
            yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    yield from _batches(rows(), names, kinds)


def read_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from its formatted text: number of turns, digests of the turns and of the text under the mask, lengths."""
    by_value(__name__)
    columns = ["conv_id", "text", "loss"]
    alone = formatted.where("whole").select(columns).mapInArrow(_read, READ)
    parts = formatted.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    return alone.unionByName(parts.select(columns).mapInArrow(_read, READ))


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in TURNS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv, part, segment, text in zip(*(batch.column(c) for c in ("conv_id", "part", "segment", "text")), strict=True):
                for place, (role, said) in enumerate(parse(text.as_py())):
                    yield conv.as_py(), part.as_py(), segment.as_py(), place, role, said

    yield from _batches(rows(), names, kinds, lambda row: len(row[5]) + 100)


def read_turns(formatted: DataFrame) -> DataFrame:
    """The turns of formatted conversations, in order of (part, segment, place)."""
    by_value(__name__)
    return formatted.select("conv_id", "part", "segment", "text").mapInArrow(_turns, TURNS)
