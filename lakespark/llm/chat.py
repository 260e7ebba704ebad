"""Conversations as training text, assembled column by column into one Arrow buffer.

A turn reads ``### Role: text</turn>`` and a line break, where the role's first letter is
upper-case; one that was upper-case already has a backslash before it. Inside roles and texts a
backslash follows every ``\\``, ``#``, ``<`` and (in roles) ``:``. So no mark can stand inside a text, not even
as part of an escaped one, and the original comes back by dropping those backslashes.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespark.llm.common import flat, lists, slices, strings

HEAD, AFTER_ROLE, END = b"### ", b": ", b"</turn>\n"
LEARNED_ROLE = "assistant"

_IN_TEXT = np.zeros(256, dtype=np.int64)
_IN_TEXT[[ord(c) for c in "\\#<"]] = 1
_IN_ROLE = _IN_TEXT.copy()
_IN_ROLE[ord(":")] = 1
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_CONTINUES = np.zeros(256, dtype=np.int64)
_CONTINUES[128:192] = 1


def _escaped(column: pa.Array, table: np.ndarray, is_role: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets with a backslash after every byte that ``table`` marks."""
    data, offsets = flat(column)
    extra = table[data]
    lead = np.zeros(len(data), dtype=np.int64)
    if is_role:
        data = data.copy()
        first = offsets[:-1][np.diff(offsets) > 0]
        lead[first] = _UPPER[data[first]]
        extra = extra + lead
        lower = first[(data[first] >= 97) & (data[first] <= 122)]
        data[lower] -= 32
    total = np.concatenate(([0], np.cumsum(extra)))
    out = np.full(len(data) + int(total[-1]), ord("\\"), dtype=np.uint8)
    out[np.arange(len(data)) + total[:-1] + lead] = data
    return out, offsets + total[offsets]


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy row ``i`` of (data, offsets) to place ``to[i]`` of ``out``."""
    out[np.arange(len(data)) + np.repeat(to - offsets[:-1], np.diff(offsets))] = data


def assemble(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Formatted text, and the starts and ends (code points) of learned spans, of each conversation.

    ``first`` holds the row at which each conversation starts, and the number of rows.
    """
    n = len(texts)
    role, role_at = _escaped(roles, _IN_ROLE, True)
    text, text_at = _escaped(texts, _IN_TEXT, False)
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    sizes = len(HEAD) + role_size + len(AFTER_ROLE) + text_size + len(END)
    at = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(int(at[-1]), dtype=np.uint8)
    begin = at[:-1]
    text_begin = begin + len(HEAD) + role_size + len(AFTER_ROLE)
    for mark, place in ((HEAD, begin), (AFTER_ROLE, text_begin - len(AFTER_ROLE)), (END, text_begin + text_size)):
        out[place[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    _scatter(out, begin + len(HEAD), role, role_at)
    _scatter(out, text_begin, text, text_at)
    # code points before each byte
    points = np.arange(len(out) + 1) - np.concatenate(([0], np.cumsum(_CONTINUES[out])))
    learned = np.flatnonzero(pc.fill_null(pc.equal(roles, LEARNED_ROLE), False).to_numpy(zero_copy_only=False))
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))[learned] if n else np.zeros(0, np.int64)
    base = points[at[first[:-1]]]
    counts = np.bincount(of, minlength=len(first) - 1)
    starts = points[text_begin[learned]] - base[of]
    ends = points[(text_begin + text_size)[learned]] - base[of]
    return strings(out, at[first]), lists(starts, counts, pa.int64()), lists(ends, counts, pa.int64())


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, and loss_starts and loss_ends of the learned spans in code points.

    One row for each conv_id of ``turns`` (conv_id, turn, role, text), null included; rows in the
    order of turn, role, text, nulls first. A null role or text counts as empty; repeated rows are
    repeated turns. Other columns are ignored, and an empty table gives no rows. Rows reach a task
    sorted, and it holds one batch and the conversation that continues; a conversation
    of any length must fit in one string, since it is one.
    """

    def build(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        ids = part.column("conv_id").combine_chunks()
        first = np.append(_starts(ids), part.num_rows)
        columns = assemble(part.column("role").combine_chunks(), part.column("text").combine_chunks(), first)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(first[:-1])), *columns], ["conv_id", "formatted", "loss_starts", "loss_ends"])

    def run(batches):
        rest = []  # parts of the conversation that may go on in the next one
        for batch in batches:
            for part in slices(batch):
                starts = _starts(part.column("conv_id"))
                if rest and rest[-1].column("conv_id")[-1].as_py() == part.column("conv_id")[0].as_py():
                    starts = starts[1:]
                if len(starts):
                    head = [*rest, *([part.slice(0, int(starts[-1]))] if starts[-1] else [])]
                    if head:
                        yield build(pa.Table.from_batches(head))
                    rest = [part.slice(int(starts[-1]))]
                else:
                    rest.append(part)
        if rest:
            yield build(pa.Table.from_batches(rest))

    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return dealt.mapInArrow(run, f"conv_id {kind}, formatted string, loss_starts array<long>, loss_ends array<long>")


def _starts(ids: pa.Array) -> np.ndarray:
    """Rows at which a value differs from the row before, nulls being equal."""
    if len(ids) == 1:
        return np.zeros(1, np.int64)
    a, b = ids.slice(0, len(ids) - 1), ids.slice(1)
    same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], 1 + np.flatnonzero(~same)))


# possessive: nothing is kept to go back to, however long a turn
_TURN = re.compile(r"### ((?:\\[A-Z])?(?:[^\\#<:]++|[\\#<:]\\)*+): ((?:[^\\#<]++|[\\#<]\\)*+)</turn>\n", re.S)
_IN_TEXTS, _IN_ROLES = re.compile(r"([\\#<])\\"), re.compile(r"([\\#<:])\\")


def unescape(text: str) -> str:
    return _IN_TEXTS.sub(r"\1", text)


def _role(written: str) -> str:
    if "A" <= written[:1] <= "Z":
        written = written[0].lower() + written[1:]
    elif written[:1] == "\\" and "A" <= written[1:2] <= "Z":
        written = written[1:]
    return _IN_ROLES.sub(r"\1", written)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation; raises ValueError if it is none."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((_role(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each formatted conversation, taken from the formatted text and its spans alone."""

    def run(batches):
        for batch in batches:
            rows = {name: [] for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("formatted", "loss_starts", "loss_ends")), strict=True):
                turns = parse(text)
                digest = hashlib.sha256()
                for role, said in turns:
                    digest.update(f"{role}\n{said}\n".encode())
                learned = "".join(unescape(text[a:b]) for a, b in zip(starts, ends, strict=True))
                values = (len(turns), digest.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text))
                for name, value in zip(rows, values, strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), **rows})

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
