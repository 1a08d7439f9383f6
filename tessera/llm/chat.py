"""Chat formatting by columnar byte assembly.

Rows are dealt by conversation and sorted by turn inside each task; a batch of
turns is formatted at once: segment lengths, cumulative offsets and scatter
indices are numpy arrays, and headers, roles, contents and footers are copied
into one preallocated buffer that becomes an Arrow string column (whose
offsets are the conversation ends).  A conversation longer than a batch comes
out in parts, so no task ever holds a whole hot conversation.

Template of a turn: ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``.  A
control string inside a role or text, ``<|``, ``<s>``, ``</s>``, ``[INST]`` or
``[/INST]``, gets one backslash after its first character; where backslashes
stand there already, one more.  Taking one away reverses it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's marks and the control strings' pattern (start, backslashes, rest).
OPEN, MIDDLE, CLOSE = b"<|im_start|>", b"\n", b"<|im_end|>\n"
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
TRAINED_ROLE = "assistant"
#: Bytes of formatted text after which a conversation continues in a further part.
PART_BYTES = 8 << 20

_ESCAPED = re.compile(r"([<\[])\\(\\*)(\||/?s>|/?INST\])")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape_column(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def escape_roles(column: pa.Array) -> pa.Array:
    """Roles stand on one line: backslash and newline are written as two characters, then control strings."""
    column = pc.replace_substring(column, "\\", "\\\\")
    return escape_column(pc.replace_substring(column, "\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, lengths) of a string column, seen as numpy arrays."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    view = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return view, at[:-1], np.diff(at)


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Copy variable pieces: piece i of ``data`` goes to ``to[i]``."""
    if not len(lengths):
        return
    if lengths.max() > 1 << 16 or lengths.sum() > 4 << 20:  # long pieces: plain slices need no index
        for a, b, n in zip(to.tolist(), starts.tolist(), lengths.tolist()):
            out[a:a + n] = data[b:b + n]
        return
    shift = np.repeat(to - starts, lengths)
    ends = np.cumsum(lengths)
    source = np.arange(int(ends[-1])) - np.repeat(ends - lengths - starts, lengths)
    out[source + shift] = data[source]


def assemble(roles: pa.Array, texts: pa.Array, breaks: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Format turns (escaped roles and texts) into one string per group of rows.

    ``breaks``: first row of each group, then the row count.  Also returns the
    byte places of each content in the whole buffer and their lengths.
    """
    role_data, role_at, role_len = _bytes_of(roles)
    text_data, text_at, text_len = _bytes_of(texts)
    fixed = len(OPEN) + len(MIDDLE) + len(CLOSE)
    ends = np.cumsum(role_len + text_len + fixed)
    begins = ends - (role_len + text_len + fixed)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    role_to = begins + len(OPEN)
    middle_to = role_to + role_len
    text_to = middle_to + len(MIDDLE)
    for to, mark in ((begins, OPEN), (middle_to, MIDDLE), (text_to + text_len, CLOSE)):
        out[to[:, None] + np.arange(len(mark))] = np.frombuffer(mark, dtype=np.uint8)
    _scatter(out, role_to, role_data, role_at, role_len)
    _scatter(out, text_to, text_data, text_at, text_len)
    offsets = np.concatenate([[0], ends])[breaks].astype(np.int64)
    column = pa.LargeStringArray.from_buffers(len(breaks) - 1, pa.py_buffer(offsets), pa.py_buffer(out))
    return column, text_to, text_len


_PARTS = ("conv_id long, part long, formatted string, first_turn boolean, "
          "loss_starts array<long>, loss_lengths array<long>")


def _parts(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Slices of a sorted batch that give at most about ``PART_BYTES`` of text each."""
    size = pc.add(pc.fill_null(pc.binary_length(batch.column("text")), 0), 64).to_numpy(zero_copy_only=False)
    total = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + PART_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def format_conversations(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """(conv_id, turn, role, text) -> formatted parts of conversations, in order.

    Columns: conv_id, part (from 0), formatted, first_turn (the part begins
    the conversation), and the byte places and lengths, in ``formatted``, of
    the escaped contents under the loss mask.  Rows go by turn, then role, then
    text, nulls last; a null text is empty, a null role the empty role; a null
    conv_id is a conversation like any other; extra columns are ignored; an
    empty table gives an empty result.  All parts of a conversation are in one
    partition, in order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: object = ()
        part = 0
        for whole in batches:
            for b in _parts(whole):
                ids = b.column("conv_id").to_pylist()
                roles = pc.fill_null(b.column("role"), "")
                escaped = escape_column(pc.fill_null(b.column("text"), ""))
                first = np.array([i == 0 or ids[i] != ids[i - 1] for i in range(len(ids))])
                breaks = np.concatenate([np.flatnonzero(first), [len(ids)]])
                column, to, length = assemble(escape_roles(roles), escaped, breaks)
                trained = pc.equal(roles, trained_role).to_numpy(zero_copy_only=False)
                group = np.cumsum(first) - 1
                base = np.frombuffer(column.buffers()[1], dtype=np.int64)[:-1]
                owners = [ids[i] for i in breaks[:-1]]
                numbers, starts = [], []
                for i, owner in enumerate(owners):
                    fresh = i > 0 or owner != last
                    part = 0 if fresh else part + 1
                    numbers.append(part)
                    starts.append(fresh)
                last = owners[-1]
                in_group = np.bincount(group[trained], minlength=len(owners))
                at = np.concatenate([[0], np.cumsum(in_group)]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(v.astype(np.int64)))
                         for v in ((to - base[group])[trained], length[trained])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners, pa.int64()), pa.array(numbers, pa.int64()), column.cast(pa.string()),
                     pa.array(starts), *lists],
                    names=["conv_id", "part", "formatted", "first_turn", "loss_starts", "loss_lengths"])

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        "role", "text")
    order = [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "role", "text")]
    return (rows.repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "role", "text").mapInArrow(run, _PARTS))


def read_back(parts: DataFrame) -> DataFrame:
    """Digest of each conversation from its formatted parts, turn by turn.

    ``turns_sha256``: of role, newline, text, newline per turn; ``loss_*``: of
    all unescaped text under the mask.  Only hash states are held, so the
    length of a conversation does not matter.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def emit(done: list) -> pa.RecordBatch:
            columns = list(zip(*[(s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]) for s in done]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for b in batches:
            done = []
            for row in b.to_pylist():
                if row["first_turn"]:
                    if state is not None:
                        done.append(state)
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                state[5] += len(text)
                place = 0
                for m in _TURN.finditer(text):
                    if m.start() != place:
                        raise ValueError("formatted text does not follow the template")
                    place = m.end()
                    state[1] += 1
                    state[2].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                if place != len(text):
                    raise ValueError("formatted text does not follow the template")
                raw = text.encode()
                for at, n in zip(row["loss_starts"], row["loss_lengths"]):
                    content = unescape(raw[at:at + n].decode())
                    state[3] += len(content)
                    state[4].update(content.encode())
            if done:
                yield emit(done)
        if state is not None:
            yield emit([state])

    return parts.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long")
