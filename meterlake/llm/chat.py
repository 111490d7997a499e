"""Chat formatting by columnar byte assembly.

A template marks the turns: `<s>` opens a conversation's first turn, `<|role|>` a role, `</s>` ends a turn. In roles and texts a
backslash is doubled and every control string gets one after its first character, so no control string of a text survives and
the escape can be undone: a backslash stands for the character after it.

Rows come in the order of conversation and turn. Lengths of headers, texts and footers give cumulative offsets; numpy scatters
whole columns of bytes to their places in one buffer, which becomes the Arrow text column without another copy. A conversation is
one row unless it has more than PART_BYTES of text; then it is cut into parts at turns, so memory stays bounded.

Defined cases: null text and null role are empty; rows of one turn number are ordered by role, then text; repeated rows are
turns; a null conversation id is a conversation; an empty table gives no rows; extra columns are ignored.
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

from meterlake.llm.common import parallel, steps, table, text_bytes

PART_BYTES = 8 << 20
OPEN, ROLE, CLOSE = "<s>", "<|role|>", "</s>"
#: Control strings of this and of common templates, which texts may not hold (fixed values).
CONTROL = ("<s>", "</s>", "<|role|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"
FORMATTED = "conv_id long, part int, n_turns long, formatted string, loss array<struct<start:long,end:long>>"


def escape(column: pa.Array) -> pa.Array:
    """Doubles backslashes and breaks control strings after their first character."""
    column = pc.replace_substring(column, "\\", "\\\\")
    tails = "|".join(sorted({re.escape(c[1:]) for c in CONTROL if c[0] == "<"}, key=len, reverse=True))
    column = pc.replace_substring_regex(column, f"<({tails})", r"<\\\1")
    tails = "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == "[")
    return pc.replace_substring_regex(column, rf"\[({tails})", r"[\\\1")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copies text i of a column to out[at[i]:], all in one indexed store for each step of bounded size."""
    for first, last, part, own in steps(data, offsets):
        out[np.arange(len(part)) + np.repeat(at[first:last] - own[:-1], np.diff(own))] = part


def assemble(conv: np.ndarray, first: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted text per group of rows with equal `conv`; row numbers where groups begin; loss span (code points in its group) per row.

    `first` tells of each row whether it opens its conversation.
    """
    n = len(conv)
    # A header ends at its first bare line feed.
    role, role_at = text_bytes(pc.replace_substring(escape(roles), "\n", "\\\n"))
    body, body_at = text_bytes(escape(texts))
    opens = np.where(first, len(OPEN), 0)
    role_len, body_len = np.diff(role_at), np.diff(body_at)
    lengths = opens + len(ROLE) + role_len + 1 + body_len + len(CLOSE)
    ends = np.cumsum(lengths)
    at = ends - lengths
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    opened = np.flatnonzero(first)
    for k, c in enumerate(OPEN.encode()):
        out[at[opened] + k] = c
    for k, c in enumerate(ROLE.encode()):
        out[at + opens + k] = c
    role_to = at + opens + len(ROLE)
    out[role_to + role_len] = 0x0A
    body_to = role_to + role_len + 1
    for k, c in enumerate(CLOSE.encode()):
        out[body_to + body_len + k] = c
    scatter(out, role_to, role, role_at)
    scatter(out, body_to, body, body_at)
    begins = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1]))) if n else np.zeros(0, np.int64)
    edges = np.append(at[begins], len(out)).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(edges), pa.py_buffer(out)).cast(pa.string())
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    base = np.repeat(points[edges[:-1]], np.diff(np.append(begins, n)))
    spans = np.stack((points[body_to] - base, points[body_to + body_len] - base), 1) if n else np.zeros((0, 2), np.int64)
    return text, begins, edges, spans


def format_chat(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """conv_id, part, n_turns, formatted, loss (spans of the assistant's texts, escaped, in code points of `formatted`)."""
    spark = turns.sparkSession
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.repartition(partitions or parallel(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def part(held: pa.Table, numbers: dict) -> pa.RecordBatch:
        """One row for each conversation in `held`; numbers: of the conversation before, how many parts it has had."""
        ids = held.column("conv_id").combine_chunks()
        roles = held.column("role").combine_chunks().cast(pa.string())
        keys = np.stack((ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()), 1)
        conv = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(1))))
        begins = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        heads = ids.take(pa.array(begins)).to_pylist()
        again = numbers.get(heads[0], 0)
        first = np.zeros(len(conv), bool)
        first[begins] = True
        first[0] = again == 0
        text, begins, _, spans = assemble(conv, first, roles, held.column("text").combine_chunks())
        learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
        count = np.diff(np.append(begins, len(conv)))
        kept = np.concatenate(([0], np.cumsum(learned)))[np.append(begins, len(conv))]
        starts, ends = (pa.array(spans[learned, k]) for k in (0, 1))
        loss = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), pa.StructArray.from_arrays([starts, ends], ["start", "end"]))
        parts = [again] + [0] * (len(heads) - 1)
        last = parts[-1] + 1
        numbers.clear()
        numbers[heads[-1]] = last
        return pa.RecordBatch.from_arrays(
            [pa.array(heads, pa.int64()), pa.array(parts, pa.int32()), pa.array(count.astype(np.int64)), text, loss.cast(span)],
            names=["conv_id", "part", "n_turns", "formatted", "loss"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, numbers = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh])
            while held is not None and held.num_rows:
                # Emit all conversations but the last, which may go on; of a very long one, a part.
                ids = held.column("conv_id").combine_chunks()
                same = pc.equal(ids, ids[-1]) if ids[-1].is_valid else ids.is_null()
                last = held.num_rows - int(pc.sum(pc.fill_null(same, False)).as_py())
                sizes = np.cumsum(pc.binary_length(held.column("text")).to_numpy())
                big = int(np.searchsorted(sizes, PART_BYTES, "right"))
                cut = min(max(last, 0), max(big, 1)) if last else (big if 0 < big < held.num_rows else held.num_rows if big == 0 else 0)
                if not cut:
                    break
                yield part(held.slice(0, cut), numbers)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield part(held, numbers)

    return rows.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation or part."""
    turns = []
    for piece in formatted.split(CLOSE)[:-1]:
        piece = piece.removeprefix(OPEN).removeprefix(ROLE)
        at = re.match(r"(?:\\.|[^\\\n])*", piece, re.DOTALL).end()
        turns.append((unescape(piece[:at]), unescape(piece[at + 1 :])))
    return turns


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss mask, read from the formatted text alone; parts follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None

        def row(x: list) -> tuple:
            return x[0], x[1], x[2].hexdigest(), x[3], x[4].hexdigest(), x[5]

        for batch in batches:
            out = []
            for conv, part, text, loss in zip(
                *(batch.column(n).to_pylist() for n in ("conv_id", "part", "formatted", "loss")), strict=True
            ):
                if part == 0:
                    if now:
                        out.append(row(now))
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read_turns(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    learned = unescape(text[span["start"] : span["end"]])
                    now[3] += len(learned)
                    now[4].update(learned.encode())
                now[5] += len(text)
            if out:
                yield digests(out)
        if now:
            yield digests([row(now)])

    def digests(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return formatted.mapInArrow(run, DIGESTS)


def op10_chat_formatting(spark, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return read_back(format_chat(turns.unionByName(extra)))
