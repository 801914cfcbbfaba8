"""Conversations as training text: columnar byte assembly with a loss mask, and reading them back.

Every turn becomes HEAD role, line feed, text, TAIL. A text cannot contain a control string: a backslash is doubled,
and a control string is broken by a backslash and a semicolon behind its first character; both are undone on reading.
A line feed in a role is written as backslash n.

Turns are placed by ranges of (conv_id, turn), so that one conversation may lie in several tasks. Each task forms the
text of its batch in one buffer: segment lengths, their running sum, and scatter indices, all in numpy. What a batch
holds of a conversation is a piece; pieces in the order of (part, piece), joined, are the conversation's text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

HEAD, TAIL = "<|im_start|>", "<|im_end|>\n"
# Strings that have a meaning to one of the usual chat templates or tokenizers.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
            "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"

PIECE = "conv_id bigint, part int, piece int, n_turns int, formatted string, loss_start array<int>, loss_end array<int>"
_ESCAPED = re.compile(r"\\(.)")
_PLAIN = {"\\": "\\", ";": "", "n": "\n"}


def escape(text: pa.Array, role: bool = False) -> pa.Array:
    text = pc.replace_substring(text, "\\", "\\\\")
    if role:
        text = pc.replace_substring(text, "\n", "\\n")
    for control in CONTROLS:
        text = pc.replace_substring(text, control, control[0] + "\\;" + control[1:])
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text) if "\\" in text else text


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all turns, where each turn begins and the end, where each text begins) of escaped columns."""
    head, line, tail = (np.frombuffer(s.encode(), np.uint8) for s in (HEAD, "\n", TAIL))
    role_at, role_bytes = common.text_bytes(roles)
    text_at, text_bytes = common.text_bytes(texts)
    n = len(roles)
    lengths = np.empty((n, 5), dtype=np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(head), len(line), len(tail)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths.reshape(-1)).reshape(n, 5)
    starts = ends - lengths
    out = np.empty(int(lengths.sum()), dtype=np.uint8)
    for k, fixed in ((0, head), (2, line), (4, tail)):
        out[starts[:, k, None] + np.arange(len(fixed))] = fixed
    for k, at, source in ((1, role_at, role_bytes), (3, text_at, text_bytes)):
        out[common.gather(starts[:, k], lengths[:, k])] = source[common.gather(at[:-1], lengths[:, k])]
    return out, np.append(starts[:, 0], len(out)), starts[:, 3]


def format_conversations(turns: DataFrame) -> DataFrame:
    """Pieces of formatted text of (conv_id, turn, role, text), with the byte spans that the loss counts.

    A null role or text is the empty one; a null conv_id or turn is a value like any other and comes first. Rows of
    one turn are ordered by role and text, and repeated rows are repeated. An empty table gives no piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = 0
        for batch in (part for batch in batches for part in common.slices(batch)):
            n = batch.num_rows
            texts = escape(batch.column("text"))
            out, turn_at, text_at = assemble(escape(batch.column("role"), role=True), texts)
            ids = batch.column("conv_id")
            values = ids.fill_null(0).to_numpy()
            null = np.asarray(ids.is_null())
            first = np.flatnonzero(np.concatenate(
                ([True], (values[1:] != values[:-1]) | (null[1:] != null[:-1]))))
            bounds = np.append(first, n)
            piece_at = turn_at[bounds]
            learned = np.asarray(pc.equal(batch.column("role"), LEARNED))
            base = np.repeat(piece_at[:-1], np.diff(bounds))
            begin = (text_at - base)[learned]
            end = begin + np.diff(common.text_bytes(texts)[0])[learned]
            spans = np.concatenate(([0], np.cumsum(learned)))[bounds].astype(np.int32)
            k = len(first)
            formatted = pa.Array.from_buffers(
                pa.large_string(), k, [None, pa.py_buffer(piece_at.astype(np.int64)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(first)), pa.array([batch.column("part")[0].as_py()] * k, pa.int32()),
                pa.array(np.arange(piece, piece + k), pa.int32()), pa.array(np.diff(bounds), pa.int32()),
                formatted.cast(pa.string()),
                pa.ListArray.from_arrays(pa.array(spans), pa.array(begin, pa.int32())),
                pa.ListArray.from_arrays(pa.array(spans), pa.array(end, pa.int32())),
            ], names=[f.split()[0] for f in PIECE.split(", ")])
            piece += k

    common.ship(turns.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    keys = ("conv_id", "turn", "role", "text")
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", text("role"), text("text"))
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    return placed.mapInArrow(run, PIECE)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a piece."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(TAIL, line + 1)
        yield unescape(formatted[at + len(HEAD):line]), unescape(formatted[line + 1:end])
        at = end + len(TAIL)


def read_digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read from its pieces: turns, learned text, lengths.

    A digest runs over a conversation's text in order, so its pieces pass one task, as a stream: only the digest's
    state is held, and a piece is forgotten when it has been read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def row() -> pa.RecordBatch:
            values = [current, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        current, begun = None, False
        done: list[pa.RecordBatch] = []
        turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
        for batch in batches:
            for piece in batch.to_pylist():
                if not begun or piece["conv_id"] != current:
                    if begun:
                        done.append(row())
                    current, begun = piece["conv_id"], True
                    turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                text = piece["formatted"]
                raw = text.encode()
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    counts[0] += 1
                for a, b in zip(piece["loss_start"], piece["loss_end"]):
                    said = unescape(raw[a:b].decode())
                    loss.update(said.encode())
                    counts[1] += len(said)
                counts[2] += len(text)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                done = []
        if begun:
            yield row()

    common.ship(pieces.sparkSession)
    placed = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return placed.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                  "loss_sha256 string, formatted_chars bigint")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    known = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_digests(store(format_conversations(turns.unionByName(known)), "chat"))
