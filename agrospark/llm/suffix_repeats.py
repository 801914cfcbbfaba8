"""Maximal repeats of at least `SIZE` bytes across all documents, and texts without them.

Suffixes are sorted at anchors only. An anchor is the place with the least hash of 32 bytes among those in a
window of SIZE bytes; equal windows have their anchor at the same place, so windows need to be compared only if they
share the anchor's 32 bytes. The window starts with one anchor form a segment, a few hundred bytes of text.

1. Segments with equal text, found by their hash, are one class; a class keeps all its occurrences.
2. Classes with the same anchor bytes but different text meet in one task. Their suffixes from the anchor are sorted,
   neighbours' common prefixes are found, and a scan with a stack gives the interval tree: each node is a string
   behind the anchor and all classes that have it. Within a node the same is done to what stands before the anchor,
   read backwards: each interval there is left-diverse by its making (its members differ, or end, one byte further
   left), and is a maximal repeat if its members also differ to the right, that is, are not all in one child.
3. Anchor bytes with more than `LIMIT` classes (as at the edge of a passage that a third of all documents share) are
   split: the window starts are halved, and each half is keyed by all the bytes that its windows have in common. A
   half that is one window start has only equal windows, so this ends after at most nine halvings.
4. What is halved are the distinct contents of a round, not the classes: a content that many classes share is one row,
   with a list of the contents of the round before that it is a part of. Repeats and classes are not multiplied; what
   the repeats of a content cover goes back from part to whole, round by round.

A repeat that is longer than a segment is reported segment by segment; together they cover it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

SIZE, GRAM = 400, 32
REACH = SIZE - GRAM  # the furthest an anchor can be from the start of its window
LIMIT = 256
CHUNK = 4 << 20  # window starts that are worked on at once

SEGMENT = "doc_id bigint, h bigint, start int, size int, rel int, key bigint, c1 bigint, c2 bigint"
CONTENT, WHOLE = ["key", "c1", "c2"], ["of_key", "of_c1", "of_c2"]
REPEAT = "repeat string, key bigint, c1 bigint, c2 bigint, before int, after int"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    n = len(data) - GRAM + 1
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h = np.zeros(n, dtype=np.uint64)
    for k in range(0, GRAM, 8):
        h ^= eight[k:k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` values: minima from both ends of blocks, two of which make up a run."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def segments_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first window start, last, anchor, hash at the anchor) of the texts in a buffer."""
    found = []
    last = len(data) - SIZE
    for low in range(0, last + 1, CHUNK):
        high = min(low + CHUNK, last + 1)  # window starts low..high-1
        hashes = gram_hashes(data[low:high + SIZE - 1])
        place = np.arange(len(hashes), dtype=np.uint64)
        least = window_minima(hashes >> np.uint64(24) << np.uint64(24) | place, REACH + 1) & np.uint64(0xFFFFFF)
        least = least.astype(np.int64)
        inside = offsets[(offsets >= low) & (offsets < high)]
        first = np.unique(np.concatenate(([low], np.flatnonzero(np.diff(least)) + 1 + low, inside)))
        doc = np.searchsorted(offsets, first, "right") - 1
        end = np.minimum(np.append(first[1:], high) - 1, offsets[doc + 1] - SIZE)
        keep = end >= first
        first, end, doc = first[keep], end[keep], doc[keep]
        at = least[first - low]
        found.append((doc, first, end, at + low, hashes[at].view(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*found))


def segments(docs: DataFrame) -> DataFrame:
    """The segments of (doc_id, h, text): where they are, where their anchor is, and hashes of both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for batch in batches for piece in common.slices(batch)):
            offsets, data = common.text_bytes(batch.column("text"))
            if len(data) < SIZE:
                continue
            doc, first, end, anchor, core = segments_of(data, offsets)
            raw, digest = memoryview(data), xxhash.xxh3_128_digest
            content = b"".join([digest(raw[a:b]) for a, b in zip(first.tolist(), (end + SIZE).tolist())])
            content = np.frombuffer(content, "<i8").reshape(-1, 2)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(rows), batch.column("h").take(rows),
                pa.array(first - offsets[doc], pa.int32()), pa.array(end - first + SIZE, pa.int32()),
                pa.array(anchor - first, pa.int32()), pa.array(core), pa.array(content[:, 0].copy()),
                pa.array(content[:, 1].copy()),
            ], names=[f.split()[0] for f in SEGMENT.split(", ")])

    return docs.mapInArrow(run, SEGMENT)


def common_prefixes(rows: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For rows in an order, how many bytes each has in common with the one before (the first: 0)."""
    out = np.zeros(len(order), dtype=np.int64)
    step = max(1, (8 << 20) // max(rows.shape[1], 1))
    for a in range(1, len(order), step):
        mine, before = order[a:a + step], order[a - 1:a - 1 + len(order[a:a + step])]
        other = rows[mine] != rows[before]
        first = np.where(other.any(axis=1), other.argmax(axis=1), rows.shape[1])
        out[a:a + step] = np.minimum(first, np.minimum(lengths[mine], lengths[before]))
    return out


def intervals(prefixes: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the intervals of a sorted list whose members share at least `least` bytes.

    prefixes[i] is what members i-1 and i share; the scan closes an interval when the shared length falls.
    """
    open_at: list[tuple[int, int]] = []  # (length, first)
    for i in range(1, len(prefixes) + 1):
        shared = prefixes[i] if i < len(prefixes) else -1
        first = i - 1
        while open_at and open_at[-1][0] > shared:
            length, first = open_at.pop()
            yield length, first, i - 1
        if shared >= least and (not open_at or open_at[-1][0] < shared):
            open_at.append((shared, first))


def _matrix(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    width = max(map(len, parts), default=0) or 1
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(-1, width), lengths


def maximal_repeats(keys: np.ndarray, data: list[bytes], rel: list[int]) -> Iterator[tuple[list[int], int, int]]:
    """(members, bytes before the anchor, bytes from it) of the maximal repeats among segments with equal keys."""
    after, after_len = _matrix([d[r:] for d, r in zip(data, rel)])
    before, before_len = _matrix([d[:r][::-1] for d, r in zip(data, rel)])
    named = keys.astype(">i8").view(np.uint8).reshape(-1, 8)
    text = lambda m: np.ascontiguousarray(np.hstack([named, m])).view(f"S{8 + m.shape[1]}").reshape(-1)
    suffixes = np.argsort(text(after), kind="stable")
    left_rank = np.empty(len(keys), dtype=np.int64)
    left_rank[np.argsort(text(before), kind="stable")] = np.arange(len(keys))
    shared = common_prefixes(after, after_len, suffixes)
    shared[1:][keys[suffixes[1:]] != keys[suffixes[:-1]]] = 0
    for length, a, b in intervals(shared.tolist(), GRAM):
        members = suffixes[a:b + 1]
        place = np.argsort(left_rank[members])
        members, at = members[place], place + a
        left = common_prefixes(before, before_len, members)
        if left.max() + length < SIZE:
            continue
        for back, i, j in intervals(left.tolist(), SIZE - length):
            low, high = at[i:j + 1].min(), at[i:j + 1].max()
            if shared[low + 1:high + 1].min() == length:  # not all in one child
                yield members[i:j + 1].tolist(), back, length


def _repeats(table: pa.Table) -> pa.Table:
    columns = {c: np.asarray(table[c]) for c in ("key", "c1", "c2")}
    names, rows, sizes, back, ahead = [], [], [], [], []
    bucket = table["bucket"][0].as_py()
    for members, before, after in maximal_repeats(columns["key"], table["data"].to_pylist(), table["rel"].to_pylist()):
        names.append(f"{bucket}-{len(names)}")
        rows.extend(members)
        sizes.append(len(members))
        back.append(before)
        ahead.append(after)
    of = np.repeat(np.arange(len(names)), sizes).astype(np.int64)
    return pa.table([
        pa.array(names, pa.string()).take(pa.array(of)), *(pa.array(columns[c][rows] if rows else [], pa.int64()) for c in columns),
        pa.array(np.asarray(back, np.int32)[of]), pa.array(np.asarray(ahead, np.int32)[of])],
        names=[f.split()[0] for f in REPEAT.split(", ")])


def _among(contents: DataFrame) -> DataFrame:
    """The maximal repeats among distinct contents (key, c1, c2, rel, data), many keys to a task."""
    buckets = max(1, math.ceil(contents.count() / 500))
    placed = contents.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    return placed.groupBy("bucket").applyInArrow(_repeats, REPEAT)


def _halves(contents: DataFrame) -> DataFrame:
    """Contents with the range of their windows' anchor distances halved, keyed by what all windows of a half share."""
    r, c = F.col, F.substring
    least = r("rel") - (F.octet_length("data") - SIZE)  # of the content's own windows, rel is the furthest
    middle = F.floor((r("low") + r("high")) / 2).cast("int")
    halves = contents.withColumn("half", F.explode(F.array(
        F.struct(r("low").alias("low"), middle.alias("high")),
        F.struct((middle + 1).alias("low"), r("high").alias("high"))))) \
        .withColumn("near", F.greatest(r("half.low"), least)).withColumn("far", F.least(r("half.high"), r("rel"))) \
        .where("near <= far and half.low <= half.high")
    core = c("data", r("rel") - r("half.low") + 1, SIZE - r("half.high") + r("half.low"))
    data = c("data", r("rel") - r("far") + 1, r("far") - r("near") + SIZE)
    return halves.select(
        *(r(a).alias(b) for a, b in zip(CONTENT, WHOLE)), r("half.low").alias("low"), r("half.high").alias("high"),
        r("far").alias("rel"), F.xxhash64(r("half.low"), r("half.high"), core).alias("key"),
        F.xxhash64(data, F.lit(1)).alias("c1"), F.xxhash64(F.lit(2), data).alias("c2"), data.alias("data"))


def _equal(rel: str, size: Column) -> list[Column]:
    """The repeat that equal contents are of each other."""
    name = F.concat(F.lit("="), *(F.hex(c) for c in CONTENT)).alias("repeat")
    return [name, *map(F.col, CONTENT), F.col(rel).alias("before"), (size - F.col(rel)).cast("int").alias("after")]


def class_repeats(classes: DataFrame, limit: int = LIMIT) -> tuple[list[DataFrame], list[DataFrame]]:
    """By round, (repeat, key, c1, c2, before, after): which contents have which maximal repeat; and by round from the
    second on, (key, c1, c2, of_key, of_c1, of_c2): of which contents of the round before they are a part.

    classes: (key, c1, c2, rel, data), distinct; they are the contents of the first round. Groups of more than `limit`
    go on to be halved.
    """
    contents = classes.select(*CONTENT, F.lit(1).alias("n"), F.lit(0).alias("low"), F.lit(REACH).alias("high"), "rel", "data")
    repeats, parts = [], []
    while True:
        large = contents.groupBy("key").count().where(F.col("count") > limit).select("key")
        found = _among(contents.join(large, "key", "left_anti").select(*CONTENT, "rel", "data"))
        # Equal contents repeat each other; halves may be equal where the wholes are not.
        same = contents.where("n > 1").select(*_equal("rel", F.octet_length("data")))
        repeats.append(store(found.unionByName(same), "repeats-found"))
        if large.isEmpty():
            return repeats, parts
        halves = store(_halves(contents.join(large, "key", "left_semi")), "repeat-halves")
        parts.append(halves.select(*CONTENT, *WHOLE))
        one = (F.first(c).alias(c) for c in ("low", "high", "rel", "data"))
        contents = store(halves.groupBy(*CONTENT).agg(F.count("*").alias("n"), *one), "repeat-contents")


def repeat_groups(docs: DataFrame, limit: int = LIMIT) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """The repeats and parts of class_repeats, and the occurrences of classes, of (doc_id, h, text); joined on CONTENT
    and from part to whole, they are all maximal repeat groups with all their occurrences."""
    all_segments = store(segments(docs), "segments")
    cores = store(all_segments.groupBy("key").agg(F.count("*").alias("n"), F.min("c1").alias("a"), F.max("c1").alias("b"))
                  .where("n > 1").select("key", (F.col("a") != F.col("b")).alias("mixed")), "repeated-cores")
    found = store(all_segments.join(cores, "key"), "repeat-segments")
    place = F.struct("doc_id", "h", "start", "size", "rel")
    classes = store(found.groupBy(*CONTENT, "mixed").agg(F.count("*").alias("n"), F.min(place).alias("at")), "classes")
    one = classes.where("mixed").select(
        F.col("at.doc_id").alias("doc_id"), F.col("at.h").alias("h"),
        F.struct(*CONTENT, F.col("at.rel").alias("rel"), F.col("at.start").alias("start"),
                 F.col("at.size").alias("size")).alias("cut"))
    wanted = one.groupBy("doc_id", "h").agg(F.collect_list("cut").alias("cuts"))
    texts = docs.alias("d").join(wanted.alias("w"), _same_document(), "inner") \
        .select(F.col("d.text").cast("binary").alias("text"), F.explode("w.cuts").alias("cut"))
    data = texts.select(*(f"cut.{c}" for c in CONTENT), "cut.rel",
                        F.substring("text", F.col("cut.start") + 1, F.col("cut.size")).alias("data"))
    # Repeated rows of the table would give a class twice.
    data = store(data.dropDuplicates(CONTENT), "class-texts")
    repeats, parts = class_repeats(data, limit)
    same = classes.where("n > 1").select(*_equal("at.rel", F.col("at.size")))
    return [repeats[0].unionByName(same), *repeats[1:]], parts, found


def class_cover(repeats: list[DataFrame], parts: list[DataFrame]) -> DataFrame:
    """(key, c1, c2, before, after): how far the repeats of a class, or of its parts, reach from the anchor."""
    covered = None
    for found, halves in zip(reversed(repeats), [None, *reversed(parts)]):
        found = found.select(*CONTENT, "before", "after")
        if halves is not None:
            up = covered.join(halves, CONTENT).select(*(F.col(w).alias(c) for c, w in zip(CONTENT, WHOLE)), "before", "after")
            found = found.unionByName(up)
        covered = found.groupBy(*CONTENT).agg(F.max("before").alias("before"), F.max("after").alias("after"))
    return covered


def _same_document() -> Column:
    return F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.h") == F.col("w.h"))


def repeated_spans(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, h and `spans` (begin, end): the bytes of each document that a repeated string of SIZE bytes covers."""
    repeats, parts, occurrences = repeat_groups(docs, limit)
    # All windows of a segment hold its anchor, so what its repeats cover is one run of bytes.
    covered = store(class_cover(repeats, parts), "covered")
    anchor = F.col("start") + F.col("rel")
    return occurrences.join(covered, CONTENT).select(
        "doc_id", "h", F.struct((anchor - F.col("before")).alias("begin"), (anchor + F.col("after")).alias("end")).alias("span")) \
        .groupBy("doc_id", "h").agg(F.collect_list("span").alias("spans"))


def remove_repeats(docs: DataFrame, kept: bool = True, limit: int = LIMIT) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, the `kept` bytes.

    A byte goes if a string of SIZE bytes that covers it also begins anywhere else, in this document or another. A
    null text is the empty one. Repeated rows are repeats of each other. Shorter texts stay as they are.
    """
    common.ship(docs.sparkSession)
    rows = common.texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    spans = repeated_spans(rows, limit)
    joined = rows.alias("d").join(spans.alias("w"), _same_document(), "left").select("d.doc_id", "d.text", "w.spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            texts = batch.column("text").cast(pa.binary())
            spans = batch.column("spans")
            for i in range(batch.num_rows):
                text = texts[i].as_buffer()
                begin, end = _union(spans[i].values) if spans[i].is_valid else (np.zeros(0, np.int64),) * 2
                left = hashlib.sha256()
                pieces = [text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), text.size])]
                for piece in pieces:
                    left.update(piece)
                for column, value in zip(out, (text.size, int((end - begin).sum()), len(begin), left.hexdigest(),
                                               b"".join(pieces) if kept else None)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, kinds))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                                  "kept binary")
    return done if kept else done.drop("kept")


def _union(spans: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that touch or overlap, joined."""
    begin, end = (np.asarray(spans.field(i)).astype(np.int64) for i in (0, 1))
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], begin[1:] > end[:-1]))
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def op2_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.table(spark, sf_dir, "documents"), kept=False)
