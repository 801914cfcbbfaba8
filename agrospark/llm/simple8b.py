"""Token ids in a compact binary file: Simple-8b words with escapes and per-block offsets.

A 64-bit word holds a selector in its top four bits and as many equal-width ids as fit the other 60. Ids are
packed in blocks of `BLOCK` ids; every block starts a new word, so a page is decoded for all its words at once.
An id of more than 60 bits is an escape: selector 0, the id itself stands in the page's escape list.

A file is a folder of pages, one row each: the documents with their ids and lengths, where each block begins, the
words and the escapes. Pages are in ascending order of doc_id (null first, repeated ids side by side).
"""

from __future__ import annotations

import functools
import itertools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from agrospark.llm import common
from agrospark.sources.files import scratch_dir

BLOCK = 1024
PAGE_IDS = 1 << 20  # ids of a page, about
JOINED = 4000  # words that the tokenizer is given as one text
# Fixed values of the format: ids per word and bits per id, by selector; selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.uint64)

PAGE = ("part int, page int, doc_ids array<bigint>, lengths array<int>, n_ids bigint, "
        "offsets binary, words binary, escapes binary")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block and the end, escapes) of 64-bit unsigned ids.

    All blocks are walked in step: each step takes from every block the word with the most ids that fit.
    """
    ids = ids.astype(np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32), np.zeros(0, np.uint64)
    large = ids >> np.uint64(60) > 0
    blocks, row = -(-n // BLOCK), BLOCK + int(COUNTS.max())
    widths = np.zeros((blocks, row), dtype=np.uint8)  # what stands after a block's end has width 0
    exact = np.frexp(ids.astype(np.float64))[1]  # bits of an id; doubles may round a long one up
    exact = np.where(large, 64, np.minimum(exact, 60)).astype(np.uint8)
    padded = np.zeros(blocks * BLOCK, dtype=np.uint8)
    padded[:n] = exact
    widths[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    flat = widths.reshape(-1)
    block = np.arange(blocks)
    place = block * row
    limit = place + np.minimum(BLOCK, n - block * BLOCK)
    by_count = range(len(COUNTS) - 2, 0, -1)  # selectors from 2 ids up
    steps = []
    while len(place):
        chosen = np.where(flat[place] > 60, 0, len(COUNTS) - 1).astype(np.int8)
        alive, most, seen = np.arange(len(place)), flat[place], 1
        for s in by_count:
            at = place[alive]
            while seen < COUNTS[s]:
                most = np.maximum(most, flat[at + seen])
                seen += 1
            fits = most <= BITS[s]
            alive, most = alive[fits], most[fits]
            if not len(alive):
                break
            chosen[alive] = s
        steps.append((block, place, chosen))
        place = place + COUNTS[chosen]
        left = place < limit[block]
        place, block = place[left], block[left]
    block, place, chosen = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(place, kind="stable")
    selectors = chosen[order].astype(np.int64)
    starts = (place - block * (row - BLOCK))[order]
    word_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    slot = (np.arange(n) - starts[word_of]).astype(np.uint64)
    shifted = np.where(large, np.uint64(0), ids) << (slot * BITS[selectors[word_of]])
    words = np.bitwise_or.reduceat(shifted, starts) | (selectors.astype(np.uint64) << np.uint64(60))
    per_block = np.bincount(block, minlength=blocks)
    return words, np.concatenate(([0], np.cumsum(per_block))).astype(np.uint32), ids[large]


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids again, all words at once."""
    if n_ids == 0:
        return np.zeros(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    word_of = np.repeat(np.arange(len(words)), counts)
    before = np.cumsum(counts) - counts
    slot = np.arange(len(word_of)) - before[word_of]
    bits = BITS[selectors[word_of]]
    ids = words[word_of] >> (slot.astype(np.uint64) * bits) & ((np.uint64(1) << bits) - np.uint64(1))
    # A block's last word may hold unused slots.
    block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets.astype(np.int64)))
    base = before[offsets[:-1].astype(np.int64)]
    inside = np.arange(len(word_of)) - base[block[word_of]]
    used = inside < np.minimum(BLOCK, n_ids - block[word_of] * BLOCK)
    if len(escapes):
        ids[selectors[word_of] == 0] = escapes
    return ids[used]


class WordEncoder:
    """Ids of texts by the tokenizers library, which sees a word once.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its words in order. It
    also parts a Latin letter or digit from the sign behind it, so a blank between them changes nothing; bars,
    angle brackets and apostrophes, which special tokens and contractions contain, are left as they are. Words
    seen before are remembered; beyond `limit` all are forgotten and encoded again.
    """

    def __init__(self, name: str, limit: int = 1_000_000):
        path = common.tokenizer_path(name)
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.limit = limit
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)  # ids that end a word
        self.ends[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes, self.pool = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _numbers(self, distinct: list[str]) -> np.ndarray:
        """Numbers of words, whose ids are then in the pool."""
        if len(self.known) > self.limit:
            self._forget()
        new = [w for w in distinct if w not in self.known]
        letters = [w for w in new if w.isalpha()] if self.ends.any() else []
        other = [w for w in new if not w.isalpha()] if letters else new
        groups = [letters[i:i + JOINED] for i in range(0, len(letters), JOINED)]
        parts = [self._joined(some) or self._each(some) for some in groups] + [self._each(other)]
        for some in (*groups, other):
            self.known.update(zip(some, range(len(self.known), len(self.known) + len(some))))
        self.sizes = np.concatenate([self.sizes, *(p[0] for p in parts)])
        self.pool = np.concatenate([self.pool, *(p[1] for p in parts)])
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))

    def _each(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, ids)."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)] if some else []
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return sizes, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum()))

    def _joined(self, some: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same for words of letters only, encoded as one text: each has one id that ends a word, its last."""
        ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, dtype=np.uint32)
        last = np.flatnonzero(self.ends[ids])
        return (np.diff(last, prepend=-1), ids) if len(last) == len(some) else None

    def __call__(self, text: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, ids of all), each text followed by end_id if there is one."""
        parted = pc.replace_substring_regex(text, r"([A-Za-z0-9])([.,;:!?$&%*#()])", r"\1 \2")
        bounds, codes, distinct = common.split_words(parted)
        codes = self._numbers(distinct.to_pylist())[codes]
        sizes, pool = self.sizes, self.pool
        if end_id is not None:  # one more word, the end, after the words of each text
            codes = np.insert(codes, bounds[1:], len(sizes))
            bounds = bounds + np.arange(len(bounds))
            sizes, pool = np.append(sizes, 1), np.append(pool, np.uint32(end_id))
        starts = np.cumsum(sizes) - sizes
        all_ids = pool[common.gather(starts[codes], sizes[codes])]
        upto = np.concatenate(([0], np.cumsum(sizes[codes])))
        return np.diff(upto[bounds]), all_ids


@functools.lru_cache(maxsize=2)
def word_encoder(name: str) -> WordEncoder:
    """One encoder for all tasks of a worker process."""
    return WordEncoder(name)


def write_ids(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int | None = 1) -> None:
    """Encode every whole text of (doc_id, text) and write its ids under `path`.

    Null and empty texts have the end id only. An empty table gives a folder without pages. Rows are placed by
    ranges of doc_id, so a source or language with many rows is spread like any other.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        page = 0
        for batch in (piece for batch in batches for piece in common.slices(batch, size=12 << 20)):
            sizes, all_ids = encoder(batch.column("text"), end_id)
            upto = np.concatenate(([0], np.cumsum(sizes)))
            part = upto[:-1] // PAGE_IDS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                ids = all_ids[upto[a]:upto[b]]
                packed, offsets, escapes = pack(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("part")[0].as_py()], pa.int32()), pa.array([page], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column("doc_id").slice(a, b - a)),
                    pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.array(sizes[a:b], pa.int32())),
                    pa.array([len(ids)], pa.int64()), pa.array([offsets.tobytes()], pa.binary()),
                    pa.array([packed.tobytes()], pa.binary()), pa.array([escapes.tobytes()], pa.binary()),
                ], names=[f.split()[0] for f in PAGE.split(", ")])
                page += 1

    ordered = (common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
               .withColumn("part", F.spark_partition_id()))
    ordered.mapInArrow(encode, PAGE).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; start counts the ids of all documents before."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _page_ids(row)
                upto = np.concatenate(([0], np.cumsum(np.asarray(row["lengths"], np.int64))))
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(row["doc_ids"]), pa.int32()),
                    pa.array([row["page"]] * len(row["doc_ids"]), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(upto[:-1], pa.int64()),
                    pa.array(np.diff(upto), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids.astype(np.int64), pa.int64())),
                ], names=["part", "page", "doc_id", "start", "n_tokens", "ids"])

    common.ship(spark)
    pages = spark.read.schema(PAGE).parquet(path)
    return _global_start(pages, pages.mapInArrow(
        decode, "part int, page int, doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>"))


def _page_ids(row: dict) -> np.ndarray:
    return unpack(np.frombuffer(row["words"], np.uint64), np.frombuffer(row["offsets"], np.uint32),
                  np.frombuffer(row["escapes"], np.uint64), row["n_ids"])


def _global_start(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds to `start` the ids of all pages before: sums within a part, then one row per part for the parts."""
    parts = pages.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("_before"))
    inside = pages.select("part", "page", (
        F.sum("n_ids").over(Window.partitionBy("part").orderBy("page")) - F.col("n_ids")).alias("_inside"))
    offsets = inside.join(before, "part").select("part", "page", (F.col("_before") + F.col("_inside")).alias("_base"))
    return (docs.join(offsets, ["part", "page"])
            .withColumn("start", F.col("start") + F.col("_base")).drop("part", "page", "_base"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read from the files; the checksum is over little-endian 32-bit ids."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = memoryview(_page_ids(row).astype("<u4")).cast("B")
                upto = np.concatenate(([0], np.cumsum(np.asarray(row["lengths"], np.int64))))
                crcs = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
                n = len(crcs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * n, pa.int32()), pa.array([row["page"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(upto[:-1], pa.int64()),
                    pa.array(np.diff(upto), pa.int64()), pa.array(crcs, pa.int64()),
                ], names=["part", "page", "doc_id", "start", "n_tokens", "ids_crc32"])

    common.ship(spark)
    pages = spark.read.schema(PAGE).parquet(path)
    return _global_start(pages, pages.mapInArrow(
        digest, "part int, page int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def op5_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    write_ids(common.table(spark, sf_dir, "documents"), path)
    return read_digests(spark, path)
