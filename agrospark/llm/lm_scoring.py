"""Scoring texts with a language model by deleted interpolation.

The probability of a token after another mixes three estimates: the share of the pair among all pairs with that
context, the share of the token among all tokens, and one part in (distinct tokens + 1). The mixture weights depend on
how often the context was seen (a bucket per power of two) and are learned by expectation-maximisation on held-out
counts: each training document in turn is taken out of all counts and its tokens are what the weights must explain.

How it runs: documents are placed in blocks of bounded size. A block counts its own words and pairs and sends the
sorted keys, packed, to the task that owns a range of keys; this adds the blocks' counts and returns to every block
what the others have counted, in the same order. So a key crosses the network once per block, however often it
occurs, and the text once. Each block then knows the full counts of its tokens, and writes them per document; the
weights and the scores are computed from that table.

Words are known by 64-bit hashes from there on; pairs by hashes with `SPARE` bits more than it takes to number the
corpus's bytes, so that at any size about one pair in a million shares its count with another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from agrospark.llm import common
from agrospark.sources.files import scratch_dir

BLOCK_BYTES = 6 << 20
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word contains a line feed
SPARE = 20
STEPS = 4  # cells per power of two, in which the EM's probabilities are gathered
NONE = -(1 << 20)  # the cell of probability 0

COUNTED = "bucket int, block int, size int, keys binary, counts binary"
OTHERS = "block int, bucket int, size int, counts binary, tokens bigint, distinct bigint"
KNOWN = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, words binary, pairs binary, "
         "tokens bigint, distinct bigint, cells binary, sums binary")


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers byte by byte of their places, so that the empty high bytes stand together and compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").reshape(-1)


def sent(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(packed(values))


def received(data: bytes) -> np.ndarray:
    return unpacked(zstandard.ZstdDecompressor().decompress(data))


def ranges(keys: np.ndarray, key_bits: int, bits: int) -> list[tuple[int, int, int]]:
    """(owner, first, end) of ascending keys, by their highest bits."""
    owner = (keys >> np.uint64(key_bits - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    return list(zip(owner[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) ^ (right + np.uint64(0xD1B54A32D192ED03))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


@dataclass
class Block:
    """The tokens of a block: every word, then one end per document; the context of a document's first is the end."""

    keys: np.ndarray  # of distinct words, ascending
    tokens: np.ndarray  # place in keys
    pairs: np.ndarray  # keys of distinct pairs, ascending
    pair_of: np.ndarray  # place in pairs, per token
    bounds: np.ndarray  # first token of each document, and the end
    trained: np.ndarray  # per token, whether its document is learned from

    @classmethod
    def of(cls, table: pa.Table, pair_bits: int) -> Block:
        text = pc.ascii_lower(table["text"].combine_chunks())
        bounds, codes, distinct = common.split_words(text)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.cast(pa.large_binary()).to_pylist()),
                             np.uint64, len(distinct))
        keys, place = np.unique(np.append(hashes, END), return_inverse=True)
        tokens = place[np.insert(codes.astype(np.int64), bounds[1:], len(hashes))]
        bounds = bounds + np.arange(len(bounds))
        before = np.concatenate((place[-1:], tokens[:-1])) if len(tokens) else tokens
        number, pair_of = np.unique(before * len(keys) + tokens, return_inverse=True)
        found = pair_keys(keys[number // len(keys)], keys[number % len(keys)]) >> np.uint64(64 - pair_bits)
        pairs, rank = np.unique(found, return_inverse=True)
        trained = np.repeat(~np.asarray(table["held_out"].combine_chunks()), np.diff(bounds))
        return cls(keys, tokens, pairs, rank[pair_of], bounds, trained)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each word and pair in the documents learned from."""
        count = lambda places, n: np.bincount(places[self.trained], minlength=n).astype(np.uint64)
        return count(self.tokens, len(self.keys)), count(self.pair_of, len(self.pairs))

    def own(self, places: np.ndarray) -> np.ndarray:
        """Per token, how often what stands at its place occurs in the token's own document."""
        doc = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        _, inverse, counts = np.unique(doc * (int(places.max(initial=0)) + 1) + places,
                                       return_inverse=True, return_counts=True)
        return counts[inverse]


def _batch(names: str, columns: list[list]) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(),
             "boolean": pa.bool_()}
    fields = [f.split() for f in names.split(", ")]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _count(bits: int, pair_bits: int):
    """A block's keys with its counts, cut by ranges of keys; ascending keys go as differences."""
    def run(table: pa.Table) -> pa.Table:
        block, number = Block.of(table, pair_bits), table["block"][0].as_py()
        rows = []
        for size, keys, counts, key_bits in zip((1, 2), (block.keys, block.pairs), block.counts(), (64, pair_bits)):
            for owner, a, b in ranges(keys, key_bits, bits):
                rows.append((owner, number, size, sent(np.diff(keys[a:b], prepend=np.uint64(0))), sent(counts[a:b])))
        return _batch(COUNTED, [list(c) for c in zip(*rows)])

    return run


def _merge(table: pa.Table) -> pa.Table:
    """Adds the counts of a range of keys; per block, what others have counted of its keys, in their order."""
    rows, block, size = [], table["block"].to_pylist(), table["size"].to_pylist()
    bucket = table["bucket"][0].as_py()
    key_data, count_data = table["keys"].to_pylist(), table["counts"].to_pylist()
    for n in (1, 2):
        mine = [i for i, s in enumerate(size) if s == n]
        if not mine:
            continue
        parts = [np.cumsum(received(key_data[i]), dtype=np.uint64) for i in mine]
        keys = np.concatenate(parts)
        counts = np.concatenate([received(count_data[i]) for i in mine])
        upto = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        distinct, inverse = np.unique(keys, return_inverse=True)
        # Whole numbers: bincount would add them as doubles.
        total = np.zeros(len(distinct), dtype=np.uint64)
        np.add.at(total, inverse, counts)
        others = total[inverse] - counts
        if n == 1:
            rows.append((-1, bucket, 0, b"", int(total.sum()), int((total > 0).sum())))
        for i, a, b in zip(mine, upto[:-1].tolist(), upto[1:].tolist()):
            if others[a:b].any():
                rows.append((block[i], bucket, n, sent(others[a:b]), 0, 0))
    return _batch(OTHERS, [list(c) for c in zip(*rows)] or [[] for _ in OTHERS.split(", ")])


def _log_cell(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, logarithm) of positive numbers; NONE and 0 for zero."""
    logs = np.log2(np.maximum(values, 1e-300))
    return np.where(values > 0, np.round(logs * STEPS), NONE).astype(np.int64), np.where(values > 0, logs, 0.0)


def frequency_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context that was never seen, else 1 + floor(log2)."""
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))) + 1, 0).astype(np.int64)


def _know(docs: pa.Table, others: pa.Table, bits: int, pair_bits: int) -> pa.Table:
    """Every document's tokens with their counts in the whole corpus, and the block's held-out cells."""
    if not docs.num_rows:  # what is addressed to no block: sums over a range of keys
        none = [None] * others.num_rows
        return _batch(KNOWN, [none, none, none, none, none, none, none,
                              others["tokens"].to_pylist(), others["distinct"].to_pylist(), none, none])
    block = Block.of(docs, pair_bits)
    totals = block.counts()
    told = {key: i for i, key in enumerate(zip(others["size"].to_pylist(), others["bucket"].to_pylist()))}
    for n, keys, total, key_bits in zip((1, 2), (block.keys, block.pairs), totals, (64, pair_bits)):
        for owner, a, b in ranges(keys, key_bits, bits):
            if (n, owner) in told:
                total[a:b] += received(others["counts"][told[n, owner]].as_py())
    word, pair = totals[0][block.tokens], totals[1][block.pair_of]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[block.bounds[:-1]] = totals[0][np.searchsorted(block.keys, END)]
    # The weights must explain a document that the counts don't hold.
    own_word, own_pair = block.own(block.tokens), block.own(block.pair_of)
    own_context = np.empty_like(own_word)
    own_context[1:] = own_word[:-1]
    own_context[block.bounds[:-1]] = 1
    t = block.trained
    left = (context[t] - own_context[t].astype(np.uint64)).astype(np.float64)
    after = (pair[t] - own_pair[t].astype(np.uint64)).astype(np.float64)
    alone = (word[t] - own_word[t].astype(np.uint64)).astype(np.float64)
    q2, log2 = _log_cell(np.divide(after, left, out=np.zeros_like(after), where=left > 0))
    q1, log1 = _log_cell(alone)
    # Bucket and both cells in one number: cells lie within a few hundred of zero.
    part = lambda q: np.where(q == NONE, 0, q + (1 << 11))
    cells, inverse, counts = np.unique((frequency_bucket(left) << 24) + (part(q2) << 12) + part(q1),
                                       return_inverse=True, return_counts=True)
    whole = lambda q: np.where(q == 0, NONE, q - (1 << 11))
    cells = np.stack([cells >> 24, whole(cells >> 12 & 0xFFF), whole(cells & 0xFFF)])
    sums = np.stack([counts.astype(np.float64), np.bincount(inverse, log2, len(counts)),
                     np.bincount(inverse, log1, len(counts))])
    n = docs.num_rows
    at, upto = block.bounds[:-1].tolist(), block.bounds[1:].tolist()
    base = np.add.reduceat(np.log10(word.astype(np.float64) + 1), block.bounds[:-1])
    known = np.add.reduceat((word > 0).astype(np.int64), block.bounds[:-1])
    values = [docs["doc_id"].to_pylist(), docs["held_out"].to_pylist(), np.diff(block.bounds), known, base,
              [packed(word[a:b]) for a, b in zip(at, upto)], [packed(pair[a:b]) for a, b in zip(at, upto)],
              *[[None] * n] * 4]
    gathered = [*[[None]] * 9, [cells.astype("<i8").tobytes()], [sums.astype("<f8").tobytes()]]
    return pa.concat_tables([_batch(KNOWN, values), _batch(KNOWN, gathered)])


@dataclass
class Model:
    """The mixture: weights[bucket] of the pair's, the word's and the flat estimate."""

    tokens: int
    distinct: int
    weights: np.ndarray

    def score(self, word: np.ndarray, pair: np.ndarray) -> float:
        """log10 probability of a text from the counts of its tokens, the last of which is the end."""
        word, pair = word.astype(np.float64), pair.astype(np.float64)
        context = np.concatenate((word[-1:], word[:-1]))
        w = self.weights[np.minimum(frequency_bucket(context), len(self.weights) - 1)]
        estimate = w[:, 2] / (self.distinct + 1) + w[:, 1] * word / max(self.tokens, 1)
        estimate += w[:, 0] * np.divide(pair, context, out=np.zeros_like(pair), where=context > 0)
        return float(np.log10(estimate).sum())


def learn_weights(cells: np.ndarray, tokens: int, distinct: int, rounds: int = 200, change: float = 1e-7) -> np.ndarray:
    """Expectation-maximisation per bucket; rows of cells: bucket, number of tokens, and the estimates' mean logs
    (of the pair's share and of the word's count; NaN for zero).

    A bucket without a held-out token takes the weights of the nearest one that has some; without any token at all,
    only the flat estimate counts.
    """
    top = int(cells[0].max(initial=0)) + 2
    weights = np.full((top, 3), np.nan)
    for b in np.unique(cells[0]).astype(int):
        mine = cells[:, cells[0] == b]
        shares = np.stack([np.where(np.isnan(mine[2]), 0, np.exp2(mine[2])),
                           np.where(np.isnan(mine[3]), 0, np.exp2(mine[3]) / max(tokens, 1)),
                           np.full(mine.shape[1], 1 / (distinct + 1))])
        w = np.array([0.0, 0.75, 0.25]) if b == 0 else np.array([0.4, 0.4, 0.2])
        for _ in range(rounds):
            part = w[:, None] * shares
            new = (part / part.sum(axis=0) * mine[1]).sum(axis=1) / mine[1].sum()
            moved, w = np.abs(new - w).max(), new
            if moved < change:
                break
        weights[b] = w
    have = np.flatnonzero(~np.isnan(weights[:, 0]))
    if not len(have):
        return np.array([[0.0, 0.0, 1.0]])
    for b in np.flatnonzero(np.isnan(weights[:, 0])):
        weights[b] = weights[have[np.abs(have - b).argmin()]]
        if b == 0:
            weights[b] = [0, 1 - weights[b, 2], weights[b, 2]]
    # A text may hold what the held-out tokens never did; the flat estimate keeps some weight everywhere.
    weights[:, 2] = np.maximum(weights[:, 2], 1e-9)
    return weights / weights.sum(axis=1, keepdims=True)


def known_counts(docs: DataFrame, held_out: Column) -> DataFrame:
    """The written table of `KNOWN` rows: documents, sums per key range, cells per block."""
    common.ship(docs.sparkSession)
    rows = common.texts(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = common.total_bytes(docs)
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    bits, pair_bits = math.ceil(math.log2(blocks)), min(64, size.bit_length() + SPARE)
    # By id and text, so that neither a missing id nor a text of many copies fills a block.
    placed = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", F.length("text")), F.lit(blocks)).cast("int")) \
        .repartition(blocks, "block")
    counted = placed.groupBy("block").applyInArrow(_count(bits, pair_bits), COUNTED)
    others = counted.repartition(1 << bits, "bucket").groupBy("bucket").applyInArrow(_merge, OTHERS)

    def know(docs: pa.Table, others: pa.Table) -> pa.Table:
        return _know(docs, others, bits, pair_bits)

    known = placed.groupBy("block").cogroup(others.repartition(blocks, "block").groupBy("block")).applyInArrow(know, KNOWN)
    path = scratch_dir(docs.sparkSession, "token-counts")
    known.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(KNOWN).parquet(path)


def learn(known: DataFrame) -> Model:
    """The model of a table of known counts; the cells that come to the driver are a few thousand at any size."""
    tokens, distinct = known.agg(F.sum("tokens"), F.sum("distinct")).first()

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["cells"], "<i8").reshape(3, -1)
                sums = np.frombuffer(row["sums"], "<f8").reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys, *sums)],
                                                 names=["b", "q2", "q1", "n", "s2", "s1"])

    gathered = known.where("cells is not null").select("cells", "sums").mapInArrow(
        cells, "b bigint, q2 bigint, q1 bigint, n double, s2 double, s1 double")
    rows = gathered.groupBy("b", "q2", "q1").agg(*[F.sum(c).alias(c) for c in ("n", "s2", "s1")]) \
        .orderBy("b", "q2", "q1").collect()
    mean = lambda r, q, s: math.nan if r[q] == NONE else r[s] / r["n"]
    table = np.array([[r["b"], r["n"], mean(r, "q2", "s2"), mean(r, "q1", "s1")] for r in rows]).reshape(-1, 4).T
    tokens, distinct = tokens or 0, distinct or 0
    return Model(tokens, distinct, learn_weights(table, tokens, distinct))


def score(known: DataFrame, model: Model) -> DataFrame:
    """One row per document: ids, counts, the base score and the model's."""
    flat = math.log10(model.tokens + model.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, pairs = batch.column("words").to_pylist(), batch.column("pairs").to_pylist()
            n = batch.column("n_tokens").to_numpy()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), batch.column("n_tokens"), batch.column("n_known"),
                pa.array(np.full(len(n), model.tokens), pa.int64()),
                pa.array(batch.column("base").to_numpy() - n * flat, pa.float64()),
                pa.array([model.score(unpacked(w), unpacked(p)) for w, p in zip(words, pairs)], pa.float64()),
            ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    common.ship(known.sparkSession)
    rows = known.where("words is not null").select("doc_id", "held_out", "n_tokens", "n_known", "base", "words", "pairs")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                "base_score double, score double")


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores every whole text with a model of the documents for which `held_out` is not true.

    A null or empty text is one end. With nothing to learn from, both scores are 0. Repeated rows are scored, and
    counted, each for itself.
    """
    known = known_counts(docs, held_out)
    return score(known, learn(known))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return score_documents(common.table(spark, sf_dir, "documents"), held_out)
