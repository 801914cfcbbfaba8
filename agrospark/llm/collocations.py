"""Phrase mining over stored occurrence relations, one phrase length after the other.

R1 is the relation of all word occurrences, sorted by place: pieces of texts follow each other, two words of a piece
have consecutive places, and a number is left out between pieces. R(k) joins R(k-1) with itself on adjacent places, a
merge of two sorted columns; its rows are grouped by (first part, rest) and counted, groups of fewer than `least` are
gone, and what remains of R(k) is its semi-join with the frequent groups. A relation is cut into blocks of texts, one
stored row per block with its columns packed, so that occurrences are grouped within their block before anything is
shuffled: a group crosses the network once per block, and a word that is everywhere is one entry per block.

Groups are dealt to ranges by a hash of their key, as many ranges as the session has shuffle partitions; a message holds
what a block has for a range. A range adds up its groups and tells every block the numbers of its frequent ones.
A phrase is known by such a number, a longer phrase by the numbers of its first part and its rest, so counts are of
phrases and not of hashes. Nothing is broadcast.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from agrospark.llm import common
from agrospark.llm.lm_scoring import pair_keys, received, sent
from agrospark.sources.files import scratch_dir

BLOCK_BYTES = 2 << 20
LEAST = 30
LONGEST = 4
PHRASES = 2000
NO_LANGUAGE = "und"

# Columns of relations, messages, and what ranges say: to a block (block, numbers), or of a phrase (no block).
RELATION = "block bigint, places binary, codes binary, numbers binary, langs array<string>, words binary"
MESSAGES = "range int, block bigint, numbers binary, langs array<string>, words binary"
ANSWERS = "block bigint, numbers binary, langs array<string>, words binary"
WORD_PHRASES = "id bigint, a bigint, lang string, word string"
PAIR_PHRASES = "id bigint, a bigint, first bigint, rest bigint"

# Bytes of a text: of a word, blank, or end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def read_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(place of each word, its code, the distinct words, the text it stands in); A-Z in lower case."""
    at, data = common.text_bytes(text)
    kind = _KIND[data]
    inside = kind == 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # No word reaches over two texts.
    bounds = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    begins[bounds] |= inside[bounds]
    ends[bounds - 1] |= inside[bounds - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = np.searchsorted(at, starts, side="right") - 1
    before = np.searchsorted(np.flatnonzero(kind == 2), starts) + owner  # ends of pieces before a word
    places = np.arange(len(starts), dtype=np.int64)
    places[1:] += np.cumsum(np.diff(before) > 0)
    # The words side by side, and where each begins.
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]]))
    coded = words.dictionary_encode()
    return places, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, owner


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    columns = zip(*rows) if rows else [[]] * len(_names(schema))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[f.split()[1]]) for c, f in zip(columns, schema.split(", "))], names=_names(schema))


def _pack(up: int, *columns: np.ndarray) -> bytes:
    """Columns of one length; the first `up` are ascending and go as differences."""
    return sent(np.concatenate([np.diff(c, prepend=0) if i < up else c for i, c in enumerate(columns)])) if len(columns[0]) else b""


def _unpack(up: int, data: bytes, n: int) -> np.ndarray:
    if not data:
        return np.zeros((n, 0), np.int64)
    columns = received(data).view(np.int64).reshape(n, -1)
    columns[:up] = np.cumsum(columns[:up], axis=1)
    return columns


def _pack_words(words: pa.Array) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words.cast(pa.large_binary()).to_pylist()))


def _unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def _texts(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.large_binary()).cast(pa.large_string())


def _word_block(block: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """R1 of a block, with the distinct words of each language and how often they occur."""
    table = pa.Table.from_batches(rows).combine_chunks()
    places, codes, words, owner = read_words(table.column("text").chunk(0))
    langs = table.column("lang").chunk(0).dictionary_encode()
    language = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
    n = max(1, len(words))
    keys, codes, counts = np.unique(language * n + codes, return_inverse=True, return_counts=True)
    return _rows(RELATION, [(block, _pack(1, places), _pack(0, codes), _pack(1, keys // n, counts), langs.dictionary.to_pylist(),
                             _pack_words(words.take(pa.array(keys % n))))])


def _written(rows: DataFrame, name: str) -> DataFrame:
    """Stored like every relation here, in less space."""
    path = scratch_dir(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def word_relation(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """R1 of all whole texts, one row per block of about `block_bytes`; a text is in one block."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in itertools.chain((piece for whole in batches for piece in common.slices(whole, size=block_bytes // 4)), [None]):
            if held and (batch is None or size + batch.nbytes > block_bytes):
                yield _word_block(block, held)
                block, held, size = block + 1, [], 0
            if batch is not None:
                held.append(batch)
                size += batch.nbytes

    common.ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return _written(rows.mapInArrow(cut, RELATION), "occurrences")


def words_per_language(relation: DataFrame) -> DataFrame:
    """(lang, n): all words of a language."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lang, n = _unpack(1, row["numbers"], 2)
                sums = np.zeros(len(row["langs"]), np.int64)
                np.add.at(sums, lang, n)
                yield pa.RecordBatch.from_arrays([pa.array(row["langs"], pa.string()), pa.array(sums)], names=["lang", "n"])

    counted = relation.select("numbers", "langs").mapInArrow(add, "lang string, n bigint").where("n > 0")
    return counted.groupBy("lang").agg(F.sum("n").alias("n"))


def messages(relation: DataFrame, ranges: int) -> DataFrame:
    """The groups of each block, dealt to ranges by their key: (lang and word, or first part and rest; code, count)."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["words"] is None:
                    first, rest, n = _unpack(1, row["numbers"], 3)
                    words, key = None, pair_keys(first.view(np.uint64), rest.view(np.uint64))
                else:
                    first, n = _unpack(1, row["numbers"], 2)
                    rest, words = np.zeros(len(n), np.int64), np.array(_unpack_words(row["words"]) if len(n) else [], object)
                    key = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                owner = (key % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(owner, kind="stable")
                cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
                rows = []
                for part in np.split(order, cuts[1:]) if len(order) else []:
                    said = None if words is None else zstandard.ZstdCompressor(level=1).compress(b"\n".join(words[part]))
                    rows.append((int(owner[part[0]]), row["block"], _pack(2, first[part], part, n[part], rest[part]),
                                 None if words is None else row["langs"], said))
                yield _rows(MESSAGES, rows)

    return relation.select("block", "numbers", "langs", "words").mapInArrow(deal, MESSAGES)


def frequent(sent_groups: DataFrame, ranges: int, least: int) -> DataFrame:
    """`ANSWERS` on the groups that sum up to `least` or more."""
    def add_up(table: pa.Table) -> pa.Table:
        columns = [_unpack(2, m, 4) for m in table.column("numbers").to_pylist()]
        sizes = [c.shape[1] for c in columns]
        first, code, n, rest = np.concatenate(columns, axis=1)
        langs = words = None
        if table.column("words")[0].is_valid:
            words = _texts([w for m in table.column("words").to_pylist() for w in _unpack_words(m)]).dictionary_encode()
            rest, words = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
            # Languages are numbered by message; here by range.
            named = table.column("langs").combine_chunks()
            coded = named.flatten().dictionary_encode()
            begins = np.repeat(named.offsets.to_numpy()[:-1] - named.offsets[0].as_py(), sizes)
            first, langs = coded.indices.to_numpy(zero_copy_only=False)[begins + first].astype(np.int64), coded.dictionary
        order = np.lexsort((rest, first))
        new = np.flatnonzero(np.append(True, (np.diff(first[order]) != 0) | (np.diff(rest[order]) != 0)))
        sums = np.add.reduceat(n[order], new)
        kept = sums >= least
        ids = np.where(kept, np.cumsum(kept) * ranges + table.column("range")[0].as_py(), -1)
        id_of = np.empty(len(order), np.int64)
        id_of[order] = np.repeat(ids, np.diff(np.append(new, len(order))))
        rows, upto = [], np.cumsum([0, *sizes])
        for block, a, b in zip(table.column("block").to_pylist(), upto[:-1].tolist(), upto[1:].tolist()):
            some = a + np.flatnonzero(id_of[a:b] >= 0)
            if len(some):
                rows.append((block, _pack(1, code[some], id_of[some]), None, None))
        if kept.any():
            one = order[new[kept]]
            rows.append((None, _pack(2, ids[kept], first[one], sums[kept], rest[one]),
                         None if langs is None else langs.to_pylist(),
                         None if words is None else _pack_words(words.take(pa.array(rest[one])))))
        return pa.Table.from_batches([_rows(ANSWERS, rows)])

    return _written(sent_groups.groupBy("range").applyInArrow(add_up, ANSWERS), "frequent-groups")


def each_once(answers: DataFrame, kind: str) -> DataFrame:
    """The frequent groups, a row each: `WORD_PHRASES` or `PAIR_PHRASES`."""
    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, first, a, rest = _unpack(2, row["numbers"], 4)
                if row["words"] is None:
                    keys = [pa.array(first), pa.array(rest)]
                else:
                    keys = [pa.array(row["langs"], pa.string()).take(pa.array(first)), _texts(_unpack_words(row["words"])).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(a), *keys], names=_names(kind))

    return answers.where("block is null").drop("block").mapInArrow(flat, kind)


def next_relation(relation: DataFrame, answers: DataFrame) -> DataFrame:
    """R(k+1) before counting, from R(k) and the numbers of its frequent groups."""
    def extend(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.Table.from_batches([_rows(RELATION, [])])
        places, codes = (_unpack(up, left.column(c)[0].as_py(), 1)[0] for up, c in ((1, "places"), (0, "codes")))
        told = [_unpack(1, m, 2) for m in right.column("numbers").to_pylist()]
        own, ids = np.concatenate(told, axis=1) if told else np.zeros((2, 0), np.int64)
        order = np.argsort(ids)
        own, ids = own[order], ids[order]
        # Semi-join: only occurrences of frequent groups stay.
        numbers = np.full(int(max(codes.max(initial=-1), own.max(initial=-1))) + 1, -1, np.int64)
        numbers[own] = np.arange(len(own))
        local = numbers[codes]
        places, local = places[local >= 0], local[local >= 0]
        # Merge-join of the relation with itself: the next occurrence begins one word further.
        at = np.flatnonzero(np.diff(places) == 1)
        n = max(1, len(ids))
        keys, codes, counts = np.unique(local[at] * n + local[at + 1], return_inverse=True, return_counts=True)
        return pa.Table.from_batches([_rows(RELATION, [
            (left.column("block")[0].as_py(), _pack(1, places[at]), _pack(0, codes), _pack(1, ids[keys // n], ids[keys % n], counts), None, None)])])

    blocks = relation.select("block", "places", "codes").groupBy("block")
    told = answers.where("block is not null").select("block", "numbers").groupBy("block")
    return _written(blocks.cogroup(told).applyInArrow(extend, RELATION), "occurrences")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), exact for any counts."""
    whole = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", whole(a) * F.lit(2_000_000).cast("decimal(7,0)"), whole(left) + whole(right))


def _longer(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrases (id, lang, phrase, last, heads, tails, a) of frequent groups (id, first, rest, a) of shorter ones.

    heads and tails: how often the first, and the last, 1, 2, ... words occur.
    """
    f = parts.select(F.col("id").alias("first"), "lang", "phrase", "heads")
    r = parts.select(F.col("id").alias("rest"), "last", "tails")
    return groups.join(f, "first").join(r, "rest").select(
        "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last",
        F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"), "a", "first", "rest")


def candidates(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(phrases of two to `longest` words that occur `least` times or more; lang, n: all words of each language).

    Phrases: lang, phrase, a, l, r, cut, score of their lowest-scoring cut, and inside: how often the most frequent
    phrase with one word more occurs that holds them, null without one.
    """
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    relation = word_relation(docs, block_bytes)
    totals = words_per_language(relation)
    answers = frequent(messages(relation, ranges), ranges, least)
    phrases = [each_once(answers, WORD_PHRASES).select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("a").alias("heads"), F.array("a").alias("tails"), "a")]
    for _ in range(longest - 1):
        relation = next_relation(relation, answers)
        answers = frequent(messages(relation, ranges), ranges, least)
        phrases.append(_written(_longer(each_once(answers, PAIR_PHRASES), phrases[-1]), "phrases"))
    found = []
    for size, (level, above) in enumerate(zip(phrases[1:], [*phrases[2:], None]), 2):
        cut = lambda k: F.struct(
            score(F.col("a"), F.get("heads", k - 1), F.get("tails", size - k - 1)).alias("score"), k.alias("cut"),  # noqa: B023
            F.get("heads", k - 1).alias("l"), F.get("tails", size - k - 1).alias("r"))  # noqa: B023
        level = level.select("id", "lang", "phrase", "a", F.array_min(F.array(*[cut(F.lit(k)) for k in range(1, size)])).alias("best"))
        if above is None:
            level = level.withColumn("inside", F.lit(None).cast("bigint"))
        else:
            parts = above.select(F.explode(F.array("first", "rest")).alias("id"), "a")
            level = level.join(parts.groupBy("id").agg(F.max("a").alias("inside")), "id", "left")
        found.append(level.select("lang", "phrase", "a", "best.l", "best.r", "best.cut", "best.score", "inside"))
    whole = found[0]
    for level in found[1:]:
        whole = whole.unionByName(level)
    return whole, totals


def best_phrases(docs: DataFrame, first: int = PHRASES, share: int = 80, salts: int = 64, **options) -> DataFrame:
    """Each language's `first` phrases by score, then a (both descending), then UTF-8 bytes: lang, rank, phrase, a, l,
    r, n, score, cut.

    A phrase is left out if a longer one that holds it occurs at least `share` per cent as often. A null text has no
    words, a null lang is `und`; repeated rows count each for itself. Other columns are not read. Without a frequent
    phrase there are no rows.
    """
    whole, totals = candidates(docs, **options)
    exact = lambda c, k: F.col(c).cast("decimal(19,0)") * F.lit(k).cast("decimal(3,0)")
    kept = whole.where(F.col("inside").isNull() | (exact("inside", 100) < exact("a", share))).drop("inside")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranked in parts first, so that a language with most of the phrases is not one group.
    part = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    kept = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    kept = kept.where(F.col("rank") <= first).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return kept.where(F.col("rank") <= first).join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.col("cut"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_phrases(common.table(spark, sf_dir, "documents"))
