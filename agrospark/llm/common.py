"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The six white-space bytes that part words (blank, tab, line feed, vertical tab, form feed, return).
BREAKS = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; their workers import it by name."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="agrospark-code-"), "agrospark")
        context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and whole text, a null text as the empty one; other columns are not carried."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def words(text: Column) -> Column:
    """Maximal runs of characters other than the six blanks."""
    return F.filter(F.split(text, f"[{BREAKS}]+"), lambda w: w != "")


def total_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one row, used to choose how many blocks there are."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def split_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a column of texts as (first word of each text and the end, word numbers, distinct words).

    The words are split and numbered in Arrow's buffers; empty pieces at the ends of a text are left out.
    """
    text = text.cast(pa.large_string())
    parts = pc.ascii_split_whitespace(text)
    values = parts.flatten()
    bounds = parts.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    full = np.asarray(pc.greater(pc.binary_length(values), 0))
    if not full.all():
        bounds = np.concatenate(([0], np.cumsum(full)))[bounds]
        values = values.filter(pa.array(full))
    coded = values.dictionary_encode()
    return bounds, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `size` bytes of text, so that memory does not follow the batch."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a column of texts, as they lie in its buffers."""
    text = text.cast(pa.large_string())
    _, offsets, data = text.buffers()
    at = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at - at[0], data[at[0]:at[-1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
    return public_tokenizers.path(name)
