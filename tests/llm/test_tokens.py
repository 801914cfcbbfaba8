import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from agrospark.llm import bpe, simple8b as S
from tests.llm import brute
from tests.llm.texts import ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ours():
    return bpe.Tokenizer(PATH)


def test_encoding_equals_the_library(spark, documents, library):
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(documents(ROWS)).collect()}
    assert got == brute.bpe(library, ROWS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cn", "Co", "Cs")), st.sampled_from(list("aeintrs'<|>\u0301 Σς"))), max_size=40))
def test_any_text(library, ours, text):
    ids = list(ours.encode(text))
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("word", ["a" * 5000, "abcab" * 800, "thethin" * 500, "é" * 999])
def test_long_words_are_emitted_before_they_end(library, ours, word):
    assert list(ours.encode(word)) == library.encode(word, add_special_tokens=False).ids
    read = 0

    def symbols():
        nonlocal read
        for c in word.encode().decode("latin-1").translate(ours._table):
            read += 1
            yield c

    stream = ours.transducer(symbols())
    next(stream)
    assert read <= 4 * ours.transducer.lookahead + 1


def test_decoding_bytes_as_they_come(ours):
    ids = list(ours.encode("Hello wörld \U0001f600!"))
    assert "".join(ours.decoded(ids, readable=True)) == "hello wörld \U0001f600! "
    assert list(ours.decoded([], readable=True)) == [""]


def test_encoded_columns(spark, documents, library):
    docs = documents(ROWS + [(5, "twice"), (5, "twice")])
    encoded = bpe.encode_texts(docs)
    assert encoded.columns == [*docs.columns, "n_tokens", "token_ids"]
    for r in encoded.collect():
        assert r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids and r.n_tokens == len(r.token_ids)
    assert bpe.encode_texts(encoded).columns == encoded.columns
    back = {r.doc_id: r.text for r in bpe.decode_ids(bpe.encode_texts(documents([(1, "Hi you"), (2, None)]))).collect()}
    assert back == {1: "hi</w> you</w>", 2: ""}
    assert bpe.encode_texts(documents([])).count() == 0


def test_ids_from_files(spark, documents, library, tmp_path):
    S.write_ids(documents(ROWS), f"file://{tmp_path}/ids")
    want = brute.token_file(library, ROWS)
    assert {r[0]: tuple(r)[1:] for r in S.read_digests(spark, f"file://{tmp_path}/ids").collect()} == want
    for r in S.read_ids(spark, f"file://{tmp_path}/ids").collect():
        assert (r.start, r.n_tokens) == want[r.doc_id][:2] and len(r.ids) == r.n_tokens and r.ids[-1] == 1


def test_missing_and_repeated_ids_and_empty_tables(spark, documents, tmp_path):
    S.write_ids(documents([(2, "b"), (None, "a"), (2, "b"), (None, None)]), f"file://{tmp_path}/some")
    got = sorted(S.read_digests(spark, f"file://{tmp_path}/some").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 2, 2]
    assert [r.start + r.n_tokens for r in got[:-1]] == [r.start for r in got[1:]]
    S.write_ids(documents([]), f"file://{tmp_path}/none")
    assert S.read_digests(spark, f"file://{tmp_path}/none").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_packing_round_trip(values):
    ids = np.array(values, dtype=np.uint64)
    assert (S.unpack(*S.pack(ids), len(ids)) == ids).all()


def test_words_are_filled():
    words, offsets, escapes = S.pack(np.ones(1024, np.uint64))
    assert len(words) == 18 and len(escapes) == 0 and offsets.tolist() == [0, 18]
    words, _, escapes = S.pack(np.array([1 << 60, 7], np.uint64))
    assert escapes.tolist() == [1 << 60] and words[0] == 0
