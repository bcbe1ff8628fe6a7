import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from icdforge.llm import pieces, queries

SPEC = pieces.PieceSpec(cache_words=50)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=SPEC.model)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["the", "ing", " ", "  ", "▁", "\n", "\t", "<s>", "</s>", "<0x41>", "é", "日本", "😀", "\x00", " ", "e", "r", "st"]), st.text(max_size=4)), max_size=30).map("".join))
def test_ids_and_decoded_texts_equal_the_librarys(text):
    own = pieces.pieces(SPEC)
    ids = own.encode(text)
    assert ids.tolist() == LIBRARY.encode(text, add_eos=True)
    assert own.decode(ids) == LIBRARY.decode(ids.tolist())
    symbols = list(pieces.MARK + text.replace(" ", pieces.MARK))  # the heap, whatever the length
    assert own.merge_long(symbols[:]) == own.merge_long(symbols[:]) and "".join(own.merge_long(symbols[:])) == "".join(symbols)
    assert [x for s in own.merge_long(symbols) for x in ([own.id[s]] if s in own.id else map(own.byte.get, s.encode()))] == (ids.tolist()[:-1] if text else own.merge(pieces.MARK))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(3, 258), max_size=40))
def test_any_ids_decode_as_in_the_library(ids):
    assert pieces.pieces(SPEC).decode(pieces.array("i", ids)) == LIBRARY.decode(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("etaoinshr▁\t\x00é日😀􏿿<"), min_size=1, max_size=45), max_size=40))
def test_words_merged_together_equal_words_merged_alone(words):
    own = pieces.pieces(SPEC)
    assert own.merge_many(words) == [pieces.array("i", own.merge(w)).tobytes() for w in words]
    assert own.ids_of(words + words) == own.merge_many(words) * 2


def test_long_words_are_encoded_whole():
    own = pieces.pieces(SPEC)
    for text in ("ab" * 20_000, "日本" * 5_000, " " * 3_001 + "x", "\n" * 1_000, "é" * 9_999):
        assert own.encode(text).tolist() == LIBRARY.encode(text, add_eos=True)


def test_encode_of_awkward_rows(spark, awkward):
    docs = awkward.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(0))
    got = [(r["doc_id"], list(r["ids"]), r["decoded"]) for r in pieces.encode(docs, pieces.PieceSpec(run_bytes=40)).collect()]
    expected = []
    for r in docs.collect():
        ids = LIBRARY.encode(r["text"] or "", add_eos=True)
        expected.append((r["doc_id"], ids, LIBRARY.decode(ids)))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert pieces.encode(docs.limit(0)).count() == 0


def test_a_difference_from_the_library_fails():
    own = pieces.pieces(SPEC)
    ids = own.encode("some words")
    pieces.check(["some words"], [ids], ["some words"], own)
    with pytest.raises(ValueError):
        pieces.check(["some words"], [ids], ["some word"], own)
    with pytest.raises(ValueError):
        pieces.check(["some word"], [ids], ["some words"], own)


def test_query_digests(spark):
    rows = {r["doc_id"]: r for r in queries.op12_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = LIBRARY.encode(d["text"] or "", add_eos=True)
        r = rows[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())


def test_each_different_word_is_looked_up_once(monkeypatch):
    own = pieces.Pieces(SPEC)
    met, ids_of = [], own.ids_of
    monkeypatch.setattr(own, "ids_of", lambda words: met.append(list(words)) or ids_of(words))
    texts = ["the cat and the cat\nand  the", "", "the cat", "\n\n \n", "▁the  ▁cat\x00the " * 3]
    expected = [LIBRARY.encode(t, add_eos=True) for t in texts]
    assert [ids.tolist() for ids in own.encode_texts(texts)] == expected
    assert len(met) == 1 and len(set(met[0])) == len(met[0])
    assert {" the", " cat", " and", "\n", "and", "  the"} <= set(met[0])
    monkeypatch.setattr(pieces, "SLICE", 3)  # texts and words across slices
    assert [ids.tolist() for ids in own.encode_texts(texts)] == expected
