"""Token files against the tokenizers library, text by text."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickpulse.llm import token_files, tokens
from clickpulse.llm.queries import op1_token_files
from clickpulse.llm.shared import shared_folder

PATH = tokens.vocabulary("byte_bpe_50k.json")
ENCODER = tokens.library_encoder(PATH)
TEXTS = [
    "a  b", None, "", " ", "\n\n x\t\ty  ", "don't <|endoftext|> é🔥  z", "word" * 500, "x \x1c y\x1f  z", "e  f 12 345",
    "the of and " * 400, "İ ᠎ a", "tail   ", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|endoftext|>b",
    " <|endoftext|> ", "x \n<|endoftext|>\n y", "one two\nthree\nfour <|endoftext|>\n<|endoftext|> five", "a b\u3000c d\x85e",
]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def test_a_special_token_in_a_text_is_that_token(model):
    assert ids_of(model, "a <|endoftext|> b") == [64, 220, 50256, 275]


def ids_of(model, text):
    return model.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(model, monkeypatch):
    want = [ids_of(model, t) for t in TEXTS]
    for step, chars, remembered in ((200_000, 2_000_000, 400_000), (3, 5, 4)):
        monkeypatch.setattr(tokens, "STEP", step)
        monkeypatch.setattr(tokens, "CHARS", chars)
        monkeypatch.setattr(tokens, "REMEMBERED", remembered)
        encoder = tokens.library_encoder(PATH)
        for _ in range(2):
            assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(TEXTS)] == want


WORDS = st.lists(st.sampled_from(["a", "é", "don't", "12", ",", "<|endoftext|>", " ", "  ", "\n", "\t", "\x1c", "\u3000"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30) | WORDS.map("".join) | WORDS.map(" ".join), max_size=5))
def test_any_text_gives_the_ids_of_the_library(model, texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in ENCODER.encode(texts)]
    assert got == [ids_of(model, t) for t in texts]


def test_long_pieces_are_not_kept(model, monkeypatch):
    monkeypatch.setattr(tokens, "BYTES", 10_000)
    encoder = tokens.PieceEncoder(tokens.library_encode(PATH, specials=True))
    texts = [f"{chr(97 + i % 26) * 3000}{i} word{i % 7}, and" for i in range(60)]
    for _ in range(2):
        for text in texts:
            (got,) = encoder.encode([text])
            assert np.frombuffer(got, "<u4").tolist() == ids_of(model, text)
            assert encoder.store._keys.nbytes <= 10_000
    assert len(encoder.store._keys) > 7


def check(rows, pairs, model, end=2):
    start = 0
    assert len(rows) == len(pairs)
    for row, (doc, text) in zip(rows, pairs):
        ids = np.array(ids_of(model, text) + [end], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc, start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_query_reads_back_every_document_in_order(spark, tmp_path, model):
    pairs = [(100 - 3 * i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(pairs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = op1_token_files(spark, str(tmp_path)).orderBy("start").collect()
    check(rows, sorted(pairs, key=lambda p: p[0]), model)


def test_query_on_the_given_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    rows = op1_token_files(spark, "/root/testdata/sf0.001").orderBy("start").collect()
    check(rows, [(d["doc_id"], d["text"]) for d in docs], model)


def test_wide_files_nulls_repeats_and_empty_tables(spark, model):
    schema = "doc_id long, text string, tokens string, start int"
    df = spark.createDataFrame([(1, "b", "x", 1), (1, "a", "x", 1), (1, "a", "x", 1), (None, "c", "x", 1)], schema)
    folder = shared_folder(spark, "test")
    manifest = token_files.write(df, folder, PATH, 70000, width="<u4")
    assert sum(p["docs"] for p in manifest) == 4 and manifest[-1]["base"] + manifest[-1]["tokens"] == 8
    rows = token_files.read(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 1]
    assert all(np.frombuffer(r["tokens"], "<u4")[-1] == 70000 for r in rows)
    folder = shared_folder(spark, "test")
    token_files.write(df.limit(0), folder, PATH, 2)
    assert token_files.read(spark, folder).count() == 0


def test_very_long_texts_and_ids_that_are_no_numbers(spark, model):
    pairs = [("x", "aé b\n" * 30_000), ("7", "word" * 20_000 + " tail"), (None, "c")]
    df = spark.createDataFrame(pairs, "doc_id string, text string")
    folder = shared_folder(spark, "test")
    token_files.write(df, folder, PATH, 2)
    rows = token_files.read(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, 7]
    got = sorted(np.frombuffer(r["tokens"], "<u4").tolist() for r in rows)
    assert got == sorted(ids_of(model, t) + [2] for _, t in pairs)


def test_equal_and_null_ids_fill_several_parts_in_the_same_order(spark):
    rows = [(doc, f"text {i} {doc}") for doc in (None, 7) for i in range(400)] + [(9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = shared_folder(spark, "test")
    manifest = token_files.write(df, folder, PATH, 2)
    assert sum(p["docs"] for p in manifest) == 801 and max(p["docs"] for p in manifest) < 300
    ordered = df.selectExpr("doc_id", "text", "xxhash64(text) AS h").orderBy("doc_id", "h", "text").collect()
    got = token_files.read(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in ordered]
    want = [np.frombuffer(b, "<u4").tolist() + [2] for b in ENCODER.encode([r["text"] for r in ordered])]
    assert [np.frombuffer(r["tokens"], "<u4").tolist() for r in got] == want
