"""Cross-tokenizer alignment against both libraries and a plain double loop over all token pairs."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickpulse.llm import alignment
from clickpulse.llm.queries import op13_cross_alignment
from clickpulse.llm.tokens import vocabulary

BYTES, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TEXTS = [
    "Hello world", None, "", " ", "a", "a  b", "x \n\n y", "one two\nthree\nfour.", " lead and tail ", "tab\tand;\r\nfeed",
    "don't <|endoftext|> </s> é🔥 z", "a▁b", "▁", "\x1c x \x1f", "wide　space  here", "<0x41>", "ﬁ ﬂ é", "x\x00y",
    "antidisestablishmentarianism " * 40, "the of and\n" * 300, "\n b", "Hello world", "١٢٣ 12345",
]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {chr(b): b for b in shown}
        for i, b in enumerate(b for b in range(256) if b not in shown):
            self.letters[chr(256 + i)] = b

    def spans(self, tokens):
        out, at = [], 0
        for number, data in tokens:
            out.append((number, at, at + len(data)))
            at += len(data)
        return out

    def document(self, text):
        """Spans of both sides, or none."""
        if not text:
            return [], []
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(d for _, d in a) != whole or b"".join(d for _, d in b) != whole:
            return [], []
        return self.spans(a), self.spans(b)

    def rows(self, texts):
        links, shapes = [], []
        for text in texts:
            a, b = self.document(text)
            links.append([(i, j) for i, s, e in a for j, t, f in b if s < f and t < e])
            ends = sorted({e for *_, e in a} & {e for *_, e in b})
            parts, start = [], 0
            for end in ends:
                sides = [",".join(str(i) for i, s, e in side if s >= start and e <= end) for side in (a, b)]
                parts.append("|".join(sides))
                start = end
            shapes.append((len(a), len(b), len(ends), ";".join(parts)))
        counts = Counter(p for found in links for p in set(found))
        most = Counter()
        for (i, _), n in counts.items():
            most[i] = max(most[i], n)
        for found, (n_a, n_b, n_groups, groups) in zip(links, shapes):
            best = sum(counts[p] == most[p[0]] for p in found)
            digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
            yield n_a, n_b, n_groups, len(found), best, sum(counts[p] for p in found), digest


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.mark.parametrize("frequent", [0, 5, 200_000])
def test_rows_equal_the_double_loop(spark, plain, frequent):
    pairs = list(enumerate(TEXTS)) + [(3, "Hello world"), (None, "Hello"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in pairs], "doc_id long, text string, row string, n_a int")
    rows = alignment.cross_alignment(df.repartition(3), BYTES, PIECES, frequent=frequent).collect()
    got = sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS)) for r in rows)
    assert got == sorted((str(i), *row) for (i, _), row in zip(pairs, plain.rows([t for _, t in pairs])))


def test_texts_that_a_side_changes_have_no_tokens(plain):
    assert all(plain.document(t) == ([], []) for t in ("a▁b", "▁", None, ""))
    assert plain.document("don't <|endoftext|> </s>")[0]


WORDS = st.lists(st.sampled_from(["a", "é", "don't", "12", ",", "</s>", "<|endoftext|>", " ", "  ", "\n", "\r", ";\r", "▁", "\x1c", "　"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=20) | WORDS.map("".join) | WORDS.map(" ".join), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(plain, texts):
    sides = alignment.encoders(BYTES, PIECES)
    coded = alignment._aligned([np.zeros(0, "<u4"), *sides.encode(texts)], sides)
    want = [row[:4] for row in plain.rows([None, *texts])]
    assert list(zip(*(c.to_pylist() for c in coded[:4]))) == want
    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in coded[4].to_pylist()]
    assert groups == [row[-1] for row in plain.rows([None, *texts])]


def test_long_texts(spark, plain):
    text = "word and wörd\n" * 25_000
    df = spark.createDataFrame([(1, text), (2, "b"), (3, "x" * 400_000)], "doc_id long, text string").coalesce(1)
    rows = alignment.align(df, BYTES, PIECES).select("doc_id", "n_a", "n_b", "groups").collect()
    for row, whole in zip(sorted(rows), (text, "b", "x" * 400_000)):
        a, b = plain.document(whole)
        assert (row["n_a"], row["n_b"]) == (len(a), len(b)) and row["groups"].count(";") + 1 <= len(a)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.cross_alignment(df, BYTES, PIECES).collect() == []


def test_query_on_the_given_table(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(1000).collect()
    rows = op13_cross_alignment(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    short = [k for k, d in enumerate(docs) if len(d["text"] or "") < 1500]
    assert len(rows) == len(docs) and len(short) > 20
    for k in short[:60]:
        a, b = plain.document(docs[k]["text"])
        assert (rows[k]["n_a"], rows[k]["n_b"]) == (len(a), len(b))
