"""Packing: ids, pieces, gapless sequences, little padding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_tokenizer())


def check(rows, texts, tokenizer, capacity=packing.CAPACITY):
    """Every id in one piece, sequences without gaps; the share of padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    total = padding = 0
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        padding += capacity - at if at & (at - 1) else 0
    return padding / total


def test_packing(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = [(9001, None), (9002, ""), (9003, "  two  spaces \n and  more \t\n"), (9004, "word " * 5000),
           (9005, "a" * 30_000), (9006, "it's we'll x \U0001F600 <|end|>"), (9007, " lead"), (9008, "trail ")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 AS `length`", "2 AS `offset`")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(packing.pack(docs).collect(), texts, tokenizer) < 0.05
    assert packing.pack(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    large = 2 ** 53 + 1
    docs = spark.createDataFrame([(large, "a b c")] * 3 + [(None, "x")] * 2, "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert Counter(r.doc_id for r in rows) == {large: 3, None: 2}
    assert len({(r.sequence_id, r.offset) for r in rows}) == 5


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.default_tokenizer())


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet="ab'sé  \n\t\r1_-.\x0b\x85\u2028\U0001F600", max_size=60), st.text(max_size=60),
                 st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=80)))
def test_both_ways_of_encoding_agree(tokenizer, encoder, text):
    want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode(text) == want


def test_every_plain_character_is_encoded_alike(tokenizer, encoder):
    plain = [chr(c) for c in range(0x20AD) if not encoder.NOT_PLAIN.search(chr(c))]
    text = " ".join(a + b for a in plain for b in "a1 .")
    assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>\n é", "<|endoftext|", "\u4e00<|endoftext|>"])
def test_added_tokens_are_encoded_as_a_plain_encode_does(tokenizer, encoder, text):
    want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
    assert encoder.encode(text) == want.tobytes()
    assert (50256 in want) == ("<|endoftext|>" in text)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=30))
def test_patterns_hold_every_piece_once(histogram):
    chosen = packing.choose_patterns(histogram, 64)
    held = Counter()
    for pattern, uses in chosen:
        assert uses > 0 and sum(s * n for s, n in pattern.items()) <= 64
        for s, n in pattern.items():
            held[s] += n * uses
    assert held == Counter(histogram)


def test_patterns_beat_first_fit():
    """Pairs (31, 33) fill a sequence exactly; so do triples (20, 21, 23)."""
    histogram = {31: 1000, 33: 1000, 20: 500, 21: 500, 23: 500}
    assert sum(uses for _, uses in packing.choose_patterns(histogram, 64)) <= 1505
