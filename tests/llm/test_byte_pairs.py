"""Ids against the tokenizers library on the same vocabulary file, and exact round trips."""

import random
import sys
from array import array
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from frostline.llm import byte_pairs
from frostline.llm.byte_pairs import BytePairs
from frostline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def pairs():
    return BytePairs(remembered=100)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_pairs.vocabulary_path())


def ids(data):
    out = array("I")
    out.frombytes(data)
    return out.tolist()


HOSTILE = [
    "", " ", "  x", "x  ", "\n\n\t x", "it's we'll I'D 'S", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "naïve Überçà",
    "日本語の文章。", "العربية", "😀👩‍👩‍👧", "a՘b࢏ ₏1", "\x00\x1c\x1d\x85   x", "é‍", "�", "x" * 5000, "1" * 999, "ab" * 3000,
    " " * 4097 + "y", "\r\n" * 2000, "é" * 3000,
]


def test_hostile_texts(pairs, library):
    for text in HOSTILE:
        got = pairs.encode(text)
        assert ids(got) == library.encode(text, add_special_tokens=False).ids, text[:40]
        assert pairs.decode(got) == text == library.decode(ids(got), skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(pairs, library, text):
    assert ids(pairs.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_every_character(pairs, library):
    """All code points, in many neighbourhoods: the splitter is chosen rightly."""
    rng = random.Random(5)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    rng.shuffle(points)
    for i in range(0, len(points), 6):
        text = "".join(rng.choice(["a", "1", " ", "!", ""]) + chr(c) for c in points[i : i + 6])
        assert ids(pairs.encode(text)) == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_arbitrary_ids_decode(pairs, library):
    rng = random.Random(6)
    for _ in range(300):
        some = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert pairs.decode(array("I", some).tobytes()) == library.decode(some, skip_special_tokens=False)
    assert pairs.decode(array("I", [99_999, 10]).tobytes()) == library.decode([10])


def test_a_word_of_a_million_characters(pairs, library):
    for text in (" " * 1_000_000, "lorem" * 200_000):
        assert ids(pairs.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_whole_table(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").toPandas()
    got = QUERIES["op11_byte_pairs"](spark, small).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for r in docs.itertuples():
        expected = library.encode(r.text or "", add_special_tokens=False).ids
        own = got.loc[r.doc_id]
        assert own.n_tokens == len(expected)
        data = array("I", expected)
        if sys.byteorder == "big":
            data.byteswap()
        assert own.ids_sha256 == sha256(data.tobytes()).hexdigest()
        assert own.decoded_sha256 == sha256((r.text or "").encode()).hexdigest()


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "hi there", "a"), (1, "hi there", "a"), (None, None, None), (2, "", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = byte_pairs.decoded(byte_pairs.encoded(df)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["decoded"]) for r in out) == [(0, "", ""), (1, "hi there", "hi there"), (1, "hi there", "hi there"), (2, "", "")]
    assert byte_pairs.round_trips(df.withColumn("n_tokens", F.lit(7))).filter("n_tokens = 0").count() == 2
    assert byte_pairs.round_trips(df.limit(0)).count() == 0
