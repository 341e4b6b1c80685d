import zlib
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from frostline.llm import best_fit

REAL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
IDS = best_fit.TokenIds()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t's<|>éaA1.,")), max_size=60))
def test_ids_are_those_of_the_tokenizer_file(text):
    assert IDS.of(text) == REAL.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a  b", "a \n b", " a", "a ", "it's we'll", "<|endoftext|> x", "x<|endoftext|>", "\n\n\n", "é  x", "१२३ ½"])
def test_ids_of_odd_texts(text):
    assert IDS.of(text) == REAL.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 100), max_size=200), st.integers(1, 8))
def test_bins_against_a_plain_search(lengths, most):
    bins = best_fit.OpenBins(most, 100)
    free, made = {}, 0
    for n in lengths:
        number, offset = bins.place(n)
        fitting = [f for f in free.values() if f >= n]
        if fitting:
            assert free[number] == min(fitting) and offset == 100 - free[number]
        else:
            if len(free) == most:
                tightest = min(free.values())
                del free[next(b for b in free if free[b] == tightest and b not in {x for xs in bins.with_free for x in xs})]
            assert number == made and offset == 0
            free[number], made = 100, made + 1
        free[number] -= n
        if not free[number]:
            del free[number]
        assert sorted(free) == sorted(x for xs in bins.with_free for x in xs) and len(free) <= most


def test_every_token_has_its_place(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = best_fit.pack_documents(docs).toPandas()
    by_doc = {d: g.sort_values("piece") for d, g in out.groupby("doc_id")}
    for r in docs.collect():
        ids = REAL.encode(r["text"], add_special_tokens=False).ids + [2]
        own = by_doc.pop(r["doc_id"])
        assert own["piece"].tolist() == list(range(len(own))) and own["length"].sum() == len(ids)
        assert (own["length"].iloc[1:] == 1024).all() and (len(own) == 1 or len(ids) > 1024)
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(array("I", ids[p.start : p.start + p.length]).tobytes())
    assert not by_doc
    for _, group in out.sort_values("offset").groupby("sequence_id"):
        assert group["length"].sum() <= 1024 and group["offset"].tolist() == [0, *group["length"].cumsum().tolist()[:-1]]
    assert out["sequence_id"].nunique() <= 1.1 * best_fit.fewest(int(out["length"].sum()))


def test_edges(spark):
    rows = [(1, None, 7), (2, "", 7), (None, "x", 7), (4, "word " * 100_000, 7), (5, "same", 7), (5, "same", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece long")
    out = best_fit.pack_documents(docs).toPandas()
    assert out[out.doc_id.isin([1, 2])]["length"].tolist() == [1, 1]
    assert len(out[out.doc_id == 5]) == 2 and out["doc_id"].isna().sum() == 1
    assert out[out.doc_id == 4]["length"].sum() == 100_002
    assert best_fit.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", [" " * 10_000_000, "\n" * 10_000_000 + "end", "a" + " " * 60_000 + "b"])
def test_ids_of_long_white_space(text):
    ids = IDS.of(text)
    assert ids[-1:] == REAL.encode(text[-20:], add_special_tokens=False).ids[-1:]
    if len(text) < 1_000_000:
        assert ids == REAL.encode(text, add_special_tokens=False).ids
    assert REAL.decode(ids, skip_special_tokens=False) == text
