import hashlib
import json
import random
import time

import numpy as np
import public_tokenizers as vocab
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from betaloom.llm import queries, rank_bpe
from betaloom.llm.rank_bpe import RankBpe, decode_ranked, encode_ranked

SF = "/root/testdata/sf0.001"
PATH = vocab.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return RankBpe(PATH)


def coded(ids):
    return np.array(ids, "<u4").tobytes()


def test_every_character_is_split_as_in_the_library(own, library):
    for at in range(0, 0x110000, 64):
        text = "".join(f"a{chr(c)}1{chr(c)}! {chr(c)}" for c in range(at, at + 64) if not 0xD800 <= c < 0xE000)
        assert own.encode(text) == coded(library.encode(text, add_special_tokens=False).ids), hex(at)


ALPHABET = st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from([" ", "'s", "'ll", "\n", "\t ", "<|endoftext|>", "the", "ing", "0", "é", "日"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=60).map("".join))
def test_ids_and_text_equal_the_library(own, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == coded(ids)
    assert own.decode(coded(ids)) == library.decode(ids, skip_special_tokens=False)


def test_any_ids_decode_as_in_the_library(own, library):
    rng = random.Random(1)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(256), rng.randrange(50_257)]) for _ in range(rng.randrange(12))]
        assert own.decode(coded(ids)) == library.decode(ids, skip_special_tokens=False)
    assert own.decode(coded([999_999])) == ""


def test_scan_and_heap_make_the_same_merges(own):
    rng = random.Random(2)
    for _ in range(600):
        word = "".join(rng.choice("abehinrst é日") for _ in range(rng.randrange(1, 120))).encode()
        assert own.merge_scan(word) == own.merge_heap(word)


def test_long_words_cost_n_log_n(own, library):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    began = time.process_time()
    ids = own.encode(text)
    assert time.process_time() - began < 20
    assert ids == coded(library.encode(text, add_special_tokens=False).ids)


def test_words_are_forgotten_and_learned_again(monkeypatch, library):
    monkeypatch.setattr(rank_bpe, "CACHED_WORDS", 20)
    monkeypatch.setattr(rank_bpe, "MATCHES", 7)
    bpe, rng = RankBpe(PATH), random.Random(4)
    for _ in range(30):
        text = " ".join(rng.choice(["one", "two", "three", "naïve", str(rng.randrange(99))]) for _ in range(60))
        assert bpe.encode(text) == coded(library.encode(text, add_special_tokens=False).ids)
        assert bpe.decode(bpe.encode(text)) == text


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"decoder": None}])
def test_other_kinds_of_files_are_refused(tmp_path, change):
    (tmp_path / "t.json").write_text(json.dumps(json.load(open(PATH)) | change))
    with pytest.raises(ValueError):
        RankBpe(str(tmp_path / "t.json"))


def test_whole_table_against_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_rank_array_bpe(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(coded(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_long_texts_and_clashing_names(spark, library):
    long = "Some words, again and again. " * 700_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "twice", "x"), (3, "twice", "x"), (None, "no id", "x"), (4, long, "x"), (5, "<|endoftext|> a<|endoftext|>", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id or 0, bytes(r.ids), r.decoded) for r in decode_ranked(encode_ranked(df, PATH), PATH).collect())
    want = sorted((d or 0, coded(library.encode(t or "", add_special_tokens=False).ids), t or "") for d, t, _ in rows)
    assert got == want
    none = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert decode_ranked(none, PATH).collect()[0].decoded == ""
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decode_ranked(encode_ranked(empty, PATH), PATH).count() == 0
