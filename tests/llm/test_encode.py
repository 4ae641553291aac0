import random
import time
from pathlib import Path

import pytest

from harborlens.llm import encode
from harborlens.llm.batches import slices

pytestmark = pytest.mark.skipif(not Path(encode.VOCABULARY).exists(), reason="no vocabulary")
TEXTS = [
    "", None, " ", "Hello  world", "aaaaaaa" * 300, "<|endoftext|> is text", "it's we'll I'D", "10.0.1.2:8080\r\n\r\n\tx", "日本語のテキスト。", "ไทย ภาษา", "مرحبا", "👩‍💻 é ｆ",
    "=" * 4000, "ab" * 20000, "\x00\x01", "x" * 3 + " " * 5 + "y", "supercalifragilistic " * 50, "A" + "b" * 7 + "A" * 7,
]


@pytest.fixture(scope="module")
def encoder():
    return encode.Encoder(encode.Vocabulary.load())


def test_against_the_vocabularys_own_library(encoder):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(encode.VOCABULARY)
    t.encode_special_tokens = True
    expected = [e.ids for e in t.encode_batch([x or "" for x in TEXTS], add_special_tokens=False)]
    assert encoder.encode(TEXTS) == expected


def test_long_words_are_mended_at_their_seams(encoder, monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(encode.VOCABULARY)
    draw = random.Random(7)
    letters = ["ab", "aA", "eta", "theinra", "=-", "acgt", "ABCDEFGHabcdefgh", "กขคงจ", "é"]
    words = ["".join(draw.choice(x) for _ in range(draw.randint(200, 1500))) for x in letters * 4] + ["aab" * 5000, "a" * 9001, "é" * 777]
    assert encoder.encode(words) == [t.encode(w, add_special_tokens=False).ids for w in words]
    monkeypatch.setattr(encode, "LONG", 5)
    monkeypatch.setattr(encode, "PART", 3)
    small = encode.Encoder(encoder.vocabulary)
    assert small.encode(TEXTS) == encoder.encode(TEXTS)


def test_a_megabyte_without_a_blank(encoder):
    draw = random.Random(3)
    word = "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(1 << 20))
    began = time.perf_counter()
    ids = encoder.encode([word])[0]
    assert time.perf_counter() - began < 60
    assert encoder.decode([ids]) == [word]


def test_batches_are_cut_by_bytes():
    pa = pytest.importorskip("pyarrow")
    texts = ["x" * 10, None, "y" * 50, "", "z", "é" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["k", "t"])
    parts = [p.column(1).to_pylist() for p in slices(batch, 1, rows=2, size=20)]
    assert parts == [["x" * 10, None], ["y" * 50], ["", "z"], ["é" * 9]]
    assert list(slices(batch.slice(0, 0), 1)) == []


def test_round_trip(encoder):
    assert encoder.decode(encoder.encode(TEXTS)) == [x or "" for x in TEXTS]
    assert encoder.decode([[], [99_999_999]]) == ["", ""]


def test_chunks_and_forgetting_change_nothing(encoder, monkeypatch):
    monkeypatch.setattr(encode, "CHUNK_WORDS", 2)
    monkeypatch.setattr(encode, "REMEMBERED", 3)
    small = encode.Encoder(encoder.vocabulary)
    assert [small.encode([x])[0] for x in TEXTS] == encoder.encode(TEXTS)


def test_frames(spark):
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    ids = encode.encode(df)
    assert dict(encode.decode(ids).collect()) == {i: x or "" for i, x in enumerate(TEXTS)}
    assert {r.doc_id: r.n_tokens for r in encode.token_counts(df).collect()} == {r.doc_id: len(r.ids) for r in ids.collect()}
    assert encode.encode(df.limit(0)).isEmpty()
