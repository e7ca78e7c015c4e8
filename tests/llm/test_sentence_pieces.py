"""The prefix table against the library itself: whole texts, odd characters, runs of spaces, long texts without a cut."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import pytest

from tests.llm import data
from tickloom.llm import sentence_pieces
from tickloom.llm.queries import tokenizer

MODEL = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return sentence_pieces.Codec(sentence_pieces.load(MODEL))


def same(codec, library, text):
    ids, decoded = codec.round_trip(text)
    found = [*map(int, ids.split()), codec.pieces.end]
    assert found == library.encode(text, add_eos=True), text[:200]
    assert decoded == codec.decode(found) == library.decode(found), text[:200]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(spark, library):
    docs, none = data.documents(spark), data.documents(spark, [])
    expected = Counter()
    for i, text in data.texts():
        ids = library.encode(text or "", add_eos=True)
        expected[i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)), tuple(ids)] += 1
    found = sentence_pieces.sentence_piece_round_trip(docs, MODEL, keep_ids=True).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in found) == expected
    assert all(r.decoded == library.decode(r.ids) for r in found)
    assert sentence_pieces.sentence_piece_round_trip(none, MODEL).collect() == []


def test_whole_table(spark, sf_dir, library):
    from tickloom.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for r in docs:
        ids = library.encode(r.text or "", add_eos=True)
        expected[r.doc_id] = (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))
    found = QUERIES["op11_sentence_pieces"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected


@pytest.mark.parametrize(
    "text",
    [
        " a", "a  b ", "   ", " " * 77, "a" + " " * 33 + "b  " + " " * 15 + "c", "\x00a\x00", "<s> </s> <unk> <0x41> ▁a▁▁b",
        "▁", "x" * 999, "abab" * 99, " \n \n  ", "⁇ a", "ﬁ Ⅳ é ​", "日本語 テキスト", "🙂🙂 a🙂b", "tab\tand\r\nlines ",
    ],
)
def test_odd_texts(codec, library, text):
    same(codec, library, text)


def test_random_texts(codec, library):
    rng = random.Random(11)
    names = list(codec.pieces.ids)
    letters = ["etaoinshr ", "a=-_#*/.0123  \n", "ab ", "中文字日本 a"]
    for k in range(4000):
        if k % 3 == 0:
            text = "".join(rng.choice(names) for _ in range(rng.randrange(1, 12)))
        elif k % 3 == 1:
            text = "".join(rng.choice(letters[k % 4]) for _ in range(rng.randrange(1, 60)))
        else:
            text = "".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x400, 0xD000)])) for _ in range(30))
        same(codec, library, text)


def test_pairs_fit_as_joint_encoding_says(codec):
    """The walk back in time against merging the joint string outright."""
    pieces, rng = codec.pieces, random.Random(5)
    names = [n for n in pieces.ids if n in pieces.proper or len(n) == 1]
    for _ in range(20_000):
        a = rng.choice(names)
        b = rng.choice(names) if rng.random() < 0.5 else a[rng.randrange(len(a)) :]
        if b not in pieces.proper and len(b) > 1:
            continue
        joint, _ = sentence_pieces.merged(list(a + b), pieces.proper)
        assert codec.compatible(pieces.ids[a], pieces.ids[b]) == (joint == [a, b]), (a, b)


def test_long_texts_without_spaces_take_linear_time_and_are_not_cached(codec, library):
    rng = random.Random(3)
    texts = ["中文" * 50_000, "x" * 100_000, "".join(rng.choice("0123456789abcdef") for _ in range(100_000)), " " * 50_000]
    before = time.process_time()
    for text in texts:
        same(codec, library, text)
    assert time.process_time() - before < 20
    assert max(map(len, codec.known)) <= sentence_pieces.LONGEST_CACHED
    assert max(map(len, codec.segments)) <= sentence_pieces.LONGEST_CACHED


def test_the_cache_may_be_emptied_at_any_time(codec, library, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CACHED_CHARS", 50)
    for seed in range(30):
        same(codec, library, data.prose(seed, 20) + "  ▁x\n" * (seed % 3))


def test_a_text_that_decodes_to_itself_is_not_built_again(codec):
    text = "two words,  two spaces " + "x" * 100
    codec.round_trip(text)
    assert not codec.odd and codec.round_trip(text)[1] is text


def test_words_met_again_outlive_a_full_cache(codec, monkeypatch):
    own = sentence_pieces.Codec(codec.pieces)
    monkeypatch.setattr(sentence_pieces, "CACHED_CHARS", 400)
    learned, plain = [], own.learned
    monkeypatch.setattr(own, "learned", lambda word: learned.append(word) or plain(word))
    for i in range(60):
        own.round_trip(f"again and again {data.prose(i, 5)}x{i}")
    assert learned.count("again") == learned.count("and") == 1
    assert sum(map(len, own.known)) + sum(map(len, own.old)) < 1600
