"""Encoding by distinct words and decoding by pieces against the library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortry.llm import bpe_words

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(9)
    alphabet = "ab  \n\t.'’é漢😀\xa0\u3000\u2003\u0085\u200b\x00|<>1\xb2\u0301\u180e\ufeff\x1c"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    out += ["<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>  x", "<|endoftext", "it's  we'll 'S", " lead", "trail  ", "\n \n  a", "x" * 5000, " " * 3000 + "y", "ab " * 40_000, None, "", " "]
    return out + out[:5]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(k if k % 7 else None, t, f"{t}", [1], 3) for k, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, words string, ids array<int>, block int").repartition(3)


@pytest.mark.parametrize("small", [False, True])
def test_round_trip_against_the_library(frame, library, monkeypatch, small):
    if small:
        monkeypatch.setattr(bpe_words, "BUCKET_WORDS", 40)
        monkeypatch.setattr(bpe_words, "BLOCK_BYTES", 500)
        monkeypatch.setattr(bpe_words, "IDS_OUT", 30)
        monkeypatch.setattr(bpe_words, "ENCODED", 5)
    got = bpe_words.decode(bpe_words.encode(frame, PATH), PATH).collect()
    want = [(k if k % 7 else None, library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts())]
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in got) == sorted((k or -1, ids) for k, ids in want)
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in got)
    assert sorted(r["decoded"] for r in got) == sorted(t or "" for t in texts())


def test_words_never_join_across_an_edge(library):
    """The place before a blank parts ids whatever characters stand around it: every character of the first plane is tried before it."""

    def one(text):
        return library.encode(text, add_special_tokens=False).ids

    import re

    edge = re.compile(bpe_words.EDGE)
    odd = []
    for code in [*range(1, 0xD800), *range(0xE000, 0x10000)]:
        text = f"a{chr(code)} b"
        if len(parts := edge.split(text)) > 1 and sum(map(one, parts), []) != one(text):
            odd.append(hex(code))
    assert odd == []


def test_any_ids_decode_as_in_the_library(spark, library):
    rng = random.Random(3)
    lists = [[rng.randrange(50_257) for _ in range(rng.randint(0, 30))] for _ in range(200)] + [None, [], [50_256, 70_000, -1, 5]]
    got = bpe_words.decode(spark.createDataFrame([(k, x, "old") for k, x in enumerate(lists)], "k int, ids array<int>, decoded string"), PATH).collect()
    for r in got:
        ids = lists[r["k"]]
        assert r["decoded"] == (None if ids is None else library.decode([i for i in ids if 0 <= i < 50_257], skip_special_tokens=False))


def test_no_rows(frame):
    assert bpe_words.decode(bpe_words.encode(frame.filter("doc_id = -1"), PATH), PATH).count() == 0


def test_a_tokenizer_that_joins_words_is_refused():
    with pytest.raises(ValueError):
        bpe_words.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
