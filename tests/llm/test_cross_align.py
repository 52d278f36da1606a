"""Alignment of two tokenizers against whole texts, and the perfect hash."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cohortry.llm import bpe_words, cross_align
from cohortry.llm.perfect_hash import PerfectHash

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_every_key_has_its_own_number_and_no_other_is_known():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 70_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        found = PerfectHash.load(*PerfectHash.of(keys).dump())
        assert sorted(found.find(keys).tolist()) == list(range(len(keys)))
        others = np.setdiff1d(rng.integers(0, 2**63, 1000, dtype=np.uint64), keys)
        assert (found.find(others) == -1).all()


def texts():
    rng = random.Random(7)
    out = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) + rng.choice(["", ",", "."]) for _ in range(rng.randint(1, 80))) for _ in range(40)]
    alphabet = "ab  \n\t.'é漢😀\xa0　 \x00|<>1́ﬁ"
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(100)]
    out += ["<|endoftext|> x", "<s> </s> <unk> <0x41>", "marks ▁ stay", "▁", " ", "   ", "\n", "x" * 4000, "ab " * 20_000, "it's  we'll", None, ""]
    return out + out[:6]


def whole(rows):
    """The contract, text by text, byte by byte."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    table = bpe_words.pieces(A).to_pylist()

    def piece(k):
        return bytes([int(b.id_to_piece(k)[3:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()

    links, out = [], []
    for doc, text in rows:
        groups, here, n = [], [], [0, 0]
        if text:
            data = (" " + text).encode()
            left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            if b"".join(table[k] for k in left) == data == b"".join(map(piece, right)):
                n = [len(left), len(right)]
                by_end = {}
                for side, (ids, size) in enumerate(((left, lambda k: len(table[k])), (right, lambda k: len(piece(k))))):
                    at = 0
                    for k in ids:
                        at += size(k)
                        by_end.setdefault(at, [None, None])[side] = k
                group = ([], [])
                for _, ends in sorted(by_end.items()):
                    for side in (0, 1):
                        if ends[side] is not None:
                            group[side].append(ends[side])
                    if None not in ends:
                        here.append(tuple(ends))
                        groups.append("|".join(",".join(map(str, g)) for g in group))
                        group = ([], [])
        links.append(here)
        out.append([doc, *n, ";".join(groups)])
    count = collections.Counter(x for here in links for x in here)
    best = collections.Counter()
    for (_, k), n in count.items():
        best[k] = max(best[k], n)
    for row, here in zip(out, links, strict=True):
        groups = row.pop()
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        row += [len(here), len(here), sum(count[x] == best[x[1]] for x in here), sum(count[x] for x in here), digest, groups]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(k if k % 9 else None, t) for k, t in enumerate(texts())]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([(*r, ["w"], 1, 2) for r in rows], "doc_id long, text string, words array<string>, n_a int, shard int").repartition(3)


def keyed(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("small", [False, True])
def test_counts_against_whole_texts(frame, rows, monkeypatch, small):
    if small:
        for name, value in (("SHARD_PAIRS", 40), ("LEAF_ROWS", 2), ("LOOKUP_LINKS", 300), ("PAIRS_HELD", 50), ("WORDS_KEPT", 100), ("CHILDREN", 2), ("BLOCK_BYTES", 1000)):
            monkeypatch.setattr(cross_align, name, value)
            monkeypatch.setattr(bpe_words, "ENCODED", 7)
    want = [tuple(r[:-1]) for r in whole(rows)]
    assert keyed(tuple(r) for r in cross_align.count_links(frame, A, B).collect()) == keyed(want)


def test_groups_against_whole_texts(frame, rows):
    want = [(r[0], r[1], r[2], r[3], r[-1]) for r in whole(rows)]
    assert keyed(tuple(r) for r in cross_align.align(frame, A, B).collect()) == keyed(want)


def test_no_rows_and_no_tokens(frame):
    assert cross_align.count_links(frame.filter("doc_id = -1"), A, B).count() == 0
    got = cross_align.count_links(frame.filter("text IS NULL OR text = '▁'"), A, B).collect()
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "")}
