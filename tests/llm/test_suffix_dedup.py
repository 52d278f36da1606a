"""Repeats in very long texts and in rows that are repeated very often."""

import hashlib
import random
import time

from cohortry.llm import suffix_dedup


def noise(n, seed):
    rng = random.Random(seed)
    return rng.randbytes(n).translate(bytes(65 + b % 57 if 65 + b % 57 not in (97,) else 66 for b in range(256))).decode()


def removed(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(frame).select("doc_id", "n_removed", "n_spans").collect()}


def test_a_string_is_found_wherever_it_stands_in_a_long_text(spark):
    run = "a" * 200
    near = noise(1000, 1) + run + noise(500, 2)
    far = noise(16_777_166, 3) + run + noise(300, 4)
    edge = noise(suffix_dedup.PIECE - 77, 5) + run + noise(300, 6)
    assert removed(spark, [near, far, edge]) == {0: (200, 1), 1: (200, 1), 2: (200, 1)}
    mixed = "".join(chr(97 + k % 23) for k in range(150)) + noise(90, 7)
    assert removed(spark, [noise(1000, 8) + mixed, noise(2 * suffix_dedup.PIECE - 100, 9) + mixed]) == {0: (240, 1), 1: (240, 1)}


def test_pieces_give_what_one_piece_gives(monkeypatch):
    import numpy as np

    rng = random.Random(2)
    parts = [("ab" * 300)[: rng.randint(0, 500)] + noise(rng.randint(0, 900), k) for k in range(12)]
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def strings(found):
        return sorted((r, lo + k, lo + off, a) for r, lo, n, off, a in zip(*(found[c].tolist() for c in ("row", "lo", "n", "off", "anchor")), strict=True) for k in range(n))

    want = strings(suffix_dedup.stretches(data, offsets))
    for piece in (1, 37, 500):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        assert strings(suffix_dedup.stretches(data, offsets)) == want


def test_ten_thousand_repeats_of_a_row(spark):
    text, other = noise(4200, 11), noise(2000, 12)
    rows = [(1, text)] * 10_000 + [(2, other), (None, other[:900]), (None, other[:900]), (3, None), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    began = time.time()
    got = suffix_dedup.remove_repeats(frame).groupBy("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").count().collect()
    assert time.time() - began < 60
    none = hashlib.sha256(b"").hexdigest()
    left = hashlib.sha256(other[900:].encode()).hexdigest()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 4200, 4200, 1, none, 10_000), (2, 2000, 900, 1, left, 1), (None, 900, 900, 1, none, 2), (3, 0, 0, 0, none, 2)], key=str)
