"""A whole run of the pipeline, every stage on what the one before kept, against plain Python."""

import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortry.llm import language, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SF = "/root/testdata/sf0.001"
EXTRA = ["_row", "row", "_own0", "id", "salt", "size"]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n, whole):
    w = words(text)
    if len(w) < n:
        return {tuple(w)} if w and whole else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that go into each stage and come out of the last."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for c in EXTRA:
        docs = docs.withColumn(c, F.concat(F.lit(c), "doc_id"))
    # null ids and sources, texts without words, repeated rows
    odd = docs.filter("doc_id in (3, 4)").withColumn("doc_id", F.lit(None).cast("long")).withColumn("source", F.lit(None).cast("string"))
    blank = docs.filter("doc_id = 5").withColumn("text", F.lit(" ")).union(docs.filter("doc_id = 6").withColumn("text", F.lit(None).cast("string")))
    docs = docs.union(odd).union(blank).union(docs.filter("doc_id < 3"))
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name)) + "/t"
        stage(spark, frames[-1], SF).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_stages_keep_the_columns(stages):
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns
        assert frame.filter("doc_id is not null").filter(" or ".join(f"`{c}` <> concat('{c}', doc_id)" for c in EXTRA)).isEmpty()


def test_rejected_languages_go(stages):
    docs, kept = stages[:2]
    model = language.fit(docs)
    accepted = {(r["text"]) for r in language.predict(docs.select("text"), model).filter("accepted").collect()}
    assert rows(kept) == sorted((tuple(r) for r in docs.collect() if r["text"] in accepted), key=str)
    assert len(accepted) > 150 and not accepted & {None, " "}


def test_one_row_of_each_group_stays(stages):
    docs, kept = stages[1:3]
    given = [tuple(r) for r in docs.collect()]
    at = docs.columns.index("text")
    sets = [shingles(r[at], 3, True) for r in given]
    root = list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(given)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(given):
        groups.setdefault(find(i) if sets[i] else ("alone", i), []).append(r)
    got = rows(kept)
    assert len(got) == len(groups)
    for members in groups.values():
        ids = [m[0] for m in members if m[0] is not None]
        best = [m for m in members if m[0] == (min(ids) if ids else None)]
        assert sum(got.count(m) for m in set(members)) == 1 and any(m in got for m in best)


def test_rows_with_benchmark_items_go(spark, stages):
    docs, kept = stages[2:4]
    items = [shingles(r["text"], 5, False) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = [s for s in items if s]
    at = docs.columns.index("text")
    want = [tuple(r) for r in docs.collect() if not any(len(s & own) >= 0.8 * len(s) for own in [shingles(r[at], 5, False)] for s in items)]
    assert rows(kept) == sorted(want, key=str) and len(want) < docs.count()


def test_the_mix_meets_its_targets(stages):
    docs, mixed = stages[3:5]
    given, sizes = {}, {}
    for r in docs.collect():
        given.setdefault((r["doc_id"], r["_row"]), []).append(r)
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.capped_targets([sizes[s] for s in order], [1 + k % 3 for k in range(len(order))]), strict=True))
    taken, by_doc = dict.fromkeys(order, 0), {}
    for r in mixed.collect():
        own = given[r["doc_id"], r["_row"]]
        n = len(WORD.findall(r["text"]))
        taken[r["source"]] += n
        by_doc[r["doc_id"], r["_row"]] = by_doc.get((r["doc_id"], r["_row"]), 0) + n
        assert any(r["source"] == o["source"] and (r["text"] == o["text"] or set(WORD.findall(r["text"])) <= set(WORD.findall(o["text"]))) for o in own)
    for s in order:
        assert abs(taken[s] - targets[s]) <= 1
    for key, n in by_doc.items():
        assert n <= 3 * sum(len(WORD.findall(o["text"] or "")) for o in given[key])


def test_tokens_of_the_mix(stages):
    mixed, tokens = stages[4:6]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(((r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in mixed.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted((tuple(r) for r in tokens.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [r[0] for r in want]
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    import numpy as np

    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted((d or -1, len(ids), crc(ids)) for d, ids in want)
