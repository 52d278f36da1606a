"""Every operator against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortry.llm import containment, graph_search, jaccard, language, licenses, mixing, shards, suffix_dedup, token_counts, token_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(40, 160)) for _ in range(25)]
    texts += [texts[0], texts[0], texts[1] + " tail", "Head " + texts[2], texts[3][:500], None, "", "   ", "one", "One two", "ab" * 400, texts[4] * 3]
    near = texts[5].split(" ")
    near[7] = "changed"
    texts += [" ".join(near), texts[6].upper(), prose(rng, 6000)]
    out = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None) for i, t in enumerate(texts)]
    return out + [out[0], (None, "no id", "en", "s1"), (None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns of clashing names must not matter
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, source string, size int, shard string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id = -1")


def test_suffix_dedup(docs, none, rows):
    want, data = [], [(r[1] or "").encode() for r in rows]
    seen = collections.Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    for r, b in zip(rows, data, strict=True):
        mark = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                mark[p : p + 200] = b"\1" * 200
        kept = bytes(x for x, y in zip(b, mark, strict=True) if not y)
        want.append((r[0], len(b), sum(mark), sum(1 for k in range(len(b)) if mark[k] and (k == 0 or not mark[k - 1])), hashlib.sha256(kept).hexdigest()))
    for batch in (4, 8192):
        got = [tuple(r) for r in suffix_dedup.remove_repeats(docs, batch=batch).drop("kept").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_family_merges_geometrically():
    rng = random.Random(1)
    family = suffix_dedup.Family(batch=2)
    same = bytes(rng.randrange(256) for _ in range(230))
    for k in range(7):
        texts = [bytes(rng.randrange(256) for _ in range(230)), same if k in (1, 6) else bytes(rng.randrange(256) for _ in range(230))]
        family.add(texts, np.array([20, 20]), np.array([1, 1]))
    assert sorted(family.levels) == [1, 2, 4]
    assert np.flatnonzero(family.marks.any(axis=1)).tolist() == [3, 13]


def test_token_counts_equal_library(docs, none, rows):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = token_counts.zipf_vocabulary(path)
    for vocabulary, texts in ((pieces, [r[1] or "" for r in rows]), ([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("▁", -1.0), ("▁a", -2.0)], ["".join(random.Random(k).choices("abc \nx", k=k % 15)) for k in range(400)])):
        library = Tokenizer(models.Unigram([("<unk>", min(s for _, s in vocabulary)), *vocabulary], unk_id=0))
        library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        counter = token_counts.Counter(vocabulary)
        for t in texts:
            assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids)
    got = sorted(tuple(r) for r in token_counts.count_tokens(docs.filter("doc_id is not null"), path).collect())
    counter = token_counts.Counter(pieces)
    assert got == sorted((r[0], counter.count(r[1] or "")) for r in rows if r[0] is not None)
    assert token_counts.count_tokens(none, path).count() == 0


@pytest.mark.parametrize("kind", [token_files.BIT, token_files.BYTE])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 16384, 16385, 40000):
        for most in (49408, 2**32 - 1):
            ids = rng.integers(0, most, n, dtype=np.uint32)
            image = token_files.pack(ids, kind=kind)
            assert (token_files.unpack(image) == ids).all()
            assert (token_files.unpack(image, 1, 2) == ids[16384:32768]).all()


def test_token_files(spark, docs, none, rows, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = token_files.Encoder(path)
    odd = ["", "  ", "a\tb\x1cc d <|endoftext|> x<|startoftext|>y", "́a é ́", "İ Σς", "don't we'll '", "a\n\nb\r\nc", "a. b, .c ,. a.. A.,", "|", "a|b | |"]
    for t in odd:
        assert coder.encode(t).tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids
    token_files.write_tokens(docs, str(tmp_path / "t"), path, segment_ids=3000)
    got = sorted((tuple(r) for r in token_files.read_tokens(spark.read.parquet(str(tmp_path / "t")), ids=True).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([r[0] for r in rows], key=lambda k: -1 if k is None else k)
    start, own = 0, {r[0]: r[1] for r in rows if r[0] is not None}
    for key, at, n, crc, ids in got:
        assert at == start and n == len(ids) and ids[-1] == 2
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        if key is not None:
            assert ids[:-1] == coder.tokenizer.encode(own[key] or "", add_special_tokens=False).ids
        start += n
    token_files.write_tokens(none, str(tmp_path / "n"), path)
    assert token_files.read_tokens(spark.read.parquet(str(tmp_path / "n"))).count() == 0


def test_smallest_capacity_against_search():
    rng = random.Random(2)
    for _ in range(200):
        runs = [(rng.randint(1, 30), rng.randint(1, 4)) for _ in range(rng.randint(1, 8))]
        atoms, k = [s for s, c in runs for _ in range(c)], rng.randint(1, 5)

        def parts(capacity, atoms=atoms):
            n, left = 1, capacity
            for a in atoms:
                if a > left:
                    n, left = n + 1, capacity
                left -= a
            return n

        want = next(c for c in range(max(atoms), sum(atoms) + 1) if parts(c) <= k)
        assert shards.smallest_capacity([s for s, _ in runs], [c for _, c in runs], k) == want
        assert len(shards.greedy_ends([s for s, _ in runs], [c for _, c in runs], want)) == parts(want)


def test_minimax_shards(docs, none, rows):
    got = shards.minimax_shards(docs, 5).collect()
    assert len(got) == len(rows) and {r["shard"] for r in got} <= set(range(5))
    by_text = collections.defaultdict(set)
    for r in got:
        by_text[r["text_crc32"]].add(r["shard"])
    assert all(len(v) == 1 for v in by_text.values())
    for k in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert shards.minimax_shards(none).count() == 0


def grams(text, n, whole=False):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w and whole else set()


def test_contaminated(spark, docs, none, rows):
    items = [(0, " ".join(rows[0][1].split()[5:25])), (1, " ".join(rows[24][1].split()[3:9])), (2, "too short"), (3, None), (4, " ".join(rows[39][1].split()[4000:4040])), (5, prose(random.Random(9), 20)), (6, " ".join([*rows[7][1].split()[5:30], "not", "there"]))]
    bench = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    want = sorted(((d[0], i, len(g), len(g & grams(d[1], 5))) for d in rows for i, t in items for g in [grams(t, 5)] if g and len(g & grams(d[1], 5)) >= 0.8 * len(g)), key=str)
    for block in (containment.BLOCK_SHINGLES, 40):
        assert sorted((tuple(r)[:4] for r in containment.contaminated(docs, bench, block=block).collect()), key=str) == want
    assert want and containment.contaminated(none, bench).count() == 0
    assert containment.contaminated(docs, bench.filter("item_id < 0")).count() == 0


def test_graph_search_recall(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.5, 2, (900, 1))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    bad = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (None, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    index = graph_search.build_index(df, shard_rows=300)
    got = collections.defaultdict(list)
    for r in graph_search.search(index, df.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    v = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 900, 20):
        s = v @ v[q]
        s[q] = -np.inf
        hits += len({i for i, _ in got[q]} & set(np.argsort(-s)[:20].tolist()))
        assert len(got[q]) == 20 and got[q] == sorted(got[q], key=lambda t: (-t[1], t[0]))
        assert all(abs(s[i] - score) < 1e-9 for i, score in got[q])
    assert hits >= 0.9 * 20 * 45 and sorted(got) == list(range(0, 900, 20))
    few = df.filter("vec_id < 8")
    assert graph_search.search(graph_search.build_index(few), few.filter("vec_id = 0")).count() == 7
    assert graph_search.search(graph_search.build_index(df.filter("vec_id < 0")), few).count() == 0


def brute_components(rows, n=3, percent=90):
    sets = [grams(r[1], n, True) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), low.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)


def test_jaccard_components(docs, none, rows):
    assert sorted((tuple(r) for r in jaccard.jaccard_components(docs).collect()), key=str) == brute_components(rows)
    assert jaccard.jaccard_components(none).count() == 0


def test_jaccard_of_frequent_tokens_and_pieces(spark, monkeypatch):
    rng = random.Random(8)
    base = prose(rng, 90).split()
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "FREQUENT", 20)
    monkeypatch.setattr(jaccard, "PIECE", 16)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_language(spark, docs, none):
    rng = random.Random(1)
    words = {"aa": ["the", "of", "and", "thing", "other"], "bb": ["der", "und", "zwischen", "schön", "nicht"], "cc": ["que", "para", "ción", "muy", "hoy"]}
    rows = [(i, " ".join(rng.choices(words[n], k=rng.randint(8, 300))), n) for i, n in enumerate(rng.choices(sorted(words), k=240))]
    train = spark.createDataFrame(rows[:160], "doc_id long, text string, lang string")
    model = language.fit(train)
    got = {r["doc_id"]: r for r in language.predict(spark.createDataFrame(rows[160:], "doc_id long, text string, lang string"), model).collect()}
    assert sum(got[i]["lang_pred"] == n for i, _, n in rows[160:]) >= 78
    assert all(0 <= r["score"] <= 1 for r in got.values())
    odd = {r["text"]: r for r in language.predict(spark.createDataFrame([(None,), ("",), ("123 !",), ("der und " * 4000,)], "text string"), model).collect()}
    assert [odd[t]["lang_pred"] for t in (None, "", "123 !")] == ["und"] * 3 and odd["der und " * 4000]["lang_pred"] == "bb"
    assert language.predict(none, model).count() == 0
    assert language.predict(train.limit(2), language.fit(train.filter("doc_id < 0"))).filter("lang_pred <> 'und'").count() == 0


def test_mixture(docs, none, rows):
    size = lambda t: len(WORD.findall(t or ""))
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.capped_targets([sizes[s] for s in order], [1 + k % 3 for k in range(len(order))]), strict=True))
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6 and all(targets[s] <= 3 * sizes[s] + 1e-9 for s in order)
    for block in (7, 64, 1024):
        mix = mixing.Mixture(docs, block=block)
        got = [tuple(r) for r in mix.taken().collect()]
        assert len(got) == len(rows) and all(t <= 3 * n for _, n, _, _, t in got)
        taken = collections.Counter()
        for _, _, s, _, t in got:
            taken[s] += t
        want = collections.Counter()
        for s in order:
            want[sizes[s]] += int(targets[s] + 0.5)
        assert taken == want
        assert sorted(map(str, got)) == sorted(map(str, [tuple(r) for r in mixing.Mixture(docs, block=block).taken().collect()]))
        made = mix.documents()
        assert made.columns == docs.columns and sum(size(r["text"]) for r in made.collect()) == sum(want.values())
    assert mixing.Mixture(none).taken().count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation_and_counts(spark, n):
    rows = []
    for key in (5, 6):
        p = mixing.Permutation(n, key)
        columns = [F.lit(x).cast("long") for x in (n, key, p.wide, p.high)]
        to = [r["to"] for r in spark.range(n).select("id", mixing.Permutation.column(F.col("id"), *columns).alias("to")).orderBy("id").collect()]
        assert sorted(to) == list(range(n)) and [p.inverse(y) for y in to] == list(range(n))
        rows.append(to)
    if n > 50:
        # neighbours are at no fixed distance, and keys differ
        assert rows[0] != rows[1] and len({(y - x) % n for x, y in zip(rows[0], rows[0][1:], strict=False)}) > n / 3
    drawn = mixing.draw_counts([100, 7, 0, 33], 6, 1)
    assert drawn.sum(axis=0).tolist() == [100, 7, 0, 33] and max(drawn.sum(axis=1)) - min(drawn.sum(axis=1)) <= 6


def test_licenses(spark, docs, none, rows):
    rng = random.Random(3)
    filler = prose(rng, 3000)
    texts = [(100 + k, f"{filler[: 400 * k]} {t} {filler}") for k, (_, t) in enumerate(licenses.TEMPLATES)] + [(200, filler), (201, None), (202, "")]
    got = collections.defaultdict(set)
    for r in containment.licensed(spark.createDataFrame(texts, "doc_id long, text string"), licenses.TEMPLATES).collect():
        got[r["doc_id"]].add(r["license_id"])
        assert r["containment"] >= 0.8
    for k, (name, t) in enumerate(licenses.TEMPLATES):
        assert name in got[100 + k] or not grams(t, 5)
    assert 200 not in got and containment.licensed(none, licenses.TEMPLATES).count() == 0


def test_words_match_the_pattern():
    from cohortry.llm.words import text_runs, word_spans

    texts = ["a b\tc", None, "", " x", "y\n", "é ü", "\x1cz\x0b"]
    out = []
    for _, text, offsets in text_runs(pa.array(texts)):
        s, e, heads = word_spans(text, offsets)
        out += [[text[s[k] : e[k]].tobytes().decode() for k in range(heads[i], heads[i + 1])] for i in range(len(offsets) - 1)]
    assert out == [WORD.findall(t or "") for t in texts]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "source_mix", "token_files"]


def test_pipeline_stages_decide_by_row(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    base, clean, twin = (prose(rng, 120) for _ in range(3))
    item = prose(rng, 20)
    near = base.split(" ")
    near[60] = "changed"
    near = " ".join(near)
    schema = "doc_id long, text string, source string"
    # repeated rows, near copies without an id, another text under a group's id, and short texts that form no group
    rows = [(3, base, "a"), (3, base, "a"), (None, near, "a"), (None, near, "b"), (3, clean, "a"), (8, twin, "a"), (8, twin, "a"), (None, "", "a"), (None, None, "a"), (None, None, "a")]
    got = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, schema), str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(3, base, "a"), (3, clean, "a"), (8, twin, "a"), (None, "", "a"), (None, None, "a"), (None, None, "a")], key=str)
    # without any id one row still stays
    got = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame([(None, base, "a"), (None, near, "a")], schema), str(tmp_path)).collect()
    assert len(got) == 1

    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(5, clean, "a"), (5, f"{base} {item} {twin}", "a"), (None, f"{twin} {item}", "a"), (None, twin, "a"), (6, f"{item} {base}", "a"), (6, f"{item} {base}", "a"), (7, None, "a"), (5, clean, "a")]
    got = [tuple(r) for r in corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(rows, schema), str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(5, clean, "a"), (5, clean, "a"), (None, twin, "a"), (7, None, "a")], key=str)


@pytest.mark.parametrize("kind", ["long", "equal"])
def test_graph_search_of_long_and_equal_vectors(spark, kind):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 16))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    if kind == "long":
        # a few very long vectors that point away from most queries of the sample
        x[:4] = -x[100:500:100] * np.array([[1e4], [1e5], [1e7], [1e12]])
    else:
        x[200:260] = x[200]
        x[300:900:2] = x[300]
    x = x.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = list(range(100, 1500, 25))
    got = collections.defaultdict(list)
    for r in graph_search.search(graph_search.build_index(df, shard_rows=1500), df.filter("vec_id >= 100 and vec_id % 25 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q in asked:
        s = x @ x[q]
        s[q] = -np.inf
        order = np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:20]
        assert len(got[q]) == 20
        hits += len({i for i, _ in got[q]} & set(order.tolist()))
    assert hits >= 0.95 * 20 * len(asked)
