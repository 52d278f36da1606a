"""Words that fool linear hashes, and operators against independent computations."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import zstandard

from cohortry.llm import containment, graph_search, jaccard, language, licenses, mixing, shards, suffix_dedup, token_counts, token_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def thue_morse(n):
    text = "a"
    while len(text) < n:
        text += text.translate(str.maketrans("ab", "ba"))
    return text


def grams(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]


X = thue_morse(2048)
Y = X.translate(str.maketrans("ab", "ba"))


def test_words_of_a_pattern_are_told_apart(spark):
    coder = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in (f"{X} {Y}", Y, X, f"{X[:1000]} {Y[:1000]} {X}", "<|endoftext|> <|ENDOFTEXT|> x", "<|ENDOFTEXT|> <|endoftext|>", "Ñandú ÉTÉ. don't DON'T x|y e\u0301 İ9"):
        assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    words = lambda w: " ".join([w] * 3 + ["one", "two", "three", w, "four", "five", w])
    docs = spark.createDataFrame([(1, words(X)), (2, words(Y)), (3, words(X))], "doc_id long, text string")
    assert sorted(tuple(r)[::2] for r in jaccard.jaccard_components(docs).collect()) == [(1, 1), (2, 2), (3, 1)]
    items = spark.createDataFrame([(7, words(X))], "item_id long, text string")
    assert sorted(r["doc_id"] for r in containment.contaminated(docs, items).collect()) == [1, 3]
    assert sorted(r["doc_id"] for r in containment.licensed(docs, [("t", words(X))]).collect()) == [1, 3]
    pairs = spark.createDataFrame([(1, X[:600]), (2, Y[:600]), (3, "z" + X[:600])], "doc_id long, text string")
    removed = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(pairs).collect()}
    seen = collections.Counter(t[i : i + 200] for t in (X[:600], Y[:600], "z" + X[:600]) for i in range(len(t) - 199))
    for key, t in ((1, X[:600]), (2, Y[:600]), (3, "z" + X[:600])):
        mark = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                mark[i : i + 200] = b"\1" * 200
        assert removed[key] == sum(mark)


def test_shared_hashes_are_noticed(monkeypatch):
    from cohortry.llm import words

    coder = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(words, "hash_eights", lambda view, starts, sizes, seed=0: np.full(len(starts), 7, np.uint64))
    coder._clear()
    assert coder.encode("some other words").tolist() == coder.tokenizer.encode("some other words", add_special_tokens=False).ids


def test_language_packs_with_every_dictionary(spark):
    rng = random.Random(4)
    words = {"aa": ["the", "of", "and", "thing"], "bb": ["der", "und", "zwischen"], "cc": ["que", "para", "muy"]}
    rows = [(i, " ".join(rng.choices(words[n], k=rng.randint(5, 900))), n) for i, n in enumerate(rng.choices(sorted(words), k=60))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df.filter("doc_id < 40"))
    # ids take no part in the sample
    again = language.fit(df.filter("doc_id < 40").withColumn("doc_id", -df["doc_id"]))
    assert model == again
    odd = [(100, None, None), (101, "", None), (102, "12 !", None), (103, "the und", None), (104, "the und", None)]
    asked = spark.createDataFrame([(i, t, "zz") for i, t, _ in rows[40:] + odd], "doc_id long, text string, lang_pred string")
    got = {r["doc_id"]: r for r in language.predict(asked, model).collect()}
    for i, text, _ in rows[40:] + odd:
        if not text or not any(c.isalpha() for c in text):
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
            continue
        data, sizes = text.lower().encode(), []
        for content in model.contents:
            plain = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            plain.precompute_compress(compression_params=language._settings())
            packer = zstandard.ZstdCompressor(compression_params=language._settings(), dict_data=plain)
            sizes.append(sum(len(packer.compress(data[k : k + language.BLOCK_BYTES])) for k in range(0, len(data), language.BLOCK_BYTES)))
        first, second = sorted(sizes)[:2]
        assert got[i]["lang_pred"] == model.languages[sizes.index(first)]
        assert abs(got[i]["score"] - min(1.0, 10 * (second - first) / second)) < 1e-12 and got[i]["accepted"] == ((second - first) / second >= language.MARGIN)


def test_licenses_against_all_windows(spark):
    rng = random.Random(6)
    filler = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(3, 7))) for _ in range(n))
    templates = [*licenses.TEMPLATES[:5], ("two", licenses.TEMPLATES[0][1] + " and some more words at its end"), ("short", "too few words"), ("same", licenses.TEMPLATES[1][1])]
    texts = [f"{filler(rng.randint(0, 200))} {t} {filler(rng.randint(0, 60))} {t.upper() if k % 2 else ''}" for k, (_, t) in enumerate(templates)]
    cut = licenses.TEMPLATES[2][1].split(" ")
    cut[3] = "other"
    texts += [" ".join(cut), filler(100), "", None]
    rows = [(k, t, 5) for k, t in enumerate(texts)] + [(0, texts[0], 5), (None, texts[1], 5)]
    want = []
    for key, text, _ in rows:
        own, best, count = grams(text, 5), {}, collections.Counter()
        for name, template in templates:
            wanted = set(grams(template, 5))
            if not wanted:
                continue
            size = math.floor(2 ** (math.ceil(2 * math.log2(len(wanted)) - 1e-9) / 2) + 1e-9)
            step = max(1, size // 8)
            width = size + step if size > 1 else 1
            for start in range(0, len(own), step):
                shared = len(wanted & set(own[start : start + width]))
                if shared >= 0.8 * len(wanted):
                    count[name] += 1
                    rank = (shared / len(wanted), len(wanted), -start)
                    if name not in best or rank > best[name][0]:
                        best[name] = (rank, len(wanted), shared, start)
        want += [(key, n, b[1], b[2], b[2] / b[1], b[3], count[n]) for n, b in best.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, license_id int")
    got = [tuple(r) for r in containment.licensed(df, templates).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 8
    assert containment.licensed(df, []).count() == 0


def test_mixture_targets_from_the_rule(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), s) for k, s in enumerate(rng.choices(["b", "a", None, "Z", "tiny"], [9, 5, 3, 6, 0.2], k=300))]
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), list(order), {}
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    taken = collections.Counter()
    for r in mixing.Mixture(spark.createDataFrame(rows, "doc_id long, text string, source string"), block=16).taken().collect():
        source = rows[r["doc_id"]][2]
        assert abs(r["target"] - target[source]) < 1e-6 and r["source_size"] == sizes[source] and r["taken"] <= 3 * r["size"] == 3 * len(WORD.findall(rows[r["doc_id"]][1]))
        taken[source] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)


def test_largest_shard_is_as_small_as_can_be(spark):
    rng = random.Random(3)
    rows = [(k, "x" * rng.choice([0, 5, 60, 61, 200])) for k in range(70)] + [(500, None), (None, "y")]
    got = shards.minimax_shards(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    load, groups = collections.Counter(), collections.defaultdict(int)
    for r in got:
        load[r["shard"]] += r["size"]
        groups[r["shard"], r["text_crc32"]] += r["size"]
    # the groups in the order of the shards they lie in; no cut of this order into as many parts has a smaller largest part
    order = [v for k, v in sorted(groups.items())]
    parts = lambda most: 1 + sum(1 for _ in cuts(order, most))

    def cuts(sizes, most):
        held = 0
        for s in sizes:
            if held + s > most:
                yield held
                held = 0
            held += s

    assert max(load.values()) >= max(order) and parts(max(load.values())) <= 6
    assert len(set(r["text_crc32"] for r in got)) == len(groups) and sum(load.values()) == sum(len(t or "") + 1 for _, t in rows)
    assert {zlib.crc32((t or "").encode()) for _, t in rows} == {c for _, c in groups}


def test_recall_on_the_given_vectors(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    table = pq.read_table(path)
    x = np.array(table["embedding"].to_pylist(), float)
    ids = np.array(table["vec_id"])
    df = spark.read.parquet(path)
    found = collections.defaultdict(set)
    for r in graph_search.search(graph_search.build_index(df), df.filter("vec_id % 20 = 0")).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits, asked = 0, [k for k in range(len(ids)) if ids[k] % 20 == 0]
    for k in asked:
        score = x @ x[k]
        score[k] = -np.inf
        hits += len(found[ids[k]] & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(asked)


def test_vectors_of_other_dimensions_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=3 if k % 3 else 5).tolist(), "x") for k in range(60)]
    df = spark.createDataFrame([*rows, rows[0], rows[1]], "vec_id long, embedding array<double>, score string")
    got = collections.defaultdict(list)
    for r in graph_search.search(graph_search.build_index(df, shard_rows=20), df.filter("vec_id in (0, 1, 2)").dropDuplicates(["vec_id"]), k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q in (0, 1, 2):
        same = [(k, float(np.dot(v, rows[q][1]))) for k, v, _ in [*rows, rows[0], rows[1]] if len(v) == len(rows[q][1]) and k != q]
        want = sorted(same, key=lambda t: (-t[1], t[0]))[:5]
        assert [k for k, _ in got[q]] == [k for k, _ in want]


def test_counts_of_marks_blanks_and_null_keys(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    counter = token_counts.Counter(token_counts.zipf_vocabulary(path))
    texts = ["▁▁a b", " a  b ", "▁", "a▁b c▁", "x" * 300 + " y", "é ü\n z", None, "", X]
    rows = [(k if k else None, t) for k, t in enumerate(texts)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((k, counter.count(t or "")) for k, t in rows), key=str)


def test_empty_tables_pass_every_stage(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "some words that make up an item")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none, str(tmp_path))
        assert out.count() == 0 and out.columns == none.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, none, str(tmp_path)).count() == 0
