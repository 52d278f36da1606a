"""Faults that show only in larger tables than the given ones, on tables made for them."""

import hashlib
import random

import pyarrow as pa
import pytest

from cohortry.operators import association, blocks, labels, models, sequences
from cohortry.plans import bindings, evidence, modelling, registry


def test_accessions_repeat_in_other_catalogues(spark, tmp_path):
    spark.createDataFrame([(k, "F") for k in (2, 3, 100_002, 100_003)], "o_orderkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    got = registry.queries()["fea15_catalogue_prepare"](spark, str(tmp_path)).collect()
    assert sorted((r["protein_id"], r["sequence"], r["accession_candidate"]) for r in got) == [("P00002", "SEQ100002", "P00002"), ("P00002", "SEQ2", "P00002"), ("x100003", "SEQ100003", None), ("x3", "SEQ3", None)]


def test_signatures_of_other_studies_are_kept(spark, tmp_path):
    # both parts are the k-mer of residues 1, 0, 0, 0 and pass, study-wide and within their comparison
    parts = [(p, "n", "Brand#1", "T", 1) for p in (15, 960_015)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(7, 15, 1), (8, 960_015, 1)], "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(7, 1), (8, 1)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    found = {n: registry.queries()[n](spark, str(tmp_path)).collect() for n in ("fea19_frozen_signature_select", "agg06_unit_evidence_state", "jon08_frozen_signature_query", "jon08_unit_hits")}
    q = {"STUDY_WIDE": round(960_015 * 29 % 983 / 1e4, 7), "WITHIN_COMPARISON": round(15 * 13 % 991 / 1e4, 7)}
    assert sorted((r["fdr_scope"], r["q_value"]) for r in found["fea19_frozen_signature_select"]) == sorted(q.items())
    assert [(r["unit_id"], r["call"]) for r in found["agg06_unit_evidence_state"]] == [(1, "PRESENT")]
    assert [(r["reference_features"], r["present"], r["unknown"]) for r in found["jon08_frozen_signature_query"]] == [(2, 2, 0)]
    assert [(r["positives"], r["q_value"]) for r in found["jon08_unit_hits"]] == [(4, min(q.values()))]


def test_half_thousands_round_to_even(spark, tmp_path):
    spark.createDataFrame([(1, 1, "F", 4500.0), (2, 2, "F", 5500.0)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([], "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([], "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    name = "win07_unit_representative"
    got = sorted(tuple(r) for r in registry.queries()[name](spark, str(tmp_path)).collect())
    assert got == sorted(_duckdb(tmp_path, name)) == [(1, 1, 4), (2, 2, 6)]


def _duckdb(folder, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for file in folder.glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}{'/*.parquet' if file.is_dir() else ''}')")
    return db.execute(registry.oracle_sql()[name]).fetchall()


def test_digest_trees_of_the_sql_have_levels_enough(spark, tmp_path):
    n = 64**3 + 1
    spark.range(n).selectExpr("id AS doc_id", "'ACD' AS text", "'en' AS lang", "'s' AS source").write.parquet(str(tmp_path / "documents.parquet"))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    lines = [f"{k}\t{digest('ACD')}\n" for k in range(n)]
    while len(lines) > 1:
        lines = [digest("".join(lines[k : k + 64])) for k in range(0, len(lines), 64)]
    assert _duckdb(tmp_path, "agg12_cohort_digest") == [("en", lines[0])]


def test_batches_of_sequences_are_cut():
    texts = ["A" * 400_000, None, "C" * 700_000, "D" * 2_500_000, "", "E"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["sequence"])
    pieces = [p.column("sequence").to_pylist() for p in sequences._pieces(batch)]
    assert sum(pieces, []) == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= sequences.PIECE_LETTERS for p in pieces)


def test_kmers_of_long_batches_are_counted(spark):
    rows = [(k, "ACDEF"[k % 3 :] * 40_000) for k in range(12)]
    proteins = spark.createDataFrame(rows, "protein_id long, sequence string").coalesce(1)
    want = {}
    for _, text in rows:
        for kmer in {text[i : i + 3] for i in range(len(text) - 2)}:
            want[kmer] = want.get(kmer, 0) + 1
    assert {r["kmer"]: r["proteins"] for r in sequences.kmer_prevalence(proteins, [3]).collect()} == want


def test_many_occurrences_in_one_sequence(spark):
    # 200,000 occurrences: slices of the parts before each would be 20 billion additions
    df = spark.createDataFrame([(1, "THE" * 200_000), (2, "TTHETHE"), (3, None)], "k int, s string")
    got = {r["k"]: r["at"] for r in df.select("k", sequences.occurrences(df["s"], "THE").alias("at")).collect()}
    assert got == {1: list(range(1, 600_000, 3)), 2: [2, 5], 3: None}


def test_clusters_of_numbers_and_of_texts_agree(spark):
    rng = random.Random(3)
    rows = [(u, "F", "T", "1", rng.randrange(300), rng.randrange(300), 0.7) for u in ("x", "y") for _ in range(260)]
    names = "comparison_universe_id string, coverage_scope string, comparison_tool string, comparison_tool_version string, protein_a_id {0}, protein_b_id {0}, tm_score double"
    parts = spark.createDataFrame([(k, "VALIDATION" if k % 5 == 0 else "DISCOVERY") for k in range(300)], "protein_id long, partition string")
    numbers = blocks.structure_clusters(spark.createDataFrame(rows, names.format("long")), parts)
    texts = spark.createDataFrame([(*r[:4], str(r[4]), str(r[5]), r[6]) for r in rows], names.format("string"))
    texts = blocks.structure_clusters(texts, parts.withColumn("protein_id", parts["protein_id"].cast("string")))
    columns = ["cluster_id", "protein_id", "membership_method", "supporting_edge_count", "member_count", "reference_member_count", "edge_count"]
    take = lambda df: sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    assert len(take(numbers)) > 100 and take(numbers) == take(texts)
    assert dict(blocks._component_members(spark.createDataFrame([("s", 1, 2)], "k string, a long, b long"), ["k"]).dtypes)["component"] == "bigint"


def test_predictions_need_no_explanations(spark, monkeypatch):
    def unwanted(*_):
        raise AssertionError("made without being asked for")

    monkeypatch.setattr(models, "permutation_importance", unwanted)
    monkeypatch.setattr(models, "linear_contributions", unwanted)
    monkeypatch.setattr(modelling, "_FITTED", {})
    assert "probability" in registry.queries()["mlx07_predictions"](spark, "/root/testdata/sf0.001").columns


def _counted(monkeypatch, module, name, key=lambda *a, **k: "calls"):
    """How often a function of a module is called, by ``key`` of its arguments."""
    calls, own = {}, getattr(module, name)

    def counting(*a, **k):
        calls[key(*a, **k)] = calls.get(key(*a, **k), 0) + 1
        return own(*a, **k)

    monkeypatch.setattr(module, name, counting)
    return calls


def test_both_partitions_are_counted_in_one_pass(spark, monkeypatch):
    made = _counted(monkeypatch, bindings, "frame", lambda spark, d, name, **_: name)
    passes = _counted(monkeypatch, association, "assessed_blocks")
    assert registry.queries()["sta04_bh_study"](spark, "/root/testdata/sf0.001").columns[-1] == "study_q_value"
    assert passes == {"calls": 1} and made["positives"] == made["domain_assessments"] == 1


def test_blocks_of_many_universes(spark):
    # 200 universes make four words; assessed rows repeat, blocks are mixed, partly assessed or not at all
    rng = random.Random(5)
    members = [("C", part, rng.randrange(12), p, rng.random() < 0.5) for p in range(60) for part in ("DISCOVERY",)]
    members = [(c, part, u, p, t if u == 0 else u % 2 == 0) for c, part, u, p, t in members]
    assessed = [(f"U{n}", p) for n in range(200) for p in range(60) if rng.random() < 0.9 for _ in range(1 + p % 2)]
    universes = [("T", f"f{n}", f"U{n}") for n in range(200)] + [("K", "k", None), ("T", "none", "POSITIVES")]
    positives = [(p, t, f) for t, f, _ in universes for p in range(60) if rng.random() < 0.1]
    tables = [(members, "comparison_id string, partition string, unit int, protein_id int, is_target boolean"), (positives, "protein_id int, feature_type string, feature_id string"), (universes, "feature_type string, feature_id string, universe string"), (assessed, "universe string, protein_id int")]
    got = {(r["feature_type"], r["feature_id"]): tuple(r[f"{n}_{k}"] for n in ("target", "background") for k in ("with", "present", "absent", "unknown")) for r in association.feature_block_counts(*[spark.createDataFrame(*t) for t in tables]).collect()}
    blocks, inside, want = {}, set(assessed), {}
    for _, _, u, p, t in members:
        blocks.setdefault(u, []).append((p, t))
    for kind, name, universe in universes:
        have, row = {p for p, t, f in positives if (t, f) == (kind, name)}, []
        for side in (True, False):
            pure = [[p for p, _ in b] for b in blocks.values() if {t for _, t in b} == {side}]
            present = sum(any(p in have for p in b) for b in pure)
            absent = sum(not any(p in have for p in b) and (universe is None or all((universe, p) in inside for p in b)) for b in pure)
            row += [sum(p in have for b in blocks.values() for p, t in b if t == side), present, absent, len(pure) - present - absent]
        if have:
            want[kind, name] = tuple(row)
    assert got == want and sum(r[2] for r in got.values()) > 100


def test_definitions_find_domains_once(spark, monkeypatch):
    found = _counted(monkeypatch, labels, "domain_evidence")
    lines = _counted(monkeypatch, evidence, "evidence")
    assert registry.queries()["fea10_label_definitions"](spark, "/root/testdata/sf0.001").columns == ["label_id", "feature_type", "feature_id", "rule_id"]
    assert found == lines == {"calls": 1}


def test_domains_without_id_or_name(spark):
    rules = [labels.Rule("r", "L", required=("^A", "x$"), supporting=("x",)), labels.Rule("s", "M")]
    rows = [(1, "B", "x"), (1, "A", "x"), (1, "A", "x"), (2, None, "x"), (2, "C", None), (3, None, None), (3, "Ax", None)]
    domains = spark.createDataFrame(rows, "protein_id int, domain_id string, domain_name string")
    got = {tuple(r) for r in labels.domain_evidence(domains, rules).collect()}
    assert got == {(1, "r", "REQUIRED_DOMAIN", "A", 2.0, 2), (1, "r", "SUPPORTING_DOMAIN", "A", 1.0, 1), (2, "r", "REQUIRED_DOMAIN", None, 2.0, 1), (2, "r", "SUPPORTING_DOMAIN", None, 1.0, 1), (3, "r", "REQUIRED_DOMAIN", "Ax", 2.0, 2), (3, "r", "SUPPORTING_DOMAIN", "Ax", 1.0, 1)}
    assert labels.domain_evidence(domains, rules[1:]).columns == ["protein_id", "rule_id", "kind", "domain_id", "score", "patterns"]


def test_signatures_make_positives_once(spark, monkeypatch):
    made = _counted(monkeypatch, bindings, "frame", lambda spark, d, name, **_: name)
    registry.queries()["agg18_evidence_class_counts"](spark, "/root/testdata/sf0.001")
    assert made["positives"] == made["exploratory"] == 1


def test_stand_ins_in_fewer_passes_have_the_rows_of_the_sql(spark, tmp_path):
    # keys repeat, are null or have no partner
    rng = random.Random(22)
    key, some = lambda n: rng.choice([None, *range(n)]), lambda *of: rng.choice([None, *of])
    segments = ("BUILDING", "MACHINERY", "FURNITURE", "X")
    tables = {
        "customer": ([(key(40), some(*segments)) for _ in range(60)], "c_custkey long, c_mktsegment string"),
        "orders": ([(key(300), key(50), some("O", "F", "P")) for _ in range(500)], "o_orderkey long, o_custkey long, o_orderstatus string"),
        "part": ([(key(50), some("Brand#1", "Brand#2", "Brand#23"), some("PROMO", "small")) for _ in range(60)], "p_partkey long, p_brand string, p_type string"),
        "lineitem": ([(key(320), key(60), key(6), some(10.0, 45.0, 48.0), some("A", "N", "R"), some("O", "F")) for _ in range(2000)], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    given = {n: spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in tables}
    for name in ("positives", "domain_assessments"):
        used = {n: df for n, df in given.items() if f"{{{n}}}" in bindings.SHARED[name]}
        want, got = spark.sql(bindings.SHARED[name], **used), bindings.frame(spark, str(tmp_path), name)
        assert got.dtypes == want.dtypes and len(got.collect()) > 300
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), name


def test_lines_are_joined_once_for_all_features(spark):
    plan = lambda name: bindings.frame(spark, "/root/testdata/sf0.001", name)._jdf.queryExecution().optimizedPlan().toString()
    assert {name: plan(name).count("Join ") for name in ("positives", "domain_assessments")} == {"positives": 4, "domain_assessments": 1}


def test_local_values_need_no_held_out_tests(spark, monkeypatch):
    passes = _counted(monkeypatch, association, "adjusted")
    registry.queries()["sta03_bh_local"](spark, "/root/testdata/sf0.001")
    assert passes == {"calls": 1}


def test_members_meet_all_evidence_in_one_pass(spark, monkeypatch):
    passes = _counted(monkeypatch, association, "block_items")
    registry.queries()["sta05_association_pipeline"](spark, "/root/testdata/sf0.001")
    assert passes == {"calls": 1}


def test_figures_of_many_blocks_stay_in_range(spark):
    # four sums of 120,000 blocks multiply beyond a long
    rows = spark.range(240_000).selectExpr("CAST(id % 2 AS INT) AS target", "CASE WHEN id % 8 < 6 THEN 0.25 + id % 2 / 2e0 ELSE 0.75 - id % 2 / 2e0 END AS probability")
    got = models.ranking_metrics(rows).first()
    assert abs(got["matthews_correlation"] - 0.5) < 1e-12 and abs(got["balanced_accuracy"] - 0.75) < 1e-12


def test_contributions_take_no_row_for_every_sample_and_feature(spark):
    rng = random.Random(6)
    table = [(c, "T", f"f{at}", at, rng.choice((-2.0, -1.0, 0.0, 1.0, 2.0)), rng.choice((0.25, 0.5, 0.75))) for c in ("c", "e") for at in range(1, 13)]
    samples = [(c, k) for c in ("c", "e") for k in range(30)] + [("without a model", 1)]
    positives = [(k, "T", f"f{at}") for k in range(25) for at in range(15) if rng.random() < k / 20] * 2
    frame = spark.createDataFrame(table, "comparison_id string, feature_type string, feature_id string, at int, coefficient double, mean double")
    given = spark.createDataFrame(samples, "comparison_id string, protein_id long"), spark.createDataFrame(positives, "protein_id long, feature_type string, feature_id string")
    own = set(positives)
    for top in (None, 1, 4, 40):
        got = models.linear_contributions(*given, frame.drop("mean"), frame.drop("coefficient", "at"), top)
        want = []
        for c, k in samples:
            values = [(f, at, b, m, int((k, t, f) in own)) for name, t, f, at, b, m in table if name == c]
            ranked = sorted(values, key=lambda x: (-abs(x[2] * (x[4] - x[3])), x[1]))
            want += [(c, k, "T", f, v, m, b, b * (v - m), r) for r, (f, _, b, m, v) in enumerate(ranked[:top], 1)]
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
        # samples are ranked where they stand
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and plan.count("Generate posexplode") == 1


def test_means_of_places_are_those_of_features(spark):
    rng = random.Random(9)
    samples = [(c, k, "VALIDATION" if k % 5 == 0 else "DISCOVERY", k // 3, k // 3 % 2) for c in ("c", "e") for k in range(90)]
    positives = sorted({(rng.randrange(90), "T", f"f{rng.randrange(6)}") for _ in range(200)})
    own = spark.createDataFrame(samples, "comparison_id string, protein_id long, partition string, unit long, target int")
    have = spark.createDataFrame(positives, "protein_id long, feature_type string, feature_id string")
    chosen = spark.createDataFrame([(c, "T", f"f{at}", at) for c, last in (("c", 7), ("e", 3)) for at in range(1, last + 1)], "comparison_id string, feature_type string, feature_id string, place int")
    want = models.discovery_means(own, have, chosen)
    got = models.place_means(models.feature_rows(own, have, chosen), chosen.withColumn("at", chosen["place"] - 1))
    rows = [sorted((r["comparison_id"], r["feature_id"], *(round(r[c], 12) for c in ("mean", "target_mean", "background_mean"))) for r in df.collect()) for df in (got, want)]
    assert got.columns == want.columns and rows[0] == rows[1] and len(rows[0]) == 10 and min(r[2] for r in rows[0]) == 0


def test_models_make_positives_once(spark, monkeypatch):
    made = _counted(monkeypatch, bindings, "frame", lambda _spark, _d, name, **_: name)
    monkeypatch.setattr(models, "fit_comparisons", lambda *_: None)
    monkeypatch.setattr(modelling, "_FITTED", {})
    modelling.fitted(spark, "/root/testdata/sf0.001")
    assert made["positives"] == 1


def test_features_are_counted_before_they_are_looked_up(spark):
    samples = spark.createDataFrame([("c", k, "DISCOVERY", k, k % 2) for k in range(9)], "comparison_id string, protein_id long, partition string, unit long, target int")
    positives = spark.createDataFrame([(k, "T", f) for k in range(9) for f in ("a", "b", "z")[: 1 + k % 3]], "protein_id long, feature_type string, feature_id string")
    complete = spark.createDataFrame([("c", "T", "b"), ("c", "T", "z"), ("c", "T", "none")], "comparison_id string, feature_type string, feature_id string")
    got = models.select_features(samples, positives, complete)
    assert [tuple(r) for r in got.orderBy("place").collect()] == [("c", "T", "b", 6, 1), ("c", "T", "z", 3, 2)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("Aggregate [comparison_id#")
