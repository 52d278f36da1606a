import math
import random

import pytest
from pyspark.sql import functions as F

from cohortry.operators import association, blocks, checks, sequences, statistics
from cohortry.operators.components import components
from cohortry.sources import readers


def test_fisher_golden_values(spark):
    df = spark.createDataFrame([(8, 2, 1, 9), (0, 0, 0, 0), (1, 0, 0, 1)], "a long, b long, c long, d long")
    rows = statistics.fisher_exact(df.withColumn("key", F.concat_ws(",", "a", "b", "c", "d"))).collect()
    got = {r["key"]: (r["odds_ratio"], r["p_value"]) for r in rows}
    assert got["8,2,1,9"][0] == 36.0 and abs(got["8,2,1,9"][1] - 0.005477494641581322) < 1e-12
    assert got["0,0,0,0"] == (None, 1.0)
    assert math.isinf(got["1,0,0,1"][0])


def test_fisher_against_exact_sums(spark):
    tables = [(a, b, c, d) for a in range(5) for b in range(5) for c in range(5) for d in range(5)]
    df = spark.createDataFrame([(*t, ",".join(map(str, t))) for t in tables], "a long, b long, c long, d long, key string")
    got = {r["key"]: r["p_value"] for r in statistics.fisher_exact(df).collect()}
    for a, b, c, d in tables:
        ways = [math.comb(a + b, x) * math.comb(c + d, a + c - x) for x in range(max(0, a - d), min(a + b, a + c) + 1)]
        want = sum(w for w in ways if w <= math.comb(a + b, a) * math.comb(c + d, c)) / sum(ways)
        assert abs(got[f"{a},{b},{c},{d}"] - want) < 1e-12


def test_wilson_and_bh_golden_values(spark):
    low, high = statistics.wilson(F.lit(5), F.lit(10))
    row = spark.range(1).select(low.alias("l"), high.alias("h")).first()
    assert abs(row["l"] - 0.236593090512564) < 1e-12 and abs(row["h"] - 0.7634069094874361) < 1e-12
    df = spark.createDataFrame([("x", 0.01), ("x", 0.04), ("x", 0.03), ("x", None)], "g string, p_value double")
    got = {r["p_value"]: r["q_value"] for r in statistics.benjamini_hochberg(df, ["g"]).collect()}
    assert [round(got[p], 12) for p in (0.01, 0.04, 0.03)] == [0.03, 0.04, 0.04] and got[None] is None


def test_components_match_union_find(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (40, 30), (60, 55)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        root = list(range(n))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        touched = {x for a, b in edges if a != b for x in (a, b)}
        assert got == {x: find(x) for x in touched}


def test_chain_collapses(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(edges).select("component").distinct().collect() == [(0,)]


def test_blocks_keep_unknown_apart(spark):
    members = spark.createDataFrame(
        [("c", "DISCOVERY", 1, 1, True), ("c", "DISCOVERY", 1, 2, True), ("c", "DISCOVERY", 2, 3, True), ("c", "DISCOVERY", 3, 4, False), ("c", "DISCOVERY", 4, 5, False), ("c", "DISCOVERY", 4, 6, True), ("c", "DISCOVERY", 5, 7, True)],
        "comparison_id string, partition string, unit long, protein_id long, is_target boolean",
    )
    positives = spark.createDataFrame([(1, "F", "f"), (5, "F", "f"), (1, "G", "g"), (1, "H", "h")], "protein_id long, feature_type string, feature_id string")
    universes = spark.createDataFrame([("F", "f", "u"), ("G", "g", None), ("H", "h", "POSITIVES")], "feature_type string, feature_id string, universe string")
    assessed = spark.createDataFrame([("u", k) for k in (1, 3, 4, 5, 6)], "universe string, protein_id long")
    got = {r["feature_type"]: r for r in association.feature_block_counts(members, positives, universes, assessed).collect()}
    # block 1 is present though part of it is unassessed, 2 is absent, 5 unknown, 4 is mixed and leaves both sides
    row = got["F"]
    assert (row["target_present"], row["target_absent"], row["target_unknown"], row["target_with"], row["background_with"]) == (1, 1, 1, 1, 1)
    assert (row["background_present"], row["background_absent"], row["background_unknown"]) == (0, 1, 0)
    # a universal feature is known everywhere, one without a universe nowhere but where it is present
    assert (got["G"]["target_absent"], got["G"]["target_unknown"], got["G"]["background_absent"]) == (2, 0, 1)
    assert (got["H"]["target_absent"], got["H"]["target_unknown"], got["H"]["background_unknown"]) == (0, 2, 1)


def cohort_rows(spark, absent_in_validation=False):
    """Forty target and forty background blocks of one protein in each partition; feature x is in all targets, y in all proteins, z in one."""
    members, positives, k = [], [], 0
    for part in ("DISCOVERY", "VALIDATION"):
        for target in (True, False):
            for _ in range(40):
                members.append(("c", part, k, k, target))
                positives.append((k, "D", "y"))
                if target and not (absent_in_validation and part == "VALIDATION"):
                    positives.append((k, "D", "x"))
                k += 1
    members.append(("few", "DISCOVERY", 500, 500, True))
    positives.append((0, "D", "z"))
    types = "comparison_id string, partition string, unit long, protein_id long, is_target boolean", "protein_id long, feature_type string, feature_id string"
    universes = spark.createDataFrame([("D", n, None) for n in "xyz"], "feature_type string, feature_id string, universe string")
    return spark.createDataFrame(members, types[0]), spark.createDataFrame(positives, types[1]), universes, spark.createDataFrame([], "universe string, protein_id long")


def test_association_statuses_and_frozen_family(spark):
    names = spark.createDataFrame([("c",), ("few",)], "comparison_id string")
    parts = cohort_rows(spark, absent_in_validation=True)
    rows = {(r["comparison_id"], r["partition"], r["feature_id"]): r for r in association.associate(*parts, names).collect()}
    assert rows["c", "DISCOVERY", "x"]["direction"] == "TARGET_ENRICHED" and rows["c", "DISCOVERY", "x"]["q_value"] < 1e-9
    # z is in too few proteins; y has no difference, so only x is tested in the held-out part, where no protein has it
    assert ("c", "DISCOVERY", "z") not in rows and ("c", "VALIDATION", "y") not in rows
    held = rows["c", "VALIDATION", "x"]
    assert (held["target_present"], held["target_absent"], held["status"], held["p_value"]) == (0, 40, "COMPLETE", 1.0)
    assert {k[2] for k in rows if k[0] == "few"} == {"INSUFFICIENT_SAMPLE_SIZE"} and sum(k[0] == "few" for k in rows) == 2
    excluded = association.associate(*parts, names, spark.createDataFrame([("D", "x")], "feature_type string, feature_id string"))
    assert [r["status"] for r in excluded.filter("partition = 'VALIDATION' and feature_id = 'x'").collect()] == ["EXCLUDED"]


def test_evidence_classes(spark):
    row = lambda part, f, q, study, diff, status="COMPLETE", kind="D": ("c", part, kind, f, status, q, study, diff)
    rows = [
        row("DISCOVERY", "both", 0.01, 0.02, 0.5), row("VALIDATION", "both", 0.01, 0.02, 0.4), row("DISCOVERY", "within", 0.01, 0.02, 0.5), row("VALIDATION", "within", 0.01, 0.2, 0.4),
        row("DISCOVERY", "study", 0.01, 0.02, 0.5), row("VALIDATION", "study", 0.2, 0.01, 0.4), row("DISCOVERY", "zero", 0.01, 0.2, 0.5), row("VALIDATION", "zero", 0.9, 0.9, 0.0),
        row("DISCOVERY", "against", 0.01, 0.02, 0.5), row("VALIDATION", "against", 0.01, 0.01, -0.4), row("DISCOVERY", "alone", 0.01, 0.02, 0.5), row("DISCOVERY", "STRUCTURE", 0.01, 0.02, 0.5, kind="STRUCTURE_AVAILABLE"),
        row("DISCOVERY", "all", 0.01, 0.02, 0.5), ("none", "DISCOVERY", "D", "n", "COMPLETE", 0.5, 0.5, 0.1), ("bare", "DISCOVERY", "ANALYSIS", "NO_ELIGIBLE_FEATURES", "NO_ELIGIBLE_FEATURES", None, None, None),
    ]
    df = spark.createDataFrame(rows, "comparison_id string, partition string, feature_type string, feature_id string, status string, q_value double, study_q_value double, prevalence_difference double")
    found = association.synthesize(df, exploratory=spark.createDataFrame([("D", "all")], "feature_type string, feature_id string")).collect()
    got = {r["feature_id"]: r["evidence_class"] for r in found if r["comparison_id"] == "c"}
    assert got == {
        "both": "DECISION_CANDIDATE__VALIDATED_STUDY_WIDE", "within": "DECISION_CANDIDATE__VALIDATED_WITHIN_COMPARISON", "study": "DECISION_CANDIDATE__DISCOVERY_ONLY", "zero": "EXPLORATORY_LOCAL_ONLY__DISCOVERY_ONLY",
        "against": "DECISION_CANDIDATE__DIRECTION_DISCORDANT", "alone": "DECISION_CANDIDATE__NO_VALIDATION_DATA", "STRUCTURE": "QC_TECHNICAL_NON_BIOLOGICAL__NO_VALIDATION_DATA", "all": "EXPLORATORY_ALL_DATA_DERIVATION__NO_VALIDATION_DATA",
    }
    assert {r["comparison_id"]: r["evidence_class"] for r in found if r["comparison_id"] != "c"} == {"none": "NO_DISCOVERY_SIGNATURE", "bare": "DISCOVERY_NOT_TESTED__NO_ELIGIBLE_FEATURES"}


def test_structure_cluster_golden_case(spark):
    pairs = spark.createDataFrame([("u", "F", "t", "1", a, b, s) for a, b, s in ((1, 2, 0.9), (2, 3, 0.8), (2, 4, 0.95), (2, 5, 0.65), (4, 5, 0.9))], "comparison_universe_id string, coverage_scope string, comparison_tool string, comparison_tool_version string, protein_a_id long, protein_b_id long, tm_score double")
    proteins = spark.createDataFrame([(1, "DISCOVERY"), (2, "DISCOVERY"), (3, "DISCOVERY"), (4, "VALIDATION"), (5, "VALIDATION")], "protein_id long, partition string")
    got = {r["protein_id"]: r for r in blocks.structure_clusters(pairs, proteins).collect()}
    assert (got[1]["membership_method"], got[1]["supporting_edge_count"], got[1]["best_tm_score"], got[2]["supporting_edge_count"]) == ("DISCOVERY_COMPONENT", 1, 0.9, 2)
    assert (got[4]["membership_method"], got[4]["supporting_edge_count"], got[4]["best_tm_score"], got[5]["best_tm_score"]) == ("VALIDATION_PROJECTION", 1, 0.95, 0.65)
    assert {(r["member_count"], r["reference_member_count"], r["edge_count"]) for r in got.values()} == {(5, 3, 2)} and len({r["cluster_id"] for r in got.values()}) == 1
    assert {r["membership_method"] for r in blocks.structure_clusters(pairs).collect()} == {"ALL_DATA_COMPONENT"}


def test_label_closure_and_cycle(spark):
    labels = spark.createDataFrame([("r", None), ("a", "r"), ("b", "a")], "label_id string, parent_label_id string")
    got = {(r["label_id"], r["ancestor_id"]): r["depth"] for r in blocks.label_closure(labels).collect()}
    assert got[("b", "r")] == 2 and len(got) == 6
    with pytest.raises(ValueError):
        blocks.label_closure(spark.createDataFrame([("a", "b"), ("b", "a")], "label_id string, parent_label_id string"), 4)


def test_pairwise_identity_golden_case(spark):
    aligned = spark.createDataFrame([(1, "AC-X"), (2, "ATX-"), (3, "-X-X")], "sequence_id long, sequence string")
    got = {(r["a"], r["b"]): (r["comparable"], r["identity"]) for r in sequences.pairwise_identity(aligned).collect()}
    assert got[(1, 2)] == (2, 0.5)


def test_kmers_of_short_and_empty_sequences(spark):
    rows = spark.createDataFrame([(1, "ABABA"), (2, "AB"), (3, ""), (4, None), (5, "ABA*C-DABAB"), (6, "ab1ABA")], "protein_id long, sequence string")
    seen = {(k, "".join(g)): set() for k in (2, 3) for g in ()}
    for key, text in ((r[0], r[1] or "") for r in rows.collect()):
        for k in (2, 3):
            for i in range(len(text) - k + 1):
                if all(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ*-?" for c in text[i : i + k]):
                    seen.setdefault((k, text[i : i + k]), set()).add(key)
    counts = sequences.kmer_prevalence(rows, [2, 3])
    assert {(r["length"], r["kmer"]): r["proteins"] for r in counts.collect()} == {k: len(v) for k, v in seen.items()}
    words = spark.createDataFrame([(3, "ABA"), (3, "BAB"), (3, "ZZZ")], "length int, kmer string")
    for limit in (sequences.VOCABULARY_LIMIT, 1):
        sequences.VOCABULARY_LIMIT, old = limit, sequences.VOCABULARY_LIMIT
        got = sorted(tuple(r) for r in sequences.kmer_rows(rows, words).select("protein_id", "length", "kmer").collect())
        sequences.VOCABULARY_LIMIT = old
        assert got == sorted((p, k, m) for (k, m), ps in seen.items() if m in ("ABA", "BAB") for p in ps)
    ranked = {r["kmer"] for r in sequences.ranked_vocabulary(counts, 3, [2, 3], minimum=2).collect()}
    order = sorted((( -len(v), f"k{k}:{m}"), k, m) for (k, m), v in seen.items() if len(v) >= 2)
    first = [m for _, k, m in order if k == 3][:2] + [m for _, k, m in order if k == 2][:1]
    assert ranked == set(first)
    with pytest.raises(ValueError):
        sequences.ranked_vocabulary(counts, 2, [2, 3], strict=True)
    assert rows.filter("protein_id = 1").select(sequences.occurrences(F.col("sequence"), "ABA").alias("at")).first()["at"] == [1, 3]


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "x.faa").write_text(">p1 first one\nACD\nef*\n>p2\nAC*D\n>p2 again\n\n>p3\nAJ\n")
    records = readers.read_fasta(spark, str(tmp_path / "x.faa"))
    got = sorted((r["protein_id"], r["description"], r["sequence"]) for r in records.collect())
    assert got == [("p1", "first one", "ACDEF"), ("p2", "", "AC*D"), ("p2", "again", ""), ("p3", "", "AJ")]
    bad = sorted(tuple(r) for r in readers.fasta_violations(records).collect())
    assert bad == [("p2", "DUPLICATE"), ("p2", "EMPTY"), ("p2", "INTERNAL_STOP"), ("p3", "ALPHABET")]


def test_tsv_keeps_empty_strings(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("a\tb\n1\t\n\tx\n")
    assert sorted(tuple(r) for r in readers.read_tsv(spark, str(tmp_path / "x.tsv"), ["a", "b"]).collect()) == [("", "x"), ("1", "")]


def test_require_empty(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    with pytest.raises(ValueError):
        checks.require_empty(checks.duplicate_keys(df, ["k"]), "repeated keys")
    checks.require_empty(checks.duplicate_keys(df.distinct(), ["k"]), "repeated keys")


def test_wide_cells_are_bounded_and_distinct(spark, tmp_path, monkeypatch):
    from cohortry.plans import tables

    rows = [(k, 1, "view") for k in range(300)] + [(7, 1, "view")] * 5 + [(k, 2, "click") for k in range(4)] + [(900, None, "view"), (None, 2, "view")]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(readers, "ROW_MEMBERS", 20)
    wide = readers.wide_members(spark.read.parquet(str(tmp_path / "events.parquet")), "user_id", "event_type", "event_id")
    assert max(len(c.split(",")) for r in wide.collect() for c in r[1:] if c) <= 60
    got = sorted((tuple(r) for r in tables.src11(spark, str(tmp_path)).select("user_id", "event_type", "member").collect()), key=str)
    assert got == sorted({(u, t, e) for e, u, t in rows if e is not None}, key=str)


def test_ordered_digests(spark, monkeypatch):
    import hashlib

    rows = [("a", k % 90, f"h{k % 3}") for k in range(500)] + [("b", 5, "x")] * 30 + [(None, 3, "y"), (None, 1, "z"), ("a", None, "w"), ("c", None, "w")]
    monkeypatch.setattr(sequences, "CHUNK_LINES", 7)
    out = sequences.ordered_digests(spark.createDataFrame(rows, "g string, k long, h string"), "g", "k", "h")
    assert "collect_list" not in out._jdf.queryExecution().toString()
    want = {}
    for g in ("a", "b", None):
        lines = sorted((k, f"{k}\t{h}\n") for x, k, h in rows if x == g and k is not None)
        want[g] = hashlib.sha256("".join(t for _, t in lines).encode()).hexdigest()
    assert {r["g"]: r["digest"] for r in out.collect()} == want | {"c": None}


def test_cohort_digest_holds_no_group_in_one_row(spark):
    from cohortry.plans import cohort

    out = cohort.agg12(spark, "/root/testdata/sf0.001")
    assert "collect_list" not in out._jdf.queryExecution().toString() and out.count() == 4
