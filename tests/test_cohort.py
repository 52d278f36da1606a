"""Labels, matching, frozen signatures, models, scans and writers on small tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cohortry.operators import checks, consolidation, families, frozen, labels, matching, models, reports
from cohortry.sinks import writers
from cohortry.sources import scans

PAIRS = "target_unit long, control_unit long, control_id long, distance double"


def random_pairs(seed, targets=9, controls=8, share=0.35):
    rng = random.Random(seed)
    return [(t, 100 + c, 100 + c, round(rng.random(), 2)) for t in range(targets) for c in range(controls) if rng.random() < share]


@pytest.mark.parametrize("slots", [1, 2])
def test_greedy_match_takes_targets_in_turn(spark, slots):
    for seed in range(3):
        pairs = random_pairs(seed)
        used, want = set(), []
        for t in sorted({p[0] for p in pairs}):
            mine = sorted((d, c) for u, c, _, d in pairs if u == t and c not in used)[:slots]
            used |= {c for _, c in mine}
            want += [(t, k + 1, c) for k, (_, c) in enumerate(mine)]
        got = matching.greedy_match(spark.createDataFrame(pairs, PAIRS), slots).select("target_unit", "slot", "control_unit").collect()
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_maximum_match_follows_long_paths(spark):
    """A chain in which every target prefers its neighbour's control needs one path through all of them."""
    n = 8
    pairs = [(t, 100 + t, 100 + t, 0.1) for t in range(n)] + [(t, 101 + t, 101 + t, 0.5) for t in range(n)] + [(n, 100, 100, 0.3)]
    got = matching.maximum_match(spark.createDataFrame(pairs, PAIRS)).collect()
    assert len(got) == n + 1 and len({r["control_unit"] for r in got}) == len({r["target_unit"] for r in got}) == n + 1
    assert {(r["target_unit"], r["control_unit"]) for r in got} == {(n, 100), *((t, 101 + t) for t in range(n))}


def test_maximum_match_covers_as_many_targets_as_possible(spark):
    for seed in range(3):
        pairs = random_pairs(seed, 7, 6, 0.3)
        edges = {(t, c) for t, c, _, _ in pairs}
        owner = {}

        def reach(t, seen, edges=edges, owner=owner):
            for c in sorted(c for u, c in edges if u == t and c not in seen):
                seen.add(c)
                if c not in owner or reach(owner[c], seen):
                    owner[c] = t
                    return True
            return False

        most = sum(reach(t, set()) for t in range(7))
        got = [tuple(r) for r in matching.maximum_match(spark.createDataFrame(pairs, PAIRS)).select("target_unit", "control_unit").collect()]
        assert len(got) == most and set(got) <= edges and len({t for t, _ in got}) == len({c for _, c in got}) == most
    assert matching.greedy_match(spark.createDataFrame([], PAIRS)).count() == 0 and matching.maximum_match(spark.createDataFrame([], PAIRS)).count() == 0


def test_control_candidates_against_all_pairs(spark):
    rng = random.Random(3)
    make = lambda k: (k, k, [f"s{rng.randrange(3)}"] if rng.random() < 0.8 else [], rng.random() < 0.5, rng.sample(["a", "b", "c"], rng.randrange(3)), None if rng.random() < 0.2 else 50.0 + rng.randrange(50), rng.randrange(10, 60))
    rows = [make(k) for k in range(40)]
    schema = "unit long, protein_id long, species array<string>, structure_eligible boolean, domain_ids array<string>, mean_confidence double, sequence_length long"
    df = spark.createDataFrame(rows, schema)
    import math

    want = {}
    for t, c in itertools.product(rows[:15], rows[15:]):
        gap = abs(math.log2(t[6] + 1) - math.log2(c[6] + 1))
        if (t[2] or [""]) == (c[2] or [""]) and t[3] == c[3] and gap <= 0.5 and abs(len(t[4]) - len(c[4])) <= 1:
            union = set(t[4]) | set(c[4])
            jaccard = len(set(t[4]) & set(c[4])) / len(union) if union else 1.0
            confidence = abs(t[5] - c[5]) / 100 if t[5] is not None and c[5] is not None else 0.0
            want[t[0], c[0]] = 2 * gap + 0.25 * abs(len(t[4]) - len(c[4])) + 0.5 * (1 - jaccard) + 0.5 * confidence
    got = {(r["target_unit"], r["control_unit"]): r["distance"] for r in matching.control_candidates(df.filter("unit < 15"), df.filter("unit >= 15")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want) and want


def test_audit_contradictions_are_named(spark):
    units = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "protein_id long, unit long")
    labelled = spark.createDataFrame([(1, "T"), (2, "B"), (3, "B")], "protein_id long, label_id string")
    schema = "background_label_id string, target_label_id string, target_protein_id long, target_unit_id long, control_protein_id long, control_unit_id long, status string"
    good = [("B", "T", 1, 10, 2, 20, "MATCHED")]
    comparisons = spark.createDataFrame([("c", "T", "B")], "comparison_id string, target_label_id string, background_label_id string")
    cohort = matching.matched_cohorts(comparisons, labelled, units, spark.createDataFrame(good, schema))
    assert sorted(tuple(r) for r in cohort.collect()) == [("c", 1, 10, True), ("c", 2, 20, False)]
    bad = {"TARGET_BLOCK_DIFFERS": ("B", "T", 1, 11, 2, 20, "MATCHED"), "UNMATCHED_NAMES_CONTROL": ("B", "T", 1, 10, 2, 20, "UNMATCHED"), "CONTROL_LACKS_BACKGROUND": ("X", "T", 1, 10, 2, 20, "MATCHED"), "TARGET_LACKS_LABEL": ("B", "Q", 1, 10, 2, 20, "MATCHED")}
    for problem, row in bad.items():
        assert [r["problem"] for r in matching.audit_violations(spark.createDataFrame([row], schema), labelled, units).collect()] == [problem]
    with pytest.raises(ValueError):
        matching.target_coverage(spark.createDataFrame([("B", 1, 5, "MATCHED"), ("B", 2, 5, "MATCHED")], "background_label_id string, target_unit_id long, control_unit_id long, status string"))


RULES = (labels.Rule("r", "LEAF", annotation=("kinase",), specific=("true kinase",), exclusion=("pseudo",), required=("PF1", "PF2"), specific_alone=True), labels.Rule("s", "ROOT", annotation=("kinase",)))


def test_rule_scoring_cases(spark):
    text = "protein_id long, text string, evidence_group string, reliability double, trusted boolean"
    texts = [(1, "a kinase", "g1", 1.0, False), (1, "a kinase", "g1", 0.5, False), (2, "pseudo kinase", "g1", 1.0, True), (3, "true kinase", "g1", 1.0, True), (3, "true kinase", "g2", 0.5, False), (4, "a kinase", "g1", 1.0, False), (5, "nothing", "g1", 1.0, False)]
    domains = [(1, "PF1", "x"), (1, "PF2", "y"), (2, "PF1", "x"), (4, "PF1", "x")]
    structures = [(k, k != 4) for k in range(1, 6)]
    got = {(r["protein_id"], r["rule_id"]): r for r in labels.score_rules(spark.createDataFrame(texts, text), spark.createDataFrame(domains, "protein_id long, domain_id string, domain_name string"), spark.createDataFrame(structures, "protein_id long, structure_eligible boolean"), RULES).collect()}
    assert (got[1, "r"]["score"], got[1, "r"]["accepted"], got[1, "r"]["confidence_tier"]) == (4.0, True, "HIGH")
    assert (got[2, "r"]["score"], got[2, "r"]["accepted"]) == (2.0, False)
    # a trusted specific text suffices without the domains, if the score does
    assert (got[3, "r"]["score"], got[3, "r"]["accepted"]) == (4.5, True)
    assert not got[4, "r"]["accepted"] and (5, "r") not in got and (2, "s") in got


def test_candidates_are_resolved(spark):
    closure = spark.createDataFrame([("ROOT", "ROOT", 0), ("A", "A", 0), ("A", "ROOT", 1), ("B", "B", 0), ("B", "ROOT", 1)], "label_id string, ancestor_id string, depth int")
    row = lambda p, label, score, accepted=True, trusted=False: (p, label, "rule", score, 0, accepted, trusted, "why")
    rows = [row(1, "A", 5.0), row(1, "ROOT", 9.0), row(2, "A", 5.0), row(2, "B", 4.5), row(3, "A", 7.0), row(3, "B", 5.0), row(4, "A", 3.0, False), row(5, "A", 5.0, True, True), row(5, "B", 9.0), row(6, "A", 9.0, True, True), row(6, "B", 5.0, True, True)]
    df = spark.createDataFrame(rows, "protein_id long, label_id string, rule_id string, score double, priority int, accepted boolean, trusted_direct boolean, reason string")
    found, decisions = labels.resolve_candidates(df, closure)
    assert {r["protein_id"]: (r["status"], r["label_id"]) for r in found.collect()} == {1: ("ACCEPTED", "A"), 2: ("AMBIGUOUS", None), 3: ("ACCEPTED", "A"), 4: ("PROPOSED", None), 5: ("ACCEPTED", "A"), 6: ("AMBIGUOUS", None)}
    named = {(r["protein_id"], r["label_id"]): r["decision"] for r in decisions.collect()}
    assert named[1, "ROOT"] == "SUPERSEDED_BY_DESCENDANT" and named[2, "A"] == "AMBIGUOUS_CONFLICT" and named[3, "B"] == "LOWER_PRIORITY" and named[4, "A"] == "BELOW_ACCEPTANCE_POLICY"


def test_unit_evidence_never_takes_missing_for_absent(spark):
    keys = "feature_type string, feature_id string"
    own = spark.createDataFrame([("c", "D", "x", 0.01, "STUDY_WIDE"), ("c", "AMINO_ACID_KMER", "k2:AB", 0.01, "STUDY_WIDE")], f"comparison_id string, {keys}, q_value double, fdr_scope string")
    units = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3), ("u3", 4)], "unit_id string, protein_id long")
    states = spark.createDataFrame([(1, "D", "x", frozen.ABSENT), (2, "D", "x", frozen.ABSENT), (3, "D", "x", "NOT_ASSESSED")], f"protein_id long, {keys}, evidence_status string")
    proteins = spark.createDataFrame([(1, "CC"), (2, "CC"), (3, "CC"), (4, "CABC")], "protein_id long, sequence string")
    kmers = frozen.kmer_calls(proteins, own)
    names = spark.createDataFrame([("c",), ("empty",)], "comparison_id string")
    got = {(r["unit_id"], r["comparison_id"]): (r["present"], r["absent"], r["unknown"], r["evidence_state"]) for r in frozen.unit_evidence(units, names, own, frozen.feature_calls(units, own, states, kmers)).collect()}
    assert got["u1", "c"] == (0, 2, 0, "ASSESSED_NO_FEATURE") and got["u2", "c"] == (0, 1, 1, "UNKNOWN_ASSESSMENT")
    assert got["u3", "c"] == (1, 0, 1, "FEATURE_EVIDENCE_PRESENT") and got["u1", "empty"] == (0, 0, 0, "NO_VALIDATED_REFERENCE_FEATURES")


def test_ranking_metrics_against_definitions(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), rng.choice([0.1, 0.3, 0.5, 0.5, 0.8, 0.9])) for _ in range(60)]
    got = models.ranking_metrics(spark.createDataFrame(rows, "target int, probability double")).first()
    pos, neg = [p for t, p in rows if t], [p for t, p in rows if not t]
    area = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    precision, seen = 0.0, 0
    for p in sorted({p for _, p in rows}, reverse=True):
        hits = sum(t for t, x in rows if x >= p)
        precision += hits / sum(x >= p for _, x in rows) * (hits - seen) / len(pos)
        seen = hits
    assert abs(got["roc_auc"] - area) < 1e-12 and abs(got["average_precision"] - precision) < 1e-12
    assert abs(got["brier_score"] - sum((p - t) ** 2 for t, p in rows) / len(rows)) < 1e-12
    assert models.ranking_metrics(spark.createDataFrame([(1, 0.5)], "target int, probability double")).first()["roc_auc"] is None


def test_models_find_what_tells_the_classes_apart(spark):
    rng = random.Random(1)
    members, positives = [], []
    for k in range(240):
        target, part = k % 2 == 0, "VALIDATION" if k % 5 == 0 else "DISCOVERY"
        members.append(("c", k, part, k // 4 * 2 + (k % 2), target))
        positives += [(k, "D", "signal")] if rng.random() < (0.9 if target else 0.1) else []
        positives += [(k, "D", "noise")] if rng.random() < 0.5 else []
    members.append(("few", 1, "DISCOVERY", 1, True))
    universes = spark.createDataFrame([("D", "signal", None), ("D", "noise", None), ("STRUCTURE_AVAILABLE", "m", None)], "feature_type string, feature_id string, universe string")
    settings = models.Settings(folds=2, strengths=(1.0,), iterations=30, repeats=2)
    found = models.fit_comparisons(spark.createDataFrame(members, "comparison_id string, protein_id long, partition string, unit long, is_target boolean"), spark.createDataFrame(positives, "protein_id long, feature_type string, feature_id string"), universes, spark.createDataFrame([], "universe string, protein_id long"), spark.createDataFrame([("c",), ("few",)], "comparison_id string"), settings=settings)
    coefficients = {r["feature_id"]: (r["coefficient"], r["importance_rank"]) for r in found.coefficients.collect()}
    assert coefficients["signal"][0] > 0.5 > abs(coefficients["noise"][0]) and coefficients["signal"][1] == 1 and len(coefficients) == 2
    status = {r["comparison_id"]: r["status"] for r in found.models.collect()}
    assert status["few"] == "INSUFFICIENT_SAMPLE_SIZE" and status["c"].startswith("COMPLETE")
    assert found.metrics.first()["roc_auc"] > 0.8
    loss = {r["feature_id"]: r["importance_mean"] for r in found.permutation.collect()}
    assert loss["signal"] > max(0.1, loss.get("noise", 0))
    # contributions and the base value add up to the logit
    base = found.models.filter("comparison_id = 'c'").first()["expected_log_odds"]
    sums = {r["protein_id"]: r["s"] for r in found.explanations.groupBy("protein_id").agg(F.sum("contribution").alias("s")).collect()}
    p = found.predictions.filter("partition = 'VALIDATION'").select("protein_id", F.log(F.col("probability") / (1 - F.col("probability"))).alias("z")).collect()
    assert all(abs(base + sums[r["protein_id"]] - r["z"]) < 1e-6 for r in p) and p


def test_writers_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"d{k}" if k % 2 else "", "ACDEF" * (k + 1)) for k in range(25)], "protein_id long, description string, sequence string")
    writers.write_canonical(rows, ["sequence", "protein_id"], str(tmp_path / "p"), 4)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.columns == ["sequence", "protein_id"] and back.count() == 25 and len(list((tmp_path / "p").glob("part-*.zstd.parquet"))) >= 7
    writers.write_fasta(rows, str(tmp_path / "f"), 8)
    text = "".join(f.read_text() for f in sorted((tmp_path / "f").glob("part-*")))
    assert text.startswith(">0\nACDEF\n>1 d1\nACDEFACD\nEF\n")
    for plain in (10, 1000):
        writers.write_tsv(rows, ["protein_id", "description"], str(tmp_path / f"t{plain}"), plain)
        assert bool(list((tmp_path / f"t{plain}").glob("*.gz"))) == (plain == 10)
    found = writers.file_inventory(spark, str(tmp_path / "f"))
    declared = found.select("name", "size_bytes", "sha256")
    assert writers.reconcile(declared, found).count() == 0
    first = sorted(r["name"] for r in declared.collect())[0]
    odd = declared.withColumn("size_bytes", F.when(F.col("name") == first, 1).otherwise(F.col("size_bytes"))).unionByName(spark.createDataFrame([("gone", 1, "x")], "name string, size_bytes long, sha256 string"))
    assert sorted(tuple(r) for r in writers.reconcile(odd, found).collect()) == sorted([(first, "SIZE_DIFFERS"), ("gone", "MISSING")])


def test_scans_name_or_raise(spark, tmp_path):
    (tmp_path / "a.faa").write_text(">x\nAC-D\n>y\nACDD\n")
    assert sorted(r["sequence_id"] for r in scans.read_alignment(spark, str(tmp_path / "a.faa")).collect()) == ["x", "y"]
    with pytest.raises(ValueError):
        scans.read_strict_fasta(spark, str(tmp_path / "a.faa"))
    lines = spark.createDataFrame([("#query\tseed_ortholog\tscore\tDescription",), ("x\to1\t3\twhat",)], "value string")
    assert [tuple(r) for r in scans.orthology_annotations(lines, spark.createDataFrame([("x",)], "sequence_id string")).collect()] == [("x", "o1", "what", "3")]
    with pytest.raises(ValueError):
        scans.domain_table(spark.createDataFrame([("too few fields",)], "value string"), spark.createDataFrame([("x", 5)], "protein_id string, sequence_length int"))
    with pytest.raises(ValueError):
        scans.projected_scan(spark.createDataFrame([], "a int"), ["a"])
    with pytest.raises(ValueError):
        scans.typed_scan(spark.createDataFrame([("1.5",)], "a string"), {"a": "bigint"})
    records, collapsed = scans.import_cluster(spark.createDataFrame([(1, "ac d*"), (1, "ACD"), (2, "AA")], "i int, s string"), "i", "s")
    assert collapsed == 1 and sorted(tuple(r) for r in records.collect()) == [(1, "ACD"), (2, "AA")]
    with pytest.raises(ValueError):
        scans.import_cluster(spark.createDataFrame([(1, "A"), (1, "B")], "i int, s string"), "i", "s")


def test_limits_and_conflicts_raise(spark):
    features = spark.createDataFrame([(k, "D", f"d{k}", "n", None, None) for k in range(5)], "protein_id long, feature_type string, feature_id string, feature_name string, start long, stop long")
    with pytest.raises(ValueError):
        reports.filtered_features(features, types=["D"], cap=4)
    assert reports.filtered_features(features, types=["D"], cap=5).count() == 5
    with pytest.raises(ValueError):
        reports.filtered_features(features)
    with pytest.raises(ValueError):
        reports.seed_proteins(features, {"protein": (features, "protein_id")}, "protein", [1, 99])
    with pytest.raises(ValueError):
        consolidation.merge_unique([features, features], ["protein_id"], "twice")
    with pytest.raises(ValueError):
        checks.class_members(spark.createDataFrame([(1, "T"), (1, "B")], "protein_id long, label_id string"), spark.createDataFrame([("c", ["T"], ["B"])], "comparison_id string, target_label_ids array<string>, background_label_ids array<string>"))
    with pytest.raises(ValueError):
        families.species_tips(spark.createDataFrame([(1, "a", "b", None)], "sequence_id long, released_species string, reviewed_species string, reviewed_taxon_id long"), ["a", "b"])


def test_substitution_tables_are_read(spark, tmp_path):
    from cohortry.operators import sequences

    (tmp_path / "m.txt").write_text("# remark\n   A  C\nA  4 -1\nC -1  9\n")
    scores = sequences.read_substitutions(spark, str(tmp_path / "m.txt"))
    assert {(r["first"], r["second"]): r["score"] for r in scores.collect()} == {("A", "A"): 4.0, ("A", "C"): -1.0, ("C", "A"): -1.0, ("C", "C"): 9.0}
    aligned = spark.createDataFrame([(1, "AC-A"), (2, "AA-A"), (3, "---C")], "sequence_id long, sequence string")
    got = {r["sequence_id"]: (r["comparable"], r["identity_to_reference"], r["substitution_score"]) for r in sequences.alignment_members(aligned, 1, scores, "AC").collect()}
    assert got == {1: (3, 1.0, 17.0), 2: (3, 2 / 3, 7.0), 3: (1, 0.0, -1.0)}
