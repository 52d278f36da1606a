"""Labels proposed by evidence rules: scoring, conflicts, propagation in groups, and the final assignments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.operators.checks import require_empty
from cohortry.ranks import running_count
from cohortry.storage import materialize

POSITIVE = ("REVIEWED_POSITIVE", "EVIDENCE_SUPPORTED_POSITIVE")


@dataclass(frozen=True)
class Rule:
    """Patterns (Java regular expressions) that speak for a label, and those that speak against it."""

    rule_id: str
    label_id: str
    component_role: str = ""
    priority: int = 0
    annotation: tuple[str, ...] = ()
    specific: tuple[str, ...] = ()
    exclusion: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    supporting: tuple[str, ...] = ()
    specific_alone: bool = False
    propagate: bool = False


@dataclass(frozen=True)
class Policy:
    """Scores and thresholds of the rules."""

    annotation: float = 2.0
    specific: float = 3.0
    required_domain: float = 2.0
    supporting_domain: float = 1.0
    group: float = 2.0
    trusted: float = 10.0
    minimum_score: float = 4.0
    minimum_groups: int = 2
    minimum_margin: float = 1.0
    minimum_anchors: int = 2
    needs_structure: bool = True


def eligible_positive(status: Column) -> Column:
    """Whether a curation status admits an assignment to the analysis."""
    return F.coalesce(status.isin(*POSITIVE), F.lit(False))


def _any(text: Column, patterns: Sequence[str]) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | text.rlike(p)
    return found


# -- evidence ----------------------------------------------------------------------------------------------------


def text_evidence(context: DataFrame, catalogue: DataFrame, annotations: DataFrame, trusted_states: Sequence[str] = ("REVIEWED",)) -> DataFrame:
    """(protein_id, text, evidence_group, evidence_source, reliability, trusted) from three sources.

    ``context``: protein_id and texts families, roles, details, joined by a bar; ``catalogue``: protein_id, category, associated, scope, source,
    review_status: its category is trusted when reviewed and direct, associated ones count half; ``annotations``: protein_id, text, source, status, scope:
    each source is an evidence group of its own, named by a digest. Empty texts give no row.
    """
    direct = lambda c: F.lower(F.trim(c)).isin("direct", "exact_protein")
    none = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    upstream = context.select("protein_id", F.concat_ws(" | ", none("families"), none("roles"), none("details")).alias("text"), F.lit("UPSTREAM_CONTEXT").alias("evidence_group"), F.lit("review context").alias("evidence_source"), F.lit(1.0).alias("reliability"), F.lit(False).alias("trusted"))
    own = catalogue.select("protein_id", F.col("category").alias("text"), F.lit("CURATED_SEED_CATALOGUE").alias("evidence_group"), F.col("source").alias("evidence_source"), F.lit(1.0).alias("reliability"), ((F.lower(F.trim("review_status")) == "reviewed") & direct("scope")).alias("trusted"))
    near = catalogue.select("protein_id", F.col("associated").alias("text"), F.lit("UPSTREAM_CONTEXT").alias("evidence_group"), F.col("source").alias("evidence_source"), F.lit(0.5).alias("reliability"), F.lit(False).alias("trusted"))
    outside = annotations.select("protein_id", "text", F.concat(F.lit("EXTERNAL_"), F.substring(F.sha2("source", 256), 1, 16)).alias("evidence_group"), F.col("source").alias("evidence_source"), F.lit(1.0).alias("reliability"), (F.upper(F.trim("status")).isin(*trusted_states) & direct("scope")).alias("trusted"))
    return upstream.unionByName(own).unionByName(near).unionByName(outside).filter(F.trim("text") != "")


def _tried(texts: DataFrame, rules: Sequence[Rule], policy: Policy) -> DataFrame:
    """(protein_id, evidence_group, text, rule_id, kind, score, specific): every text with the rules that it speaks for."""
    text = F.col("text")
    tried = []
    for r in rules:
        specific, plain = _any(text, r.specific), _any(text, r.annotation)
        kind = F.when(specific, "SPECIFIC_ANNOTATION").when(plain, "ANNOTATION")
        score = F.when(specific, F.lit(policy.specific)).otherwise(F.lit(policy.annotation)) * F.col("reliability")
        tried.append(F.when(~_any(text, r.exclusion) & kind.isNotNull(), F.struct(F.lit(r.rule_id).alias("rule_id"), kind.alias("kind"), score.alias("score"), (specific & F.col("trusted")).alias("specific"))))
    return texts.select("protein_id", "evidence_group", "text", F.explode(F.array_compact(F.array(*tried))).alias("m")).select("protein_id", "evidence_group", "text", "m.*")


def best_texts(texts: DataFrame, rules: Sequence[Rule], policy: Policy = Policy()) -> DataFrame:
    """(protein_id, rule_id, evidence_group, kind, value, score, trusted_specific): the best text of each evidence group for each rule.

    Rules are tried inside a row, so texts are not joined with them. A text that an exclusion pattern matches says nothing; of equal scores the
    first text by code point counts. trusted_specific tells whether any trusted text of the group matches a specific pattern.
    """
    rows = _tried(texts, rules, policy)
    ranked = rows.groupBy("protein_id", "rule_id", "evidence_group", "score").agg(F.min_by(F.struct("kind", "text"), F.struct("text", "kind")).alias("t"), F.bool_or("specific").alias("s"))
    top = ranked.groupBy("protein_id", "rule_id", "evidence_group").agg(F.max_by(F.struct("t.kind", "t.text", "score"), "score").alias("b"), F.bool_or("s").alias("trusted_specific"))
    return top.select("protein_id", "rule_id", "evidence_group", "b.kind", F.col("b.text").alias("value"), "b.score", "trusted_specific")


def domain_evidence(domains: DataFrame, rules: Sequence[Rule], policy: Policy = Policy()) -> DataFrame:
    """(protein_id, rule_id, kind, domain_id, score, patterns): the domains that the patterns of each rule find, the least id for each pattern.

    ``domains``: protein_id, domain_id, domain_name. Patterns see the id, a blank and the name. The domain of the first pattern carries the
    score, the others none. patterns counts the patterns of the kind that found a domain.
    """
    kinds = [(r.rule_id, kind, patterns) for r in rules for kind, patterns in (("REQUIRED_DOMAIN", r.required), ("SUPPORTING_DOMAIN", r.supporting))]
    tried = [(g, k, p) for g, (_, _, patterns) in enumerate(kinds) for k, p in enumerate(patterns)]
    if not tried:
        return domains.select("protein_id", *[F.lit(None).cast("string").alias(c) for c in ("rule_id", "kind", "domain_id")], F.lit(None).cast("double").alias("score"), F.lit(None).cast("long").alias("patterns")).limit(0)
    # patterns are tried on different domains; proteins meet numbers, in the order of the ids
    text = F.concat_ws(" ", "domain_id", "domain_name")
    at = F.array_compact(F.array(*[F.when(text.rlike(p), F.struct(F.lit(g).alias("g"), F.lit(k).alias("at"))) for g, k, p in tried]))
    # written first: a filter would be moved in front of the distinct, to every row
    different = materialize(domains.select("domain_id", "domain_name").distinct(), "different")
    matched = materialize(different.withColumn("m", at).filter(F.size("m") > 0), "matched")
    ids = materialize(running_count(matched.select("domain_id").filter("domain_id is not null").distinct(), [], ["domain_id"], upto="number").select("domain_id", "number"), "ids")
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("domain_id", "domain_name")]
    known = matched.join(ids, "domain_id", "left").alias("y")
    rows = domains.alias("x").join(known, same).select("protein_id", "number", F.explode("m").alias("m")).select("protein_id", "number", "m.*")
    found = rows.groupBy("protein_id", "g", "at").agg(F.min("number").alias("number"))
    whole = Window.partitionBy("protein_id", "g")
    counted = found.withColumns({"patterns": F.count("*").over(whole), "_first": F.min("at").over(whole)})
    once = counted.groupBy("protein_id", "g", "number", "patterns", "_first").agg(F.min("at").alias("at"))
    names = domains.sparkSession.createDataFrame([(g, rule, kind) for g, (rule, kind, _) in enumerate(kinds)], "g int, rule_id string, kind string")
    score = F.when(F.col("at") > F.col("_first"), 0.0).when(F.col("kind") == "REQUIRED_DOMAIN", policy.required_domain).otherwise(policy.supporting_domain)
    return once.join(names, "g").join(ids, "number", "left").select("protein_id", "rule_id", "kind", "domain_id", score.alias("score"), "patterns")


def score_rules(texts: DataFrame, domains: DataFrame, structures: DataFrame, rules: Sequence[Rule], policy: Policy = Policy(), found: DataFrame | None = None) -> DataFrame:
    """Candidates: protein_id, label_id, rule_id, component_role, priority, score, evidence_groups, accepted, confidence_tier, trusted_direct, reason.

    ``structures``: protein_id, structure_eligible. A candidate has any text or domain of its rule. It is accepted when texts speak for it, all
    required domains are there, and score and number of evidence groups suffice, or when a trusted specific text suffices alone; and the structure
    must be eligible, if the policy asks for it. Groups count when their score is above 0; domains are one group.
    ``found``: what ``domain_evidence`` gives, where it is at hand.
    """
    spark = texts.sparkSession
    # the best score of a group is that of its best text, which nothing else is asked of
    best = _tried(texts, rules, policy).groupBy("protein_id", "rule_id", "evidence_group").agg(F.max("score").alias("score"), F.bool_or("specific").alias("trusted_specific"))
    found = domain_evidence(domains, rules, policy) if found is None else found
    by_text = best.groupBy("protein_id", "rule_id").agg(F.sum("score").alias("text_score"), F.collect_set(F.when(F.col("score") > 0, F.col("evidence_group"))).alias("text_groups"), F.count_if((F.col("score") > 0) & F.col("evidence_group").isNotNull()).alias("group_count"), F.count("*").alias("texts"), F.bool_or("trusted_specific").alias("trusted"))
    by_domain = found.groupBy("protein_id", "rule_id").agg(F.sum("score").alias("domain_score"), F.max(F.when(F.col("kind") == "REQUIRED_DOMAIN", F.col("patterns"))).alias("required_found"))
    table = spark.createDataFrame([(r.rule_id, r.label_id, r.component_role, r.priority, len(r.required), r.specific_alone) for r in rules], "rule_id string, label_id string, component_role string, priority int, required int, alone boolean")
    rows = by_text.join(by_domain, ["protein_id", "rule_id"], "full").join(table, "rule_id").join(structures.select("protein_id", "structure_eligible"), "protein_id", "left")
    score = F.coalesce("text_score", F.lit(0.0)) + F.coalesce("domain_score", F.lit(0.0))
    groups = F.array_sort(F.concat(F.coalesce("text_groups", F.array().cast("array<string>")), F.when(F.coalesce("domain_score", F.lit(0.0)) > 0, F.array(F.lit("PFAM"))).otherwise(F.array().cast("array<string>"))))
    rows = rows.withColumns({"score": score, "evidence_groups": groups, "texts": F.coalesce("texts", F.lit(0)), "trusted": F.coalesce("trusted", F.lit(False))})
    enough, several = F.col("score") >= policy.minimum_score, F.coalesce("group_count", F.lit(0)) + F.when(F.coalesce("domain_score", F.lit(0.0)) > 0, 1).otherwise(0) >= policy.minimum_groups
    complete = (F.col("required") == 0) | (F.coalesce("required_found", F.lit(0)) == F.col("required"))
    alone = F.col("alone") & F.col("trusted") & enough
    structure = F.coalesce("structure_eligible", F.lit(False)) if policy.needs_structure else F.lit(True)
    accepted = (((F.col("texts") > 0) & complete & enough & several) | alone) & structure
    reason = (
        F.when(~structure, "Structure required but not eligible.").when(F.col("texts") == 0, "Domains alone do not establish a label.").when(~complete, "A required domain is missing.")
        .when(~enough, "Score below the threshold.").when(~several & ~alone, "Too few evidence groups.").otherwise("Evidence and structure suffice.")
    )
    tier = F.when(accepted & several, "HIGH").when(accepted & alone, "DIRECT_CURATED").otherwise("PROPOSED")
    return rows.select("protein_id", "label_id", "rule_id", "component_role", "priority", "score", "evidence_groups", accepted.alias("accepted"), tier.alias("confidence_tier"), F.lit(False).alias("trusted_direct"), reason.alias("reason"))


def trusted_candidates(direct: DataFrame, labels: DataFrame, structures: DataFrame, rules: Sequence[Rule], policy: Policy = Policy()) -> DataFrame:
    """Candidates of reviewed labels that someone gave directly, in the form of ``score_rules``; ``direct``: protein_id, label_id.

    Labels that allow no positives, and controls, give none.
    """
    own = {r.label_id: r for r in rules}
    table = labels.sparkSession.createDataFrame([(r.label_id, r.rule_id, r.priority) for r in own.values()], "label_id string, rule_id string, priority int")
    allowed = labels.filter(F.col("reviewed_positive_allowed") & ~F.col("label_id").startswith("control")).select("label_id", "component_role")
    rows = direct.select("protein_id", "label_id").distinct().join(allowed, "label_id").join(table, "label_id", "left").join(structures.select("protein_id", "structure_eligible"), "protein_id", "left")
    ok = F.coalesce("structure_eligible", F.lit(False)) if policy.needs_structure else F.lit(True)
    return rows.select(
        "protein_id", "label_id", F.coalesce("rule_id", F.lit("trusted_direct_label")).alias("rule_id"), "component_role", F.coalesce("priority", F.lit(10_000)).alias("priority"),
        F.lit(policy.trusted).alias("score"), F.array(F.lit("TRUSTED_DIRECT_LABEL")).alias("evidence_groups"), ok.alias("accepted"), F.lit("DIRECT_CURATED").alias("confidence_tier"),
        F.lit(True).alias("trusted_direct"), F.when(ok, "Trusted direct label.").otherwise("Structure required but not eligible.").alias("reason"),
    )


# -- conflicts ---------------------------------------------------------------------------------------------------


def resolve_candidates(candidates: DataFrame, closure: DataFrame, margin: float = Policy.minimum_margin) -> tuple[DataFrame, DataFrame]:
    """(resolutions, decisions). Resolutions: protein_id, status, label_id, rule_id, score, conflicts, reason. Decisions: the candidates with decision and rank.

    Of the accepted candidates, trusted ones alone compete if there are any; those whose label is an ancestor of another's leave. One that
    remains is selected; of several the best score is, unless they are trusted or its lead is below ``margin``: then the protein is AMBIGUOUS.
    Candidates rank by acceptance, trust, score, depth of the label, priority, label and rule.
    """
    depths = closure.groupBy("label_id").agg(F.max("depth").alias("_depth"))
    order = [F.desc("accepted"), F.desc("trusted_direct"), F.desc("score"), F.desc("_depth"), F.desc("priority"), F.col("label_id"), F.col("rule_id")]
    ranked = candidates.join(depths, "label_id", "left").withColumn("rank", F.row_number().over(Window.partitionBy("protein_id").orderBy(*order)))
    trusted = Window.partitionBy("protein_id")
    pool = ranked.filter("accepted").withColumn("_any", F.max("trusted_direct").over(trusted)).filter(~F.col("_any") | F.col("trusted_direct"))
    above = pool.select("protein_id", "label_id").distinct().join(closure.filter("depth > 0"), "label_id").select("protein_id", F.col("ancestor_id").alias("label_id")).distinct()
    apart = pool.join(above, ["protein_id", "label_id"], "left_anti")
    best = Window.partitionBy("protein_id").orderBy(F.desc("score"), F.desc("priority"), "label_id", "rule_id")
    led = apart.withColumns({"_place": F.row_number().over(best), "_next": F.lead("score").over(best), "_n": F.count("*").over(Window.partitionBy("protein_id"))})
    wins = (F.col("_n") == 1) | (~F.col("_any") & (F.col("score") - F.col("_next") >= margin))
    first = led.filter("_place = 1").withColumn("_wins", wins)
    conflicts = led.groupBy("protein_id").agg(F.array_sort(F.collect_set("label_id")).alias("conflicts"))
    chosen = first.filter("_wins").select("protein_id", F.col("label_id").alias("sel_label"), F.col("rule_id").alias("sel_rule"), F.col("score").alias("sel_score"), F.col("reason").alias("sel_reason"), F.col("_n").alias("sel_n"))
    state = ranked.groupBy("protein_id").agg(F.max("accepted").alias("any"), F.min_by("reason", "rank").alias("first_reason"))
    joined = state.join(chosen, "protein_id", "left").join(conflicts, "protein_id", "left")
    status = F.when(~F.col("any"), "PROPOSED").when(F.col("sel_label").isNotNull(), "ACCEPTED").otherwise("AMBIGUOUS")
    reason = F.when(status == "PROPOSED", F.col("first_reason")).when(status == "AMBIGUOUS", "Accepted labels conflict.").when(F.col("sel_n") > 1, "The lead over the next label suffices.").otherwise(F.col("sel_reason"))
    resolutions = joined.select("protein_id", status.alias("status"), F.col("sel_label").alias("label_id"), F.col("sel_rule").alias("rule_id"), F.col("sel_score").alias("score"), F.when(status == "AMBIGUOUS", F.col("conflicts")).otherwise(F.array().cast("array<string>")).alias("conflicts"), reason.alias("reason"))
    up = closure.filter("depth > 0").select(F.col("label_id").alias("sel_label"), F.col("ancestor_id").alias("label_id"), F.lit(True).alias("_above"))
    judged = ranked.join(chosen, "protein_id", "left").join(up, ["sel_label", "label_id"], "left")
    is_selected = (F.col("label_id") == F.col("sel_label")) & (F.col("rule_id") == F.col("sel_rule"))
    decision = (
        F.when(~F.col("accepted"), "BELOW_ACCEPTANCE_POLICY").when(F.col("sel_label").isNull(), "AMBIGUOUS_CONFLICT").when(is_selected, "ACCEPTED")
        .when(F.coalesce("_above", F.lit(False)), "SUPERSEDED_BY_DESCENDANT").otherwise("LOWER_PRIORITY")
    )
    decisions = judged.withColumn("decision", decision).select(*candidates.columns, "decision", "rank")
    return resolutions, decisions


def group_consensus(memberships: DataFrame, selected: DataFrame, closure: DataFrame, rule_labels: Sequence[str], minimum_anchors: int = Policy.minimum_anchors) -> DataFrame:
    """(group_id, label_id, anchors): the deepest label with a rule that is the label or an ancestor of the label of every anchor of a group.

    ``memberships``: group_id, protein_id; ``selected``: protein_id, label_id. Groups of fewer anchors than ``minimum_anchors``, or without a common label, give no row.
    """
    anchors = memberships.select("group_id", "protein_id").join(selected.select("protein_id", "label_id"), "protein_id")
    sizes = anchors.groupBy("group_id").agg(F.count("*").alias("anchors")).filter(F.col("anchors") >= minimum_anchors)
    by_label = anchors.groupBy("group_id", "label_id").agg(F.count("*").alias("k"))
    depths = closure.groupBy("label_id").agg(F.max("depth").alias("_depth"))
    common = by_label.join(closure, "label_id").groupBy("group_id", F.col("ancestor_id").alias("label_id")).agg(F.sum("k").alias("k")).join(sizes, "group_id").filter("k = anchors").filter(F.col("label_id").isin(*rule_labels))
    return common.join(depths, "label_id").groupBy("group_id", "anchors").agg(F.max_by("label_id", F.struct("_depth", "label_id")).alias("label_id")).select("group_id", "label_id", "anchors")


def propagate_labels(memberships: DataFrame, consensus: DataFrame, selected: DataFrame, domains: DataFrame, structures: DataFrame, rules: Sequence[Rule], policy: Policy = Policy()) -> DataFrame:
    """Candidates, in the form of ``score_rules``, for members of a group with a consensus that have all required domains of its rule and no label yet."""
    usable = [r for r in rules if r.propagate and r.required]
    table = memberships.sparkSession.createDataFrame([(r.label_id, r.rule_id, r.component_role, r.priority, len(r.required)) for r in usable], "label_id string, rule_id string, component_role string, priority int, required int")
    found = domain_evidence(domains, usable, policy).filter("kind = 'REQUIRED_DOMAIN'").select("protein_id", "rule_id", "patterns").distinct()
    asked = memberships.select("group_id", "protein_id").distinct().join(consensus.select("group_id", "label_id"), "group_id").join(table, "label_id").join(selected.select("protein_id"), "protein_id", "left_anti")
    rows = asked.join(found, ["protein_id", "rule_id"]).filter("patterns = required").join(structures.select("protein_id", "structure_eligible"), "protein_id", "left")
    ok = F.coalesce("structure_eligible", F.lit(False)) if policy.needs_structure else F.lit(True)
    score = policy.group + policy.required_domain
    accepted = ok & F.lit(score >= policy.minimum_score)
    return rows.select(
        "protein_id", "label_id", F.concat("rule_id", F.lit("_group_propagation")).alias("rule_id"), "component_role", "priority", F.lit(float(score)).alias("score"),
        F.array(F.lit("GROUP_HOMOLOGY"), F.lit("PFAM")).alias("evidence_groups"), accepted.alias("accepted"), F.when(accepted, "HIGH").otherwise("PROPOSED").alias("confidence_tier"), F.lit(False).alias("trusted_direct"),
        F.when(accepted, "All anchors of the group agree and the required domains are there.").otherwise("Score or structure do not suffice.").alias("reason"),
    ).distinct()


# -- what follows from them --------------------------------------------------------------------------------------


def label_rows(proteins: DataFrame, selected: DataFrame, controls: DataFrame, resolutions: DataFrame, root: str) -> DataFrame:
    """(protein_id, label_id, curation_status, evidence_status): a row for every protein, several for a control of several backgrounds.

    ``selected`` (protein_id, label_id) wins, then ``controls`` (protein_id, label_id); the others keep the root label and are AMBIGUOUS, PROPOSED or UNMAPPED.
    """
    row = lambda status, state: [F.lit(status).alias("curation_status"), F.lit(state).alias("evidence_status")]
    target = selected.select("protein_id", "label_id", *row("EVIDENCE_SUPPORTED_POSITIVE", "AUTOMATED_TARGET_EVIDENCE"))
    control = controls.select("protein_id", "label_id").distinct().join(selected.select("protein_id"), "protein_id", "left_anti").select("protein_id", "label_id", *row("EVIDENCE_SUPPORTED_POSITIVE", "AUTOMATED_MATCHED_CONTROL"))
    rest = proteins.select("protein_id").distinct().join(target.select("protein_id").union(control.select("protein_id")).distinct(), "protein_id", "left_anti").join(resolutions.select("protein_id", "status"), "protein_id", "left")
    status = F.when(F.col("status") == "AMBIGUOUS", "AMBIGUOUS").when(F.col("status") == "PROPOSED", "PROPOSED").otherwise("UNMAPPED")
    state = F.when(F.col("status") == "AMBIGUOUS", "AUTOMATED_EVIDENCE_CONFLICT").when(F.col("status") == "PROPOSED", "AUTOMATED_EVIDENCE_BELOW_POLICY").otherwise("AUTOMATED_EVIDENCE_NOT_MAPPED")
    return target.unionByName(control).unionByName(rest.select("protein_id", F.lit(root).alias("label_id"), status.alias("curation_status"), state.alias("evidence_status")))


def unresolved(resolutions: DataFrame, candidates: DataFrame, taken: DataFrame) -> DataFrame:
    """(protein_id, status, best_score, candidate_label_ids): proteins with candidates and neither a label nor a place among the controls (``taken``)."""
    best = candidates.groupBy("protein_id").agg(F.max("score").alias("best_score"), F.array_join(F.array_sort(F.collect_set("label_id")), "|").alias("candidate_label_ids"))
    return resolutions.select("protein_id", "status").join(taken.select("protein_id"), "protein_id", "left_anti").join(best, "protein_id")


def label_definitions(selected: DataFrame, domains: DataFrame, closure: DataFrame) -> DataFrame:
    """(label_id, feature_type, feature_id, rule_id): domains that defined a label, for it and all its ancestors.

    ``selected``: protein_id, label_id, rule_id; ``domains``: what ``domain_evidence`` gives.
    """
    used = selected.select("protein_id", "label_id", "rule_id").join(domains.select("protein_id", "rule_id", "domain_id"), ["protein_id", "rule_id"])
    distinct = used.select("label_id", "rule_id", "domain_id").distinct()
    return distinct.join(closure, "label_id").select(F.col("ancestor_id").alias("label_id"), F.lit("DOMAIN").alias("feature_type"), F.col("domain_id").alias("feature_id"), "rule_id").distinct()


def without_defining_domains(hits: DataFrame, assessments: DataFrame, defining: DataFrame) -> DataFrame:
    """(protein_id, domain_authority, assessment_status, kept): assessments after the domains of ``defining`` (domain_id) are taken out of ``hits``.

    A protein that an authority has left without any hit counts as assessed without one; other states stay. Keyed by protein and authority, so one authority's hits say
    nothing of another's.
    """
    kept = hits.select("protein_id", "domain_authority", "domain_id").distinct().join(defining.select("domain_id").distinct(), "domain_id", "left_anti")
    counts = kept.groupBy("protein_id", "domain_authority").agg(F.count("*").alias("n"))
    rows = assessments.select("protein_id", "domain_authority", "assessment_status").join(counts, ["protein_id", "domain_authority"], "left")
    status = F.when((F.col("assessment_status") == "ASSESSED_WITH_HIT") & F.col("n").isNull(), "ASSESSED_NO_HIT").otherwise(F.col("assessment_status"))
    return rows.select("protein_id", "domain_authority", status.alias("assessment_status"), F.coalesce("n", F.lit(0)).alias("kept"))


def class_summary(selected: DataFrame, units: DataFrame, controls: DataFrame, backgrounds: DataFrame) -> DataFrame:
    """(label_id, label_type, proteins, units, background_label_id, control_proteins, control_units) of targets and of backgrounds.

    ``units``: protein_id, unit; ``controls``: label_id, protein_id; ``backgrounds``: label_id, background_label_id.
    """
    own = selected.select("protein_id", "label_id").join(units, "protein_id").groupBy("label_id").agg(F.count("*").alias("proteins"), F.count_distinct("unit").alias("units"))
    held = controls.select("label_id", "protein_id").distinct().join(units, "protein_id").groupBy("label_id").agg(F.count("*").alias("control_proteins"), F.count_distinct("unit").alias("control_units"))
    target = own.join(backgrounds, "label_id", "left").join(held.withColumnRenamed("label_id", "background_label_id"), "background_label_id", "left")
    none = F.lit(0).cast("long")
    target = target.select("label_id", F.lit("TARGET").alias("label_type"), "proteins", "units", F.coalesce("background_label_id", F.lit("")).alias("background_label_id"), F.coalesce("control_proteins", none).alias("control_proteins"), F.coalesce("control_units", none).alias("control_units"))
    return target.unionByName(held.select("label_id", F.lit("BACKGROUND").alias("label_type"), F.col("control_proteins").alias("proteins"), F.col("control_units").alias("units"), F.lit("").alias("background_label_id"), none.alias("control_proteins"), none.alias("control_units")))


def merged_context(proteins: DataFrame, review: DataFrame, metadata: DataFrame, domains: DataFrame, structures: DataFrame) -> DataFrame:
    """(protein_id, species, input_candidate, domain_ids, domain_count, structure_eligible, mean_confidence) of every protein; disagreeing sources are an error.

    ``review``: protein_id, sequence_length, species (array), input_candidate, structure_eligible; ``metadata``: protein_id, species, input_candidate; ``proteins``:
    protein_id, sequence_length. The best structure of a protein is the eligible one, then that of the highest confidence.
    """
    lengths = review.select("protein_id", F.col("sequence_length").alias("declared")).join(proteins.select("protein_id", "sequence_length"), "protein_id", "left")
    require_empty(lengths.filter(F.col("sequence_length").isNull() | (F.col("declared") != F.col("sequence_length"))), "review rows of unknown or other sequences")
    both = review.select("protein_id", F.col("species").alias("rs"), F.col("input_candidate").alias("rc")).join(metadata.select("protein_id", F.col("species").alias("ms"), F.col("input_candidate").alias("mc")), "protein_id", "full")
    clash = ((F.size("rs") > 0) & (F.size("ms") > 0) & (F.col("rs") != F.col("ms"))) | (F.col("rc") != F.col("mc"))
    require_empty(both.filter(clash), "metadata that disagree")
    species = F.when(F.size("rs") > 0, F.col("rs")).otherwise(F.coalesce("ms", F.array().cast("array<string>")))
    who = both.select("protein_id", species.alias("species"), F.coalesce("mc", "rc", F.lit(False)).alias("input_candidate"))
    own = domains.groupBy("protein_id").agg(F.array_sort(F.collect_set("domain_id")).alias("domain_ids"))
    ranked = F.struct("structure_eligible", F.coalesce("mean_confidence", F.lit(-1.0)).alias("c"))
    best = structures.groupBy("protein_id").agg(F.max_by(F.struct("structure_eligible", "mean_confidence"), ranked).alias("s"))
    declared = review.select("protein_id", F.col("structure_eligible").alias("declared")).join(best, "protein_id", "left")
    require_empty(declared.filter(F.col("declared") != F.coalesce("s.structure_eligible", F.lit(False))), "structures whose eligibility is declared otherwise")
    rows = proteins.select("protein_id").join(who, "protein_id", "left").join(own, "protein_id", "left").join(best, "protein_id", "left")
    none = F.array().cast("array<string>")
    return rows.select(
        "protein_id", F.coalesce("species", none).alias("species"), F.coalesce("input_candidate", F.lit(False)).alias("input_candidate"), F.coalesce("domain_ids", none).alias("domain_ids"),
        F.size(F.coalesce("domain_ids", none)).alias("domain_count"), F.coalesce("s.structure_eligible", F.lit(False)).alias("structure_eligible"), F.col("s.mean_confidence").alias("mean_confidence"),
    )
