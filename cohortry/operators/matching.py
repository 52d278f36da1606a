"""Controls matched to targets: candidates within calipers, greedy and maximum matching, coverage and the cohorts that follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.operators.checks import require_empty
from cohortry.storage import materialize


@dataclass(frozen=True)
class Calipers:
    """How far a control may differ from its target."""

    length: float = 0.5
    domains: int = 1
    species: bool = True
    structure: bool = True


def control_pool(proteins: DataFrame, candidates: DataFrame, targets: DataFrame, exclude_input: bool = True) -> DataFrame:
    """The proteins that may serve as controls: no label candidate, no member of a target's unit, no input candidate unless these are let in.

    ``proteins``: protein_id, unit, input_candidate; ``candidates`` and ``targets``: protein_id.
    """
    clean = proteins.join(candidates.select("protein_id").distinct(), "protein_id", "left_anti")
    units = proteins.join(targets.select("protein_id").distinct(), "protein_id", "left_semi").select("unit").distinct()
    clean = clean.join(units, "unit", "left_anti")
    return clean.filter(~F.coalesce("input_candidate", F.lit(False))) if exclude_input else clean


def targets_by_background(selected: DataFrame, closure: DataFrame, comparisons: DataFrame) -> DataFrame:
    """(background_label_id, protein_id, target_label_id): targets under the background of each comparison whose target label they have or inherit."""
    up = selected.select("protein_id", "label_id").join(closure, "label_id").select("protein_id", F.col("ancestor_id").alias("target_label_id"))
    return up.join(comparisons.select("target_label_id", "background_label_id"), "target_label_id").select("background_label_id", "protein_id", "target_label_id").distinct()


def unit_representatives(contexts: DataFrame) -> DataFrame:
    """One context a unit: an eligible structure first, then the higher confidence, the shorter sequence, the smaller id."""
    order = F.struct((~F.col("structure_eligible")).alias("a"), (-F.coalesce("mean_confidence", F.lit(-1.0))).alias("b"), "sequence_length", "protein_id")
    columns = [c for c in contexts.columns if c != "unit"]
    return contexts.groupBy("unit").agg(F.min_by(F.struct(*columns), order).alias("r")).select("unit", "r.*")


def _doublings(c: str) -> Column:
    return F.log2(F.col(c) + 1)


def control_distance() -> Column:
    """2 x the difference of lengths in doublings + 0.25 x that of domain counts + 0.5 x (1 - Jaccard of domains) + 0.5 x that of confidences / 100; columns t_... and c_..."""
    length = F.abs(_doublings("t_sequence_length") - _doublings("c_sequence_length"))
    domains = F.abs(F.size("t_domain_ids") - F.size("c_domain_ids"))
    union = F.size(F.array_union("t_domain_ids", "c_domain_ids"))
    jaccard = F.when(union > 0, F.size(F.array_intersect("t_domain_ids", "c_domain_ids")) / union).otherwise(1.0)
    confidence = F.coalesce(F.abs(F.col("t_mean_confidence") - F.col("c_mean_confidence")) / 100, F.lit(0.0))
    return 2.0 * length + 0.25 * domains + 0.5 * (1.0 - jaccard) + 0.5 * confidence


def control_candidates(targets: DataFrame, controls: DataFrame, calipers: Calipers = Calipers()) -> DataFrame:
    """(target_unit, target_id, control_unit, control_id, distance): controls of another unit within every caliper.

    Both sides: unit, protein_id, species (array), structure_eligible, domain_ids (array), mean_confidence, sequence_length. Controls fall in bands one
    caliper of length wide; a target meets its own and the two beside it, each species it has, and each domain count in reach, so this is an equi-join.
    """
    band = F.floor(_doublings("sequence_length") / calipers.length)
    names = F.when(F.size("species") > 0, F.array_distinct("species")).otherwise(F.array(F.lit(""))) if calipers.species else F.array(F.lit(""))
    state = F.col("structure_eligible") if calipers.structure else F.lit(True)
    columns = ["unit", "protein_id", "domain_ids", "mean_confidence", "sequence_length"]

    def side(df: DataFrame, name: str, bands: Column, counts: Column) -> DataFrame:
        rows = df.select(*[F.col(c).alias(f"{name}_{c}") for c in columns], state.alias("_state"), F.explode(names).alias("_species"), bands.alias("_bands"), counts.alias("_counts"))
        return rows.withColumn("_band", F.explode("_bands")).withColumn("_n", F.explode("_counts")).drop("_bands", "_counts")

    n = F.size("domain_ids")
    t = side(targets, "t", F.array(band - 1, band, band + 1), F.sequence(F.greatest(F.lit(0), n - calipers.domains), n + calipers.domains))
    c = side(controls, "c", F.array(band), F.array(n))
    pairs = t.join(c, ["_species", "_state", "_band", "_n"])
    near = (F.col("t_unit") != F.col("c_unit")) & (F.abs(_doublings("t_sequence_length") - _doublings("c_sequence_length")) <= calipers.length)
    rows = pairs.filter(near).select(F.col("t_unit").alias("target_unit"), F.col("t_protein_id").alias("target_id"), F.col("c_unit").alias("control_unit"), F.col("c_protein_id").alias("control_id"), control_distance().alias("distance"))
    return rows.dropDuplicates(["target_unit", "control_unit"])


def greedy_match(pairs: DataFrame, slots: int = 1, max_rounds: int = 200) -> DataFrame:
    """(target_unit, slot, control_unit, control_id, distance): every target in turn, by unit, takes its ``slots`` nearest controls that are left.

    This is the outcome in which every control goes to the first target, by unit, that reaches for it; so targets may reach all at once. In a round each target
    reaches for its nearest controls that have not refused it, and each control refuses all but the first; rounds end when none refuses.
    Ties of distance go to the smaller control id. No group of targets or controls is held in one task.
    """
    order = Window.partitionBy("target_unit").orderBy("distance", "control_id")
    left = materialize(pairs.select("target_unit", "control_unit", "control_id", "distance"), "pairs")
    for _ in range(max_rounds):
        reached = materialize(left.withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= slots), "reached")
        # a control's holder is the first to reach for it
        holder = reached.groupBy("control_unit").agg(F.min("target_unit").alias("holder"), F.count("*").alias("n"))
        refused = materialize(reached.join(holder.filter("n > 1"), "control_unit").filter("target_unit <> holder").select("target_unit", "control_unit"), "refused")
        if refused.isEmpty():
            return reached
        left = materialize(left.join(refused, ["target_unit", "control_unit"], "left_anti"), "pairs")
    raise RuntimeError(f"no stable matching after {max_rounds} rounds")


def maximum_match(pairs: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(target_unit, control_unit, control_id, distance): a matching of as many targets as possible.

    Starts from the greedy matching. A phase grows trees from all unmatched targets at once, level by level, each control and target in one tree; at the first level where trees reach
    free controls, one shortest path of each such tree is flipped. When no tree reaches one, no path exists, so no larger matching does. A reached control is a row that names the target
    it was reached from, so rows do not grow with the depth; paths are read back level by level.
    """
    edges = materialize(pairs.select("target_unit", "control_unit", "control_id", "distance"), "edges")
    match = materialize(greedy_match(edges).select("target_unit", "control_unit"), "match")
    for _ in range(max_rounds):
        front = edges.select("target_unit").distinct().join(match, "target_unit", "left_anti").select("target_unit", F.col("target_unit").alias("root"))
        levels, hits = [], None
        while True:
            step = front.join(edges, "target_unit").select("control_unit", "target_unit", "root", "distance")
            for earlier in levels:
                step = step.join(earlier.select("control_unit"), "control_unit", "left_anti")
            first = F.min_by(F.struct("target_unit", "root", "distance"), F.struct("root", "distance", "target_unit"))
            step = materialize(step.groupBy("control_unit").agg(first.alias("b")).select("control_unit", "b.*"), "level")
            if step.isEmpty():
                break
            levels.append(step)
            open_ = step.join(match.select("control_unit"), "control_unit", "left_anti")
            if not open_.isEmpty():
                hits = open_.groupBy("root").agg(F.min_by("control_unit", F.struct("distance", "control_unit")).alias("control_unit"))
                break
            front = step.select("control_unit", "root").join(match, "control_unit").select("target_unit", "root")
        if hits is None:
            return match.join(edges, ["target_unit", "control_unit"]).select("target_unit", "control_unit", "control_id", "distance")
        ends, new = hits.select("control_unit"), None
        for level in reversed(levels):
            links = materialize(ends.join(level.select("control_unit", "target_unit"), "control_unit"), "links")
            new = links if new is None else new.unionByName(links)
            # the target's own control is what the level before reached
            ends = match.join(links.select("target_unit"), "target_unit", "left_semi").select("control_unit")
        new = materialize(new.select("target_unit", "control_unit"), "flipped")
        match = materialize(match.join(new.select("target_unit"), "target_unit", "left_anti").unionByName(new), "match")
    raise RuntimeError(f"no maximum matching after {max_rounds} rounds")


def coverage_first_match(pairs: DataFrame, slots: int = 1) -> DataFrame:
    """(target_unit, slot, control_unit, control_id, distance): a first control for as many targets as possible, then a second for as many of these, and so on."""
    left, out = pairs, None
    for slot in range(1, slots + 1):
        found = materialize(maximum_match(left).withColumn("slot", F.lit(slot)), "slot")
        out = found if out is None else out.unionByName(found)
        # a target without this slot gets no later one, a control serves once
        left = left.join(found.select("target_unit"), "target_unit", "left_semi").join(found.select("control_unit"), "control_unit", "left_anti")
    return out.select("target_unit", "slot", "control_unit", "control_id", "distance")


def match_audit(targets: DataFrame, matches: DataFrame, slots: int, background: str) -> DataFrame:
    """A row for each target unit and slot: background_label_id, target_unit_id, target_protein_id, slot, control_unit_id, control_protein_id, match_score, status."""
    asked = targets.select(F.col("unit").alias("target_unit"), F.col("protein_id").alias("target_protein_id"), F.explode(F.sequence(F.lit(1), F.lit(slots))).alias("slot"))
    rows = asked.join(matches, ["target_unit", "slot"], "left")
    return rows.select(
        F.lit(background).alias("background_label_id"), F.col("target_unit").alias("target_unit_id"), "target_protein_id", "slot", F.col("control_unit").alias("control_unit_id"),
        F.col("control_id").alias("control_protein_id"), F.col("distance").alias("match_score"), F.when(F.col("control_unit").isNull(), "UNMATCHED").otherwise("MATCHED").alias("status"),
    )


# -- coverage ------------------------------------------------------------------------------------------------------


def target_coverage(audit: DataFrame) -> DataFrame:
    """(background_label_id, target_unit_id, requested, matched, coverage_status) of every target unit; a control used twice under one background is an error."""
    used = audit.filter("status = 'MATCHED'").groupBy("background_label_id", "control_unit_id").agg(F.count("*").alias("n")).filter("n > 1")
    require_empty(used, "controls used twice under one background")
    rows = audit.groupBy("background_label_id", "target_unit_id").agg(F.count("*").alias("requested"), F.count_if(F.col("status") == "MATCHED").alias("matched"))
    return rows.withColumn("coverage_status", F.when(F.col("matched") == 0, "UNMATCHED").when(F.col("matched") == F.col("requested"), "FULL").otherwise("PARTIAL"))


def background_coverage(coverage: DataFrame) -> DataFrame:
    """Per background: target units, matched controls, targets with and without one, and the fraction with one."""
    rows = coverage.groupBy("background_label_id").agg(F.count("*").alias("target_units"), F.sum("matched").alias("matched_controls"), F.count_if(F.col("matched") > 0).alias("with_control"))
    return rows.withColumns({"without_control": F.col("target_units") - F.col("with_control"), "coverage_fraction": F.col("with_control") / F.col("target_units")})


def pool_coverage(audit: DataFrame) -> DataFrame:
    """Per background: different target units, those with a match, different control units, and the fraction covered (null without targets)."""
    matched = F.col("status") == "MATCHED"
    rows = audit.groupBy("background_label_id").agg(F.count_distinct("target_unit_id").alias("target_units"), F.count_distinct(F.when(matched, F.col("target_unit_id"))).alias("covered_target_units"), F.count_distinct(F.when(matched, F.col("control_unit_id"))).alias("matched_control_units"))
    return rows.withColumn("target_coverage_fraction", F.col("covered_target_units") / F.nullif(F.col("target_units"), F.lit(0)))


# -- matched cohorts -----------------------------------------------------------------------------------------------


def audit_violations(audit: DataFrame, memberships: DataFrame, units: DataFrame) -> DataFrame:
    """(target_unit_id, control_unit_id, problem): audit rows that contradict the blocks or labels, or use a control twice.

    ``audit``: background_label_id, target_label_id, target_protein_id, target_unit_id, control_protein_id, control_unit_id, status; ``units``: protein_id, unit.
    """
    t = units.select(F.col("protein_id").alias("target_protein_id"), F.col("unit").alias("_tu"))
    c = units.select(F.col("protein_id").alias("control_protein_id"), F.col("unit").alias("_cu"))
    label = memberships.select(F.col("protein_id").alias("target_protein_id"), F.col("label_id").alias("target_label_id"), F.lit(True).alias("_tl")).distinct()
    back = memberships.select(F.col("protein_id").alias("control_protein_id"), F.col("label_id").alias("background_label_id"), F.lit(True).alias("_cl")).distinct()
    rows = audit.join(t, "target_protein_id", "left").join(c, "control_protein_id", "left").join(label, ["target_protein_id", "target_label_id"], "left").join(back, ["control_protein_id", "background_label_id"], "left")
    matched = F.col("status") == "MATCHED"
    uses = audit.filter("status = 'MATCHED'").groupBy("background_label_id", "control_unit_id").agg(F.count("*").alias("_uses"))
    rows = rows.join(uses, ["background_label_id", "control_unit_id"], "left")
    other = lambda a, b: F.col(a).isNull() | (F.col(a) != F.col(b))
    problem = (
        F.when(~F.col("status").isin("MATCHED", "UNMATCHED"), "UNKNOWN_STATUS").when(other("_tu", "target_unit_id"), "TARGET_BLOCK_DIFFERS").when(F.col("_tl").isNull(), "TARGET_LACKS_LABEL")
        .when(~matched & (F.col("control_unit_id").isNotNull() | F.col("control_protein_id").isNotNull()), "UNMATCHED_NAMES_CONTROL").when(matched & other("_cu", "control_unit_id"), "CONTROL_BLOCK_DIFFERS")
        .when(matched & F.col("_cl").isNull(), "CONTROL_LACKS_BACKGROUND").when(matched & ((F.col("control_unit_id") == F.col("target_unit_id")) | (F.col("_uses") > 1)), "CONTROL_REUSED")
    )
    return rows.withColumn("problem", problem).filter("problem is not null").select("target_unit_id", "control_unit_id", "problem")


def matched_cohorts(comparisons: DataFrame, memberships: DataFrame, units: DataFrame, audit: DataFrame) -> DataFrame:
    """(comparison_id, protein_id, unit, is_target): target units with a matched control, and the controls matched to them, of every audited comparison.

    ``comparisons``: comparison_id, target_label_id, background_label_id, a row for each pair of labels. A comparison whose backgrounds are audited in part is an error; one without
    audited background has no rows, it keeps its whole cohort.
    """
    require_empty(audit_violations(audit, memberships, units), "a matching audit that contradicts the cohort")
    audited = audit.select("background_label_id").distinct().withColumn("_audited", F.lit(True))
    asked = comparisons.join(audited, "background_label_id", "left")
    state = asked.groupBy("comparison_id").agg(F.bool_or(F.coalesce("_audited", F.lit(False))).alias("any"), F.bool_and(F.coalesce("_audited", F.lit(False))).alias("all"))
    require_empty(state.filter("any and not `all`"), "comparisons of audited and unaudited backgrounds")
    chosen = comparisons.join(state.filter("`all`").select("comparison_id"), "comparison_id", "left_semi")
    labelled = memberships.select("protein_id", "label_id").distinct().join(units, "protein_id")
    target = labelled.join(chosen.select("comparison_id", F.col("target_label_id").alias("label_id")).distinct(), "label_id").select("comparison_id", "protein_id", "unit").distinct()
    links = audit.filter("status = 'MATCHED'").join(chosen.select("comparison_id", "background_label_id").distinct(), "background_label_id").select("comparison_id", F.col("target_unit_id").alias("unit"), "control_unit_id").distinct()
    kept_target = target.join(links.select("comparison_id", "unit").distinct(), ["comparison_id", "unit"], "left_semi")
    used = links.join(target.select("comparison_id", "unit").distinct(), ["comparison_id", "unit"], "left_semi").select("comparison_id", F.col("control_unit_id").alias("unit")).distinct()
    background = labelled.join(chosen.select("comparison_id", F.col("background_label_id").alias("label_id")).distinct(), "label_id").select("comparison_id", "protein_id", "unit").distinct()
    kept_background = background.join(used, ["comparison_id", "unit"], "left_semi")
    columns = ["comparison_id", "protein_id", "unit"]
    return kept_target.select(*columns, F.lit(True).alias("is_target")).unionByName(kept_background.select(*columns, F.lit(False).alias("is_target")))


def cohort_coverage(cohorts: DataFrame, comparisons: DataFrame, memberships: DataFrame, units: DataFrame) -> DataFrame:
    """Per comparison: target units in all and matched, their fraction, target proteins kept and left out, control units and proteins."""
    labelled = memberships.select("protein_id", "label_id").distinct().join(units, "protein_id")
    target = labelled.join(comparisons.select("comparison_id", F.col("target_label_id").alias("label_id")).distinct(), "label_id").select("comparison_id", "protein_id", "unit").distinct()
    whole = target.groupBy("comparison_id").agg(F.count_distinct("unit").alias("target_units"), F.count("*").alias("_proteins"))
    own = cohorts.groupBy("comparison_id").agg(
        F.count_distinct(F.when(F.col("is_target"), F.col("unit"))).alias("matched_target_units"), F.count_if("is_target").alias("target_proteins"),
        F.count_distinct(F.when(~F.col("is_target"), F.col("unit"))).alias("control_units"), F.count_if(~F.col("is_target")).alias("control_proteins"),
    )
    rows = whole.join(own, "comparison_id")
    return rows.select(
        "comparison_id", "target_units", "matched_target_units", (F.col("target_units") - F.col("matched_target_units")).alias("unmatched_target_units"), (F.col("matched_target_units") / F.col("target_units")).alias("target_coverage_fraction"),
        "target_proteins", (F.col("_proteins") - F.col("target_proteins")).alias("unmatched_target_proteins"), "control_units", "control_proteins",
    )
