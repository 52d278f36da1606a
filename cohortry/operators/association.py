"""Feature associations of independence blocks, with unknown kept apart from absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.operators.statistics import adjusted, fisher_exact, wilson
from cohortry.storage import materialize

FDR = 0.05
MINIMUM_BLOCKS = 3
MINIMUM_FEATURE_PROTEINS = 2
#: Feature types that describe the data rather than the entities.
TECHNICAL_TYPES = ("EVIDENCE_AVAILABILITY", "STRUCTURE_AVAILABLE")
BLOCK = ["comparison_id", "partition", "unit"]
PART = ["comparison_id", "partition"]
FEATURE = ["feature_type", "feature_id"]
SIDES = (("target", True), ("background", False))
PARTITIONS = ("DISCOVERY", "VALIDATION")
#: Universes to a word.
WORD = 63
#: The item of the first word, which every member has; so it stands for the block as a whole.
SELF = -1
#: A comparison without discoveries is named by the first of these that any of its discovery rows has.
UNTESTED = ("INSUFFICIENT_SAMPLE_SIZE", "NO_ELIGIBLE_FEATURES", "INPUT_UNAVAILABLE", "FAILED", "EXCLUDED", "AMBIGUOUS_CLASS", "MAPPING_FAILED", "NOT_SELECTED")


def block_classes(members: DataFrame, by: Sequence[str] = BLOCK) -> DataFrame:
    """(comparison_id, partition, unit, is_target, mixed, n) of every block, or with the columns ``by`` for the first three.

    ``members``: comparison_id, partition, unit, protein_id, is_target. A block with members of both classes is mixed.
    """
    flags = members.groupBy(*by).agg(F.max("is_target").alias("t"), F.min("is_target").alias("b"), F.count("*").alias("n"))
    return flags.select(*by, F.col("t").alias("is_target"), (F.col("t") != F.col("b")).alias("mixed"), "n")


def _numbered(rows: DataFrame, name: str, label: str) -> DataFrame:
    """The different ``rows`` with a number each, written, so that it stays."""
    return materialize(rows.distinct().withColumn(name, F.monotonically_increasing_id()), label)


def block_items(members: DataFrame, found: DataFrame, assessed: DataFrame, numbers: DataFrame, by: Sequence[str] = BLOCK) -> DataFrame:
    """(by, item, t, b, mask): members of both classes, of every block and of its members with each item.

    Items are the features of ``found`` (protein_id, feature, a number from 0) and the words of universes (``SELF`` - word; ``mask``: the universes that all of
    these members are in). Both meet the members in one join. ``numbers``: universe, word, bit. A protein has a row a word, so members meet the words of their
    proteins, not each universe, and every protein has the first word, which thus counts its members. Rows of ``assessed`` may repeat.
    """
    none, first = F.lit(None).cast("long").alias("mask"), F.lit(0).cast("long")
    bits = assessed.join(numbers, "universe").select("protein_id", "word", F.expr("shiftleft(1L, bit)").alias("mask"))
    later = bits.filter("word > 0").select("protein_id", first.alias("word"), first.alias("mask"))
    packs = bits.unionByName(later).unionByName(found.select("protein_id", first.alias("word"), first.alias("mask"))).groupBy("protein_id", "word").agg(F.bit_or("mask").alias("mask"))
    items = packs.select("protein_id", (SELF - F.col("word")).alias("item"), "mask").unionByName(found.select("protein_id", F.col("feature").alias("item"), none))
    rows = members.join(items, "protein_id", "left").select(*by, "is_target", F.coalesce("item", F.lit(SELF).cast("long")).alias("item"), F.when(F.col("item").isNull(), 0).otherwise(F.col("mask")).alias("mask"))
    return rows.groupBy(*by, "item").agg(F.count_if("is_target").alias("t"), F.count_if(~F.col("is_target")).alias("b"), F.bit_and("mask").alias("mask"))


def assessed_blocks(items: DataFrame, by: Sequence[str] = BLOCK) -> DataFrame:
    """(by, is_target, words): every pure block of ``items`` with the universes that all of its members are in, as masks of words."""
    of = lambda condition, *columns: F.when(condition, F.struct(*columns))
    word = of((F.col("item") <= SELF) & (F.col("mask") != 0), (SELF - F.col("item")).alias("word"), "mask", (F.col("t") + F.col("b")).alias("k"))
    blocks = items.filter(F.col("item") <= SELF).groupBy(*by).agg(F.max(of(F.col("item") == SELF, "t", "b")).alias("own"), F.collect_list(word).alias("words"))
    whole = F.expr("map_from_entries(transform(filter(words, w -> w.k = own.t + own.b), w -> struct(w.word, w.mask)))")
    return blocks.filter("own.t = 0 OR own.b = 0").select(*by, (F.col("own.t") > 0).alias("is_target"), whole.alias("words"))


def _sides(condition: Column, suffix: str) -> list[Column]:
    return [F.count_if((F.col("is_target") == t) & condition).alias(f"{n}_{suffix}") for n, t in SIDES]


def sample_counts(members: DataFrame) -> DataFrame:
    """Per comparison and partition: proteins of both classes, pure blocks of both, and mixed blocks."""
    proteins = members.groupBy(*PART).agg(*_sides(F.lit(True), "proteins"))
    blocks = block_classes(members).groupBy(*PART).agg(*_sides(~F.col("mixed"), "blocks"), F.count_if("mixed").alias("mixed_blocks"))
    return proteins.join(blocks, PART)


def _tallies(members: DataFrame, positives: DataFrame, universes: DataFrame, assessed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(counted, totals, in_universe, universes), all written: proteins and blocks of every partition and feature that has any, pure blocks, those of each universe, and the universes given.

    Partitions, features and universes go by numbers, as their names would make up most of the rows that move.
    """
    by = ["part", "unit"]
    parts = _numbered(members.select(*PART), "part", "parts")
    numbers = _numbered(universes.select("universe").filter("universe is not null"), "id", "numbers")
    numbers = numbers.select("universe", F.floor(F.col("id") / WORD).alias("word"), (F.col("id") % WORD).cast("int").alias("bit"))
    features = _numbered(universes.select(*FEATURE, "universe"), "feature", "universes")
    placed = features.join(numbers, "universe", "left").select("feature", F.col("universe").isNull().alias("universal"), "word", "bit")
    rows = members.join(parts, PART).select(*by, "protein_id", "is_target")
    items = materialize(block_items(rows, positives.join(features, FEATURE).select("protein_id", "feature"), assessed, numbers, by), "items")
    pure = materialize(assessed_blocks(items, by), "assessed")
    totals = pure.groupBy("part").agg(*_sides(F.lit(True), "blocks"))
    masks = pure.select("part", "is_target", F.explode("words").alias("word", "mask")).groupBy("part", "is_target", "word", "mask").agg(F.count("*").alias("k"))
    held = masks.join(numbers, "word").filter("shiftright(mask, bit) & 1 = 1")
    in_universe = held.groupBy("part", "universe").agg(*[F.sum(F.when(F.col("is_target") == t, F.col("k")).otherwise(0)).alias(f"{n}_assessed") for n, t in SIDES])
    present = items.filter("item >= 0").select(*by, F.col("item").alias("feature"), "t", "b").join(placed, "feature").join(pure, by, "left")
    inside = F.col("universal") | F.coalesce(F.expr("shiftright(try_element_at(words, word), bit) & 1 = 1"), F.lit(False))
    counted = present.groupBy("part", "feature").agg(F.sum("t").alias("target_with"), F.sum("b").alias("background_with"), *_sides(F.lit(True), "present"), *_sides(inside, "both"))
    counted = materialize(counted.join(features, "feature").join(parts, "part").drop("feature", "part"), "features")
    named = lambda df, label: materialize(df.join(parts, "part").drop("part"), label)
    return counted, named(totals, "totals"), named(in_universe, "in_universe"), features.drop("feature")


def _completed(counted: DataFrame, totals: DataFrame, in_universe: DataFrame) -> DataFrame:
    joined = counted.join(totals, PART).join(in_universe, [*PART, "universe"], "left")
    whole = lambda n: F.when(F.col("universe").isNull(), F.col(f"{n}_blocks")).otherwise(F.coalesce(f"{n}_assessed", F.lit(0)))
    out = joined.select(
        *PART, *FEATURE, "target_with", "background_with", *[f"{n}_{k}" for n, _ in SIDES for k in ("blocks", "present")],
        *[(whole(n) - F.col(f"{n}_both")).alias(f"{n}_absent") for n, _ in SIDES],
    )
    return out.withColumns({f"{n}_unknown": F.col(f"{n}_blocks") - F.col(f"{n}_present") - F.col(f"{n}_absent") for n, _ in SIDES})


def _only(wanted: DataFrame, counted: DataFrame, universes: DataFrame) -> DataFrame:
    """The rows of ``wanted`` in every partition, with zeros where ``counted`` has none."""
    every = wanted.join(universes, FEATURE).withColumn("partition", F.explode(F.array(*map(F.lit, PARTITIONS))))
    return every.join(counted.drop("universe"), [*PART, *FEATURE], "left").fillna(0, ["target_with", "background_with", *(f"{n}_{k}" for n, _ in SIDES for k in ("present", "both"))])


def feature_block_counts(members: DataFrame, positives: DataFrame, universes: DataFrame, assessed: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Per comparison, partition and feature: proteins with it, and present, absent and unknown blocks of both classes.

    ``positives``: protein_id, feature_type, feature_id. ``universes``: feature_type, feature_id, universe; null means that every
    protein was assessed. ``assessed``: universe, protein_id. A block is present if any member is positive, absent if all members are
    in the feature's universe and none is positive, else unknown. Absent blocks are never listed: they are the assessed blocks of a
    class less those of them that are present. Mixed blocks leave both sides. ``wanted`` (comparison_id, feature_type, feature_id)
    limits the rows to its features and adds those that no protein of a partition has.
    """
    counted, totals, in_universe, universes = _tallies(members, positives, universes, assessed)
    return _completed(counted if wanted is None else _only(wanted, counted, universes), totals, in_universe)


def prevalence(counts: DataFrame) -> DataFrame:
    """Add both prevalences, their difference and the direction."""
    share = lambda n: F.col(f"{n}_present") / F.when(F.col(f"{n}_present") + F.col(f"{n}_absent") > 0, F.col(f"{n}_present") + F.col(f"{n}_absent"))
    out = counts.withColumns({"target_prevalence": share("target"), "background_prevalence": share("background")})
    out = out.withColumn("prevalence_difference", F.col("target_prevalence") - F.col("background_prevalence"))
    d = F.col("prevalence_difference")
    return out.withColumn("direction", F.when(d > 0, "TARGET_ENRICHED").when(d < 0, "BACKGROUND_ENRICHED").when(d == 0, "NO_DIFFERENCE"))


def _status_rows(parts: DataFrame, status: str) -> DataFrame:
    return parts.select(*PART, F.lit("ANALYSIS").alias("feature_type"), F.lit(status).alias("feature_id"), *[f"{n}_blocks" for n, _ in SIDES], F.lit("NOT_TESTED").alias("direction"), F.lit(status).alias("status"))


def associate(
    members: DataFrame, positives: DataFrame, universes: DataFrame, assessed: DataFrame, comparisons: DataFrame, exploratory: DataFrame | None = None,
    minimum_target: int = MINIMUM_BLOCKS, minimum_background: int = MINIMUM_BLOCKS, minimum_proteins: int = MINIMUM_FEATURE_PROTEINS, fdr: float = FDR, held_out: bool = True,
) -> DataFrame:
    """Association rows of all comparisons and both partitions: counts, tests, intervals and two false-discovery scopes.

    Where a partition has too few pure blocks of a class there is one row INSUFFICIENT_SAMPLE_SIZE. Discovery tests the features that
    ``minimum_proteins`` of its proteins have (else NO_ELIGIBLE_FEATURES); the held-out partition tests those that passed in discovery
    with a difference, whether or not it has them (else NOT_SELECTED): the family is frozen. A feature with too few assessed blocks of a
    class is INSUFFICIENT_SAMPLE_SIZE, a held-out one of ``exploratory`` (feature_type, feature_id) is EXCLUDED; neither is tested.
    Without ``held_out`` there are the discovery rows only, which do not depend on the held-out partition.
    """
    wanted = PARTITIONS if held_out else PARTITIONS[:1]
    parts = comparisons.select("comparison_id").distinct().withColumn("partition", F.explode(F.array(*map(F.lit, wanted))))
    members = members if held_out else members.filter(F.col("partition").isin(*wanted))
    # both partitions go through one pass over proteins and blocks
    counted, totals, in_universe, universes = _tallies(members, positives, universes, assessed)
    parts = parts.join(totals, PART, "left").fillna(0)
    enough = (F.col("target_blocks") >= minimum_target) & (F.col("background_blocks") >= minimum_background)
    parts = materialize(parts.withColumn("enough", enough), "parts")
    able = parts.filter("enough")
    short = _status_rows(parts.filter(~F.col("enough")), "INSUFFICIENT_SAMPLE_SIZE")
    none = positives.sparkSession.createDataFrame([], "feature_type string, feature_id string")
    exploratory = none if exploratory is None else exploratory.select(*FEATURE).distinct()

    def judged(counts: DataFrame) -> DataFrame:
        counts = prevalence(counts).join(exploratory.withColumn("_exploratory", F.lit(True)), FEATURE, "left")
        denominator = lambda n: F.col(f"{n}_present") + F.col(f"{n}_absent")
        few = (denominator("target") < minimum_target) | (denominator("background") < minimum_background)
        excluded = F.coalesce("_exploratory", F.lit(False)) & (F.col("partition") == "VALIDATION")
        counts = counts.withColumn("status", F.when(excluded, "EXCLUDED").when(few, "INSUFFICIENT_SAMPLE_SIZE").otherwise("COMPLETE"))
        untested = F.col("status") != "COMPLETE"
        blank = {c: F.when(~untested, F.col(c)) for c in ("target_prevalence", "background_prevalence", "prevalence_difference")}
        return counts.withColumns({**blank, "direction": F.when(untested, "NOT_TESTED").otherwise(F.col("direction"))}).drop("_exploratory")

    def tested(rows: DataFrame) -> DataFrame:
        done = fisher_exact(rows.filter("status = 'COMPLETE'"), "target_present", "target_absent", "background_present", "background_absent")
        # families read the p-values several times
        done = adjusted(materialize(done, "tests"), {"q_value": ["comparison_id", "partition", "feature_type"], "study_q_value": ["partition", "feature_type"]})
        for n, _ in SIDES:
            low, high = wilson(F.col(f"{n}_present"), F.col(f"{n}_present") + F.col(f"{n}_absent"))
            done = done.withColumns({f"{n}_low": low, f"{n}_high": high})
        return done.unionByName(rows.filter("status <> 'COMPLETE'"), allowMissingColumns=True)

    counts = _completed(counted.filter("partition = 'DISCOVERY'"), totals, in_universe).join(able.select(*PART), PART, "left_semi")
    counts = materialize(judged(counts.filter(F.col("target_with") + F.col("background_with") >= minimum_proteins)), "counts")
    discovery = materialize(tested(counts), "discovery")
    ineligible = able.filter("partition = 'DISCOVERY'").join(counts.select("comparison_id").distinct(), "comparison_id", "left_anti")
    out = discovery
    for rows in (short, _status_rows(ineligible, "NO_ELIGIBLE_FEATURES")):
        out = out.unionByName(rows, allowMissingColumns=True)
    if not held_out:
        return out
    frozen = discovery.filter((F.col("q_value") <= fdr) & (F.col("prevalence_difference") != 0)).select("comparison_id", *FEATURE)
    held = able.filter("partition = 'VALIDATION'")
    wanted = frozen.join(held.select("comparison_id"), "comparison_id", "left_semi")
    kept = _only(wanted, counted, universes).filter("partition = 'VALIDATION'")
    validation = tested(materialize(judged(_completed(kept, totals, in_universe)), "held"))
    unselected = held.join(frozen.select("comparison_id").distinct(), "comparison_id", "left_anti")
    return out.unionByName(validation).unionByName(_status_rows(unselected, "NOT_SELECTED"), allowMissingColumns=True)


def evidence_class(fdr: float, technical: Sequence[str] = TECHNICAL_TYPES) -> Column:
    """The class of a discovery row paired with its held-out row (columns prefixed discovery_, validation_ and held_status)."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    within = F.coalesce(F.col("validation_q_value") <= fdr, F.lit(False))
    held = (
        F.when(F.col("held_status").isNull() | (F.col("held_status") != "COMPLETE"), "NO_VALIDATION_DATA")
        .when(zero("discovery_prevalence_difference") * zero("validation_prevalence_difference") < 0, "DIRECTION_DISCORDANT")
        .when(within & F.coalesce(F.col("validation_study_q_value") <= fdr, F.lit(False)), "VALIDATED_STUDY_WIDE")
        .when(within, "VALIDATED_WITHIN_COMPARISON")
        .otherwise("DISCOVERY_ONLY")
    )
    scope = (
        F.when(F.col("feature_type").isin(*technical), "QC_TECHNICAL_NON_BIOLOGICAL__")
        .when(F.coalesce("exploratory", F.lit(False)), "EXPLORATORY_ALL_DATA_DERIVATION__")
        .when(F.col("discovery_study_q_value") <= fdr, "DECISION_CANDIDATE__")
        .otherwise("EXPLORATORY_LOCAL_ONLY__")
    )
    return F.concat(scope, held)


def validation_pairs(associations: DataFrame, fdr: float = FDR) -> DataFrame:
    """Every discovery that passes with a difference, beside its held-out row where there is one."""
    keys = ["comparison_id", *FEATURE]
    values = ("q_value", "study_q_value", "prevalence_difference")
    pick = lambda part, name: associations.filter(F.col("partition") == part).select(*keys, "status", *[F.col(c).alias(f"{name}_{c}") for c in values])
    found = pick("DISCOVERY", "discovery").filter((F.col("status") == "COMPLETE") & (F.col("discovery_q_value") <= fdr) & (F.col("discovery_prevalence_difference") != 0))
    return found.join(pick("VALIDATION", "validation").withColumnRenamed("status", "held_status"), keys, "left")


def synthesize(associations: DataFrame, fdr: float = FDR, exploratory: DataFrame | None = None) -> DataFrame:
    """Pair every discovery with its held-out row and name the evidence; a comparison without one gets a row saying why.

    ``exploratory`` (feature_type, feature_id): features defined on all data, which no held-out row can confirm.
    """
    paired = validation_pairs(associations, fdr)
    if exploratory is None:
        paired = paired.withColumn("exploratory", F.lit(False))
    else:
        paired = paired.join(exploratory.select(*FEATURE).distinct().withColumn("exploratory", F.lit(True)), FEATURE, "left")
    named = paired.withColumn("evidence_class", evidence_class(fdr)).drop("held_status", "exploratory")
    seen = associations.filter("partition = 'DISCOVERY'").groupBy("comparison_id").agg(F.collect_set("status").alias("seen"))
    comparisons = associations.select("comparison_id").distinct()
    none = comparisons.join(named.select("comparison_id").distinct(), "comparison_id", "left_anti").join(seen, "comparison_id", "left")
    done = F.coalesce(F.arrays_overlap("seen", F.array(F.lit("COMPLETE"), F.lit("NO_SIGNIFICANT_SIGNATURE"))), F.lit(False))
    first = F.coalesce(*[F.when(F.array_contains("seen", s), s) for s in UNTESTED], F.lit("NO_ELIGIBLE_FEATURES"))
    status = F.when(done, "NO_SIGNIFICANT_SIGNATURE").otherwise(first)
    none = none.select("comparison_id", F.lit("ANALYSIS").alias("feature_type"), status.alias("feature_id"), status.alias("status"), F.when(done, "NO_DISCOVERY_SIGNATURE").otherwise(F.concat(F.lit("DISCOVERY_NOT_TESTED__"), status)).alias("evidence_class"))
    return named.unionByName(none, allowMissingColumns=True)
