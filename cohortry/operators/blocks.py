"""Independence blocks, hashed partitions and label hierarchies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.joins import spread_join
from cohortry.operators.checks import require_empty
from cohortry.operators.components import components
from cohortry.operators.sequences import ordered_digests
from cohortry.storage import materialize

SEED, VALIDATION_SHARE = 1729, 0.2


def partition_of(unit: Column, key: Column, seed: int = SEED, share: float = VALIDATION_SHARE) -> Column:
    """VALIDATION if the first 64 bits of sha256("seed:unit:key") fall in the first ``share`` of their range."""
    head = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), unit, key).cast("binary"), 256), 1, 16), 16, 10)
    return F.when(head.cast("decimal(20,0)").cast("double") / 2.0**64 < share, "VALIDATION").otherwise("DISCOVERY")


def independence_blocks(memberships: DataFrame) -> DataFrame:
    """(protein_id, block): proteins that share any hub, directly or through others, are one block.

    ``memberships``: protein_id and hub, text. Edges join each protein to the smallest protein of its hub, so
    a hub of any size gives one edge a member. The block is named by its smallest protein.
    """
    low = memberships.groupBy("hub").agg(F.min("protein_id").alias("first"))
    edges = memberships.join(low, "hub").select("protein_id", "first")
    found = components(edges, "protein_id", "first")
    every = memberships.select("protein_id").distinct()
    return every.join(found.withColumnRenamed("node", "protein_id"), "protein_id", "left").select("protein_id", F.coalesce("component", "protein_id").alias("block"))


def partition_blocks(proteins: DataFrame, groups: DataFrame, clusters: DataFrame, seed: int = SEED, share: float = VALIDATION_SHARE) -> DataFrame:
    """(protein_id, partition, partition_unit, partition_key) of proteins joined by equal sequences, groups and redundancy clusters.

    ``proteins``: protein_id, sequence_sha256; ``groups``: protein_id, group_key; ``clusters``: protein_id, cluster_id; a protein in two
    groups or two clusters, or unknown to ``proteins``, is an error. A block without group or cluster is an EXACT_SEQUENCE and goes by its digest; one of
    a single group is an ORTHOFINDER_GROUP and goes by the group; any other is a REDUNDANCY_BLOCK, whose key is ``PB_`` and the
    SHA-256 of its sorted tokens, a line each.
    """
    for rows, key, what in ((groups, "group_key", "proteins in several groups"), (clusters, "cluster_id", "proteins in several clusters")):
        require_empty(rows.groupBy("protein_id").agg(F.count_distinct(key).alias("n")).filter("n > 1"), what)
        require_empty(rows.select("protein_id").join(proteins, "protein_id", "left_anti"), "members that are no known protein")
    token = lambda rows, kind, key: rows.select("protein_id", F.lit(kind).alias("kind"), F.concat(F.lit(kind + ":"), F.col(key).cast("string")).alias("hub"))
    hubs = materialize(token(proteins, "SEQUENCE", "sequence_sha256").union(token(groups, "GROUP", "group_key")).union(token(clusters, "REDUNDANCY", "cluster_id")).distinct(), "hubs")
    blocks = materialize(independence_blocks(hubs.select("protein_id", "hub")), "blocks")
    tokens = hubs.join(blocks, "protein_id").select("block", "kind", "hub").distinct()
    kinds = tokens.groupBy("block").agg(
        F.count_if(F.col("kind") == "GROUP").alias("groups"), F.count_if(F.col("kind") == "REDUNDANCY").alias("redundant"),
        F.min(F.when(F.col("kind") == "GROUP", F.col("hub"))).alias("group"), F.min(F.when(F.col("kind") == "SEQUENCE", F.col("hub"))).alias("exact"),
    )
    exact, single = (F.col("groups") == 0) & (F.col("redundant") == 0), (F.col("groups") == 1) & (F.col("redundant") == 0)
    named = materialize(kinds.withColumn("partition_unit", F.when(exact, "EXACT_SEQUENCE").when(single, "ORTHOFINDER_GROUP").otherwise("REDUNDANCY_BLOCK")), "kinds")
    digests = ordered_digests(tokens.join(named.filter("partition_unit = 'REDUNDANCY_BLOCK'").select("block"), "block", "left_semi"), "block", None, "hub")
    after = lambda c: F.substring_index(F.col(c), ":", -1)
    own = F.expr("substring(`group`, 7)")
    keyed = named.join(digests.select(F.col("block").alias("of"), "digest"), F.col("block").cast("string") == F.col("of"), "left")
    key = F.when(F.col("partition_unit") == "EXACT_SEQUENCE", after("exact")).when(F.col("partition_unit") == "ORTHOFINDER_GROUP", own).otherwise(F.concat(F.lit("PB_"), "digest"))
    keyed = keyed.select("block", "partition_unit", key.alias("partition_key"))
    return blocks.join(keyed, "block").select("protein_id", partition_of(F.col("partition_unit"), F.col("partition_key"), seed, share).alias("partition"), "partition_unit", "partition_key")


def label_closure(labels: DataFrame, max_depth: int = 32) -> DataFrame:
    """(label_id, ancestor_id, depth), each label its own ancestor at depth 0; labels: label_id, parent_label_id.

    The path grows by doubling. A cycle shows as a depth beyond ``max_depth`` and is an error.
    """
    parents = labels.filter("parent_label_id is not null").select("label_id", F.col("parent_label_id").alias("ancestor_id"), F.lit(1).alias("depth"))
    closure, reach = parents, 1
    while True:
        more = closure.alias("x").join(closure.alias("y"), F.col("x.ancestor_id") == F.col("y.label_id")).select("x.label_id", "y.ancestor_id", (F.col("x.depth") + F.col("y.depth")).alias("depth"))
        grown = materialize(closure.unionByName(more).distinct(), "closure")
        reach *= 2
        if reach > 2 * max_depth:
            raise ValueError("the labels hold a cycle, or are too deep")
        if grown.count() == closure.count():
            break
        closure = grown
    return closure.unionByName(labels.select("label_id", F.col("label_id").alias("ancestor_id"), F.lit(0).alias("depth")))


def expand_memberships(direct: DataFrame, closure: DataFrame) -> DataFrame:
    """Direct memberships with those of all ancestors; a direct one wins over an inherited one."""
    rows = direct.join(closure, "label_id").select("protein_id", F.col("ancestor_id").alias("label_id"), "depth")
    return rows.groupBy("protein_id", "label_id").agg(F.min("depth").alias("depth")).select("protein_id", "label_id", F.when(F.col("depth") == 0, "DIRECT").otherwise("INHERITED").alias("source"))


def hierarchy_violations(labels: DataFrame, closure: DataFrame) -> DataFrame:
    """(label_id, problem) of a label tree: repeated ids, shared aliases, roots in excess, unknown parents, and bad default backgrounds.

    ``labels``: label_id, parent_label_id, display_name, aliases (array), default_background_label_id (null where there is none).
    """
    named = labels.select("label_id", F.explode(F.array_distinct(F.transform(F.concat(F.array("label_id", "display_name"), F.coalesce("aliases", F.array().cast("array<string>"))), F.lower))).alias("term"))
    shared = named.groupBy("term").agg(F.count_distinct("label_id").alias("n")).filter("n > 1")
    roots = labels.filter("parent_label_id is null").select("label_id")
    several = roots.groupBy().agg(F.count("*").alias("n")).filter("n <> 1")
    known = labels.select(F.col("label_id").alias("parent_label_id")).distinct()
    backed = labels.filter("default_background_label_id is not null").select("label_id", F.col("default_background_label_id").alias("b"))
    up = closure.select(F.col("label_id").alias("x"), F.col("ancestor_id").alias("y")).distinct()
    below = backed.join(up, (F.col("b") == F.col("x")) & (F.col("label_id") == F.col("y"))).select("label_id")
    above = backed.join(up, (F.col("label_id") == F.col("x")) & (F.col("b") == F.col("y"))).select("label_id")
    found = [
        (labels.groupBy("label_id").agg(F.count("*").alias("n")).filter("n > 1").select("label_id"), "REPEATED_LABEL"),
        (named.join(shared, "term", "left_semi").select("label_id").distinct(), "SHARED_ALIAS"),
        (roots.crossJoin(several).select("label_id"), "SEVERAL_ROOTS"),
        (labels.filter("parent_label_id is not null").join(known, "parent_label_id", "left_anti").select("label_id"), "UNKNOWN_PARENT"),
        (backed.join(known.withColumnRenamed("parent_label_id", "b"), "b", "left_anti").select("label_id"), "UNKNOWN_BACKGROUND"),
        (below.union(above).distinct(), "BACKGROUND_OVERLAPS_TARGET"),
    ]
    out = None
    for rows, problem in found:
        rows = rows.withColumn("problem", F.lit(problem))
        out = rows if out is None else out.unionByName(rows)
    return out


def default_backgrounds(labels: DataFrame, closure: DataFrame, fallback: str) -> DataFrame:
    """(label_id, background): the default background of the nearest ancestor that has one, the label itself first."""
    own = labels.filter("default_background_label_id is not null").select(F.col("label_id").alias("ancestor_id"), F.col("default_background_label_id").alias("b"))
    near = closure.join(own, "ancestor_id").groupBy("label_id").agg(F.min_by("b", F.struct("depth", "ancestor_id")).alias("b"))
    return labels.select("label_id").join(near, "label_id", "left").select("label_id", F.coalesce("b", F.lit(fallback)).alias("background"))


def profile_comparisons(labels: DataFrame, closure: DataFrame, root: str, fallback: str, excluded: Sequence[str] = (), excluded_subtrees: Sequence[str] = ()) -> DataFrame:
    """(comparison_id, display_name, target_label_id, background_label_id) of a label tree's default policy.

    Targets are the labels for default analysis below ``root``, without the root, the fallback background, ``excluded`` labels, and all
    labels of ``excluded_subtrees``; each is compared with its default background.
    """
    below = closure.filter(F.col("ancestor_id") == root).select("label_id")
    cut = closure.filter(F.col("ancestor_id").isin(*excluded_subtrees) if excluded_subtrees else F.lit(False)).select("label_id")
    chosen = labels.filter("default_analysis").filter(~F.col("label_id").isin(root, fallback, *excluded)).join(below, "label_id", "left_semi").join(cut, "label_id", "left_anti")
    rows = chosen.select("label_id", "display_name").join(default_backgrounds(labels, closure, fallback), "label_id")
    names = labels.select(F.col("label_id").alias("background"), F.col("display_name").alias("_other"))
    clean = lambda c: F.replace(F.replace(F.col(c), F.lit(":"), F.lit("__")), F.lit("/"), F.lit("_"))
    return rows.join(names, "background").select(F.concat(clean("label_id"), F.lit("_vs_"), clean("background")).alias("comparison_id"), F.concat("display_name", F.lit(" versus "), "_other").alias("display_name"), F.col("label_id").alias("target_label_id"), F.col("background").alias("background_label_id"))


def assignment_violations(assignments: DataFrame, labels: DataFrame, closure: DataFrame, not_reviewed: Sequence[str] = ()) -> DataFrame:
    """(protein_id, label_id, problem) of positive assignments that their labels do not allow.

    ``assignments``: protein_id, label_id, curation_status, evidence_status, component_role; ``labels``: label_id, reviewed_positive_allowed, component_role,
    exclusivity_group (null where there is none). A protein may own one label of an exclusivity group only, ancestors included.
    """
    positive = assignments.filter(F.col("curation_status").isin("REVIEWED_POSITIVE", "EVIDENCE_SUPPORTED_POSITIVE"))
    rules = labels.select("label_id", "reviewed_positive_allowed", F.col("component_role").alias("_role"))
    joined = positive.join(rules, "label_id", "left")
    role = (F.coalesce("_role", F.lit("")) != "") & (F.col("_role") != "UNKNOWN") & (F.coalesce("component_role", F.lit("")) != F.col("_role"))
    state = F.upper(F.trim("evidence_status")).isin(*not_reviewed) if not_reviewed else F.lit(False)
    problem = F.when(F.col("reviewed_positive_allowed").isNull(), "UNKNOWN_LABEL").when(~F.col("reviewed_positive_allowed"), "POSITIVE_NOT_ALLOWED").when(state, "STATE_NOT_REVIEWED").when(role, "WRONG_ROLE")
    single = joined.withColumn("problem", problem).filter("problem is not null").select("protein_id", "label_id", "problem")
    exclusive = labels.filter("exclusivity_group is not null").select(F.col("label_id").alias("ancestor_id"), "exclusivity_group")
    owned = positive.select("protein_id", "label_id").join(closure.join(exclusive, "ancestor_id"), "label_id").select("protein_id", "exclusivity_group", "ancestor_id").distinct()
    several = owned.groupBy("protein_id", "exclusivity_group").agg(F.count("*").alias("n")).filter("n > 1")
    clash = owned.join(several, ["protein_id", "exclusivity_group"], "left_semi").select("protein_id", F.col("ancestor_id").alias("label_id"), F.lit("EXCLUSIVITY_CONFLICT").alias("problem"))
    return single.unionByName(clash)


#: What tells one search from another.
SEARCH_KEY = ("comparison_universe_id", "coverage_scope", "comparison_tool", "comparison_tool_version")
COMPLETE_PAIRS = ("COMPLETE", "SUCCESS", "PASS")


def passing_pairs(comparisons: DataFrame, score: float = 0.5, coverage: float = 0.5) -> DataFrame:
    """The complete comparisons whose score and both coverages reach the thresholds."""
    return comparisons.filter(F.col("comparison_status").isin(*COMPLETE_PAIRS) & (F.col("tm_score") >= score) & (F.col("coverage_a") >= coverage) & (F.col("coverage_b") >= coverage))


#: Whole-number ids below this and searches below its counterpart make one number of a search and a protein.
ID_BITS = 40


def _component_members(pairs: DataFrame, key: list[str]) -> DataFrame:
    """(key, protein_id, component) of the components of every search; ``pairs``: key, a, b.

    Nodes are numbers where ids and searches fit into 63 bits, as numbers move and compare faster, else texts.
    """
    found = materialize(pairs.select(*key).distinct(), "searches")
    low, high, kind = None, None, pairs.schema["a"].dataType
    if isinstance(kind, (T.IntegerType, T.LongType)):
        low, high = pairs.agg(F.min(F.least("a", "b")), F.max(F.greatest("a", "b"))).first()
    if low is not None and low >= 0 and high < 1 << ID_BITS and found.count() < 1 << (62 - ID_BITS):
        # a row a search
        searches = materialize(found.withColumn("_search", F.row_number().over(Window.orderBy(*key)).cast("long")), "searches")
        number = lambda c: F.shiftleft("_search", ID_BITS) + F.col(c)
        nodes = components(pairs.join(searches, key).select(number("a").alias("x"), number("b").alias("y")), "x", "y")
        ids = nodes.select(F.shiftright("node", ID_BITS).alias("_search"), F.col("node").bitwiseAND((1 << ID_BITS) - 1).cast(kind).alias("protein_id"), "component")
        return ids.join(searches, "_search").select(*key, "protein_id", "component")
    node = lambda c: F.concat_ws("|", *key, F.col(c).cast("string"))
    nodes = components(pairs.select(node("a").alias("x"), node("b").alias("y")), "x", "y")
    names = pairs.select(*key, F.col("a").alias("protein_id")).union(pairs.select(*key, "b")).distinct()
    return names.join(nodes, F.concat_ws("|", *key, F.col("protein_id").cast("string")) == F.col("node")).select(*key, "protein_id", "component")


def structure_clusters(pairs: DataFrame, partitions: DataFrame | None = None, score: float = 0.5, coverage: float = 0.5, key: Sequence[str] = SEARCH_KEY) -> DataFrame:
    """Clusters of every search: the columns of ``key``, cluster_id, protein_id, membership_method, supporting_edge_count, best_tm_score, member_count, reference_member_count, edge_count, first_member.

    ``pairs``: passing pairs with protein_a_id, protein_b_id, tm_score. Discovery proteins form components by their pairs, of two members at
    least; a held-out protein joins a component only by a pair with a member (VALIDATION_PROJECTION). Without ``partitions`` (protein_id,
    partition) all proteins form components. Support counts comparisons, edges count different pairs. The id is ``SC_`` and 16 digits of the
    SHA-256 of the search, the thresholds, and the number and two checks of the members, so it does not depend on their order.
    """
    key = list(key)
    ids = pairs.select(*key, F.col("protein_a_id").alias("a"), F.col("protein_b_id").alias("b"), "tm_score")
    if partitions is None:
        known = ids.withColumns({"a_part": F.lit("DISCOVERY"), "b_part": F.lit("DISCOVERY")})
    else:
        side = lambda c: partitions.select(F.col("protein_id").alias(c), F.col("partition").alias(f"{c}_part"))
        known = ids.join(side("a"), "a", "left").join(side("b"), "b", "left")
    known = materialize(known, "pairs")
    inner = known.filter("a_part = 'DISCOVERY' and b_part = 'DISCOVERY'")
    members = materialize(_component_members(inner, key), "members")
    piece = lambda at: F.conv(F.substring(F.sha2(F.col("protein_id").cast("string"), 256), at, 15), 16, 10).cast("long")
    sizes = members.groupBy(*key, "component").agg(F.count("*").alias("reference_member_count"), F.min("protein_id").alias("first_member"), F.bit_xor(piece(1)).alias("one"), F.bit_xor(piece(16)).alias("two"))
    text = F.concat_ws("|", *key, F.lit("ALL" if partitions is None else "DISCOVERY"), F.lit(str(score)), F.lit(str(coverage)), "reference_member_count", "one", "two")
    sizes = sizes.select(*key, "component", F.concat(F.lit("SC_"), F.substring(F.sha2(text, 256), 1, 16)).alias("cluster_id"), "reference_member_count", "first_member")
    own = members.select(*key, F.col("protein_id").alias("a"), "component")
    edges = inner.select(*key, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(own, [*key, "a"]).groupBy(*key, "component").agg(F.count("*").alias("edge_count"))
    ends = known.select(*key, F.col("a").alias("protein_id"), F.col("a_part").alias("part"), F.col("b").alias("other"), "tm_score").unionByName(known.select(*key, F.col("b").alias("protein_id"), F.col("b_part").alias("part"), F.col("a").alias("other"), "tm_score"))
    joined = ends.filter("part is not null").join(members.withColumnRenamed("protein_id", "other"), [*key, "other"])
    support = joined.groupBy(*key, "component", "protein_id", "part").agg(F.count("*").alias("supporting_edge_count"), F.max("tm_score").alias("best_tm_score"))
    method = F.when(F.col("part") == "VALIDATION", "VALIDATION_PROJECTION").otherwise("ALL_DATA_COMPONENT" if partitions is None else "DISCOVERY_COMPONENT")
    rows = materialize(support.select(*key, "component", "protein_id", method.alias("membership_method"), "supporting_edge_count", "best_tm_score"), "support")
    whole = rows.groupBy(*key, "component").agg(F.count("*").alias("member_count"))
    # a component may hold most of a search, so its rows meet its figures in many tasks
    figures = materialize(whole.join(sizes, [*key, "component"]).join(edges, [*key, "component"]).withColumn("_rows", F.col("member_count")), "figures")
    return spread_join(rows, figures, [*key, "component"], "_rows").drop("component")


def cluster_features(clusters: DataFrame, key: Sequence[str] = SEARCH_KEY) -> DataFrame:
    """(protein_id, feature_type, feature_id, evidence_reference) of cluster members, once each."""
    return clusters.select("protein_id", F.lit("STRUCTURE_CLUSTER").alias("feature_type"), F.col("cluster_id").alias("feature_id"), F.concat_ws("|", *key).alias("evidence_reference")).distinct()


def best_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of every key in an order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")
