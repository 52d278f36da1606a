"""Families of related sequences: id resolution, retrieval, audits of clusters, context and taxa."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.operators.checks import require_empty
from cohortry.ranks import medians

PASS, CENTROID = "EXACT_THRESHOLDS_PASS", "CENTROID_SELF"
DIGEST = "^[0-9a-f]{64}$"


def controlled_aliases(column: Column) -> Column:
    """The names that an id may go by: itself, the part after a single ``@@``, and accession and entry of ``sp|accession|entry`` or ``tr|...``."""
    token = F.split(F.trim(column), r"\s+")[0]
    parts = F.split(token, "@@")
    bare = F.when((F.size(parts) == 2) & (parts[0] != "") & (parts[1] != ""), parts[1])
    form = r"^(?:sp|tr)\|([^|]+)\|([^|]+)$"
    pieces = lambda t: [F.nullif(F.regexp_extract(t, form, k), F.lit("")) for k in (1, 2)]
    return F.array_distinct(F.array_compact(F.array(F.nullif(token, F.lit("")), bare, *pieces(token), *pieces(bare))))


def resolve_members(members: DataFrame, mapping: DataFrame, proteins: DataFrame) -> DataFrame:
    """(member, protein_id): the protein that a group member is, null where none; a member that is several proteins is an error.

    ``mapping`` (internal, original) renames members before their names are tried; ``proteins``: protein_id as text.
    """
    asked = members.select("member").distinct().join(mapping.select(F.col("internal").alias("member"), "original"), "member", "left")
    named = asked.select("member", F.explode(F.array_distinct(F.concat(controlled_aliases(F.col("member")), F.coalesce(controlled_aliases(F.col("original")), F.array().cast("array<string>"))))).alias("alias"))
    found = named.join(proteins.select(F.col("protein_id").alias("alias")).distinct(), "alias").select("member", F.col("alias").alias("protein_id")).distinct()
    require_empty(found.groupBy("member").agg(F.count("*").alias("n")).filter("n > 1"), "members that are several proteins")
    return members.select("member").distinct().join(found, "member", "left")


def _prefixed(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda x: F.concat(F.lit(prefix), x))


def resolve_ids(inputs: DataFrame, mapping: DataFrame, clusters: DataFrame, prefixes: Sequence[str] = (), bridge: DataFrame | None = None) -> DataFrame:
    """(input_id, alias, sequence_id, cluster_id, member_count, mapping_evidence, status): what asked ids are in a sequence map, ambiguous ones in several rows.

    ``mapping``: sequence_id, cluster_id; ``clusters``: cluster_id, member_count; ``bridge``: input_id, sequence_id. Names tried are the id, the accession of ``sp|..|..``, and both behind each prefix.
    UNMATCHED: in no map; MAPPED_UNINDEXED: in no cluster of the index.
    """
    parts = F.split("input_id", r"\|")
    accession = F.when((F.size(parts) >= 3) & parts[0].isin("sp", "tr"), parts[1])
    base = F.array_compact(F.array(F.col("input_id"), accession))
    names = F.array_distinct(F.concat(base, *[_prefixed(base, p) for p in prefixes]))
    asked = inputs.select("input_id").distinct()
    aliases = asked.select("input_id", F.explode(names).alias("alias"), F.lit("EXACT_ALIAS").alias("mapping_evidence"))
    if bridge is not None:
        over = aliases.join(bridge.select(F.col("input_id").alias("alias"), F.col("sequence_id").alias("_to")), "alias").select("input_id", F.col("_to").alias("alias"), F.lit("DECLARED_BRIDGE").alias("mapping_evidence"))
        aliases = aliases.unionByName(over).distinct()
    matched = aliases.join(mapping.select(F.col("sequence_id").alias("alias"), "cluster_id"), "alias").select("input_id", "alias", "mapping_evidence", F.col("alias").alias("sequence_id"), "cluster_id").distinct()
    rows = asked.join(matched, "input_id", "left").join(clusters.select("cluster_id", "member_count", F.lit(True).alias("_indexed")), "cluster_id", "left")
    status = F.when(F.col("cluster_id").isNull(), "UNMATCHED").when(F.col("_indexed").isNull(), "MAPPED_UNINDEXED").otherwise("MAPPED")
    return rows.select("input_id", "alias", "sequence_id", "cluster_id", "member_count", "mapping_evidence", status.alias("status"))


def retrieve_clusters(sequences: DataFrame, index: DataFrame, wanted: Sequence[object]) -> DataFrame:
    """The sequences of some clusters, whole: a cluster that the index lacks, another count than it says, and a repeated id are errors."""
    chosen = index.filter(F.col("cluster_id").isin(*wanted)).select("cluster_id", "member_count")
    if chosen.count() != len(set(wanted)):
        raise ValueError("clusters that the index lacks or repeats")
    rows = sequences.filter(F.col("cluster_id").isin(*wanted))
    counts = rows.groupBy("cluster_id").agg(F.count("*").alias("n"))
    require_empty(chosen.join(counts, "cluster_id", "left").filter("n is null or n <> member_count"), "clusters of another size than published")
    require_empty(rows.groupBy("sequence_id").agg(F.count("*").alias("n")).filter("n > 1"), "repeated sequence ids")
    return rows


def retrieval_summary(members: DataFrame, taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and length range of each cluster, and its sequences by reviewed species (Unclassified where there is none).

    ``members``: cluster_id, sequence_id, sequence_length; ``taxonomy``: sequence_id, reviewed_species, reviewed_taxon_id.
    """
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("members"), F.min("sequence_length").alias("shortest"), F.max("sequence_length").alias("longest"))
    joined = members.join(taxonomy, "sequence_id", "left")
    species = joined.groupBy("cluster_id", F.coalesce("reviewed_species", F.lit("Unclassified")).alias("species"), F.col("reviewed_taxon_id").alias("taxon_id")).agg(F.count("*").alias("sequences"))
    return sizes, species


def screen_audit(family: DataFrame, hits: DataFrame, taxon_passing: DataFrame | None = None, deduplicate: bool = True) -> DataFrame:
    """(sequence_id, best_seed_id, selection_status) of every family member after a search against seeds.

    ``family``: sequence_id, sequence_sha256; ``hits``: sequence_id, seed_id, bitscore. The best hit is that of the highest score, then the smaller seed; of equal sequences the first id is
    SELECTED, others are EXACT_SEQUENCE_DUPLICATE. Best hits are chosen first, so a member of several hits keeps its place. Members with hits that ``taxon_passing`` (sequence_id) lacks
    are TAXONOMY_FILTERED_OR_UNKNOWN, those without NO_RETAINED_HIT.
    """
    best = hits.groupBy("sequence_id").agg(F.min_by("seed_id", F.struct((-F.col("bitscore")).alias("s"), "seed_id")).alias("best_seed_id"))
    allowed = best if taxon_passing is None else best.join(taxon_passing.select("sequence_id").distinct(), "sequence_id", "left_semi")
    passing = allowed.join(family.select("sequence_id", "sequence_sha256"), "sequence_id")
    first = passing.groupBy("sequence_sha256").agg(F.min("sequence_id").alias("_first"))
    rows = family.select("sequence_id", "sequence_sha256").join(best.select("sequence_id", F.lit(True).alias("_hit")), "sequence_id", "left").join(passing.select("sequence_id", "best_seed_id"), "sequence_id", "left").join(first, "sequence_sha256", "left")
    kept = F.col("sequence_id") == F.col("_first") if deduplicate else F.lit(True)
    status = F.when(F.col("best_seed_id").isNotNull() & kept, "SELECTED").when(F.col("best_seed_id").isNotNull(), "EXACT_SEQUENCE_DUPLICATE").when(F.col("_hit"), "TAXONOMY_FILTERED_OR_UNKNOWN").otherwise("NO_RETAINED_HIT")
    return rows.select("sequence_id", "best_seed_id", status.alias("selection_status"))


def threshold_hits(hits: DataFrame, identity: float, coverage: float, evalue: float) -> DataFrame:
    """Hits with recomputed coverages that reach identity, both coverages and the e-value; numbers out of range are an error.

    ``hits``: pident, evalue, qstart, qend, qlen, sstart, send, slen. Coverages are in percent.
    """
    cover = lambda a, b, n: 100 * (F.abs(F.col(b) - F.col(a)) + 1) / F.nullif(F.col(n), F.lit(0))
    rows = hits.withColumns({"query_coverage": cover("qstart", "qend", "qlen"), "subject_coverage": cover("sstart", "send", "slen")})
    inside = lambda a, b, n: (F.col(a) >= 1) & (F.col(a) <= F.col(b)) & (F.col(b) <= F.col(n))
    good = F.col("pident").between(0, 100) & (F.col("evalue") >= 0) & inside("qstart", "qend", "qlen") & inside("sstart", "send", "slen")
    require_empty(rows.filter(~F.coalesce(good, F.lit(False))), "hits out of range")
    return rows.filter((F.col("pident") >= identity) & (F.col("query_coverage") >= coverage) & (F.col("subject_coverage") >= coverage) & (F.col("evalue") <= evalue))


def group_members(memberships: DataFrame, proteins: DataFrame, scope: dict[str, str], wanted: Sequence[object] = (), cap: int = 100_000) -> DataFrame:
    """(protein_id, species_label, sequence) of one group in one scope (run_id, group_type, hierarchy_node, group_id); members without a sequence stay.

    Asked ids outside the group, two rows of one member, no member and more than ``cap`` are errors.
    """
    rows = memberships
    for c, v in scope.items():
        rows = rows.filter(F.coalesce(F.col(c), F.lit("")) == v)
    rows = rows.select("protein_id", "species_label").distinct()
    if wanted:
        rows = rows.filter(F.col("protein_id").isin(*wanted))
        if rows.select("protein_id").distinct().count() != len(set(wanted)):
            raise ValueError("asked proteins outside the group")
    n = rows.limit(cap + 1).count()
    if not 0 < n <= cap:
        raise ValueError(f"a group of 1 to {cap} members is needed")
    require_empty(rows.groupBy("protein_id").agg(F.count("*").alias("n")).filter("n > 1"), "members in two rows")
    return rows.join(proteins.select("protein_id", "sequence"), "protein_id", "left")


def search_groups(memberships: DataFrame, text: str, group_type: str = "HOG", most: int = 50) -> DataFrame:
    """(group_id, run_id, hierarchy_node): groups whose id holds a text, whatever its case; equal names of different runs stay apart."""
    rows = memberships.filter((F.col("group_type") == group_type) & F.contains(F.lower("group_id"), F.lit(text.strip().lower())))
    return rows.select("group_id", "run_id", "hierarchy_node").distinct().orderBy("group_id", "run_id", "hierarchy_node").limit(most)


def group_snapshot(members: DataFrame, by_id: DataFrame, by_label: DataFrame) -> DataFrame:
    """(protein_id, sequence_sha256, released_species, reviewed_species, reviewed_taxon_id): species by the id's review, else by the label's; where both have a taxon and differ, neither.

    ``by_id``: sequence_id, reviewed_species, reviewed_taxon_id; ``by_label``: released_species and the same two. Members without a sequence are left out.
    """
    one = by_id.select(F.col("sequence_id").alias("protein_id"), F.col("reviewed_species").alias("_si"), F.col("reviewed_taxon_id").alias("_ti"))
    two = by_label.select(F.col("released_species").alias("species_label"), F.col("reviewed_species").alias("_sl"), F.col("reviewed_taxon_id").alias("_tl"))
    rows = members.filter("sequence is not null").join(one, "protein_id", "left").join(two, "species_label", "left")
    clash = F.coalesce(F.col("_ti") != F.col("_tl"), F.lit(False))
    return rows.select("protein_id", F.sha2("sequence", 256).alias("sequence_sha256"), F.col("species_label").alias("released_species"), F.when(~clash, F.coalesce("_si", "_sl")).alias("reviewed_species"), F.when(~clash, F.coalesce("_ti", "_tl")).alias("reviewed_taxon_id"))


def carry_context(context: DataFrame, sequences: DataFrame) -> DataFrame:
    """The context rows whose id and sequence digest are both among the sequences."""
    return context.join(sequences.select("sequence_id", "sequence_sha256").distinct(), ["sequence_id", "sequence_sha256"], "left_semi")


def context_violations(context: DataFrame) -> DataFrame:
    """(sequence_id, problem): missing ids, digests of another form, taxa that are no positive whole numbers, and repeated ids."""
    taxon = F.col("reviewed_taxon_id").isNotNull() & ~(F.col("reviewed_taxon_id").cast("string").rlike("^[1-9][0-9]*$") & F.col("reviewed_taxon_id").cast("string").try_cast("bigint").isNotNull())
    problem = F.when(F.col("sequence_id").isNull(), "MISSING_ID").when(~F.coalesce(F.col("sequence_sha256").rlike(DIGEST), F.lit(False)), "BAD_DIGEST").when(taxon, "BAD_TAXON")
    single = context.withColumn("problem", problem).filter("problem is not null").select("sequence_id", "problem")
    return single.unionByName(context.groupBy("sequence_id").agg(F.count("*").alias("n")).filter("n > 1").select("sequence_id", F.lit("REPEATED_ID").alias("problem")))


def context_summary(context: DataFrame, sequences: DataFrame, most: int = 12) -> DataFrame:
    """One row: the first source groups by name, rows that match, and sequences in all."""
    matched = carry_context(context, sequences)
    names = matched.filter(F.coalesce("source_group", F.lit("")) != "").select("source_group").distinct().orderBy("source_group").limit(most)
    groups = names.agg(F.array_join(F.array_sort(F.collect_list("source_group")), "|").alias("source_groups"))
    return groups.crossJoin(matched.agg(F.count("*").alias("matched_rows"))).crossJoin(sequences.agg(F.count("*").alias("output_sequences")))


def aligned_context(context: DataFrame, aligned: DataFrame) -> DataFrame:
    """The context rows whose digest is that of the ungapped aligned row of their id; two of one id are an error."""
    own = aligned.select("sequence_id", F.sha2(F.regexp_replace("sequence", "-", ""), 256).alias("sequence_sha256"))
    rows = context.join(own, ["sequence_id", "sequence_sha256"], "left_semi")
    require_empty(rows.groupBy("sequence_id").agg(F.count("*").alias("n")).filter("n > 1"), "two matching context rows")
    return rows


def partition_members(membership: DataFrame, sequences: DataFrame, cluster: object) -> DataFrame:
    """(sequence_id, sequence) of one audited cluster; none, repeated ids, and lengths that disagree with the sequences are errors."""
    chosen = membership.filter(F.col("subcluster_id") == cluster).select("sequence_id", "sequence_length")
    if chosen.isEmpty():
        raise ValueError("no such cluster")
    require_empty(chosen.groupBy("sequence_id").agg(F.count("*").alias("n")).filter("n > 1"), "repeated sequence ids")
    joined = chosen.join(sequences.select("sequence_id", "sequence"), "sequence_id", "left")
    require_empty(joined.filter(F.col("sequence").isNull() | (F.length("sequence") != F.col("sequence_length"))), "members that disagree with their sequences")
    return joined.select("sequence_id", "sequence").orderBy("sequence_id")


def pairs_with_results(prior: DataFrame, results: DataFrame, tools: Sequence[str] = ("us-align", "tm-align")) -> DataFrame:
    """Prior alignments by one of the tools, reference rows left out, with a new method's results for the same two models; NOT_ASSESSED where there is none.

    ``prior``: reference_model_sha256, mobile_model_sha256, alignment_tool, status; ``results``: the two digests, status, score. Columns get the prefixes previous_ and new_.
    """
    key = ["reference_model_sha256", "mobile_model_sha256"]
    rows = prior.filter(F.lower("alignment_tool").isin(*tools) & (F.col("status") != "REFERENCE"))
    rows = rows.select(*key, *[F.col(c).alias(f"previous_{c}") for c in prior.columns if c not in key])
    new = results.select(*key, *[F.col(c).alias(f"new_{c}") for c in results.columns if c not in key])
    return rows.join(new, key, "left").withColumn("new_status", F.coalesce("new_status", F.lit("NOT_ASSESSED")))


# -- audited clusters --------------------------------------------------------------------------------------------


def exact_evidence(rows: DataFrame) -> DataFrame:
    """Add identity and both coverages in percent of a realignment, recomputed from its coordinates; null where these are impossible.

    ``rows``: qlen, slen, qstart, qend, sstart, send, length, nident, evalue; query is the representative.
    """
    q, s = F.col("qend") - F.col("qstart") + 1, F.col("send") - F.col("sstart") + 1
    good = (
        F.col("qstart").between(1, F.col("qend")) & (F.col("qend") <= F.col("qlen")) & F.col("sstart").between(1, F.col("send")) & (F.col("send") <= F.col("slen"))
        & (F.col("length") >= F.greatest(q, s)) & (F.col("length") <= q + s) & F.col("nident").between(0, F.least(q, s)) & (F.col("evalue") >= 0)
    )
    ok = F.coalesce(good, F.lit(False))
    return rows.withColumns({"identity": F.when(ok, 100 * F.col("nident") / F.col("length")), "representative_coverage": F.when(ok, 100 * q / F.col("qlen")), "member_coverage": F.when(ok, 100 * s / F.col("slen"))})


def best_realignments(rows: DataFrame) -> DataFrame:
    """For each member the best realignment that ``exact_evidence`` accepts: score, then falling e-value, then identity; and whether any was refused."""
    checked = exact_evidence(rows)
    best = F.max_by(F.struct("identity", "representative_coverage", "member_coverage", "evalue", "bitscore"), F.struct("bitscore", (-F.col("evalue")).alias("e"), "identity"))
    good = checked.filter("identity is not null").groupBy("member_id").agg(best.alias("b")).select("member_id", "b.*")
    refused = checked.groupBy("member_id").agg(F.bool_or(F.col("identity").isNull()).alias("refused"))
    return refused.join(good, "member_id", "left")


def audited_partition(native: DataFrame, realignments: DataFrame, identity: float, coverage: float, evalue: float, bitscore: float = 20.0) -> DataFrame:
    """(subcluster_id, audited_representative_id, sequence_id, native_representative_id, alignment_status and the evidence) of every member.

    ``native``: member_id, representative_id; every member once, every representative its own member. A member whose best realignment reaches all thresholds keeps its representative, any other becomes a
    cluster of its own. The id is ``sub_`` and 24 digits of the SHA-256 of the representative.
    """
    require_empty(native.groupBy("member_id").agg(F.count("*").alias("n")).filter("n > 1"), "members in two clusters")
    own = native.filter("member_id = representative_id").select("representative_id")
    require_empty(native.select("representative_id").distinct().join(own, "representative_id", "left_anti"), "representatives that are no member of their cluster")
    outside = realignments.select("member_id", "representative_id").distinct().join(native, ["member_id", "representative_id"], "left_anti")
    require_empty(outside, "realignments of other pairs")
    rows = native.join(best_realignments(realignments), "member_id", "left")
    passes = (F.col("identity") >= identity) & (F.col("representative_coverage") >= coverage) & (F.col("member_coverage") >= coverage) & (F.col("evalue") <= evalue) & (F.col("bitscore") > bitscore)
    status = (
        F.when(F.col("member_id") == F.col("representative_id"), CENTROID).when(F.col("identity").isNull() & F.coalesce("refused", F.lit(False)), "INVALID_REALIGNMENT")
        .when(F.col("identity").isNull(), "NO_REALIGNMENT").when(passes, PASS).otherwise("EXACT_THRESHOLDS_FAIL")
    )
    kept = F.when(status.isin(CENTROID, PASS), F.col("representative_id")).otherwise(F.col("member_id"))
    rows = rows.withColumns({"alignment_status": status, "audited_representative_id": kept})
    return rows.select(F.concat(F.lit("sub_"), F.substring(F.sha2(F.col("audited_representative_id").cast("string"), 256), 1, 24)).alias("subcluster_id"), "audited_representative_id", F.col("member_id").alias("sequence_id"), F.col("representative_id").alias("native_representative_id"), "alignment_status", "identity", "representative_coverage", "member_coverage", "evalue", "bitscore")


def audit_summary(membership: DataFrame) -> DataFrame:
    """Per audited cluster: members, rescued singletons, and the least identity and coverages that passed.

    ``membership``: subcluster_id, alignment_status, pident, representative_coverage, member_coverage.
    """
    passed = F.col("alignment_status") == PASS
    least = lambda c: F.min(F.when(passed, F.col(c)))
    return membership.groupBy("subcluster_id").agg(
        F.count("*").alias("members"), F.count_if(~F.col("alignment_status").isin(CENTROID, PASS)).alias("rescued_singletons"),
        least("pident").alias("minimum_identity"), least("representative_coverage").alias("minimum_representative_coverage"), least("member_coverage").alias("minimum_member_coverage"),
    )


def _scopes(membership: DataFrame, cluster: object) -> DataFrame:
    every = membership.withColumn("scope", F.lit("all"))
    return every.unionByName(membership.filter(F.col("subcluster_id") == cluster).withColumn("scope", F.lit("selected")))


def partition_compare(membership: DataFrame, cluster: object) -> DataFrame:
    """A cluster beside all members: proteins, groups, lengths (least, median, mean, most) and rescued singletons."""
    rows = _scopes(membership, cluster)
    counts = rows.groupBy("scope").agg(
        F.count("*").alias("proteins"),
        F.count_distinct("subcluster_id").alias("audited_groups"),
        F.count_distinct("native_representative_id").alias("native_groups"),
        F.min("sequence_length").alias("shortest"),
        F.avg("sequence_length").alias("mean_length"),
        F.max("sequence_length").alias("longest"),
        F.count_if(~F.col("alignment_status").isin(CENTROID, PASS)).alias("rescued_singletons"),
    )
    return counts.join(medians(rows, ["scope"], ["sequence_length"]).withColumnRenamed("sequence_length", "median_length"), "scope", "left")


def partition_evidence(membership: DataFrame, cluster: object) -> DataFrame:
    """A cluster beside all members, by alignment status: proteins, measured alignments, least and median identity, median coverages and score."""
    rows, key = _scopes(membership, cluster), ["scope", "alignment_status"]
    counts = rows.groupBy(*key).agg(F.count("*").alias("proteins"), F.count("pident").alias("measured"), F.min("pident").alias("minimum_identity"))
    names = {"pident": "median_identity", "representative_coverage": "median_representative_coverage", "member_coverage": "median_member_coverage", "bitscore": "median_bitscore"}
    return counts.join(medians(rows, key, list(names)).withColumnsRenamed(names), key, "left")


def taxon_overlap(taxa: DataFrame, groups: Sequence[object]) -> DataFrame:
    """(group_a, group_b, shared, united, jaccard) of each ordered pair of up to 12 groups, from (group, taxon) rows; null jaccard where there is no taxon.

    Taxa are counted by the set of groups that have them, so no set of taxa is held whole.
    """
    if not 1 <= len(set(groups)) == len(groups) <= 12:
        raise ValueError("name 1 to 12 different groups")
    masks = {g: 1 << k for k, g in enumerate(groups)}
    spark = taxa.sparkSession
    table = spark.createDataFrame([(g, m) for g, m in masks.items()], T.StructType([taxa.schema["group"], T.StructField("bit", T.IntegerType())]))
    regions = taxa.filter("taxon is not null").join(table, "group").groupBy("taxon").agg(F.bit_or("bit").alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))
    pairs = table.select(F.col("group").alias("group_a"), F.col("bit").alias("x")).crossJoin(table.select(F.col("group").alias("group_b"), F.col("bit").alias("y")))
    joined = pairs.join(regions, F.col("mask").bitwiseAND(F.col("x").bitwiseOR(F.col("y"))) != 0, "left")
    both = (F.col("mask").bitwiseAND(F.col("x")) != 0) & (F.col("mask").bitwiseAND(F.col("y")) != 0)
    counted = joined.groupBy("group_a", "group_b").agg(F.coalesce(F.sum(F.when(both, F.col("n"))), F.lit(0)).alias("shared"), F.coalesce(F.sum("n"), F.lit(0)).alias("united"))
    return counted.withColumn("jaccard", F.col("shared") / F.nullif(F.col("united"), F.lit(0)))


def exclusive_regions(taxa: DataFrame, groups: Sequence[object]) -> DataFrame:
    """(groups, taxa): how many taxa exactly the named groups have, for every set of 2 or 3 groups; from (group, taxon) rows."""
    if not 2 <= len(set(groups)) == len(groups) <= 3:
        raise ValueError("name 2 or 3 different groups")
    names = taxa.sparkSession.createDataFrame([(" + ".join(str(g) for k, g in enumerate(groups) if m >> k & 1), m) for m in range(1, 1 << len(groups))], "groups string, mask int")
    table = taxa.sparkSession.createDataFrame([(g, 1 << k) for k, g in enumerate(groups)], T.StructType([taxa.schema["group"], T.StructField("bit", T.IntegerType())]))
    regions = taxa.filter("taxon is not null").join(table, "group").groupBy("taxon").agg(F.bit_or("bit").alias("mask")).groupBy("mask").agg(F.count("*").alias("taxa"))
    return names.join(regions, "mask", "left").select("groups", F.coalesce("taxa", F.lit(0).cast("long")).alias("taxa"))


def reviewed_taxonomy(rows: DataFrame, key: str = "sequence_id") -> DataFrame:
    """(key, reviewed_species, reviewed_taxon_id): one taxon by all rows of a key, each of them a positive whole number; the species only if it is one.

    ``rows``: the key, species, taxon_id as text.
    """
    taxon = F.when(F.col("taxon_id").cast("string").rlike("^[1-9][0-9]*$"), F.col("taxon_id").cast("string").try_cast("bigint"))
    some = rows.select(key, "species", taxon.alias("taxon")).groupBy(key).agg(
        F.count_distinct("taxon").alias("n"), F.count("taxon").alias("good"), F.count("*").alias("rows"), F.count_distinct("species").alias("names"), F.min("species").alias("name"), F.min("taxon").alias("reviewed_taxon_id"),
    )
    return some.filter("n = 1 and good = rows").select(key, F.when(F.col("names") == 1, F.col("name")).alias("reviewed_species"), "reviewed_taxon_id")


def one_taxon(rows: DataFrame, taxa: Sequence[object], reviewed: str | None = None) -> DataFrame:
    """(sequence_id): sequences of exactly one taxon, all of whose rows name a wanted one and, with ``reviewed``, are marked so."""
    good = F.col("taxon_id").isin(*taxa)
    if reviewed:
        good = good & (F.col(reviewed) == "REVIEWED")
    some = rows.groupBy("sequence_id").agg(F.count_distinct("taxon_id").alias("n"), F.bool_and(F.coalesce(good, F.lit(False))).alias("ok"))
    return some.filter("n = 1 and ok").select("sequence_id")


def species_tips(metadata: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(sequence_id, species_tree_tip): the one tip that is the released species, the reviewed species or the taxon of a sequence; none or several are an error.

    ``metadata``: sequence_id, released_species, reviewed_species, reviewed_taxon_id.
    """
    names = F.array_distinct(F.array_compact(F.array("released_species", "reviewed_species", F.col("reviewed_taxon_id").cast("string"))))
    rows = metadata.select("sequence_id", F.filter(names, lambda n: n.isin(*labels)).alias("tips"))
    require_empty(rows.filter(F.size("tips") != 1), "sequences without one exact tip")
    return rows.select("sequence_id", F.col("tips")[0].alias("species_tree_tip"))


def network_nodes(membership: DataFrame, clusters: Sequence[object], nodes: int = 360) -> DataFrame:
    """(subcluster_id, sequence_id, cluster_size, role and the evidence): a preview of each cluster, its centroid first, then by id; ``nodes`` in all.

    ``membership``: subcluster_id, audited_representative_id, sequence_id and any evidence.
    """
    chosen = membership.filter(F.col("subcluster_id").isin(*clusters))
    sizes = chosen.groupBy("subcluster_id").agg(F.count("*").alias("cluster_size"))
    centroid = F.col("sequence_id") == F.col("audited_representative_id")
    rank = F.row_number().over(Window.partitionBy("subcluster_id").orderBy(F.desc(centroid), "sequence_id"))
    rows = chosen.withColumn("_rank", rank).filter(F.col("_rank") <= nodes // len(clusters)).drop("_rank").join(sizes, "subcluster_id")
    return rows.withColumn("role", F.when(F.col("cluster_size") == 1, "Singleton").when(centroid, "Centroid").otherwise("Member"))


def network_edges(nodes: DataFrame) -> DataFrame:
    """The passing links between displayed members and their displayed centroid."""
    shown = nodes.select(F.col("sequence_id").alias("audited_representative_id")).distinct()
    return nodes.filter((F.col("alignment_status") == PASS) & (F.col("sequence_id") != F.col("audited_representative_id"))).join(shown, "audited_representative_id", "left_semi")


# -- catalogues --------------------------------------------------------------------------------------------------

#: The form of public protein accessions (a fixed value).
ACCESSION = "^([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9]([A-Z][A-Z0-9]{2}[0-9]){1,2})$"


def prepare_catalogue(rows: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(protein_id, description, sequence, sequence_sha256, proposed_category, accession_candidate) of a catalogue; repeated ids and empty sequences are errors.

    ``rows``: protein_id, sequence, description, category. White space is removed, letters are raised, trailing ``*`` are cut.
    ``within``: columns that name a catalogue, where a table holds many; an id names one row of one catalogue, and these columns stay in front.
    """
    within = list(within)
    clean = F.regexp_replace(F.upper(F.regexp_replace("sequence", r"\s", "")), r"\*+$", "")
    made = rows.select(*within, "protein_id", F.coalesce("description", F.lit("")).alias("description"), clean.alias("sequence"), F.coalesce("category", F.lit("")).alias("proposed_category"))
    require_empty(made.filter(F.coalesce("sequence", F.lit("")) == ""), "catalogue rows without a sequence")
    require_empty(made.groupBy(*within, "protein_id").agg(F.count("*").alias("n")).filter("n > 1"), "repeated catalogue ids")
    accession = F.when(F.upper(F.col("protein_id").cast("string")).rlike(ACCESSION), F.upper(F.col("protein_id").cast("string")))
    return made.select(*within, "protein_id", "description", "sequence", F.sha2("sequence", 256).alias("sequence_sha256"), "proposed_category", accession.alias("accession_candidate"))


def label_template(proteins: DataFrame, label: str, curation_status: str = "UNMAPPED", evidence_status: str = "UNREVIEWED_SOURCE") -> DataFrame:
    """A row for each protein that no analysis takes for a positive, for a curator to fill in."""
    return proteins.select("protein_id", F.lit(label).alias("label_id"), F.lit(curation_status).alias("curation_status"), F.lit(evidence_status).alias("evidence_status"), F.lit("UNKNOWN").alias("component_role"))


def expanded_members(seeds: DataFrame, candidates: DataFrame) -> DataFrame:
    """(protein_id, source_id, source_role, sequence_sha256, retained_protein_id) of seeds and candidates: of equal sequences a seed stays before a candidate, then the smaller id.

    Both: sequence_id, sequence_sha256.
    """
    part = lambda df, role, order: df.select(F.concat(F.lit(f"{role.lower()}__"), F.col("sequence_id").cast("string")).alias("protein_id"), F.col("sequence_id").alias("source_id"), F.lit(role).alias("source_role"), "sequence_sha256", F.lit(order).alias("_order"))
    rows = part(seeds, "SEED", 0).unionByName(part(candidates, "CANDIDATE", 1))
    kept = rows.groupBy("sequence_sha256").agg(F.min_by("protein_id", F.struct("_order", "source_id")).alias("retained_protein_id"))
    return rows.join(kept, "sequence_sha256").drop("_order")
