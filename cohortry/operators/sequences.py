"""K-mers, alignments and other work on residues."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.ranks import first_rows, running_count
from cohortry.storage import materialize

#: Lines that are joined into one row before they are digested in order, and lines or digests under one digest of a tree.
CHUNK_LINES = 1000
FAN = 64
#: Aligned rows of a block, about; blocks are compared in pairs.
PAIR_ROWS = 256

#: Residues of a k-mer code, five bits each; anything else ends a window.
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ*-?"
_CODES = np.zeros(256, np.uint64)
_CODES[[ord(c) for c in _SYMBOLS]] = np.arange(1, len(_SYMBOLS) + 1)
MAX_K = 12
#: K-mers of a vocabulary that is sent to the executors (8 bytes each).
VOCABULARY_LIMIT = 1_000_000
#: Letters whose k-mers are worked on at once (about 60 bytes each); a longer sequence is taken alone.
PIECE_LETTERS = 1_000_000
#: Different k-mers that a task holds before it passes their counts on.
HELD_KMERS = 1_000_000


def kmer_codes(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of the distinct k-mers of every sequence of a column, from vectorised windows; null gives none."""
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k-mers of 1 to {MAX_K} residues have codes")
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if len(text) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    codes = _CODES[text]
    count = len(text) - k + 1
    value, whole = np.zeros(count, np.uint64), np.ones(count, bool)
    for j in range(k):
        value = (value << np.uint64(5)) | codes[j : j + count]
        whole &= codes[j : j + count] > 0
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    whole &= row[:count] == row[k - 1 :]
    row, value = row[:count][whole], value[whole]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[first], value[first]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch cut where its sequences pass ``PIECE_LETTERS``, so that memory depends on no batch size."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("sequence")), 0).to_numpy().astype(np.int64))
    a = 0
    while a < len(sizes):
        done = sizes[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(sizes, done + PIECE_LETTERS, side="right")))
        yield batch.slice(a, b - a)
        a = b


def kmer_texts(codes: np.ndarray, k: int) -> pa.Array:
    """The k-mers of codes as text."""
    symbols = np.frombuffer(b"." + _SYMBOLS.encode() + b"..", np.uint8)
    letters = np.stack([symbols[((codes >> np.uint64(5 * (k - 1 - j))) & np.uint64(31)).astype(np.int64)] for j in range(k)], axis=1)
    offsets = pa.py_buffer(np.arange(0, k * len(codes) + 1, k, dtype=np.int32).tobytes())
    return pa.StringArray.from_buffers(len(codes), offsets, pa.py_buffer(letters.tobytes()))


def kmer_prevalence(proteins: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """(length, kmer, proteins): how many of the proteins have each k-mer. Counts are added up within a task, ``HELD_KMERS`` of them at most, before they are shuffled."""

    def out(k: int, found: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(found), PIECE_LETTERS):
            some = slice(a, a + PIECE_LETTERS)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found[some]), k, np.int32)), kmer_texts(found[some], k), pa.array(n[some])], names=["length", "kmer", "n"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for k in lengths}
        for batch in batches:
            for piece in _pieces(batch):
                for k in lengths:
                    codes, n = np.unique(kmer_codes(piece.column("sequence"), k)[1], return_counts=True)
                    found, at = np.unique(np.concatenate([held[k][0], codes]), return_inverse=True)
                    total = np.zeros(len(found), np.int64)
                    np.add.at(total, at, np.concatenate([held[k][1], n]))
                    held[k] = (found, total)
                    if len(found) > HELD_KMERS:
                        yield from out(k, *held[k])
                        held[k] = (found[:0], total[:0])
        for k in lengths:
            yield from out(k, *held[k])

    counted = proteins.select("sequence").mapInArrow(scan, "length int, kmer string, n long")
    return counted.groupBy("length", "kmer").agg(F.sum("n").alias("proteins"))


def kmer_rows(proteins: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(protein_id, length, kmer): which k-mers of a vocabulary (length, kmer) every protein has.

    A vocabulary of up to ``VOCABULARY_LIMIT`` k-mers is sent to the executors, so that no other k-mer leaves a task; a larger one is joined.
    """
    sizes = {r["length"]: r["n"] for r in vocabulary.groupBy("length").agg(F.count("*").alias("n")).collect()}
    small = sum(sizes.values()) <= VOCABULARY_LIMIT
    kept: dict[int, np.ndarray] = {}
    if small:
        for k in sizes:
            texts = pa.array(sorted(r["kmer"] for r in vocabulary.filter(F.col("length") == k).select("kmer").distinct().collect()))
            kept[k] = np.unique(kmer_codes(texts, k)[1])
    schema = T.StructType([proteins.schema["protein_id"], T.StructField("length", T.IntegerType()), T.StructField("kmer", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for p in _pieces(batch)):
            for k in sizes:
                row, codes = kmer_codes(piece.column("sequence"), k)
                if small:
                    at = np.minimum(np.searchsorted(kept[k], codes), len(kept[k]) - 1)
                    hit = kept[k][at] == codes
                    row, codes = row[hit], codes[hit]
                yield pa.RecordBatch.from_arrays([piece.column("protein_id").take(pa.array(row)), pa.array(np.full(len(row), k, np.int32)), kmer_texts(codes, k)], names=["protein_id", "length", "kmer"])

    rows = proteins.select("protein_id", "sequence").mapInArrow(scan, schema)
    return rows if small else rows.join(vocabulary.select("length", "kmer"), ["length", "kmer"], "left_semi")


def ranked_vocabulary(counts: DataFrame, budget: int, lengths: Sequence[int], minimum: int = 1, strict: bool = False) -> DataFrame:
    """(length, kmer, proteins) of the k-mers to keep, from ``kmer_prevalence`` of the discovery proteins.

    Only k-mers of ``minimum`` proteins are kept. With ``strict`` all of these are, and more than ``budget`` are an error. Else the budget is
    shared evenly by length, longer lengths first, by falling count, then k-mer; what one length leaves unused is filled from all the
    others by falling count, then the id ``k<length>:<kmer>``.
    """
    counts = counts.filter(F.col("proteins") >= minimum).select("length", "kmer", "proteins")
    if strict:
        if counts.count() > budget:
            raise ValueError(f"more than {budget} k-mers; take shorter ones or a larger budget")
        return counts
    share, extra = divmod(budget, len(lengths))
    own = F.lit(0)
    for place, k in enumerate(sorted(lengths, reverse=True)):
        own = F.when(F.col("length") == k, share + (place < extra)).otherwise(own)
    counts = materialize(counts.withColumn("_own", own.cast("long")), "vocabulary")
    first = materialize(first_rows(counts, ["length"], "proteins", "kmer", "_own"), "first")
    left = budget - first.count()
    rest = counts.join(first.select("length", "kmer"), ["length", "kmer"], "left_anti")
    rest = rest.select("length", "kmer", "proteins", F.concat(F.lit("k"), "length", F.lit(":"), "kmer").alias("_id"), F.lit(left).cast("long").alias("_left"))
    more = first_rows(rest, [], "proteins", "_id", "_left")
    return first.select("length", "kmer", "proteins").unionByName(more.select("length", "kmer", "proteins"))


def kmer_features(proteins: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(protein_id, feature_type, feature_id, feature_name, derivation_scope, feature_definition_sha256) of the k-mers of a vocabulary.

    The definition digest is that of the text that names type, id and algorithm, a line each.
    """
    rows = kmer_rows(proteins, vocabulary)
    key = F.concat(F.lit("k"), "length", F.lit(":"), "kmer")
    text = F.concat(F.lit("feature definition v1\nfeature_type=AMINO_ACID_KMER\nfeature_id="), key, F.lit("\nalgorithm=exact_protein_level_presence\n"))
    defined = vocabulary.select("length", "kmer", key.alias("feature_id"), F.sha2(text, 256).alias("feature_definition_sha256"))
    joined = rows.join(defined, ["length", "kmer"])
    return joined.select("protein_id", F.lit("AMINO_ACID_KMER").alias("feature_type"), "feature_id", F.concat(F.lit("k"), "length", F.lit(" "), "kmer").alias("feature_name"), F.lit("DISCOVERY_DERIVED").alias("derivation_scope"), "feature_definition_sha256")


def occurrences(sequence: Column, motif: str) -> Column:
    """1-based starts of all overlapping occurrences, found one after another; null of null."""

    @F.pandas_udf("array<int>")
    def starts(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[int] | None:
            if text is None:
                return None
            found, at = [], text.find(motif)
            while at >= 0:
                found.append(at + 1)
                at = text.find(motif, at + 1)
            return found

        return texts.map(one)

    return starts(sequence)


def residues(aligned: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(sequence_id, column, residue) of aligned rows, with the columns of ``within``; columns count from 1."""
    return aligned.select("sequence_id", *within, F.posexplode(F.split("sequence", ""))).select("sequence_id", *within, (F.col("pos") + 1).alias("column"), F.col("col").alias("residue"))


#: The twenty residues that count as known.
CANONICAL = "ACDEFGHIKLMNPQRSTVWY"


def column_summary(aligned: DataFrame, known: str = CANONICAL, reference: object = None) -> DataFrame:
    """Per column: gap fraction, fraction of known residues, the most frequent known residue (then the first), its share of the known, entropy in bits.

    With the id of a ``reference`` row also ``reference_position``, null at its gaps.
    """
    counts = residues(aligned).groupBy("column", "residue").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("column")
    real = F.col("residue").isin(*known)
    some = counts.withColumns({"rows": F.sum("n").over(whole), "filled": F.sum(F.when(real, F.col("n")).otherwise(0)).over(whole)})
    p = F.col("n") / F.col("filled")
    out = some.groupBy("column").agg(
        (F.sum(F.when(F.col("residue") == "-", F.col("n")).otherwise(0)) / F.max("rows")).alias("gap_fraction"),
        (F.max("filled") / F.max("rows")).alias("canonical_fraction"),
        F.min(F.when(real, F.struct((-F.col("n")).alias("n"), F.col("residue").alias("r")))).alias("best"),
        F.sum(F.when(real, -p * F.log2(p))).alias("entropy"),
        F.max("filled").alias("filled"),
    ).select("column", "gap_fraction", "canonical_fraction", F.col("best.r").alias("consensus"), (-F.col("best.n") / F.col("filled")).alias("consensus_share"), "entropy")
    if reference is None:
        return out
    own = residues(aligned.filter(F.col("sequence_id") == reference)).filter("residue <> '-'").select("column")
    return out.join(reference_positions(aligned, reference).join(own, "column", "left_semi").withColumnRenamed("position", "reference_position"), "column", "left")


def read_substitutions(spark: SparkSession, path: str) -> DataFrame:
    """(first, second, score) of a residue substitution matrix in its usual text form: ``#`` remarks, a heading of residues, a line each."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    cells = lines.select(F.split(F.trim("value"), r"\s+").alias("cells"), F.col("value").rlike(r"^\s").alias("heading"))
    heading = cells.filter("heading").select(F.col("cells").alias("names"))
    rows = cells.filter("not heading").crossJoin(F.broadcast(heading))
    return rows.select(F.col("cells")[0].alias("first"), F.explode(F.arrays_zip("names", F.slice("cells", 2, 100).alias("scores"))).alias("z")).select("first", F.col("z.names").alias("second"), F.col("z.scores").cast("double").alias("score"))


def alignment_members(aligned: DataFrame, reference: object, scores: DataFrame, known: str = CANONICAL) -> DataFrame:
    """Every row against a reference row: own length, comparable and identical known residues, overlaps of both, and the sum of substitution scores.

    ``scores``: first, second, score. Shares are null where they have no denominator.
    """
    long = residues(aligned)
    own = residues(aligned.filter(F.col("sequence_id") == reference)).select("column", F.col("residue").alias("_of"))
    width = F.length(F.regexp_replace("sequence", "-", ""))
    sizes = aligned.select("sequence_id", width.cast("long").alias("sequence_length"))
    joined = long.join(F.broadcast(own), "column")
    table = scores.select(F.col("first").alias("_of"), F.col("second").alias("residue"), "score")
    both = F.col("_of").isin(*known) & F.col("residue").isin(*known)
    sums = joined.join(F.broadcast(table), ["_of", "residue"], "left").groupBy("sequence_id").agg(
        F.count_if((F.col("_of") != "-") & (F.col("residue") != "-")).alias("_overlap"), F.count_if(both).alias("comparable"),
        F.count_if(both & (F.col("_of") == F.col("residue"))).alias("_identical"), F.coalesce(F.sum(F.when(both, F.col("score"))), F.lit(0.0)).alias("substitution_score"),
        F.count_if(F.col("_of") != "-").alias("_reference"),
    )
    share = lambda a, b: F.col(a) / F.when(F.col(b) > 0, F.col(b))
    return sums.join(sizes, "sequence_id").select(
        "sequence_id", "sequence_length", "comparable", share("_identical", "comparable").alias("identity_to_reference"),
        share("_overlap", "_reference").alias("reference_overlap"), share("_overlap", "sequence_length").alias("member_overlap"), "substitution_score",
    )


def pairwise_identity(aligned: DataFrame, within: Sequence[str] = (), known: str | None = None) -> DataFrame:
    """(a, b, comparable, identical, identity) of pairs of rows with a <= b, over columns where both have residues (of ``known``, if given).

    ``within``: columns that name an alignment, where a table holds many; only rows of one are paired, and an id names one row of one alignment. Rows are dealt into blocks of about ``PAIR_ROWS``;
    a pair of blocks is one row of work, whose counts are products of the incidence matrices of each residue. Residues are characters of Latin-1.
    """
    within = list(within)
    sizes = aligned.groupBy(*within).agg(F.ceil(F.count("*") / PAIR_ROWS).alias("_blocks"))
    placed = aligned.join(sizes, within) if within else aligned.crossJoin(F.broadcast(sizes))
    block = F.pmod(F.xxhash64("sequence_id"), F.col("_blocks")).cast("int")
    blocks = placed.groupBy(*within, "_blocks", block.alias("_block")).agg(F.collect_list(F.struct("sequence_id", "sequence")).alias("_rows"))
    meet = F.transform(F.sequence(F.lit(0), (F.col("_blocks") - 1).cast("int")), lambda k: F.struct(F.least(k, "_block").alias("x"), F.greatest(k, "_block").alias("y")))
    met = blocks.withColumn("_meet", F.explode(meet)).groupBy(*within, "_meet").agg(F.sort_array(F.collect_list(F.struct("_block", "_rows"))).alias("pair"))
    name = aligned.schema["sequence_id"].dataType
    schema = T.StructType([T.StructField("a", name), T.StructField("b", name), T.StructField("comparable", T.LongType()), T.StructField("identical", T.LongType())])
    letters = np.array([ord(c) for c in known], np.uint8) if known else None

    def matrix(rows: list[dict]) -> np.ndarray:
        texts = [(r["sequence"] or "").encode("latin-1", "replace") for r in rows]
        out = np.zeros((len(texts), max(map(len, texts), default=0)), np.uint8)
        for k, text in enumerate(texts):
            out[k, : len(text)] = np.frombuffer(text, np.uint8)
        return np.where(np.isin(out, letters) if known else (out != ord("-")), out, 0)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("pair").type.value_type.field("_rows").type.value_type.field("sequence_id").type
            for pair in batch.column("pair"):
                sides = [s["_rows"] for s in pair.as_py()]
                left, right = sides[0], sides[-1]
                x, y = matrix(left), matrix(right)
                wide = min(x.shape[1], y.shape[1])
                x, y = x[:, :wide], y[:, :wide]
                comparable = (x != 0).astype(np.float32) @ (y != 0).astype(np.float32).T
                identical = sum(((x == c).astype(np.float32) @ (y == c).astype(np.float32).T for c in np.unique(x[x != 0])), np.zeros_like(comparable))
                at, to = np.nonzero(comparable)
                ids, others = [r["sequence_id"] for r in left], [r["sequence_id"] for r in right]
                order = np.array([[a <= b for b in others] for a in ids])
                own = len(sides) == 1
                # within one block each pair stands there from both sides
                keep = order[at, to] if own else np.ones(len(at), bool)
                at, to = at[keep], to[keep]
                first = [ids[i] if order[i, j] else others[j] for i, j in zip(at.tolist(), to.tolist(), strict=True)]
                second = [others[j] if order[i, j] else ids[i] for i, j in zip(at.tolist(), to.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(first, kind), pa.array(second, kind), pa.array(comparable[at, to].astype(np.int64)), pa.array(identical[at, to].astype(np.int64))], names=schema.fieldNames())

    pairs = met.select("pair").mapInArrow(products, schema)
    return pairs.withColumn("identity", F.col("identical") / F.col("comparable"))


def reference_positions(aligned: DataFrame, reference: object) -> DataFrame:
    """(column, position): the running number of residues along the reference row."""
    own = residues(aligned.filter(F.col("sequence_id") == reference))
    return own.select("column", F.sum(F.when(F.col("residue") != "-", 1).otherwise(0)).over(Window.orderBy("column").rowsBetween(Window.unboundedPreceding, 0)).alias("position"))


def ordered_digests(rows: DataFrame, group: str, key: str | None, text: str) -> DataFrame:
    """(group, digest): SHA-256 over the lines ``key, tab, text, newline`` of a group in order of key; null where it has none.

    Without a key the lines are ``text, newline`` in order of the text.

    Lines are sorted in ranges and joined into chunks in parallel. A digest is one chain, so a group's chunks pass through
    one task; it sorts on disk and holds a batch of them at a time.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def out() -> pa.RecordBatch:
            chunk = {"g": held[0]["g"], "first": held[0]["line"], "k": held[0]["k"], "last_k": held[-1]["k"], "last": held[-1]["line"], "lines": "".join(r["line"] for r in held)}
            held.clear()
            return pa.RecordBatch.from_pylist([chunk], schema=packed)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == CHUNK_LINES or held[0]["g"] != row["g"]):
                    yield out()
                held.append(row)
        if held:
            yield out()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["g"] != at:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([{"g": at, "digest": state.hexdigest()}], schema=digested)
                    at, state = row["g"], hashlib.sha256()
                state.update(row["lines"].encode())
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"g": at, "digest": state.hexdigest()}], schema=digested)

    s = pa.string()
    packed = pa.schema([("g", s), ("first", s), ("k", pa.int64()), ("last_k", pa.int64()), ("last", s), ("lines", s)])
    digested = pa.schema([("g", s), ("digest", s)])
    head = [F.col(key).cast("string"), F.lit("\t")] if key else []
    line = F.concat(*head, F.col(text), F.lit("\n"))
    place = F.col(key).cast("long") if key else F.lit(0).cast("long")
    lines = materialize(rows.select(F.col(group).cast("string").alias("g"), place.alias("k"), line.alias("line")), "lines")
    ranged = lines.filter("line is not null").repartitionByRange("g", "k", "line").sortWithinPartitions("g", "k", "line")
    chunks = ranged.mapInArrow(pack, "g string, first string, k long, last_k long, last string, lines string")
    # equal lines may fill a chunk whole, so the last line takes part in the order
    in_order = chunks.repartition("g").sortWithinPartitions("g", "k", "first", "last_k", "last")
    found = in_order.mapInArrow(digest, "g string, digest string").withColumnRenamed("g", "of")
    groups = lines.select("g").distinct()
    return groups.join(found, F.col("g").eqNullSafe(F.col("of")), "left").select(F.col("g").alias(group), "digest")


def digest_tree(rows: DataFrame, group: str, key: str, text: str, fan: int = FAN) -> DataFrame:
    """(group, digest): a tree of SHA-256 digests over the lines ``key, tab, text, newline`` of a group in order of key, then line; null where it has none.

    The lines are numbered in their order; ``fan`` at a time are digested, then ``fan`` of these digests (as hexadecimal text, one after another), and so on until one is left. So a digest depends on the
    lines alone, and no task holds more than ``fan`` of a group.
    """
    line = F.concat(F.col(key).cast("string"), F.lit("\t"), F.col(text), F.lit("\n"))
    lines = rows.select(F.col(group).alias("g"), F.col(key).alias("k"), line.alias("line")).filter("line IS NOT NULL")
    nodes = running_count(lines, ["g"], ["k", "line"], upto="no", whole="nodes").select("g", (F.col("no") - 1).alias("no"), "line", "nodes")
    most = None
    while most is None or most > 1:
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("no", "line"))), lambda x: x["line"]), "")
        up = nodes.groupBy("g", "nodes", F.floor(F.col("no") / fan).cast("long").alias("up")).agg(joined.alias("joined"))
        # a group that is down to one digest keeps it
        done = F.lit(False) if most is None else F.col("nodes") == 1
        nodes = up.select("g", F.col("up").alias("no"), F.when(done, F.col("joined")).otherwise(F.sha2("joined", 256)).alias("line"), F.ceil(F.col("nodes") / fan).cast("long").alias("nodes"))
        nodes = materialize(nodes, "digests")
        most = nodes.agg(F.max("nodes")).first()[0] or 0
    groups = rows.select(F.col(group).alias("of")).distinct()
    return groups.join(nodes, F.col("of").eqNullSafe(F.col("g")), "left").select(F.col("of").alias(group), F.col("line").alias("digest"))
