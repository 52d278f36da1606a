"""Repair of the role structure of conversations by a rank-convergence Viterbi pass (operator 11).

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Four states follow that
language: nothing yet, after ``s``, after ``u`` (an ``a`` must come), after ``a``. Rows are kept, given
another role or deleted, and rows without text may be inserted. The cost from a row to the end of its
conversation is a vector over the states; only the differences between its entries steer the edits.

Conversations are cut into chunks in their order. Every chunk first runs backwards from a speculative
vector. Fix-up passes then hand each chunk the vector of the chunk behind it and run it again until the
new vectors differ from the old ones by a constant only; passes end when no chunk has news. A task of a
pass goes through its chunks from the back, so a pass settles at least one more task of a conversation,
whatever the rows. With true vectors every chunk maps the state before it to the state behind it; these
maps are composed in blocks, and each chunk traces its edits from its own state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.llm.tables import small_batches
from cohortry.storage import materialize

#: Rows of a conversation that make up a chunk, and the bytes of text that close one early.
CHUNK_ROWS = 64
CHUNK_BYTES = 4 << 20
#: Chunks whose maps of states are composed at a time.
COMPOSED = 1024

START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
#: The state that an inserted or reroled row leads to, and the states after which a kept row may come.
NEXT = (USER, USER, ASSISTANT, USER)
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Cost of a legal end from each state, and the vector that stands for one that is not known yet.
END = (0, 4, 2, 0)
GUESS = (0, 0, 0, 0)
BLANK = r"\x20\x09-\x0D"


@lru_cache(maxsize=1 << 16)
def before(vector: tuple[int, ...], row: str) -> tuple[tuple[int, ...], int]:
    """The costs before a row, less their least one, and that least one; ``vector`` has the costs after it.

    ``row`` is s, u, a or x by its role, upper case if its text is cut off, or d if it must go.
    """
    kind = row.lower()
    cut = CUT if row.isupper() else 0
    costs = [DELETE + v for v in vector]
    if kind != "d":
        for q in range(4):
            costs[q] = min(costs[q], REROLE + cut + vector[NEXT[q]])
            if q in KEEP[kind]:
                costs[q] = min(costs[q], cut + vector[KEEP[kind][q]])
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    least = min(costs)
    return tuple(c - least for c in costs), least


def backward(rows: str, vector: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a chunk, from the one behind it."""
    for row in reversed(rows):
        vector, _ = before(vector, row)
    return vector


def again(rows: str, old: tuple[int, ...], left: tuple[int, ...], new: tuple[int, ...]) -> tuple[int, ...]:
    """``backward`` from ``new``, when ``old`` is known to give ``left``: it stops where the two runs meet."""
    for row in reversed(rows):
        if old == new:
            return left
        old, new = before(old, row)[0], before(new, row)[0]
    return left if old == new else new


def trace(rows: str, vector: tuple[int, ...], state: int, last: bool) -> tuple[list[tuple[str, int]], int, int]:
    """The edits of a chunk that are cheapest and, of equal cost, least as text: (initial, state after it), their cost, and the state behind it.

    Every initial leads to one state only, so taking the least one that stays on a cheapest path is enough.
    """
    vectors, steps = [vector], []
    for row in reversed(rows):
        vector, least = before(vector, row)
        vectors.append(vector)
        steps.append(least)
    vectors.reverse()
    steps.reverse()
    edits, cost = [], 0
    for k, row in enumerate(rows):
        here, after, kind = vectors[k], vectors[k + 1], row.lower()
        cut = CUT if row.isupper() else 0
        while True:
            left = here[state] + steps[k]
            if left == DELETE + after[state]:
                edits.append(("D", state))
                cost += DELETE
                break
            if here[state] == INSERT + here[NEXT[state]]:
                state = NEXT[state]
                edits.append(("I", state))
                cost += INSERT
                continue
            if state in KEEP[kind] and left == cut + after[KEEP[kind][state]]:
                state = KEEP[kind][state]
                edits.append(("K", state))
                cost += cut
            else:
                state = NEXT[state]
                edits.append(("R", state))
                cost += REROLE + cut
            break
    while last and END[state]:
        state = NEXT[state]
        edits.append(("I", state))
        cost += INSERT
    return edits, cost, state


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults by the crc32 of ``conv_id:turn``: conv_id, turn, role, text, n (0 for a row that is dropped, 2 for one that is repeated).

    0 of 20 drops a row, 1 empties its text, 2 takes its full stops, question and exclamation marks, 3 repeats it, 4 makes it the user's.
    Nulls read as one space, but conv_id and turn stay null.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    role = F.when(fault == 4, F.lit("user")).otherwise(filled("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("n"))


def _digest(*names: str) -> Column:
    """A digest of some columns in which nulls differ from all values and no two rows read alike."""
    parts = [F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string"))) for c in names]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _ordered(rows: DataFrame) -> DataFrame:
    """Different rows with their number, whether they must go and whether their text is cut off, dealt by range and sorted by conversation, turn, role, text."""
    named = rows.withColumn("row", _digest("conv_id", "turn", "role", "text")).withColumn("said", _digest("conv_id", "role", "text"))
    once = named.groupBy("row").agg(F.first(F.struct("conv_id", "turn", "role", "text")).alias("r"), F.sum("n").alias("n"))
    # nulls are the earliest turns; only texts that are said at several turns are looked at, by digests
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    brief = named.filter("n > 0").select("row", "said", turn.alias("at"))
    first = brief.groupBy("said").agg(F.min("at").alias("first"), F.max("at").alias("latest")).filter("first <> latest").select("said", "first", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    later = brief.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(16)).cast("int")).join(first, ["said", "salt"]).filter("at > first").select("row", F.lit(True).alias("later")).distinct()
    text = F.col("r.text")
    forced = ~text.rlike(f"[^{BLANK}]")
    cut = ~text.rlike(rf"[.!?][{BLANK}]*\z")
    flat = once.join(later, "row", "left").select("r.*", "n", forced.alias("blank"), F.coalesce("later", F.lit(False)).alias("later"), cut.alias("cut"))
    return flat.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 256)).sortWithinPartitions("conv_id", "turn", "role", "text")


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """The chunks of sorted rows with the counts that need no neighbour."""
    conv, turn = rows.schema["conv_id"].dataType, rows.schema["turn"].dataType
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("no", T.LongType()), T.StructField("conv_id", conv), T.StructField("rows", T.StringType())]
        + [T.StructField(n, T.ArrayType(t)) for n, t in (("copies", T.LongType()), ("roles", T.StringType()), ("texts", T.StringType()))]
        + [T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "turns")]
        + [T.StructField("first_turn", turn), T.StructField("last_turn", turn), T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part, names, arrow = TaskContext.get().partitionId(), schema.fieldNames(), to_arrow_schema(schema)
        no, size, key, now = 0, 0, None, None
        done: list[dict] = []

        def fresh(key) -> dict:
            return dict.fromkeys(names) | {"part": part, "no": no, "conv_id": key, "rows": "", "copies": [], "roles": [], "texts": [], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([c[n] for c in done], arrow.field(n).type) for n in names], names=names)
            done.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now["conv_id"] or len(now["rows"]) >= chunk_rows or size >= CHUNK_BYTES:
                    if now is not None:
                        done.append(now)
                        no += 1
                    if len(done) >= 1024 or size >= CHUNK_BYTES:
                        yield flush()
                        size = 0
                    now = fresh(row["conv_id"])
                n = row["n"]
                if not n:
                    continue
                initial = row["role"][:1]
                if now["rows"]:
                    now["illegal"] += now["last_initial"] + initial not in ("su", "ua", "au")
                else:
                    now["first_initial"] = initial
                now["illegal"] += n - 1
                now["last_initial"] = initial
                if row["turn"] is not None:
                    now["turns"] += row["turn"] != now["last_turn"]
                    now["first_turn"] = row["turn"] if now["first_turn"] is None else now["first_turn"]
                    now["last_turn"] = row["turn"]
                kind = initial if initial in KEEP and initial != "x" else "x"
                if row["blank"]:
                    now["blank"] += n
                    kind = "d"
                else:
                    now["duplicate"] += n - 1 + row["later"]
                    if row["later"]:
                        kind = "d"
                    elif row["cut"]:
                        now["truncated"] += 1
                        kind = kind.upper()
                now["rows"] += kind
                now["copies"].append(n)
                now["roles"].append(row["role"] if kind != "d" else "")
                now["texts"].append(row["text"] if kind != "d" else "")
                size += len(row["text"])
        if now is not None:
            done.append(now)
        if done:
            yield flush()

    return small_batches(rows).mapInArrow(cut, schema)


def _vectors(chunks: DataFrame) -> DataFrame:
    """g, right and whether a chunk is the last of its conversation; of chunks that have a neighbour in their conversation."""
    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rights = [END if last else GUESS for last in batch.column("last").to_pylist()]
            lefts = [backward(r, v) for r, v in zip(batch.column("rows").to_pylist(), rights, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rights, pa.list_(pa.int32())), pa.array(lefts, pa.list_(pa.int32()))], names=["g", "rows", "first", "last", "right", "left"])

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        behind = None
        for batch in batches:
            rights, lefts = [], []
            for row in batch.to_pylist():
                old, left, new = tuple(row["right"]), tuple(row["left"]), tuple(row["want"])
                if behind and behind[0] == row["g"] + 1 and not row["last"]:
                    new = behind[1]
                left = again(row["rows"], old, left, new)
                behind = row["g"], left
                rights.append(new)
                lefts.append(left)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("g", "rows", "first", "last")), pa.array(rights, pa.list_(pa.int32())), pa.array(lefts, pa.list_(pa.int32()))], names=["g", "rows", "first", "last", "right", "left"])

    schema = "g long, rows string, first boolean, last boolean, right array<int>, left array<int>"
    state = materialize(chunks.select("g", "rows", "first", "last").mapInArrow(guess, schema), "vectors")
    while True:
        behind = state.select((F.col("g") - 1).alias("g"), F.col("left").alias("want"))
        told = state.join(behind, "g", "left").withColumn("want", F.when(F.col("last"), F.col("right")).otherwise(F.col("want")))
        if told.filter("want <> right").isEmpty():
            return state
        swept = told.repartitionByRange("g").sortWithinPartitions(F.col("g").desc())
        state = materialize(swept.mapInArrow(fix, schema), "vectors")


def _entries(maps: DataFrame) -> DataFrame:
    """g and the state before it, for rows (g, ends): ends[q] is the state behind g when q is the one before it.

    Blocks of ``COMPOSED`` rows are composed, then the blocks by the same function, so no task holds more than a block.
    """
    block = F.floor(F.col("g") / COMPOSED).cast("long")
    lists = maps.groupBy(block.alias("b")).agg(F.sort_array(F.collect_list(F.struct("g", "ends"))).alias("of"))
    top = maps.agg(F.max("g")).first()[0]
    if top is not None and top >= COMPOSED:
        ends = F.aggregate("of", F.array(*map(F.lit, range(4))), lambda got, x: F.transform(got, lambda q: F.element_at(x["ends"], q + 1)))
        lists = lists.join(_entries(materialize(lists.select(F.col("b").alias("g"), ends.alias("ends")), "maps")).select(F.col("g").alias("b"), "state"), "b")
    else:
        lists = lists.withColumn("state", F.lit(START))
    begin = F.struct(F.col("state").alias("state"), F.array().cast("array<struct<g:bigint,state:int>>").alias("out"))
    run = F.aggregate("of", begin, lambda got, x: F.struct(F.element_at(x["ends"], got["state"] + 1).alias("state"), F.concat(got["out"], F.array(F.struct(x["g"].alias("g"), got["state"].alias("state")))).alias("out")))
    return lists.select(F.inline(run["out"]))


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Repair conversations; ``rows`` has conv_id, turn, role, text and n, the number of times that a row stands there (as ``damage`` gives it).

    Per conv_id: gaps, blank, duplicate, truncated, illegal and cost (long), audit (initials of the edits) and repaired_sha256
    (of the repaired ``role:text``, joined by newlines). Rows stand by turn (null first), then role, then text. A null conv_id is one conversation.
    A role is known by its first character; an empty role has none and cannot be kept. A conversation all of whose n are 0 has zeros and an empty audit;
    no rows give none; other columns are ignored. Roles and texts must not be null.
    Repeated rows are counted before they are shuffled. The digest of a conversation is one stream, and its audit one cell: both pass through one task, chunk by chunk.
    """
    cells = materialize(_chunks(_ordered(rows.select("conv_id", "turn", "role", "text", "n")), chunk_rows), "chunks")
    sizes = cells.groupBy("part").agg(F.max("no").alias("n"))
    base = sizes.select("part", F.coalesce(F.sum(F.col("n") + 1).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = cells.join(base, "part").withColumn("g", F.col("base") + F.col("no")).drop("base", "part", "no")
    brief = placed.select("g", "conv_id", "rows")
    # a chunk that is the only one of its conversation needs no other
    beside = [brief.select((F.col("g") + k).alias("g"), F.struct("conv_id").alias(n)) for k, n in ((1, "front"), (-1, "rear"))]
    own = F.struct("conv_id")
    edges = brief.join(beside[0], "g", "left").join(beside[1], "g", "left").withColumn("first", ~F.coalesce(F.col("front") == own, F.lit(False))).withColumn("last", ~F.coalesce(F.col("rear") == own, F.lit(False)))
    vectors = _vectors(materialize(edges.filter("NOT (first AND last)").select("g", "rows", "first", "last"), "edges"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[trace(r["rows"], tuple(r["right"]), START if r["first"] else q, False)[2] for q in range(4)] for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("g"), pa.array(found, pa.list_(pa.int32()))], names=["g", "ends"])

    maps = materialize(vectors.select("g", "rows", "first", "right").mapInArrow(ends, "g long, ends array<int>"), "maps")
    states = vectors.select("g", "right", "first", "last").join(_entries(maps), "g").select("g", "right", "last", F.when(F.col("first"), START).otherwise(F.col("state")).alias("state"))
    whole = placed.join(states, "g", "left").select(
        *placed.columns, F.coalesce("right", F.array(*map(F.lit, END))).alias("right"), F.coalesce("state", F.lit(START)).alias("state"), F.coalesce("last", F.lit(True)).alias("last")
    )
    kept = ["conv_id", "g", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first_initial", "last_initial"]
    pieces = T.StructType([placed.schema[n] for n in kept] + [T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired", T.ArrayType(T.StringType()))])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, audits, texts = [], [], []
            for r in pa.RecordBatch.from_arrays([batch.column(n) for n in ("rows", "copies", "roles", "texts", "right", "state", "last")], names=["rows", "copies", "roles", "texts", "right", "state", "last"]).to_pylist():
                edits, cost, _ = trace(r["rows"], tuple(r["right"]), r["state"], r["last"])
                audit, out, k = [], [], 0
                for what, state in edits:
                    audit.append(what)
                    if what == "I":
                        out.append(f"{NAMES[state]}:")
                        continue
                    if what != "D":
                        out.append(f"{r['roles'][k] if what == 'K' else NAMES[state]}:{r['texts'][k]}")
                    # further copies of a row are duplicates, or blank as it is
                    audit.append("D" * (r["copies"][k] - 1))
                    cost += DELETE * (r["copies"][k] - 1)
                    k += 1
                costs.append(cost)
                audits.append("".join(audit))
                texts.append(out)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(texts, pa.list_(pa.string()))], names=pieces.fieldNames())

    edited = small_batches(whole).mapInArrow(edit, pieces)
    streams = edited.repartition("conv_id").sortWithinPartitions("conv_id", "g")
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    result = T.StructType([rows.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in sums], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, out = None, []

        def closed(c: dict) -> tuple:
            gaps = 0 if c["low"] is None else c["high"] - c["low"] + 1 - c["turns"]
            return (c["conv_id"], gaps, *(c[n] for n in sums[1:]), "".join(c["audit"]), c["hash"].hexdigest())

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [kind, *[pa.int64()] * len(sums), pa.string(), pa.string()], strict=True)], names=result.fieldNames())
            out.clear()
            return batch

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for r in batch.to_pylist():
                if open_ is None or open_["conv_id"] != r["conv_id"]:
                    if open_ is not None:
                        out.append(closed(open_))
                    open_ = {"conv_id": r["conv_id"], "low": None, "high": None, "turns": 0, "initial": None, "audit": [], "hash": hashlib.sha256(), "any": False, **dict.fromkeys(sums, 0)}
                for n in sums[1:]:
                    open_[n] += r[n]
                if r["first_initial"] is not None:
                    open_["illegal"] += open_["initial"] is not None and open_["initial"] + r["first_initial"] not in ("su", "ua", "au")
                    open_["initial"] = r["last_initial"]
                if r["first_turn"] is not None:
                    open_["turns"] += r["turns"] - (open_["high"] == r["first_turn"])
                    open_["low"] = r["first_turn"] if open_["low"] is None else open_["low"]
                    open_["high"] = r["last_turn"]
                open_["audit"].append(r["audit"])
                for text in r["repaired"]:
                    open_["hash"].update(("\n" if open_["any"] else "").encode() + text.encode())
                    open_["any"] = True
                if len(out) >= 10_000:
                    yield flush()
        if open_ is not None:
            out.append(closed(open_))
        if out:
            yield flush()

    return small_batches(streams).mapInArrow(fold, result)
