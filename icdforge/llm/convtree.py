"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

``prefixes`` gives one row per conversation and prefix length.  A prefix is told
by the exclusive or of the 128-bit digests of its (position, turn) pairs, so it
is a running total that a long conversation can be cut up for; the trie's build
checks every node for one last turn and one parent, and fails on a collision.

``subtree_totals`` contracts a forest.  Each round rakes the leaves (their
totals are final and are added to their parents by a map-side combined sum) and
compresses unary chains: of the nodes with one child an independent set is
spliced out, first by their depth's trailing zeros, so that a fresh chain halves,
in the next round by a hash, so that every chain shrinks.  A node knows its only
child from the exclusive or of its children, without a join.  A spliced node
keeps what lies above its child; when the forest is down to its roots, the
rounds are undone in reverse, each spliced node adding its child's total.  Every
join is between unique keys.  Rounds grow with the logarithm of the nodes, not
with the depth, and each is written to the shared folder.

Defined results: null role or text is empty; rows without a conv_id are in no
conversation; turns of equal number are ordered by role, then by their text's
digest; repeated rows are repeated turns; empty texts are turns like others; a
text counts with all its bytes; an empty table gives an empty trie; columns
other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship, text_of

#: positions of a conversation that one task puts in order
POSITIONS_PER_BUCKET = 20_000
#: decimal ids that make one row of a list in writing
IDS_PER_ROW = 500


# ---------------------------------------------------------------- turns

def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0, by turn, null first), digest (of role and text),
    bytes (of the text).  Rows are dealt by (conv_id, turn, role, digest), so a
    conversation of any length is numbered by many tasks."""
    role, text = text_of("role"), text_of("text")
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "scan"]  # the last tells equal turns apart
    rows = rows.withColumn("scan", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("row", F.monotonically_increasing_id()).drop("turn", "role", "scan")
    rows = materialize(rows.withColumn("part", F.shiftright("row", 33)), "turns")
    runs = rows.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    return rows.join(runs, ["conv_id", "part"]).select("conv_id", (F.col("ahead") + F.col("row") - F.col("first")).alias("pos"), "digest", "bytes")


def rebuilt_turns(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns).  Conversation c begins with the first h turns of
    c - c % ``family`` and goes on with its own turns after its first h, with
    h = crc32(c) % ``heads``.  At most ``heads`` - 1 turns of a first
    conversation are copied, to fewer than 2 * ``family`` others."""
    own = materialize(numbered_turns(turns), "numbered")
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = materialize(convs.select("conv_id", "base", "h", "head"), "conversations")
    first = own.filter((F.col("pos") < heads - 1) & (F.col("conv_id") % family == 0)).withColumnRenamed("conv_id", "base")
    copied = first.join(convs, "base").filter("pos < h").select("conv_id", "pos", "digest", "bytes")
    later = own.join(convs, "conv_id").filter("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "digest", "bytes")
    return convs.select("conv_id"), copied.union(later)


def prefixes(turns: DataFrame) -> DataFrame:
    """From conv_id, pos, digest, bytes: one row per conversation and depth >= 1
    with the prefix's key (k1, k2), its parent's (p1, p2), digest and bytes."""
    cell = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), "digest").cast("binary"), 256)
    lane = [F.conv(F.substring(cell, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(2)]
    rows = turns.select("conv_id", "pos", "digest", "bytes", lane[0].alias("x1"), lane[1].alias("x2"), F.expr(f"pos div {POSITIONS_PER_BUCKET}").alias("bucket"))
    per = rows.groupBy("conv_id", "bucket").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    ahead = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("conv_id", "bucket", *(F.coalesce(F.bit_xor(x).over(ahead), F.lit(0)).alias(b) for x, b in (("x1", "b1"), ("x2", "b2"))))
    within = Window.partitionBy("conv_id", "bucket").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = rows.join(per, ["conv_id", "bucket"]).select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "digest", "bytes", "x1", "x2",
        *(F.col(b).bitwiseXOR(F.bit_xor(x).over(within)).alias(k) for x, b, k in (("x1", "b1", "k1"), ("x2", "b2", "k2"))))
    return keyed.select("conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "digest", "bytes")


# ---------------------------------------------------------------- nodes

def trie(convs: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes: conv_id (smallest member), depth, k1, k2, parent_conv_id, n_convs,
    n_children, bytes (of the last turn's text)."""
    same = [F.min(c) == F.max(c) for c in ("digest", "p1", "p2")]
    inner = members.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        (same[0] & same[1] & same[2]).alias("one"))
    inner = inner.withColumn("bytes", F.when(F.col("one"), F.col("bytes")).otherwise(F.raise_error(F.lit("two prefixes have one key")).cast("long"))).drop("one")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("bytes"), none.alias("p1"), none.alias("p2"))
    nodes = materialize(inner.select(root.columns).union(root), "nodes")
    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = materialize(nodes.join(kids, ["depth", "k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    # a parent of many children is sent to them; there are at most 100,000 such
    # parents, and the others have at most 1 child in 100,000 or 10,000 children
    many = max(10_000, nodes.count() // 100_000)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > many).alias("big"), "n_children").filter("n_children > 0").drop("n_children")
    big = parents.filter("big").select("depth", "p1", "p2", F.col("parent_conv_id").alias("big_parent"))
    seen = nodes.join(F.broadcast(big), ["depth", "p1", "p2"], "left")
    own = lambda c: F.when(F.col("big_parent").isNull(), F.col(c))  # noqa: E731  no hot key is shuffled
    small = parents.filter("NOT big").select(F.col("depth").alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), "parent_conv_id")
    spread = F.when(F.col("big_parent").isNull(), F.col("depth")).otherwise(-1 - F.pmod(F.col("k1"), F.lit(1 << 20)))
    seen = seen.withColumn("to", spread).withColumn("a", F.coalesce(own("p1"), F.lit(0))).withColumn("b", F.coalesce(own("p2"), F.lit(0)))
    full = seen.join(small, (seen["to"] == small["d"]) & (seen["a"] == small["q1"]) & (seen["b"] == small["q2"]), "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("big_parent", "parent_conv_id"))
    return full.select("conv_id", "depth", "k1", "k2", parent.alias("parent_conv_id"), "n_convs", "n_children", "bytes")


def id_lists(members: DataFrame, keys: list[str], schema: str) -> DataFrame:
    """Per ``keys`` the SHA-256 (hex) of its conv_ids in ascending decimal
    writing, comma-joined.  The ids are sorted and written over all tasks; the
    digest, which has no parallel form, then reads a key's list as rows of
    ``IDS_PER_ROW`` ids, one at a time."""
    names = [*keys, "conv_id"]
    ship()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        done: list[tuple] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())], names=[*names, "ids"])

        for batch in batches:
            for *own, conv in zip(*(batch.column(c).to_pylist() for c in names)):
                if own != key or len(held) == IDS_PER_ROW:
                    if held:
                        done.append((*key, held[0], ",".join(map(str, held))))
                    held, key = [], own
                held.append(conv)
                if len(done) >= 1000:
                    yield rows()
        if held:
            done.append((*key, held[0], ",".join(map(str, held))))
        if done:
            yield rows()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key = None, None
        done: list[tuple] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())], names=[*keys, "sha256"])

        for batch in batches:
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in keys), batch.column("ids")):
                if own != key:
                    if state is not None:
                        done.append((*key, state.hexdigest()))
                    state, key = hashlib.sha256(), own
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
                if len(done) >= 1000:
                    yield rows()
        if state is not None:
            done.append((*key, state.hexdigest()))
        if done:
            yield rows()

    ordered = members.select(*names).repartitionByRange(*names).sortWithinPartitions(*names)
    lists = ordered.mapInArrow(write, f"{schema}, conv_id long, ids string")
    return lists.repartition(*keys).sortWithinPartitions(*names).mapInArrow(digest, f"{schema}, sha256 string")


# ---------------------------------------------------------------- contraction

def _trailing_zeros(depth: Column) -> Column:
    """Of a positive number (a root's 0 counts as many)."""
    return F.when(depth == 0, 64).otherwise(F.bit_count(depth.bitwiseAND(-depth) - 1))


def _sooner(a: tuple[str, str], b: tuple[str, str], turn: int) -> Column:
    """Whether node ``a`` is spliced before its neighbour ``b`` in a round."""
    def rank(n: tuple[str, str]) -> Column:
        draw = F.xxhash64(F.lit(turn), *map(F.col, n))
        return F.struct(F.lit(0) if turn % 2 else _trailing_zeros(F.col(n[1])), draw, F.col(n[0]), F.col(n[1]))

    return rank(a) < rank(b)


def subtree_totals(forest: DataFrame, totals: list[str], label: str = "tree", max_rounds: int = 400) -> DataFrame:
    """``forest``: (a, b) unique node ids, (pa, pb) their parent's (null for a
    root), numbers ``totals``; b is a node's depth or any number of it.  Returns
    (a, b, totals), each summed over the node's subtree."""
    ids, up = ["a", "b"], ["pa", "pb"]
    kids = forest.filter("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("kids"), F.bit_xor("a").alias("ka"), F.bit_xor("b").alias("kb"))
    zero = F.lit(0).cast("long")
    active = forest.select(*ids, *up, *totals).join(kids, ids, "left").select(*ids, *up, *totals, *(F.coalesce(c, zero).alias(c) for c in ("kids", "ka", "kb")))
    written = []
    for turn in range(max_rounds):
        gone = active.filter("kids = 0 AND pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.count("*").alias("dk"), F.bit_xor("a").alias("da"), F.bit_xor("b").alias("db"), *(F.sum(t).alias(f"d{t}") for t in totals))
        raked = active.join(gone, ids, "left").select(
            *ids, *up, *((F.col(t) + F.coalesce(f"d{t}", zero)).alias(t) for t in totals), F.expr("kids = 0 AND pa IS NOT NULL").alias("leaf"), (F.col("kids") - F.coalesce("dk", zero)).alias("kids"),
            F.col("ka").bitwiseXOR(F.coalesce("da", zero)).alias("ka"), F.col("kb").bitwiseXOR(F.coalesce("db", zero)).alias("kb"))
        chained = ~F.col("leaf") & F.col("pa").isNotNull() & (F.col("kids") == 1)
        picks = F.when(chained, _sooner(("a", "b"), ("pa", "pb"), turn) & _sooner(("a", "b"), ("ka", "kb"), turn)).otherwise(False)
        now = materialize(raked.withColumn("out", picks), f"{label}-round")
        written.append(now)
        if now.filter("pa IS NOT NULL AND NOT leaf").isEmpty():
            break
        out = now.filter("out")
        above = out.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.bit_xor(F.col("a").bitwiseXOR(F.col("ka"))).alias("da"), F.bit_xor(F.col("b").bitwiseXOR(F.col("kb"))).alias("db"), *(F.sum(t).alias(f"d{t}") for t in totals))
        below = out.select(F.col("ka").alias("a"), F.col("kb").alias("b"), F.col("pa").alias("na"), F.col("pb").alias("nb"))
        active = now.filter("NOT leaf AND NOT out").join(above, ids, "left").join(below, ids, "left").select(
            *ids, F.coalesce("na", "pa").alias("pa"), F.coalesce("nb", "pb").alias("pb"), *((F.col(t) + F.coalesce(f"d{t}", zero)).alias(t) for t in totals), "kids",
            F.col("ka").bitwiseXOR(F.coalesce("da", zero)).alias("ka"), F.col("kb").bitwiseXOR(F.coalesce("db", zero)).alias("kb"))
    else:
        raise RuntimeError(f"the forest was not contracted in {max_rounds} rounds")
    done = written.pop().select(*ids, *totals)
    for now in reversed(written):
        below = done.select(F.col("a").alias("ka"), F.col("b").alias("kb"), *(F.col(t).alias(f"d{t}") for t in totals))
        again = now.filter("out").join(below, ["ka", "kb"]).select(*ids, *((F.col(t) + F.col(f"d{t}")).alias(t) for t in totals))
        done = materialize(done.union(again).union(now.filter("leaf").select(*ids, *totals)), f"{label}-totals")
    return done


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations: one row per node with conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    convs, turns = rebuilt_turns(conversations)
    members = materialize(prefixes(turns), "prefixes")
    nodes = materialize(trie(convs, members), "trie")
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    forest = nodes.select(F.col("conv_id").alias("a"), F.col("depth").alias("b"), F.col("parent_conv_id").alias("pa"), F.when(F.col("depth") > 0, F.col("depth") - 1).alias("pb"),
                          F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), saved.alias("saved_tokens"))
    sums = subtree_totals(forest, ["n_leaves", "saved_tokens"], "trie").withColumnsRenamed({"a": "conv_id", "b": "depth"})
    length = members.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("last"))
    none = F.lit(0).cast("long")
    ends = convs.join(length, "conv_id", "left").select(*(F.coalesce(F.col(f"last.{c}"), none).alias(c) for c in ("depth", "k1", "k2")), "conv_id")
    lists = id_lists(ends, ["depth", "k1", "k2"], "depth long, k1 long, k2 long")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    full = nodes.join(sums, ["conv_id", "depth"]).join(lists, ["depth", "k1", "k2"], "left")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha256", empty).alias("ends_sha256"))
