"""Embedding near-dedup by NN-descent.

Equal vectors are one node with a weight.  A neighbour graph starts from
random-projection orders (neighbours within short runs of each order) and is
refined by neighbours-of-neighbours joins: around every node, its neighbours in
either direction are compared with each other and the better ones enter the
lists, until few list entries change.  The number of orders grows with the bits
of their sign codes, so that a pair at the threshold shares its code in
``orders`` of them on average, however many nodes there are.  Comparisons in
this phase use half-precision copies of the vectors; nothing is decided by them.

Lists have ``k`` entries; a list whose last entry is still a link is saturated
and is enlarged: nodes join the group of their smallest neighbour, or of
a neighbour's neighbour that is near enough and smaller still, saturated
groups are compared with the groups two steps away that are near enough to hold
a link, and groups are compared in full, block against block, in double
precision.  Blocks give counts and a spanning forest of their links, never
pairs, so a group of near copies costs one row per member and block pair.

Nodes are drawn and compared with all others by brute force to measure recall,
until enough of them have links or ``AUDIT_MOST`` are drawn.  Recall is the mean
over nodes of the share of their linked nodes that was found, taken apart for
nodes with few links and with many; the lower mean counts.  Below ``recall``, or
where no drawn node has a link though not all nodes were drawn, the search is
repeated with twice the orders; below 0.9 after that it fails, and a recall that
could not be measured is warned of.

Defined results: null or empty vectors, and vectors with null or non-finite
components or of length zero, link with nothing; vectors of different
dimension never link; repeated rows are copies that link with one another; a
null vec_id is kept and names no component unless all its members' are null;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, materialize, ship

#: nodes in the first draw that recall is measured on, at most in all, and nodes
#: with few links that are enough
AUDIT_NODES, AUDIT_MOST, AUDIT_ENOUGH = 1024, 8192, 256


@dataclass(frozen=True)
class DescentSpec:
    threshold: float = 0.95
    k: int = 10
    #: orders in which a pair at the threshold shares its code, on average
    orders: int = 10
    run: int = 64
    #: at most so many rounds; none: as many as ``change`` asks for
    rounds: int | None = None
    lead_rounds: int = 2
    #: share of list entries that must change for another round
    change: float = 0.02
    #: candidates a node may gain around one neighbour
    gain: int = 4
    block: int = 256
    recall: float = 0.98
    seed: int = 3


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def _half(column: pa.Array, dim: int) -> np.ndarray:
    """Half-precision vectors stored as binary, in single precision."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, dim).astype(np.float32)


def nodes_of(vectors: DataFrame) -> DataFrame:
    """node, low (smallest vec_id), weight, dim, embedding, vec (unit, double)."""
    v = vectors.select("vec_id", "embedding").filter(_usable(F.col("embedding")))
    v = v.groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"))
    top = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    v = v.withColumn("dim", F.size("embedding")).withColumn("scaled", F.transform("embedding", lambda x: x.cast("double") / top))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    return v.withColumn("norm", norm).select(F.monotonically_increasing_id().alias("node"), "low", "weight", "dim", "embedding", F.transform("scaled", lambda x: x / F.col("norm")).alias("vec"))


def _padded(nodes: DataFrame, dim: int) -> DataFrame:
    short = F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vec")))
    return nodes.select("node", "weight", "dim", F.when(F.size("vec") == dim, F.col("vec")).otherwise(short).alias("vec"))


def _bits(n: int, spec: DescentSpec) -> int:
    return max(1, int(np.log2(max(2, n / spec.run))))


def order_count(n: int, spec: DescentSpec, attempt: int = 0) -> int:
    """Orders of ``n`` nodes: a plane parts a pair at the threshold with chance
    angle / pi, so a pair shares the whole code more rarely the more bits it has."""
    same = 1 - float(np.arccos(np.clip(spec.threshold, 0, 1))) / np.pi
    return int(np.ceil((spec.orders << attempt) / same ** _bits(n, spec)))


def projection_neighbours(nodes: DataFrame, dim: int, n: int, spec: DescentSpec, seed: int, orders: int) -> DataFrame:
    """(node, other, sim): the best ``k`` within a run of each random order."""
    bits = _bits(n, spec)
    planes = np.random.default_rng([spec.seed, seed]).normal(size=(orders, dim, bits + 1)).astype(np.float32)
    ship()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("vec"), dim).astype(np.float32)
            half = [r.tobytes() for r in x.astype(np.float16)]
            for t in range(orders):
                y = x @ planes[t]
                code = ((y[:, :bits] > 0) << np.arange(bits)).sum(1)
                yield pa.RecordBatch.from_pydict({"tree": np.full(len(x), t, np.int32), "code": code.astype(np.int64), "at": y[:, bits].astype(np.float64), "node": b.column("node"), "dim": b.column("dim"), "half": pa.array(half, pa.binary())})

    rows = nodes.mapInArrow(project, "tree int, code long, at double, node long, dim int, half binary")
    rows = rows.repartitionByRange("tree", "dim", "code", "at").sortWithinPartitions("tree", "dim", "code", "at", "node")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t = t.combine_chunks()
            node, dims = np.asarray(t.column("node")), np.asarray(t.column("dim"))
            x = _half(t.column("half").combine_chunks() if isinstance(t.column("half"), pa.ChunkedArray) else t.column("half"), dim)
            keep = min(spec.k, spec.run - 1)
            out = ([], [], [])
            for i in range(0, len(node), spec.run):
                j = min(len(node), max(i + spec.run, 0))
                lo = max(0, j - spec.run)  # the last run of a stretch is filled from before
                s = x[i:j] @ x[lo:j].T
                s[node[i:j, None] == node[None, lo:j]] = -2
                s[dims[i:j, None] != dims[None, lo:j]] = -2
                best = np.argsort(-s, axis=1)[:, :keep]
                sim = np.take_along_axis(s, best, 1)
                ok = sim > -1.5
                out[0].append(np.repeat(node[i:j], best.shape[1])[ok.ravel()])
                out[1].append(node[lo:j][best].ravel()[ok.ravel()])
                out[2].append(sim.ravel()[ok.ravel()])
            if out[0]:
                yield pa.RecordBatch.from_pydict({"node": np.concatenate(out[0]), "other": np.concatenate(out[1]), "sim": np.concatenate(out[2]).astype(np.float32)})

        rows_held = 0
        for b in batches:
            held.append(b)
            rows_held += b.num_rows
            if rows_held >= 64 * spec.run:
                t = pa.Table.from_batches(held)
                whole = rows_held // spec.run * spec.run
                yield from compare(t.slice(0, whole))
                held = t.slice(whole).to_batches()
                rows_held -= whole
        if rows_held:
            yield from compare(pa.Table.from_batches(held))

    return rows.mapInArrow(runs, "node long, other long, sim float")


def best_lists(edges: DataFrame, k: int) -> DataFrame:
    """(node, list): the ``k`` best distinct neighbours, best first."""
    one = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    entry = F.struct("sim", "other", F.col("fresh"))
    return one.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(entry), asc=False), 1, k).alias("list"))


def refine(nodes: DataFrame, graph: DataFrame, dim: int, spec: DescentSpec) -> DataFrame:
    """One neighbours-of-neighbours join: new candidates (node, other, sim)."""
    ship()
    kth = graph.select("node", F.when(F.size("list") >= spec.k, F.element_at("list", -1)["sim"]).otherwise(F.lit(-2.0)).cast("float").alias("kth"))
    flat = graph.select("node", F.explode("list").alias("e")).select("node", F.col("e.other").alias("other"), F.col("e.fresh").alias("fresh"))
    around = flat.select(F.col("node").alias("pivot"), F.col("other").alias("member"), "fresh").union(flat.select(F.col("other").alias("pivot"), F.col("node").alias("member"), "fresh"))
    around = around.groupBy("pivot", "member").agg(F.max("fresh").alias("fresh"))

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("vec"), dim).astype(np.float16)
            yield pa.RecordBatch.from_pydict({"member": b.column("node"), "dim": b.column("dim"), "kth": b.column("kth"), "half": pa.array([r.tobytes() for r in x], pa.binary())})

    known = nodes.select("node", "dim", "vec").join(kth, "node").mapInArrow(halves, "member long, dim int, kth float, half binary")
    rows = around.join(known, "member").repartition("pivot").sortWithinPartitions("pivot", "fresh", "member")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.Table | None = None

        def compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t = t.combine_chunks()
            pivot, member, fresh = (np.asarray(t.column(c)) for c in ("pivot", "member", "fresh"))
            dims, kth_ = np.asarray(t.column("dim")), np.asarray(t.column("kth"))
            x = _half(t.column("half").combine_chunks(), dim)
            cuts = [0, *(np.flatnonzero(np.diff(pivot)) + 1), len(pivot)]
            out: tuple[list, list, list] = ([], [], [])
            for a, b in zip(cuts, cuts[1:]):
                if not fresh[a:b].any():
                    continue
                for i in range(a, b, 2 * spec.run):  # a hub's neighbours meet in runs
                    j = min(b, i + 2 * spec.run)
                    if j - i < 2:
                        continue
                    s = x[i:j] @ x[i:j].T
                    f = fresh[i:j]
                    s[~(f[:, None] | f[None, :]) | (dims[i:j, None] != dims[None, i:j])] = -2
                    np.fill_diagonal(s, -2)
                    m = min(spec.gain, j - i - 1)
                    best = np.argpartition(-s, m - 1, axis=1)[:, :m]
                    sim = np.take_along_axis(s, best, 1)
                    ok = (sim > kth_[i:j, None]).ravel()
                    if ok.any():
                        out[0].append(np.repeat(member[i:j], m)[ok])
                        out[1].append(member[i:j][best].ravel()[ok])
                        out[2].append(sim.ravel()[ok])
            if out[0]:
                yield pa.RecordBatch.from_pydict({"node": np.concatenate(out[0]), "other": np.concatenate(out[1]), "sim": np.concatenate(out[2]).astype(np.float32)})

        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([left, t]) if left is not None else t
            pivot = np.asarray(t.column("pivot").combine_chunks())
            cut = int(np.searchsorted(pivot, pivot[-1], "left"))
            if cut == 0 and len(pivot) > 50_000:
                cut = len(pivot) // (2 * spec.run) * 2 * spec.run  # a hub is taken in pieces
            if cut:
                yield from compare(t.slice(0, cut))
            left = t.slice(cut)
        if left is not None and left.num_rows:
            yield from compare(left)

    return rows.mapInArrow(join, "node long, other long, sim float")


def neighbour_graph(nodes: DataFrame, dim: int, n: int, spec: DescentSpec, seed: int, orders: int, known: DataFrame | None = None) -> DataFrame:
    """(node, list of (sim, other, fresh)) after descent."""
    start = projection_neighbours(nodes, dim, n, spec, seed, orders).withColumn("fresh", F.lit(True))
    if known is not None:
        start = start.union(known.select("node", F.explode("list").alias("e")).select("node", "e.other", "e.sim", F.lit(False)))
    graph = materialize(best_lists(start, spec.k), "descent-graph")
    for _ in itertools.count() if spec.rounds is None else range(spec.rounds):  # lists only get better, so this ends
        new = refine(nodes, graph, dim, spec).withColumn("fresh", F.lit(True))
        old = graph.select("node", F.explode("list").alias("e")).select("node", "e.other", "e.sim", F.lit(False).alias("fresh"))
        nxt = materialize(best_lists(old.unionByName(new), spec.k), "descent-graph")
        changed = nxt.agg(F.avg(F.size(F.filter("list", lambda e: e["fresh"])) / F.size("list"))).first()[0] or 0.0
        graph = nxt
        if changed < spec.change:
            break
    return graph


def exact_links(nodes: DataFrame, graph: DataFrame, dim: int, spec: DescentSpec) -> DataFrame:
    """(node, links, others, rep) rows: summed over a node's rows, ``links`` is
    the weight of the other nodes linked with it and ``others`` their number;
    (node, rep) edges connect exactly what links connect."""
    ship()
    near = spec.threshold - 0.005  # the graph's half-precision similarities
    strong = graph.select("node", F.explode("list").alias("e")).filter(F.col("e.sim") >= near).select("node", F.col("e.other").alias("other"))
    strong = strong.union(strong.select("other", "node"))
    lead = materialize(strong.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("lead")), "descent-leads")
    vectors = nodes.select("node", "dim", "vec")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    for _ in range(spec.lead_rounds):  # a neighbour's leader that is near enough and smaller: dense groups end up with few leaders
        offer = strong.join(lead.withColumnRenamed("node", "other"), "other").select("node", F.col("lead").alias("offer")).distinct()
        offer = offer.join(lead, "node").filter("offer < lead").select("node", "offer")
        known = offer.join(vectors, "node").join(vectors.select(F.col("node").alias("offer"), F.col("dim").alias("odim"), F.col("vec").alias("ovec")), "offer")
        taken = known.filter((F.col("dim") == F.col("odim")) & (dot("vec", "ovec") >= near)).groupBy("node").agg(F.min("offer").alias("m"))
        lead = materialize(lead.join(taken, "node", "left").select("node", F.coalesce("m", "lead").alias("lead")), "descent-leads")
    full = graph.filter((F.size("list") >= spec.k) & (F.element_at("list", -1)["sim"] >= near)).select("node")
    saturated = lead.join(full, "node", "left_semi").select("lead").distinct()
    a, b = lead.select("node", F.col("lead").alias("a")), lead.select(F.col("node").alias("other"), F.col("lead").alias("b"))
    pairs = strong.join(a, "node").join(b, "other").select("a", "b").union(lead.select(F.col("lead").alias("a"), F.col("lead").alias("b"))).distinct()
    pairs = materialize(pairs, "descent-leadpairs")
    # two steps from a saturated group, as far as a link is possible: members and link are each within the threshold's angle
    reach = float(np.cos(min(np.pi, 3 * np.arccos(near))))
    step = pairs.join(saturated.withColumnRenamed("lead", "a"), "a", "left_semi")
    two = step.join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")).distinct()
    va, vb = nodes.select(F.col("node").alias("a"), F.col("vec").alias("va")), nodes.select(F.col("node").alias("b"), F.col("vec").alias("vb"))
    two = two.join(va, "a").join(vb, "b").filter(dot("va", "vb") >= reach).select("a", "b")
    pairs = pairs.union(two).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    count = lead.groupBy("lead").agg(F.ceil(F.count("*") / spec.block).cast("int").alias("blocks"))
    member = nodes.join(lead, "node").join(count, "lead").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    blocks = member.groupBy("lead", "blk").agg(F.collect_list(F.struct("node", "weight", "dim", "vec")).alias("rows"))
    blocks = materialize(blocks, "descent-blocks")
    names = blocks.select("lead", "blk")
    tasks = pairs.join(names.select(F.col("lead").alias("a"), F.col("blk").alias("ablk")), "a").join(names.select(F.col("lead").alias("b"), F.col("blk").alias("bblk")), "b")
    tasks = tasks.filter((F.col("a") < F.col("b")) | (F.col("ablk") <= F.col("bblk")))
    work = tasks.join(blocks.select(F.col("lead").alias("a"), F.col("blk").alias("ablk"), F.col("rows").alias("arows")), ["a", "ablk"])
    work = work.join(blocks.select(F.col("lead").alias("b"), F.col("blk").alias("bblk"), F.col("rows").alias("brows")), ["b", "bblk"])
    same = (F.col("a") == F.col("b")) & (F.col("ablk") == F.col("bblk"))
    work = work.select(same.alias("same"), "arows", "brows")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(v: pa.ListScalar):
            s = v.values
            return np.asarray(s.field("node")), np.asarray(s.field("weight")), np.asarray(s.field("dim")), _matrix(s.field("vec"), dim)

        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for same_, left, right in zip(batch.column("same").to_pylist(), batch.column("arows"), batch.column("brows")):
                na, wa, da, xa = rows(left)
                nb, wb, db, xb = (na, wa, da, xa) if same_ else rows(right)
                hit = (xa @ xb.T >= spec.threshold) & (da[:, None] == db[None, :])
                if same_:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                ids = na if same_ else np.concatenate([na, nb])
                links = hit @ wb if same_ else np.concatenate([hit @ wb, wa @ hit])
                root = ids.copy()  # smallest node reached within this pair of blocks
                while True:
                    ra = root[:len(na)]
                    rb = ra if same_ else root[len(na):]
                    to_a = np.minimum(ra, np.where(hit, rb[None, :], np.iinfo(np.int64).max).min(1))
                    if same_:
                        new = to_a
                    else:
                        new = np.concatenate([to_a, np.minimum(rb, np.where(hit, to_a[:, None], np.iinfo(np.int64).max).min(0))])
                    if (new == root).all():
                        break
                    root = new
                on = links > 0
                out[0].append(ids[on])
                out[1].append(links[on])
                out[2].append((hit.sum(1) if same_ else np.concatenate([hit.sum(1), hit.sum(0)]))[on])
                out[3].append(root[on])
            if out[0]:
                yield pa.RecordBatch.from_pydict({"node": np.concatenate(out[0]), "links": np.concatenate(out[1]).astype(np.int64), "others": np.concatenate(out[2]).astype(np.int64), "rep": np.concatenate(out[3])})

    return work.mapInArrow(compare, "node long, links long, others long, rep long")


@dataclass(frozen=True)
class Audit:
    """Nodes asked, and per class (few links: under ``k``; many) the asked nodes
    that have links and the mean share found of their linked nodes."""

    asked: int
    whole: bool
    few: int
    few_found: float | None
    many: int
    many_found: float | None

    @property
    def recall(self) -> float | None:
        """The lower class's mean; None: no asked node has a link and not all were asked."""
        means = [x for x in (self.few_found, self.many_found) if x is not None]
        return min(means) if means else 1.0 if self.whole else None


def _true_links(nodes: DataFrame, draw: Column, low: float, high: float, dim: int, spec: DescentSpec) -> tuple[int, DataFrame]:
    """The nodes drawn in [low, high), counted, and (node, true): their linked
    nodes by brute force, for those that have any."""
    asked = nodes.filter((draw >= low) & (draw < high)).select("node", "dim", "vec").toArrow().combine_chunks()  # a bounded number
    qid, qdim = np.asarray(asked.column("node")), np.asarray(asked.column("dim"))
    q = _matrix(pa.concat_arrays(asked.column("vec").chunks), dim) if len(qid) else np.zeros((0, dim))
    ship()

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(q), np.int64)
        for b in batches:
            node, dims, x = np.asarray(b.column("node")), np.asarray(b.column("dim")), _matrix(b.column("vec"), dim)
            for i in range(0, len(node), 2048):
                for j in range(0, len(q), 1024):
                    row, col = np.nonzero(x[i:i + 2048] @ q[j:j + 1024].T >= spec.threshold)
                    ok = (dims[i + row] == qdim[j + col]) & (node[i + row] != qid[j + col])
                    total += np.bincount(j + col[ok], minlength=len(q))
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"node": qid[on], "true": total[on]})

    return len(qid), nodes.mapInArrow(brute, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))


def audit(nodes: DataFrame, found: DataFrame, dim: int, n: int, spec: DescentSpec) -> Audit:
    """What was found of the links of drawn nodes, known by brute force."""
    draw = F.pmod(F.xxhash64(F.lit(spec.seed), "node"), F.lit(1 << 40)) / float(1 << 40)
    asked, low, most = 0, 0.0, AUDIT_NODES
    count, total = {True: 0, False: 0}, {True: 0.0, False: 0.0}
    while True:
        high = min(1.0, most / max(1, n))
        drawn, true = _true_links(nodes, draw, low, high, dim, spec)
        got = found.groupBy("node").agg(F.sum("others").alias("got"))
        share = F.least("true", F.coalesce("got", F.lit(0))) / F.col("true")
        for r in true.join(got, "node", "left").groupBy((F.col("true") < spec.k).alias("few")).agg(F.count("*").alias("n"), F.sum(share).alias("s")).collect():
            count[r["few"]] += r["n"]
            total[r["few"]] += r["s"]
        asked, low, most = asked + drawn, high, 2 * most
        if high >= 1.0 or count[True] >= AUDIT_ENOUGH or most > AUDIT_MOST:
            break
    mean = {c: total[c] / count[c] if count[c] else None for c in count}
    return Audit(asked, high >= 1.0, count[True], mean[True], count[False], mean[False])


def near_duplicate_vectors(vectors: DataFrame, spec: DescentSpec = DescentSpec()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = vectors.select("vec_id", "embedding")
    all_nodes = materialize(nodes_of(rows), "descent-nodes")
    size = all_nodes.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    n, dim = size["n"], size["dim"] or 1
    nodes = materialize(_padded(all_nodes, dim), "descent-vectors")
    graph, found, seen = None, None, None
    for attempt in range(3 if n > 1 else 0):
        graph = neighbour_graph(nodes, dim, n, spec, attempt, order_count(n, spec, attempt), graph)
        found = materialize(exact_links(nodes, graph, dim, spec), "descent-links")
        seen = audit(nodes, found, dim, n, spec)
        if seen.recall is not None and seen.recall >= spec.recall:
            break
    if seen is not None and seen.recall is None:
        warnings.warn(f"recall of the neighbour graph is not measured: none of {seen.asked} drawn nodes has a link")
    elif seen is not None and seen.recall < 0.9:
        raise RuntimeError(f"recall of the neighbour graph is {seen.recall:.3f} after three attempts: {seen}")
    if found is None:
        found = all_nodes.sparkSession.createDataFrame([], "node long, links long, others long, rep long")
    comp = components(found.select(F.col("node").alias("a"), F.col("rep").alias("b")), "descent")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    own = all_nodes.select("node", "low", "weight", "embedding").join(links, "node", "left").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = own.groupBy("root").agg(F.min("low").alias("component_id"))
    own = own.join(low, "root").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id", F.lit(True).alias("linked"))
    out = rows.join(own, "embedding", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
