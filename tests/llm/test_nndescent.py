"""Links, counts and components against brute force."""

from collections import Counter

import numpy as np
import pytest

from icdforge.llm import nndescent

KIND = "vec_id long, embedding array<float>"


def brute(rows):
    ok, vecs = [], []
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(np.float32(v), float)
            ok.append(i)
            vecs.append(x / np.abs(x).max())
    near = {i: [] for i in range(len(rows))}
    for i, a in zip(ok, vecs):
        for j, b in zip(ok, vecs):
            if i != j and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= .95:
                near[i].append(j)
    out, seen = {}, {}
    for i in near:
        if i not in seen:
            stack, comp = [i], {i}
            while stack:
                for j in near[stack.pop()]:
                    if j not in comp:
                        comp.add(j)
                        stack.append(j)
            low = min((rows[j][0] for j in comp if rows[j][0] is not None), default=None)
            seen |= dict.fromkeys(comp, low)
        out[i] = (rows[i][0], len(near[i]), seen[i], rows[i][0] is not None and rows[i][0] == seen[i])
    return Counter(out.values())


def run(spark, rows, **spec):
    got = nndescent.near_duplicate_vectors(spark.createDataFrame(rows, KIND), nndescent.DescentSpec(**spec))
    assert got.columns[:4] == ["vec_id", "n_links", "component_id", "kept"]
    return Counter(tuple(r) for r in got.collect())


def test_clusters_saturated_lists_chains_and_copies(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(900, 16))
    vecs = [*base]
    vecs += [base[0] + .05 * rng.normal(size=16) for _ in range(120)]  # lists of ten are saturated
    vecs += [base[i] + .1 * rng.normal(size=16) for i in range(1, 60)]
    a, b = np.linalg.qr(rng.normal(size=(16, 2)))[0].T
    vecs += [np.cos(t) * a + np.sin(t) * b for t in np.arange(0, 2.5, .2)]  # a chain: neighbours link, ends do not
    vecs += [base[5]] * 40 + [3 * base[6]]  # copies, and a multiple
    ids = rng.permutation(len(vecs))
    rows = [(int(i), [float(x) for x in np.float32(v)]) for i, v in zip(ids, vecs)]
    assert run(spark, rows) == brute(rows)


def test_awkward_vectors(spark):
    e = [1.0, 2.0, 3.0]
    rows = [(1, e), (2, e), (2, e), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]),
            (None, e), (None, [5.0, 0.0, 0.0]), (9, [1.0, 2.0]), (10, [1.0, 2.0, 0.0]), (11, [1e30, 2e30, 3e30]), (12, [1e-38, 2e-38, 3e-38]), (13, [-1.0, -2.0, -3.0])]
    got = run(spark, rows)
    want = brute([r for r in rows])
    assert got == want


def test_empty_and_single(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(1, [1.0, 0.0])]) == Counter({(1, 0, 1, True): 1})


@pytest.mark.parametrize("weak", [dict(orders=1, k=4, rounds=2)])
def test_recall_is_audited(spark, weak):
    """A weak start is noticed and repeated with more orders."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(600, 32))
    vecs = [*base, *(base[:200] + .04 * rng.normal(size=(200, 32)))]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vecs)]
    got, want = run(spark, rows, **weak), brute(rows)
    assert sum(r[1] for r in got.elements()) >= .9 * sum(r[1] for r in want.elements())


def grouped(rng, others):
    """A group of 300 near copies beside 700 vectors, of which ``others`` have a near copy each."""
    base = rng.normal(size=(701, 16))
    vecs = [*base[1:], *(base[0] + .02 * rng.normal(size=(300, 16))), *(base[1:1 + others] + .03 * rng.normal(size=(others, 16)))]
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vecs)]


def test_lost_pairs_beside_a_large_group_are_noticed(spark, monkeypatch):
    links = nndescent.exact_links

    def lossy(*args):
        found = nndescent.materialize(links(*args), "test-links")
        large = found.groupBy("node").agg({"links": "sum"}).filter("`sum(links)` > 100").select("node")
        return found.join(large, "node", "left_semi")

    monkeypatch.setattr(nndescent, "exact_links", lossy)
    with pytest.raises(RuntimeError, match="recall"):
        run(spark, grouped(np.random.default_rng(4), 60))


def test_no_link_seen_is_not_full_recall(spark, monkeypatch):
    """Few links and a small draw: the search is repeated and the missing measure told."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.normal(size=(400, 32)))]
    monkeypatch.setattr(nndescent, "AUDIT_NODES", 10)
    monkeypatch.setattr(nndescent, "AUDIT_MOST", 40, raising=False)
    with pytest.warns(UserWarning, match="not measured"):
        assert run(spark, rows, orders=1, k=3) == brute(rows)


def test_orders_grow_with_the_code():
    spec = nndescent.DescentSpec()
    few, many = (nndescent.order_count(n, spec) for n in (1_000, 10_000_000))
    same = 1 - np.arccos(.95) / np.pi
    assert few < many and many * same ** 17 >= spec.orders
    assert spec.rounds is None
