"""Leaf-wise boosting against a booster that looks at every row and every cut."""

import math
import random

import pytest

from kindred.operators import boosting, model
from kindred.operators.boosting import boost
from kindred.session import work_path
from test_plans import plan_of

NAMES = ["flag", "length", "ratio", "gap"]


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, flag int, length int, ratio double, gap double, label int")


def drawn(n, seed=1, missing=0.3):
    """Rows whose label depends on several features, and on whether one is missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        flag, length, ratio = rng.randrange(2), rng.randrange(12), rng.randrange(40) / 40
        gap = None if rng.random() < missing else rng.randrange(20) / 4
        odds = flag + 0.3 * length - 3 * ratio + (2.5 if gap is None else 0.4 * gap - 1) - 1.2
        rows.append((i, flag, length, ratio, gap, int(rng.random() < 1 / (1 + math.exp(-odds)))))
    return rows


def brute_boost(rows, rounds, rate, leaves, min_leaf, l2):
    """Trees as nested ``(feature, cut, missing_left, left, right)`` or leaf values, and all scores."""
    xs, ys = [r[1:-1] for r in rows], [r[-1] for r in rows]
    base = math.log(sum(ys) / (len(ys) - sum(ys)))
    margins, trees = [base] * len(rows), []

    def sums(members, g, h):
        return sum(g[i] for i in members), sum(h[i] for i in members)

    def best(members, g, h):
        gt, ht = sums(members, g, h)
        options = []
        for f in range(len(NAMES)):
            every = sorted({x[f] for x in xs if x[f] is not None})
            lost = [i for i in members if xs[i][f] is None]
            cuts = [a + (b - a) / 2 for a, b in zip(every, every[1:])]
            for missing_left in (False, True) if lost else (False,):
                for cut in cuts + ([math.inf] if lost and not missing_left else []):
                    left = [i for i in members if (missing_left if xs[i][f] is None else xs[i][f] < cut)]
                    right = [i for i in members if not (missing_left if xs[i][f] is None else xs[i][f] < cut)]
                    if min(len(left), len(right)) < min_leaf:
                        continue
                    (gl, hl), (gr, hr) = sums(left, g, h), sums(right, g, h)
                    if min(hl, hr) < 1e-3:
                        continue
                    gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - gt**2 / (ht + l2)
                    way = missing_left if lost else len(left) > len(right)
                    if gain > 0:
                        options.append((gain, f, cut, way, left, right))
        if not options:
            return None
        most = max(o[0] for o in options)
        return next(o for o in options if o[0] >= most * (1 - 1e-9))

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g, h = [a - y for a, y in zip(p, ys)], [a * (1 - a) for a in p]
        root = {"members": list(range(len(rows))), "path": ""}
        root["best"] = best(root["members"], g, h)
        open_leaves, count = [root], 1
        while count < leaves:
            able = [n for n in open_leaves if n["best"]]
            if not able:
                break
            node = min(able, key=lambda n: (-float(f"{n['best'][0]:.9e}"), n["path"]))
            open_leaves.remove(node)
            for side, members in zip("01", node["best"][4:]):
                child = {"members": members, "path": node["path"] + side}
                child["best"] = best(members, g, h) if len(members) >= 2 * min_leaf else None
                node[side] = child
                open_leaves.append(child)
            count += 1
        if "0" not in root:
            break

        def shape(node):
            if "0" in node:
                _, f, cut, way, *_ = node["best"]
                return (f, cut, way, shape(node["0"]), shape(node["1"]))
            gs, hs = sums(node["members"], g, h)
            value = -rate * gs / (hs + l2)
            for i in node["members"]:
                margins[i] += value
            return value

        trees.append(shape(root))
    return trees, [1 / (1 + math.exp(-m)) for m in margins]


def shape_of(forest, nodes, at=0):
    node = nodes[at]
    if node.feature < 0:
        return node.value
    cuts = forest.edges[node.feature]
    cut = cuts[node.bin] if node.bin < len(cuts) else math.inf
    return (node.feature, cut, node.missing_left, shape_of(forest, nodes, node.left), shape_of(forest, nodes, node.right))


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:3] == b[:3] and same(a[3], b[3]) and same(a[4], b[4])
    return a == pytest.approx(b, rel=1e-9, abs=1e-12)


OPTIONS = {"rounds": 4, "leaves": 7, "min_leaf": 12, "learning_rate": 0.3, "l2": 1.0}


@pytest.fixture(scope="module")
def rows():
    return drawn(500)


@pytest.fixture(scope="module")
def brute(rows):
    return brute_boost(rows, OPTIONS["rounds"], OPTIONS["learning_rate"], OPTIONS["leaves"], OPTIONS["min_leaf"], OPTIONS["l2"])


@pytest.mark.parametrize("per_block", [10**6, 60, 7])
def test_trees_and_scores_equal_brute_force(spark, rows, brute, per_block, monkeypatch):
    """In one block, in several, and in more than the driver adds up itself."""
    monkeypatch.setattr(boosting, "ROWS_PER_BLOCK", per_block)
    monkeypatch.setattr(boosting, "KEEP_EVERY", 2)
    trees, scores = brute
    forest = boost(table(spark, rows), NAMES, **OPTIONS)
    assert len(forest.trees) == len(trees) and any(isinstance(t, tuple) for t in trees)
    for nodes, expected in zip(forest.trees, trees):
        assert same(shape_of(forest, nodes), expected)
    scored = {r.id: r.probability for r in model.score_pairs(forest, table(spark, rows)).collect()}
    assert [scored[r[0]] for r in rows] == pytest.approx(scores, rel=1e-9)
    directions = {n.missing_left for nodes in forest.trees for n in nodes if n.feature == 3}
    assert directions == {True, False}


def test_filling_and_routing_differ(spark):
    """Missing values that go with the large ones: a fill below all others cannot say so in one split."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        gap = rng.choice([None, 1.0, 2.0, 3.0, 4.0])
        rows.append((i, 0, 0, 0.0, gap, int(gap is None or gap > 2) if rng.random() < 0.9 else 0))
    options = OPTIONS | {"rounds": 1, "leaves": 2}
    forest = boost(table(spark, rows), NAMES, **options)
    filled = boost(table(spark, [(*r[:4], -1.0 if r[4] is None else r[4], r[5]) for r in rows]), NAMES, **options)
    root = forest.trees[0][0]
    assert (root.feature, root.missing_left) == (3, False) and forest.edges[3][root.bin] == 2.5
    by_id = lambda f, t: {r.id: r.probability for r in model.score_pairs(f, t).collect()}
    routed, plain = by_id(forest, table(spark, rows)), by_id(filled, table(spark, rows).fillna({"gap": -1.0}))
    assert any(abs(routed[r[0]] - plain[r[0]]) > 0.1 for r in rows if r[4] is None)
    _, scores = brute_boost(rows, 1, options["learning_rate"], 2, options["min_leaf"], 1.0)
    assert [routed[r[0]] for r in rows] == pytest.approx(scores)


def test_missing_values_first_seen_at_scoring_go_with_the_larger_side(spark):
    rows = [(i, int(i % 4 == 0), 0, 0.0, 1.0, int(i % 4 == 0)) for i in range(200)]
    forest = boost(table(spark, rows), NAMES, **OPTIONS | {"rounds": 1, "leaves": 2})
    unseen = model.score_pairs(forest, table(spark, [(0, None, 0, 0.0, 1.0, 0), (1, 0, 0, 0.0, 1.0, 0)])).collect()
    assert unseen[0].probability == unseen[1].probability < 0.5


def test_many_values_are_cut_at_quantiles(spark):
    rng = random.Random(3)
    rows = [(i, 0, 0, x := rng.random(), None, int(x > 0.6)) for i in range(3000)]
    forest = boost(table(spark, rows), NAMES, bins=16, **OPTIONS)
    assert 8 <= len(forest.edges[2]) < 16 and forest.edges[3] == []
    wrong = [r for r in model.score_pairs(forest, table(spark, rows)).collect() if (r.probability > 0.5) != (r.label == 1)]
    assert len(wrong) < 3000 / 16


def test_boosting_stops_when_held_out_rows_gain_no_more(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(2), rng.randrange(12), rng.random(), None, rng.randrange(2)) for i in range(800)]
    options = OPTIONS | {"rounds": 60}
    assert len(boost(table(spark, rows), NAMES, stop_early=True, **options).trees) < 40
    assert len(boost(table(spark, rows), NAMES, stop_early=False, **options).trees) == 60


def test_nothing_to_learn(spark):
    for rows, expected in (([], 0.5), (drawn(0), 0.5), ([(i, 0, 0, 0.0, None, 1) for i in range(9)], 1.0)):
        forest = boost(table(spark, rows), NAMES, **OPTIONS)
        assert forest.trees == []
        scored = model.score_pairs(forest, table(spark, drawn(2))).collect()
        assert all(r.probability == pytest.approx(expected, abs=1e-9) for r in scored)


def test_scores_need_no_python_worker_and_no_join(spark, rows):
    forest = boost(table(spark, rows), NAMES, **OPTIONS)
    plan = plan_of(model.score_pairs(forest, table(spark, rows)))
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_all_rounds_take_few_stages(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("boost", "boost")
    try:
        boost(table(spark, rows), NAMES, **OPTIONS | {"rounds": 150})
        jobs = tracker.getJobIdsForGroup("boost")
        assert sum(len(tracker.getJobInfo(j).stageIds) for j in jobs if tracker.getJobInfo(j)) < 60
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_save_that_breaks_off_leaves_the_old_model(spark, rows, monkeypatch):
    forest = boost(table(spark, rows), NAMES, **OPTIONS | {"rounds": 2})
    path = work_path(spark, "matcher")
    first = model.Matcher(forest, 0.7)
    model.save_matcher(first, path)
    other = boost(table(spark, rows), NAMES, **OPTIONS | {"rounds": 1})
    written = model._versions

    def broken(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(model, "_versions", broken)  # after the nodes, before the manifest
    with pytest.raises(KeyboardInterrupt):
        model.save_matcher(model.Matcher(other, 0.9), path)
    monkeypatch.setattr(model, "_versions", written)
    assert model.load_matcher(spark, path) == first
    model.save_matcher(model.Matcher(other, 0.9), path)
    assert model.load_matcher(spark, path) == model.Matcher(other, 0.9)
    with pytest.raises(Exception):
        model.load_matcher(spark, work_path(spark, "nowhere"))
