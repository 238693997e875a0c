"""Training and prediction from files to files."""

import math
import random

import pytest

from kindred.operators import labels, model, quality
from kindred.plans import linkage
from kindred.schemas import FEATURES
from kindred.session import stage, work_path
from kindred.sources import files


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Source files in which S2 and S3 hold noisy copies of most S1 records."""
    rng = random.Random(5)
    folder = tmp_path_factory.mktemp("data")
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    tables = {1: [header], 2: [header], 3: [header]}
    truth = ["source1_entity_id\tmatched_entity_ids\n"]
    for i in range(300):
        name = " ".join(rng.sample(words, 3))
        address = f"{rng.randrange(90)} {rng.choice(words)} street"
        tables[1].append(f"S1-{i:04}\t{name.title()}\t{address}\tUS\n")
        matched = []
        for s in (2, 3):
            kind = rng.random()
            entity = f"S{s}-{i:04}"
            if kind < 0.6:
                tables[s].append(f"{entity}\t{name} Ltd.\t{address}\tus\n")
                matched.append(entity)
            else:
                other = " ".join(rng.sample(words, 3))
                tables[s].append(f"{entity}\t{other}\t{rng.randrange(90)} {rng.choice(words)} road\tus\n")
        truth.append(f"S1-{i:04}\t{','.join(matched)}\n")
    paths = []
    for s in (1, 2, 3):
        paths.append(str(folder / f"s{s}.tsv"))
        (folder / f"s{s}.tsv").write_text("".join(tables[s]))
    (folder / "truth.tsv").write_text("".join(truth))
    return paths, str(folder / "truth.tsv"), folder


def test_train_predict_and_check(spark, data):
    paths, truth_path, folder = data
    options = {"rounds": 4, "min_leaf": 5, "leaves": 6, "learning_rate": 0.5}
    matcher, sweep = linkage.train_from_files(spark, *paths, truth_path, **options)
    assert sweep.count() == 13

    stored = work_path(spark, "matcher")
    model.save_matcher(matcher, stored)
    loaded = model.load_matcher(spark, stored)
    assert (loaded.threshold, loaded.features) == (matcher.threshold, matcher.features)

    out, candidates = str(folder / "matches"), str(folder / "candidates")
    scored = linkage.predict_to_files(spark, loaded, *paths, out, candidates)
    assert scored.filter("probability < 0 OR probability > 1").count() == 0

    truth = {r[0]: r[1] or "" for r in files.read_truth(spark, truth_path).collect()}
    got = {r[0]: r[1] or "" for r in files.read_truth(spark, out).collect()}
    assert set(got) == set(truth)
    assert sum(got[k] == truth[k] for k in truth) > 0.9 * len(truth)

    s1 = files.read_records(spark, paths[0])
    valid = quality.match_targets(*[files.read_records(spark, p) for p in paths[1:]])
    report = quality.check_files(spark, out, s1, candidates, valid)
    assert report.collect() == []


def test_training_is_repeatable(spark, data):
    paths, truth_path, _ = data
    s1, others = linkage.load_sources(spark, *paths)
    truth = files.read_truth(spark, truth_path)
    rows = stage(linkage.labelled_features(s1, others, truth), "features")
    by_pairs = labels.label_pairs(rows.drop("label"), labels.true_pairs(truth))
    assert rows.filter("label = 1").count() > 100
    assert rows.join(by_pairs, ["source1_entity_id", "candidate_entity_id", "label"]).count() == rows.count()
    fits = [model.fit_model(rows, rounds=2, leaves=4, min_leaf=5) for _ in range(2)]
    scores = [sorted(map(tuple, model.score_pairs(m, rows).collect()), key=str) for m in fits]
    assert scores[0] == scores[1]


def test_scores_equal_the_trees(spark, data):
    """The score by SQL functions against the trees walked one row at a time."""
    paths, truth_path, _ = data
    s1, others = linkage.load_sources(spark, *paths)
    truth = files.read_truth(spark, truth_path)
    rows = stage(linkage.labelled_features(s1, others, truth), "features")
    forest = model.fit_model(rows, rounds=5, leaves=6, min_leaf=5)

    def walked(row):
        margin = forest.base
        for nodes in forest.trees:
            node = nodes[0]
            while node.feature >= 0:
                value, cuts = row[FEATURES[node.feature]], forest.edges[node.feature]
                low = node.missing_left if value is None else sum(float(value) >= c for c in cuts) <= node.bin
                node = nodes[node.left if low else node.right]
            margin += node.value
        return 1 / (1 + math.exp(-margin))

    scored = model.score_pairs(forest, rows).collect()
    assert len({r.probability for r in scored}) > 1
    for r in scored:
        assert r.probability == pytest.approx(walked(r))


def test_link_by_rule(spark, data):
    paths, _, _ = data
    s1, others = linkage.load_sources(spark, *paths)
    got = linkage.link_by_rule(s1, others, threshold=0.4)
    assert got.count() == 300 and got.filter("matched_entity_ids <> ''").count() > 150
