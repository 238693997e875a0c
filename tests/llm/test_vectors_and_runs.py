"""Whitening, nearest neighbours and periodic runs against brute force, and odd inputs."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

import check_oracle
from __spark_entry__ import queries
from kindred.llm import neighbours, runs, whitening

SF_DIR = f"{check_oracle.DATA}/sf0.001"


def vectors(spark, rows, extra=False):
    """A table of ids and vectors; with ``extra``, of further columns with names used inside."""
    schema = "vec_id long, embedding array<float>"
    if extra:
        schema += ", x long, v string, weight string, cell int, id long, key string, block int"
        rows = [(*r, 7, "v", "w", 1, 2, "k", 3) for r in rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def folder(spark, tmp_path):
    def write(**tables):
        for name, table in tables.items():
            table.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def embedded(rng, n, dims):
    return [rng.normal(size=dims).astype(np.float32).tolist() for _ in range(n)]


# --- whitening ----------------------------------------------------------------


def brute_whitened(rows, components=32):
    """``(id, k) -> (deviation, |whitened|, explained)`` and n, from all rows one by one."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept])
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    z = centred @ parts[:, order] / np.sqrt(values[order])
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return kept, n, deviations, np.abs(z), values[order] / values.sum()


def check_whitened(found, rows, components=32):
    kept, n, deviations, z, shares = brute_whitened(rows, components)
    expected = sorted(
        (i, k + 1, n, d, z[r, k], shares[k]) for r, ((i, _), d) in enumerate(zip(kept, deviations)) for k in range(z.shape[1])
    )
    mine = sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in found)
    assert [r[:4] for r in mine] == [r[:4] for r in expected]
    for a, b in zip(mine, expected):
        assert a[4] == pytest.approx(b[4], abs=1e-7) and a[5] == pytest.approx(b[5], rel=1e-8)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-8


def test_op11_on_the_table(spark):
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitened(queries()["op11_embedding_whitening"](spark, SF_DIR).collect(), rows)


def test_whitening_of_copies_and_odd_rows(spark, folder):
    rng = np.random.default_rng(3)
    some = embedded(rng, 60, 5)
    rows = [(i, some[0] if i % 3 == 0 else some[i % 60]) for i in range(200)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [float("nan")] * 5), (303, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (5, some[5])]
    found = queries()["op11_embedding_whitening"](spark, folder(embeddings=vectors(spark, rows, extra=True))).collect()
    check_whitened(found, rows)


def test_signs_are_the_same_for_all_rows(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate(embedded(rng, 100, 4)))
    joined, model, _ = whitening.whitened_rows(vectors(spark, rows))
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float))
    c = x - x.mean(0)
    assert np.allclose([r.whitened for r in joined.orderBy("vec_id").collect()], c @ model.components / np.sqrt(model.values))
    z = np.array([r.whitened for r in joined.collect()])
    assert np.allclose(z.T @ z / 100, np.eye(4), atol=1e-9)


def test_weights_of_one_fit_distinct_vectors(spark):
    rng = np.random.default_rng(5)
    some = embedded(rng, 30, 3)
    rows = [(i, some[0]) for i in range(100)] + [(100 + i, v) for i, v in enumerate(some)]
    joined, model, error = whitening.whitened_rows(vectors(spark, rows), weights=whitening.ONES)
    x = np.floor(64 * np.array(some, np.float32).astype(float))
    assert model.n == 30 and error < 1e-9 and joined.count() == 130
    assert np.allclose(np.sort(model.values), np.linalg.eigvalsh(np.cov(x.T, bias=True)))


def test_whitening_without_variance_or_rows(spark, folder):
    same = [(i, [1.0, 2.0, 3.0]) for i in range(7)]
    found = queries()["op11_embedding_whitening"](spark, folder(embeddings=vectors(spark, same))).collect()
    assert len(found) == 21 and all(r.whitened is None and r.deviation == 0 and r.identity_error is None for r in found)
    for rows in ([], [(1, None)], [(1, [])]):
        joined, model, _ = whitening.whitened_rows(vectors(spark, rows))
        assert joined.count() == 0 and model is None


def test_lengths_and_large_entries(spark):
    rng = np.random.default_rng(6)
    rows = list(enumerate(embedded(rng, 20, 3))) + [(50, [1.0] * 4), (51, [1e30, 0.0, 0.0])]
    joined, model, _ = whitening.whitened_rows(vectors(spark, rows))
    assert model.n == 20 and joined.count() == 20
    far = [(i, [2.0**40 * i, float(i % 3), 1.0]) for i in range(20)]
    joined, model, error = whitening.whitened_rows(vectors(spark, far))
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in far]
    sums = [sum(col) for col in zip(*x)]
    exact = {i: sum((20 * a - s) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}
    assert {r.vec_id: r.deviation for r in joined.collect()} == {i: d if d < 1 << 63 else None for i, d in exact.items()}


# --- nearest neighbours ---------------------------------------------------------


def brute_nearest(rows, asked, k=10):
    valid = {(i, tuple(np.array(v, np.float64))) for i, v in rows if i is not None and v is not None and all(
        c is not None and math.isfinite(c) for c in v) and any(v)}
    out = {}
    for q, own in valid:
        if q in asked:
            near = sorted((math.dist(own, v), i) for i, v in valid if i != q and len(v) == len(own))
            out[q] = near[:k]
    return out


def check_nearest(found, rows, asked, k=10, recall=0.9):
    """Ranks, true distances and order are exact; the share of the nearest that are found is ``recall``."""
    expected, got = brute_nearest(rows, asked, k), {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert set(got) == {q for q, near in expected.items() if near}
    place = {i: v for i, v in rows if v is not None}
    hits = total = 0
    for q, near in expected.items():
        own = got.get(q, [])
        assert [r for r, _, _ in own] == list(range(1, len(near) + 1))
        assert [(s, i) for _, s, i in own] == sorted((s, i) for _, s, i in own)
        for _, score, i in own:
            assert score == pytest.approx(math.dist(place[q], place[i]), rel=1e-12, abs=1e-12) and i != q
        hits += len({i for _, _, i in own} & {i for _, i in near})
        total += len(near)
    assert hits >= recall * total
    return got


def test_op12_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = queries()["op12_nearest_neighbours"](spark, SF_DIR).collect()
    check_nearest(found, rows, {i for i, _ in rows if i % 100 == 0})


def test_neighbours_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 128)
    monkeypatch.setattr(neighbours, "QUERIES", 16)
    monkeypatch.setattr(neighbours, "LEAF", 8)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 24)) * 4
    rows = [(i, (centres[i % 20] + rng.normal(size=24)).astype(np.float32).tolist()) for i in range(2500)]
    asked = vectors(spark, rows[:300:3])
    found = neighbours.nearest(vectors(spark, rows), asked).collect()
    check_nearest(found, rows, {i for i, _ in rows[:300:3]}, recall=0.95)


def test_neighbours_of_copies(spark, folder):
    rng = np.random.default_rng(8)
    some = embedded(rng, 40, 6)
    rows = [(i, some[0] if i % 3 else some[i % 40]) for i in range(900)] + [(900, some[0]), (0, some[0])]
    rows[0] = (0, some[0])
    found = queries()["op12_nearest_neighbours"](spark, folder(embeddings=vectors(spark, rows, extra=True))).collect()
    got = check_nearest(found, rows, {0, 100, 200, 300, 400, 500, 600, 700, 800, 900}, recall=0.97)
    assert [i for _, _, i in got[100]] == [0, 1, 2, 4, 5, 7, 8, 10, 11, 13]  # equal distances: smaller ids


def test_few_rows_and_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [1.0, 1.0, 1.0]), (None, [1.0, 1.0])]
    found = neighbours.nearest(vectors(spark, rows), vectors(spark, rows)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [(0, 1, 1), (1, 1, 0)]
    assert all(r.score == math.sqrt(2) for r in found)
    assert neighbours.nearest(vectors(spark, rows), vectors(spark, [])).count() == 0
    assert neighbours.nearest(vectors(spark, []), vectors(spark, rows)).count() == 0


def test_signed_zeros_are_equal(spark):
    found = neighbours.nearest(vectors(spark, [(0, [0.0, 1.0]), (1, [-0.0, 1.0])]), vectors(spark, [(0, [0.0, 1.0])])).collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 0.0)]


def test_stop_ratio_is_the_quantile():
    rng = np.random.default_rng(9)
    drawn = (rng.normal(size=(200_000, neighbours.DIMS)) ** 2).sum(1)
    assert (drawn < neighbours.stop_ratio(0.9)).mean() == pytest.approx(0.9, abs=0.004)


# --- periodic runs --------------------------------------------------------------


def brute_runs(words):
    """Runs by the definition: maximal stretches of a period, the smallest for each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and (i, length) not in found:
                found[i, length] = q
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rng, n, letters):
    words = [rng.choice(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 4:
            a, p = rng.randrange(n - 1), rng.randrange(1, max(2, n // 4))
            for i in range(a, min(n, a + rng.randrange(3, 8) * p)):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_against_brute_force():
    rng = random.Random(10)
    texts = [periodic(rng, rng.randrange(0, 120), "ab" if k % 3 else "abcdefgh") for k in range(600)]
    found = runs.find_runs([[w.encode() for w in t] for t in texts])
    assert found == [brute_runs(t) for t in texts]
    assert sum(map(len, found)) > 300


@pytest.mark.parametrize("step", [1, 3, 16, 1000])
def test_appending_word_by_word_gives_the_same_runs(step):
    rng = random.Random(11)
    for _ in range(60):
        words = periodic(rng, rng.randrange(1, 150), "abc")
        numbers = np.array([ord(w) for w in words])
        catcher = runs.SquareCatcher()
        for at in range(0, len(words), step):
            catcher.append(numbers[at : at + step])
            if step <= 3:  # online: after every append, the runs of the words so far
                assert list(map(tuple, catcher.runs().tolist())) == brute_runs(words[: at + step])
        assert list(map(tuple, catcher.runs().tolist())) == brute_runs(words)


def test_names_that_collide_are_compared(monkeypatch):
    rng = random.Random(12)
    texts = [[w.encode() for w in periodic(rng, 50, "abcd")] for _ in range(40)]
    expected = [brute_runs(t) for t in texts]
    monkeypatch.setattr(runs, "_numbers", lambda words: np.array([w[0] % 2 for w in words], np.int64))
    assert runs.find_runs(texts) == expected


def planted(words, doc_id):
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + math.floor((n - a) / (3 + g % 8))
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_digest(doc_id, text):
    words = planted((text or "").encode().split(), doc_id)
    found = brute_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
    one = (*best, math.floor(1000 * best[1] / best[2])) if best else (None,) * 4
    return (doc_id, len(found), *one, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_op13_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = queries()["op13_periodic_runs"](spark, SF_DIR).collect()
    short = {r.doc_id: r for r in found}
    assert len(found) == len(docs)
    expected = [brute_digest(*d) for d in docs if len((d.text or "").split()) <= 1500]
    assert len(expected) > 0.9 * len(docs) and [tuple(short[e[0]]) for e in expected] == expected
    assert any(e[1] for e in expected)


def test_runs_of_odd_texts(spark):
    long = " ".join(["tick"] * 30_000)
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "a a a a"), (7, long), (7, long),
        (None, "x y x y x y x y"), (8, "a b a b a b a b a b c c c c c c c"), (9, "A a A a A a A a"),
    ]
    docs = spark.createDataFrame([(*r, 1, "r") for r in rows], "doc_id long, text string, runs int, start string")
    found = {}
    for r in runs.document_runs(docs).collect():
        found.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.text))
    assert found[1] == found[2] == found[3] == [([], "")]
    assert found[4] == [([], "a a a a a")] and found[5] == [([(0, 6, 1)], "a")]
    assert found[6] == [([], "a a a a")]
    assert found[7] == [([(0, 30_000, 1)], "tick")] * 2
    assert found[None] == [([(0, 8, 2)], "x y")] and found[9] == [([(0, 8, 2)], "A a")]
    assert found[8] == [([(0, 10, 2), (10, 7, 1)], "a b c")]
    assert runs.digests(docs.limit(0)).count() == 0
    digests = sorted((tuple(r) for r in runs.digests(docs).collect() if r.doc_id != 7), key=str)
    assert digests == sorted((brute_digest(*r) for r in rows if r[0] != 7), key=str)
