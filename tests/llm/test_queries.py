"""The queries on the smallest tables against DuckDB or brute force, and the pipeline."""

import glob
import math
import random
import zlib

import numpy as np
import pytest

import check_oracle
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from kindred.llm import chat, near_dup, queries as llm, secret_scan, tokens, toxicity

from test_small_cases import (
    best_fit, brute_components, brute_cost, brute_counts, brute_ppm, brute_spans, prose, shingle_set, whole_ids, words,
)

SF_DIR = f"{check_oracle.DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check_oracle.duck_connection(SF_DIR)


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.fixture(scope="module")
def encoder():
    return tokens.WordEncoder(tokens.default_vocabulary())


def by_id(spark, name):
    return {r["doc_id"]: r for r in queries()[name](spark, SF_DIR).collect()}


def test_all_queries_are_registered():
    assert set(llm.QUERIES) | {"pipeline"} <= set(queries())
    assert {n.split("_")[0] for n in llm.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(llm.ORACLE) <= set(oracle_sql()) and corpus_pipeline.ORACLE_SQL is None
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_against_sql(spark, duck, name):
    message, rows, _, _ = check_oracle.compare(spark, duck, SF_DIR, name, llm.ORACLE[name])
    assert message is None and rows > 0


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, documents, encoder):
    found = queries()["op1_best_fit_packing"](spark, SF_DIR).collect()
    expected = []
    for doc_id, text in documents:
        ids = whole_ids(encoder, text)
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected.append((doc_id, k, at, len(part), crc(part)))
    assert sorted(tuple(r)[:5] for r in found) == sorted(expected)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 4096
        assert all(o + n == p for (o, n), (p, _) in zip(parts, parts[1:]))
    assert len(sequences) <= best_fit([e[3] for e in expected], 4096) + 1


def test_op3(spark, documents):
    found = by_id(spark, "op3_secret_scans")
    for doc_id, text in documents:
        spans = [s for s in found[doc_id]["spans"].split(",") if s and not s.startswith("novel")]
        assert spans == brute_spans(text)
    assert len(found) == len(documents)


def test_op4(spark, documents):
    found = by_id(spark, "op4_quality_rules")
    assert len(found) == len(documents)
    for doc_id, text in documents:
        r = found[doc_id]
        n, chars, symbols, lines, repeated = brute_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            n, chars, symbols, lines, repeated
        )
        assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert not (r["base_failed"] and r["kept"])


def test_op5(spark, documents, encoder):
    found = by_id(spark, "op5_token_files")
    start = 0
    for doc_id, text in sorted(documents):
        ids = whole_ids(encoder, text)
        assert tuple(found[doc_id])[1:] == (start, len(ids), crc(ids))
        start += len(ids)


def test_op7(spark, duck, documents):
    found = by_id(spark, "op7_toxicity")
    assert len(found) == len(documents)
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    model = toxicity.trained(read("documents"), read("labels"))
    for doc_id, text in documents:
        r = found[doc_id]
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert r["score"] == pytest.approx(model.score(text), abs=1e-9) and r["predicted"] == (r["score"] >= 0.7)


def test_op8(spark, documents):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in documents}
    raw = {i: (t or "").encode().lower() for i, t in documents}
    train = [raw[i] for i, _ in documents if not held[i]]
    counts = {}
    for t in train:
        for w in [*t.split(), b""]:
            counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    found = by_id(spark, "op8_lm_scoring")
    for doc_id, _ in documents:
        own, r = [*raw[doc_id].split(), b""], found[doc_id]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + kinds + 1)) for w in own)
        assert tuple(r)[1:5] == (held[doc_id], len(own), sum(w in counts for w in own), total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    for doc_id in [i for i, _ in documents if len(raw[i]) < 2000][:40]:
        from kindred.llm.ppm import ORDER

        assert found[doc_id]["score"] == pytest.approx(brute_ppm_cached(train, raw[doc_id], ORDER), abs=1e-6)


_tries = {}


def brute_ppm_cached(train, text, order):
    """``brute_ppm`` with the counts of the training texts made once."""
    if order not in _tries:
        pad, counts = b"\xff" * order, {}
        for t in train:
            data = pad + t + b"\xff"
            for i in range(order, len(data)):
                for d in range(order + 1):
                    own = counts.setdefault((d, data[i - d : i]), {})
                    own[data[i]] = own.get(data[i], 0) + 1
        _tries[order] = counts
    return brute_ppm(train, text, order, _tries[order])


def test_op9(spark, duck):
    turns = duck.execute("SELECT conv_id, list(role ORDER BY turn) FROM conversations GROUP BY 1").fetchall()
    found = queries()["op9_chat_formatting"](spark, SF_DIR).orderBy("place", "part").collect()
    by = {}
    for r in found:
        by.setdefault(r["conv_id"], []).append(r)
    assert set(by) == {c for c, _ in turns}
    for conv, roles in turns:
        roles = [chat.role_of(r) for r in roles]
        states = [chat.STATES.index(r["role"]) for r in by[conv] if r["action"] not in ("insert", "end")]
        cost, before = 0, 0
        for role, state in zip(roles, states, strict=True):
            cost += chat.step_cost(before, state, role)
            before = state
        assert cost + chat.end_cost(before) == brute_cost(roles)


def test_pipeline(spark, tmp_path, encoder):
    rng = random.Random(31)
    bad = ["grobulous", "snarkwit", "vexpod"]
    docs, labels = [], []

    def add(text):
        docs.append((len(docs), text, "en", "s", len(text or "")))

    for k in range(160):
        text = prose(rng, rng.randrange(30, 90), 3000).split()
        for _ in range(5 * (k % 4 == 0)):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        labels.append((len(docs), 1, int(k % 4 == 0)))
        add(" ".join(text))
    for k in range(12):
        copy = docs[1 + 4 * (k % 3)][1].split()
        copy[rng.randrange(len(copy))] = "changed"
        add(" ".join(copy) if k % 2 else docs[1 + 4 * (k % 3)][1])
    items = [(k, prose(rng, 40, 3000)) for k in range(4)]
    for k, item in items:
        add(f"{prose(rng, 50, 3000)} {item} {prose(rng, 2000 if k == 1 else 9, 3000)}")
    add(f"{prose(rng, 30, 3000)} password=abcdef0123456789 {prose(rng, 10, 3000)}")
    add(None)
    add("")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet")
    model = toxicity.trained(read("documents"), read("labels"))
    rows = [(i, t) for i, t, *_ in docs if model.score(t or "") < 0.7]
    assert 110 < len(rows) < 145
    first, kept = set(), []
    for (doc_id, text), (_, n, component) in zip(rows, brute_components(rows, 5)):
        if not n or component not in first:
            kept.append((doc_id, text))
        first.add(component)
    assert len(kept) <= len(rows) - 11
    clean = [
        (i, t) for i, t in kept
        if not any(100 * len(shingle_set(x.lower(), 5) & shingle_set((t or "").lower(), 5)) >= 80 * len(shingle_set(x, 5)) for _, x in items)
    ]
    assert len(clean) == len(kept) - 4
    expected = []
    for doc_id, text in clean:
        ids = whole_ids(encoder, secret_scan.redact(text or ""))
        expected += [(doc_id, k, len(ids[a : a + 4096]), crc(ids[a : a + 4096])) for k, a in enumerate(range(0, len(ids), 4096))]
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in found) == sorted(expected)
    assert any(secret_scan.REPLACEMENT in secret_scan.redact(t or "") for _, t in clean)
