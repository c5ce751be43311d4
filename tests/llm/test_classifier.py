import math
import zlib

import numpy as np
import pytest
from support import documents, odd_rows, prose

from tillmark.llm import classifier as c
from tillmark.llm.classifier import Machine, Weights


def corpus(spark):
    rows = [(i, prose(i, 80) if i % 2 else " ".join(f"WIN{x} $$$" for x in range(i % 30 + 5))) for i in range(400)]
    labels = [(i, i % 2, 0) for i, _ in rows if i % 3] + [(None, 1, 0), (9999, 0, 0), (1, 0, 0), (4, None, None)]
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_pairwise_sum_equals_the_double_loop():
    rng = np.random.default_rng(0)
    w = Weights(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    index, value = np.array([3, 9, 20, 41]), rng.normal(size=4)
    pairs = sum(w.factors[index[i]] @ w.factors[index[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert w.raw(index, value) == pytest.approx(0.3 + w.linear[index] @ value + pairs)


def plain_raw(bias, linear, factors, row):
    """Bias, linear sum and the sum over all pairs of features, one by one."""
    out = bias + sum(linear[i] * x for i, x in row)
    for a, (i, x) in enumerate(row):
        for j, y in row[:a]:
            out += sum(factors[i][f] * factors[j][f] for f in range(len(factors[i]))) * x * y
    return out


def test_scores_equal_a_plain_loop(spark):
    rows, labels = corpus(spark)
    df = documents(spark, rows[:40] + odd_rows()[:9])
    machine = Machine()
    weights = c.train(documents(spark, rows), labels)
    linear, factors = weights.linear.tolist(), weights.factors.tolist()
    got = sorted((r.score for r in c.score(df, weights).collect()))
    expected = []
    for _, t in rows[:40] + odd_rows()[:9]:
        index, value = c.features(t, None if t is None else len(t), machine.bits)
        raw = plain_raw(weights.bias, linear, factors, list(zip(index.tolist(), value.tolist())))
        expected.append(1 / (1 + math.exp(-min(30, max(-30, raw)))))
    assert got == pytest.approx(sorted(expected), abs=1e-9)


def test_fit_follows_the_gradient_of_the_loss():
    machine = Machine(bits=4, rank=2, rounds=2, batch=3)
    rows = [c.features(t, len(t), machine.bits) for t in ("a b c", "b b d e", "x 1 2", "", "The end.", "c d")]
    labels = np.array([1, 0, 0, 1, 1, 0], float)
    made = c.fit(rows, labels, machine)
    rng, d, k = np.random.default_rng(machine.seed), c.width(machine.bits), machine.rank
    theta = np.concatenate([[0.0], np.zeros(d), rng.normal(0, 0.05, (d, k)).ravel()])
    seen = np.full(len(theta), 1e-8)

    def loss(theta, own):
        linear, factors = theta[1 : 1 + d], theta[1 + d :].reshape(d, k)
        total = 0.0
        for i in own:
            raw = plain_raw(theta[0], linear, factors, list(zip(*rows[i])))
            p = 1 / (1 + math.exp(-raw))
            total -= labels[i] * math.log(p) + (1 - labels[i]) * math.log(1 - p)
        return total / len(own)

    for _ in range(machine.rounds):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), machine.batch):
            own = order[at : at + machine.batch]
            touched = sorted({int(i) for r in own for i in rows[r][0]})
            places = [0, *(1 + i for i in touched), *(1 + d + i * k + f for i in touched for f in range(k))]
            step = np.zeros(len(theta))
            for p in places:  # central differences
                up, down = theta.copy(), theta.copy()
                up[p] += 1e-5
                down[p] -= 1e-5
                step[p] = (loss(up, own) - loss(down, own)) / 2e-5 + (machine.decay * theta[p] if p else 0.0)
            seen += step**2
            theta = theta - machine.rate * step / np.sqrt(seen)
    assert made.bias == pytest.approx(theta[0], abs=1e-4)
    assert made.linear == pytest.approx(theta[1 : 1 + d], abs=1e-4)
    assert made.factors.ravel() == pytest.approx(theta[1 + d :], abs=1e-4)


def test_registered_query(spark, tmp_path):
    rows, labels = corpus(spark)
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = c.op5_factorisation_machine(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(400))
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.held_out]) > 0.95


def test_held_out_accuracy_and_columns(spark):
    rows, labels = corpus(spark)
    df = documents(spark, rows + odd_rows(), clashes=True)
    got = c.score(df, c.train(df, labels)).collect()
    assert len(got) == len(rows) + len(odd_rows())
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    known = dict(rows)
    held = [r for r in got if r.held_out and r.doc_id in known and r.doc_id > 20]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95


def test_scores_depend_on_text_and_length_alone(spark):
    rows, labels = corpus(spark)
    weights = c.train(documents(spark, rows), labels)
    texts = [prose(5, 30), "", None]
    frame = spark.createDataFrame(
        [(i * 10 + j, t, lang, source, 7) for i, t in enumerate(texts) for j, (lang, source) in enumerate([("en", "a"), (None, None), ("xx", "b")])],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    got = {r.doc_id: r.score for r in c.score(frame, weights).collect()}
    assert all(len({got[i * 10 + j] for j in range(3)}) == 1 for i in range(3))


def test_held_out_labels_are_not_learnt(spark):
    rows, labels = corpus(spark)
    df = documents(spark, rows)
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = c.train(df, labels), c.train(df, turned)
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()


def test_sample_is_a_bound_and_no_labels_are_no_fault(spark):
    rows, labels = corpus(spark)
    df = documents(spark, rows)
    assert c.train(df, labels, Machine(sample=10)).linear.any()
    none = c.train(df, labels.where("false"))
    assert {r.score for r in c.score(df, none).collect()} == {0.5}
    assert c.score(documents(spark, []), none).collect() == []


def test_features_of_odd_texts():
    for text in (None, "", " ", "a", "🙂 " * 50, "x" * 100_000):
        index, value = c.features(text, None if text is None else len(text), 15)
        assert len(index) == len(value) > 0 and index.max() < c.width(15) and np.isfinite(value).all()
