import random
import zlib

import numpy as np
import pytest

from cairnflow.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def held(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def accuracy(spark, scored, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in scored.collect() if r.held_out and r.doc_id in labels]
    assert len(rows) > 400
    return np.mean([r.predicted == labels[r.doc_id] for r in rows])


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score_quality(docs, labels)
    assert scored.count() == docs.count()
    assert accuracy(spark, scored, "quality") > 0.95


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert accuracy(spark, toxicity.score_toxicity(docs, labels), "toxic") > 0.95


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_edge_cases(spark, score):
    docs = spark.createDataFrame([(1, None, 1.0), (1, None, 1.0), (5, "", 1.0), (None, "hello", 1.0), (7, "x" * 300_000, 1.0), (8, " ".join(["stupid"] * 50), 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 0, 1), (5, None, 2), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = score(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id: r.held_out for r in rows} == {**{d: held(d) for d in (1, 5, 7, 8)}, None: False}
    assert score(docs.limit(0), labels).count() == 0
    assert score(docs, labels.limit(0)).count() == 6


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    for score in (quality.score_quality, toxicity.score_toxicity):
        a, b = ({r.doc_id: r.score for r in score(docs, lab).collect()} for lab in (labels, flipped))
        assert a == b


def test_tables_add_up():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)  # only a pair explains this
    m = quality.AdditiveModel(x, y)
    assert (0, 1) in m.pairs
    p = m.score(x)
    assert ((p > 0.5) == y).mean() > 0.9
    by_hand = m.base + sum(t[np.searchsorted(c, x[0, j], side="right")] for j, (c, t) in enumerate(zip(m.cuts, m.tables, strict=True)))
    by_hand += sum(t[np.searchsorted(m.coarse[f], x[0, f], side="right"), np.searchsorted(m.coarse[g], x[0, g], side="right")] for (f, g), t in zip(m.pairs, m.pair_tables, strict=True))
    assert abs(p[0] - 1 / (1 + np.exp(-by_hand))) < 1e-12


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    v = np.zeros((4000, 5), np.int8)
    for j, acc in enumerate((0.95, 0.9, 0.8, 0.6)):
        right = rng.random(4000) < acc
        v[:, j] = np.where(truth == right, toxicity.TOXIC, toxicity.CLEAN)
    v[:, 4] = v[:, 0]  # a copy must not count twice
    noisy = np.where(rng.random(4000) < 0.9, truth, ~truth).astype(float)
    m = toxicity.LabelModel(v, noisy)
    acc = m.accuracy()
    assert acc[0] > acc[1] > acc[2] > acc[3]
    assert [sorted(t[:2]) for t in m.correlations()] == [[0, 4]]
    assert np.abs(np.log(m.pair[4][1] / m.pair[4][0])[[1, 2], [1, 2]]).max() < 0.2  # what the copy adds to the posterior
    assert ((m.labels > 0.5) == truth).mean() > 0.95


def test_label_model_against_a_plain_computation():
    """Posteriors of a fitted model, recomputed vote by vote; a correlated pair counts by its own table."""
    rng = np.random.default_rng(4)
    truth = rng.random(3000) < 0.3
    base = np.where(rng.random(3000) < 0.8, truth, ~truth)
    echo = np.where(rng.random(3000) < 0.9, base, ~base)
    other = np.where(rng.random(3000) < 0.75, truth, ~truth)
    v = np.stack([np.where(x, toxicity.TOXIC, toxicity.CLEAN) for x in (base, echo, other)], axis=1).astype(np.int8)
    v[rng.random(3000) < 0.2, 2] = toxicity.ABSTAIN
    m = toxicity.LabelModel(v, truth.astype(float))
    assert [sorted(t[:2]) for t in m.correlations()] == [[0, 1]]
    whole = np.hstack([v, np.where(truth, toxicity.TOXIC, toxicity.CLEAN)[:, None]]).astype(np.int8)
    for row in whole[:50]:
        odds = m.prior / (1 - m.prior)
        for j, x in enumerate(row):
            t = m.table[j] if m.parent[j] < 0 else m.pair[j][:, row[m.parent[j]]]
            odds *= t[1][x] / t[0][x]
        assert abs(m.posterior(row[None])[0] - odds / (1 + odds)) < 1e-9
    table = np.array([[[0.2, 0.3, 0.5]], [[0.5, 0.4, 0.1]]])
    fixed = toxicity.no_worse_than_chance(table, np.array([0.5, 0.5]))
    assert np.allclose(fixed[:, 0, 1], 0.35) and np.allclose(fixed[:, 0, 2], 0.3)


def test_mining_is_not_fooled_by_copies():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    texts, y = [], []
    for i in range(400):
        w = [word() for _ in range(60)]
        toxic = i % 8 == 0
        if toxic:
            w[5] = "zorgle" + word()[:2]
        texts.append(" ".join(w))
        y.append(float(toxic))
    for _ in range(60):  # near copies of one toxic text
        w = texts[0].split()
        w[rng.randrange(20, 60)] = word()
        texts.append(" ".join(w))
        y.append(1.0)
    words, stems, several = toxicity.mine(texts, np.array(y))
    assert any("zorgl".startswith(s) or s.startswith("zorgl") for s in stems)
    assert len(words) + len(several) <= 2


def test_long_texts_do_not_thin_the_training_sample(spark):
    rows = [(k, b"x" * 100) for k in range(200)] + [(1000 + k, b"y" * 60_000) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, __text binary")
    assert sorted(r.doc_id for r in toxicity.fitting(docs, 24_000).collect()) == list(range(200))
    over = toxicity.fitting(docs.where("doc_id < 1000"), 15_000).count()
    assert 120 <= over <= 180  # three quarters fit; a whole divisor would leave half


def test_a_shared_passage_makes_no_copy():
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = words(60)
    apart = [f"{words(100)} {passage} {words(100)}" for _ in range(60)]
    assert not any(toxicity.near_copies(apart))
    assert toxicity.near_copies([*apart, apart[3], apart[4] + " more", "", None]) == [False] * 60 + [True, True, False, True]
