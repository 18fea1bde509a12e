from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm.quality_domains import BUDGET_RATIO, domains
from starload.llm.quality_domains import TARGETS as MIX
from starload.llm.queries import op6_soft_mixing
from starload.llm.soft_mixing import Model, fit_rates, learn, mix, mixture, pieces_of, posteriors
from tests.conftest import SF_DIR

TARGETS = {"good": 0.7, "poor": 0.3, "toxic": 0.0}


def members(spark, seed=1, rows=400, sharp=3.0):
    pick = np.random.default_rng(seed)
    logits = pick.normal(size=(rows, 3)) * sharp
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    t = pick.integers(0, 500, rows)
    table = [(int(n), *map(float, q)) for n, q in zip(t, p, strict=True)]
    return t, p, spark.createDataFrame(table, "n_tokens INT, p_good DOUBLE, p_poor DOUBLE, p_toxic DOUBLE")


def brute_force(t, p, wanted, steps=20_000):
    """Least squares over non-negative rates, by many small plain gradient steps."""
    mass = (t[:, None] * p * p).sum(axis=0)
    rate = np.ones(len(t))
    for _ in range(steps):
        off = (t[:, None] * p * rate[:, None]).sum(axis=0) - wanted
        rate = np.maximum(0, rate - 0.2 * (p * (off / mass)).sum(axis=1))
    return rate


@pytest.mark.parametrize(
    "targets",
    [TARGETS, {"good": 0.1, "poor": 0.1, "toxic": 0.8}, {"good": 0.5, "poor": 0.499, "toxic": 0.001}],
)
def test_totals_meet_targets_that_can_be_met(spark, targets):
    t, p, table = members(spark, sharp=30.0)
    budget = 1.5 * t.sum()
    found = fit_rates(table, targets, budget)
    assert found.settled and not found.missed()
    assert len(found.steps) < 40
    rates = np.array([r["r"] for r in table.select(found.column().alias("r")).collect()])
    assert (rates >= 0).all()
    mine = (t[:, None] * p * rates[:, None]).sum(axis=0)
    for domain, share, total, before in zip(targets, targets.values(), mine, (t[:, None] * p).sum(axis=0), strict=True):
        # Within a thousandth of its own target, however small, or of its mass if that is zero.
        assert abs(total - share * budget) <= 1.01e-3 * (share * budget or before), domain


def test_what_cannot_be_met_comes_as_near_as_brute_force(spark, caplog):
    t, p, table = members(spark, seed=2, sharp=1.0)
    budget = float(t.sum())
    wanted = budget * np.array(list(TARGETS.values()))
    found = fit_rates(table, TARGETS, budget)
    assert found.settled and set(found.missed()) == set(TARGETS)
    assert "off target" in caplog.text
    rates = np.array([r["r"] for r in table.select(found.column().alias("r")).collect()])
    mine = (t[:, None] * p * rates[:, None]).sum(axis=0)
    assert np.allclose(mine, [found.totals[d] for d in TARGETS])
    best = (t[:, None] * p * brute_force(t, p, wanted)[:, None]).sum(axis=0)
    assert abs(best - wanted).max() > 0.02 * budget  # out of reach
    assert abs(mine - best).max() < 0.01 * budget


def test_a_guard_that_is_reached_is_told(spark, caplog):
    _, _, table = members(spark, seed=2, sharp=1.0)
    found = fit_rates(table, TARGETS, 1e5, max_steps=3)
    assert not found.settled and "still change" in caplog.text


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_registered_query_meets_its_targets(spark, sf):
    folder = SF_DIR.replace("sf0.01", sf)
    found = op6_soft_mixing(spark, folder)
    sums = found.agg(
        F.sum("n_tokens").alias("tokens"), F.sum("rate").alias("rate"), F.sum("copies").alias("copies"),
        *[F.sum(F.expr(f"n_tokens * p_{d} * rate")).alias(d) for d in MIX],
        *[F.sum(F.expr(f"n_tokens * p_{d}")).alias(f"had_{d}") for d in MIX],
    ).first()
    for domain, share in MIX.items():
        wanted = share * BUDGET_RATIO * sums["tokens"]
        assert abs(sums[domain] - wanted) <= 1.01e-3 * (wanted or sums[f"had_{domain}"]), domain
    assert sums["copies"] == pytest.approx(sums["rate"], rel=0.05)
    # Clean documents stay, poor ones as well as good ones.
    labels = domains(spark.read.parquet(f"{folder}/labels.parquet"))
    kept = found.join(labels, "doc_id").groupBy("domain").agg(F.avg((F.col("copies") > 0).cast("int")).alias("k"))
    kept = {r["domain"]: r["k"] for r in kept.collect()}
    assert kept["good"] > 0.97 and kept["poor"] > 0.8 and kept["toxic"] < 0.4


def test_posteriors_equal_bayes(spark, documents):
    model = Model(
        ["good", "toxic"], [np.log(0.75), np.log(0.25)], ["idiot", "!!"],
        [[np.log(0.01), np.log(0.5)], [np.log(0.1), np.log(0.2)]],
        [[np.log(0.99), np.log(0.5)], [np.log(0.9), np.log(0.8)]],
    )
    texts = ["an IDIOT, an idiot", "so!! what", "", None, "idiot!!", "nothing"]
    found = posteriors(documents(list(enumerate(texts)), p_good="old"), model, list(TARGETS)).collect()
    for row in found:
        text = (texts[row["doc_id"]] or "").lower()
        has = ["idiot" in text, "!!" in text]
        score = [
            np.exp(model.prior[k]) * np.prod([np.exp((model.present if h else model.absent)[i][k]) for i, h in enumerate(has)])
            for k in range(2)
        ]
        assert row["p_good"] == pytest.approx(score[0] / sum(score))
        assert row["p_toxic"] == pytest.approx(score[1] / sum(score))
        assert row["p_poor"] == 0


def test_pieces(spark, documents):
    row = documents([(1, "Thnd*** a,b  É!! | x")]).select(pieces_of("text").alias("p")).first()
    assert [p for p in row["p"] if p] == ["thnd", "***", "a", ",b", "é", "!!", "|", "x"]


def labelled(documents, spark):
    pick = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(300):
        kind = ("good", "poor", "toxic")[i % 3]
        text = pick.choices(words, k=30) + {"good": [], "poor": ["###"] * 3, "toxic": ["idiot"]}[kind]
        pick.shuffle(text)
        rows.append((i, " ".join(text)))
        if i < 200:
            labels.append((i, kind))
    return documents(rows), spark.createDataFrame(labels, "doc_id BIGINT, domain STRING"), rows


def test_unlabelled_documents_are_judged(spark, documents):
    docs, labels, rows = labelled(documents, spark)
    found = {r["doc_id"]: r for r in mix(docs, labels, TARGETS, budget_ratio=1.0).collect()}
    for i in range(200, 300):
        kind = ("good", "poor", "toxic")[i % 3]
        assert max(TARGETS, key=lambda d: found[i][f"p_{d}"]) == kind
    budget = sum(len(text.split()) for _, text in rows)
    for domain, share in TARGETS.items():
        total = sum(r["n_tokens"] * r[f"p_{domain}"] * r["rate"] for r in found.values())
        assert abs(total - share * budget) < 0.02 * budget
    assert all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in found.values())
    assert sum(r["copies"] for r in found.values()) == pytest.approx(sum(r["rate"] for r in found.values()), rel=0.1)


def test_mixture_repeats_rows(spark, documents):
    docs, labels, _ = labelled(documents, spark)
    for name in ("rate", "copies", "p_good"):
        docs = docs.withColumn(name, F.lit("old"))
    copies = {r["doc_id"]: r["copies"] for r in mix(docs, labels, TARGETS).collect()}
    found = mixture(docs, labels, TARGETS)
    assert found.columns == docs.columns
    got = {r["doc_id"]: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in copies.items() if n}
    assert {tuple(r) for r in found.select("rate", "copies", "p_good").collect()} == {("old",) * 3}


def test_tables_of_every_kind(spark, documents):
    none = spark.createDataFrame([], "doc_id BIGINT, domain STRING")
    assert mix(documents([]), none, TARGETS).count() == 0
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, None), (3, "x " * 50_000)]
    found = mix(documents(rows), none, TARGETS).collect()
    assert len(found) == 5
    assert {round(r["p_poor"], 6) for r in found} == {round(1 / 3, 6)}
    labels = spark.createDataFrame([(None, "good"), (77, "good"), (1, "else"), (1, None)], "doc_id BIGINT, domain STRING")
    assert mix(documents(rows), labels, TARGETS).count() == 5
    one = spark.createDataFrame([(1, "good")], "doc_id BIGINT, domain STRING")
    assert {r["p_good"] for r in mix(documents(rows), one, TARGETS).collect()} == {1.0}
    with pytest.raises(ValueError):
        mix(documents(rows), one, {"good": 0.5})


def test_domains_of_labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 1), (5, None, 0), (6, 1, None), (None, 1, 0)]
    labels = spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")
    assert {(r["doc_id"], r["domain"]) for r in domains(labels).collect()} == {
        (1, "good"), (2, "poor"), (3, "toxic"), (4, "toxic"), (None, "good"),
    }


def test_given_labels_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = domains(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    odd, even = labels.filter("doc_id % 2 = 1"), labels.filter("doc_id % 2 = 0")
    model = learn(docs, odd, list(TARGETS))
    judged = posteriors(docs, model, list(TARGETS)).join(even, "doc_id").collect()
    good = [r for r in judged if r["domain"] == "good"]
    toxic = [r for r in judged if r["domain"] == "toxic"]
    assert sum(r["p_good"] > 0.5 for r in good) / len(good) > 0.95
    assert sum(r["p_toxic"] for r in toxic) / len(toxic) > 10 * sum(r["p_toxic"] for r in good) / len(good)
