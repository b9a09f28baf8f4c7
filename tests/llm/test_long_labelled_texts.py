"""Languages and domains of long texts are learned; targets are met when domains overlap; cuts of long texts change nothing."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from casefile.llm import decontaminate, language_id, mixing
from casefile.llm.common import taken_from

ENGLISH = "the river runs down to the sea and the people of the town walk along it every day with their dogs "
SPANISH = "el río baja hasta el mar y la gente del pueblo camina junto a él todos los días con sus perros "


def test_language_of_long_texts_only(spark):
    rows = [(i, f"{ENGLISH}{i} " * (1 + i % 3), "en") for i in range(60)] + [(100 + i, f"{SPANISH}{i} " * 150, "es") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.learn_and_identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
    with pytest.raises(ValueError):
        language_id.language_samples(docs, most_languages=1)


def test_pieces_of_long_texts(spark):
    texts = ["short é", "€" * 30_000, "ab " * 20_000, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", taken_from(F.col("t"), 1024).alias("p")).collect()
    assert [rows[0]["p"], rows[3]["p"]] == ["short é", ""]
    for r in rows[1:3]:
        pieces = [r["p"][65 * k : 65 * k + 64] for k in range(4)]
        assert len(r["p"]) == 4 * 64 + 3 and len(r["p"].encode()) <= 1024 + 3 and all(p in r["t"] for p in pieces)


def test_domain_of_long_texts_only(spark):
    rows = [(f"{ENGLISH}{i}", "en") for i in range(60)] + [(f"{SPANISH}{i} " * 300, "es") for i in range(20)]
    assert mixing.learn_domains(spark.createDataFrame(rows, "text string, domain string")).names == ["en", "es"]


@pytest.mark.parametrize("lean", [0.55, 0.6, 0.9])
def test_overlapping_domains_meet_their_targets(spark, lean):
    table = spark.range(400).select((F.col("id") % 7 + 1).cast("double").alias("tokens"), F.when(F.col("id") % 3 == 0, F.array(F.lit(lean), F.lit(1 - lean))).otherwise(F.array(F.lit(1 - lean), F.lit(lean))).alias("shares")).cache()
    fit = mixing.fit_steps(table, [0.5, 0.5])
    rated = table.withColumn("r", mixing.rate_of(F.col("shares"), fit.history))
    row = rated.agg(F.min("r"), F.sum(F.col("tokens") * F.col("r") * F.col("shares")[0]) / F.sum("tokens")).first()
    assert row[0] >= 0 and abs(row[1] - 0.5) < 1e-5 and max(map(abs, fit.gaps)) < 1e-5


def test_mixes_without_losses(spark):
    """No rate below 1: targets are shares of the grown corpus; what cannot be reached is told."""
    table = spark.range(400).select((F.col("id") % 5 + 1).cast("double").alias("tokens"), F.when(F.col("id") % 2 == 0, F.array(F.lit(0.9), F.lit(0.1))).otherwise(F.array(F.lit(0.2), F.lit(0.8))).alias("shares")).cache()
    for weights in ([0.4, 0.6], [0.8, 0.2], [0.55, 0.45]):
        fit = mixing.fit_steps(table, weights, floor=1.0)
        rated = table.withColumn("r", mixing.rate_of(F.col("shares"), fit.history, 1.0)).withColumn("t", F.col("tokens") * F.col("r"))
        least, share = rated.agg(F.min("r"), F.sum(F.col("t") * F.col("shares")[0]) / F.sum("t")).first()
        assert least >= 1.0 and abs(share - weights[0]) < 1e-5 and max(map(abs, fit.gaps)) < 1e-5 and len(fit.history) < 12
        # the smallest growth: one kind of rows stays as it is
        assert rated.filter("r = 1.0").count() >= 200
    far = mixing.fit_steps(table, [0.1, 0.9], floor=1.0)
    assert far.gaps[0] > 0.05 and abs(sum(far.gaps)) < 1e-9
    grown = table.agg(F.sum(F.col("tokens") * mixing.rate_of(F.col("shares"), far.history, 1.0)) / F.sum("tokens")).first()[0]
    assert grown <= mixing.MOST_TOTAL
    only = mixing.fit_steps(spark.createDataFrame([(3.0, [1.0])], "tokens double, shares array<double>"), [1.0])
    assert only.history == [] and abs(only.gaps[0]) < 1e-9
    none = mixing.fit_steps(table.limit(0), [0.5, 0.5])
    assert none.history == [] and none.gaps == [0.0, 0.0]


def test_rates_are_those_of_least_squares(spark):
    """With more domains than targets can hold apart, the totals are as near as projected gradient in numpy brings them."""
    rng = np.random.default_rng(3)
    shares, tokens = rng.dirichlet([2, 2, 2], 300), rng.integers(1, 9, 300).astype(float)
    table = spark.createDataFrame([(t, s.tolist()) for t, s in zip(tokens.tolist(), shares)], "tokens double, shares array<double>").cache()
    weights = np.array([0.75, 0.2, 0.05])
    fit = mixing.fit_steps(table, weights.tolist())
    share = tokens / tokens.sum()
    r = np.ones(300)
    for _ in range(20_000):
        r = np.maximum(0, r - 0.5 * shares @ ((share * r) @ shares - weights))
    want = (share * r) @ shares - weights
    assert np.square(fit.gaps).sum() <= np.square(want).sum() * 1.02 + 1e-10


def test_template_of_a_text_that_is_cut(monkeypatch):
    text = "He paid Stone 5 miles. Stone went on for 12 km with Anna Berg! It was 3,5 or 4.75 kg. " * 30
    whole = decontaminate.template(text)
    for piece in (7, 16, 29, 100):
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        cut = decontaminate.template(text)
        assert (cut.kinds == whole.kinds).all()
