"""Rates that mix a corpus to target weights when the domain of a document is only known softly.

A classifier learned from labelled rows gives every document a share in each domain. The expected
tokens of a domain are the sum of rate x tokens x share. Projected gradient steps on the squared
distance to the targets find rates that are never negative; each step is one pass that adds up a number
for each domain and pair of domains. All of it is DataFrame expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casefile.llm.common import fresh_name, taken_from
from casefile.session import durable

# Labelled rows used to learn, bytes taken of one (longer texts give pieces from all over them), marker words of a domain.
FIT_ROWS, FIT_BYTES, MARKERS = 4000, 16_384, 60
STEPS, TOLERANCE = 60, 1e-6
# How many times the tokens of the corpus a mix without losses may have, if nothing else is asked for.
MOST_TOTAL = 4.0
# Words here are runs of anything but blanks and ASCII punctuation or digits.
NOT_WORD = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Domains:
    """`markers[m]`: words typical of domain m; `shares[m][d]`: how much a marker of m speaks for domain d."""

    names: list[str]
    prior: list[float]
    markers: list[list[str]]
    shares: list[list[float]]


def words_of(text: Column) -> Column:
    """Words of a whole text in lower case, empty ones at its ends included."""
    return F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD)


def learn_domains(labelled: DataFrame, rows: int = FIT_ROWS, markers: int = MARKERS) -> Domains:
    """From (text, domain); at most about `rows` rows are used, chosen by the hash of their text.

    Rows without text or domain teach nothing. The markers of a domain are the words whose share of
    its documents is the furthest above their share of all others. The number of domains is that of
    the targets a user writes down, so their few numbers may come to the driver.
    """
    known = labelled.filter(F.col("text").isNotNull() & F.col("domain").isNotNull())
    known = known.select(F.col("domain").cast("string").alias("domain"), F.col("text").cast("string").alias("text"))
    total = known.select("domain").count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * rows / total))
    sample = durable(known.select("domain", F.array_distinct(words_of(taken_from(F.col("text"), FIT_BYTES))).alias("words")))
    held = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    names, n = sorted(held), sum(held.values())
    if not names:
        return Domains([], [], [], [])
    seen = sample.select("domain", F.explode("words").alias("word")).filter("word <> ''").groupBy("word", "domain").agg(F.count(F.lit(1)).alias("n"))
    size = F.create_map(*[F.lit(v) for d in names for v in (d, float(held[d]))])
    everywhere = W.partitionBy("word")
    rated = seen.select("word", "domain", "n", F.sum("n").over(everywhere).alias("all"), F.element_at(size, F.col("domain")).alias("of"))
    rated = rated.withColumn("gap", F.col("n") / F.col("of") - (F.col("all") - F.col("n")) / F.greatest(F.lit(float(n)) - F.col("of"), F.lit(1.0)))
    best = rated.withColumn("r", F.row_number().over(W.partitionBy("domain").orderBy(F.desc("gap"), "word"))).filter((F.col("r") <= markers) & (F.col("gap") > 0))
    chosen: dict[str, list[str]] = {d: [] for d in names}
    for row in best.select("domain", "r", "word").collect():  # `markers` words of each domain
        chosen[row["domain"]].append(row["word"])
    lists = [sorted(chosen[d]) for d in names]
    hits = sample.groupBy("domain").agg(*[F.sum(_hits(F.col("words"), words)).alias(f"m{i}") for i, words in enumerate(lists)])
    found = {r["domain"]: r for r in hits.collect()}
    shares = []
    for i in range(len(names)):
        rate = [(found[d][f"m{i}"] + 0.5) / (held[d] + 1) for d in names]
        shares.append([r / sum(rate) for r in rate])
    return Domains(names, [held[d] / n for d in names], lists, shares)


def _hits(words: Column, markers: list[str]) -> Column:
    return F.size(F.array_intersect(words, F.array(*map(F.lit, markers)).cast("array<string>")))


def measured(text: Column, domains: Domains) -> Column:
    """(tokens, shares) of a whole text: its number of words, and its share in each domain.

    The shares are the posteriors of naive Bayes: those of the labelled rows times, for every distinct marker
    word in the text, how much it speaks for each domain. A text with no marker, also a null or empty
    one, has the shares of the labelled rows. Shares add up to 1.
    """
    prior = F.array(*map(F.lit, map(float, domains.prior))).cast("array<double>")
    every = sorted({w for words in domains.markers for w in words})

    def spread(count: Column) -> Column:
        # products of many small numbers, so logarithms, measured from the largest
        logs = F.array(*[F.array(*[F.lit(math.log(v)) for v in row]) for row in domains.shares])
        start = F.array(*[F.lit(math.log(v)) for v in domains.prior])
        summed = F.aggregate(F.arrays_zip(count.alias("c"), logs.alias("s")), start, lambda a, e: F.zip_with(a, e["s"], lambda x, y: x + e["c"] * y))
        likely = F.transform(F.array(summed), lambda x: F.transform(x, lambda v: F.exp(v - F.array_max(x))))
        return F.get(F.transform(likely, lambda x: F.transform(x, lambda v: v / F.aggregate(x, F.lit(0.0), lambda a, y: a + y))), F.lit(0))

    def look(words: Column) -> Column:
        tokens = F.size(words) - F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0) - F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
        if not domains.names:
            return F.struct(tokens.cast("long").alias("tokens"), prior.alias("shares"))
        # the text is searched once for all markers; what is left is short
        found = F.array_intersect(words, F.array(*map(F.lit, every)).cast("array<string>"))
        counts = F.transform(F.array(found), lambda few: F.array(*[_hits(few, m).cast("double") for m in domains.markers]))
        return F.struct(tokens.cast("long").alias("tokens"), F.get(F.transform(counts, spread), F.lit(0)).alias("shares"))

    return F.get(F.transform(F.array(words_of(text)), look), F.lit(0))


@dataclass(frozen=True)
class Fit:
    """The moves of all steps, and how far the total of each domain is from its target, as a share of the corpus."""

    history: list[list[float]]
    gaps: list[float]


def fit_steps(table: DataFrame, weights: list[float], floor: float = 0.0, steps: int = STEPS, tolerance: float = TOLERANCE, most_total: float = MOST_TOTAL) -> Fit:
    """Projected gradient steps until all token totals are within `tolerance` of their targets or no step gets nearer.

    `table` has `tokens` and `shares`; `weights` add up to 1. A step turns rate r of a document with
    shares p into max(floor, r - p . g), so its whole history is a list of vectors. The gradient of
    the squared distance is p . (totals - targets), which holds back documents at the floor; it is scaled by the inverse of the sums of
    tokens x p p' over the documents that can move (above the floor, or pushed up), which one pass gives along
    with the totals, so that domains whose shares overlap take no more steps than separate ones. A step that does not get
    nearer is halved. With floor 0 the targets are `weights` of the corpus as it is. With a higher one they are
    `weights` of whatever total the rates give, up to `most_total` times the corpus. What is missed is in the gaps.
    """
    width = len(weights)
    pairs = [(d, e) for d in range(width) for e in range(d, width)]

    def measure(history: list[list[float]], off: list[float] | None = None) -> tuple[np.ndarray, np.ndarray, float]:
        rated = table.select("tokens", "shares", rate_of(F.col("shares"), history, floor).alias("r"))
        push = F.lit(-1.0) if off is None else sum((F.col("shares")[d] * o for d, o in enumerate(off)), F.lit(0.0))
        free = F.when((F.col("r") > floor) | (push < 0), F.col("tokens")).otherwise(0.0)
        sums = [F.sum(F.col("tokens") * F.col("r") * F.col("shares")[d]).alias(f"d{d}") for d in range(width)]
        sums += [F.sum(free * F.col("shares")[d] * F.col("shares")[e]).alias(f"h{d}_{e}") for d, e in pairs]
        row = rated.agg(F.sum("tokens").alias("t"), *sums).first()
        if not row["t"]:
            return np.zeros(width), np.zeros((width, width)), 0.0
        metric = np.zeros((width, width))
        for d, e in pairs:
            metric[d, e] = metric[e, d] = row[f"h{d}_{e}"] / row["t"]
        return np.array([row[f"d{d}"] for d in range(width)]) / row["t"], metric, row["t"]

    now, metric, tokens = measure([])
    if not tokens:
        return Fit([], [0.0] * width)
    wanted = np.array(weights)

    def gap(totals: np.ndarray) -> np.ndarray:
        return totals - wanted * (totals.sum() if floor > 0 else 1.0)

    def seen_from_target(metric: np.ndarray) -> np.ndarray:
        # a document adds p - w to the gaps if the total follows it, and p if not; the shares p add up to 1
        if floor == 0:
            return metric
        one = metric.sum(axis=1)
        return metric - np.outer(one, wanted) - np.outer(wanted, one) + one.sum() * np.outer(wanted, wanted)

    def on_shares(vector: np.ndarray) -> list[float]:
        return (vector - wanted @ vector if floor > 0 else vector).tolist()

    history: list[list[float]] = []
    size = 1.0
    for _ in range(steps):
        off = gap(now)
        if np.abs(off).max() < tolerance or size < 1e-3:
            break
        move = size * (np.linalg.pinv(seen_from_target(metric), rcond=1e-9, hermitian=True) @ off)
        step = [*on_shares(move), *on_shares(off)]
        tried, tried_metric, _ = measure([*history, step], on_shares(off))
        if np.square(gap(tried)).sum() < np.square(off).sum() and (floor == 0 or tried.sum() <= most_total):
            history.append(step)
            now, metric, size = tried, tried_metric, min(1.0, 2 * size)
        else:
            size /= 4
    return Fit(history, (gap(now) / (now.sum() if floor > 0 else 1.0)).tolist())


def rate_of(shares: Column, history: list[list[float]], floor: float = 0.0) -> Column:
    """Rate of a document after all steps, beginning with 1 and never below `floor`.

    A step holds the move and the gradient, side by side; a document at the floor that the gradient pushes
    down stays there, whatever the scaled move is.
    """
    if not history:
        return F.lit(1.0)
    width = len(history[0]) // 2
    steps = F.array(*[F.struct(F.array(*map(F.lit, h[:width])).alias("move"), F.array(*map(F.lit, h[width:])).alias("push")) for h in history])

    def dot(x: Column) -> Column:
        return F.aggregate(F.zip_with(shares, x, lambda p, v: p * v), F.lit(0.0), lambda a, v: a + v)

    def step(rate: Column, h: Column) -> Column:
        return F.when((rate <= floor) & (dot(h["push"]) >= 0), rate).otherwise(F.greatest(F.lit(float(floor)), rate - dot(h["move"])))

    return F.aggregate(steps, F.lit(1.0), step)


@dataclass(frozen=True)
class Mix:
    """`table` holds (doc_id, tokens, shares) of the rows that it was fitted on; `gaps`: what each domain's share of tokens misses its target by."""

    domains: Domains
    history: list[list[float]]
    floor: float
    table: DataFrame
    gaps: dict[str, float]

    def rate(self, shares: Column) -> Column:
        return rate_of(shares, self.history, self.floor) if self.domains.names else F.lit(1.0)


def fit_mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, floor: float = 0.0, most_gap: float | None = None) -> Mix:
    """Learn the domains from `labelled` (text, domain) and fit rates for all of `docs`.

    `weights` names the wanted share of each domain (in any unit; domains left out get 0, unknown
    ones are ignored); without it all domains weigh the same. No rate gets below `floor`. A gap above
    `most_gap` is an error if that is given.
    """
    domains = learn_domains(labelled)
    wanted = [float((weights or {}).get(d, 0.0 if weights else 1.0)) for d in domains.names]
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), measured(docs["text"], domains).alias("m"))
    table = durable(rows.select("doc_id", "m.tokens", "m.shares"))
    fit = fit_steps(table, [w / sum(wanted) for w in wanted], floor) if sum(wanted) > 0 else Fit([], [0.0] * len(wanted))
    gaps = dict(zip(domains.names, fit.gaps, strict=True))
    if most_gap is not None and any(abs(g) > most_gap for g in gaps.values()):
        raise ValueError(f"the targets are missed by {gaps}")
    return Mix(domains, fit.history, floor, table, gaps)


def mixed_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, tokens, shares, rate) for every row of `docs`; `shares` maps domains to posteriors.

    Null and empty texts have no tokens and the shares of the labelled rows. Null and repeated ids
    are kept; other columns do not count. Without labelled rows there are no domains: shares are
    empty and every rate is 1. No rows give no rows.
    """
    mix = fit_mix(docs, labelled, weights)
    names = F.array(*map(F.lit, mix.domains.names)).cast("array<string>")
    return mix.table.select("doc_id", "tokens", F.map_from_arrays(names, F.col("shares")).alias("shares"), mix.rate(mix.table["shares"]).alias("rate"))


def apply_rates(docs: DataFrame, mix: Mix) -> DataFrame:
    """`docs` with every row as often as its rate asks for.

    The fraction of a rate is settled by a hash of id and text, so the fitted token totals hold in
    expectation. With a mix fitted with floor 1 no row is lost and under-represented documents are
    repeated; rows with equal id and text are repeated alike.
    """
    rate = fresh_name(docs, "rate_of_row")
    shares = measured(docs["text"], mix.domains)["shares"]
    rated = docs.withColumn(rate, F.get(F.transform(F.array(shares), mix.rate), F.lit(0)))
    luck = F.pmod(F.xxhash64(docs["doc_id"], docs["text"]), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col(rate) + luck).cast("int")
    return rated.withColumn(rate, F.explode(F.array_repeat(F.lit(1), copies))).drop(rate)
