"""Collocations against plain counting, in shards of any size."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from casefile.llm import collocations

SCHEMA = "doc_id long, text string, lang string, n long, h long, words int, phrase string"


def plain(rows, depth=3, least=10, inside=50, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, depth + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in found.items():
        longer = [b for (other, q), b in found.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= inside * a for b in longer):
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, x, y, totals[lang], -s) for lang, held in out.items() for r, (s, a, p, x, y) in enumerate(sorted(held)[:top], 1))


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(6)
    words = ["the", "The", "of", "in", "river", "bank", "New", "york", "city", "é€", "a\x1fb", "x\x00", "𝄞"]
    out = []
    for i in range(260):
        text = ""
        for _ in range(pick.randrange(0, 40)):
            text += pick.choice(["new york city", "river bank", pick.choice(words), pick.choice(words), f"w{pick.randrange(300)}"]) + pick.choice([" "] * 9 + [". ", ",", "\n", "\t", "! ? "])
        out.append((text, ["en", "de", None, "und"][i % 4]))
    return out + [(None, "en"), ("", "fr"), ("... ,", "fr"), (None, None), out[5], out[5], ("go " * 5000, "en")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, 3, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("shard_words", [50, 3000, collocations.SHARD_WORDS])
def test_equal_plain_counting(spark, rows, shard_words):
    got = collocations.collocations(frame(spark, rows).repartition(3), shard_words=shard_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_deeper_phrases_and_other_bounds(spark, rows):
    docs = frame(spark, rows[:120])
    assert sorted(map(tuple, collocations.collocations(docs, depth=4, least=3, inside_percent=80, top=None, shard_words=400).collect())) == plain(rows[:120], 4, 3, 80, None)
    assert sorted(map(tuple, collocations.collocations(docs, depth=2, least=2, top=5).collect())) == plain(rows[:120], 2, 2, 50, 5)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.limit(3), least=10**6).count() == 0


def test_full_bitmap_only_prunes_less(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows)).collect())) == plain(rows)


def test_intervals_of_both_directions():
    """Grown in any order of sides, intervals count what stands in the text and hold its places."""
    pick = random.Random(2)
    ids = np.array([0] + [pick.choice([0, 1, 1, 2, 3]) for _ in range(500)] + [0])
    text = ids.tolist()
    for sides in ([0, 0, 0], [1, 1, 1], [0, 1, 0], [1, 0, 1], [1, 0, 0]):
        index = collocations.TwoWayIndex(ids, 4)
        held = index.words()
        for d in sides:
            held = index.extended(held, d)
            size = len(held.words)
            want = Counter(tuple(text[i : i + size]) for i in range(len(text) - size + 1) if 0 not in text[i : i + size])
            got = dict(zip(zip(*[w.tolist() for w in held.words], strict=True), held.counts.tolist(), strict=True))
            assert got == want


def test_exact_arithmetic(spark):
    """Counts whose products pass 64 bits."""
    big = 3 * 10**14
    rows = [("x", 1, "p", big + 1), ("x", 1, "q", big + 7), ("x", 2, "p q", big), ("x", 0, "", 2 * big)]
    row = collocations.scored(spark.createDataFrame(rows, "lang string, words int, phrase string, f long")).first()
    assert (row["a"], row["l"], row["r"], row["score"]) == (big, big + 1, big + 7, 1_000_000 * big * big // ((big + 1) * (big + 7)))
