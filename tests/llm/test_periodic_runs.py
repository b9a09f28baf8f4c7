"""Periodic runs against a plain search over all periods and stretches."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from casefile.llm import periodic_runs
from casefile.llm.queries import QUERIES

GRID = periodic_runs.grid_table()


def plain_runs(words):
    """(start, length, period) by start and period: longest stretches of every period whose smallest period it is."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                stretch = words[i : j + q]
                if not any(all(stretch[x] == stretch[x + p] for x in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    text = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())


def shapes(pick):
    yield []
    yield ["a"] * 5
    yield ["a"] * 6
    yield ["a"] * 700
    yield ["a", "b"] * 200 + ["a"]
    yield (["a", "a", "b"] * 5 + ["c"]) * 6
    for _ in range(60):
        words = []
        while len(words) < pick.randrange(10, 160):
            unit = [pick.choice("ab") for _ in range(pick.randrange(1, 7))]
            words += unit * pick.choice([1, 2, 4, 5, 9])
        yield words
    for size in (2, 3):
        for _ in range(20):
            yield [pick.choice("abc"[:size]) for _ in range(120)]
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    yield list(fib[-1])


def test_runs_equal_plain_search():
    texts = list(shapes(random.Random(3)))
    got = periodic_runs.runs_of([periodic_runs.word_ids([w.encode() for w in t]) for t in texts], GRID)
    for words, runs in zip(texts, got, strict=True):
        assert [tuple(r) for r in runs.tolist()] == plain_runs(words)


@pytest.mark.parametrize("most", [40, 1 << 14])
def test_long_texts_and_full_groups(monkeypatch, most):
    """Texts beyond the table, candidates followed in parts and groups closed early give the same runs."""
    monkeypatch.setattr(periodic_runs, "TABLE_WORDS", most)
    monkeypatch.setattr(periodic_runs, "GROUP_CANDIDATES", 7)
    monkeypatch.setattr(periodic_runs, "GROUP_WORDS", 50)
    texts = list(shapes(random.Random(5)))
    got = periodic_runs.runs_of([periodic_runs.word_ids([w.encode() for w in t]) for t in texts], GRID)
    assert [[tuple(r) for r in runs.tolist()] for runs in got] == [plain_runs(t) for t in texts]


def test_agreement_of_any_two_places():
    pick = random.Random(8)
    ids = np.array([9] + [pick.choice([1, 2, 2, 2, 3]) for _ in range(400)] + [8])
    levels = periodic_runs.grammar(ids)
    assert len(set(levels[-1].ids.tolist())) == len(levels[-1].ids)
    pairs = np.array([(x, y) for x in range(1, 401, 3) for y in range(1, 401, 2) if x != y])
    ahead = periodic_runs.agreement(levels, pairs[:, 0], pairs[:, 1], 1)
    behind = periodic_runs.agreement(levels, pairs[:, 0], pairs[:, 1], -1)
    word = ids.tolist()
    for (x, y), f, b in zip(pairs.tolist(), ahead.tolist(), behind.tolist(), strict=True):
        assert word[x : x + f] == word[y : y + f] and word[x + f] != word[y + f]
        assert word[x - b + 1 : x + 1] == word[y - b + 1 : y + 1] and word[x - b] != word[y - b]


def test_query_equals_plain_rows(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    odd = [(None, "a a a a a a a", "x"), (7_000_001, None, "x"), (7_000_002, "", None), (7_000_003, " \n\t ", "x"), (7_000_004, "é é é é é é b", "x")]
    odd += [(7_000_005, " ".join(["w", "v", "w"] * 9_000), "x"), (7_000_006, "a\x1fb " * 8, "x"), (7_000_006, "a\x1fb " * 8, "x")]
    odd += [(8_000_000 + i, " ".join(f"w{j}" for j in range(i % 40)), "x") for i in range(200)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string, n string").select("doc_id", "text"))
    rows = rows.selectExpr("doc_id", "text", "1 as n", "2L as a", "'x' as runs")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = [r for r in rows.select("doc_id", "text").collect() if r["doc_id"] is not None and len(r["text"] or "") < 4_000]
    want = {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in small}
    found = got.collect()
    assert len(found) == rows.count()
    for r in found:
        if r["doc_id"] in want:
            assert tuple(r) == want[r["doc_id"]]
    by_id = {r["doc_id"]: r for r in found}
    assert tuple(by_id[None])[1:6] == (1, 0, 7, 1, 7000)
    assert sum(tuple(r)[1] for r in found if (r["doc_id"] or 0) >= 8_000_000) > 0
    long = by_id[7_000_005]
    assert (long["n_runs"], long["start"], long["length"], long["period"]) in {(1, 0, 27_000, 3)} or zlib.crc32(b"7000005") % 10 == 0


def test_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x y x y x y x y z")], "doc_id long, text string")
    row = periodic_runs.periodic_runs(docs, texts=True).first()
    assert (row["runs"], row["collapsed"], row["n_words"]) == ([0, 8, 2], "x y z", 9)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
