"""The whole pipeline on planted rows against plain rules."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline

from casefile.llm import quality_model, simhash

EXTRA = {"best": "1", "node": "2L", "key": "'k'", "rate": "0.5D", "component_id": "7L"}


def groups_of(prints):
    """Smallest id of each group joined by fingerprints at most two bits apart, by all pairs."""
    ids, head = sorted(prints), {}
    group = {i: i for i in ids}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 2 and top(a) != top(b):
                group[max(top(a), top(b))] = min(top(a), top(b))
    for i in ids:
        head[i] = top(i)
    return head


def windows(text, width=8):
    words = re.findall(r"[^\W_]+", text.lower())
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def planted(spark, sf, folder):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(3).collect()]
    long = [r for r in rows.values() if r["text"] and len(r["text"].split()) > 250][:8]
    more = [(900_000 + i, r["text"], r["lang"]) for i, r in enumerate(long)]
    more += [(900_100 + i, r["text"].replace(r["text"].split()[120], "altered", 1), r["lang"]) for i, r in enumerate(long)]
    leaks = {900_200 + i: f"{r['text'][:600]}\n{items[i % len(items)]}\n{r['text'][700:1500]}" for i, r in enumerate(long[:4])}
    more += [(i, t, "en") for i, t in leaks.items()] + [(900_300, None, None), (900_301, "", "en"), (900_302, "$$$ ### click click click here", "en"), (900_303, "", "en")]
    table = spark.createDataFrame([(i, t, lang, "planted", len(t or "")) for i, t, lang in more], docs.schema)
    docs.unionByName(table).selectExpr("*", *[f"{v} AS {c}" for c, v in EXTRA.items()]).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return set(leaks)


def test_run_against_plain_rules(spark, sf, tmp_path):
    leaks = planted(spark, sf, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    bench = set().union(*(windows(r["text"]) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()))
    model = quality_model.learn_quality(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in quality_model.score_documents(docs, model).collect()}
    good = {i for i, s in scores.items() if s >= 0.7}
    assert 150 < len(good) < len(rows)
    head = groups_of({i: simhash.fingerprint(rows[i]["text"]) for i in good})
    kept = {i for i in good if head[i] == i}
    assert any(i not in kept for i in good if 900_000 <= i < 900_200)
    placed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = {r["doc_id"] for r in placed}
    assert found <= kept and not found & leaks
    # what decontamination took away shares a window with the benchmark; all other documents are still there
    assert all(windows(rows[i]["text"] or "") & bench for i in kept - found)
    assert {i for i in kept if not windows(rows[i]["text"] or "") & bench} <= found
    sizes = Counter(r["shard"] for r in placed)
    assert len(sizes) == corpus_pipeline.SHARDS and max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted((r["shard"], r["slot"]) for r in placed) == sorted((s, i) for s, n in sizes.items() for i in range(n))


def test_run_on_an_empty_table(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_name_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    assert corpus_pipeline.ORACLE_SQL is None
