"""Text operators against plain Python, and on rows that are empty, null, equal or odd."""

from __future__ import annotations

import hashlib
import io
import random
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from casefile.llm import decontaminate, hilbert, language_id, mixing, quality_model, quality_rules, repeated_spans, simhash, url_filter, warc
from casefile.llm.queries import QUERIES, URL_RULES
from casefile.session import scratch_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, mark string, rate double, curve int"


def rows_of(texts, first=0):
    return [(first + i, t, "en", f"s{i % 3}", 0, 7, "x", 0.5, 1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, repeated rows, null ids and metadata, ties, a long text; extra columns with names used inside."""
    words = random.Random(3)
    long_text = " ".join(words.choice(["river", "stone", "Ärger", "no", "x1"]) for _ in range(60_000))
    rows = rows_of([None, "", " \n\t", "a", "short text", "short text", long_text, "Zeile\nZeile\nZeile", "é€𝄞 end"])
    rows += [rows[4], rows[4], (None, "short text", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, 1, 0), (4, 0, 0), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def plain_removal(texts, span):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + span] for d in data for i in range(len(d) - span + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - span + 1):
            if seen[d[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("span", [8, 21])
def test_repeated_spans_match_plain_search(spark, span):
    pick = random.Random(span)
    base = ["".join(pick.choice("abé ") for _ in range(pick.randint(0, 90))) for _ in range(40)]
    texts = base + [pick.choice(base) + pick.choice(base)[:30] for _ in range(20)] + [None, "", "ab" * 40, "ab" * 40]
    got = repeated_spans.remove_repeats(spark.createDataFrame(rows_of(texts), SCHEMA), span).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == plain_removal(texts, span)
    assert all(len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in got)


def test_repeated_spans_on_odd_rows(odd, none):
    texts = [r["text"] for r in odd.collect()]
    got = repeated_spans.remove_repeats(odd).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(plain_removal(texts, 200))
    assert repeated_spans.remove_repeats(none).count() == 0


def test_fingerprint_follows_its_definition():
    words = "the cat sat on the mat".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(4)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 4)
    assert simhash.fingerprint("The CAT\nsat  on the mat") % 2**64 == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t") == 0
    assert simhash.fingerprint("one two") % 2**64 == xxhash.xxh64_intdigest(b"one two", 42)


def test_simhash_groups_match_all_pairs(spark):
    pick = random.Random(5)
    prints = [pick.getrandbits(64) for _ in range(150)] + [0, 3, 2**63]
    prints += [p ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)) for p in prints for _ in range(2)]
    prints = sorted(set(prints))
    head = {p: p for p in prints}

    def top(p):
        while head[p] != p:
            p = head[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 2:
                head[top(p)] = top(q)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    groups = {r["fp"] % 2**64: r["head"] for r in simhash.fingerprint_groups(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    for i, p in enumerate(prints):
        for q in prints[:i]:
            assert (top(p) == top(q)) == (groups.get(p, p) == groups.get(q, q))


def test_simhash_on_odd_rows(odd, none):
    got = simhash.simhash_components(odd).collect()
    assert len(got) == odd.count() and simhash.simhash_components(none).count() == 0
    by_text = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_text[0]["fingerprint"] == "0" * 16 and {by_text[i]["component_id"] for i in (0, 1, 2)} == {0}
    assert {r["component_id"] for r in got if r["fingerprint"] == by_text[4]["fingerprint"]} == {4}
    kept = simhash.one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 4, 6, 7, 8]
    assert simhash.one_of_each_group(none).count() == 0


def test_decontamination(spark, odd, none):
    item = "Yesterday Anna bought 3 kg of red apples and Anna gave 3 apples to her neighbour before the long walk home"
    bench = spark.createDataFrame([(1, item, 9), (2, None, 9), (3, "", 9), (4, "tiny bit", 9)], "item_id long, text string, window int")
    again = item.replace("Anna", "Berta").replace("3", "17").replace("kg", "pounds")
    mixed = item.replace("Anna gave 3", "Clara gave 9")
    docs = spark.createDataFrame(rows_of(["Well. " + item + " indeed", "So: " + again.upper()[:0] + again, mixed, "Nothing of that kind is in here at all , only words", item[:40], "the tiny bit", None]), SCHEMA)
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {0: [1], 1: [1], 2: [], 3: [], 4: [], 5: [4], 6: []}
    assert sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, bench).collect()) == [2, 3, 4, 6]
    assert decontaminate.contamination(odd, bench).filter("contaminated").count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_url_rules_and_list(spark):
    urls = [
        None, "", "no scheme", "http://A.NET", "http://a.net/x", "https://sub.Example.net/en/1?q", "http://example.com/de/", "http://example.com/dex",
        "ftp://x.org/fr/a#b", "http://www.listed.com:80/p/?b=2&a=1&utm_source=x#f", "https://listed.com/p?a=1&b=2", "http://badexample.net/en/", "x://?q",
    ]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)] + [(None, "http://listed.com/p?b=2&a=1", "k"), (4, "http://a.net/x", "k")], "page_id long, url string, key string")
    listed = spark.createDataFrame([("http://listed.com/p?a=1&b=2",), (None,), ("nonsense",)], "url string")
    got = url_filter.filter_urls(pages, listed, URL_RULES).collect()
    assert len(got) == len(urls) + 2
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert by[0] == by[1] == by[2] == ("", "", None, "allow")
    assert by[3] == ("a.net", "", None, "allow") and by[4] == ("a.net", "/x", "net/", "block")
    assert by[5] == ("sub.example.net", "/en/1", "example.net/en/", "allow") and by[6][2:] == ("example.com/de/", "block")
    assert by[7][2:] == (None, "allow") and by[8][2:] == ("org/fr/", "allow") and by[11][2:] == ("net/", "block")
    assert by[9][3] == by[10][3] == by[None][3] == "block" and by[12] == ("", "", None, "allow")
    assert url_filter.filter_urls(pages.limit(0), listed, URL_RULES).count() == 0
    assert url_filter.filter_urls(pages, listed.limit(0), URL_RULES).filter("listed").count() == 0


def test_bloom_filter_lets_all_listed_keys_through(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h/"), F.col("id")).alias("url"), F.concat(F.lit("http://h/"), F.col("id")).alias("full"))
    pages = keys.select(F.lit(1).cast("long").alias("page_id"), F.col("full").alias("url"))
    assert url_filter.filter_urls(pages, pages.select("url"), [], blocks=8).filter("possible AND listed").count() == 3000
    others = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://g/"), F.col("id")).alias("url"))
    assert url_filter.filter_urls(others, pages.select("url"), [], blocks=8).filter("listed").count() == 0


def test_language_identification(spark, odd, none):
    english, german = "the house and the tree are with that man from the city", "das Haus und der Baum sind mit dem Mann aus der Stadt"
    docs = spark.createDataFrame([(i, (english if i % 2 else german) + f" {i}", "en" if i % 2 else "de", "s", 0) for i in range(80)] + [(90, None, "en", "s", 0), (91, "12 ... !", "en", "s", 0), (93, "\u00bd \u00b2 1", "en", "s", 0), (92, english.upper(), None, "s", 0)], "doc_id long, text string, lang string, source string, score long")
    got = {r["doc_id"]: r for r in language_id.learn_and_identify(docs).collect()}
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(80)) and got[92]["lang_pred"] == "en"
    assert got[90]["lang_pred"] == got[91]["lang_pred"] == got[93]["lang_pred"] == "und" and got[90]["score"] == 0
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert language_id.learn_and_identify(odd).count() == odd.count() and language_id.learn_and_identify(none).count() == 0


def test_quality_model(spark, odd, none, labels):
    good, bad = "A calm sentence about the river, number {}.\nIt goes on.", "BUY!! NOW!! BUY!! NOW!! {} ### ||| $$$"
    docs = spark.createDataFrame(rows_of([(good if i % 2 else bad).format(i) for i in range(400)]), SCHEMA)
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    got = quality_model.score_documents(docs, quality_model.learn_quality(docs, marks)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 and 0 <= r["score"] <= 1 for r in got) and sum(r["held_out"] for r in got) > 50
    model = quality_model.learn_quality(odd, labels)
    scores = quality_model.score_documents(odd, model).collect()
    assert len(scores) == odd.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert quality_model.score_documents(none, model).count() == 0
    assert {r["score"] > 0.99 for r in quality_model.score_documents(odd, quality_model.learn_quality(odd, labels.limit(0))).collect()} == {True}


def test_quality_rules_match_plain_counts(spark, odd, none):
    pick = random.Random(9)
    texts = [" ".join(pick.choice("ab#c|") * pick.randint(1, 2) + pick.choice(["", "\n", "\x0b"]) for _ in range(pick.randint(0, 80))) for _ in range(60)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).unionByName(odd)
    got = quality_rules.judge(docs).collect()
    assert len(got) == docs.count() and quality_rules.judge(none).count() == 0
    want = []
    for text in [r["text"] or "" for r in docs.collect()]:
        words = text.encode().split()
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [line for line in text.split("\n") if line.encode().split()]
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        want.append((len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed))
    assert sorted((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == sorted(want)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_warc_round_trip(spark):
    body = "x" * 120
    pages = [(1, "http://a/ b\n", body), (2, "http://b", body), (3, None, "tiny"), (4, "u", "tiny"), (5, "u", None), (6, "u", ""), (7, "u", "é" * 500_000), (None, "u", body), (2, "http://b", body)]
    table = spark.createDataFrame([(*p, "d") for p in pages], "page_id long, url string, html string, digest string")
    folder = scratch_folder(spark)
    got = warc.read_archives(warc.write_archives(table, folder), folder).collect()
    assert len(got) == len(pages)
    for r in got:
        html = next(p[2] for p in pages if p[0] == r["page_id"]) or ""
        assert r["payload_bytes"] == len(html.encode()) and r["payload_digest"] == hashlib.sha256(html.encode()).hexdigest()
        assert (r["record_type"], r["refers_to"]) == (("revisit", 1) if r["page_id"] == 2 else ("response", None))
        assert r["payload"] == (None if r["page_id"] == 2 else html.encode())
    assert warc.read_archives(warc.write_archives(table.limit(0), folder), folder).count() == 0


def test_warc_reader_refuses_broken_archives():
    whole = warc.record_bytes({"WARC-Type": "response"}, b"abc") + warc.record_bytes({"WARC-Type": "response"}, b"")
    assert [b for _, b in warc.read_records(io.BytesIO(whole))] == [b"abc", b""]
    for broken in (whole[:-3], whole[:20], whole + b"junk"):
        with pytest.raises(warc.BrokenArchive):
            list(warc.read_records(io.BytesIO(broken)))


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2)])
def test_hilbert_curve_steps_to_neighbours(spark, dims, bits):
    side = 1 << bits
    grid = spark.range(side**dims).select(*[(F.floor(F.col("id") / side**d) % side).cast("int").alias(f"c{d}") for d in range(dims)])
    rows = grid.withColumn("at", hilbert.curve_index([F.col(f"c{d}") for d in range(dims)], bits)).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(side**dims))
    assert all(sum(abs(a[d] - b[d]) for d in range(dims)) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_hilbert_shards(odd, none):
    got = hilbert.shard_rows(odd, 5, hilbert.corpus_levels(odd)).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == odd.count() and max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted((r["shard"], r["slot"]) for r in got) == sorted((s, i) for s, n in sizes.items() for i in range(n))
    for r in got:
        text = next(d["text"] for d in odd.collect() if d["doc_id"] == r["doc_id"]) if r["doc_id"] is not None else None
        if r["doc_id"] is not None:
            assert (r["size"], r["text_crc32"]) == (len((text or "").encode()) + 8, zlib.crc32((text or "").encode()))
    assert hilbert.shard_rows(none, 5, hilbert.corpus_levels(none)).count() == 0
    assert sorted(r["slot"] for r in hilbert.shard_rows(odd.limit(3), 24, hilbert.corpus_levels(odd.limit(3))).collect()) == [0, 0, 0]


def test_mixing_meets_its_targets(spark, odd, none):
    words = {"en": "the of and to in", "de": "der die und zu mit"}
    docs = spark.createDataFrame([(i, f"{words['de' if i % 5 == 0 else 'en']} w{i} w{i + 1}", "x", "s", 0) for i in range(200)], "doc_id long, text string, lang string, source string, tokens long")
    labelled = docs.select("text", F.when(F.col("doc_id") % 5 == 0, "de").otherwise("en").alias("domain"))
    rows = mixing.mixed_rates(docs, labelled, {"de": 1, "en": 1}).collect()
    total = sum(r["tokens"] for r in rows)
    for name in ("de", "en"):
        assert abs(sum(r["rate"] * r["tokens"] * r["shares"][name] for r in rows) / total - 0.5) < 0.01
    assert all(r["rate"] >= 0 and abs(sum(r["shares"].values()) - 1) < 1e-9 for r in rows)
    grown = mixing.apply_rates(docs, mixing.fit_mix(docs, labelled, {"de": 1, "en": 1}, floor=1.0))
    assert grown.columns == docs.columns and grown.select("doc_id").distinct().count() == 200 and 300 < grown.count() < 340
    assert mixing.mixed_rates(odd, labelled).count() == odd.count() and mixing.mixed_rates(none, labelled).count() == 0
    assert {r["rate"] for r in mixing.mixed_rates(odd, labelled.limit(0)).collect()} == {1.0}


def test_pipeline_stages_keep_columns(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf).cache()
        assert after.columns == docs.columns and after.count() > 0
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()}
        if name == "near_dedup":
            groups = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(before).collect()}
            assert ids == set(groups.values())
        before = after
    placed = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert placed.count() == before.count()


def test_every_operator_has_its_query():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
