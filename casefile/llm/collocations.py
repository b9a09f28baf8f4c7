"""Phrases ranked by how much more often their words meet than chance has it.

Texts are cut into shards of a bounded number of words. Over the word ids of a shard stands an
FM-index in both reading directions, its suffixes sorted as deep as phrases get. From the interval of
every word, phrases grow by the words that the Burrows-Wheeler transform shows before them (in the
forward index) and behind them (in the backward one); the intervals of both indexes are moved
together, and the size of an interval is the count of its phrase. Spark adds up the counts of shards.

A phrase of three words is no more frequent than the two pairs in it. A first pass therefore adds up
hashes of words and pairs; a bitmap of those that reach the least count (equal hashes only let
too much through) tells the second pass which phrases to grow and to send on in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casefile.session import durable

# Signs that end a piece; words are what blanks and tabs leave of it.
ENDS = b".,;:!?\n\x0b\x0c\r"
# 0xFF is in no UTF-8 text.
CUT = b"\xff"
_TABLE = bytes.maketrans(ENDS + b"\t", CUT * len(ENDS) + b" ")
# Words after which a shard is closed (some 300 bytes of memory each); only a single longer text makes it larger.
SHARD_WORDS = 800_000
# Rows of a batch that leaves a shard.
BATCH = 1 << 16
# The bitmap has this many bits for each frequent hash, within these powers of two (32 MB at most); a fuller one prunes less.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 6, 28
UNKNOWN = "und"


class _Ids(dict):
    """Numbers from a shared counter for words not seen before."""

    def __init__(self, next_id):
        super().__init__({CUT: 0})
        self.next_id = next_id

    def __missing__(self, word):
        self[word] = found = self.next_id()
        return found


@dataclass
class Shard:
    """`ids`: words of many texts, 0 between pieces; `vocabulary[i]` and `lang_of[i]` belong to id i + 1."""

    ids: np.ndarray
    vocabulary: list[bytes]
    lang_of: np.ndarray
    langs: list[str]


def shards(texts: Iterator[tuple[str, bytes]], most: int = SHARD_WORDS) -> Iterator[Shard]:
    """Shards of (lang, text); equal words of two languages have two ids."""
    vocabularies: dict[str, _Ids] = {}
    held, size, taken = [np.zeros(1, np.int32)], 0, iter(range(1, 1 << 62))
    for lang, text in texts:
        words = text.lower().translate(_TABLE).replace(CUT, b" \xff ").split()
        if lang not in vocabularies:
            vocabularies[lang] = _Ids(lambda: next(taken))
        ids = np.fromiter(map(vocabularies[lang].__getitem__, words), np.int32, len(words))
        held += [ids, held[0]]
        size += len(ids)
        if size >= most:
            yield _closed(held, vocabularies)
            vocabularies = {}
            held, size, taken = held[:1], 0, iter(range(1, 1 << 62))
    if size:
        yield _closed(held, vocabularies)


def _closed(held: list[np.ndarray], vocabularies: dict[str, _Ids]) -> Shard:
    ids = np.concatenate(held)
    ids = ids[(ids > 0) | np.concatenate([[True], ids[:-1] > 0])]  # one 0 between pieces is enough
    size = sum(len(v) - 1 for v in vocabularies.values())
    words, lang_of = [b""] * size, np.zeros(size, np.int32)
    for k, known in enumerate(vocabularies.values()):
        for word, at in known.items():
            if at:
                words[at - 1], lang_of[at - 1] = word, k
    return Shard(ids, words, lang_of, list(vocabularies))


class FmIndex:
    """One direction: `bwt[row]` is the id before the suffix in that row, suffixes sorted by their first `depth` ids."""

    def __init__(self, ids: np.ndarray, depth: int):
        n, base = len(ids), int(ids.max(initial=0)) + 1
        ahead = np.concatenate([ids, np.zeros(depth, ids.dtype)])
        if base**depth < 1 << 63:
            key = np.zeros(n, np.int64)
            for k in range(depth):
                key = key * base + ahead[k : k + n]
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort([ahead[k : k + n] for k in reversed(range(depth))])
        self.bwt = ids[order - 1]  # the text begins with 0, so what stands before it does not matter
        self.bwt[order == 0] = 0
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=base))])

    @cached_property
    def before(self) -> np.ndarray:
        """The row of the suffix that is one id longer, for every row."""
        rows = np.empty(len(self.bwt), np.int64)
        rows[np.argsort(self.bwt, kind="stable")] = np.arange(len(self.bwt))
        return rows


@dataclass
class Phrases:
    """`words[k]`: ids at place k; the intervals begin at row `near[d]` of the forward (0) and backward (1) index."""

    words: list[np.ndarray]
    near: list[np.ndarray]
    counts: np.ndarray

    def some(self, which: np.ndarray) -> Phrases:
        return Phrases([w[which] for w in self.words], [r[which] for r in self.near], self.counts[which])


class TwoWayIndex:
    """FM-indexes of the ids and of the ids read backwards."""

    def __init__(self, ids: np.ndarray, depth: int):
        self._ids, self._depth, self._sides = ids, depth, {}
        self.symbols = int(ids.max(initial=0)) + 1

    def side(self, d: int) -> FmIndex:
        if d not in self._sides:
            self._sides[d] = FmIndex(self._ids[::-1] if d else self._ids, self._depth)
        return self._sides[d]

    def words(self) -> Phrases:
        """The intervals of all words."""
        first = self.side(0).first
        known = np.arange(1, self.symbols)
        return Phrases([known], [first[1:-1], first[1:-1]], np.diff(first)[1:])

    def extended(self, held: Phrases, d: int) -> Phrases:
        """All phrases that are one word longer on the left (0) or right (1) within a piece.

        The rows of an interval are read from the transform. The first row of a symbol leads to the
        new interval of this index; in the other one it begins behind all smaller symbols.
        """
        index = self.side(d)
        starts = np.cumsum(held.counts) - held.counts
        owner = np.repeat(np.arange(len(held.counts)), held.counts)
        rows = np.arange(len(owner)) + (held.near[d] - starts)[owner]
        key = owner * self.symbols + index.bwt[rows]
        found, at, counts = np.unique(key, return_index=True, return_counts=True)
        owner, symbol = np.divmod(found, self.symbols)
        passed = np.cumsum(counts) - counts - starts[owner]
        word = symbol > 0
        owner, at, symbol = owner[word], at[word], symbol[word]
        near: list[np.ndarray] = [None, None]
        near[1 - d] = held.near[1 - d][owner] + passed[word]
        near[d] = index.before[rows[at]] if len(held.words) + 1 < self._depth else near[1 - d]  # longest phrases are not extended
        words = [w[owner] for w in held.words]
        return Phrases([symbol, *words] if d == 0 else [*words, symbol], near, counts[word])


def _hashes(shard: Shard) -> np.ndarray:
    found = [xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(shard.langs[k])) for word, k in zip(shard.vocabulary, shard.lang_of.tolist(), strict=True)]
    return np.array([0, *found], np.uint64)


def _joint(hashes: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """One hash for each phrase."""
    out = hashes[words[0]]
    for more in words[1:]:
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[more]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            yield lang.as_py(), text.as_py()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs["text"].cast("string").cast("binary"), F.lit(b"")).alias("text"))


def short_hashes(docs: DataFrame, depth: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(h, n): hashes of words and pairs with their counts in one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(_read(batches), shard_words):
            index, hashes = TwoWayIndex(shard.ids, depth), _hashes(shard)
            single = index.words()
            for held in (single, index.extended(single, 0)):
                for at in range(0, len(held.counts), BATCH):
                    part = held.some(slice(at, at + BATCH))
                    yield pa.RecordBatch.from_arrays([pa.array(_joint(hashes, part.words).view(np.int64)), pa.array(part.counts.astype(np.int64))], names=["h", "n"])

    return _rows(docs).mapInArrow(run, "h long, n long")


def bitmap(hashes: DataFrame) -> np.ndarray:
    """A bit for each of the distinct `h`, chosen by its upper digits; a power of two of bits, 32 MB at most."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(np.ceil(np.log2(max(1, hashes.count()) * BITS_EACH)))))
    slot = F.shiftrightunsigned("h", 64 - bits)
    cells = hashes.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 AS int)))").alias("bits"))
    got = cells.toArrow()  # 2^22 rows at most
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[got.column("cell").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - 6 - int(np.log2(len(bits))))
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def shard_counts(docs: DataFrame, depth: int, bits: np.ndarray, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, words, phrase, n): counts in one shard of phrases all of whose words and pairs have their bit; words 0: all words of a language."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for shard in shards(_read(batches), shard_words):
            index, hashes = TwoWayIndex(shard.ids, depth), _hashes(shard)
            vocabulary, langs = pa.array([b"", *shard.vocabulary], pa.binary()), pa.array(shard.langs, pa.string())
            lang_of = np.concatenate([[0], shard.lang_of])
            held = index.words()
            total = np.bincount(shard.lang_of, weights=held.counts, minlength=len(shard.langs)).astype(np.int64)
            yield _batch(langs, 0, pa.array([b""] * len(shard.langs), pa.binary()), total)
            for size in range(1, depth + 1):
                if size > 1:
                    held = index.extended(held, size % 2)
                ends = (held.words[:2], held.words[-2:]) if size > 1 else (held.words,)  # inner pairs were looked at before
                held = held.some(np.logical_and.reduce([_set(bits, _joint(hashes, words)) for words in ends]))
                for at in range(0, len(held.counts), BATCH):
                    part = held.some(slice(at, at + BATCH))
                    phrase = vocabulary.take(pa.array(part.words[0]))
                    for words in part.words[1:]:
                        phrase = pc.binary_join_element_wise(phrase, vocabulary.take(pa.array(words)), b" ")
                    yield _batch(langs.take(pa.array(lang_of[part.words[0]])), size, phrase, part.counts)

    return _rows(docs).mapInArrow(run, "lang string, words int, phrase binary, n long")


def _batch(lang: pa.Array, words: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    columns = [lang, pa.repeat(pa.scalar(words, pa.int32()), len(lang)), phrase, pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])


def phrase_counts(docs: DataFrame, depth: int = 3, least: int = 10, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, words, phrase, f): every phrase of up to `depth` words that occurs `least` times, and (words 0) all words of a language.

    Counts are exact and over whole texts; phrases stay within pieces. Null texts are empty, a null
    language is `und`, equal rows count each, other columns are ignored, no rows give none.
    """
    sums = short_hashes(docs, min(depth, 2), shard_words).groupBy("h").agg(F.sum("n").alias("n"))
    bits = bitmap(durable(sums.filter(F.col("n") >= least).select("h")))
    found = shard_counts(docs, depth, bits, shard_words).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    return durable(found.filter((F.col("f") >= least) | (F.col("words") == 0)).withColumn("phrase", F.col("phrase").cast("string")))


def _part(words: Column, start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, F.lit(start) if isinstance(start, int) else start, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of all phrases of two and more words, by their weakest cut.

    Decimals hold counts below 10^15 exactly: a million times the square of a count has 36 digits at most.
    """
    phrases = counts.filter("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("parts"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "words", "phrase", "a", "k", _part(F.col("parts"), 1, F.col("k")).alias("head"), _part(F.col("parts"), F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    parts = counts.filter("words > 0")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    whole = {c: f"cast({c} AS decimal(15, 0))" for c in "alr"}
    cuts = cuts.withColumn("score", F.expr(f"div(1000000BD * {whole['a']} * {whole['a']}, {whole['l']} * {whole['r']})"))
    weakest = cuts.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return weakest.select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def contained(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longest_f): phrases of two and more words inside a longer one, with the largest count of these."""
    longer = counts.filter("words > 2").select("lang", "f", "words", F.split("phrase", " ").alias("parts"))
    sizes = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    starts = sizes.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    return starts.groupBy("lang", _part(F.col("parts"), F.col("start"), F.col("size")).alias("phrase")).agg(F.max("f").alias("longest_f"))


def collocations(docs: DataFrame, depth: int = 3, least: int = 10, inside_percent: int = 50, top: int | None = 2000, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to `depth` words of each language.

    A phrase found `a` times is cut into two parts found `l` and `r` times; score is
    floor(10^6 a a / (l r)) of its lowest cut (ties: the first). Phrases within a longer one that makes
    up `inside_percent` of their count are left out. Rank goes by score, count and phrase. `top` None
    ranks all. Odd rows are treated as in `phrase_counts`; a language without phrases has no row.
    """
    counts = phrase_counts(docs, depth, least, shard_words)
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    rows = scored(counts).join(contained(counts), ["lang", "phrase"], "left")
    rows = rows.filter(F.col("longest_f").isNull() | (100 * F.col("longest_f") < inside_percent * F.col("a")))
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
