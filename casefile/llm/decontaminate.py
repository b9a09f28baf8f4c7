"""Benchmark passages in a corpus, also with other numbers, names and units.

Words become templates: numbers, names and units turn into typed placeholders. All windows of a
benchmark's templates are joined by hash with those of the documents. Along one alignment equal
values of the item should stand for equal values of the document, and different ones for
different ones: where a value has several partners, the one at most places is right (then the
equal one, then the first). Windows with another partner do not count, unless they are equal
word by word. Windows with few literal words are joined by their words as they are.

Documents are cut into windows where they are; a bitmap of fixed size, made of all benchmark
windows, lets through those that may match, so that only few rows are moved and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.session import durable

WINDOW = 8
# Words of a window that must be literal, as a share of it; otherwise it is joined as it is, with all its values.
LITERAL = 0.5
# Windows of an item that must be found: this share, but never more than so many.
SHARE, ENOUGH = 0.5, 13
BITMAP_BITS = 23
PIECE = 1 << 22
# Fixed word lists.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNIT_WORDS = "mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms ton tons pound pounds ounce ounces ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees mph kmh".split()
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"

_KIND = np.zeros(256, np.uint8)
_KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256), ord("_")]] = 1
_KIND[[*range(ord("0"), ord("9") + 1)]] = 2
_KIND[[ord("."), ord(",")]] = 3
_STOP = np.zeros(256, bool)
_STOP[[*b'.!?:;"\n|']] = True
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_MARKS = _mix(np.array([1, 2, 3, 4], np.uint64))


def _lower(text: str, data: bytes) -> bytes:
    """Lower case of the same length in bytes: a letter that would change its length stays."""
    low = text.lower().encode("utf-8", "surrogatepass")
    if len(low) == len(data):
        return low
    small = ((c, c.lower()) for c in text)
    return "".join(s if len(s.encode("utf-8", "surrogatepass")) == len(c.encode("utf-8", "surrogatepass")) else c for c, s in small).encode("utf-8", "surrogatepass")


def _word_hashes(b: np.ndarray, word: np.ndarray, starts: np.ndarray) -> np.ndarray:
    first = np.zeros(len(b), np.int64)
    first[starts] = starts
    offset = np.arange(len(b)) - np.maximum.accumulate(first)
    weights = np.where(word, (b.astype(np.uint64) + np.uint64(1)) * _POWERS[offset & 63], np.uint64(0))
    return _mix(np.add.reduceat(weights, starts))


@dataclass
class Template:
    """Words of a text: hashes with placeholders in place and without, 0 literal, 1 number, 2 name, 3 unit, and where they are."""

    low: bytes
    hashes: np.ndarray
    plain: np.ndarray
    kinds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    capital: np.ndarray

    def inside(self) -> Template:
        """The same text as it reads behind other words: a capitalised first word is a name there."""
        kinds, hashes = self.kinds.copy(), self.hashes.copy()
        if len(kinds) and self.capital[0] and not kinds[0]:
            kinds[0], hashes[0] = 2, _MARKS[2]
        return replace(self, kinds=kinds, hashes=hashes)

    def word(self, i: int) -> str:
        return self.low[self.starts[i] : self.ends[i]].decode("utf-8", "replace")

    def window(self, at: int, width: int) -> tuple[str, list[str], list[int]]:
        """Template of a window, the values in its slots, and the places of these; without enough literal words its words and no slots."""
        words, slots, places = [], [], []
        if np.count_nonzero(self.kinds[at : at + width] == 0) < LITERAL * width:
            return " ".join(self.word(i) for i in range(at, at + width)), slots, places
        for i in range(at, at + width):
            kind = self.kinds[i]
            words.append((self.word(i), NUM, NAME, UNIT)[kind])
            if kind:
                slots.append(f"{kind}:{self.word(i)}")
                places.append(i)
        return " ".join(words), slots, places

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows, and which of them have enough literal words to be templates."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        literal = np.concatenate([[0], np.cumsum(self.kinds == 0)])
        open_ = literal[width:] - literal[:n] >= LITERAL * width
        total = np.full(n, np.uint64(width))
        for k in range(width):
            total = total * _STEP + np.where(open_, self.hashes[k : k + n], self.plain[k : k + n])
        return _mix(total), open_


def _constant(words: list[str]) -> np.ndarray:
    line = np.frombuffer(" ".join(words).encode(), np.uint8)
    word = line != 32
    starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    return np.sort(_word_hashes(line, word, starts))


def template(text: str | None) -> Template:
    """Template of a whole text; without words all arrays are empty."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    low = _lower(text, data)
    numbers, units = _constant(NUMBER_WORDS), _constant(UNIT_WORDS)
    parts, begin = [], 0
    # what a cut must not forget: whether a stop sign came since the last word, and whether that was a number
    opening, after_number = True, False
    while begin < len(data):
        end = min(len(data), begin + PIECE)
        if end < len(data):  # a long text is cut between words where there is a blank
            cut = max(low.rfind(b" ", begin, end), low.rfind(b"\n", begin, end))
            end = cut if cut > begin else end
        b, raw = np.frombuffer(low, np.uint8, end - begin, begin), np.frombuffer(data, np.uint8, end - begin, begin)
        kind = _KIND[b]
        # dashes, quotes and dots from U+2010 on, and quotes and opening signs of Latin-1, are no letters
        signs = np.flatnonzero((b[:-2] == 0xE2) & (b[1:-1] == 0x80) & (b[2:] >= 0x90))
        for k in range(3):
            kind[signs + k] = 0
        signs = np.flatnonzero((b[:-1] == 0xC2) & np.isin(b[1:], [0xA0, 0xA1, 0xAB, 0xBB, 0xBF]))
        for k in range(2):
            kind[signs + k] = 0
        word, digit = (kind == 1) | (kind == 2), kind == 2
        word[1:-1] |= (kind[1:-1] == 3) & digit[:-2] & digit[2:]
        starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
        ends = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
        if len(starts):
            h = _word_hashes(b, word, starts)
            changed = raw != b
            n_changed = np.add.reduceat(changed.astype(np.int32), starts)
            second = np.minimum(starts + 1, len(b) - 1)
            name = (n_changed == 1) & (changed[starts] | ((b[starts] >= 128) & changed[second])) & (ends - starts > 1)
            stops = np.concatenate([[0], np.cumsum(_STOP[b] & ~word)])
            opens = np.concatenate([[opening or stops[starts[0]] > 0], stops[starts[1:]] > stops[ends[:-1]]])
            number = digit[starts] | np.isin(h, numbers)
            unit = np.isin(h, units) & np.concatenate([[after_number], number[:-1]])
            opening, after_number = bool(stops[-1] > stops[ends[-1]]), bool(number[-1])
            kinds = np.select([number, unit, name & ~opens], [1, 3, 2], 0).astype(np.uint8)
            parts.append((np.where(kinds > 0, _MARKS[kinds], h), h, kinds, starts + begin, ends + begin, name))
        else:
            opening = opening or bool(_STOP[b].any())
        begin = end
    if not parts:
        return Template(low, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    return Template(low, *(np.concatenate(column) for column in zip(*parts, strict=True)))


def item_windows(benchmark: DataFrame, width: int = WINDOW, id_column: str = "item_id") -> DataFrame:
    """(item_id, pos, n, n_open, open, width, window, slots, places, spot): the windows of every item, `n` of them, of which `n_open` are templates (`open`).

    An item shorter than a window is one window of its own width. The window at the start is there
    a second time if its first word reads as a name behind other words. `spot` is the bit of the window
    in the bitmap. Null, empty and wordless items have no windows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = template(text)
                wide = min(width, len(t.hashes))
                hashes, open_ = t.windows(wide) if wide else ([], [])
                readings = [(t, p, h) for p, h in enumerate(hashes)]
                if wide and (other := t.inside()).kinds[0] != t.kinds[0]:
                    readings.append((other, 0, other.windows(wide)[0][0]))
                for r, p, h in readings:
                    rows.append((item, p, len(hashes), int(open_.sum()), bool(open_[p]), wide, *r.window(p, wide), int(h >> np.uint64(64 - BITMAP_BITS))))
            names = ["item_id", "pos", "n", "n_open", "open", "width", "window", "slots", "places", "spot"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    items = benchmark.select(benchmark[id_column].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    return items.mapInArrow(cut, "item_id long, pos int, n int, n_open int, open boolean, width int, window string, slots array<string>, places array<int>, spot int")


def _bitmap(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bitmap of all windows, a megabyte whatever their number, and the widths that occur (one to `WINDOW`)."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(F.lit(63)))
    words = windows.groupBy(F.shiftright("spot", 6).alias("w")).agg(F.bit_or(bit).alias("bits")).collect()
    found = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in words:
        found[row["w"]] = row["bits"]
    widths = sorted(row["width"] for row in windows.select("width").distinct().collect())
    return np.unpackbits(found.view(np.uint8), bitorder="little").astype(bool), widths


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, share: float = SHARE, enough: int = ENOUGH) -> DataFrame:
    """(key, item_id, coverage): benchmark items found in the text whose `text_key` is `key`.

    An item is found if consistent windows are at least `share` of its windows, or of its templates, or `enough` of them.
    """
    spark = docs.sparkSession
    items = durable(item_windows(benchmark, width))
    bitmap, widths = _bitmap(items)
    shared = spark.sparkContext.broadcast(np.packbits(bitmap))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            rows = []
            for text in batch.column(0):
                text = text.as_py()
                t = template(text)
                key = None
                for wide in widths:
                    hashes, _ = t.windows(wide)
                    for p in np.flatnonzero(known[hashes >> np.uint64(64 - BITMAP_BITS)]).tolist():
                        key = key or hashlib.md5((text or "").encode("utf-8", "surrogatepass")).hexdigest()
                        rows.append((key, p, *t.window(p, wide)[:2]))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "at", "window", "filled"])

    found = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(scan, "key string, at int, window string, filled array<string>")
    found = found.dropDuplicates(["key", "at", "window"])
    met = found.join(items.select("item_id", "pos", "n", "n_open", "open", "window", "slots", "places"), "window")
    met = durable(met.select("key", "item_id", "n", "n_open", "open", "pos", (F.col("at") - F.col("pos")).alias("shift"), "slots", "filled", "places"))
    run = ["key", "item_id", "shift"]
    pairs = met.select(*run, F.explode(F.arrays_zip("slots", "filled", "places")).alias("s")).select(*run, "s.*").groupBy(*run, "slots", "filled")
    pairs = pairs.agg(F.struct(F.count_distinct("places").alias("n"), F.expr("slots = filled").alias("same"), (-F.min("places")).alias("first")).alias("rank"))
    # what has a better partner on either side is odd
    one = pairs.groupBy(*run, "slots").agg(F.max("rank").alias("top_one"))
    two = pairs.groupBy(*run, "filled").agg(F.max("rank").alias("top_two"))
    odd = pairs.join(one, [*run, "slots"]).join(two, [*run, "filled"]).filter("rank < top_one OR rank < top_two")
    odd = odd.groupBy(*run).agg(F.collect_set(F.struct("slots", "filled")).alias("odd"))
    used = F.arrays_zip("slots", "filled")
    even = met.join(odd, run, "left").filter(F.col("odd").isNull() | F.expr("slots = filled") | ~F.arrays_overlap(used, "odd"))
    held = even.groupBy("key", "item_id").agg(F.count_distinct("pos").alias("held"), F.count_distinct(F.expr("CASE WHEN open THEN pos END")).alias("held_open"), F.first("n").alias("n"), F.first("n_open").alias("n_open"))
    reached = lambda h, n: (F.col(h) > 0) & (F.col(h) >= F.least(F.ceil(F.col(n) * share), F.lit(enough)))
    cover = F.greatest(F.col("held") / F.col("n"), F.when(F.col("n_open") > 0, F.col("held_open") / F.col("n_open")))
    # with other values only templates can be found: they are judged among themselves, and all windows together
    return held.filter(reached("held", "n") | reached("held_open", "n_open")).select("key", "item_id", cover.alias("coverage"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, item_ids, coverage) for every row of `docs`.

    `item_ids` lists the items found in ascending order, `coverage` is the largest share of one of
    them. Null, empty and wordless texts hold nothing; equal texts get equal answers; null and
    repeated ids are kept row by row; other columns do not count; an empty benchmark finds nothing.
    """
    by_text = leaks(docs, benchmark).groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(docs["text"]).alias("key"))
    none = F.array().cast("array<bigint>")
    return rows.join(by_text, "key", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("coverage", F.lit(0.0)).alias("coverage")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` in which no benchmark item is found, all columns kept."""
    bad = leaks(docs, benchmark).select("key").distinct()
    return docs.join(bad, text_key(docs["text"]) == bad["key"], "left_anti")
