"""Removal of long byte strings that occur more than once, by prefix doubling over sampled positions.

Every window of `span` bytes picks one position inside it by its content alone, the smallest name of
the short strings it holds, so equal windows pick the same place. Positions are first named by the
string that follows them, itself named by doubling; Spark groups equal names and drops positions whose
name is unique. Those left get longer contexts at growing offsets on both sides: a block of windows
around a position is named once by what all its windows share (its core) and once by all they cover.
A block whose core is unique holds no repeated window and is dropped; one that recurs whole is
repeated throughout; any other is cut into four smaller blocks with longer cores and named again,
until a core is as long as a window and its name decides.

Names that decide a removal have 128 bits; the 64-bit names only choose what is looked at further.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import forget, free_shuffles, written
from casefile.session import durable

SPAN = 200
CUT = 4
# Windows named at a time, a power of two.
STEP = 1 << 18
_LOW = np.uint64(2 * STEP - 1)
_BASE = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def gram_length(span: int) -> int:
    """Bytes of the first name of a position: a power of two of at most two fifths of the span."""
    return 1 << ((2 * span // 5).bit_length() - 1)


def block_sizes(span: int) -> list[int]:
    """Sizes of the blocks of windows around a position, from all of them down to one; each is `CUT` times the next."""
    sizes = [1]
    while sizes[0] < span - gram_length(span) + 1:
        sizes.insert(0, sizes[0] * CUT)
    return sizes


def sampled_positions(data: bytes, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, lo, hi, name): the position is picked by the windows that begin `lo` to `hi` bytes before it."""
    gram, windows = gram_length(span), len(data) - span + 1
    width = span - gram + 1
    for begin in range(0, windows, STEP):
        count = min(STEP, windows - begin)
        h = _BYTES[np.frombuffer(data, np.uint8, count + span - 1, begin)]
        k, power = 1, _BASE
        while k < gram:
            h = h[:-k] * np.uint64(power) + h[k:]
            k, power = 2 * k, power * power % 2**64
        h = _mix(h)
        least, k = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * k <= width:
            least, k = np.minimum(least[:-k], least[k:]), 2 * k
        least = np.minimum(least[:count], least[width - k : width - k + count])
        at = (least & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [count]]) - 1
        picked = at[first]
        yield picked + begin, picked - last, picked - first, h[picked].view(np.int64)


def _named(data: bytes, lo: int, hi: int) -> bytes:
    return xxhash.xxh3_128_digest(data, lo << 20 | hi)


POSITIONS = "doc_id long, mark long, pos long, lo int, hi int, gram long, context binary"


def _positions(rows: DataFrame, span: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("pos", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("gram", pa.int64()), ("context", pa.binary())])
        for batch in batches:
            for doc, mark, data in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                data, doc, mark = data.as_py(), doc.as_py(), mark.as_py()
                for pos, lo, hi, gram in sampled_positions(data, span):
                    contexts = [_named(data[p - b : p - a + span], a, b) for p, a, b in zip(pos.tolist(), lo.tolist(), hi.tolist(), strict=True)]
                    n = len(pos)
                    columns = [pa.repeat(pa.scalar(doc, pa.int64()), n), pa.repeat(pa.scalar(mark, pa.int64()), n), pos, lo, hi, gram, contexts]
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    return rows.select("doc_id", "mark", "data").mapInArrow(lambda batches: _gathered(run(batches)), POSITIONS)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _contexts(rows: DataFrame, places: DataFrame, span: int) -> DataFrame:
    """(context, lo, hi, open, bytes): the bytes around the listed positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("context", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("open", pa.bool_()), ("bytes", pa.binary())])
        for batch in batches:
            for data, wanted in zip(batch.column(0), batch.column(1), strict=True):
                data = data.as_py()
                cut = [(w["context"], w["lo"], w["hi"], w["open"], data[w["pos"] - w["hi"] : w["pos"] - w["lo"] + span]) for w in wanted.as_py()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*cut, strict=True), kinds, strict=True)], schema=kinds)

    wanted = places.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("context", "pos", "lo", "hi", "open")).alias("wanted"))
    once = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["mark"] == wanted["mark"]))
    # rows equal in id and text would give the same contexts
    cut = once.select("data", "wanted").mapInArrow(lambda batches: _gathered(run(batches)), "context binary, lo int, hi int, open boolean, bytes binary")
    return cut


def _blocks(pending: DataFrame, span: int, size: int, parent: int) -> DataFrame:
    """(context, start, open, core, whole): the blocks of `size` windows inside each pending one of `parent` windows."""

    width = span - gram_length(span) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("context", pa.binary()), ("start", pa.int32()), ("open", pa.bool_()), ("core", pa.int64()), ("whole", pa.binary())])
        for batch in batches:
            rows = []
            for context, lo, hi, data, starts, opens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start, is_open in zip(starts, opens, strict=True):
                    for s in range(start, min(start + parent, width), size):
                        e = min(s + size, width) - 1
                        a, b = max(s, lo), min(e, hi)
                        if a <= b:
                            core = xxhash.xxh64_intdigest(data[hi - s : hi - e + span], s)
                            rows.append((context, s, is_open, core - (1 << 64) if core >> 63 else core, _named(data[hi - b : hi - a + span], a, b)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    rows = pending.select("context", "lo", "hi", "bytes", "starts", "opens")
    return rows.mapInArrow(run, "context binary, start int, open boolean, core long, whole binary")


def repeated_ranges(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, mark, begin, end): byte ranges of (doc_id, mark, data) covered by repeated windows; ranges may overlap."""
    spark, sizes = rows.sparkSession, block_sizes(span)
    positions, first_path = written(_positions(rows.filter(F.octet_length("data") >= span), span))
    # side tables are written out before a join, so that it reads two plain shuffles and hot names can be split
    again = durable(positions.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    left, left_path = written(positions.join(again, "gram", "left_semi").select(positions.columns))
    forget(spark, first_path)
    free_shuffles(spark)
    place = F.struct("doc_id", "mark", "pos", "lo", "hi")
    known = left.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at"))
    known = durable(known.select("gram", "context", (F.col("n") == 1).alias("open"), "at.*"))
    # contexts that recur as they are need no closer look, but others may equal parts of them
    doubtful = durable(known.groupBy("gram").agg(F.max("open").alias("any")).filter("any").select("gram"))
    contexts, contexts_path = written(_contexts(rows, known.join(doubtful, "gram", "left_semi"), span))
    pending = contexts.select("*", F.array(F.lit(0)).alias("starts"), F.array("open").alias("opens"))
    found = None
    for size, parent in zip(sizes[1:], sizes[:-1], strict=True):
        blocks, path = written(_blocks(pending, span, size, parent))
        twice = durable(blocks.groupBy("whole").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("whole", F.lit(True).alias("twice")))
        judged = blocks.join(twice, "whole", "left").select("context", "start", "core", F.col("open"), F.coalesce("twice", F.lit(False)).alias("twice"))
        hits = durable(judged.filter("open AND twice").select("context", F.col("start").alias("a"), F.lit(size).alias("size")))
        found = hits if found is None else found.unionByName(hits)
        if size > 1:
            judged = judged.withColumn("open", F.col("open") & ~F.col("twice"))
            cores = durable(judged.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("any")).filter("n > 1 AND any").select("core"))
            live = judged.join(cores, "core", "left_semi")
            live = durable(live.groupBy("context").agg(F.collect_list("start").alias("starts"), F.collect_list("open").alias("opens")))
            pending = contexts.drop("open").join(live, "context")
        forget(spark, path)
        free_shuffles(spark)
    forget(spark, contexts_path)
    whole = left.join(known.filter(~F.col("open")).select("context"), "context", "left_semi")
    whole = whole.select("doc_id", "mark", (F.col("pos") - F.col("hi")).alias("begin"), (F.col("pos") - F.col("lo") + span).alias("end"))
    if found is None:
        return whole
    parts = known.filter("open").join(found, "context")
    near, far = F.greatest("a", "lo"), F.least(F.col("a") + F.col("size") - 1, F.col("hi"))
    parts = parts.select("doc_id", "mark", (F.col("pos") - far).alias("begin"), (F.col("pos") - near + span).alias("end"))
    ranges = durable(whole.unionByName(parts))
    forget(spark, left_path)
    return ranges


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def remove_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept): one row per row of `docs`.

    A byte goes if it lies in a string of `span` bytes that also begins anywhere else in the
    table, in the same text or another row; `spans` lists the removed runs, `kept` is the rest.
    A null text is empty; shorter texts than `span` stay whole; a row that is there twice repeats
    itself; null ids are kept; other columns do not count; no rows give no rows.
    """
    data = F.coalesce(docs["text"].cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), data.alias("data"))
    rows = rows.select("doc_id", F.xxhash64("data").alias("mark"), "data")
    ranges = repeated_ranges(rows, span)
    lists = ranges.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    kinds = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, held in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                text, spans = text.as_py(), merged([(r["begin"], r["end"]) for r in held.as_py() or []])
                kept, at = [], 0
                for begin, end in spans:
                    kept.append(text[at:begin])
                    at = end
                rest = b"".join([*kept, text[at:]])
                out.append((doc.as_py(), len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), [{"begin": b, "end": e} for b, e in spans], rest))
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    met = rows.join(lists, rows["doc_id"].eqNullSafe(lists["doc_id"]) & (rows["mark"] == lists["mark"]), "left").select(rows["doc_id"], "data", "ranges")
    return met.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin: bigint, end: bigint>>, kept binary")
