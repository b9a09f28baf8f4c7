"""Language identification by compression.

For each language a raw-content Zstandard dictionary is cut from known texts. Texts are brought to
lower-case words, a word said several times in a row once, and all of a text is compressed with every
dictionary, piece by piece, so that a long text cannot become its own dictionary. The one that
makes it smallest names its language. Where the runner-up is nearly as small the choice is marked
as not confident.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casefile.llm.common import held_out, taken_from

# Per language: known texts taken, bytes taken of one (longer ones give pieces from all over them), and bytes of the dictionary.
SAMPLE_TEXTS = 400
SAMPLE_TEXT_BYTES = 8192
DICTIONARY_BYTES = 1 << 18
# Languages, each with a dictionary in every task; more are an error.
MOST_LANGUAGES = 1000
LEVEL = 3
# Bytes by which the runner-up must be larger, as a share of its size.
NARROW = 0.01
# Characters compressed at a time.
PIECE = 1024
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def plain_words(text: str) -> str:
    """The words of a text in lower case, repetitions in a row left out."""
    return " ".join(word for word, _ in groupby(WORD.findall(text.lower())))


def language_samples(known: DataFrame, most_languages: int = MOST_LANGUAGES) -> dict[str, bytes]:
    """A dictionary of bounded size for each language of (doc_id, text, lang), the most frequent first.

    Texts are taken in the order of a hash of the id, long ones in pieces, so that a language that has only
    long texts is learned too. More than `most_languages` languages are an error.
    """
    fit = known.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.octet_length("text") > 0))
    fit = fit.select("lang", "text", F.xxhash64(F.col("doc_id"), F.lit("sample")).alias("h"))
    counts = fit.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} languages are labelled")
    held = F.broadcast(known.sparkSession.createDataFrame(counts, "lang string, n long"))
    # a hash threshold leaves about twice the rows wanted of each language, however many it has
    slots = F.pmod(F.col("h"), F.lit(1 << 30)).cast("double") / (1 << 30)
    few = fit.join(held, "lang").filter(slots * F.col("n") < 2 * SAMPLE_TEXTS).select("lang", taken_from(F.col("text"), SAMPLE_TEXT_BYTES).alias("text"), "h")
    ranked = few.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))).filter(F.col("r") <= SAMPLE_TEXTS)
    size = F.sum(F.octet_length("text") + 1).over(W.partitionBy("lang").orderBy("r"))
    ranked = ranked.withColumn("size", size).filter((F.col("size") <= DICTIONARY_BYTES) | (F.col("r") == 1))
    found: dict[str, list[bytes]] = {r["lang"]: [] for r in sorted(counts, key=lambda r: (-r["n"], r["lang"]))}
    for row in sorted(ranked.select("lang", "r", "text").collect(), key=lambda row: (row["lang"], -row["r"])):
        found[row["lang"]].append(plain_words(row["text"]).encode())
    return {lang: b" ".join(texts) for lang, texts in found.items()}


def identifier(samples: dict[str, bytes], level: int = LEVEL):
    """A function from text to (language, score, confident)."""
    names = list(samples)
    squeezers = []
    for name in names:
        known = zstandard.ZstdCompressionDict(samples[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=level)
        squeezers.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))

    def identify(text: str | None) -> tuple[str, float, bool]:
        words = plain_words(text) if names and text else ""
        if not any(map(str.isalpha, words)):  # signs such as a half count as word characters but are no letters
            return UNKNOWN, 0.0, False
        pieces = [words[at : at + PIECE].encode() for at in range(0, len(words), PIECE)]
        sizes = [sum(len(s.compress(piece)) for piece in pieces) for s in squeezers]
        order = sorted(range(len(names)), key=lambda i: (sizes[i], i))
        best, second = sizes[order[0]], sizes[order[1]] if len(order) > 1 else 2 * sizes[order[0]]
        score = 1 - best / second
        return names[order[0]], score, score > NARROW

    return identify


def identify_languages(docs: DataFrame, samples: dict[str, bytes], level: int = LEVEL) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, confident) for every row of `docs`.

    The score is the share by which the best dictionary beats the runner-up: 0 for a tie, 1 for
    nothing left; ties go to the language with more known texts. Null texts, texts without a letter and all
    texts where nothing was learned are `und` with score 0. Repeated rows and null ids are kept,
    other columns ignored; no rows give no rows.
    """
    types = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("confident", pa.bool_())])

    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identify = identifier(shared.value, level)
        for batch in batches:
            found = [identify(t.as_py()) for t in batch.column(2)]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), list(types)[2:], strict=True)] if found else [pa.array([], f.type) for f in list(types)[2:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=types)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, confident boolean")


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows of `docs` that are not held out, then identify all of them."""
    known = docs.filter(~held_out(docs["doc_id"])).select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    return identify_languages(docs, language_samples(known))
