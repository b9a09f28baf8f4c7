"""The operators over the test tables, one query each, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm import collocations, decontaminate, hilbert, language_id, mixing, periodic_runs, quality_model, quality_rules, repeated_spans, simhash, url_filter, vector_links, warc
from casefile.llm.common import bounded_ids, table
from casefile.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

URL_RULES = [
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return register


@query("op1_repeated_spans")
def op1_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.remove_repeats(table(spark, sf_dir, "documents")).drop("spans", "kept")


@query("op2_hilbert_shards")
def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sharded = hilbert.shard_rows(docs, 24, hilbert.corpus_levels(docs))
    return sharded.withColumn("grown_shard", F.lit(None).cast("int"))


OP4_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, rest,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS asked
  FROM cut
), named AS (
  SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN
    regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS canonical,
    CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM parts
), judged AS (
  SELECT *, coalesce(canonical IN (SELECT canonical FROM named WHERE page_id % 50 = 0 AND canonical IS NOT NULL), false) AS listed FROM named
)
SELECT page_id, host, path, rule, canonical, listed,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query("op4_url_filter", OP4_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of blocked URLs: those of the pages whose id is divisible by 50."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter("page_id % 50 = 0").select("url")
    return url_filter.filter_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH p AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to, url, true AS block_ok
FROM f
"""


@query("op8_warc", OP8_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    files = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(files, folder, keep_payload=False).drop("payload")


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS w FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), m AS (
  SELECT doc_id, text, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    100 * n_symbols > 10 * word_chars OR n_dup_lines * 10 > 3 * len(string_split(text, chr(10))) OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 50 * word_chars OR 100 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 30 * word_chars
    OR 100 * (length(text) - length(replace(text, '!', ''))) > 50 * n_words) AS kept
FROM b
"""


@query("op9_quality_rules", OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.learn_and_identify(table(spark, sf_dir, "documents"))


@query("op10_quality_model")
def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score_documents(docs, quality_model.learn_quality(docs, table(spark, sf_dir, "labels")))


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def language_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, domain): a bounded number of documents that the table of labels covers, their language as the domain."""
    covered = F.broadcast(bounded_ids(table(spark, sf_dir, "labels"), mixing.FIT_ROWS))
    return table(spark, sf_dir, "documents").join(covered, "doc_id", "left_semi").select("text", F.col("lang").alias("domain"))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All languages are wanted with the same number of tokens."""
    return mixing.mixed_rates(table(spark, sf_dir, "documents"), language_labels(spark, sf_dir))


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), usable AS (
  SELECT r, vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT r, r AS other FROM v UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other
), counted AS (
  SELECT a AS r, count(*) AS n_links FROM links GROUP BY a
), least AS (
  SELECT reach.r, min(o.vec_id) AS component_id FROM reach JOIN v o ON o.r = reach.other GROUP BY reach.r
)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (r) LEFT JOIN counted USING (r)
"""


@query("op11_vector_links", OP11_SQL)
def op11_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.linked_vectors(table(spark, sf_dir, "embeddings"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, list_filter(regexp_extract_all(piece, '[^\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut WHERE len(w) > 0
), grams AS (
  SELECT lang, s AS size, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM starts, (VALUES (1), (2), (3)) AS sizes (s) WHERE i + s - 1 <= len(w)
), counts AS (
  SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, count(*) AS n FROM starts GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS parts FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(parts[1:k], ' ') AS head, array_to_string(parts[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), rated AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
), lowest AS (
  SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_pairs AS (
  SELECT lang, phrase, max(a) AS f FROM (
    SELECT lang, a, array_to_string(parts[1:2], ' ') AS phrase FROM candidates WHERE size = 3
    UNION ALL SELECT lang, a, array_to_string(parts[2:3], ' ') FROM candidates WHERE size = 3) GROUP BY ALL
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inner_pairs i USING (lang, phrase) WHERE i.f IS NULL OR 100 * i.f < 50 * lowest.a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In a tenth of the documents, chosen by the crc32 of their id, the words from some place on are first replaced by repetitions."""
    docs = table(spark, sf_dir, "documents")
    n, h = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    marked = docs.select("doc_id", "text", n.cast("long").alias("n"), h.alias("h"), F.floor(h / 10).alias("g"))
    marked = marked.withColumn("a", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.try_mod("g", "n")))
    marked = marked.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    return periodic_runs.periodic_runs(marked, marked["p"], marked["a"]).drop("n_words")
