"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import packing, perplexity, quality, records, urlrules, warc
from fieldtally.llm.audit import source_divergence
from fieldtally.llm.decontam import contamination
from fieldtally.llm.langid import identify
from fieldtally.llm.mixing import Mixture
from fieldtally.llm.negatives import hard_negatives, whole_numbers
from fieldtally.llm.neardup import near_duplicates
from fieldtally.llm.scratch import Scratch
from fieldtally.llm.sharding import shard_rows


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Target weights of the tree domain - language - source; nodes that are not named weigh 1.
WEIGHTS = {
    ("crawl",): 2, ("forum",): 3, ("library",): 5,
    **{(d, lang): w for d in ("crawl", "forum", "library") for lang, w in (("en", 5), ("de", 2), ("fr", 2), ("es", 1))},
}


def levels() -> dict[str, Column]:
    """The tables name no domain: the largest source is a crawl, odd ones forums, even ones libraries."""
    source = F.col("source")
    domain = F.when(source == "src0", "crawl").when(F.substring(source, -1, 1).isin(*"13579"), "forum").otherwise("library")
    return {"domain": domain, "lang": F.col("lang"), "source": source}


def op1_hierarchical_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    mixed = Mixture(docs, levels(), WEIGHTS).assign(docs)
    return mixed.select(
        "doc.doc_id", F.col("mix_domain").alias("domain"), F.col("mix_lang").alias("lang"), F.col("mix_source").alias("source"),
        "n_tokens", "leaf_budget", "copies", "partial_tokens",
    )


def op2_evidence_language(spark: SparkSession, sf: str) -> DataFrame:
    """The source is a document's host; its address is that of the page that shows it, if there is one."""
    shown = shown_documents(table(spark, sf, "pages")).select("doc_id", F.regexp_extract(urlrules.host_of(F.col("url")), "[^.]+$", 0).alias("suffix"))
    docs, addresses = table(spark, sf, "documents"), shown.where("suffix != ''")
    return identify(docs, F.col("text"), F.col("doc_id"), declared=F.col("lang"), host=F.col("source"), addresses=addresses)


def op3_divergence_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


def op4_framed_token_records(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    scratch = Scratch(spark, "records")
    index = records.write_records(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), scratch.folder("records"))
    return records.token_starts(records.read_records(index), scratch)


def shown_documents(pages: DataFrame) -> DataFrame:
    """(url, doc_id): a page's path ends in the id of the document it shows."""
    return pages.select("url", F.expr(r"try_cast(regexp_extract(url, '://[^/?#]*/[^/?#]*/([0-9]+)', 1) AS BIGINT)").alias("doc_id"))


def labelled_urls(spark: SparkSession, sf: str) -> DataFrame:
    """(url, bad): a page's document may have a label."""
    labels = table(spark, sf, "labels").groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return shown_documents(table(spark, sf, "pages")).join(labels, "doc_id").select("url", "bad")


def op5_association_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urlrules.judge(table(spark, sf, "pages"), labelled_urls(spark, sf), significant=True)


def op6_hypergeometric_shards(spark: SparkSession, sf: str) -> DataFrame:
    return shard_rows(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_chosen_path_neardup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents")).select(
        "doc.doc_id", "n_shingles", "component_id", "kept"
    )


def op8_chunked_warc(spark: SparkSession, sf: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    manifest = warc.write_archives(table(spark, sf, "pages"), scratch.folder("archives"), scratch)
    return warc.page_digests(warc.read_chunks(manifest, with_data=False))


def op9_kneser_ney_quality(spark: SparkSession, sf: str) -> DataFrame:
    good = table(spark, sf, "labels").where("quality = 1 and toxic = 0")
    return perplexity.score_words(table(spark, sf, "documents"), good)


def op10_winnowed_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("th")


def op11_bounded_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_threshold_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select("vec_id", label.alias("label"), whole_numbers(F.col("embedding"), 256).alias("vector"))
    return hard_negatives(rows, "vec_id", "label", "vector", F.col("vec_id") % 100 == 0)


def op13_iceberg_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence(table(spark, sf, "documents"))


WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {}

SQL["op7_chosen_path_neardup"] = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {WORDS.format(LOWERED.format('text'))} AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM docs),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM sets),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY ALL),
links AS MATERIALIZED (
    SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * common >= 85 * (s.n + t.n - common)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT a AS v, b AS r FROM both_ways UNION SELECT e.a, r FROM reach JOIN both_ways e ON e.b = v),
best AS (SELECT v, min(r) AS r FROM reach GROUP BY v)
SELECT s.doc_id, s.n AS n_shingles, coalesce(least(s.doc_id, r), s.doc_id) AS component_id,
    s.doc_id = coalesce(least(s.doc_id, r), s.doc_id) AS kept
FROM sizes s LEFT JOIN best ON v = s.doc_id
"""


# a 40-digit hexadecimal digest is eight groups of 20 bits, four letters each
SQL["op8_chunked_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM payloads),
firsts AS (SELECT hex, min(page_id) AS first FROM digests GROUP BY 1)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform(range(4), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 5 * i + 1, 5))::BIGINT >> (15 - 5 * k)) & 31)::BIGINT, 1)), '')), '')
        AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests JOIN firsts USING (hex)
"""


SQL["op10_winnowed_leaks"] = f"""
WITH docs AS (SELECT doc_id, {ALNUM.format(LOWERED.format('text'))} AS w FROM documents),
items AS (SELECT item_id, {ALNUM.format(LOWERED.format('text'))} AS w FROM benchmark),
wins AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
        unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS x
    FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
own AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p,
        unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS x
    FROM docs, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, p, n, item_id FROM own JOIN wins USING (n, x)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
lists AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN lists USING (doc_id)
"""


SQL["op12_threshold_negatives"] = """
WITH rows AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS own, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
    other AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT own AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


TERMS = r"regexp_extract_all({}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op13_iceberg_divergence"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {TERMS.format(LOWERED.format('text'))} AS w
    FROM documents),
found AS MATERIALIZED (
    SELECT lang, source, row, term, count(*) AS n FROM (SELECT lang, source, row, unnest(w) AS term FROM docs) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM found GROUP BY ALL HAVING count(*) >= 3),
counts AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS whole FROM kept GROUP BY 1),
groups AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(own, 0) AS own, whole
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s ON s.lang = g.lang
    LEFT JOIN (SELECT lang, source, sum(n) AS own FROM counts GROUP BY ALL) o ON o.lang = g.lang AND o.source = g.source),
shares AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)::HUGEINT) // (own + v)::HUGEINT)::BIGINT AS p,
        (1 + (1000000000::HUGEINT * (k.n + 1)::HUGEINT) // (whole + v)::HUGEINT)::BIGINT AS q
    FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_hierarchical_mixture, op2_evidence_language, op3_divergence_quality, op4_framed_token_records,
        op5_association_urls, op6_hypergeometric_shards, op7_chosen_path_neardup, op8_chunked_warc,
        op9_kneser_ney_quality, op10_winnowed_leaks, op11_bounded_packing, op12_threshold_negatives,
        op13_iceberg_divergence,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
