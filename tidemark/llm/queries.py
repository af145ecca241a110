"""Registered queries of the corpus operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import capfilters, counts, decontamination, jaccard, language, licenses, merkle, mixing, negatives, packed, sharding, substrings, toxicity
from tidemark.llm.common import free_name, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f
    return add


def byte_bpe() -> str:
    """The vocabulary file of the token queries; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


BYTE_BPE_IDS = 50_257
END_ID = 2


@query()
def op1_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = packed.write_blocks(table(spark, sf_dir, "documents"), byte_bpe(), END_ID, BYTE_BPE_IDS)
    return packed.read_documents(blocks)


@query()
def op3_token_count_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(table(spark, sf_dir, "documents"), byte_bpe())


@query()
def op4_spherical_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query(decontamination.oracle())
def op8_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(licenses.oracle("""
    SELECT doc_id, source || '/' || lang || '/' || (doc_id // 100) || '/' || CASE WHEN regexp_matches(split_part(ltrim(text, chr(10)), chr(10), 1), '"""
                       + licenses.CUE + """') THEN 'LICENSE' ELSE doc_id || '.txt' END AS path, text FROM documents"""))
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: a text lies in a folder of its source, language and hundred of ids, and one
    whose first line is a notice stands for the licence file of that folder."""
    first = F.substring_index(F.expr("ltrim('\n', text)"), "\n", 1)
    name = F.when(first.rlike(licenses.CUE), "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws(
        "/", "source", "lang", F.expr("cast(doc_id div 100 as string)"), name).alias("path"))
    return licenses.scan(docs)


#: The tree of the mixing query. The table names no domain: four are formed from the source's number.
MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {("d0",): 4, ("d1",): 3, ("d2",): 2, ("d3",): 1,
               (None, "en"): 5, (None, "de"): 3, (None, "fr"): 2, (None, "es"): 1}
MIX_EPOCHS = 2
MIX_SEED = 17


def with_domain(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a domain, and that column's name."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int")
    name = free_name(docs, "domain")
    return docs.withColumn(name, F.concat(F.lit("d"), F.coalesce(number, F.lit(0)) % 4)), name


@query("""
    WITH rows AS (
        SELECT doc_id, lang, source, 'd' || coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT), 0) % 4 AS domain,
               len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\x0B]+'))::BIGINT AS tokens FROM documents),
    total AS (SELECT sum(tokens)::HUGEINT // 2 AS budget FROM rows),
    leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * 2 AS room FROM rows GROUP BY ALL),
    d0 AS (SELECT domain, sum(room)::HUGEINT AS room, CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END::HUGEINT AS w,
                  (SELECT budget FROM total) AS budget FROM leaves GROUP BY 1),
    d1 AS (SELECT *, budget - (sum(room) OVER o - room) AS lft, sum(w) OVER () - sum(w) OVER o + w AS rest FROM d0
           WINDOW o AS (ORDER BY room::DOUBLE / w, domain ROWS UNBOUNDED PRECEDING)),
    d2 AS (SELECT *, room * rest <= lft * w AS f FROM d1),
    d3 AS (SELECT domain, CASE WHEN f THEN room ELSE (budget - coalesce(sum(room) FILTER (f) OVER (), 0)) * (sum(w) FILTER (NOT f) OVER o) // sum(w) FILTER (NOT f) OVER ()
                  - (budget - coalesce(sum(room) FILTER (f) OVER (), 0)) * (sum(w) FILTER (NOT f) OVER o - w) // sum(w) FILTER (NOT f) OVER () END::HUGEINT AS share
           FROM d2 WINDOW o AS (ORDER BY room::DOUBLE / w, domain ROWS UNBOUNDED PRECEDING)),
    l0 AS (SELECT domain, lang, sum(room)::HUGEINT AS room, CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END::HUGEINT AS w,
                  any_value(share) AS budget FROM leaves JOIN d3 USING (domain) GROUP BY 1, 2),
    l1 AS (SELECT *, budget - (sum(room) OVER o - room) AS lft, sum(w) OVER p - sum(w) OVER o + w AS rest FROM l0
           WINDOW p AS (PARTITION BY domain), o AS (PARTITION BY domain ORDER BY room::DOUBLE / w, lang ROWS UNBOUNDED PRECEDING)),
    l2 AS (SELECT *, room * rest <= lft * w AS f FROM l1),
    l3 AS (SELECT domain, lang, CASE WHEN f THEN room ELSE (budget - coalesce(sum(room) FILTER (f) OVER p, 0)) * (sum(w) FILTER (NOT f) OVER o) // sum(w) FILTER (NOT f) OVER p
                  - (budget - coalesce(sum(room) FILTER (f) OVER p, 0)) * (sum(w) FILTER (NOT f) OVER o - w) // sum(w) FILTER (NOT f) OVER p END::HUGEINT AS share
           FROM l2 WINDOW p AS (PARTITION BY domain), o AS (PARTITION BY domain ORDER BY room::DOUBLE / w, lang ROWS UNBOUNDED PRECEDING)),
    s0 AS (SELECT domain, lang, source, tokens, room, 1::HUGEINT AS w, share AS budget FROM leaves JOIN l3 USING (domain, lang)),
    s1 AS (SELECT *, budget - (sum(room) OVER o - room) AS lft, sum(w) OVER p - sum(w) OVER o + w AS rest FROM s0
           WINDOW p AS (PARTITION BY domain, lang), o AS (PARTITION BY domain, lang ORDER BY room::DOUBLE / w, length(source) || ':' || source ROWS UNBOUNDED PRECEDING)),
    s2 AS (SELECT *, room * rest <= lft * w AS f FROM s1),
    s3 AS (SELECT domain, lang, source, tokens, CASE WHEN f THEN room ELSE (budget - coalesce(sum(room) FILTER (f) OVER p, 0)) * (sum(w) FILTER (NOT f) OVER o) // sum(w) FILTER (NOT f) OVER p
                  - (budget - coalesce(sum(room) FILTER (f) OVER p, 0)) * (sum(w) FILTER (NOT f) OVER o - w) // sum(w) FILTER (NOT f) OVER p END::HUGEINT AS share
           FROM s2 WINDOW p AS (PARTITION BY domain, lang), o AS (PARTITION BY domain, lang ORDER BY room::DOUBLE / w, length(source) || ':' || source ROWS UNBOUNDED PRECEDING)),
    plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS epochs,
                    CASE WHEN tokens > 0 THEN share % tokens ELSE share END AS remains FROM s3),
    run AS (SELECT doc_id, domain, lang, source, tokens, epochs, remains,
                   sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || epochs || ':' || doc_id)) AS upto
            FROM rows JOIN plan USING (domain, lang, source))
    SELECT doc_id, domain, lang, source, tokens AS n_tokens, (epochs + (upto <= remains)::INT)::INT AS copies
    FROM run WHERE epochs + (upto <= remains)::INT > 0""")
def op10_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, domain = with_domain(table(spark, sf_dir, "documents"))
    docs = docs.select("doc_id", F.col(domain).alias("domain"), "lang", "source", mixing.word_count().alias("n_tokens"))
    return mixing.mix(docs, MIX_LEVELS, MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED, tokens=F.col("n_tokens"))


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query(merkle.ORACLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 3 divides the checksum of the id, the candidate leaf is that of a text with its A-Z lowered."""
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    docs = docs.withColumn("changed", F.when(hit, lowered).otherwise(F.col("text")))
    built = merkle.manifest(docs, "doc_id", "lang", LEAF_FIELDS, merkle.leaf([*LEAF_FIELDS[:-1], "changed"]))
    return merkle.proofs(built).withColumnRenamed("key", "doc_id")


SHARDS = 8


@query()
def op12_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    stored = sharding.shards(table(spark, sf_dir, "documents"), SHARDS, size, F.col("text"), "doc_id")
    text = F.coalesce("row.text", F.lit(""))
    rows = stored.select("row.doc_id", F.col("_size").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                         F.lit("bytes").alias("law"), "_shard", "_run", "_at")
    return sharding.slots(stored, rows).select(
        "doc_id", "size", "text_crc32", "law", F.col("_shard").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("""
    WITH good AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
        FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
           n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
    QUALIFY rank <= 10""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides the id, the label is first moved on by one of ten."""
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, F.col("vec") % 100 == 0)
