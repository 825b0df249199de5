"""One query per operator over the given tables, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.llm import (
    alignment,
    conversations,
    mixing,
    packing,
    quality,
    simhash,
    substring_dedup,
    token_counts,
    token_files,
    topk,
    url_filters,
    warc,
    window_packing,
)
from labelflow.llm.common import table, text_or_empty
from labelflow.storage import materialise, scratch_dir

#: Tokenizer files, found when a query runs.
WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
CAPACITY, PACK_END, FILE_END = 4096, 1, 2
WINDOW = 2048
#: Each turn of a conversation has one of so many fates.
FATES = 20
TOKEN_LIMIT = 1024
NEIGHBOURS, QUERY_EVERY, SCALE = 10, 100, 1024
LEAST_REVISIT_BYTES = 0
SHINGLE, RADIUS = 3, 2
MIX = mixing.Mix()

#: Fixed rules of hosts and paths, and general patterns for all other URLs.
HOST_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
PATTERNS = [
    ("?utm_source=feed", "block"),
    ("?page=*&ref=", "block"),
    ("/wp-admin/", "block"),
    ("/cgi-bin/", "block"),
    ("/login^", "block"),
    ("||ads.*^", "block"),
    ("||m.*.example.net/en/", "block"),
    (".xml|", "block"),
    ("||blog.*/en/*?page=*&ref=", "allow"),
]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def url_rules() -> list[url_filters.Rule]:
    return [url_filters.Rule.of_host(*r) for r in HOST_RULES] + [
        url_filters.Rule.of_pattern(*r) for r in PATTERNS
    ]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filters.judge_urls(pages, ["page_id"], "url", url_rules())
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    judged = quality.judge(docs, ["doc_id"], "text", model)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "probability")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents"), ["doc_id"], "text")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), "doc_id", "text",
        tokenizer_path(WORD_BPE), PACK_END, CAPACITY,
    )
    return packed.withColumnRenamed("key", "doc_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark)
    index = warc.write_archives(
        table(spark, sf_dir, "pages"), "page_id", "url", "html", folder, LEAST_REVISIT_BYTES
    )
    return warc.read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, "doc_id", "text", SHINGLE, RADIUS)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), ["doc_id"], "text", tokenizer_path(BYTE_BPE)
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
        F.col("vec_id") % QUERY_EVERY == 0, NEIGHBOURS, SCALE,
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_dir(spark)
    token_files.write_token_files(
        docs, "doc_id", "text", tokenizer_path(WORD_BPE), FILE_END, folder
    )
    found = token_files.read_token_files(spark, folder, docs, "doc_id")
    return found.withColumnRenamed("key", "doc_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = materialise(
        table(spark, sf_dir, "documents").select(
            "doc_id", "source", mixing.words("text").alias("size"),
            F.xxhash64(text_or_empty("text")).alias("tie"),
        )
    )
    taken = mixing.copies(sized, "source", "size", [F.col("doc_id"), F.col("tie")], MIX)
    return taken.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = window_packing.pack_windows(
        table(spark, sf_dir, "documents"), "doc_id", "text",
        tokenizer_path(BYTE_BPE), PACK_END, WINDOW,
    )
    return packed.withColumnRenamed("key", "doc_id")


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with a fault in some turns: lost (column gone), emptied,
    without ends of sentences, repeated, or with another role."""
    name = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    fate = F.crc32(name) % FATES
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fate == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("copy"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    blocks = conversations.repair(rows, "conv_id", "turn", "role", "text", F.col("gone"))
    return conversations.reports(blocks).withColumnRenamed("key", "conv_id")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(
        table(spark, sf_dir, "documents"), "doc_id", "text",
        tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE),
    )
    return aligned.withColumnRenamed("key", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_quality_rules, op3_substring_dedup, op4_best_fit_packing, op5_warc,
        op6_simhash_near_dedup, op7_token_counts, op8_exact_top_k, op9_token_files, op10_mixing,
        op11_window_packing, op12_conversation_repair, op13_tokenizer_alignment,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_sql() -> str:
    hosts = "\n".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p, _ in sorted(HOST_RULES, key=lambda r: -len(r[0] + r[1]))
    )
    actions = "\n".join(f"WHEN rule = '{h}{p}' THEN '{a}'" for h, p, a in HOST_RULES)
    patterns = "\n".join(
        f"WHEN regexp_matches(whole, '^(?s:{r.regex})') THEN '{r.name}'".replace(r"\Z", r"\z")
        for r in sorted((url_filters.Rule.of_pattern(*p) for p in PATTERNS), key=lambda r: r.rank)[::-1]
    )
    by_pattern = "\n".join(f"WHEN pattern = '{p}' THEN '{a}'" for p, a in PATTERNS)
    return f"""
    WITH a AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    b AS (SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS h FROM a),
    c AS (SELECT page_id, {_LOWER.format("h")} AS host, substr(coalesce(rest, ''), length(h) + 1) AS tail FROM b),
    d AS (SELECT page_id, host, regexp_extract(tail, '^[^?#]*') AS path, '.' || host || tail AS whole FROM c),
    e AS (SELECT *, CASE {hosts} END AS rule FROM d),
    f AS (SELECT *, CASE WHEN rule IS NULL AND whole <> '.' THEN CASE {patterns} END END AS pattern FROM e)
    SELECT page_id, host, path, rule, pattern,
        CASE {actions} {by_pattern} ELSE 'allow' END AS verdict
    FROM f"""


_WARC_SQL = f"""
    WITH a AS (
        SELECT page_id, coalesce(html, '') AS payload, row_number() OVER () AS r FROM pages),
    b AS (SELECT page_id, r, strlen(payload) AS n, sha1(payload) AS hex FROM a),
    c AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS first_page
          FROM b WINDOW w AS (PARTITION BY hex ORDER BY page_id DESC NULLS LAST, r DESC)),
    d AS (SELECT *, [CAST('0x' || substr(hex, 1 + 5 * i, 5) AS BIGINT) FOR i IN range(0, 8)] AS parts FROM c)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
        list_aggregate([
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(1 + ((parts[1 + i // 4] >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)
            FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
        CASE WHEN k > 1 AND n >= {LEAST_REVISIT_BYTES} THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN k > 1 AND n >= {LEAST_REVISIT_BYTES} THEN first_page END AS refers_to
    FROM d"""

_TOP_K_SQL = f"""
    WITH a AS (
        SELECT row_number() OVER () AS r, vec_id,
            [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    b AS (
        SELECT q.r, q.vec_id AS query_id, c.vec_id,
            CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score, c.r AS cr
        FROM a q, a c WHERE q.vec_id % {QUERY_EVERY} = 0 AND q.r <> c.r)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, cr) AS rank FROM b)
    WHERE rank <= {NEIGHBOURS}"""


def _mix_sql(mix: mixing.Mix) -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mix.weights))
    return f"""
    WITH sized AS (
        SELECT doc_id, source,
            CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
        FROM documents),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.weights)} {weights} END AS w
        FROM sized GROUP BY source),
    limits AS (SELECT *, CAST({mix.most} * source_size AS DOUBLE) AS most FROM sources),
    steps AS (
        SELECT coalesce(sum(most) OVER before, 0) AS capped,
            sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weights,
            {mix.share} * sum(source_size) OVER () AS amount
        FROM limits
        WINDOW before AS (ORDER BY most / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (
        SELECT CAST(amount - capped AS DOUBLE) AS rest, CAST(weights AS DOUBLE) AS weights
        FROM steps ORDER BY (amount - capped) / weights DESC LIMIT 1),
    targets AS (
        SELECT source, source_size, least(most, rest * CAST(w AS DOUBLE) / weights) AS target
        FROM limits, level),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS k FROM sized),
    rates AS (
        SELECT r.*, source_size, target, coalesce(target / nullif(source_size, 0), 0) AS rate
        FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
        CAST((floor(rate * (k + 1) + {mix.offset!r}) - floor(rate * k + {mix.offset!r})) * size AS BIGINT) AS taken
    FROM rates"""


ORACLE = {
    "op1_url_filters": _url_sql(),
    "op5_warc": _WARC_SQL,
    "op8_exact_top_k": _TOP_K_SQL,
    "op10_mixing": _mix_sql(MIX),
}
