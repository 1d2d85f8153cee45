"""The operators' registered queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.llm import chat, decontaminate, licenses, mixing, near_dup, negatives, periodic, quality, repair_tokens, sharding, topk, toxicity, warc
from tripwise.llm.common import crc_fold, ship, table, written

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def put(fn):
        @wraps(fn)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = shipped
        if sql:
            ORACLE[name] = sql
        return fn
    return put


@register("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) whose alignment shows a leak, with score and place."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_repair_tokens")
def op2_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids in Re-Pair shards, read back: place, number and crc32."""
    import public_tokenizers

    shards = repair_tokens.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return repair_tokens.read_tokens(shards)


def held_out(folds: int, rest: int):
    return crc_fold("doc_id", folds) == rest


@register("op3_fourier_quality")
def op3_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    out = held_out(quality.FOLDS, quality.HELD_OUT)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), ~out)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


@register("op4_segment_toxicity")
def op4_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, with its significant passages."""
    out = held_out(toxicity.FOLDS, toxicity.HELD_OUT)
    scored = toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~out)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"),
                         "evidence")


@register("op5_warc_normalise", f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM q)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES} AND page_id < last_id
                THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES} AND page_id < last_id THEN last_id END AS refers_to
    FROM g""")
def op5_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to monolithic archives, normalised to a member a record, read back by the index."""
    return warc.pages_to_warc(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_pfair_mix")
def op6_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mix of all sources (target weights: their block counts to the power 0.7)."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.octet_length("text").alias("mix_bytes"))
    return mixing.mix(docs, temperature=mixing.TEMPERATURE).select("doc_id", "source", "block", "slot", "slot_bytes", "exact_mix")


@register("op7_extendible_shards", sharding.oracle_sql())
def op7_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of at most 1 MiB of text."""
    return sharding.assign(sharding.hashed(table(spark, sf_dir, "documents")).select(
        "doc_id", "sh_hash", "sh_bytes")).select(
        "doc_id", "shard_id", "shard_depth", F.col("sh_bytes").alias("n_bytes"), "shard_bytes", "shard_rows")


@register("op8_order_minhash")
def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near-duplicates."""
    return near_dup.classes(table(spark, sf_dir, "documents"))


#: The contract's extra conversation.
EXTRA_ID, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"


def chat_digests(formatted: DataFrame) -> DataFrame:
    """The digest columns, computed from what the written output says."""
    turns, loss = F.col("_turns"), F.col("_loss")
    whole = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (formatted.withColumn("_turns", chat.parsed_turns(F.col("formatted"))).withColumn("_loss", chat.loss_text())
            .select("conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                    F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars")))


def _esc(col: str) -> str:
    return rf"regexp_replace({col}, '(\\|###|</turn>)', '\\\1', 'g')"


@register("op9_chat_fingerprint", f"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT {EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT {EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}'),
    g AS (SELECT conv_id, count(*)::BIGINT AS n_turns,
      string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS w,
      coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS l,
      sum(length('### ' || role) + 1 + length({_esc('text')}) + {len(chat.CLOSE)})::BIGINT AS formatted_chars
      FROM c GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(w) AS turns_sha256, length(l)::BIGINT AS loss_chars, sha256(l) AS loss_sha256,
           formatted_chars FROM g""")
def op9_chat_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted, written, read back and digested."""
    rows = table(spark, sf_dir, "conversations")
    extra = spark.range(2).select(
        F.lit(EXTRA_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    every = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    return chat_digests(written(chat.format_turns(chat.canonical_table(every))
                                .select("conv_id", "formatted", "loss_spans"), "chat"))


@register("op10_pivot_topk", """
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
               FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c::DOUBLE))) = 0),
    s AS (SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(list_zip(q.x, r.x), lambda z: z[1] * z[2]))::BIGINT AS score
          FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id AND len(q.x) = len(r.x)),
    o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 5""")
def op10_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of largest inner product with every vector whose id is divisible by 50."""
    rows = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


@register("op11_cluster_negatives", """
    WITH r AS (SELECT vec_id, label::BIGINT AS label, embedding FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c::DOUBLE))) = 0),
    d AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, embedding) = 1),
    v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM d),
    s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
                 list_sum(list_transform(list_zip(a.x, r.x), lambda z: z[1] * z[2]))::BIGINT AS score
          FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.x) = len(r.x)),
    p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, p.vec_id AS positive_id,
           row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
           s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT s.alike AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
    QUALIFY rank <= 5""")
def op11_cluster_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives for each of the five positives of every anchor (ids divisible by 100)."""
    rows = negatives.integer_vectors(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.mine(rows, rows.filter(F.col("vec_id") % 100 == 0))


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text) by the contract: in every tenth document by hash the words from a on repeat the first p of them."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", text.alias("text"), words.alias("w"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    made = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest))
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@register("op12_cover_runs")
def op12_cover_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and the digest of its text without their repeats."""
    found = periodic.find_runs(planted_periods(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register("op13_license_diagonals", licenses.oracle_sql())
def op13_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))
