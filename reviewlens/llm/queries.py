"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import bpe, chat, compression, extendible, hash_tree, lexical, main_text, mixing, near_dup, quality, repair, rollup, spotsigs
from reviewlens.llm.common import table, word_count, written
from reviewlens.session import configure, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_hash_tree_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: DuckDB has no CRC-32. Tests compare with a brute-force version."""
    return hash_tree.shard_documents(table(spark, sf_dir, "documents"))


@query("op2_adaptive_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: tests compare with a brute-force version."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op3_compression_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: a trained model. Tests hold it to an accuracy on held-out labels."""
    return compression.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op4_extendible_hash_dedup",
    """
    WITH n AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents),
    g AS (
      SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
             row_number() OVER (PARTITION BY norm, doc_id) AS again
      FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AND again = 1 AS kept, sha256(norm) AS text_sha256 FROM g
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible.flag_copies(table(spark, sf_dir, "documents"))


@query(
    "op5_mix_sources",
    """
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (
      SELECT source, source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM s),
    o AS (SELECT *, 2::DOUBLE * source_size / weight AS stop FROM w),
    l AS (
      SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)::BIGINT
                 - 2::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
                / (sum(weight) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
      FROM o),
    t AS (
      SELECT source, source_size, least(2::DOUBLE * source_size, coalesce(weight * (
               SELECT level FROM l WHERE level <= stop ORDER BY stop, source NULLS LAST LIMIT 1), 2::DOUBLE * source_size)) AS target
      FROM l),
    r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
    c AS (
      SELECT d.doc_id, d.size, r.source_size, r.target,
             (floor(r.rate) + CASE WHEN (('0x' || substr(md5('mix-1/' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE)
                  / 281474976710656::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END)::BIGINT AS copies
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
    SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


CONTROL = "</s>[INST] ok [/INST]"


@query(
    "op7_chat_events",
    """
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v(a, b, c, d)),
    e AS (
      SELECT *, length(replace(replace(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<s>', '<_s>'), '</s>', '<_/s>'),
                  '[INST]', '[_INST]'), '[/INST]', '[_/INST]')) AS role_chars,
             length(replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '<s>', '<_s>'), '</s>', '<_/s>'),
                  '[INST]', '[_INST]'), '[/INST]', '[_/INST]')) AS text_chars
      FROM t)
    SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(role_chars + text_chars + 20)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{CONTROL}'), (-7L, 1L, 'assistant', '{CONTROL}') AS v(conv_id, turn, role, text)")
    return chat.digest(chat.format_conversations(turns.unionByName(more)))


@query(
    "op10_token_rollups",
    """
    SELECT d.source, d.lang, 'words-1' AS tokenizer, count(*) AS n_docs,
           sum(len(regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+')))::BIGINT AS n_tokens
    FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
    GROUP BY d.source, d.lang
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted with an estimate from their length, revised to exact counts, and the toxic ones deleted.
    Each batch arrives twice, as after a retry; the second time changes nothing. Every row counts, also where rows share an id
    or have none: a row's key is its values and its number among equal rows."""
    docs = table(spark, sf_dir, "documents")
    ledger = rollup.TokenLedger(spark, scratch_path(spark, "token-ledger"), "string")
    values = ["doc_id", "source", "lang", "guess", "words"]
    counted = docs.select("doc_id", "source", "lang", F.floor(F.col("n_chars") / 6).alias("guess"), word_count(F.col("text")).alias("words"))
    equal = counted.groupBy(*values).agg(F.count(F.lit(1)).alias("n"))
    numbered = equal.select(*values, F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("n"))
    key = F.to_json(F.struct(*values, "n"))
    base = written(numbered.select(key.alias("key"), *values, F.lit("words-1").alias("tokenizer")), "token-rows")
    first = base.select(F.lit("insert").alias("op"), F.col("key").alias("doc_id"), "source", "lang", "tokenizer", F.col("guess").alias("tokens"))
    exact = base.select(F.lit("revise").alias("op"), F.col("key").alias("doc_id"), "source", "lang", "tokenizer", F.col("words").alias("tokens"))
    none = F.lit(None).cast("string")
    toxic = base.select("doc_id", "key").join(table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    drops = toxic.select(F.lit("delete").alias("op"), F.col("key").alias("doc_id"), none.alias("source"), none.alias("lang"), none.alias("tokenizer"), F.lit(0).alias("tokens"))
    for batch, events in (("1-load", first), ("2-exact", exact), ("3-takedown", drops)):
        ledger.commit(batch, events)
        ledger.commit(batch, events)
    return ledger.totals()


#: The tokenizer file; every machine has the package installed.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query("op9_backtracking_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: tests compare with the tokenizers library."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op6_dom_main_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: a trained model. Tests compare with the known articles of fixtures and of the pages' landmarks."""
    return main_text.extract(table(spark, sf_dir, "pages"))


@query("op8_hyperminhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: tests compare with the exact links of all pairs on small tables."""
    return near_dup.components_of(table(spark, sf_dir, "documents"), size=2)


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query(
    "op11_lexical_search",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
    s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_all FROM d WHERE len(ts) > 0),
    q AS (
      SELECT i, item_id, term, count(*) AS times FROM (
        SELECT i, item_id, unnest(ts) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS ts FROM benchmark)) GROUP BY ALL),
    t AS (
      SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    w AS (
      SELECT term, floor(1000::DOUBLE * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
    p AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_all))) AS points FROM t JOIN w USING (term), s),
    c AS (SELECT i, item_id, r, doc_id, sum(times * points)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY ALL)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0) WHERE rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_spot_signatures")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: signatures are hashed. Tests compare with a brute-force version."""
    return spotsigs.with_next(table(spark, sf_dir, "documents"))


@query("op13_structure_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No twin: a CRC and the cheapest of all edits. Tests compare with all edits of small conversations."""
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))
