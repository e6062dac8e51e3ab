"""Quality rules with thresholds that adapt to each language and source.

Word statistics of every text are computed once. For each measure, quantile sketches are kept per language and source:
counts of documents in buckets whose widths grow by a fixed factor, so sketches merge by adding counts and any quantile is
known to within the factor. Limits come from the sketches alone. Most texts have no symbols and repeat nothing, so a rate is
cut where its sketch has a gap: the first place above the median where neighbouring occupied buckets are far apart, beyond
what single occurrences in a document of typical length can make. The length of words has a spread, and its limit is the
median plus a multiple of the distance to the lower quartile. Junk in up to half of a group moves neither the median nor what
lies below it. Documents are joined with the limits of their group and filtered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from reviewlens.llm.common import map_batches, rows_of, salted_lookup, written

#: Fixed by the statistics' definition.
SYMBOLS = b"#*$%&|<>"
#: Buckets grow by this factor; the first one holds everything up to LEAST.
GROWTH, LEAST = 1.02, 1e-4
#: Measures that are judged from above.
MEASURES = ["symbol_rate", "dup_line_rate", "repeat_rate", "word_length"]
#: Rates, and what one occurrence is: so many parts of the median of a size. A repeat takes two windows of three words.
UNITS = {"symbol_rate": ("n_words", 1), "dup_line_rate": ("n_lines", 1), "repeat_rate": ("n_words", 6)}
#: A gap is a factor of at least this between neighbouring occupied buckets; values below one occurrence count as one.
GAP = 4.0
#: The limit of word length is the group's median plus FENCE times the distance between lower quartile and median, its own or
#: its language's, at least MARGIN characters.
FENCE, MARGIN = 12.0, 0.5
#: Groups with more documents stand by their own rates; smaller ones take the higher limit of their own and their language's.
ENOUGH = 300
#: Groups with fewer documents use the merged sketch of their language, and languages with fewer that of all documents.
MIN_DOCS = 30


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which is found at least twice."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    ids: dict[tuple, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in windows), np.int64, len(windows))
    again = np.bincount(code)[code] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + len(windows)] |= again
    return int(hit.sum())


def text_stats(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()  # bytes split at space and 9 to 13, exactly the white space meant here
    joined = b"".join(words)
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), len(joined.decode("utf-8", "replace")), symbols, len(lines) - len(set(lines)), _repeat_words(words)


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def document_stats(docs: DataFrame, extra: list[str]) -> DataFrame:
    """``extra`` columns of docs, the five statistics, and the number of lines with a word."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = rows_of(batch.column(batch.num_columns - 1))
        stats = np.array([text_stats(t) for t in texts], np.int64).reshape(len(texts), 5)
        lines = np.array([sum(1 for x in t.split(b"\n") if x.strip()) for t in texts], np.int64)
        cols = [*batch.columns[:-1], *[pa.array(stats[:, k]) for k in range(5)], pa.array(lines)]
        return pa.RecordBatch.from_arrays(cols, [*extra, *STATS, "n_lines"])

    kinds = [docs.schema[c] for c in extra] + [T.StructField(c, T.LongType()) for c in [*STATS, "n_lines"]]
    return map_batches(docs.select(*extra, "text"), run, T.StructType(kinds))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _rate(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def measures() -> dict[str, Column]:
    return {
        "symbol_rate": _rate("n_symbols", "n_words"),
        "dup_line_rate": _rate("n_dup_lines", "n_lines"),
        "repeat_rate": _rate("n_repeat_words", "n_words"),
        "word_length": _rate("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """Bucket 0 holds values up to LEAST; bucket k those up to LEAST * GROWTH^k."""
    return F.when(value <= LEAST, 0).otherwise(F.ceil(F.log(value / LEAST) / F.log(F.lit(GROWTH)))).cast("int")


def sketches(stats: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, bucket, n): additive, so sketches of parts, groups and days merge by summing ``n``."""
    values = measures() | {c: F.col(c) for c in ("n_words", "n_lines")}
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(v).alias("bucket")) for m, v in values.items()])
    return (
        stats.withColumn("__cells", cells)
        .select(*keys, F.explode("__cells").alias("c"))
        .groupBy(*keys, "c.measure", "c.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(sketch: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """(keys, measure, n, one column per quantile): the upper end of the bucket in which the quantile lies."""
    part = Window.partitionBy(*keys, "measure")
    run = part.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    end = F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(F.lit(LEAST) * F.pow(F.lit(GROWTH), F.col("bucket")))
    ranked = sketch.withColumn("__upto", F.sum("n").over(run)).withColumn("__all", F.sum("n").over(part)).withColumn("__end", end)
    pick = [F.min(F.when(F.col("__upto") >= F.ceil(F.col("__all") * q), F.col("__end"))).alias(name) for name, q in at.items()]
    return ranked.groupBy(*keys, "measure").agg(F.sum("n").alias("n"), *pick)


def bucket_end(k: Column) -> Column:
    return F.when(k <= 0, F.lit(0.0)).otherwise(F.lit(LEAST) * F.pow(F.lit(GROWTH), k))


def gap_limits(sketch: DataFrame, keys: list[str], gap: float = GAP) -> DataFrame:
    """(keys, measure, n, top): where each rate is cut.

    One occurrence is a part of the median size of the group's documents. The first gap at or above the median cuts at the
    geometric mean of its two sides; without one the limit is the highest value there is, and nothing is cut.
    """
    sizes = quantiles(sketch.filter(F.col("measure").isin("n_words", "n_lines")), keys, {"mid": 0.5})
    sizes = sizes.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("measure").alias("__size"), "mid")
    unit_of = F.create_map(*[F.lit(x) for m, (size, _) in UNITS.items() for x in (m, size)])[F.col("measure")]
    parts = F.create_map(*[F.lit(x) for m, (_, n) in UNITS.items() for x in (m, float(n))])[F.col("measure")]
    same = F.col("__size") == unit_of
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    rates = sketch.filter(F.col("measure").isin(*UNITS)).join(sizes, same).withColumn("__unit", parts / F.greatest("mid", F.lit(1.0)))
    part = Window.partitionBy(*keys, "measure")
    order = part.orderBy("bucket")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    low = F.greatest(bucket_end(F.col("bucket")), "__unit")
    high = bucket_end(F.lead("bucket").over(order) - 1)
    wide = (2 * upto >= F.sum("n").over(part)) & (high >= F.lit(gap) * low)
    seen = rates.withColumn("__cut", F.when(wide, F.struct("bucket", F.sqrt(low * high).alias("at"))))
    cut = F.min("__cut")["at"]
    return seen.groupBy(*keys, "measure").agg(F.sum("n").alias("n"), F.coalesce(cut, F.max(bucket_end(F.col("bucket")))).alias("top"))


def limits(stats: DataFrame, fence: float = FENCE, min_docs: int = MIN_DOCS, enough: int = ENOUGH, gap: float = GAP) -> DataFrame:
    """(lang, source, max_<measure> ...): one row per language and source.

    The tables here have one row per group, measure and bucket (about two thousand buckets at most), however many documents
    there are. Groups below ``min_docs`` use the merged sketch of their language, languages below that the one of all.
    """
    fine = written(sketches(stats, ["lang", "source"]), "quality-sketches")
    by_lang = fine.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    overall = fine.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))

    def limit(sketch: DataFrame, keys: list[str], name: str) -> DataFrame:
        q = quantiles(sketch.filter(F.col("measure") == "word_length"), keys, {"q25": 0.25, "mid": 0.5})
        spread = q.select(*keys, "measure", "n", "mid", F.greatest(F.lit(fence) * (F.col("mid") - F.col("q25")), F.lit(MARGIN)).alias("reach"))
        rates = gap_limits(sketch, keys, gap).select(*keys, "measure", "n", F.col("top").alias("mid"), F.lit(0.0).alias("reach"))
        both = rates.unionByName(spread)
        return both.select(*[F.col(k).alias(f"__{name}_{k}") for k in keys], *[F.col(c).alias(f"__{name}_{c}") for c in ("measure", "n", "mid", "reach")])

    own, lang, every = limit(fine, ["lang", "source"], "own"), limit(by_lang, ["lang"], "lang"), limit(overall, [], "all")
    joined = own.join(lang, F.col("__own_lang").eqNullSafe(F.col("__lang_lang")) & (F.col("__own_measure") == F.col("__lang_measure"))).join(
        every, F.col("__own_measure") == F.col("__all_measure")
    )
    own_top, lang_top, all_top = (F.col(f"__{name}_mid") + F.col(f"__{name}_reach") for name in ("own", "lang", "all"))
    spread = F.col("__own_measure") == "word_length"
    small = F.when(spread, F.col("__own_mid") + F.greatest("__own_reach", "__lang_reach")).when(F.col("__own_n") >= enough, own_top).otherwise(F.greatest(own_top, lang_top))
    chosen = F.when(F.col("__own_n") >= min_docs, small).when(F.col("__lang_n") >= min_docs, lang_top).otherwise(all_top)
    return joined.groupBy(F.col("__own_lang").alias("lang"), F.col("__own_source").alias("source")).agg(
        *[F.max(F.when(F.col("__own_measure") == m, chosen)).alias(f"max_{m}") for m in MEASURES]
    )


def judge(docs: DataFrame, **options) -> DataFrame:
    """doc_id, the five statistics, base_failed, kept, and the four measures with the limits they were held against.

    Null and empty texts have no words and fail. Null languages and sources are groups of their own. Repeated rows are each
    judged and counted. Other columns are ignored; an empty table gives an empty result.
    """
    stats = written(document_stats(docs, ["doc_id", "lang", "source"]), "quality-stats")
    judged = salted_lookup(stats, limits(stats, **options), ["lang", "source"], F.col("doc_id"))
    values = measures()
    within = F.lit(True)
    for m, v in values.items():
        within = within & (v <= F.col(f"max_{m}"))
    return judged.select(
        "doc_id",
        *STATS,
        base_failed().alias("base_failed"),
        (~base_failed() & within).alias("kept"),
        *[v.alias(m) for m, v in values.items()],
        *[f"max_{m}" for m in values],
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns, whatever these are called.

    Verdicts are joined by id: a repeated id passes if one of its rows does, and so do the rows without an id. Null and empty
    texts fail; an empty table gives an empty result.
    """
    good = judge(docs, **options).filter("kept").select(F.col("doc_id").alias("__good")).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(good["__good"]), "left_semi")
