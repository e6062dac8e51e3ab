"""Token counts as delta-maintained rollups.

Changes arrive in batches of ``insert``, ``revise`` and ``delete`` events. A batch is turned into signed rows (a revision
takes back the old count and adds the new one), the signed rows into a small table of sums by source, language and tokenizer
version, and both are written under the batch's id. Totals are the sums over all committed batches, so nothing is recounted.

    <path>/changes/<number>-<batch>/bucket=B   signed rows, in hash buckets of the document id
    <path>/sums/<number>-<batch>               their sums; the batch is committed once this folder is finished
    <path>/standing/fold=N/bucket=B            the counts of a bucket that stand after batch N
    <path>/folds/N                             for every bucket, which fold holds it and up to which batch

A batch that was interrupted is written again from the start; one that is committed is never applied twice. After a batch the
buckets whose unfolded rows have outgrown a share of their standing rows, or lie in too many batches, are folded. A fold counts
once its folder under ``folds`` is finished; a job that ends before leaves the fold before it in force. So a commit reads the
buckets that its ids fall in, compares their rows with its own ids, and shuffles the rows of these ids only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from reviewlens.session import clear_scratch, scratch_path
from reviewlens.streaming.changes import finished

KEYS = ["source", "lang", "tokenizer"]


class TokenLedger:
    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 64, share: float = 0.25, max_batches: int = 16) -> None:
        """``id_type``: the type of ``doc_id``, for callers whose rows are told apart by more than a number. ``buckets``: of a new
        ledger, so many that a bucket's standing rows are a few GB at most; a ledger keeps the number it was made with.
        ``share`` of a bucket's standing rows may lie unfolded, in at most ``max_batches`` batches."""
        self.spark, self.path, self.id_type = spark, path.rstrip("/"), id_type
        self.buckets, self.share, self.max_batches = buckets, share, max_batches

    # -- what is there ---------------------------------------------------------------------

    def _folders(self) -> list[str]:
        """Folders of the committed batches, in order of their numbers."""
        return finished(self.spark, f"{self.path}/sums")

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return sorted(f.split("-", 1)[1] for f in self._folders())

    def _state(self) -> list[Row]:
        """bucket, upto, fold, n of the last fold that counts; one row a bucket, none before the first batch."""
        folds = finished(self.spark, f"{self.path}/folds")
        rows = self.spark.read.parquet(f"{self.path}/folds/{folds[-1]}").collect() if folds else []
        return sorted(rows, key=lambda r: r.bucket)

    def _write_state(self, number: int, rows: list[tuple[int, int, int, int]]) -> None:
        table = self.spark.createDataFrame(rows, "bucket int, upto int, fold int, n long")
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folds/{number:08d}")

    def _held(self, folder: str) -> list[int]:
        """Buckets that a folder has rows of, from its listing."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket="))

    def _schema(self) -> str:
        return f"doc_id {self.id_type}, source string, lang string, tokenizer string, tokens bigint, sign int, bucket int"

    def _rows(self, folder: str, only: list[int] | None = None) -> DataFrame | None:
        mine = [b for b in self._held(folder) if only is None or b in only]
        if not mine:
            return None
        return self.spark.read.schema(self._schema()).option("basePath", folder).parquet(*[f"{folder}/bucket={b}" for b in mine])

    def _unfolded(self, state: list[Row], only: list[int] | None = None) -> list[tuple[int, DataFrame]]:
        """Signed rows that no fold holds yet, by batch number."""
        out = []
        for folder in self._folders():
            number = int(folder.split("-", 1)[0])
            open_ = [r.bucket for r in state if r.upto < number and (only is None or r.bucket in only)]
            rows = self._rows(f"{self.path}/changes/{folder}", open_) if open_ else None
            if rows is not None:
                out.append((number, rows))
        return out

    def _signed(self, state: list[Row], only: list[int] | None = None) -> DataFrame:
        """Folded rows and unfolded signed rows, of some buckets or all."""
        parts = [rows for _, rows in self._unfolded(state, only)]
        for fold in sorted({r.fold for r in state if r.n}):
            rows = self._rows(f"{self.path}/standing/fold={fold}", [r.bucket for r in state if r.n and r.fold == fold and (only is None or r.bucket in only)])
            parts += [] if rows is None else [rows]
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else self.spark.createDataFrame([], self._schema())

    @staticmethod
    def _net(signed: DataFrame) -> DataFrame:
        """Signed rows that do not cancel."""
        cols = ["bucket", "doc_id", *KEYS, "tokens"]
        return signed.groupBy(*cols).agg(F.sum("sign").alias("n")).filter("n > 0").select(*cols)

    def current(self) -> DataFrame:
        """The counts that stand."""
        return self._net(self._signed(self._state())).drop("bucket")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches; groups that are back at zero are left out."""
        schema = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
        folders = self._folders()
        if not folders:
            return self.spark.createDataFrame([], schema)
        sums = self.spark.read.schema(schema).parquet(*[f"{self.path}/sums/{f}" for f in folders])
        out = sums.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return out.filter("n_docs <> 0 OR n_tokens <> 0")

    # -- writing ---------------------------------------------------------------------------

    def _dealt(self, rows: DataFrame, path: str) -> None:
        """Write rows by bucket; adaptive execution splits large buckets and joins small ones."""
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")

    def commit(self, batch: str, events: DataFrame) -> bool:
        """Apply a batch of events (op, doc_id, source, lang, tokenizer, tokens). False if it was committed before.

        ``insert`` and ``revise`` both set the count of (doc_id, tokenizer): whatever stands is taken back first, so an insert
        of a known document does not count twice. ``delete`` takes back what stands, of all tokenizers where its tokenizer is
        null. Of several events for one (doc_id, tokenizer) in a batch the last by (op, source, lang, tokens) holds, deletes
        before inserts before revisions. Null tokens count as 0; null ids, sources and languages are values of their own.
        Other columns are ignored; an empty batch commits without rows. Unknown ops raise.
        """
        if not batch or "/" in batch:
            raise ValueError("a batch id is a plain, non-empty name")
        if batch in self.batches():
            return False
        state = self._state()
        if not state:
            self._write_state(0, [(b, 0, 0, 0) for b in range(self.buckets)])
            state = self._state()
        folders = self._folders()
        number = int(folders[-1].split("-", 1)[0]) + 1 if folders else 1

        events = events.select(
            "op", F.col("doc_id").cast(self.id_type).alias("doc_id"), "source", "lang", "tokenizer",
            F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"),
        )
        known = F.when(F.col("op").isin("insert", "revise", "delete"), F.col("op")).otherwise(
            F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null"))))
        )
        arrived = scratch_path(self.spark, "ledger-events")
        self._dealt(events.withColumns({"op": known, "bucket": self._bucket(len(state))}), arrived)
        hit = self._held(arrived)
        schema = f"op string, doc_id {self.id_type}, source string, lang string, tokenizer string, tokens bigint, bucket int"
        events = self.spark.read.schema(schema).parquet(arrived) if hit else self.spark.createDataFrame([], schema)

        whole = events.filter("op = 'delete' AND tokenizer IS NULL").select("doc_id").distinct().withColumn("__gone", F.lit(True))
        keyed = events.filter("NOT (op = 'delete' AND tokenizer IS NULL)")
        last = keyed.groupBy("bucket", "doc_id", "tokenizer").agg(F.max(F.struct("op", "source", "lang", "tokens")).alias("e"))
        plus = last.filter("e.op <> 'delete'").select("bucket", "doc_id", "e.source", "e.lang", "tokenizer", "e.tokens", F.lit(1).alias("sign"))
        signed = plus
        if folders:
            ids = events.select("bucket", F.col("doc_id").alias("__id")).distinct()
            old = self._signed(state, hit).alias("o")
            met = old.join(ids.alias("i"), (F.col("o.bucket") == F.col("i.bucket")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
            touched = last.select(F.col("doc_id").alias("__id"), F.col("tokenizer").alias("__tk"), F.lit(True).alias("__hit"))
            gone = whole.select(F.col("doc_id").alias("__gid"), "__gone")
            minus = (
                self._net(met)
                .join(touched, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("tokenizer").eqNullSafe(F.col("__tk")), "left")
                .join(gone, F.col("doc_id").eqNullSafe(F.col("__gid")), "left")
                .filter("__hit OR __gone")
                .select("bucket", "doc_id", *KEYS, "tokens", F.lit(-1).alias("sign"))
            )
            signed = plus.unionByName(minus)
        folder = f"{number:08d}-{batch}"
        changes = f"{self.path}/changes/{folder}"
        self._dealt(signed, changes)
        rows = self._rows(changes)
        rows = self.spark.createDataFrame([], self._schema()) if rows is None else rows
        sums = rows.groupBy(*KEYS).agg(
            F.sum(F.col("sign").cast("long")).alias("n_docs"), F.sum(F.col("sign") * F.col("tokens")).alias("n_tokens")
        )
        sums.write.mode("overwrite").parquet(f"{self.path}/sums/{folder}")
        clear_scratch(self.spark, [arrived])
        self.fold_due()
        return True

    def fold_due(self) -> list[int]:
        """Fold the buckets that have outgrown their share; returns them. A bucket whose only rows are one batch stays as it is."""
        state = self._state()
        counts = {r.bucket: [0, 0] for r in state}
        for _, rows in self._unfolded(state):
            for r in rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a bucket, counted from file footers
                counts[r.bucket][0] += r.n
                counts[r.bucket][1] += 1
        standing = {r.bucket: r.n for r in state}
        due = [b for b, (n, k) in counts.items() if k and (k > self.max_batches or (k > 1 or standing[b]) and n > self.share * standing[b])]
        if due:
            self.fold(due)
        return due

    def fold(self, buckets: list[int]) -> None:
        """Write the standing rows of some buckets as one fold, then let it count."""
        state, number = self._state(), int(self._folders()[-1].split("-", 1)[0])
        path = f"{self.path}/standing/fold={number}"
        self._dealt(self._net(self._signed(state, buckets)).withColumn("sign", F.lit(1)), path)
        rows = self._rows(path)
        sizes = {} if rows is None else {r.bucket: r.n for r in rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
        self._write_state(number, [(r.bucket, number, number, sizes.get(r.bucket, 0)) if r.bucket in buckets else tuple(r) for r in state])
