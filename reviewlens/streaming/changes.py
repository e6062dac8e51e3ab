"""A table of changes that keeps itself small: rows land per batch in hash buckets of their key and are folded bucket by bucket.

    <path>/batch_id=N/bucket=B     what batch N brought, the latest row per key
    <path>/_base/fold=N/bucket=B   the latest row per key of a bucket up to batch N
    <path>/_folds/commit=N         for every bucket, which fold holds it and up to which batch

The job that appends a batch also folds those buckets whose unfolded changes have outgrown a share of what is folded, or lie
in too many batches. A fold counts once its commit folder is finished; before that readers use the commit before, after it
the new one, so a job that ends at any point leaves a table that reads the same. Readers rank the unfolded changes only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators.dedup import keep_top

#: Buckets of a new table. A table keeps the number that it was first folded with.
BUCKETS = 16


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def finished(spark: SparkSession, path: str) -> list[str]:
    """Finished folders under a path, by name."""
    at, fs = _path(spark, path)
    if not fs.exists(at):
        return []
    done = lambda p: fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() and done(s.getPath()))


def _numbers(names: list[str], kind: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))


class ChangeTable:
    """Latest row per key of everything appended. ``order`` names columns of which the larger wins; then the later batch does.

    ``share`` of a bucket's folded rows may lie unfolded, in at most ``max_batches`` batches.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str] | None = None, buckets: int = BUCKETS, share: float = 0.25, max_batches: int = 16):
        self.spark, self.path, self.keys, self.order = spark, path, keys, order or []
        self.buckets, self.share, self.max_batches = buckets, share, max_batches

    # -- what is there ---------------------------------------------------------------------

    def _holds_rows(self, folder: str) -> bool:
        """A batch without rows leaves a finished folder with nothing in it."""
        at, fs = _path(self.spark, folder)
        return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(at))

    def _commits(self) -> list[int]:
        return _numbers(finished(self.spark, f"{self.path}/_folds"), "commit")

    def state(self) -> list[Row]:
        """bucket, upto, fold, n of the last commit; empty before the first."""
        commits = self._commits()
        rows = self.spark.read.parquet(f"{self.path}/_folds/commit={commits[-1]}").collect() if commits else []  # one row a bucket
        return sorted(rows, key=lambda r: r.bucket)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _newest(self) -> list[Column]:
        return [F.col(c).desc() for c in [*self.order, "batch_id"]]

    def _changes(self, state: list[Row], only: list[int] | None = None) -> DataFrame | None:
        """Rows that no commit has folded, with batch_id and bucket."""
        least = min((r.upto for r in state), default=None)
        batches = [n for n in _numbers(finished(self.spark, self.path), "batch_id") if (least is None or n > least) and self._holds_rows(f"{self.path}/batch_id={n}")]
        if not batches:
            return None
        rows = self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/batch_id={n}" for n in batches])
        if "bucket" not in rows.columns:
            rows = rows.withColumn("bucket", self._bucket(len(state) or self.buckets))
        rows = rows.withColumns({"batch_id": F.col("batch_id").cast("long"), "bucket": F.col("bucket").cast("int")})
        if state:
            # A condition on partition columns alone: folders of folded batches are not read.
            open_ = reduce(lambda a, b: a | b, [(F.col("bucket") == r.bucket) & (F.col("batch_id") > r.upto) for r in state])
            rows = rows.filter(open_)
        return rows if only is None else rows.filter(F.col("bucket").isin(only))

    def _base(self, state: list[Row], only: list[int] | None = None) -> DataFrame | None:
        """Folded rows, with batch_id and bucket; each key once."""
        mine = [r for r in state if r.n and (only is None or r.bucket in only)]
        folds = sorted({r.fold for r in mine})
        parts = []
        for f in folds:
            root = f"{self.path}/_base/fold={f}"
            rows = self.spark.read.option("basePath", root).parquet(*[f"{root}/bucket={r.bucket}" for r in mine if r.fold == f])
            parts.append(rows.withColumns({"batch_id": F.col("batch_id").cast("long"), "bucket": F.col("bucket").cast("int")}))
        return reduce(lambda a, b: a.unionByName(b), parts) if parts else None

    def _latest(self, state: list[Row], only: list[int] | None = None) -> DataFrame | None:
        changes, base = self._changes(state, only), self._base(state, only)
        if changes is None:
            return base
        newest = keep_top(changes, self.keys, self._newest())
        if base is None:
            return newest
        # Folded rows are ranked only where a change has their key.
        keys = newest.select(*[F.col(k).alias(f"__{n}") for n, k in enumerate(self.keys)])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{n}")) for n, k in enumerate(self.keys)])
        met = keep_top(newest.unionByName(base.join(keys, same, "left_semi").select(*newest.columns)), self.keys, self._newest())
        return base.join(keys, same, "left_anti").select(*newest.columns).unionByName(met)

    def current(self) -> DataFrame:
        """The latest row per key, with the batch that brought it (batch_id)."""
        rows = self._latest(self.state())
        if rows is None:
            raise ValueError(f"nothing has been appended to {self.path}")
        return rows.drop("bucket")

    # -- writing ---------------------------------------------------------------------------

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch and fold what is due. A replayed batch replaces its own rows, or does nothing once it is folded."""
        state = self.state()
        newest = keep_top(batch, self.keys, [F.col(c).desc() for c in self.order] or [F.lit(1)])
        dealt = newest.withColumn("bucket", self._bucket(len(state) or self.buckets))
        if not state or min(r.upto for r in state) < batch_id:
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch_id={batch_id}")
        self.fold_due(batch_id)

    def fold_due(self, batch_id: int) -> list[int]:
        """Fold the buckets that have outgrown their share; returns them."""
        state = self.state()
        folded = {r.bucket: r.n for r in state}
        changes = self._changes(state)
        if changes is None or batch_id in self._commits():
            return []
        counts = changes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("batch_id").alias("batches")).collect()  # one row a bucket
        due = sorted(r.bucket for r in counts if r["n"] > self.share * folded.get(r.bucket, 0) or r.batches > self.max_batches)
        if due:
            self.fold(batch_id, due, {r.bucket for r in counts})
        return due

    def fold(self, batch_id: int, buckets: list[int], changed: set[int]) -> None:
        """Write the latest rows of some buckets as fold ``batch_id`` and commit it. ``changed``: buckets with unfolded changes;
        the others are up to date as they are."""
        state = self.state()
        root = f"{self.path}/_base/fold={batch_id}"
        self._latest(state, buckets).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(root)
        sizes = {r.bucket: r.n for r in self.spark.read.parquet(root).groupBy(F.col("bucket").cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()}
        self.commit(batch_id, buckets, sizes, state, changed)

    def commit(self, batch_id: int, buckets: list[int], sizes: dict[int, int], state: list[Row], changed: set[int]) -> None:
        before = {r.bucket: (r.upto, r.fold, r.n) for r in state}
        rows = []
        for b in range(len(state) or self.buckets):
            upto, fold, n = before.get(b, (-(2**40), -1, 0))
            rows.append((b, batch_id, batch_id, sizes.get(b, 0)) if b in buckets else (b, upto if b in changed else batch_id, fold, n))
        table = self.spark.createDataFrame(rows, "bucket int, upto long, fold long, n long")
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_folds/commit={batch_id}")

    def vacuum(self) -> int:
        """Delete folders that the last commit no longer needs; returns their number. For a time when no one reads older commits."""
        state, commits = self.state(), self._commits()
        if not state:
            return 0
        least, used = min(r.upto for r in state), {r.fold for r in state}
        old = [f"{self.path}/batch_id={n}" for n in _numbers(finished(self.spark, self.path), "batch_id") if n <= least]
        old += [f"{self.path}/_base/fold={n}" for n in _numbers(finished(self.spark, f"{self.path}/_base"), "fold") if n not in used and n < commits[-1]]
        old += [f"{self.path}/_folds/commit={n}" for n in commits[:-1]]
        for path in old:
            at, fs = _path(self.spark, path)
            fs.delete(at, True)
        return len(old)
