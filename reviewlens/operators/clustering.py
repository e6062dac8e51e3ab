"""Density clustering at scale: micro-clusters around pivots, linked where documents lie between them.

All rows go to their nearest pivot, so the work per row is fixed and no pair of rows is ever formed. A row almost as close
to a second pivot as to its first links the two cells, and the number of such rows is the weight of the link. Both are
judged relative to the data: a cell is dense against the mean cell, and a link is strong against the smaller of its two
cells. So ten times as many rows of the same kind give the same clusters; how many can be told apart depends on the number
of pivots alone. Dense cells joined by strong links make a cluster; rows in thin cells follow the strongest link or become
noise. Everything after the assignment works on tables of at most ``pivots`` cells.
"""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from reviewlens import config as cfg
from reviewlens.operators.dedup import keep_top
from reviewlens.operators.ivf import neighbours as neighbours
from reviewlens.operators.vectors import CENTROID_BLOCK, nearest
from reviewlens.session import ensure_checkpoint_dir


def choose_pivots(df: DataFrame, key: str, n: int, vec: str = "embedding") -> DataFrame:
    """``n`` different vectors in hash order of their key: a repeatable spread over the data.

    Four times as many rows are drawn, so that copies of one vector do not use up the places.
    """
    if n > CENTROID_BLOCK:
        raise ValueError(f"at most {CENTROID_BLOCK} pivots")
    code = F.md5(F.col(key).cast("string"))
    drawn = df.select(F.col(key).alias("cell"), F.col(vec).alias("pivot"), code.alias("__code")).orderBy("__code", "cell").limit(4 * n)
    first = keep_top(drawn, ["pivot"], [F.col("__code"), F.col("cell")])
    return first.orderBy("__code", "cell").limit(n).drop("__code")


def assign_cells(df: DataFrame, pivots: DataFrame, vec: str = "embedding") -> DataFrame:
    """Nearest and second nearest pivot of every row with both distances."""
    near = nearest(df, pivots, "cell", "pivot", vec=vec, k=2, metric="euclidean")
    first, second = F.col("near")[0], F.get("near", F.lit(1))
    return near.withColumns(
        {"cell": first["id"], "distance": -first["score"], "cell2": second["id"], "distance2": -second["score"]}
    ).drop("near", "exp_sum")


def cell_graph(assigned: DataFrame, closeness: float) -> DataFrame:
    """Links between cells: rows for which the nearest pivot is at least ``closeness`` as far away as the second one."""
    between = assigned.filter(F.col("distance") >= F.col("distance2") * closeness)
    return between.groupBy(F.least("cell", "cell2").alias("cell_a"), F.greatest("cell", "cell2").alias("cell_b")).agg(
        F.count(F.lit(1)).alias("weight")
    )


def components(nodes: DataFrame, edges: DataFrame, node: str = "cell", max_rounds: int = 100, few: bool = False) -> DataFrame:
    """(node, component): the smallest node id that can be reached, by passing labels along edges and following them.

    Each round is written to the checkpoint folder, and the job ends when a round changes nothing. ``few`` is for callers
    whose nodes are bounded by construction: the labels are then broadcast instead of shuffled.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    light = F.broadcast if few else (lambda df: df)
    a, b = edges.columns[:2]
    both = edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct().checkpoint()
    labels = nodes.select(F.col(node).alias("id"), F.col(node).alias("label")).checkpoint()
    for _ in range(max_rounds):
        heard = both.join(light(labels), both.src == labels.id).groupBy("dst").agg(F.min("label").alias("heard"))
        passed = labels.join(light(heard), labels.id == heard.dst, "left").select(
            "id", F.col("label").alias("old"), F.least("label", F.coalesce("heard", "label")).alias("mid")
        )
        hop = labels.select(F.col("id").alias("mid"), F.col("label").alias("far"))
        labels = (
            passed.join(light(hop), "mid", "left").select("id", "old", F.least("mid", F.coalesce("far", "mid")).alias("label")).checkpoint()
        )
        if labels.filter("label <> old").limit(1).count() == 0:
            return labels.select(F.col("id").alias(node), F.col("label").alias("component"))
        labels = labels.drop("old")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def density_clusters(
    df: DataFrame,
    key: str,
    vec: str = "embedding",
    pivots: int = 256,
    min_points: int = 3,
    closeness: float = 0.75,
    min_link: int = 2,
    min_cluster_size: int = cfg.MIN_TOPIC_SIZE,
    least_tenths: int = 1,
) -> DataFrame:
    """(key, cell, topic_id): clusters numbered from 0 by falling size, noise is -1.

    A cell is dense with ``min_points`` rows and ``least_tenths`` tenths of the mean cell; a link is strong with ``min_link``
    rows and as many tenths of its smaller cell. Comparisons are in whole numbers. Rows without a vector are noise.
    """
    no_vector = df.filter(F.col(vec).isNull()).select(key, F.lit(None).cast("bigint").alias("cell"), F.lit(-1).alias("topic_id"))
    df = df.filter(F.col(vec).isNotNull())
    ensure_checkpoint_dir(df.sparkSession)
    # The assignment is the one costly pass and feeds four small tables, so it is written once.
    assigned = assign_cells(df.select(key, vec), choose_pivots(df, key, pivots, vec), vec).drop(vec).checkpoint()
    cells = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    sides = [cells.select(F.col("cell").alias(f"cell_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab"]
    sized = cell_graph(assigned, closeness).join(F.broadcast(sides[0]), "cell_a").join(F.broadcast(sides[1]), "cell_b")
    links = sized.filter((F.col("weight") >= min_link) & (10 * F.col("weight") >= least_tenths * F.least("n_a", "n_b"))).drop("n_a", "n_b")
    # From here on every table has at most one row per pivot, apart from the links, so those are the ones to broadcast.
    whole = cells.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("cells"))
    dense = (
        cells.crossJoin(F.broadcast(whole))  # one row
        .filter((F.col("n") >= min_points) & (10 * F.col("n") * F.col("cells") >= least_tenths * F.col("rows")))
        .select("cell")
    )
    strong = links.join(F.broadcast(dense.withColumnRenamed("cell", "cell_a")), "cell_a", "left_semi").join(
        F.broadcast(dense.withColumnRenamed("cell", "cell_b")), "cell_b", "left_semi"
    )
    core = components(dense, strong.select("cell_a", "cell_b"), few=True)
    one_way = links.select(F.col("cell_a").alias("cell"), F.col("cell_b").alias("other"), "weight").unionByName(
        links.select(F.col("cell_b").alias("cell"), F.col("cell_a").alias("other"), "weight")
    )
    thin = one_way.join(F.broadcast(core.select("cell")), "cell", "left_anti")
    followers = keep_top(
        thin.join(F.broadcast(core.withColumnRenamed("cell", "other")), "other"), ["cell"], [F.col("weight").desc(), F.col("other")]
    )
    members = core.unionByName(followers.select("cell", "component"))
    sizes = members.join(F.broadcast(cells), "cell").groupBy("component").agg(F.sum("n").alias("size"))
    # At most ``pivots`` components, so one ordered window over them is small.
    order = Window.orderBy(F.col("size").desc(), F.col("component"))
    numbered = sizes.filter(F.col("size") >= min_cluster_size).withColumn("topic_id", F.row_number().over(order) - 1)
    topics = members.join(F.broadcast(numbered), "component").select("cell", "topic_id")
    placed = assigned.select(key, "cell").join(F.broadcast(topics), "cell", "left").select(
        key, F.col("cell").cast("bigint").alias("cell"), F.coalesce("topic_id", F.lit(-1)).alias("topic_id")
    )
    return placed.unionByName(no_vector)


def kmeans_topics(df: DataFrame, k: int, vec: str = "embedding", seed: int = 42, min_size: int = 1) -> DataFrame:
    """The same table shape from bisecting k-means on cosine distance: every row gets a topic."""
    data = df.withColumn("__vec", array_to_vector(vec))
    model = BisectingKMeans(
        k=k, featuresCol="__vec", predictionCol="topic_id", distanceMeasure="cosine", seed=seed, minDivisibleClusterSize=float(min_size)
    ).fit(data)
    return model.transform(data).drop("__vec")
