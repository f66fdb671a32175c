"""Quality of any labelled table from sufficient statistics of its clusters.

One scan gives per cluster the number of rows, the mean and the variance of each
feature.  Inertia and the Calinski-Harabasz ratio follow from these alone.  The mean
squared distance of a row to all rows of a cluster is its squared distance to their
mean plus their variance, so a second scan gives the silhouette on squared Euclidean
distance.  Rows without a cluster (noise, null) take no part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

NOISE = -1
CLUSTERS = 20_000  # statistics that one pass over the rows carries; more clusters are more passes


def cluster_statistics(labelled: DataFrame, features: list[str], label: str = "cluster_id") -> DataFrame:
    """cluster_id, n, m0.. (means), v0.. (population variances)."""
    x = [F.col(f).cast("double") for f in features]
    return (
        labelled.filter(F.col(label).isNotNull() & (F.col(label) != NOISE))
        .groupBy(F.col(label).cast("long").alias("cluster_id"))
        .agg(
            F.count("*").alias("n"),
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
            *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(x)],
        )
    )


def _dispersion(statistics: DataFrame, d: int) -> DataFrame:
    """n_clusters, n_points, inertia, calinski_harabasz (one row)."""
    n = F.col("n")
    within = sum((F.col(f"v{i}") for i in range(d)), F.lit(0.0))
    # moments of the means, weighted by size, around their own centre
    spread = [
        F.sum(n * F.col(f"m{i}") * F.col(f"m{i}")) - F.sum(n * F.col(f"m{i}")) ** 2 / F.sum(n) for i in range(d)
    ]
    centre = statistics.agg(
        F.struct(*[(F.sum(n * F.col(f"m{i}")) / F.sum(n)).alias(f"c{i}") for i in range(d)]).alias("c")
    ).scalar()
    moved = statistics.withColumn("_c", centre).withColumns(
        {f"m{i}": F.col(f"m{i}") - F.col(f"_c.c{i}") for i in range(d)}
    )
    sums = moved.agg(
        F.count("*").alias("n_clusters"),
        F.coalesce(F.sum(n), F.lit(0)).alias("n_points"),
        F.sum(n * within).alias("inertia"),
        sum(spread, F.lit(0.0)).alias("_between"),
    )
    k, total = F.col("n_clusters"), F.col("n_points")
    ratio = (F.col("_between") / (k - 1)) / (F.col("inertia") / (total - k))
    usable = (k > 1) & (total > k) & (F.col("inertia") > 0)
    return sums.withColumn("calinski_harabasz", F.when(usable, ratio)).drop("_between")


def silhouettes(x, labels, ids, sizes, means, variances):
    """Of each row of `x`: own (mean squared distance to the other rows of its cluster, nan
    if it is not among `ids`) and other (the least to another cluster)."""
    import numpy as np

    own = np.full(len(x), np.nan)
    if not len(ids):
        return own, np.full(len(x), np.inf)
    far = ((x[:, None, :] - means[None]) ** 2).sum(axis=2) + variances
    at = np.searchsorted(ids, labels).clip(max=len(ids) - 1)
    mine = np.flatnonzero(ids[at] == labels)
    n = sizes[at[mine]]
    # the mean counts the row itself, at distance 0
    own[mine] = np.where(n > 1, far[mine, at[mine]] * n / np.maximum(n - 1, 1), -1.0)
    far[mine, at[mine]] = np.inf
    return own, far.min(axis=1)


def score(own, other):
    """Silhouettes; 0 in a cluster of one row (own is -1)."""
    import numpy as np

    most = np.maximum(own, other)
    plain = np.divide(other - own, most, out=np.zeros(len(own)), where=(most > 0) & np.isfinite(most))
    return np.where(own < 0, 0.0, plain)


def _near(rows: DataFrame, block: list, d: int, strip: int = 2_000_000) -> DataFrame:
    """Update `own` and `other` with the clusters of a block."""
    import numpy as np

    block = sorted(block)
    ids, sizes = (np.array([r[i] for r in block], "int64") for i in (0, 1))
    means = np.array([r[2 : 2 + d] for r in block], float).reshape(-1, d)
    variances = np.array([sum(r[2 + d :]) for r in block], float)

    def run(batches):
        import pyarrow as pa

        step = max(1, strip // max(1, len(ids) * d))
        for batch in batches:
            x = np.column_stack([batch.column(f"x{i}").to_numpy() for i in range(d)])
            labels = batch.column("label").to_numpy()
            own, other = (batch.column(c).to_numpy().copy() for c in ("own", "other"))
            for a in range(0, len(x), step):
                o, b = silhouettes(x[a : a + step], labels[a : a + step], ids, sizes, means, variances)
                own[a : a + step] = np.where(np.isnan(o), own[a : a + step], o)
                other[a : a + step] = np.minimum(other[a : a + step], b)
            done = {c: batch.column(c) for c in rows_columns} | {"own": pa.array(own), "other": pa.array(other)}
            yield pa.RecordBatch.from_pydict(done)

    rows_columns = ["label", *[f"x{i}" for i in range(d)]]
    return rows.mapInArrow(run, rows.schema)


def silhouette(labelled: DataFrame, features: list[str], statistics: DataFrame, label: str = "cluster_id") -> DataFrame:
    """The mean silhouette (one row), null with fewer than two clusters."""
    d = len(features)
    rows = labelled.filter(F.col(label).isNotNull() & (F.col(label) != NOISE)).select(
        F.col(label).cast("long").alias("label"),
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
        F.lit(float("nan")).alias("own"),
        F.lit(float("inf")).alias("other"),
    )
    clusters = statistics.count()
    blocks = max(1, -(-clusters // CLUSTERS))
    columns = ["cluster_id", "n", *[f"m{i}" for i in range(d)], *[f"v{i}" for i in range(d)]]
    told = statistics.select(*columns).withColumn("_block", F.pmod(F.xxhash64("cluster_id"), F.lit(blocks)))
    for b in range(blocks):
        rows = _near(rows, [tuple(r)[:-1] for r in told.filter(F.col("_block") == b).collect()], d)
    most = F.greatest("own", "other")
    one = F.when(F.col("own") < 0, 0.0).when(most > 0, (F.col("other") - F.col("own")) / most).otherwise(0.0)
    return rows.agg(F.when(F.lit(clusters > 1), F.avg(one)).alias("silhouette_squared_euclidean"))


def cluster_metrics(labelled: DataFrame, features: list[str], label: str = "cluster_id") -> DataFrame:
    """n_clusters, n_points, inertia, calinski_harabasz, silhouette_squared_euclidean of the
    rows that have a cluster (one row)."""
    statistics = materialize(cluster_statistics(labelled, features, label))
    mean = silhouette(labelled, features, statistics, label).scalar()
    return _dispersion(statistics, len(features)).withColumn("silhouette_squared_euclidean", mean)
