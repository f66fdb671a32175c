"""Clustering input features and K-means over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..session import materialize
from .cluster_metrics import score, silhouettes
from .scale import exact_median

CLUSTER_FEATURES = (
    "latitude",
    "longitude",
    "distance_from_center",
    "grid_crime_count",
    "crimes_same_location_24h",
    "distance_to_hotspot_1",
    "distance_to_hotspot_2",
    "distance_to_hotspot_3",
)
GRID_EDGES = 50
STRIP = 4_096  # vectors compared at once with the centres of all models


def grid_features(
    located: DataFrame, edges: int = GRID_EDGES, areas=S.HIGH_CRIME_AREAS
) -> DataFrame:
    """Grid cell, incidents in the cell, its busiest calendar day, and planar
    distances to fixed points.

    The grid has at most (edges-1)^2 cells whatever the data, so the two cell
    tables are always small enough to broadcast and the rows are not shuffled.
    Rows at the minimum of a coordinate have no cell and get null counts."""
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    located = located.withColumns({"latitude": lat, "longitude": lon})
    bounds = located.agg(
        F.struct(
            F.min("latitude").alias("lat0"),
            F.max("latitude").alias("lat1"),
            F.min("longitude").alias("lon0"),
            F.max("longitude").alias("lon1"),
        ).alias("b")
    ).scalar()
    binned = located.withColumn("_b", bounds).withColumns(
        {
            "lat_bin": S.linspace_bin(F.col("latitude"), F.col("_b.lat0"), F.col("_b.lat1"), edges),
            "lon_bin": S.linspace_bin(F.col("longitude"), F.col("_b.lon0"), F.col("_b.lon1"), edges),
        }
    ).drop("_b")
    cell = ["lat_bin", "lon_bin"]
    per_cell = (
        binned.filter(F.col("lat_bin").isNotNull() & F.col("lon_bin").isNotNull())
        .groupBy(*cell, F.to_date("date").alias("day"))
        .agg(F.count("*").alias("n"))
        .groupBy(*cell)
        .agg(
            F.sum("n").alias("grid_crime_count"),
            F.max("n").alias("crimes_same_location_24h"),
        )
    )
    return binned.join(F.broadcast(per_cell), cell, "left").withColumns(
        {
            f"distance_to_hotspot_{i}": S.planar_miles(
                F.col("latitude"), F.col("longitude"), point
            )
            for i, point in enumerate(areas, start=1)
        }
    )


def standardize(df: DataFrame, features=CLUSTER_FEATURES) -> DataFrame:
    """Fill nulls with the median and scale by mean and population deviation.

    Adds a `z_` column per feature.  Medians are exact and only computed for
    features that have nulls; constant features become 0."""
    x = [F.col(f).cast("double") for f in features]
    nulls = df.agg(*[F.count_if(c.isNull()).alias(f) for f, c in zip(features, x)]).first()
    fills = {f: exact_median(df, f) for f in features if nulls[f]}
    filled = {
        f: F.coalesce(c, F.lit(float(fills[f]))) if f in fills else c for f, c in zip(features, x)
    }
    stats = df.agg(
        *[F.avg(c).alias(f"m_{f}") for f, c in filled.items()],
        *[F.stddev_pop(c).alias(f"s_{f}") for f, c in filled.items()],
    ).first()
    return df.withColumns(
        {f"z_{f}": (c - stats[f"m_{f}"]) / (stats[f"s_{f}"] or 1.0) for f, c in filled.items()}
    )


def scaled_names(features=CLUSTER_FEATURES) -> list[str]:
    return [f"z_{f}" for f in features]


def weighted_vectors(scaled: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct vectors with their number of rows and a hash.

    K-means on weighted distinct vectors has the same optimum as on the rows,
    and incidents at one place are one vector."""
    distinct = scaled.groupBy(*columns).agg(F.count("*").cast("double").alias("n"))
    return distinct.withColumn("row", F.xxhash64(*columns))


def _numbers(batch, columns: list[str]):
    import numpy as np

    x = np.column_stack([batch.column(c).to_numpy() for c in columns])
    return x, batch.column("n").to_numpy(), batch.column("row").to_numpy()


def _scan(vectors: DataFrame, columns: list[str], step, schema: str) -> DataFrame:
    """`step(x, n, row)` on blocks of vectors, a dictionary of arrays each."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                yield pa.RecordBatch.from_pydict(step(*_numbers(batch.slice(at, STRIP), columns)))

    return vectors.mapInArrow(run, schema)


def _uniform(row, seed: int):
    """A number in (0, 1] for each row hash, the same in every run."""
    import numpy as np

    u = np.uint64
    z = row.astype("int64").view(u) + u(seed * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> u(30))) * u(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> u(27))) * u(0x94D049BB133111EB)
    return ((z ^ (z >> u(31))) >> u(11)).astype(float) / 2**53 + 2**-54


def _distances(x, centers):
    """Squared distances (rows x centres), by differences: no cancellation."""
    return sum((x[:, i, None] - centers[:, i]) ** 2 for i in range(x.shape[1]))


def _first_centers(vectors: DataFrame, columns: list[str], k: int, seed: int, restarts: int) -> list:
    """`restarts` sequences of k centres, each drawn with a chance in proportion to its
    weight times its squared distance to those before (k-means++ on all vectors).

    One scan draws the next centre of all sequences: the least of -log(u)/chance over all
    vectors is such a draw, and the least of parts can be combined."""
    import numpy as np

    d = len(columns)
    chosen: list[list] = [[] for _ in range(restarts)]
    fields = ", ".join(f"c{i} double" for i in range(d))
    for turn in range(k):
        have = [np.array(c, float).reshape(-1, d) for c in chosen]

        def draw(x, n, row, have=have, turn=turn):
            out = []
            for r, centers in enumerate(have):
                chance = n * (_distances(x, centers).min(axis=1) if turn else 1.0)
                key = np.full(len(x), np.inf)
                held = chance > 0
                key[held] = -np.log(_uniform(row[held], (seed + r) * 1000 + turn)) / chance[held]
                at = int(key.argmin())
                out.append((r, float(key[at]), *x[at]))
            told = list(zip(*out))
            return {"r": np.array(told[0], "int32"), "key": np.array(told[1])} | {
                f"c{i}": np.array(told[2 + i]) for i in range(d)
            }

        least = F.min(F.struct("key", *[f"c{i}" for i in range(d)])).alias("best")
        found = _scan(vectors, columns, draw, f"r int, key double, {fields}").groupBy("r").agg(least)
        for row in found.collect():  # one per sequence
            chosen[row.r].append(list(row.best)[1:])
    return [np.array(c, float) for c in chosen]


def _assign_all(vectors: DataFrame, columns: list[str], models: dict) -> dict:
    """For every model (its centres) and centre: weight, mean offset and squared distance
    of the vectors nearest to it; one scan for all models."""
    import numpy as np

    d = len(columns)
    sums = ", ".join(f"s{i} double" for i in range(d))

    def step(x, n, row):
        rows = []
        for m, centers in models.items():
            far = _distances(x, centers)
            at = far.argmin(axis=1)
            count = np.bincount(at, n, len(centers))
            cost = np.bincount(at, n * far[np.arange(len(x)), at], len(centers))
            # offsets from the centre keep sums small
            moved = [np.bincount(at, n * (x[:, i] - centers[at, i]), len(centers)) for i in range(d)]
            held = np.flatnonzero(count)
            rows.append(np.column_stack([np.full(len(held), m), held, count[held], cost[held], *[v[held] for v in moved]]))
        told = np.vstack(rows)
        return {"m": told[:, 0].astype("int32"), "c": told[:, 1].astype("int32"), "n": told[:, 2], "cost": told[:, 3]} | {
            f"s{i}": told[:, 4 + i] for i in range(d)
        }

    found = _scan(vectors, columns, step, f"m int, c int, n double, cost double, {sums}").groupBy("m", "c").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(d)]
    )
    out = {m: [np.zeros(len(c)), np.zeros(len(c)), np.zeros_like(c)] for m, c in models.items()}
    for r in found.collect():  # a row per centre
        count, cost, moved = out[r.m]
        count[r.c], cost[r.c], moved[r.c] = r.n, r.cost, [r[f"s{i}"] for i in range(d)]
    return out


def _fit_all(vectors, columns, ks, seed, restarts, max_iter=300, tol=1e-4) -> dict[int, dict]:
    """The cheapest of `restarts` fits for each k.

    All models are moved together: a scan assigns every vector to a centre of each model
    that still moves and sums per centre.  A model rests when the squared shifts of its
    centres sum to at most `tol` (features have unit variance)."""
    import numpy as np

    starts = _first_centers(vectors, columns, max(ks), seed, restarts)
    names = [(k, r) for k in ks for r in range(restarts)]
    models = {m: starts[r][:k].copy() for m, (k, r) in enumerate(names)}
    moving, fitted = set(models), {}
    for turn in range(max_iter + 1):
        for m, (count, cost, moved) in _assign_all(vectors, columns, {m: models[m] for m in moving}).items():
            shift = np.divide(moved, count[:, None], out=np.zeros_like(moved), where=count[:, None] > 0)
            if (shift**2).sum() <= tol or turn == max_iter:
                fitted[m] = {"centers": models[m], "inertia": float(cost.sum())}
                moving.discard(m)
            else:
                models[m] = models[m] + shift
        if not moving:
            break
    best: dict[int, dict] = {}
    for m, (k, _) in enumerate(names):
        if k not in best or fitted[m]["inertia"] < best[k]["inertia"]:
            best[k] = fitted[m]
    return best


def _statistics(vectors: DataFrame, columns: list[str], models: dict[int, dict]) -> dict[int, tuple]:
    """Per k the weights, means and variances of its clusters."""
    import numpy as np

    out = {}
    for k, (n, cost, moved) in _assign_all(vectors, columns, {k: m["centers"] for k, m in models.items()}).items():
        held = n > 0
        shift = np.divide(moved, n[:, None], out=np.zeros_like(moved), where=held[:, None])
        variance = np.divide(cost, n, out=np.zeros_like(cost), where=held) - (shift**2).sum(axis=1)
        out[k] = (n, models[k]["centers"] + shift, np.maximum(variance, 0.0))
    return out


def _silhouettes(vectors: DataFrame, columns: list[str], models: dict[int, dict], statistics) -> dict[int, float]:
    """Mean silhouette on squared Euclidean distance of every k, in one scan."""
    import numpy as np

    def step(x, n, row):
        rows = []
        for k, (sizes, means, variances) in statistics.items():
            labels = _distances(x, models[k]["centers"]).argmin(axis=1)
            held = np.flatnonzero(sizes)
            own, other = silhouettes(x, labels, held, sizes[held], means[held], variances[held])
            rows.append((k, float((score(own, other) * n).sum()), float(n.sum())))
        told = list(zip(*rows))
        return {"k": np.array(told[0], "int32"), "s": np.array(told[1]), "n": np.array(told[2])}

    found = _scan(vectors, columns, step, "k int, s double, n double").groupBy("k").agg((F.sum("s") / F.sum("n")).alias("s"))
    return {r.k: r.s for r in found.collect()}


def _sweep(vectors, columns, ks, seed, restarts):
    """Best model and metrics for each k."""
    import numpy as np

    models = _fit_all(vectors, columns, list(ks), seed, restarts)
    statistics = _statistics(vectors, columns, models)
    mean = _silhouettes(vectors, columns, models, statistics)
    rows = []
    for k, (n, means, _) in sorted(statistics.items()):
        total, inertia = n.sum(), models[k]["inertia"]
        centre = (n[:, None] * means).sum(axis=0) / total
        between = float((n * ((means - centre) ** 2).sum(axis=1)).sum())
        usable = inertia > 0 and total > k
        rows.append(
            {
                "k": k,
                "inertia": inertia,
                "silhouette_squared_euclidean": mean[k] if np.count_nonzero(n) > 1 else None,
                "calinski_harabasz": (between / (k - 1)) / (inertia / float(total - k)) if usable else None,
            }
        )
    return models, rows


def _recommend(spark, rows) -> DataFrame:
    ddl = "k int, inertia double, silhouette_squared_euclidean double, calinski_harabasz double"
    return with_recommendation(spark.createDataFrame(rows, ddl))


def kmeans_sweep(
    scaled: DataFrame,
    columns: list[str] | None = None,
    max_k: int = 15,
    seed: int = 42,
    restarts: int = 10,
) -> DataFrame:
    """Metrics of the best fit for k = 2..max_k, one row per k, with the elbow
    and the k of the best silhouette, which is the recommended one."""
    columns = columns or scaled_names()
    vectors = materialize(weighted_vectors(scaled, columns))
    _, rows = _sweep(vectors, columns, range(2, max_k + 1), seed, restarts)
    return _recommend(scaled.sparkSession, rows)


def with_elbow(sweep: DataFrame) -> DataFrame:
    """Add `elbow_k` (one row per k): one k beyond the point where the drop in inertia
    slows most, that is where the second difference is largest."""
    by_k = Window.orderBy("k")
    bend = sweep.withColumns(
        {
            "_bend": F.lead("inertia", 2).over(by_k)
            - 2 * F.lead("inertia", 1).over(by_k)
            + F.col("inertia"),
            # the reported k lies two steps after the first of the three
            "_elbow": F.lead("k", 2).over(by_k),
        }
    )
    return bend.withColumn("elbow_k", _pick("_elbow", F.col("_bend"))).drop("_bend", "_elbow")


def _pick(value: str, score: Column) -> Column:
    known = F.when(score.isNotNull(), F.struct(score, -F.col("k")))
    return F.max_by(value, known).over(Window.partitionBy())


def with_recommendation(sweep: DataFrame) -> DataFrame:
    """Add `elbow_k` and `recommended_k` (best silhouette), one row per k."""
    best = _pick("k", F.col("silhouette_squared_euclidean"))
    return with_elbow(sweep).withColumn("recommended_k", best)


def strip_sweep(located: DataFrame, max_k: int = 15) -> DataFrame:
    """Inertia of the partitions into k = 2..max_k strips of equal width in latitude, and
    their elbow.  Each row carries its strip for every k; one scan sums by (k, strip)."""
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    ends = located.agg(F.struct(F.min(lat).alias("lo"), F.max(lat).alias("hi")).alias("b")).scalar()
    place = (F.col("lat") - F.col("b.lo")) / (F.col("b.hi") - F.col("b.lo"))
    strip = lambda k: F.least(F.floor(place * k), F.lit(k - 1)).cast("int")
    models = F.array(*[F.struct(F.lit(k).alias("k"), strip(k).alias("strip")) for k in range(2, max_k + 1)])
    each = (
        located.select(lat.alias("lat"), lon.alias("lon"))
        .withColumn("b", ends)
        .select("lat", "lon", F.explode(models).alias("m"))
    )
    sums = each.groupBy("m.k", "m.strip").agg(
        F.count("*").alias("n"), (F.var_pop("lat") + F.var_pop("lon")).alias("v")
    )
    return with_elbow(sums.groupBy("k").agg(F.sum(F.col("n") * F.col("v")).alias("inertia")))


def kmeans_labels(
    scaled: DataFrame,
    columns: list[str] | None = None,
    k: int | None = None,
    seed: int = 42,
    restarts: int = 10,
    max_k: int = 15,
) -> tuple[DataFrame, dict]:
    """Rows with `cluster_id`, and the metrics of the fit.  Without `k` the
    recommended one of the sweep is used."""
    columns = columns or scaled_names()
    vectors = materialize(weighted_vectors(scaled, columns))
    ks = range(2, max_k + 1) if k is None else [k]
    models, rows = _sweep(vectors, columns, ks, seed, restarts)
    if k is None:
        k = _recommend(scaled.sparkSession, rows).first().recommended_k
    model, metrics = models[k], next(r for r in rows if r["k"] == k)
    centers = model["centers"].tolist()
    return nearest_center(scaled, columns, centers), metrics


def nearest_center(df: DataFrame, columns: list[str], centers) -> DataFrame:
    """Assign each row to its nearest centre, as a plain column expression."""

    def squared(center):
        terms = [(F.col(c) - v) * (F.col(c) - v) for c, v in zip(columns, center)]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total

    options = [F.struct(squared(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]
    return df.withColumn("cluster_id", F.least(*options)["i"] if len(options) > 1 else F.lit(0))
