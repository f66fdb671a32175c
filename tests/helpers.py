"""Fixtures by hand and brute-force counterparts of the operators."""

from __future__ import annotations

import json
from datetime import datetime

import numpy as np


def raw(spark, rows):
    """rows: (id, date text or None, payload: dict, text or None)."""
    from incidentlens.schema import RAW

    made = [
        (
            i,
            datetime.fromisoformat(d) if d else None,
            json.dumps(p) if isinstance(p, dict) else p,
            datetime(2024, 6, 1),
            "test",
        )
        for i, d, p in rows
    ]
    return spark.createDataFrame(made, RAW)


def incidents(spark, rows):
    """rows: (date, type[, arrest, district, ward, place]) as raw incidents."""
    keys = ("primary_type", "arrest", "district", "ward", "location_description")
    return raw(
        spark,
        [(str(n), r[0], {k: v for k, v in zip(keys, r[1:]) if v is not None}) for n, r in enumerate(rows)],
    )


def brute_dbscan(points: np.ndarray, eps: float, min_samples: int) -> np.ndarray:
    """Textbook DBSCAN in row order."""
    dist = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    near = [np.flatnonzero(row <= eps) for row in dist]
    core = np.array([len(n) >= min_samples for n in near])
    labels = np.full(len(points), -1)
    cluster = 0
    for i in range(len(points)):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] != -1:
                continue
            labels[j] = cluster
            if core[j]:
                stack.extend(k for k in near[j] if labels[k] == -1)
        cluster += 1
    return labels


def brute_kdist(points: np.ndarray, k: int) -> np.ndarray:
    dist = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    return np.sort(dist, axis=1)[:, k]


def frame(spark, points, names):
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names))
