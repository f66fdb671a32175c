"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

A text is a bag of segments of its sentences: its tokens without punctuation, and runs
of very short tokens written together ("i d i o t").  The kernel of two segments counts
their common subsequences of four characters, gaps allowed, each weighted by DECAY to
the length it spans, so that inserted or left-out characters cost little.  It is
divided by the value for a segment of the same length without repeated subsequences.

Learning is multi-instance, since labels hold for texts: segments that are toxic in far
more contexts than chance explains are the first witnesses; a linear SVM on Nystroem features (the kernel with
landmark segments, whitened) tells them from segments of clean texts; the hardest clean
segments and further witnesses are added and it is trained again.  Gaps are limited, so
the landmarks' weights add up to one table of subsequence weights, and scoring a
segment is a sum over its subsequences.  A text's margin is that of its worst segment;
a logistic curve over the margins of training texts turns it into a score.

The model is fitted on at most `sample` labelled texts of either kind, chosen by a hash
of the id.  Everything else reads all texts whole.

Cases: a null or empty text has no segments and the lowest margin; rows are scored one
by one, so repeated rows get equal scores; labels that are null are left out, of
several for one id the largest holds; without labelled texts of both kinds every score
is the share of toxic labels (0 if there are none); an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, in_worker, read

SAMPLE = 2_000
DECAY = 0.75
SPAN = 7  # characters that a subsequence of four may span
FEATURE_BITS = 20
FEATURES = 1 << FEATURE_BITS
LANDMARKS = 160
NEGATIVES = 6_000
ROUNDS = 4
COST = 100.0
SLICE_BYTES = 4_000_000
STORED = 64_000_000  # bytes of tokens that a worker stores, an entry with ENTRY more
ENTRY = 120
PART = 10_000  # segments that are scored at a time in fitting
PIECE, OVERLAP = 64, 24  # longer segments are scored in overlapping pieces
OFFSETS = [(i, j, k) for k in range(3, SPAN) for i, j in combinations(range(1, k), 2)]

NOT_LETTERS = regex.compile(r"[^\p{L}\p{N}]+")
SHORT_RUN = regex.compile(r"(?<!\S)\S{1,2}(?:[ \t]+\S{1,2}(?!\S)){2,}")


def tokens(text: str) -> set[str]:
    """The distinct raw tokens of a text, and its runs of short ones as one each."""
    text = text.lower()
    return set(text.split()).union("".join(run.split()) for run in SHORT_RUN.findall(text))


def segment(token: str) -> str:
    return NOT_LETTERS.sub("", token)


def length_norm(n: np.ndarray) -> np.ndarray:
    """Root of the kernel of a segment of n characters with itself, if no
    subsequence is repeated."""
    total = np.zeros(len(n))
    for _, _, k in OFFSETS:
        total += np.maximum(n - k, 0) * DECAY ** (2 * (k + 1))
    return np.sqrt(np.maximum(total, 1e-12))


class Subsequences:
    """The weighted subsequences of many segments: for each pair of offsets the
    positions, the feature of each, and the segment each belongs to."""

    def __init__(self, segments: list[str]):
        self.size = np.fromiter(map(len, segments), np.int64, len(segments))
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "replace"), np.uint32)
        self.codes = codes.astype(np.uint64)
        self.owner = np.repeat(np.arange(len(segments)), self.size)
        ends = np.cumsum(self.size)
        self.left = ends[self.owner] - np.arange(len(codes)) if len(codes) else np.zeros(0, int)
        self.norm = length_norm(self.size)

    def __iter__(self):
        c = self.codes * np.uint64(0x9E3779B97F4A7C15)
        c ^= c >> np.uint64(29)
        for i, j, k in OFFSETS:
            at = np.flatnonzero(self.left > k)
            x = c[at] * np.uint64(0xBF58476D1CE4E5B9) + c[at + i]
            x = (x * np.uint64(0x94D049BB133111EB) + c[at + j]) * np.uint64(0xD6E8FEB86659FD93)
            x = (x + c[at + k]) * np.uint64(0xFF51AFD7ED558CCD)
            yield (
                self.owner[at],
                (x >> np.uint64(64 - FEATURE_BITS)).astype(np.int64),
                DECAY ** (k + 1),
            )

    def dot(self, table: np.ndarray) -> np.ndarray:
        """Sum of the table's weights over the subsequences of every segment."""
        total = np.zeros(len(self.size))
        for owner, feature, weight in self:
            total += weight * np.bincount(owner, table[feature], len(total))
        return total / self.norm

    def table(self, weights: np.ndarray) -> np.ndarray:
        """The weighted sum of the segments' subsequence vectors."""
        out = np.zeros(FEATURES)
        weights = weights / self.norm
        for owner, feature, weight in self:
            np.add.at(out, feature, weight * weights[owner])
        return out


def dots(segments: list[str], table: np.ndarray) -> np.ndarray:
    """Subsequences.dot over many segments, in parts, which bounds the memory it takes."""
    parts = [segments[k : k + PART] for k in range(0, len(segments), PART)]
    return np.concatenate([Subsequences(part).dot(table) for part in parts] or [np.zeros(0)])


def kernel(segments: list[str], landmarks: list[str]) -> np.ndarray:
    own = Subsequences(segments)
    out = np.empty((len(segments), len(landmarks)))
    for k, landmark in enumerate(landmarks):
        out[:, k] = own.dot(Subsequences([landmark]).table(np.ones(1)))
    return out


def train_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, by Newton steps on the rows inside
    the margin."""
    x = np.hstack((x, np.ones((len(x), 1))))
    beta = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    active = np.ones(len(x), bool)
    for _ in range(30):
        weighted = (x * (weight * active)[:, None]).T
        beta = np.linalg.solve(ridge + weighted @ x, weighted @ y)
        inside = y * (x @ beta) < 1
        if (inside == active).all():
            break
        active = inside
    return beta[:-1], float(beta[-1])


def fit_segments(names: list[str], toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, float]:
    """Table of subsequence weights and bias, from segments with the number of
    different contexts in toxic and clean texts (`toxic`, `clean`)."""
    usable = np.fromiter(map(len, names), np.int64, len(names)) >= 4
    only_toxic, from_clean = usable & (toxic > 0) & (clean == 0), usable & (clean > 0)
    hashed = np.fromiter((hash_of(s) for s in names), np.uint64, len(names))
    order = np.argsort(hashed, kind="stable")
    negative = np.zeros(len(names), bool)
    negative[order[from_clean[order]][:NEGATIVES]] = True
    if not only_toxic.any() or not negative.any():
        return np.zeros(FEATURES), -1.0
    # witnesses: segments whose contexts are toxic far more often than all are
    base = toxic.sum() / (toxic.sum() + clean.sum())
    share = np.clip(toxic / (toxic + clean), 1e-9, 1 - 1e-9)
    evidence = toxic * np.log(share / base) + clean * np.log((1 - share) / (1 - base))
    surprising = (share > 0.9) & (evidence > np.log(len(names)) + 3)
    witness = usable & surprising
    if not witness.any():
        witness = only_toxic & (evidence == evidence[only_toxic].max())
    table, bias = np.zeros(FEATURES), -1.0
    for _ in range(ROUNDS):
        positives, negatives = np.flatnonzero(witness), np.flatnonzero(negative & ~witness)
        if not len(negatives):
            return np.zeros(FEATURES), -1.0
        strong = spread_out(names, positives, toxic, LANDMARKS // 2)
        # the other landmarks are the clean segments nearest to these
        picked = [names[i] for i in strong]
        near = dots([names[i] for i in negatives], Subsequences(picked).table(np.ones(len(picked))))
        hard = negatives[np.argsort(-near, kind="stable")]
        landmarks = picked + [names[i] for i in hard[: LANDMARKS // 2]]
        rows = [names[i] for i in positives]
        among = kernel(landmarks, landmarks)
        values, vectors = np.linalg.eigh(among + 1e-6 * np.eye(len(landmarks)))
        whiten = vectors / np.sqrt(np.maximum(values, 1e-6))
        positive = len(rows)
        rows += [names[i] for i in negatives]
        x = kernel(rows, landmarks) @ whiten
        y = np.where(np.arange(len(rows)) < positive, 1.0, -1.0)
        # a witness counts by its contexts, and both kinds alike
        weight = np.ones(len(rows))
        weight[:positive] = np.sqrt(toxic[positives])
        weight[positive:] = np.sqrt(1 + clean[negatives])
        weight[:positive] /= weight[:positive].sum()
        weight[positive:] /= weight[positive:].sum()
        beta, bias = train_svm(x, y, COST * len(rows) * weight / 2)
        table = Subsequences(landmarks).table(whiten @ beta)
        margin = dots(names, table) + bias
        # clean segments that look worst, and toxic ones that look like witnesses
        worst = np.flatnonzero(from_clean)
        negative[worst[np.argsort(-margin[worst], kind="stable")][: NEGATIVES // 3]] = True
        witness |= only_toxic & (margin > max(0.5, margin[from_clean & ~witness].max(initial=-1.0)))
    return table, bias


def spread_out(names: list[str], among: np.ndarray, mass: np.ndarray, count: int) -> list[int]:
    """Greedy choice of segments: the heaviest first, while each takes weight from
    those that are alike."""
    left = mass[among].astype(float)
    own = Subsequences([names[i] for i in among])
    chosen = []
    while len(chosen) < min(count, len(among)):
        best = int(np.argmax(left))
        if left[best] <= 0:
            break
        chosen.append(int(among[best]))
        alike = own.dot(Subsequences([names[among[best]]]).table(np.ones(1)))
        left *= np.clip(1 - alike, 0, 1) ** 2
        left[best] = 0
    return chosen


def hash_of(s: str) -> int:
    out = 14695981039346656037
    for b in s.encode("utf-8", "replace"):
        out = ((out ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return out


def pieces_of(s: str) -> list[str]:
    """A segment in overlapping pieces, so that long ones are read whole."""
    if len(s) <= PIECE:
        return [s]
    return [s[k : k + PIECE] for k in range(0, len(s) - OVERLAP, PIECE - OVERLAP)]


class Scorer:
    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias, self.store, self.held = table, bias, {}, 0

    def _learn(self, new: list[str]) -> None:
        pieces = [pieces_of(segment(t)) for t in new]
        margins = Subsequences([p for ps in pieces for p in ps]).dot(self.table) + self.bias
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        worst = np.maximum.reduceat(margins, np.cumsum(counts) - counts)
        self.store.update(zip(new, worst.tolist()))
        self.held += sum(map(len, new)) + ENTRY * len(new)

    def margins(self, texts: list[str | None]) -> np.ndarray:
        bags = [tokens(t) if t else set() for t in texts]
        if self.held > STORED:
            self.store, self.held = {}, 0
        new = set().union(*bags).difference(self.store)
        if new:
            self._learn(list(new))
        get = self.store.__getitem__
        floor = self.bias
        return np.array([max(map(get, bag), default=floor) for bag in bags])


def _scorer(model) -> Scorer:
    """One scorer, with its store of tokens, per worker process and model, while this
    operator runs."""
    name, table, bias = model.value
    return in_worker(("toxicity", name), lambda: Scorer(table, bias))


def _margins(docs: DataFrame, model, keep_text: bool = False) -> DataFrame:
    """The columns of `docs` (which has `text`), the text only on request, and `margin`."""
    others = [c for c in docs.columns if keep_text or c != "text"]
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                margin = scorer.margins(part.column("text").to_pylist())
                yield part.select(others).append_column("margin", pa.array(margin))

    return docs.mapInArrow(run, types + ", margin double")


def contexts(text: str) -> set[tuple[str, str]]:
    """Segments of a text, each with the token before it.  A word that only copies
    of one text share has one context, however many copies there are."""
    own = text.lower().split()
    found = {(s, before) for t, before in zip(own, ["", *own]) for s in pieces_of(segment(t))}
    found |= {(t, "") for t in tokens(text) - set(own)}
    return {x for x in found if x[0]}


def _contexts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                found = sorted(contexts(text or ""))
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array([s for s, _ in found], pa.string()),
                        "before": pa.array([t for _, t in found], pa.string()),
                        "toxic": pa.array([toxic] * len(found), pa.int32()),
                    }
                )


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the weights and bias for the segments of the sample, if there are any."""
    in_worker(("toxicity", "fit"), dict)  # other operators' stores are given up
    found = list(batches)
    if not sum(len(batch) for batch in found):
        return
    whole = pa.Table.from_batches(found).sort_by("segment")
    toxic, clean = (whole.column(c).to_numpy().astype(float) for c in ("toxic", "clean"))
    table, bias = fit_segments(whole.column("segment").to_pylist(), toxic, clean)
    weights = pa.array([table.astype(np.float32).tobytes()], pa.binary())
    yield pa.RecordBatch.from_arrays([weights, pa.array([float(bias)])], ["weights", "bias"])


class Model:
    def __init__(self, broadcast, slope: float, offset: float):
        self.broadcast, self.slope, self.offset = broadcast, slope, offset

    def score(self, margin: Column) -> Column:
        z = margin * self.slope + self.offset
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def _logistic(margin: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted, slightly damped logistic curve."""
    x = np.column_stack((margin, np.ones(len(margin))))
    beta = np.zeros(2)
    damp = np.diag([1e-2, 1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + damp @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + damp
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """Fit on at most `sample` texts of either label, of those ids (column doc_id)
    for which `train` holds.  The sample's segments are fitted in one task, so the driver
    holds the weights only."""
    spark = docs.sparkSession
    marked = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    marked = marked.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if train is not None:
        marked = marked.filter(train)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = dict(marked.groupBy("toxic").count().collect())  # one row per label
    chosen = [
        marked.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        for k in (0, 1)
    ]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * sample rows
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        picked, "doc_id"
    )
    counted = texts.select("text", "toxic").mapInArrow(
        _contexts_of, "segment string, before string, toxic int"
    )
    found = (
        counted.distinct()
        .groupBy("segment")
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum(1 - F.col("toxic")).alias("clean"),
        )
    )
    share = totals.get(1, 0) / max(1, totals.get(0, 0) + totals.get(1, 0))
    none = Model(None, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    if not totals.get(0) or not totals.get(1):
        return none
    # the segments of the sample, however many texts there are
    fitted = found.repartition(1).mapInArrow(_fitted, "weights binary, bias double").collect()
    table = np.frombuffer(fitted[0].weights, np.float32) if fitted else np.zeros(0)
    if not table.any():
        return none
    bias = fitted[0].bias
    name = f"{hash_of(table.tobytes().hex()[:4096])}-{bias}"
    model = spark.sparkContext.broadcast((name, table, bias))  # 4 MB
    shown = _margins(texts, model).select("toxic", "margin").collect()  # the sample
    toxic = np.array([r.toxic for r in shown], float)
    margin = np.array([r.margin for r in shown], float)
    weight = np.where(toxic > 0, totals[1] / max(1, toxic.sum()), totals[0] / max(1, (1 - toxic).sum()))
    slope, offset = _logistic(margin, toxic, weight / weight.mean())
    return Model(model, slope, offset)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of `docs` as struct `row`, and `score`."""
    # a text goes to the worker and back once
    others = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in docs.columns if c != text])
    rows = docs.select(others.alias("others"), F.col(text).alias("text"))
    if model.broadcast is None:
        margins = rows.withColumn("margin", F.lit(0.0))
    else:
        margins = _margins(rows, model.broadcast, keep_text=True)
    whole = F.struct(*[(F.col("text") if c == text else F.col("others").getField(c)).alias(c) for c in docs.columns])
    return margins.select(whole.alias("row"), model.score(F.col("margin")).alias("score"))


def clean(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    limit: float = 0.5,
) -> DataFrame:
    """The rows of `docs` whose score is under `limit`."""
    model = fit(docs, labels, train, text, doc_id)
    return score(docs, model, text).filter(F.col("score") < limit).select("row.*")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    slim = docs.select("doc_id", "text")
    if model.broadcast is None:
        margins = slim.select("doc_id", F.lit(0.0).alias("margin"))
    else:
        margins = _margins(slim, model.broadcast)
    found = margins.select("doc_id", model.score(F.col("margin")).alias("score"))
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
