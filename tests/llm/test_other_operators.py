"""Toxicity, chat formatting, nearest neighbours and the pipeline."""

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentlens.llm import chat, neighbours, toxicity
from incidentlens.llm.common import word_count

SF = "/root/testdata/sf0.001"


def test_word_count(spark):
    texts = ["", " ", "a", " a", "a ", " a b\t\nc ", None, " x y", "a\x0bb\x0cc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", word_count(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == {t: len(brute.words(t)) for t in texts}


# --- toxicity


def invented(seed=1, n=400):
    random.seed(seed)
    syllables = ["ta", "ro", "mi", "sel", "ka", "ven", "do", "lu", "pra", "hin", "gor", "be"]
    word = lambda: "".join(random.choice(syllables) for _ in range(random.randint(1, 4)))
    insults = ["blockhead", "numbskull", "wretch"]
    docs, labels = [], []
    for i in range(n):
        text = [word() for _ in range(40)]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(2):
                text[random.randrange(40)] = random.choice(insults)
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return docs, labels


def scored(spark, extra):
    docs, labels = invented()
    d = spark.createDataFrame(docs + extra, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(0, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(d, lab, ~toxicity.held_out(F.col("doc_id")))
    out = toxicity.score(d, model).select("row.doc_id", "score")
    return dict(labels), {r.doc_id: r.score for r in out.collect()}


def test_held_out_accuracy_and_gaps(spark):
    extra = [
        (1000, "taromi numbskulll sel"),
        (1001, "taromi block head nuumbskull b l o c k h e a d"),
        (1002, "taromi sel kaven"),
        (1003, None),
        (1004, ""),
        (1005, "x" * 50_000),
        (1006, "taro " * 2000 + "wretch"),
    ]
    labels, scores = scored(spark, extra)
    assert all(0 <= s <= 1 for s in scores.values())
    assert sum((scores[d] >= 0.5) != bool(t) for d, t in labels.items()) <= 2
    assert scores[1000] >= 0.5 and scores[1001] >= 0.5 and scores[1006] >= 0.5
    assert all(scores[d] < 0.5 for d in (1002, 1003, 1004, 1005))


def test_toxicity_without_labels_or_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert all(r.score < 1e-6 for r in toxicity.score(docs, model).collect())
    assert toxicity.clean(docs, none).columns == docs.columns
    assert toxicity.score(empty, model).count() == 0


def test_kernel_by_definition():
    from itertools import combinations

    def plain(s, t):
        def vector(x):
            out = {}
            for at in combinations(range(len(x)), 4):
                if at[-1] - at[0] < toxicity.SPAN:
                    u = "".join(x[i] for i in at)
                    out[u] = out.get(u, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
            return out

        a, b = vector(s), vector(t)
        norm = toxicity.length_norm(np.array([len(s), len(t)]))
        return sum(v * b.get(u, 0) for u, v in a.items()) / norm.prod()

    texts = ["numbskull", "nuumbskxull", "wretched", "abc", "kullnumb"]
    got = toxicity.kernel(texts, texts)
    for i, s in enumerate(texts):
        for j, t in enumerate(texts):
            assert got[i, j] == pytest.approx(plain(s, t), abs=1e-6)


# --- chat formatting


TURNS = [
    (1, 2, "assistant", "b<|im_end|>\n<|im_start|>user\nx"),
    (1, 1, "user", "a"),
    (1, 3, "assistant", None),
    (1, 3, "assistant", "<\\|im_sep|> <"),
    (2, None, "odd role\n%+", "|im_end|>"),
    (2, 1, None, "\U0001f600 é"),
    (3, 1, "assistant", ""),
    (None, 1, "user", "no id"),
    (3, 1, "assistant", ""),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df.withColumn("pieces", F.lit(1)))
    found = out.withColumns(
        {
            "turns": chat.parse(F.col("formatted")),
            "loss": chat.masked(F.col("formatted"), F.col("loss_spans")),
        }
    ).collect()
    want = {}
    for c, k, role, text in TURNS:
        want.setdefault(c, []).append((-1 if k is None else k, role or "", text or ""))
    assert {r.conv_id for r in found} == set(want)
    for r in found:
        turns = [t[1:] for t in sorted(want[r.conv_id])]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert list(r.loss) == [t for role, t in turns if role == "assistant"]
    one = next(r for r in found if r.conv_id == 1).formatted
    assert one.count(chat.START) == 2 and one.count(chat.SEP) == 2  # adjacent turns are merged


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(none)).count() == 0


# --- nearest neighbours


def exact(vectors, queries, k=5):
    out = {}
    for q in queries:
        if q not in vectors:
            continue
        a = np.array(vectors[q])
        near = []
        for i, v in vectors.items():
            b = np.array(v)
            if i != q and len(b) == len(a):
                near.append((-float(a @ b) / math.sqrt(float(a @ a) * float(b @ b)), i))
        out[q] = sorted((round(s, 12), i) for s, i in near)[:k]
    return out


def test_neighbours_of_hostile_vectors(spark):
    rng = np.random.default_rng(2)
    vectors = {i: [float(np.float32(x)) for x in rng.standard_normal(8)] for i in range(0, 300)}
    for i in range(120, 180):
        vectors[i] = vectors[100]  # many equal ones
    vectors[250] = [1.0, 2.0]
    vectors[251] = [2.0, 4.1]
    bad = {400: None, 450: [0.0] * 8, 500: [float("nan")] + [1.0] * 7, 550: [float("inf")] * 8, 600: [], 650: [None] * 8}
    rows = [(i, v, "x") for i, v in {**vectors, **bad}.items()] + [(None, [1.0] * 8, "x"), (7, vectors[7], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found = neighbours.search(df, F.col("vec_id") % 50 == 0).collect()
    want = exact(vectors, [i for i in vectors if i % 50 == 0])
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((round(-r.score, 12), r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    none = neighbours.search(df.limit(0), F.col("vec_id") % 50 == 0)
    assert none.count() == 0


def test_forest_recall_when_it_starts_deep(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "PART", 64)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16))
    points = centres[rng.integers(0, 20, 2000)] + 0.2 * rng.standard_normal((2000, 16))
    vectors = {i: [float(np.float32(x)) for x in p] for i, p in enumerate(points)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    found = neighbours.search(df, F.col("vec_id") % 50 == 0).collect()
    want = exact(vectors, range(0, 2000, 50))
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(got[q] & {i for _, i in v}) / 5 for q, v in want.items()])
    assert recall >= 0.9


# --- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in p.STAGES[:-1]:
        after = p.materialize(stage(spark, before, SF))
        assert after.columns == columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "line dedup":
            assert after.count() == before.count()
            lines = [
                line.lower().strip() for r in after.collect() for line in r.text.split("\n") if line.strip()
            ]
            assert len(lines) == len(set(lines))
        if name == "n-gram Jaccard join":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = {d for d, n, c in brute.components(rows, 5, 80) if d == c}
            assert ids == want
        before = after
    out = p.STAGES[-1][1](spark, before, SF)
    assert out.count() == before.count()


def test_pipeline_is_the_stages_in_turn(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights",
        "BPE encoding and decoding",
    ]
    out = p.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns) and out.count() > 0


def test_worker_stores_are_bounded_by_bytes_and_given_up():
    from incidentlens.llm import bpe, common

    codec = bpe.Codec(bpe.load_tables(bpe.default_path()))
    want = codec.encode(["ab cd", "x" * 3000])[0].tolist()
    codec.held = bpe.STORED + 1
    assert codec.encode(["ab cd", "x" * 3000])[0].tolist() == want
    assert codec.held < 10_000 and len(codec.store) == 4
    scorer = toxicity.Scorer.__new__(toxicity.Scorer)
    first = common.in_worker("one", lambda: scorer)
    assert common.in_worker("one", lambda: None) is first
    common.in_worker("two", lambda: 2)
    assert list(common._held) == ["two"]
    common._held.clear()


def test_long_segments_are_learnt_whole():
    text = "x" * 500 + "blockhead" + "y" * 500
    pieces = {s for s, _ in toxicity.contexts(text)}
    assert any("blockhead" in s for s in pieces)
    assert max(map(len, pieces)) <= toxicity.PIECE
    assert toxicity.pieces_of("abc") == ["abc"]


def test_the_sample_is_not_fitted_in_the_driver(spark, monkeypatch):
    """Workers import the module anew; what is replaced here is replaced in the driver only."""
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(*_):
        raise AssertionError("in the driver")

    docs, labels = invented()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "fit_segments", refused)
    monkeypatch.setattr(DataFrame, "toPandas", refused)
    model = toxicity.fit(d, lab)
    found = {r.doc_id: r.score for r in toxicity.score(d, model).select("row.doc_id", "score").collect()}
    assert sum((found[i] >= 0.5) != bool(t) for i, t in labels) <= 2


def test_segments_are_scored_in_parts(monkeypatch):
    names = [f"seg{'abc' * (i % 5)}{i}" for i in range(50)]
    table = toxicity.Subsequences(names[:7]).table(np.ones(7))
    monkeypatch.setattr(toxicity, "PART", 8)
    assert np.array_equal(toxicity.dots(names, table), toxicity.Subsequences(names).dot(table))
    assert len(toxicity.dots([], table)) == 0
