"""Merkle manifest, page templates and hard negatives against plain counterparts."""

import hashlib
import html
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentlens.llm import manifest, negatives, templates

SF = "/root/testdata/sf0.001"
H = lambda s: hashlib.sha256(s.encode()).hexdigest()


# --- manifest


def plain_leaf(row):
    told = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return H("".join(told))


def plain_tree(digests):
    """Root and, per leaf, its proof: (before, after) per level."""
    proofs = [[] for _ in digests]
    under = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(k, min(k + 16, len(digests))) for k in range(0, len(digests), 16)]
        for run in runs:
            for i in run:
                own = ("".join(digests[j] for j in run if j < i), "".join(digests[j] for j in run if j > i))
                for leaf in under[i]:
                    proofs[leaf].append(own)
        under = [[x for i in run for x in under[i]] for run in runs]
        digests = [H("".join(digests[i] for i in run)) for run in runs]
    return digests[0], proofs


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted (doc_id, leaf, subroot, root, proof)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    root, above = plain_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, above):
        for x, proof in zip(sorted(by[s], key=lambda x: x[:3]), trees[s][1]):
            out.append((str(x[3]), x[2], trees[s][0], root, tuple(proof + top)))
    return sorted(out)


def found_manifest(docs):
    rows = manifest.manifest(docs).collect()
    return sorted(
        (str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in rows
    )


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_manifest_of_hostile_rows(docs, repeated):
    for df in (docs, repeated):
        want = plain_manifest([tuple(r) for r in df.select(FIELDS).collect()])
        assert found_manifest(df) == want


@pytest.mark.parametrize("sizes", [[1], [1, 1], [16], [17, 1], [256, 257, 2], [5000, 3]])
def test_manifest_of_all_depths(spark, sizes):
    rows = [(i * 7919 % 99991, f"s{k}", "en", i, f"t{i}") for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert found_manifest(df) == plain_manifest(rows)


def test_manifest_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(FIELDS).collect()]
    want = {d: (leaf, sub, root, proof) for d, leaf, sub, root, proof in plain_manifest(rows)}
    texts = {str(r[0]): r for r in rows}
    lower = str.maketrans(manifest.UPPER, manifest.LOWER)
    got = manifest.query(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        leaf, sub, root, proof = want[str(r.doc_id)]
        row = texts[str(r.doc_id)]
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            row = (*row[:4], row[4] and row[4].translate(lower))
        folded = plain_leaf(row)
        for before, after in proof:
            folded = H(before + folded + after)
        assert (r.leaf, r.subroot, r.root) == (leaf, sub, root)
        assert r.proof_sha256 == H("".join(b + a for b, a in proof))
        assert r.folded_root == folded and r.verified == (folded == root)
    assert {r.verified for r in got} == {True, False}


def test_empty_manifest(empty):
    assert manifest.manifest(empty).count() == 0


def test_sweeps_deliver_once():
    digests = [H(str(i)) for i in range(200)]
    top, runs = manifest.sweep_up(digests, 2)
    proofs = manifest.sweep_down(runs, 200, [("x", "y")])
    want, plain = plain_tree(digests)
    assert top == want and proofs == [[*p, ("x", "y")] for p in plain]


# --- page templates


def plain_article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inside = re.sub(r"</?b>", "", inside.replace("<br>", " "))
    blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", inside)]
    return "\n".join(b for b in blocks if b)


def test_pages_of_the_tables(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = templates.query(spark, SF).collect()
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    for r in got:
        assert r.text == plain_article(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    # columns that clash with the operator's own
    df = df.withColumns({"host": F.lit(1), "main": F.lit("m"), "path": F.lit(2.0), "pages": F.lit("x")})
    out = {}
    for r in templates.main_text(df).collect():
        out.setdefault(r.page_id, []).append(r.text)
    return out


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


def shell(title, paragraphs, extra=""):
    """A site without article elements or telling names."""
    body = "".join(f"<p>{p}" for p in paragraphs)
    links = "".join(f'<a href="/{k}">{words(k, 3)}</a> ' for k in range(30))
    return (
        f"<html><head><title>{title} | site</title></head><body><div id=wrap><div class=upper>{links}</div>"
        f"<div class=motto>Always the same long sentence on every page of this site, word for word.</div>"
        f"<div class=inner><h1>{title}</h1>{body}</div><div class=links{extra}>{links}</div></div>"
    )


def test_template_without_article_elements(spark):
    rows, want = [], {}
    for k in range(8):
        paragraphs = [words(100 * k + j, 40) for j in range(3)]
        rows.append((k, "http://plain.example/x", shell(f"Title {k}", paragraphs)))
        want[k] = ["\n".join([f"Title {k}", *paragraphs])]
    assert extracted(spark, rows) == want


def test_fixed_parts_of_pages_without_a_slot(spark):
    fixed = "<div class=motto>The same words on every page of this host, again and again.</div>"
    rows, want = [], {}
    for k in range(6):
        a, b = words(k, 30), words(50 + k, 30)
        rows.append((k, "https://u@flat.example:80/", f"<body>{fixed}<div class=l>{a}</div><div class=r>{b}</div>"))
        want[k] = [f"{a}\n{b}"]
    assert extracted(spark, rows) == want


def test_copies_on_one_host_are_kept(spark):
    page = "<nav><a href=/>Home</a></nav><article><h1>T</h1><p>One text.</p></article><footer>f</footer>"
    other = page.replace("One text", "Another text")
    rows = [(k, "http://copies.example/", page) for k in range(9)] + [(9, "http://copies.example/", other)]
    got = extracted(spark, rows)
    assert all(got[k] == ["T\nOne text."] for k in range(9)) and got[9] == ["T\nAnother text."]


HOSTILE = {
    "": "",
    None: "",
    "no markup &amp; no blocks": "no markup & no blocks",
    "<p>a<p>b<br>c</p>d &lt;p&gt; &eacute &am &#x41;": "a\nb c\nd <p> é &am A",
    "<div><!-- x --><p>kept<script>var a='</p>';</script> too</p><style>p{}</style>": "kept too",
    "<article><p>x < y and 3>2</p><aside>no</aside><form>no</form><div class='ad'>no</div></article>": "x < y and 3>2",
    "<article>a<section class='comments'><p>no</p></section></article><article class=comment>no</article>": "a",
    "<body class='has-sidebar'><main><p>in</p><div hidden>no</div><p style='display: none'>no</p></main>": "in",
    "<article><ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>": "one\ntwo\n1\n2",
    "<article><p>a <span class=share>no</span>b <em>c</em>d</p></article>": "a b cd",
    "<article><h1>T</h1><p>cut off in a tag <a href=": "T\ncut off in a tag",
    "<article><p>a  b\n\tc</p></article><!-- open": "a b c",
    "<p title='a>b' x=it's>text</p>": "text",
    "<script>only script": "",
    "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>": "deep",
}


def test_hostile_pages(spark):
    rows = [(k, (None, "x", "http://one.example/", "http://")[k % 4], page) for k, page in enumerate(HOSTILE)]
    got = extracted(spark, rows)
    assert got == {k: [text] for k, text in enumerate(HOSTILE.values())}


def test_repeated_long_and_missing_pages(spark):
    text = words(1, 60_000)
    rows = [(1, "http://h.example", f"<article><p>{text}</p></article>")] * 2 + [(None, None, None)]
    got = extracted(spark, rows)
    assert got == {1: [text, text], None: [""]}
    none = spark.createDataFrame([], "page_id string, url string, html string")
    out = templates.main_text(none)
    assert out.count() == 0 and out.schema["page_id"].dataType.simpleString() == "string"
    open_tags = templates.Page("<a '" * 50_000 + "<p \"" * 50_000)  # in linear time
    assert open_tags.blocks == []


def test_equivalence_classes():
    t = lambda path, parent, vector, pages=4: dict(path=path, parent=parent, vector=vector, pages=pages)
    found = templates.classes([t(0, 0, 9), t(1, 0, 9), t(2, 1, 9), t(3, 2, 5), t(4, 3, 5), t(6, 5, 9)])
    assert found[0] == found[1] == found[2] and found[3] == found[4] != found[0]
    assert 6 not in found  # what is around it is not in the template


# --- hard negatives


def plain_negatives(rows, every, keep=5, low=80, high=100):
    used = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * float(x))) for x in v]
        used[i] = min(used.get(i, (label, whole)), (label, whole))
    out = []
    for a in used:
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(used[a][1], v)) for i, (_, v) in used.items()}
        order = sorted((i for i in used if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if used[i][0] == used[a][0]][:keep]:
            near = [i for i in order if used[i][0] != used[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(near[:keep], 1)]
    return sorted(out)


def mined(spark, rows, every, **kw):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, label int, embedding array<float>, a string, r int")
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % every == 0, **kw).collect()))


def test_negatives_of_hostile_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, [float(np.float32(x)) for x in rng.standard_normal(13)]) for i in range(-20, 150)]
    rows += [(i, i % 4, rows[5][2]) for i in range(200, 260)]  # one vector under many ids and labels
    rows += [(300, 1, [float("nan")] * 13), (310, 1, [1.0, None]), (320, None, [1.0]), (330, 2, None), (None, 1, [1.0])]
    rows += [(340, 1, []), (350, 2, [0.5] * 40), (360, 0, [float("inf")]), (370, 1, [1e30, -1e30]), (380, 2, [-0.001])]
    rows += rows[:30] + [(0, 2, [9.0] * 13)]
    small = [r for r in rows if r[0] != 370]
    want = plain_negatives(small, 10)
    assert mined(spark, small, 10) == want and want
    assert len(mined(spark, rows, 10)) > 0  # components beyond the bound are held at it


def test_negatives_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 8)
    monkeypatch.setattr(negatives, "ROWS", 50)
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(3)), [float(x) for x in rng.integers(-2, 3, 8)]) for i in range(300)]  # many ties
    assert mined(spark, rows, 7, scale=256.0) == plain_negatives(rows, 7)
    wide = [(i, label, [1000 * x for x in v]) for i, label, v in rows]
    assert mined(spark, wide, 7, positives=3, negatives=3) == plain_negatives(wide, 7, 3)


def test_no_negatives(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert negatives.mine(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert negatives.mine(df, F.col("vec_id") % 5 == 0).count() == 0


def test_tables_give_inner_products():
    rng = np.random.default_rng(5)
    anchors, rows = rng.integers(-200, 200, (7, 21)), rng.integers(-256, 256, (40, 21))
    found = negatives.scores(negatives.tables(anchors, "int64"), negatives.planes(rows, 9))
    assert (found == rows @ anchors.T).all()
