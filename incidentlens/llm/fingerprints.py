"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line, cut into pieces of about forty characters that end with a
word or a sentence.  A section ends after a paragraph whose digest says so, or with
the text, so an edit moves no section border but its own.  A section's digest covers
its paragraphs' digests, and the root covers the sections'.

The fingerprint is a string: the root, ":", then the short digests of the first
twenty-four two-character heads of the text, ":", then those of the pieces, with "." after
a paragraph and "/" after one that ends a section.  Equal roots mean equal texts; where
roots differ, the branches that differ show where.  The heads keep very short texts
comparable.

Cases: a null text is an empty one; equal texts have equal fingerprints whatever
their row; two empty texts are alike (1.0), an empty and another text are not (0.0);
rows that repeat a doc_id share their neighbours, and the smallest fingerprint of the
next id counts; rows without doc_id come last; a single document is its own next
one; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import with_neighbours
from ..session import materialize

DIGITS = 6
HEADS, HEAD_CHARS = 24, 2
# up to forty characters within a sentence, the rest of the word, its full stops
PIECE = r"[^.!?]{1,40}[^\x20\x09-\x0D.!?]*[.!?]*"
LAST_ID = -(2**63)


def _short(value: Column) -> Column:
    return F.substring(F.md5(value), 1, DIGITS)


def _ends_section(digest: Column) -> Column:
    return digest < "4"


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    lines = F.transform(
        F.split(text, "\n"),
        lambda line: F.struct(
            F.md5(line).alias("digest"),
            F.array_join(
                F.transform(F.regexp_extract_all(line, F.lit(PIECE), F.lit(0)), _short), ""
            ).alias("pieces"),
        ),
    )

    def closed(field: str) -> Column:
        return F.array_join(
            F.transform(
                lines,
                lambda p: F.concat(
                    p[field], F.when(_ends_section(p["digest"]), "/").otherwise(".")
                ),
            ),
            "",
        )

    root = F.md5(F.array_join(F.transform(F.split(closed("digest"), "/"), F.md5), ""))
    heads = F.filter(
        F.transform(
            F.array(*[F.lit(i) for i in range(HEADS)]),
            lambda i: F.substr(text, i * HEAD_CHARS + 1, F.lit(HEAD_CHARS)),
        ),
        lambda h: h != "",
    )
    tagged = F.transform(heads, lambda h, i: _short(F.concat(i.cast("string"), F.lit(":"), h)))
    return F.concat_ws(":", root, F.array_join(tagged, ""), closed("pieces"))


def _leaves(mark: Column) -> Column:
    return F.array_distinct(
        F.regexp_extract_all(F.substr(mark, F.lit(34)), F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))
    )


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: shared leaves of two fingerprints, twice, over all their leaves."""
    one, other = _leaves(a), _leaves(b)
    total = F.size(one) + F.size(other)
    shared = F.size(F.array_intersect(one, other))
    return (
        F.when(F.substring(a, 1, 32) == F.substring(b, 1, 32), F.lit(1.0))
        .when(total == 0, F.lit(0.0))
        .otherwise((shared * 2).cast("double") / total)
    )


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Positions of the paragraphs of `a` that `b` lacks.  Sections that both have
    are passed over whole."""

    def sections(mark: Column) -> Column:
        return F.split(F.element_at(F.split(mark, ":"), 3), "(?<=/)")

    theirs = F.split(F.array_join(F.array_except(sections(b), sections(a)), ""), "(?<=[./])")
    mine = F.transform(
        sections(a),
        lambda s: F.transform(
            F.filter(F.split(s, "(?<=[./])"), lambda p: p != ""),
            lambda p: F.struct(p.alias("p"), F.array_contains(sections(b), s).alias("same")),
        ),
    )
    return F.filter(
        F.transform(
            F.flatten(mine),
            lambda x, i: F.when(~x["same"] & ~F.array_contains(theirs, x["p"]), i),
        ),
        lambda i: i.isNotNull(),
    )


def _neighbours(rows: DataFrame) -> DataFrame:
    """For each id: who comes before it in descending order, and how many code
    points that one takes of it (the one before the first is the last)."""
    ids = rows.groupBy("key").agg(F.max("third").alias("third"))
    around = materialize(with_neighbours(ids, "key", "_lower", "_higher"))
    ends = around.agg(F.min(F.struct("key", "third")).alias("low")).select(
        F.col("low.key").alias("_low"), F.col("low.third").alias("_low_third")
    )
    above = around.select(F.col("key").alias("before"), F.col("third").alias("taken"))
    return (
        around.join(F.broadcast(ends))  # one row
        .withColumn("before", F.coalesce("_higher", "_low"))
        .join(above, "before")
        .select("key", "before", "taken")
    )


def edited_fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Every row's fingerprint, that of its edited text (the last third replaced by
    the beginning of the next document), and their likenesses."""
    value = F.coalesce(F.col(text), F.lit(""))
    # nothing but key and text, so that both joins below share one exchange of the texts
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("key"), value.alias("text")
    )
    id_type = docs.select(F.col(doc_id)).schema[0].dataType
    third = F.floor(F.length("text") / 3).cast("int")
    sizes = materialize(rows.select("key", third.alias("third")))
    near = materialize(_neighbours(sizes))
    told = rows.join(near, "key").select(
        F.col("before").alias("key"),
        F.substr("text", F.lit(1), F.col("taken")).alias("given"),
        fingerprint(F.col("text")).alias("next_fingerprint"),
    )
    if near.count() < sizes.count():  # rows repeat an id
        told = (
            told.groupBy("key")
            .agg(F.min(F.struct("next_fingerprint", "given")).alias("x"))
            .select("key", "x.given", "x.next_fingerprint")
        )
    edited = F.concat(
        F.substr("text", F.lit(1), F.length("text") - third),
        # repeated ids may differ in length: each takes its own third of what is given
        F.substr("given", F.lit(1), third),
    )
    named = F.when(F.col("key") != LAST_ID, F.col("key")).cast(id_type).alias("doc_id")
    both = rows.join(told, "key").select(named, "text", edited.alias("edited"), "next_fingerprint")
    marked = both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    return marked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return edited_fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    length(coalesce(text, '')) // 3 AS third FROM documents),
near AS (
  SELECT d.*, coalesce(lead(text) OVER w, (SELECT arg_max(text, doc_id) FROM docs)) AS next
  FROM docs d WINDOW w AS (ORDER BY doc_id DESC)),
edits AS (
  SELECT doc_id, n, text, next, substr(text, 1, n - third) || substr(next, 1, third) AS edited
  FROM near),
texts AS (SELECT DISTINCT unnest([text, next, edited]) AS t FROM edits),
lines AS (
  SELECT t, list_transform(string_split(t, chr(10)), lambda l: {
    'digest': md5(l),
    'close': CASE WHEN md5(l) < '4' THEN '/' ELSE '.' END,
    'pieces': array_to_string(list_transform(
      regexp_extract_all(l, '[^.!?]{1,40}[^\x20\x09-\x0D.!?]*[.!?]*'), lambda p: substr(md5(p), 1, 6)), '')
  }) AS ls FROM texts),
marks AS (
  SELECT t,
    md5(array_to_string(list_transform(string_split(
      array_to_string(list_transform(ls, lambda x: x.digest || x.close), ''), '/'), lambda s: md5(s)), ''))
    || ':' || array_to_string(list_transform(list_filter(range(24), lambda i: i * 2 < length(t)),
      lambda i: substr(md5(CAST(i AS VARCHAR) || ':' || substr(t, CAST(i * 2 + 1 AS BIGINT), 2)), 1, 6)), '')
    || ':' || array_to_string(list_transform(ls, lambda x: x.pieces || x.close), '') AS mark
  FROM lines),
leaves AS (
  SELECT t, mark, list_distinct(regexp_extract_all(substr(mark, 34), '[0-9a-f]{6}')) AS leaf FROM marks),
joined AS (
  SELECT e.doc_id, e.n, e.edited, a.mark AS fingerprint, b.mark AS edited_fingerprint,
    a.leaf AS x, b.leaf AS y, c.leaf AS z, c.mark AS next_fingerprint
  FROM edits e JOIN leaves a ON a.t = e.text JOIN leaves b ON b.t = e.edited JOIN leaves c ON c.t = e.next)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN fingerprint = edited_fingerprint THEN 1.0::DOUBLE WHEN len(x) + len(y) = 0 THEN 0.0::DOUBLE
    ELSE CAST(2 * len(list_intersect(x, y)) AS DOUBLE) / (len(x) + len(y)) END AS near_edited,
  CASE WHEN fingerprint = next_fingerprint THEN 1.0::DOUBLE WHEN len(x) + len(z) = 0 THEN 0.0::DOUBLE
    ELSE CAST(2 * len(list_intersect(x, z)) AS DOUBLE) / (len(x) + len(z)) END AS near_next
FROM joined
"""
