"""Substring dedup by prefix-partitioned suffix trees.

A word goes if it lies in a window of 20 words whose word sequence also starts
earlier (in a document of smaller id, or earlier in the same one).

Suffixes are sampled so that equal windows sample equal suffixes: of the runs of five
words in a window the one with the smallest hash starts the window's suffix.  The
windows that share a suffix form its segment, at most sixteen windows in a row.
Suffixes are split into groups by prefix: the five words, or, where these are too
frequent for one group, the segment's whole sequence.  A group is a subtree held in
memory by one task.  Its suffixes are sorted by five-word prefix, then by segment:

- a node whose leaves share the whole segment is a repeat of at least 20 words; all
  its leaves but the first start a repeat, and their segments go as a whole;
- a five-word node with several segments below may hold further repeats, shorter than
  the segments: the first leaf of each is read again, and its single windows are
  grouped and sorted in the same way;
- any other suffix is a leaf of its own.

Before suffixes are shuffled, each task keeps the first of equal ones, so a passage
that a third of all documents share reaches a group once per task.

Cases: a null or blank text has no words; texts shorter than a window lose none; copies
lose all windows but the first one's; rows that repeat a doc_id are the same document if
their texts are equal, and else documents of their own, in the order of a hash of the
text, so a row loses only words found in its own text; rows without doc_id come first,
likewise; an empty table gives an empty result.  Sequences are compared by 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import byte_slices
from .wordhash import U, arrow_texts, mix, run_hashes, spans, word_hashes

WINDOW = 20
PREFIX = 5
SLICE_BYTES = 2_000_000
COUNTERS = 1 << 18
COUNTER_ROWS = 64
GROUP_ROWS = 200_000
BROADCAST_ROWS = 500_000
NO_ID = -(2**63)


class Windows:
    """The windows of the texts of a slice: which text each is in, its word
    number there, its hash; and the suffix it belongs to."""

    def __init__(self, column, window: int):
        data, bounds = arrow_texts(column)
        starts, ends, doc = spans(data, bounds)
        words = word_hashes(data, starts, ends)
        self.first_word = np.searchsorted(doc, np.arange(len(column)))
        whole = run_hashes(words, window)
        self.at = np.flatnonzero(doc[: len(whole)] == doc[window - 1 :]) if len(whole) else (
            np.zeros(0, np.int64)
        )
        self.doc = doc[self.at]
        self.word = self.at - self.first_word[self.doc]
        self.hash = whole[self.at]
        self.prefixes = run_hashes(words, PREFIX)
        self.reach = window - PREFIX + 1

    def suffixes(self):
        """For each suffix: prefix hash, segment hash, first window (as an index
        of `at`), number of windows."""
        if len(self.at) == 0:
            return np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        view = np.lib.stride_tricks.sliding_window_view(self.prefixes, self.reach)
        anchor = view.argmin(1)[self.at] + self.at
        fresh = (anchor[1:] != anchor[:-1]) | (self.at[1:] != self.at[:-1] + 1)
        lead = np.flatnonzero(np.concatenate(([True], fresh)))
        count = np.diff(np.append(lead, len(self.at)))
        prefix = self.prefixes[anchor[lead]]
        # the first and the last window cover the segment between them
        segment = mix(
            self.hash[lead] * U(3)
            + self.hash[lead + count - 1]
            + (anchor[lead] - self.at[lead]).astype(U) * U(0x9E3779B97F4A7C15)
            + count.astype(U) * U(0xD1B54A32D192ED03)
        )
        return prefix, segment, lead, count


def _counters(prefix: np.ndarray) -> np.ndarray:
    return (prefix % U(COUNTERS)).astype(np.int64)


def _survey(window: int):
    """Counts of suffixes by prefix hash, in a table of fixed size per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                prefix = Windows(part.column("text"), window).suffixes()[0]
                counts += np.bincount(_counters(prefix), minlength=COUNTERS)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(COUNTER_ROWS, dtype=np.int32)),
                pa.array(list(counts.reshape(COUNTER_ROWS, -1)), pa.list_(pa.int64())),
            ],
            names=["block", "counts"],
        )

    return run


def _prefix_counts(docs: DataFrame, window: int) -> np.ndarray:
    blocks = docs.select("text").mapInArrow(_survey(window), "block int, counts array<long>")
    summed = (
        blocks.select("block", F.posexplode("counts"))
        .groupBy("block", "pos")
        .agg(F.sum("col").alias("n"))
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("counts"))
    )
    out = np.zeros((COUNTER_ROWS, COUNTERS // COUNTER_ROWS), np.int64)
    for block, counts in summed.select("block", F.col("counts.n")).collect():  # fixed size
        out[block] = counts
    return out.ravel()


def _firsts(keys: list[np.ndarray], doc: np.ndarray, version: np.ndarray, start: np.ndarray):
    """Order by keys, document, text, start; and where a new key begins in that order."""
    order = np.lexsort((start, version, doc, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    return order, new


ROWS = ["part", "prefix", "segment", "doc", "version", "start", "count", "known"]
ROWS_SCHEMA = (
    "part long, prefix long, segment long, doc long, version long, start long, count int,"
    " known boolean"
)


def _sampled(window: int, long_prefixes, groups: int):
    """Suffix rows of a task: the first of equal ones to the group of its prefix,
    the later ones (`known`) anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            versions = batch.column("version").to_numpy(zero_copy_only=False)
            at = 0
            for part in byte_slices(batch, "text", SLICE_BYTES):
                w = Windows(part.column("text"), window)
                prefix, segment, lead, count = w.suffixes()
                doc = ids[at : at + part.num_rows][w.doc[lead]]
                version = versions[at : at + part.num_rows][w.doc[lead]]
                found.append((prefix, segment, doc, version, w.word[lead], count.astype(np.int32)))
                at += part.num_rows
        if not found:
            return
        prefix, segment, doc, version, start, count = map(np.concatenate, zip(*found))
        del found
        order, new = _firsts([prefix, segment], doc, version, start)
        prefix, segment, doc, version, start, count = (
            x[order] for x in (prefix, segment, doc, version, start, count)
        )
        longer = long_prefixes.value[_counters(prefix)]
        key = np.where(longer, mix(prefix + segment), mix(prefix))
        part = (np.where(new, key, mix(doc.astype(U))) % U(groups)).astype(np.int64)
        for lo in range(0, len(part), 50_000):
            cut = slice(lo, lo + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[cut]),
                    pa.array(prefix[cut].view(np.int64)),
                    pa.array(segment[cut].view(np.int64)),
                    pa.array(doc[cut]),
                    pa.array(version[cut]),
                    pa.array(start[cut]),
                    pa.array(count[cut]),
                    pa.array(~new[cut]),
                ],
                names=ROWS,
            )

    return run


SPANS_SCHEMA = "doc long, version long, start long, count int, again boolean"


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _spans_table(doc, version, start, count, again) -> pa.Table:
    return pa.table(
        {
            "doc": pa.array(doc, pa.int64()),
            "version": pa.array(version, pa.int64()),
            "start": pa.array(start, pa.int64()),
            "count": pa.array(count, pa.int32()),
            "again": pa.array(again, pa.bool_()),
        }
    )


def _subtree(long_prefixes):
    """Runs of windows that go, and those to be looked at one by one (`again`)."""

    def run(table: pa.Table) -> pa.Table:
        known = _column(table, "known")
        doc, version, start, count = (
            _column(table, c) for c in ("doc", "version", "start", "count")
        )
        old = np.flatnonzero(known)
        own = np.flatnonzero(~known)
        prefix = _column(table, "prefix")[own].view(U)
        segment = _column(table, "segment")[own].view(U)
        order, new = _firsts([prefix, segment], doc[own], version[own], start[own])
        own, prefix = own[order], prefix[order]
        heads = np.flatnonzero(new)
        kids = prefix[heads]
        fresh = np.concatenate(([True], kids[1:] != kids[:-1])) if len(kids) else np.zeros(0, bool)
        node = np.cumsum(fresh) - 1
        several = np.bincount(node, minlength=1)[node] > 1 if len(node) else fresh
        several |= long_prefixes.value[_counters(kids)]
        gone = np.concatenate((old, own[~new]))
        again = own[heads[several]]
        rows = np.concatenate((gone, again))
        return _spans_table(
            doc[rows], version[rows], start[rows], count[rows], np.arange(len(rows)) >= len(gone)
        )

    return run


def _single(window: int, groups: int):
    """Single windows of the runs to be looked at again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            versions = batch.column("version").to_numpy(zero_copy_only=False)
            at = 0
            for part in byte_slices(batch, "text", SLICE_BYTES):
                w = Windows(part.column("text"), window)
                runs = part.column("runs")
                sizes = np.diff(runs.offsets.to_numpy())
                flat = runs.flatten()
                row = np.repeat(np.arange(part.num_rows), sizes)
                start = flat.field("start").to_numpy()
                count = flat.field("count").to_numpy().astype(np.int64)
                # windows of a text follow each other, from its word 0 on
                lead = np.searchsorted(w.doc, np.arange(part.num_rows))
                room = np.bincount(w.doc, minlength=part.num_rows)[row]
                count = np.clip(room - start, 0, count)
                from_ = np.cumsum(count) - count
                index = np.repeat(lead[row] + start - from_, count) + np.arange(int(count.sum()))
                index = np.unique(index)
                doc = ids[at : at + part.num_rows][w.doc[index]]
                version = versions[at : at + part.num_rows][w.doc[index]]
                found.append((w.hash[index], doc, version, w.word[index]))
                at += part.num_rows
        if not found:
            return
        hashes, doc, version, start = map(np.concatenate, zip(*found))
        del found
        order, new = _firsts([hashes], doc, version, start)
        hashes, doc, version, start = (x[order] for x in (hashes, doc, version, start))
        part = (np.where(new, hashes, mix(doc.astype(U))) % U(groups)).astype(np.int64)
        for lo in range(0, len(part), 50_000):
            cut = slice(lo, lo + 50_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[cut]),
                    pa.array(hashes[cut].view(np.int64)),
                    pa.array(doc[cut]),
                    pa.array(version[cut]),
                    pa.array(start[cut]),
                    pa.array(~new[cut]),
                ],
                names=["part", "hash", "doc", "version", "start", "known"],
            )

    return run


def _leaves(table: pa.Table) -> pa.Table:
    known = _column(table, "known")
    doc, version, start = (_column(table, c) for c in ("doc", "version", "start"))
    own = np.flatnonzero(~known)
    order, new = _firsts(
        [_column(table, "hash")[own].view(U)], doc[own], version[own], start[own]
    )
    gone = np.concatenate((np.flatnonzero(known), own[order][~new]))
    one = np.ones(len(gone), np.int32)
    return _spans_table(doc[gone], version[gone], start[gone], one, np.zeros(len(gone), bool))


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW):
    """Runs of windows that also start earlier: doc, version (hash of the text), start (word number of the first
    window), count (of windows); the words from start to start + count + window - 2 go."""
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("version"),
        F.col(text).alias("text"),
    )
    counts = _prefix_counts(source, window)
    groups = max(1, int(counts.sum()) // GROUP_ROWS + 1)
    longer = spark.sparkContext.broadcast(counts > GROUP_ROWS // 8)  # one byte a counter
    first = materialize(
        source.mapInArrow(_sampled(window, longer, groups), ROWS_SCHEMA)
        .groupBy("part")
        .applyInArrow(_subtree(longer), SPANS_SCHEMA)
    )
    again = first.filter("again")
    lists = materialize(
        again.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "count")).alias("runs"))
    )
    texts = source
    if lists.count() <= BROADCAST_ROWS:
        texts = source.join(F.broadcast(lists.select("doc", "version")), ["doc", "version"], "left_semi")
    total = again.agg(F.sum("count")).first()[0] or 0
    second = materialize(
        texts.join(lists, ["doc", "version"])
        .select("doc", "version", "text", "runs")
        .mapInArrow(
            _single(window, int(total) // GROUP_ROWS + 1),
            "part long, hash long, doc long, version long, start long, known boolean",
        )
        .groupBy("part")
        .applyInArrow(_leaves, SPANS_SCHEMA)
    )
    return first.filter("not again").unionByName(second).select("doc", "version", "start", "count")


def _cut(window: int):
    """Texts without the words of the given runs, joined by one blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                rows = part.num_rows
                data, bounds = arrow_texts(part.column("text"))
                starts, ends, doc = spans(data, bounds)
                first = np.searchsorted(doc, np.arange(rows + 1))
                runs = part.column("runs")
                row = np.repeat(np.arange(rows), np.diff(runs.offsets.to_numpy()))
                flat = runs.flatten()
                start = flat.field("start").to_numpy()
                stop = start + flat.field("count").to_numpy() + window - 1
                size = np.diff(first)
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, first[row] + np.minimum(start, size[row]), 1)
                np.add.at(edge, first[row] + np.minimum(stop, size[row]), -1)
                keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                kept = np.bincount(doc[keep], minlength=rows)
                lens = (ends - starts)[keep]
                # every kept word and a blank, then without the last blank of a text
                room = lens + 1
                to = np.cumsum(room) - room
                out = np.full(int(room.sum()), 0x20, np.uint8)
                within = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
                out[np.repeat(to, lens) + within] = data[np.repeat(starts[keep], lens) + within]
                last = np.cumsum(kept)
                cut = (to + lens)[last[kept > 0] - 1]
                size_of = np.bincount(doc[keep], weights=room, minlength=rows).astype(np.int64)
                offsets = np.concatenate(([0], np.cumsum(size_of - (kept > 0)))).astype(np.int32)
                text = pa.StringArray.from_buffers(
                    rows, pa.py_buffer(offsets), pa.py_buffer(np.delete(out, cut))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(size.astype(np.int64)),
                        pa.array((size - kept).astype(np.int64)),
                        text,
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return run


def without_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one blank)."""
    runs = materialize(
        repeats(docs, text, doc_id, window)
        .groupBy("doc", "version")
        .agg(F.collect_list(F.struct("start", "count")).alias("runs"))
    )
    source = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("version"),
        F.col(text).alias("text"),
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    none = F.array().cast("array<struct<start:bigint,count:int>>")
    whole = source.join(runs, ["doc", "version"], "left").select(
        "doc_id", "text", F.coalesce("runs", none).alias("runs")
    )
    return whole.mapInArrow(
        _cut(window), f"doc_id {id_type}, n_words long, n_removed long, kept string"
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    found = without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
