"""BPE encoding and decoding with a published vocabulary, in batched merge rounds.

The words of many texts are encoded together: their symbols lie in one flat array,
the ranks of all adjacent pairs are found by binary search over the sorted pair
keys, every word merges its lowest-ranked pair, and words without a pair left drop
out, until none is left.  Chunks met before are looked up; the store is bounded and
starts afresh when it is full.

Texts are prepared as the vocabulary file says: special tokens are cut out first,
then NFC, lower case, and the file's splitting pattern.  Decoding joins the tokens of
the ids with one blank, as a file without a decoder asks for.

Cases: a null text is an empty one, which has no ids and decodes to an empty text;
repeated rows are encoded like others; an empty table gives an empty result; texts
and words of any length are taken whole."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, in_worker

SLICE_BYTES = 4_000_000
STORED = 64_000_000  # bytes of chunks that a worker stores, an entry with ENTRY more
ENTRY = 120
NONE = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable
    Latin-1, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def load_tables(path: str) -> dict:
    """What the tasks need of a vocabulary file; a few MB, bounded by the file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    tokens = dict((i, t) for t, i in vocab.items())
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens.update((i, t) for t, i in specials.items())
    base = max(tokens) + 1
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    keys = np.array([vocab[a] * base + vocab[b] for a, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int32)
    order = np.argsort(keys, kind="stable")
    symbols = byte_symbols()
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return {
        "path": path,
        "base": base,
        "keys": keys[order],
        "ranks": order.astype(np.int32),
        "made": made[order],
        "inner": np.array([vocab[s] for s in symbols], np.int32),
        "last": np.array([vocab[s + end] for s in symbols], np.int32),
        "tokens": [tokens.get(i, "") for i in range(base)],
        "specials": specials,
        "pattern": split["pattern"]["Regex"],
    }


def gather(flat: np.ndarray, lens: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries `index` of a list of lists (one array, lengths), end to end, and
    the offsets of its entries."""
    starts = np.cumsum(lens) - lens
    size = lens[index]
    ends = np.concatenate(([0], np.cumsum(size)))
    shift = np.repeat(starts[index] - ends[:-1], size)
    return flat[np.arange(ends[-1]) + shift], ends


class Codec:
    def __init__(self, tables: dict):
        self.__dict__.update(tables)
        self.words = regex.compile(self.pattern)
        self.marks = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")"
        )
        self._restart()

    def _restart(self) -> None:
        self.store, self.held = {"": 0}, 0
        self.flat = np.zeros(0, np.int32)
        self.lens = np.zeros(1, np.int64)

    def pieces(self, chunk: str) -> list[str | int]:
        """The words of a text, and the ids of the special tokens between them."""
        out: list[str | int] = []
        parts = self.marks.split(chunk) if "<|" in chunk else [chunk]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.specials[part])
            else:
                plain = unicodedata.normalize("NFC", part)
                # lower case is taken letter by letter: no final sigma
                out += self.words.findall(plain.replace("Σ", "σ").lower())
        return out

    def _ranks(self, ids: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs that start at the positions `left`."""
        key = ids[left].astype(np.int64) * self.base + ids[left + 1]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.made[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word."""
        raw = [w.encode() for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.inner[data]
        ends = np.cumsum(lens) - 1
        ids[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        rank, made = np.full(len(ids), NONE, np.int32), np.zeros(len(ids), np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside], made[inside] = self._ranks(ids, inside)
        done_ids, done_words = [], []
        while len(ids):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.minimum.reduceat(rank, first)
            lowest = np.repeat(lowest, np.diff(np.append(first, len(ids))))
            keep = lowest < NONE
            done_ids.append(ids[~keep])
            done_words.append(word[~keep])
            here = np.flatnonzero(keep & (rank == lowest))
            # of pairs that overlap (equal symbols in a row) every second one merges
            fresh = np.concatenate(([True], np.diff(here) != 1))[: len(here)]
            run = here[np.maximum.accumulate(np.where(fresh, np.arange(len(here)), 0))]
            here = here[(here - run) % 2 == 0]
            ids[here] = made[here]
            keep[here + 1] = False
            here = (np.cumsum(keep) - 1)[here]
            ids, word, rank, made = ids[keep], word[keep], rank[keep], made[keep]
            # only pairs next to a merged symbol have changed
            near = np.concatenate((here, np.maximum(here - 1, 0)))
            rank[near] = NONE
            near = near[near + 1 < len(ids)]
            near = near[word[near] == word[near + 1]]
            rank[near], made[near] = self._ranks(ids, near)
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        ids = ids[np.argsort(word, kind="stable")]
        return ids, np.bincount(word, minlength=len(words))

    def learn(self, chunks: list[str]) -> None:
        """Add the ids of chunks without blanks or line feeds to the store."""
        pieces = [self.pieces(c) for c in chunks]
        flat = list(chain.from_iterable(pieces))
        words = [p for p in flat if isinstance(p, str)]
        known = list(dict.fromkeys(words))
        index = dict(zip(known, range(len(known))))
        ids, lens = self.merge(known) if known else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        # special tokens are further entries with one id each
        extra = {i: len(known) + k for k, i in enumerate(self.specials.values())}
        ids = np.concatenate((ids, np.array(list(extra), np.int32)))
        lens = np.concatenate((lens, np.ones(len(extra), np.int64)))
        entry = [index[p] if isinstance(p, str) else extra[p] for p in flat]
        ids, ends = gather(ids, lens, np.array(entry, np.int64))
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bounds = ends[np.concatenate(([0], np.cumsum(counts)))]
        start = len(self.store)
        self.store.update(zip(chunks, range(start, start + len(chunks))))
        self.held += sum(map(len, chunks)) + ENTRY * len(chunks)
        self.flat = np.concatenate((self.flat, ids))
        self.lens = np.concatenate((self.lens, np.diff(bounds)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and offsets of the texts in it."""
        # the pattern never crosses a blank or a line feed, and nothing composes
        # across them, so chunks between them can be looked up
        chunks = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        if self.held > STORED:
            self._restart()
        new = list(set(chain.from_iterable(chunks)).difference(self.store))
        if new:
            self.learn(new)
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        index = np.fromiter(
            map(self.store.__getitem__, chain.from_iterable(chunks)), np.int64, int(counts.sum())
        )
        ids, ends = gather(self.flat, self.lens, index)
        return ids, ends[np.concatenate(([0], np.cumsum(counts)))]

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def _codec(tables) -> Codec:
    """One codec per worker process and vocabulary, while this operator runs."""
    value = tables.value
    return in_worker(("bpe", value["path"]), lambda: Codec(value))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    decoded: bool = False,
) -> DataFrame:
    """doc_id and `ids` (array of int) of every text; with `decoded`, also the
    text that decoding these ids gives."""
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(load_tables(path or default_path()))
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, ids array<int>" + (", decoded string" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tables)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                ids, ends = codec.encode(part.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                columns = {"doc_id": part.column("doc_id"), "ids": lists}
                if decoded:
                    columns["decoded"] = pa.array(
                        [codec.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string()
                    )
                yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """The columns of `encoded` and `decoded`, the text of the ids (null: empty)."""
    tables = encoded.sparkSession.sparkContext.broadcast(load_tables(path or default_path()))

    @F.pandas_udf("string")
    def text_of(lists):
        codec = _codec(tables)
        return lists.map(lambda v: "" if v is None else codec.decode(np.asarray(v)))

    return encoded.withColumn("decoded", text_of(F.col(ids)))


def digest_of_ids(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, " "), 256)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    both = encode(docs, path, decoded=True)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest_of_ids(F.col("ids").cast("array<string>")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return digests(read(spark, sf_dir, "documents").select("doc_id", "text"))
