"""Substring dedup on a sparse De Bruijn graph of word k-mers.

A k-mer is a window of ``window`` words. Windows that follow each other and share a minimizer (the
least hash among their ``ANCHOR``-word parts, leftmost on ties) are one edge of the graph. Both
the minimizer and its place depend on a window's words alone, so equal windows lie at the same
place of edges with the same anchor:

1. ``edges``: (doc, start, n windows, anchor, label); the label hashes all words of the edge.
2. An aggregate by anchor finds the repeated edges and their source, the first document and start.
   An anchor with one label has one edge: every later occurrence is a repeat as a whole. An
   anchor with several labels branches: each label has a source of its own, and the windows of
   the sources are compared one by one (only near the ends of repeated spans).
3. Repeated edges that follow each other in the document and in the source are a nonbranching path;
   they are compacted to one span each. A path ends where the document or the source branches off.
4. Spans are verified at their source coordinates: the words of the source span are hashed from
   its text (SHA-256) and compared with those of the span. One that differs is not removed.
5. Each document drops the words of its verified spans, of single late windows, and of windows
   that it repeats itself.

Documents are ordered by doc_id. Every exchange is by anchor, window or document. Counts combine
before they are shuffled, joins on hot anchors and sources are left to the skew-join rule, and only
one document's own spans come together in one row. (The spans that one source is asked for are
distinct pairs of its edges, so at most the square of its edge count.)

Defined results: null or blank texts have no words and give an empty ``kept``; fewer words than a
window stay. Null doc_ids count as one id that comes last. Rows that share a doc_id do not remove
each other's words (none of the ids is smaller); a repeated row gets the same result. Other
columns are left out. An empty table gives no rows. Whole texts are read, nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmarts.llm.common import Workspace, ship_package

WINDOW = 20
#: Words of a minimizer.
ANCHOR = 6
LAST_ID = (1 << 63) - 1
#: Odd multipliers of the two polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Hashes:
    """Polynomial hashes mod 2^64 of stretches of one document's words, by prefix sums."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, words: list[bytes]):
        self.words = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.sums: dict[int, np.ndarray] = {}

    @classmethod
    def powers(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """base ** k and base ** -k for k <= n."""
        have = cls._powers.get(base)
        if have is None or len(have[0]) <= n:
            size = max(1 << 14, 2 * n)
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
            have = cls._powers[base] = tuple(both)
        return have

    def of(self, base: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        up, down = self.powers(base, len(self.words))
        if base not in self.sums:
            self.sums[base] = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.words * down[:len(self.words)], dtype=np.uint64)))
        p = self.sums[base]
        return (p[stop] - p[start]) * up[start]


def mix(h: np.ndarray) -> np.ndarray:
    """Bits spread, so that the order of hashes has nothing to do with the words."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def document_edges(hashes: Hashes, window: int) -> tuple[np.ndarray, ...]:
    """(start, n, anchor, label) of a document's edges, the first of equal ones only."""
    size = len(hashes.words)
    small = min(ANCHOR, window)
    at = np.arange(size - small + 1)
    anchors = mix(hashes.of(BASES[0], at, at + small))
    wide = window - small + 1
    place = np.lib.stride_tricks.sliding_window_view(anchors, wide).argmin(axis=1) + np.arange(size - window + 1)
    start = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
    n = np.diff(np.concatenate((start, [len(place)])))
    label = mix(hashes.of(BASES[1], start, start + n + window - 1) + n.astype(np.uint64))
    anchor = anchors[place[start]]
    _, first = np.unique(anchor + label * np.uint64(BASES[0]), return_index=True)
    first.sort()
    return start[first], n[first], anchor[first].view(np.int64), label[first].view(np.int64)


def own_repeats(hashes: Hashes, window: int) -> list[tuple[int, int]]:
    """(start, n) of runs of windows that the document already has at an earlier start."""
    at = np.arange(len(hashes.words) - window + 1)
    one, two = (hashes.of(b, at, at + window) for b in BASES)
    both = mix(one) + two
    _, first = np.unique(both, return_index=True)
    if len(first) == len(both):
        return []
    late = np.ones(len(both), bool)
    late[first] = False
    return _runs(late)


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


EDGES = "d long, start int, n int, anchor long, label long"


def _edges(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Edges; a run of windows that the document repeats itself is a row without an anchor, whose
    label is the hash of the text."""
    for batch in batches:
        ids, parts, own = batch.column(0).to_pylist(), [], []
        for k in range(batch.num_rows):
            text = batch.column(1)[k].as_py()
            words = text.split() if text else ()  # bytes are split at the white space of the rule
            if len(words) < window:
                continue
            hashes = Hashes(words)
            start, n, anchor, label = document_edges(hashes, window)
            parts.append((np.full(len(start), ids[k], np.int64), start, n, anchor, label))
            own += [(ids[k], a, b, xxhash.xxh64_intdigest(text) - (1 << 63)) for a, b in own_repeats(hashes, window)]
        if parts:
            d, start, n, anchor, label = (np.concatenate(c) for c in zip(*parts))
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor), pa.array(label)],
                                             names=["d", "start", "n", "anchor", "label"])
        if own:
            d, start, n, text = zip(*own)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32()),
                                              pa.nulls(len(own), pa.int64()), pa.array(text, pa.int64())], names=["d", "start", "n", "anchor", "label"])


def repeated_edges(edges: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """(late, branching): occurrences (d, start, n, src, src_start) after an edge's source, and the
    sources (d, start, n) of edges whose anchor has several labels."""
    def source(group: list[str]) -> DataFrame:
        return edges_at.groupBy(*group).agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("d").alias("src"),
                                            F.max("d").alias("last"), F.min_by("start", "d").alias("src_start"))
    edges_at = edges.where(F.col("anchor").isNotNull())
    shared = source(["anchor"]).where(F.col("src") < F.col("last")).drop("last")
    found = ws.store(edges_at.join(shared, "anchor").where((F.col("low") != F.col("high")) | (F.col("d") > F.col("src"))), "found")
    one_label = found.where(F.col("low") == F.col("high"))
    edges_at = found.where(F.col("low") != F.col("high")).select("d", "start", "n", "anchor", "label")
    labels = source(["anchor", "label"]).drop("low", "high", "last")
    branching = ws.store(edges_at.join(labels, ["anchor", "label"]), "branching")
    columns = ["d", "start", "n", "src", "src_start"]
    late = one_label.select(*columns).unionByName(branching.where(F.col("d") > F.col("src")).select(*columns))
    return late, branching.where(F.col("d") == F.col("src")).select("d", "start", "n")


def compact(late: DataFrame) -> DataFrame:
    """Paths (d, start, n, src, src_start): edges joined to the one before, where both the document
    and the source go on."""
    by = Window.partitionBy("d").orderBy("start", "src", "src_start")
    goes_on = ((F.lag(F.col("start") + F.col("n")).over(by) == F.col("start")) & (F.lag("src").over(by) == F.col("src"))
               & (F.lag(F.col("src_start") + F.col("n")).over(by) == F.col("src_start")))
    marked = late.withColumn("head", F.when(goes_on, 0).otherwise(1))
    return (marked.withColumn("path", F.sum("head").over(by.rowsBetween(Window.unboundedPreceding, 0))).groupBy("d", "path")
            .agg(F.min("start").alias("start"), F.sum("n").alias("n"), F.min("src").alias("src"), F.min("src_start").alias("src_start"))
            .drop("path"))


def _digest(words: list[bytes], start: int, n: int, window: int) -> bytes | None:
    """Of the words of ``n`` windows from ``start``; None where the text is shorter."""
    stop = start + n + window - 1
    return hashlib.sha256(b" ".join(words[start:stop])).digest()[:16] if stop <= len(words) else None


SEEN = "d long, start int, n long, digest binary, one long, two long"


def _look(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Digests of the spans that others ask of a document, hashes of its branching windows."""
    schema = pa.schema([("d", pa.int64()), ("start", pa.int32()), ("n", pa.int64()), ("digest", pa.binary()), ("one", pa.int64()), ("two", pa.int64())])
    for batch in batches:
        for k in range(batch.num_rows):
            d, words = batch.column(0)[k].as_py(), (batch.column(1)[k].as_py() or b"").split()
            spans = [(x["start"], x["n"], _digest(words, x["start"], x["n"], window)) for x in batch.column(2)[k].as_py() or ()]
            if spans:
                start, n, digest = zip(*spans)
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(n), pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int64()),
                                                  pa.array(digest, pa.binary()), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64())], schema=schema)
            wanted = batch.column(3)[k].as_py() or ()
            if wanted:
                at = np.unique(np.concatenate([np.arange(x["start"], x["start"] + x["n"]) for x in wanted]))
                at = at[at + window <= len(words)]
                hashes = Hashes(words)
                one, two = (pa.array(np.atleast_1d(hashes.of(b, at, at + window)).view(np.int64)) for b in BASES)
                size = len(at)
                yield pa.RecordBatch.from_arrays([pa.array([d] * size, pa.int64()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int64()),
                                                  pa.nulls(size, pa.binary()), one, two], schema=schema)


def _finish(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for k in range(batch.num_rows):
            text = batch.column(1)[k].as_py() or b""
            words = text.split()
            drop = np.zeros(len(words), bool)
            late: set[tuple[int, int]] = set()
            own = None
            for x in batch.column(2)[k].as_py() or ():
                start, n = x["start"], x["n"]
                if start is None:
                    late.add((x["one"], x["two"]))
                elif x["digest"] is not None:
                    if _digest(words, start, n, window) == x["digest"]:
                        drop[start:start + n + window - 1] = True
                else:
                    own = xxhash.xxh64_intdigest(text) - (1 << 63) if own is None else own
                    if own == x["one"]:
                        drop[start:start + n + window - 1] = True
            if late and len(words) >= window:
                at = np.arange(len(words) - window + 1)
                hashes = Hashes(words)
                one, two = (hashes.of(b, at, at + window).view(np.int64).tolist() for b in BASES)
                for i, pair in enumerate(zip(one, two)):
                    if pair in late:
                        drop[i:i + window] = True
            gone = int(drop.sum())
            n_words.append(len(words))
            n_removed.append(gone)
            kept.append(b" ".join(words if not gone else [words[i] for i in np.flatnonzero(~drop)]).decode(errors="replace"))
        yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept"])


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the text without the words of windows that
    start earlier (in a smaller doc_id, or before in the same document), joined by blanks."""
    spark = docs.sparkSession
    ship_package(spark)
    ws = Workspace(spark, "substrings")
    texts = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("d"), F.col("text").cast("binary").alias("text"))
    edges = ws.store(texts.select("d", "text").mapInArrow(partial(_edges, window=window), EDGES), "edges")
    late, branching = repeated_edges(edges, ws)
    paths = ws.store(compact(late), "paths")
    # what documents have to show: spans that are sources, windows at branches
    asks = (paths.select(F.col("src").alias("d"), F.struct(F.col("src_start").alias("start"), "n").alias("span")).distinct()
            .groupBy("d").agg(F.collect_list("span").alias("spans")))
    looks = branching.distinct().groupBy("d").agg(F.collect_list(F.struct("start", "n")).alias("windows"))
    wanted = asks.join(looks, "d", "full")
    seen = ws.store(texts.join(wanted, "d").select("d", "text", "spans", "windows").mapInArrow(partial(_look, window=window), SEEN), "seen")
    verified = paths.join(seen.where(F.col("digest").isNotNull()).select(
        F.col("d").alias("src"), F.col("start").alias("src_start"), "n", "digest").distinct(), ["src", "src_start", "n"])
    shown = seen.where(F.col("one").isNotNull()).select("d", "one", "two")
    firsts = shown.groupBy("one", "two").agg(F.min("d").alias("src"), F.max("d").alias("last")).where(F.col("src") < F.col("last"))
    again = shown.join(firsts, ["one", "two"]).where(F.col("d") > F.col("src"))
    none = F.lit(None)
    marks = ws.store(
        verified.select("d", "start", "n", "digest", none.cast("long").alias("one"), none.cast("long").alias("two"))
        .unionByName(edges.where(F.col("anchor").isNull()).select(
            "d", "start", F.col("n").cast("long").alias("n"), none.cast("binary").alias("digest"), F.col("label").alias("one"), none.cast("long").alias("two")))
        .unionByName(again.select("d", none.cast("int").alias("start"), none.cast("long").alias("n"), none.cast("binary").alias("digest"), "one", "two"))
        .groupBy("d").agg(F.collect_list(F.struct("start", "n", "digest", "one", "two")).alias("marks")), "marks")
    ws.drop("edges", "found", "branching", "paths", "seen")
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("n_words long, n_removed long, kept string").fields])
    return texts.join(marks, "d", "left").select("d", "text", "marks", "doc_id").mapInArrow(partial(_finish, window=window), schema)
