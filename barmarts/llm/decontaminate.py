"""Operator 3: benchmark decontamination by SimHash over item-sized windows.

Words are runs of letters and digits, lower-cased. A window of a document has as many words
as the item it may hold (``n``); its shingles are its 5-word runs (the whole item where it
has fewer words). The weight of a shingle is 1 / (number of different items with it; items of
equal words count once), so wording that many items share counts less; shingles of no item
weigh 1, so an edit inside shared wording costs more than its share. A window matches an item if
sum(w * min(count)) >= 0.8 * sum(w * max(count)) over both multisets.

Method. Windows whose shingles are mostly shingles of some item (a bound that no match can
miss) get a 64-bit SimHash of their weighted shingles. An index over eight 8-bit blocks per item size
finds every item within ``RADIUS`` = 23 bits: two fingerprints that differ in at most 23
bits differ in at most two bits in one of the blocks. A pair at similarity 0.8 differs in
about 10 bits (standard deviation 3). Candidates are verified on the exact shingle counts.

Items are taken to the workers in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_BYTES`` of text, one pass over the documents per block, so no broadcast grows with
the items. Weights come from the whole benchmark, whatever the block: shingles are counted
once over all items, and those that several items hold go to every block with their counts
(12 bytes each and their words; the only table that grows with the wording items share).
Words have the same ids in every block. Each document is judged in its own task; documents
are not shuffled.

Defined results: null and empty texts match nothing; items without a word are skipped;
very long texts are judged whole, in stretches around matching shingles; repeated rows are
judged one by one; ties go to the least start; of several texts under one item_id the best
match counts; an empty table (either side) gives no match;
other columns pass through, a column named ``matches`` is replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import blake2b
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmarts.llm.common import ship_package

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 16 << 20
STRETCH = 4096

MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start_word", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("similarity", T.DoubleType())]))
ARROW_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()),
                                  ("n_words", pa.int64()), ("similarity", pa.float64())]))

words_of = re.compile(r"[^\W_]+").findall
_ASCII = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else 32 for b in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Bits of a 64-bit value spread over the whole word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MUL
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def lower_words(text: str) -> list[str]:
    """Words of the lower-cased text; the same as ``words_of`` gives, cheaper where it is ASCII."""
    if text.isascii():
        return text.encode().translate(_ASCII).decode().split()
    return words_of(text.lower())


def keys_at(ids: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit key for the ``width`` word ids from each place of ``at`` on."""
    out = np.full(len(at), np.uint64(width))
    for k in range(width):
        out = _mix(out + ids[at + k].astype(np.uint64))
    return out


def shingle_keys(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit key for each run of ``width`` word ids."""
    return keys_at(ids, np.arange(max(len(ids) - width + 1, 0)), width)


def signed_bits(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(_mix(keys).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (bits.astype(np.float32) * 2 - 1) * weights[:, None].astype(np.float32)


class _Known(dict):
    """Ids of known words, the same in every block; 0 for the others."""

    def __missing__(self, word: str) -> int:
        return 0

    def learn(self, words: list[str]) -> np.ndarray:
        for w in words:
            if w not in self:
                self[w] = int.from_bytes(blake2b(w.encode(), digest_size=8).digest(), "little") >> 1 or 1
        return np.array([self[w] for w in words], dtype=np.int64)


class Shared:
    """Shingles that several items of the whole benchmark hold: words, keys and numbers of items."""

    def __init__(self, rows: Iterable[tuple[str, int]]):
        self.words, having = _Known(), {}
        for shingle, n in rows:
            ids = self.words.learn(shingle.split(" "))
            having[int(shingle_keys(ids, len(ids))[0])] = n
        self.keys = np.array(sorted(having), dtype=np.uint64)
        self.n_items = np.array([having[k] for k in self.keys.tolist()], dtype=np.int32)


class ItemBlock:
    """Items of one block: word ids, shingle weights, fingerprints and the block index."""

    def __init__(self, items: list[tuple[int, str]], shared: Shared):
        self.words = _Known(shared.words)
        by_size: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        held: set[int] = set()
        for item, text in items:
            ids = self.words.learn(lower_words(text or ""))
            if len(ids):
                keys = shingle_keys(ids, min(WIDTH, len(ids)))
                held.update(keys.tolist())
                by_size[len(ids)].append((item, keys))
        self.known = np.array(sorted(held), dtype=np.uint64)
        self.shared, self.weight = shared.keys, 1.0 / shared.n_items
        near = np.array([[bin(a ^ b).count("1") <= RADIUS // 8 for b in range(256)] for a in range(256)])
        self.sizes = {}
        for n, group in by_size.items():
            prints = np.stack([(signed_bits(k, self.weights(k)).sum(0) > 0) for _, k in group])
            blocks = np.packbits(prints, axis=1, bitorder="little")  # items x 8 blocks
            index = np.stack([near[:, blocks[:, b]] for b in range(8)])  # block, value, item
            held_by = [(np.unique(k), float(self.weights(k).sum())) for _, k in group]
            self.sizes[n] = ([i for i, _ in group], [Counter(k.tolist()) for _, k in group], held_by, blocks.view(np.uint64)[:, 0], index)

    def weights(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.shared):
            return np.ones(len(keys))
        at = np.minimum(np.searchsorted(self.shared, keys), len(self.shared) - 1)
        return np.where(self.shared[at] == keys, self.weight[at], 1.0)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return self.known[at] == keys

    def similarity(self, window: np.ndarray, item: Counter) -> float:
        mine = Counter(window.tolist())
        keys = np.array(sorted({*mine, *item}), dtype=np.uint64)
        weight = dict(zip(keys.tolist(), self.weights(keys)))
        low = sum(weight[k] * min(mine[k], item[k]) for k in weight)
        high = sum(weight[k] * max(mine[k], item[k]) for k in weight)
        return round(float(low / high), 12)  # equal windows tie whatever the order of summing

    def matches(self, text: str | None) -> list[dict]:
        """Best window of every item that the text holds."""
        if not text or not len(self.known):
            return []
        ids = np.fromiter(map(self.words.get, lower_words(text), repeat(0)), dtype=np.int64)
        best: dict[int, tuple[float, int, int]] = {}
        for width in sorted({min(WIDTH, n) for n in self.sizes}):
            if len(ids) < width:
                break
            seen, places = ids != 0, len(ids) - width + 1
            known = seen[:places].copy()
            for k in range(1, width):
                known &= seen[k:places + k]
            at = np.flatnonzero(known)
            if not len(at):
                continue
            # only runs of known words can be shingles of an item, or weigh less than 1
            keys = keys_at(ids, at, width)
            known[at] = self.holds(keys)
            if not known.any():
                continue
            weight = np.ones(places)
            weight[at] = self.weights(keys)
            shared = np.concatenate([[0.0], np.cumsum(np.where(known, weight, 0.0))])
            foreign = np.concatenate([[0.0], np.cumsum(np.where(known, 0.0, weight))])
            for n in self.sizes:
                span = n - width + 1  # shingles in a window
                if min(WIDTH, n) != width or len(ids) < n:
                    continue
                own, other = shared[span:] - shared[:-span], foreign[span:] - foreign[:-span]
                # no more than own / (own + other) can be reached, whatever the item
                starts = np.flatnonzero((own >= SIMILARITY * (own + other) - 1e-9) & (own > 1e-9))
                for k in range(0, len(starts), STRETCH):
                    self._windows(ids, weight, starts[k:k + STRETCH], n, width, best)
        return [{"item_id": i, "start_word": s, "n_words": n, "similarity": v} for i, (v, s, n) in sorted(best.items())]

    def _windows(self, ids: np.ndarray, weight: np.ndarray, starts: np.ndarray, n: int, width: int, best: dict) -> None:
        items, counts, held_by, prints, index = self.sizes[n]
        span = n - width + 1
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > span) + 1):
            low, high = run[0], run[-1] + span
            keys, mass = shingle_keys(ids[low:high + width - 1], width), weight[low:high]
            # sums over neighbouring windows, from one cumulative sum
            total = np.zeros((high - low + 1, 64))
            np.cumsum(signed_bits(keys, mass), axis=0, out=total[1:])
            window = (total[run - low + span] - total[run - low]) > 1e-9
            blocks = np.packbits(window, axis=1, bitorder="little")
            near = index[0][blocks[:, 0]]
            for b in range(1, 8):
                near = near | index[b][blocks[:, b]]
            w, i = np.nonzero(near)
            far = np.bitwise_count(blocks.view(np.uint64)[w, 0] ^ prints[i])
            close = far <= RADIUS
            w, i, far = w[close], i[close], far[close]
            if not len(w):
                continue
            # of each item near a window: what the window has of its shingles bounds the similarity from above
            at, whole = run - low, np.concatenate([[0.0], np.cumsum(mass)])
            fits = np.zeros(len(w), dtype=bool)
            for one in np.unique(i).tolist():
                (held, weighs), mine = held_by[one], np.flatnonzero(i == one)
                place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
                own = np.concatenate([[0.0], np.cumsum(np.where(held[place] == keys, mass, 0.0))])
                from_ = at[w[mine]]
                both = own[from_ + span] - own[from_]
                either = whole[from_ + span] - whole[from_] + weighs - both
                fits[mine] = both >= SIMILARITY * either - 1e-6
            w, i, far = w[fits], i[fits], far[fits]
            order = np.lexsort((w, far))
            for s, i in zip(run[w[order]].tolist(), i[order].tolist()):
                if items[i] in best and best[items[i]][0] >= 1 and best[items[i]][1] < s:
                    continue
                value = self.similarity(keys[s - low:s - low + span], counts[i])
                if value >= SIMILARITY - 1e-12 and (items[i] not in best or _order((value, s, n)) < _order(best[items[i]])):
                    best[items[i]] = (value, s, n)


def _order(found: tuple[float, int, int]) -> tuple[float, int, int]:
    return -found[0], found[1], found[2]


def merged(found: list[dict], more: list[dict]) -> list[dict]:
    """The matches of two blocks: the best of each item."""
    best: dict[int, dict] = {}
    for m in [*found, *more]:
        rank = _order((m["similarity"], m["start_word"], m["n_words"]))
        old = best.get(m["item_id"])
        if old is None or rank < _order((old["similarity"], old["start_word"], old["n_words"])):
            best[m["item_id"]] = m
    return [best[i] for i in sorted(best)]


def shared_shingles(benchmark: DataFrame) -> DataFrame:
    """(shingle, n): the shingles that ``n`` > 1 different items of the whole benchmark hold, words joined
    by blanks. Items of equal words count once: a repeated item must not get harder to match."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([" ".join(words_of((t.as_py() or "").lower())) for t in batch.column(0)], pa.string())], names=["words"])

    items = benchmark.where("item_id IS NOT NULL").select("text").mapInArrow(joined, "words string").where("words <> ''").distinct()
    words = F.col("w")
    width = F.least(F.lit(WIDTH), F.size(words))
    each = F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.array_join(F.slice(words, i, width), " "))
    return (items.select(F.split("words", " ").alias("w")).select(F.explode(F.array_distinct(each)).alias("shingle"))
            .groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Blocks of items, at most BLOCK_ITEMS items and BLOCK_BYTES of text each (one item at least)."""
    block, held = [], 0
    for row in benchmark.where("item_id IS NOT NULL").select("item_id", "text").toLocalIterator():
        size = len(row.text or "") * 4
        if block and (len(block) >= BLOCK_ITEMS or held + size > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += size
    if block:
        yield block


def with_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``matches``: item_id, start_word, n_words and similarity of the best window
    of each item that the text holds."""
    out = docs.drop("matches").withColumn("matches", F.array().cast(MATCH))
    spark = docs.sparkSession
    ship_package(spark)
    counted = spark.sparkContext.broadcast(Shared((r.shingle, r.n) for r in shared_shingles(benchmark).toLocalIterator()))
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)
        text, found = out.columns.index("text"), out.columns.index("matches")
        schema = T.StructType([*out.drop("matches").schema.fields, T.StructField("matches", MATCH)])

        def run(batches: Iterator[pa.RecordBatch], shared=shared, counted=counted, text=text, found=found) -> Iterator[pa.RecordBatch]:
            items = ItemBlock(shared.value, counted.value)
            for batch in batches:
                rows = [merged(m.as_py() or [], items.matches(t.as_py())) for t, m in zip(batch.column(text), batch.column(found))]
                columns = [c for k, c in enumerate(batch.columns) if k != found]
                names = [c for k, c in enumerate(batch.schema.names) if k != found]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, ARROW_MATCH)], names=[*names, "matches"])

        out = out.mapInArrow(run, schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    return with_matches(docs, benchmark).where(F.size("matches") == 0).drop("matches")
