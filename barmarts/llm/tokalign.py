"""Cross-tokenizer alignment by diagonal run skipping.

A text is read by tokenizer A (byte-level BPE) and tokenizer B (BPE over pieces with byte
fallback). Both sets of tokens are intervals over the bytes of blank + text. Offsets where an A
and a B token both end cut them into groups. ``common_ends`` walks the two end arrays: while
ends agree at the current index shift it probes 1, 2, 4, ... entries at once and jumps over the
whole one-to-one stretch; where they differ it steps the side that is behind until both end
together, and the shift becomes the new one.

Both tokenizers never join a blank to the character before it (the pattern of A starts a match
at white space; no piece of B has a blank after another character, which is checked), so texts
are cut before the blanks that follow other characters, and each distinct stretch is encoded and
aligned once per worker: the new stretches of a batch are joined, encoded and aligned as one long
text, then cut again. Stretches that end in white space, or whose bytes do not come back, are
treated alone. The store is emptied when it is full, which changes time only.

Link counts are corpus-wide. A pair's count is an aggregate over all documents; pairs that make
up 1 / 65536 of all links or more (so at most 65,536 pairs) are broadcast to the documents, the
others, of which none is frequent, are joined by a shuffle.

Defined results: a null or empty text, and a text that one tokenizer does not give back byte by
byte (for instance one with U+2581), has no tokens: zeros and an empty hash. Rows are kept as
they are, repeated ids and null ids too; every row counts. Other columns are left out. An empty
table gives no rows. Tokens have at least one byte, so tokens that end together are one pair.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import Workspace, ship_package

#: Bounds of a worker's store of aligned stretches, and of the text taken at once.
STORE_ENTRIES, STORE_CHARS, BLOCK_CHARS, JOIN_CHARS = 400_000, 1 << 25, 1 << 20, 1 << 19
#: Pairs with at least this share of all links are broadcast.
FREQUENT = 1 << 16


class Files(NamedTuple):
    """Contents of the two vocabularies (fixed size, so they are broadcast)."""
    byte_json: bytes
    piece_model: bytes
    pattern: str


def read_files(byte_json: str, piece_model: str, pattern: str) -> Files:
    with open(byte_json, "rb") as a, open(piece_model, "rb") as b:
        return Files(a.read(), b.read(), pattern)


def common_ends(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """(i, shift, n): a[i + k] == b[i + shift + k] for k < n, over all common values, in order.

    ``a`` and ``b`` ascend and end in the same value.
    """
    runs, i, j, size = [], 0, 0, len(a)
    while i < size:
        x, y = a[i], b[j]
        if x == y:
            first, shift, width = i, j - i, 1
            i += 1
            while i < size and a[i:i + width] == b[i + shift:i + shift + width]:
                i += width
                width += width
            i = min(i, size)  # the last probe may have reached beyond both ends
            while width > 1:
                width >>= 1
                if i + width <= size and a[i:i + width] == b[i + shift:i + shift + width]:
                    i += width
            runs.append((first, shift, i - first))
            j = i + shift
        else:
            while x != y:  # an irregular group
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            runs.append((i, j - i, 1))
            i += 1
            j += 1
    return runs


def byte_level_bytes() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte (printable Latin-1 stands for itself, the
    other bytes, in order, for the characters from U+0100 on)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in set(plain)]
    return {**{chr(x): x for x in plain}, **{chr(256 + k): x for k, x in enumerate(rest)}}


class Entry(NamedTuple):
    """An aligned stretch: its groups as text, its links (a << 32 | b, as bytes), token counts."""
    groups: bytes
    links: bytes
    n_a: int
    n_b: int


class Aligner:
    def __init__(self, files: Files):
        import sentencepiece
        import tiktoken

        model, chars = json.loads(files.byte_json)["model"], byte_level_bytes()
        special = {t["content"] for t in json.loads(files.byte_json).get("added_tokens", [])}
        ranks = {bytes(chars[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        order = [model["vocab"][x + y] for x, y in merges]
        if order != sorted(order):  # then ranks do not stand for the merges
            raise ValueError("the byte-level vocabulary does not number its tokens by merge")
        self.encode_a = tiktoken.Encoding("a", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=files.piece_model)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError("a piece joins a blank to the character before it")
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_a[i] = t
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.size_a, self.size_b = (np.array([len(t) for t in tokens], np.int64) for tokens in (self.bytes_a, self.bytes_b))
        self.store: dict[str, Entry | None] = {}
        self.chars = 0

    def encode(self, stretch: str) -> tuple[list[int], list[int]] | None:
        """A and B ids of a stretch (which begins with a blank); None if its bytes don't come back."""
        a, want = self.encode_a(stretch), stretch.encode()
        # B adds its blank to every text but the empty one
        b = self.pieces.encode(stretch[1:], num_threads=1) if stretch != " " else [self.pieces.piece_to_id("▁")]
        same = b"".join([self.bytes_a[i] for i in a]) == want == b"".join([self.bytes_b[i] for i in b])
        return (a, b) if same else None

    def align(self, a: list[int], b: list[int], cuts: np.ndarray) -> list[Entry]:
        """Entries of the stretches that end at the byte offsets ``cuts``."""
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        runs = np.array(common_ends(ends_a.tolist(), ends_b.tolist()), np.int64)
        first, shift, n = runs.T
        last_a = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)  # last A token of each group
        last_b = last_a + np.repeat(shift, n)
        links = (ids_a[last_a] << 32) | ids_b[last_b]
        groups, lengths = self._written(ids_a, ids_b, last_a, last_b)
        # a stretch ends at a common end
        stop = np.searchsorted(ends_a[last_a], cuts, side="right")
        stop_a, stop_b, stop_text = last_a[stop - 1] + 1, last_b[stop - 1] + 1, lengths[stop - 1]
        out, raw, g0, a0, b0, t0 = [], links.tobytes(), 0, 0, 0, 0
        for g, x, y, t in zip(stop.tolist(), stop_a.tolist(), stop_b.tolist(), stop_text.tolist()):
            out.append(Entry(groups[t0:t - 1], raw[8 * g0:8 * g], x - a0, y - b0))
            g0, a0, b0, t0 = g, x, y, t
        return out

    @staticmethod
    def _written(ids_a, ids_b, last_a, last_b) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2;`` of all groups, and the length of the text after each group."""
        group_a = np.searchsorted(last_a, np.arange(len(ids_a)))
        group_b = np.searchsorted(last_b, np.arange(len(ids_b)))
        start_b = np.concatenate(([0], last_b[:-1] + 1))
        at_a = np.arange(len(ids_a)) + start_b[group_a]  # B tokens of the groups before
        at_b = np.arange(len(ids_b)) + last_a[group_b] + 1  # A tokens up to this group
        total = len(ids_a) + len(ids_b)
        ids, mark = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[at_a], ids[at_b] = ids_a, ids_b
        mark[at_a[last_a]], mark[at_b[last_b]] = ord("|"), ord(";")
        digits = 1 + sum((ids >= 10 ** k).astype(np.int64) for k in range(1, 10))
        ends = np.cumsum(digits + 1)
        text = np.empty(int(ends[-1]), np.uint8)
        text[ends - 1] = mark
        for k in range(int(digits.max())):  # k-th digit from the right
            has = digits > k
            text[ends[has] - 2 - k] = ord("0") + ids[has] // 10 ** k % 10
        return text.tobytes(), ends[at_b[last_b]]

    def learn(self, stretches: set[str]) -> None:
        """Put new stretches into the store."""
        alone, joined, size = [], [], 0
        for s in [*stretches, None]:
            if s is not None and (s[-1].isspace() or "▁" in s):
                alone.append(s)
                continue
            if s is None or size + len(s) > JOIN_CHARS:
                if joined:
                    both = self.encode("".join(joined))
                    if both is None:
                        alone += joined
                    else:
                        cuts = np.cumsum([len(x.encode()) for x in joined])
                        self.store.update(zip(joined, self.align(*both, cuts)))
                joined, size = [], 0
            if s is not None:
                joined.append(s)
                size += len(s)
        for s in alone:
            both = self.encode(s)
            self.store[s] = both and self.align(*both, np.array([len(s.encode())]))[0]
        self.chars += sum(map(len, stretches))

    def entries(self, text: str) -> list[Entry | None]:
        """The entries of a stretch of text that begins with a blank."""
        parts = stretches(text)
        if len(self.store) > STORE_ENTRIES or self.chars > STORE_CHARS:
            self.store, self.chars = {}, 0
        new = set(parts).difference(self.store)
        if new:
            self.learn(new)
        return [self.store[p] for p in parts]


def stretches(text: str) -> list[str]:
    """``text`` (which begins with a blank) cut before the blanks that follow other characters."""
    if "\0" in text or re.search(r"\s ", text):
        return re.split(r"(?<=\S)(?= )", text)
    return text.replace(" ", "\0 ").split("\0")[1:]


def blocks(text: str) -> Iterator[str]:
    """Blank + text in blocks of bounded size, cut like stretches."""
    text, at = " " + text, 0
    cut = re.compile(r"(?<=\S) ")
    while at < len(text):
        found = cut.search(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
        stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


_NOW: list = [None, None]
ALIGNED = "row long, doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>, counts array<long>"


def _run(batches: Iterator[pa.RecordBatch], shared, keep: bool) -> Iterator[pa.RecordBatch]:
    files = shared.value
    if _NOW[0] is not files:  # a worker reads a broadcast once
        _NOW[:] = [files, Aligner(Files(*files))]
    aligner = _NOW[1]
    for batch in batches:
        texts = batch.column(2)
        out, kept = [], []
        for k in range(batch.num_rows):  # texts come over one by one
            text = texts[k].as_py() or ""
            sha, links, n_a, n_b, n_groups, sound, whole = hashlib.sha256(), [], 0, 0, 0, bool(text), []
            for block in blocks(text) if text else ():
                entries = aligner.entries(block)
                if None in entries:
                    sound = False
                    break
                groups = b";".join([e.groups for e in entries])
                sha.update(b";" + groups if n_groups else groups)
                found = np.frombuffer(b"".join([e.links for e in entries]), np.int64)
                links.append(np.unique(found, return_counts=True))
                n_a, n_b, n_groups = n_a + sum(e.n_a for e in entries), n_b + sum(e.n_b for e in entries), n_groups + len(found)
                if keep:
                    whole.append(groups)
            if not sound:
                n_a, n_b, n_groups, links, whole = 0, 0, 0, [], []
            out.append((n_a, n_b, n_groups, sha.hexdigest() if n_groups else "", *_merged(links)))
            kept.append(b";".join(whole).decode())
        columns = list(zip(*out)) or [()] * 6
        arrays = [pa.array(c, t) for c, t in zip(columns[:4], (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        for column in columns[4:]:
            offsets = np.cumsum([0, *map(len, column)]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *column]))))
        names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "counts"]
        if keep:
            arrays.append(pa.array(kept, pa.string()))
            names.append("groups")
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=names)


def _merged(links: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(links) <= 1:
        return links[0] if links else (np.empty(0, np.int64), np.empty(0, np.int64))
    keys, place = np.unique(np.concatenate([k for k, _ in links]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, place, np.concatenate([n for _, n in links]))
    return keys, counts


def align(docs: DataFrame, files: Files, keep_groups: bool = False) -> DataFrame:
    """One row per document: ``row`` (a number of its own), doc_id, token and group counts, the
    hash of the groups, and its distinct links (a << 32 | b) with their counts; with
    ``keep_groups`` also ``groups`` as text."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(tuple(files))
    schema = ALIGNED.format(id=docs.schema["doc_id"].dataType.simpleString()) + (", groups string" if keep_groups else "")
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(partial(_run, shared=shared, keep=keep_groups), schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, count, best): corpus-wide counts of the id pairs; ``best``: no other A id is linked
    with the pair's B id more often."""
    pairs = aligned.select(F.explode(F.arrays_zip("links", "counts")).alias("x")).select(
        F.col("x.links").alias("link"), F.col("x.counts").alias("n")).groupBy("link").agg(F.sum("n").alias("count"))
    pairs = pairs.withColumn("b", F.col("link").bitwiseAND((1 << 32) - 1))
    top = pairs.groupBy("b").agg(F.max("count").alias("top"))
    return pairs.join(top, "b").select("link", "count", (F.col("count") == F.col("top")).alias("best"))


def score_links(docs: DataFrame, files: Files) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row."""
    ws = Workspace(docs.sparkSession, "tokalign")
    aligned = ws.store(align(docs, files), "aligned")
    pairs = ws.store(link_counts(aligned), "pairs")
    total = pairs.agg(F.sum("count")).first()[0] or 0
    frequent = pairs.where(F.col("count") * FREQUENT >= F.lit(total))  # at most FREQUENT rows
    each = aligned.select("row", F.explode(F.arrays_zip("links", "counts")).alias("x")).select(
        "row", F.col("x.links").alias("link"), F.col("x.counts").alias("n"))
    sums = [F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    often = each.join(F.broadcast(frequent), "link").groupBy("row").agg(*sums)
    seldom = (each.join(F.broadcast(frequent.select("link")), "link", "left_anti")
              .join(pairs.where(F.col("count") * FREQUENT < F.lit(total)), "link").groupBy("row").agg(*sums))
    both = often.unionByName(seldom).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("links", "counts").join(both, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
