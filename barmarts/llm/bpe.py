"""Operator 5: byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that can end its encoding.
``PrefixEncoder`` stores that token for each prefix: token t may end prefix p if the token
that ends p without t, followed by t, is itself what BPE makes of those two tokens' bytes.
So bytes are appended exactly by extending the table, without looking at earlier bytes
again, and after an edit the table is kept up to the edit and recomputed only until it
agrees with the old one again. Pair checks are memoised. The new pieces of a block of texts
fill their tables side by side, one prefix length at a time (``PieceTable``).

A text is split by the vocabulary's pattern first and each match is encoded separately;
a match that is itself a token is that token. No special tokens. Texts are encoded in
Arrow batches with the ranks as a broadcast variable (the file's size is checked); each
task keeps a bounded cache of encoded pieces.

Defined results: null and empty texts give no ids and decode to no bytes; very long texts
are encoded whole; lone surrogates cannot occur in Spark strings; repeated rows are encoded
one by one; an empty table gives an empty result; other columns pass through, columns named
``ids`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmarts.llm.common import ship_package

CACHE_ENTRIES = 400_000
SHARED_PREFIX_BYTES = 48
BLOCK_BYTES = 2 << 20
PIECES_AT_ONCE = 1 << 15
PAIR_SLOTS = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: base of the hash of byte strings
_SPACE = r"[\x{9}-\x{D} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"  # \p{White_Space}
UNEVEN = f"{_SPACE}{{2}}|{_SPACE}$"
MAX_RANK_FILE_BYTES = 64 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank a line."""
    if os.path.getsize(path) > MAX_RANK_FILE_BYTES:
        raise ValueError(f"rank file over {MAX_RANK_FILE_BYTES} bytes: {path}")
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_bytes(piece: bytes, ranks: dict[bytes, int], but: bytes | None = None) -> list[bytes]:
    """Plain BPE of a short byte string: merge the adjacent pair of least rank until none is
    left; the token ``but`` is not made."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, 1 << 60) if a + b != but else 1 << 60, i)
                      for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def slices(sizes: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of runs of rows, each of about ``BLOCK_BYTES`` (a larger row alone)."""
    block = np.cumsum(pc.fill_null(sizes, 0).to_numpy(), dtype=np.int64) // BLOCK_BYTES
    starts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist()] if len(block) else []
    yield from ((a, b - a) for a, b in zip(starts, [*starts[1:], len(block)]))


class PrefixEncoder:
    """Exact BPE of byte strings with one stored token (by id) per prefix."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self._length = {i: len(t) for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._last_merge: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}
        self._prefixes: dict[bytes, int] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two parts of the merge that made a token; None for a byte and for a token
        that the merges do not reach from its bytes (some vocabularies hold such)."""
        if token not in self._last_merge:
            made, data = None, self.bytes_of[token]
            if len(data) > 1:
                parts = merge_bytes(data, self.ranks, but=data)
                if len(parts) == 2 and merge_bytes(data, self.ranks) == [data]:
                    made = self.ranks[parts[0]], self.ranks[parts[1]]
            self._last_merge[token] = made
        return self._last_merge[token]

    def _may_follow(self, left: int, right: int) -> bool:
        """The token ``right`` may come after ``left`` (-1: at the start).

        Undo the merges nearest to the border from the last to the first, and see that the
        parts at the border would not have merged earlier.
        """
        key = (left + 1 << 32) | right
        if len(self._pairs) > CACHE_ENTRIES:
            self._pairs.clear()
        single = len(self.bytes_of[right]) == 1
        if left < 0 or not (single or self._halves(right)):
            self._pairs[key] = known = single or self._halves(right) is not None
            return known
        ranks, text, before = self.ranks, self.bytes_of, 1 << 60
        while True:
            merged = ranks.get(text[left] + text[right])
            if merged is not None and merged < before:
                known = False
                break
            a = left if len(text[left]) > 1 else -1
            b = right if len(text[right]) > 1 else -1
            if a < 0 and b < 0:
                known = True
                break
            if a > b:
                before, left = a, self._halves(left)[1]
            else:  # of equal ranks the left one merged first
                before, right = b + 1, self._halves(right)[0]
        self._pairs[key] = known
        return known

    def _token_at(self, data: bytes, stop: int, ending: Callable[[int], int]) -> int:
        """The token that ends data[:stop]; ``ending(i)`` gives the one that ends data[:i].

        Only one candidate fits, so the likely ones go first: the token before with one byte
        more, the byte alone, then starts inside that token, then longer ones.
        """
        get, pairs = self.ranks.get, self._pairs
        before = ending(stop - 1) if stop > 1 else -1
        near = stop - 1 - len(self.bytes_of[before]) if stop > 1 else 0
        low = stop - self.longest if stop > self.longest else 0
        for start in chain((near, stop - 1), range(near + 1, stop - 1), range(near - 1, low - 1, -1)):
            token = get(data[start:stop])
            if token is not None:
                left = ending(start) if start else -1
                fits = pairs.get((left + 1 << 32) | token)
                if self._may_follow(left, token) if fits is None else fits:
                    return token
        raise ValueError(f"no token for byte {data[stop - 1]}")

    def extend(self, data: bytes, last: list[int], end: int | None = None) -> list[int]:
        """Append to ``last`` (last[i]: token that ends data[:i + 1]) up to ``end`` bytes."""
        for stop in range(len(last) + 1, (len(data) if end is None else end) + 1):
            last.append(self._token_at(data, stop, lambda i: last[i - 1]))
        return last

    def edit(self, data: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """Replace data[start:stop] by ``new``; recompute prefixes only until the table agrees again.

        The token of a prefix depends on the tokens of the ``longest`` prefixes before it and
        on the bytes, so once that many entries past the edit equal the old ones, the rest does.
        """
        out = data[:start] + new + data[stop:]
        table, shift, agree = last[:start], len(new) - (stop - start), 0
        while len(table) < len(out):
            self.extend(out, table, len(table) + 1)
            at = len(table)  # prefix length in the new text; at - shift in the old
            agree = agree + 1 if at > start + len(new) and last[at - shift - 1] == table[-1] else 0
            if agree >= self.longest:
                table += last[at - shift:]
                break
        return out, table

    def tokens(self, last: list[int]) -> list[int]:
        """Ids of the whole string, read back from its end."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[out[-1]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match. Prefixes of short pieces are shared between pieces."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > SHARED_PREFIX_BYTES:
            return self.tokens(self.extend(piece, []))
        known, length = self._prefixes, self._length
        if len(known) > CACHE_ENTRIES:
            known.clear()
        # known prefixes are closed under prefixes: find the longest by bisection
        low, high = 0, len(piece)
        while low < high:
            mid = (low + high + 1) >> 1
            if piece[:mid] in known:
                low = mid
            else:
                high = mid - 1
        # _token_at, written out for the hot path
        get, pairs = self.ranks.get, self._pairs
        before = known[piece[:low]] if low else -1
        for stop in range(low + 1, len(piece) + 1):
            near = stop - 1 - length[before] if stop > 1 else 0
            token = get(piece[near:stop])
            if token is not None:
                left = known[piece[:near]] if near else -1
                fits = pairs.get((left + 1 << 32) | token)
                if not (self._may_follow(left, token) if fits is None else fits):
                    token = None
            if token is None:
                token = self._token_at(piece, stop, lambda i: known[piece[:i]])
            known[piece[:stop]] = before = token
        out, at = [], len(piece)
        while at:
            token = known[piece[:at]]
            out.append(token)
            at -= length[token]
        out.reverse()
        return out


class PieceTable:
    """The prefix tables of many short pieces at once: a numpy column per prefix length.

    A candidate token is looked up by the hash of its bytes. Adjacent tokens that may follow
    each other and spell the piece are its encoding, so the spelling is checked at the end and a
    piece that a hash collision misled is encoded alone.
    """

    def __init__(self, encoder: PrefixEncoder):
        self.encoder = encoder
        short = [(t, i) for t, i in encoder.ranks.items() if 0 < len(t) <= SHARED_PREFIX_BYTES]
        self.power = np.cumprod(np.append(np.uint64(1), np.full(SHARED_PREFIX_BYTES, BASE)), dtype=np.uint64)
        lengths = np.array([len(t) for t, _ in short], np.int64)
        code = self._prefix_hashes([t for t, _ in short])[lengths, np.arange(len(short))]
        order = np.argsort(code)
        self.code, self.id = code[order], np.array([i for _, i in short], np.int64)[order]
        self.length = np.zeros(max(encoder.bytes_of, default=0) + 1, np.int64)
        self.length[[i for _, i in short]] = lengths
        self.longest = int(lengths.max(initial=0))
        self.pair_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.pair_fits = np.zeros(PAIR_SLOTS, bool)

    def _prefix_hashes(self, pieces: list[bytes]) -> np.ndarray:
        """Row i: the hashes of the first i bytes of every piece (of zeros past its end)."""
        longest = max(map(len, pieces), default=1)
        data = np.array(pieces, f"S{longest}").view(np.uint8).reshape(len(pieces), longest)
        out = np.zeros((longest + 1, len(pieces)), np.uint64)
        for k in range(longest):
            out[k + 1] = out[k] * BASE + data[:, k] + np.uint64(1)
        return out

    def _token(self, hashes: np.ndarray, start: np.ndarray, stop: int, row: np.ndarray) -> np.ndarray:
        """The token that spells [start:stop] of each row's piece, or -1."""
        code = hashes[stop, row] - hashes[start, row] * self.power[stop - start]
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where((self.code[at] == code) & (self.length[self.id[at]] == stop - start), self.id[at], -1)

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left + 1 << 32) | right
        slot = ((key * 0x2545F4914F6CDD1D) >> 33) & (PAIR_SLOTS - 1)
        fits, known = self.pair_fits[slot], self.pair_key[slot] == key
        if not known.all():
            new, back = np.unique(key[~known], return_inverse=True)
            get, follow = self.encoder._pairs.get, self.encoder._may_follow
            answer = np.empty(len(new), bool)
            for k, pair in enumerate(new.tolist()):
                kept = get(pair)
                answer[k] = follow((pair >> 32) - 1, pair & 0xFFFFFFFF) if kept is None else kept
            fits[~known] = answer[back]
            self.pair_key[slot[~known]], self.pair_fits[slot[~known]] = key[~known], answer[back]
        return fits

    def encode(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pieces of 1 to ``SHARED_PREFIX_BYTES`` bytes."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-size, kind="stable")
        inner, size = [pieces[k] for k in order.tolist()], size[order]
        hashes = self._prefix_hashes(inner)
        last = np.full((len(hashes), len(inner)), -1, np.int64)  # last[i]: token that ends the first i bytes
        for stop in range(1, len(hashes)):
            row = np.arange(np.searchsorted(-size, -stop, side="right"))  # pieces of at least stop bytes
            before = last[stop - 1, row]
            # the token before with one byte more, as a rule the one that fits
            start = stop - 1 - np.where(before < 0, 0, self.length[before])
            for width in range(0, min(stop, self.longest) + 1):
                if width:
                    start = np.full(len(row), stop - width)
                token = self._token(hashes, start, stop, row)
                found = np.flatnonzero(token >= 0)
                found = found[self._fits(last[start[found], row[found]], token[found])]
                last[stop, row[found]] = token[found]
                row = np.delete(row, found)
                if not len(row):
                    break
        steps, at, rows = [], size.copy(), np.arange(len(inner))
        while at.any():
            token = np.where(at > 0, last[at, rows], -1)
            steps.append(token)
            at = np.where(token < 0, 0, at - self.length[token])
        found = np.stack(steps[::-1], axis=1) if steps else np.empty((0, 0), np.int64)
        stops = np.cumsum((found >= 0).sum(axis=1)).tolist()
        flat, text = found[found >= 0].tolist(), self.encoder.bytes_of.__getitem__
        ids = [tuple(flat[a:b]) for a, b in zip([0, *stops], stops)]
        if b"".join(map(text, flat)) != b"".join(inner):
            ids = [x if b"".join(map(text, x)) == p else tuple(self.encoder.encode(p)) for x, p in zip(ids, inner)]
        out: list[tuple[int, ...]] = [()] * len(pieces)
        for k, x in zip(order.tolist(), ids):
            out[k] = x
        return out


class TextEncoder:
    """Pattern split and a bounded cache of encoded pieces over a ``PrefixEncoder``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # white space as Unicode defines it, the same for every regex library
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.plain = r"| ?\p{L}+|" in pattern
        self.encoder = PrefixEncoder(ranks)
        self.table = PieceTable(self.encoder)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _keep(self, text: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        """Two generations: a full cache becomes the older one, what is used again comes back."""
        if len(self.cache) >= CACHE_ENTRIES // 2:
            self.older, self.cache = self.cache, {}
        if len(text) <= 64:
            self.cache[text] = ids
        return ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.cache.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            ids = self._keep(piece, tuple(self.encoder.encode(piece.encode())) if ids is None else ids)
        return ids

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """A chunk that the cache does not hold."""
        ids = self.older.get(chunk)
        if ids is not None:
            return self._keep(chunk, ids)
        pieces = self.split(chunk)
        if len(pieces) == 1:
            return self._piece(chunk)
        return self._keep(chunk, tuple(chain.from_iterable(map(self._piece, pieces))))

    def _known(self, chunks: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of every chunk; those that the caches do not hold are encoded side by side."""
        known, cut, pieces = {}, {}, {}
        get, older, ranks = self.cache.get, self.older.get, self.encoder.ranks.get
        for c in chunks:
            ids = get(c)
            if ids is None:
                ids = older(c)
                if ids is not None:
                    self._keep(c, ids)
                elif self.plain and (c[1:] if c[:1] == " " else c).isalpha():
                    pieces[c] = None  # letters after at most one blank are one match
                    continue
                else:
                    cut[c] = parts = self.split(c)
                    for piece in parts:
                        if piece not in pieces:
                            pieces[piece] = get(piece) or older(piece)
                    continue
            known[c] = ids
        short = []
        for piece, ids in pieces.items():
            if ids is None:
                data = piece.encode()
                whole = ranks(data)
                if whole is not None:
                    pieces[piece] = (whole,)
                elif len(data) <= SHARED_PREFIX_BYTES:
                    short.append((piece, data))
                else:
                    pieces[piece] = tuple(self.encoder.encode(data))
        for k in range(0, len(short), PIECES_AT_ONCE):
            some = short[k:k + PIECES_AT_ONCE]
            pieces.update(zip([p for p, _ in some], self.table.encode([d for _, d in some])))
        for piece, ids in pieces.items():
            self._keep(piece, ids)
        for c, parts in cut.items():
            known[c] = pieces[c] if len(parts) == 1 else self._keep(c, tuple(chain.from_iterable(pieces[p] for p in parts)))
        return known | pieces

    def encode(self, text: str) -> list[int]:
        get, chunk = self.cache.get, self._chunk
        out: list[int] = []
        for c in self.split(text):
            ids = get(c)
            out += chunk(c) if ids is None else ids
        return out

    def encode_column(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text of a column (null: none). Chunks are cut and told apart by Arrow, the new
        ones encoded together, and their ids gathered; blocks hold about ``BLOCK_BYTES`` bytes."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return pa.array([], pa.list_(pa.int32()))
        parts = [self._block(texts.slice(at, n)) for at, n in slices(pc.binary_length(texts))]
        offsets = np.zeros(len(texts) + 1, np.int32)
        np.cumsum(np.concatenate([n for _, n in parts]), out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([x for x, _ in parts])))

    def _block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the texts, and how many each has. A match never reaches from other
        characters into a following blank, so a text whose white space is single may be cut before
        every blank; others are cut by the pattern as a whole."""
        whole = pc.or_(pc.match_substring_regex(texts, UNEVEN), pc.match_substring(texts, "\0"))
        even = pc.split_pattern(pc.replace_substring(pc.if_else(whole, "", texts), " ", "\0 "), "\0")
        codes = even.values.slice(even.offsets[0].as_py(), len(even.values)).dictionary_encode()
        known = self._known(names := codes.dictionary.to_pylist())
        ids = [known[c] for c in names]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        first, code = np.cumsum(size) - size, codes.indices.to_numpy()
        count = size[code]
        upto = np.concatenate([[0], np.cumsum(count)])
        out = flat[np.repeat(first[code] - upto[:-1], count) + np.arange(upto[-1])]
        row = np.diff(upto[even.offsets.to_numpy() - even.offsets[0].as_py()])
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if len(odd):
            rows = np.split(out, np.cumsum(row)[:-1])
            for k in odd.tolist():
                rows[k] = np.array(self.encode(texts[k].as_py()), np.int32)
            out, row = np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
        return out, row


_STATE: dict[int, TextEncoder] = {}


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` array<int>."""
    docs = docs.drop("ids") if text != "ids" else docs
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _STATE.get(id(shared.value))
        if own is None:
            _STATE.clear()
            own = _STATE[id(shared.value)] = TextEncoder(shared.value, pattern)
        for batch in (b.slice(at, n) for b in batches for at, n in slices(pc.binary_length(b.column(place)))):
            ids = own.encode_column(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` binary: the bytes of the tokens, one after the other."""
    encoded = encoded.drop("decoded")
    ship_package(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    place = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: t for t, i in shared.value.items()}.__getitem__
        for batch in (b.slice(at, n) for b in batches for at, n in slices(pc.list_value_length(b.column(place)))):
            out = [b"".join(map(token, row.values.to_numpy().tolist())) if row.is_valid else b"" for row in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of ``ids`` and ``decoded``."""
    return decoded.withColumns({
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    })
