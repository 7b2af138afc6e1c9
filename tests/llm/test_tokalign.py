"""Operator 12: alignment of two tokenizers against the libraries and plain set operations."""
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from barmarts.llm import tokalign
from llm_edge import SF_SMALL, edge, nothing  # noqa: F401

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def files():
    return tokalign.read_files(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def brute_groups(libraries, text):
    """[(A ids, B ids)] from the libraries over the whole text, cut at the common ends."""
    a, b = libraries
    chars = tokalign.byte_level_bytes()
    names = {i: t for t, i in a.get_vocab().items()}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text, num_threads=1)
    bytes_a = [bytes(chars[c] for c in names[i]) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    if not text or not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
        return []

    def by_end(ids, tokens):
        at, out = 0, []
        for i, t in zip(ids, tokens):
            at += len(t)
            out.append((at, i))
        return out
    left, right = by_end(ids_a, bytes_a), by_end(ids_b, bytes_b)
    stops, groups, before = sorted({e for e, _ in left} & {e for e, _ in right}), [], 0
    side = [defaultdict(list), defaultdict(list)]
    import bisect
    for which, tokens in enumerate((left, right)):
        for end, i in tokens:
            side[which][stops[bisect.bisect_left(stops, end)]].append(i)
    for stop in stops:
        groups.append((side[0][stop], side[1][stop]))
    return groups


def brute_scores(libraries, rows):
    grouped = [(doc, brute_groups(libraries, text or "")) for doc, text in rows]
    count = Counter((a[-1], b[-1]) for _, groups in grouped for a, b in groups)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for doc, groups in grouped:
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        links = [(a[-1], b[-1]) for a, b in groups]
        out.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", *COLUMNS).collect()), key=str)


def test_query_against_the_libraries(spark, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(E.queries()["op12_token_alignment"](spark, SF_SMALL)) == brute_scores(libraries, rows)


TRICKY = [" ", "  ", "\n", " a", "a ", "a  b", "a \n b", "a\n\n  b\n", "x▁y", "▁", "\0", "a\0 b \0", "tab\t here", " nb sp",
          "　你好，世界", "é ́x Ａ", "\U0001f600\U0001f468‍\U0001f469", "don't we'll I'M",
          "<|endoftext|> <s> </s> <unk> <0x41>", "12345 67,890.12", "﻿bom", "\r\n\r\n a", "a  b", "a\x1c b", "\x85 x", "f▁ g h"]


def test_tricky_texts(spark, libraries, files):
    random.seed(5)
    parts = [*TRICKY, " ", "word", " the", "\n", "ing", "  "]
    texts = TRICKY + ["".join(random.choices(parts, k=random.randint(1, 12))) for _ in range(400)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(tokalign.score_links(df, files)) == brute_scores(libraries, rows)


def test_edges(spark, edge, nothing, libraries, files, monkeypatch):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    clash = edge.withColumns({c: F.lit("clash") for c in ("row", "links", "n_a", "link")})
    want = brute_scores(libraries, rows)
    assert found(tokalign.score_links(clash, files)) == want
    assert tokalign.score_links(nothing, files).count() == 0
    monkeypatch.setattr(tokalign, "FREQUENT", 4)  # most pairs then take the way of the join
    assert found(tokalign.score_links(clash, files)) == want


def test_blocks_and_store_change_nothing(libraries, files, monkeypatch):
    text = "Some words, unlike others; déjà vu 12\n\n  and so on. " * 40
    want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in brute_groups(libraries, text)).encode()
    for block, entries, join in ((1 << 20, 400_000, 1 << 19), (50, 3, 20), (1, 0, 1)):
        for name, value in (("BLOCK_CHARS", block), ("STORE_ENTRIES", entries), ("JOIN_CHARS", join)):
            monkeypatch.setattr(tokalign, name, value)
        aligner = tokalign.Aligner(files)
        assert "".join(tokalign.blocks(text)) == " " + text
        assert b";".join(e.groups for b in tokalign.blocks(text) for e in aligner.entries(b)) == want


def test_common_ends():
    random.seed(3)
    for _ in range(300):
        top = random.randint(1, 60)
        a, b = (sorted({*random.sample(range(1, top + 1), random.randint(0, top)), top}) for _ in range(2))
        runs = tokalign.common_ends(a, b)
        pairs = [(i + k, i + shift + k) for i, shift, n in runs for k in range(n)]
        assert [a[i] for i, _ in pairs] == [b[j] for _, j in pairs] == sorted(set(a) & set(b))
    assert tokalign.common_ends(list(range(1, 1001)), list(range(1, 1001))) == [(0, 0, 1000)]
