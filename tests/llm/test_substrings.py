"""Operator 13: substring dedup against all windows in one dictionary."""
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from barmarts.llm import substrings
from llm_edge import SF_SMALL, edge, nothing  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    """Rows (doc_id, text); null ids come last and never remove one another's words."""
    split = [((doc is None, doc or 0), WORD.findall(text or "")) for doc, text in rows]
    first = {}
    for key, words in split:
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            first[w] = min(key, first.get(w, key))
    out = []
    for (doc, _), (key, words) in zip(rows, split):
        gone, own = set(), set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if first[w] < key or w in own:
                gone.update(range(i, i + window))
            own.add(w)
        out.append((doc, len(words), len(gone), " ".join(x for i, x in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute(rows)]
    got = sorted((tuple(r) for r in E.queries()["op13_substring_dedup"](spark, SF_SMALL).collect()), key=str)
    assert got == sorted(want, key=str)


def test_edges(spark, edge, nothing):
    clash = edge.withColumns({c: F.lit("clash") for c in ("d", "marks", "start", "kept", "label")})
    assert found(substrings.substring_dedup(clash)) == brute([(r.doc_id, r.text) for r in edge.collect()])
    assert substrings.substring_dedup(nothing).count() == 0


@pytest.mark.parametrize("window, seed", [(20, 1), (6, 2), (4, 3)])
def test_spliced_texts(spark, window, seed):
    """Texts cut from each other at random places, small vocabularies (periodic windows), equal ids."""
    random.seed(seed)
    vocabulary = [[f"w{i}" for i in range(5000)], ["a", "b"], ["über", "x", "y"]]
    pool = [[random.choice(v) for _ in range(random.randint(1, 120))] for v in vocabulary for _ in range(8)]
    rows = []
    for doc in range(150):
        parts = []
        for _ in range(random.randint(0, 4)):
            p = random.choice(pool)
            a = random.randint(0, len(p))
            parts += p[a:a + random.randint(0, 80)]
            parts += random.choices(vocabulary[0], k=random.randint(0, 3))
        pool.append(parts)
        rows.append((random.choice([doc, doc, doc // 3 * 3, None]) if doc % 10 == 0 else doc, random.choice([" ", "\n", " \t "]).join(parts)))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(substrings.substring_dedup(df, window)) == brute(rows, window)


def test_hashes_and_edges():
    words = [b"a", b"b", b"c", b"a", b"b", b"c", b"d"] * 9
    h = substrings.Hashes(words)
    one = h.of(substrings.BASES[0], np.array([0, 7, 3]), np.array([3, 10, 6]))
    assert one[0] == one[1] == one[2] != h.of(substrings.BASES[0], np.array([1]), np.array([4]))[0]
    start, n, anchor, label = substrings.document_edges(substrings.Hashes([b"%d" % i for i in range(100)]), 20)
    assert n.sum() == 81 and start[0] == 0 and (np.diff(start) == n[:-1]).all() and len(set(label)) == len(label)
