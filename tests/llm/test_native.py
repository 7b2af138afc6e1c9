"""Operators 2, 7, 8, 9, 10: SQL twins, brute force and edge cases."""
import math
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from barmarts.llm import licenses, line_dedup, minhash, quality, url_lm
from barmarts.llm.queries import URL_RULES
from llm_edge import SF_SMALL, edge, nothing  # noqa: F401
from oracle_harness import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("key", ["op7_quality_rules", "op8_line_dedup", "op9_license_scan", "op10_minhash_dedup"])
def test_sql_twin(spark, key):
    r = compare(E.queries()[key](spark, SF_SMALL), E.oracle_sql()[key], SF_SMALL)
    assert r["values_match"], r


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- quality -----------------------------------------------------------------------------

def brute_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    win = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {i + k for i, x in enumerate(win) if Counter(win)[x] > 1 for k in range(3)} if len(win) < 2000 else None
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), \
        None if twice is None else len(twice)


def test_quality_edges(spark, edge, nothing):
    out = quality.quality(edge.withColumn("words", F.lit("clash")).withColumn("kept", F.lit("clash")))
    no_python(out)
    rows = out.collect()
    assert len(rows) == edge.count() and quality.quality(nothing).count() == 0
    for r in rows:
        want = brute_quality(r.text)
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got[:4] == want[:4] and (want[4] is None or got[4] == want[4])
        assert not r.kept or r.n_words >= 50


def test_cascade_order_changes_cost_only(edge):
    rules = quality.default_rules()
    docs = quality.base_counts(edge)
    one, two = (docs.select("doc_id", quality.cascade(r).isNull().alias("k")).collect() for r in (rules, rules[::-1]))
    assert sorted(map(str, one)) == sorted(map(str, two))
    est = quality.estimate(edge, rules)
    assert [e.name for e in est] == [r.name for r in rules] and all(0 <= e.rejected <= 1 and e.seconds >= 0 for e in est)
    made = [quality.Estimate("a", 1.0, 0.1), quality.Estimate("b", 0.1, 0.1), quality.Estimate("c", 1.0, 0.0)]
    order = quality.ordered([quality.Rule(n, F.lit(True)) for n in "abc"], made)
    assert [r.name for r in order] == ["b", "a", "c"]


# --- line dedup --------------------------------------------------------------------------

def test_lines_within_one_word_edit(spark):
    base = "a b c d e f g h i j k l".split()
    other = [base[:3] + ["X"] + base[4:], base[:-1], base + ["m"], ["X"] + base[1:-1] + ["Y"], base[::-1], base[:5]]
    docs = spark.createDataFrame([(0, " ".join(base))] + [(k + 1, " ".join(x)) for k, x in enumerate(other)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup.line_dedup(docs).collect()}
    assert [out[k] != "" for k in range(7)] == [True, False, False, False, True, True, True]


def test_line_dedup_edges(spark, edge, nothing):
    out = line_dedup.line_dedup(edge.withColumn("n_lines", F.lit("clash")))
    no_python(out)
    rows = {(r.doc_id, r.n_chars): r for r in out.collect()}
    assert out.count() == edge.count() and line_dedup.line_dedup(nothing).count() == 0
    assert rows[2, None].text is None and rows[3, 0].text == "" and rows[4, 4].text == " \n\t\n "
    assert rows[1, 10].n_dropped == 0 and rows[6, 10].text == "" and rows[6, 10].n_dropped == 2
    assert rows[9, 3].text == "línea única con ñ y ü\nline two\r"


# --- licenses ----------------------------------------------------------------------------

def test_license_intervals(spark, edge, nothing):
    texts = ["Licensed under the Apache License, Version 2.0. (C) all rights reserved", "CC BY-NC 4.0 and CC BY", "mit der Licenz",
             "This work is licensed under the GNU General Public License, version 3.", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").withColumn("labels", F.lit("clash"))
    out = licenses.scan(docs)
    no_python(out)
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].labels == "apache-2.0,reserved" and rows[0].base_labels == "reserved" and (rows[0].first_word, rows[0].n_base) == (9, 1)
    assert rows[1].n_base == 2 and (rows[1].first_word, rows[1].last_word) == (0, 6) and rows[1].labels == "cc-by,cc-by-nc"
    assert rows[2].labels == "" and rows[2].score == 0 and rows[4].n_words == 0 and rows[4].first_word is None
    assert rows[3].labels == "gpl,gpl-3.0" and [(d.start, d.end) for d in rows[3].detections] == [(0, 12)]
    assert licenses.scan(edge).count() == edge.count() and licenses.scan(nothing).count() == 0
    assert len(licenses.rules()) > 300


def matches_of(pattern):
    """The least match of a pattern, and for each alternative and each optional part one match with it."""
    def forms(tree):  # every choice on its own, the others at their least
        parts = []
        for kind, arg in tree:
            if kind is parser.LITERAL:
                parts.append([chr(arg)])
            elif kind is parser.IN:
                parts.append([chr(arg[0][1][0] if arg[0][0] is parser.RANGE else arg[0][1])])
            elif kind is parser.NOT_LITERAL:
                parts.append(["q"])
            elif kind is parser.BRANCH:
                parts.append([x for branch in arg[1] for x in forms(branch)])
            elif kind is parser.SUBPATTERN:
                parts.append(forms(arg[3]))
            else:  # a repeated part: (least, most, tree)
                inner = forms(arg[2])
                parts.append([inner[0] * arg[0], *(x * max(arg[0], 1) for x in inner)])
        least = [p[0] for p in parts]
        return ["".join(least)] + ["".join([*least[:k], x, *least[k + 1:]]) for k, p in enumerate(parts) for x in p[1:]]
    parser = re._parser
    return list(dict.fromkeys(forms(parser.parse(pattern))))


def test_every_rule_is_reached_by_a_match_alone(spark):
    rules = licenses.rules()
    texts, compiled = {}, [re.compile(r.pattern) for r in rules]
    for rule, own in zip(rules, compiled):
        made = matches_of(rule.pattern)
        assert all(own.fullmatch(t) for t in made) and made
        needed = [*licenses.literal_runs(rule.pattern), licenses.key_literal(rule), licenses.form_literal(rule)]
        assert all(x in f" {t} " for t in made for x in needed), rule
        texts |= dict.fromkeys([made[0], max(made, key=len)])
    texts = [*texts, "Released under the GNU GPL.", "Distributed under the terms of the Apache 2.0", "FreeBSD"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        words = " ".join(re.findall("[a-z0-9]+", r.text.lower()))
        best = next(rule for rule, own in zip(rules, compiled) if own.fullmatch(words))
        assert [(d.start, d.end, d.label) for d in r.detections] == [(0, len(words.split()), best.label)], r.text
        assert best.label in r.labels.split(",") and r.score == best.confidence


@pytest.mark.parametrize("text, labels", [
    ("Licensed under LGPL-2.1", "lgpl-2.1"), ("MPL-2.0", "mpl-2.0"), ("SPDX-License-Identifier: AGPL-3.0-only", "agpl-3.0"),
    ("licensed under the GPLv2", "gpl-2.0"), ("GPL-3.0-or-later", "gpl-3.0"), ("licensed under the EPL 2.0", "epl-2.0"),
    ("LGPLv3+", "lgpl-3.0"), ("released under the LGPL", "lgpl"), ("the OFL-1.1", "ofl-1.1"), ("EUPL-1.2", "eupl-1.2"),
    ("governed by the mit students", ""), ("governed by the MIT license", "mit"), ("covered by the bsd team", ""),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("Neither the name of Some Institute nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", "gpl,gpl-2.0"),
    ("To the extent possible under law, A. N. Other has waived all copyright", "cc0-1.0"),
    ("gplants 2", "")])
def test_abbreviations_and_license_texts(spark, text, labels):
    assert licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().labels == labels


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_places_and_containment_of_many_matches(spark, n):
    text = " ".join(["x y cc by nc 4 0 z", "cc by sa", "all rights reserved w"][k % 3] for k in range(n))
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    words, at = text.split(), []
    for k, word in enumerate(words):
        if word == "cc":
            at.append((k, k + (5 if words[k + 2] == "nc" else 3), "cc-by-" + words[k + 2]))
        elif word == "all":
            at.append((k, k + 3, "reserved"))
    assert [(d.start, d.end, d.label) for d in row.detections] == at
    assert (row.n_base, row.first_word, row.last_word) == (n, at[0][0], at[-1][0])


def test_long_text_takes_linear_time(spark):
    docs = spark.createDataFrame([(1, "licensed under the mit license and cc by sa 4 0 " * 20_000)], "doc_id long, text string")
    start = time.monotonic()
    row = licenses.scan(docs).first()
    assert row.n_base == 20_000 and len(row.detections) == 40_000 and time.monotonic() - start < 60


# --- near duplicates ---------------------------------------------------------------------

def brute_components(rows, width, threshold):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    ids, up = sorted(sets), {i: i for i in sets}
    find = lambda x: x if up[x] == x else find(up[x])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            i = len(sets[a] & sets[b])
            if i and 100 * i >= threshold * (len(sets[a]) + len(sets[b]) - i):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_near_classes_of_a_chain_and_copies(spark, width):
    base = [f"w{k}" for k in range(400)]
    rows = [(0, " ".join(base))]
    for step in range(1, 40):  # a chain: neighbours are near, the ends are not
        base[step * 9] = f"x{step}"
        rows.append((step, " ".join(base)))
    rows += [(100 + k, rows[5][1]) for k in range(30)] + [(200, "one two"), (201, "one two"), (202, "one two three"), (203, None), (204, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_classes(docs, width, 80).collect()}
    assert got == brute_components(rows, width, 80)


def test_near_classes_edges(edge, nothing):
    out = minhash.near_classes(edge.withColumn("n", F.lit("clash")), 2, 80)
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[6].component_id == 1 and rows[2].component_id == 2 and rows[None].component_id is None
    kept = minhash.near_dedup(edge, 2, 80)
    assert kept.columns == edge.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 7, 8, 9, None}
    assert minhash.near_classes(nothing).count() == 0


def test_near_classes_of_repeated_and_null_ids(spark):
    texts = {"x": " ".join(f"w{k}" for k in range(60)), "y": " ".join(f"v{k}" for k in range(60)), "z": "entirely other words here", "": ""}
    rows = [(1, "x"), (1, "y"), (1, "y"), (2, "y"), (3, "x"), (4, "z"), (4, ""), (5, ""), (6, "z"), (6, "x"), (None, "x"), (None, "z"), (None, "z"), (9, "")]
    docs = spark.createDataFrame([(d, texts[t]) for d, t in rows], "doc_id long, text string").repartition(4)
    for width in (2, 5):
        out = minhash.near_classes(docs, width, 80).collect()
        # 1 joins the classes of x and y, 6 those of z and x
        assert sorted((r.doc_id, r.component_id) for r in out if r.doc_id is not None) == [
            (1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (4, 1), (5, 5), (6, 1), (6, 1), (9, 9)]
        assert [(r.doc_id, r.component_id) for r in out if r.doc_id is None] == [(None, None)] * 3
        left = sorted(((r.doc_id, r.text) for r in minhash.near_dedup(docs, width, 80).collect()), key=str)
        # each text by its own links: the first document of x, y and z stays, and what has no words
        want = [(1, "x"), (1, "y"), (1, "y"), (4, "z"), (4, ""), (5, ""), (9, ""), (None, "x"), (None, "z"), (None, "z")]
        assert left == sorted(((d, texts[t]) for d, t in want), key=str)
    with pytest.raises(ValueError, match="80 or more"):
        minhash.near_classes(docs, 2, 50)


# --- URLs --------------------------------------------------------------------------------

def brute_ratio(train, text, order):
    counts = [defaultdict(Counter), defaultdict(Counter)]
    cut = lambda t: [(f"{url_lm.PAD * order}{t}{url_lm.END}")[i:i + order + 1] for i in range(len(t) + 1)]
    for t, rejected in train:
        for w in cut(t):
            for k in range(order + 1):
                counts[rejected][w[order - k:order]][w[order]] += 1
    total = 0.0
    for w in cut(text):
        p = [1 / url_lm.ALPHABET] * 2
        for k in range(order + 1):
            for side in (0, 1):
                seen = counts[side].get(w[order - k:order])
                if seen:
                    p[side] = (seen[w[order]] + len(seen) * p[side]) / (sum(seen.values()) + len(seen))
        total += math.log(p[1]) - math.log(p[0])
    return total / (len(text) + 1)


def test_url_scores_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url")
    out = url_lm.judge(pages, URL_RULES).withColumn("held", F.pmod(F.xxhash64(F.concat("host", "path")), F.lit(5)) == 0)
    no_python(out)
    rows = out.collect()
    train = list({(r.host + r.path, int(URL_RULES[r.rule] == "block")) for r in rows if r.rule and not r.held})
    for r in rows:
        assert r.score == pytest.approx(brute_ratio(train, r.host + r.path, url_lm.ORDER), abs=1e-9)
        assert r.rule is None or r.verdict == URL_RULES[r.rule]


def test_whole_urls_and_copies_count(spark):
    urls = [f"http://{host}/{'en' if k % 2 else 'de'}/{k % 7}?q={k % 5}#{host[0]}" for k in range(24) for host in ("example.net", "a.net", "b.org")]
    urls += urls[:3] * 9 + ["https://b.org/x", "https://b.org/x?q=casino", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_lm.judge(pages, URL_RULES, whole=True).withColumn("held", F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(5)) == 0)
    no_python(out)
    rows = {r.page_id: r for r in out.collect()}
    train = [(r.url, int(URL_RULES[r.rule] == "block")) for r in rows.values() if r.rule and not r.held]  # every row
    assert len(rows) == len(urls) and len(train) > len(set(train)) and len({k for _, k in train}) == 2
    for r in rows.values():
        assert r.score == pytest.approx(brute_ratio(train, r.url or "", url_lm.ORDER), abs=1e-9)
    assert rows[len(urls) - 3].score != rows[len(urls) - 2].score  # they differ in the query only
    scored = spark.createDataFrame([(0.1, False, 1), (0.3, True, 1), (0.5, False, 8), (0.7, True, 3)], "score double, rejected boolean, copies long")
    assert 0.5 < url_lm.calibrate(scored) < 0.7  # one row each, 0.1 to 0.3 would be as good


def test_url_parts_and_rules(spark):
    urls = [None, "", "nope", "http://A.Example.NET/en/x?y#z", "https://example.net?q", "ftp://x.org/fr/1", "http://example.com/de/", "http://myexample.com/de/", "http://ü.net/", "http://a.net/" + "x" * 50_000]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(1, "")], "page_id long, url string").withColumn("verdict", F.lit("clash"))
    rows = {r.page_id: r for r in url_lm.judge(pages, URL_RULES).collect()}
    assert [(rows[k].host, rows[k].path, rows[k].rule) for k in range(9)] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.example.net", "/en/x", "example.net/en/"), ("example.net", "", None),
        ("x.org", "/fr/1", "org/fr/"), ("example.com", "/de/", "example.com/de/"), ("myexample.com", "/de/", None), ("ü.net", "/", "net/")]
    assert {r.verdict for r in rows.values()} <= {"allow", "block"}
    assert url_lm.judge(pages.limit(0), URL_RULES).count() == 0


def test_minhash_keys_number_their_table(spark):
    """The table of a key is read from its low bits, so a bucket's rows need no second set of keys."""
    groups, band = 3, 2
    docs = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(9))), (2, " ".join(f"w{k}" for k in range(170))),
                                  (3, " ".join(f"w{k}" for k in range(400)))], "doc_id long, text string")
    classes = minhash.signatures(docs, 2, 2 * groups * band).withColumnRenamed("doc_id", "rep")
    keys = minhash.table_keys(classes, groups, band)
    mask, tables = minhash._place_mask(groups), groups * groups
    places = {}
    for r in keys.collect():
        places.setdefault(r.rep, []).append(r.key & mask)
    assert {k: sorted(v) for k, v in places.items()} == {
        1: list(range(tables)), 2: list(range(2 * tables)), 3: list(range(tables, 2 * tables))}
    met = minhash.with_tables(keys, classes, groups, band)
    wrong = F.expr("shiftright(key, 5) <> shiftright(xxhash64(get(us, i), get(vs, j)), 5)")
    assert mask == 31 and met.count() == 4 * tables and met.where(wrong).count() == 0
