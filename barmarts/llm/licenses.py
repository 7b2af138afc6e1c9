"""Operator 9: license scan by ordered signature rules (DataFrame functions only).

Texts become words (A-Z lower-cased, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`), joined by
single blanks. A rule is tried only in texts that hold its literals, which are read off its own
pattern: every match must contain them (``key_literal``, ``form_literal``), so no text that a
rule fits is passed over. Rules are regular expressions over the joined words,
made from license families (names in full and abbreviations with versions), hand-written sentence
forms around them, and sentences of the license texts themselves. Every match is an interval of
words. A match is suppressed if its interval lies in that of another match, equal intervals
being decided by priority (more specific forms first).

Base phrases are found wherever their words stand consecutively; their labels always stay.

Defined results: null, empty and word-less texts have 0 words and no label (empty strings,
score 0, null places); very long texts are scanned whole, each in its own row, without a
shuffle, in time near linear in words and matches; repeated rows are scanned one by one; an empty table gives an empty result; other
columns pass through, columns named like a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import ascii_lower

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrase and label of the base scan.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

RUN = 64

# Families: label, keyword (in every match of the name), name as a pattern over words, may the name stand alone.
FAMILIES = [
    ("apache-1.1", "apache", "apache( software)?( license)?( version| v)? 1 1", True),
    ("apache-2.0", "apache", "apache( software)?( license)?( version| v)? 2( 0)?", True),
    ("mit", "mit", "mit( x11)?( expat)?( license)?", False),
    ("isc", "isc", "isc( license)?", False),
    ("zlib", "zlib", "zlib( libpng)?( license)?", False),
    ("bsd-2-clause", "bsd", "(simplified bsd|freebsd|bsd 2 clause|2 clause bsd)( license)?", True),
    ("bsd-3-clause", "bsd", "((new|modified|revised) bsd|bsd 3 clause|3 clause bsd)( license)?", True),
    ("bsd-4-clause", "bsd", "(original bsd|bsd 4 clause|4 clause bsd)( license)?", True),
    ("bsd", "bsd", "bsd( style)?( license)?", False),
    ("gpl-1.0", "general public", "(gnu )?general public license( version| v)? 1( 0)?", True),
    ("gpl-2.0", "general public", "(gnu )?general public license( version| v)? 2( 0)?( only| or later)?", True),
    ("gpl-3.0", "general public", "(gnu )?general public license( version| v)? 3( 0)?( only| or later)?", True),
    ("gpl", "gpl", "(gnu )?gpl", False),
    ("gpl-1.0", "gpl", "(gnu )?gpl( version | v| |v)1( 0)?", True),
    ("gpl-2.0", "gpl", "(gnu )?gpl( version | v| |v)2( 0)?( only| or later)?", True),
    ("gpl-3.0", "gpl", "(gnu )?gpl( version | v| |v)3( 0)?( only| or later)?", True),
    ("lgpl-2.1", "lgpl", "(gnu )?lgpl( version | v| |v)2 1( only| or later)?", True),
    ("lgpl-3.0", "lgpl", "(gnu )?lgpl( version | v| |v)3( 0)?( only| or later)?", True),
    ("lgpl", "lgpl", "(gnu )?lgpl", False),
    ("agpl-3.0", "agpl", "(gnu )?agpl( version | v| |v)3( 0)?( only| or later)?", True),
    ("agpl", "agpl", "(gnu )?agpl", False),
    ("gfdl", "gfdl", "(gnu )?gfdl(( version | v| |v)1 [123])?( only| or later)?", False),
    ("mpl-1.1", "mpl", "mpl( version | v| |v)1 1", True),
    ("mpl-2.0", "mpl", "mpl( version | v| |v)2( 0)?", True),
    ("epl-1.0", "epl", "epl( version | v| |v)1( 0)?", True),
    ("epl-2.0", "epl", "epl( version | v| |v)2( 0)?", True),
    ("eupl-1.2", "eupl", "eupl( version | v| |v)1 2", True),
    ("ofl-1.1", "ofl", "(sil )?ofl( version | v| |v)1 1", True),
    ("boost-1.0", "bsl", "bsl( version | v| |v)1 0", True),
    ("lgpl-2.1", "lesser", "(gnu )?lesser general public license( version| v)? 2 1", True),
    ("lgpl-3.0", "lesser", "(gnu )?lesser general public license( version| v)? 3( 0)?", True),
    ("lgpl", "lesser", "(gnu )?lesser general public license", True),
    ("agpl-3.0", "affero", "(gnu )?affero general public license( version| v)?( 3( 0)?)?", True),
    ("gfdl", "documentation", "(gnu )?free documentation license( version| v)?( 1 [123])?", True),
    ("mpl-1.1", "mozilla", "mozilla public license( version| v)? 1 1", True),
    ("mpl-2.0", "mozilla", "mozilla public license( version| v)? 2( 0)?", True),
    ("epl-1.0", "eclipse", "eclipse public license( version| v)? 1( 0)?", True),
    ("epl-2.0", "eclipse", "eclipse public license( version| v)? 2( 0)?", True),
    ("cddl-1.0", "cddl", "(common development and distribution license )?cddl( version| v)?( 1 0)?", False),
    ("artistic-2.0", "artistic", "artistic license( version| v)? 2( 0)?", True),
    ("boost-1.0", "boost", "boost software license( version| v)?( 1 0)?", True),
    ("ofl-1.1", "font", "(sil )?open font license( version| v)?( 1 1)?", True),
    ("odbl", "database", "open (data commons )?(open )?database license( version| v)?( 1 0)?", True),
    ("unlicense", "unlicense", "unlicense", True),
    ("wtfpl", "wtfpl", "wtfpl( version 2)?", False),
    ("cc0-1.0", "cc0", "cc0( 1 0)?( universal)?", True),
    ("cc-by-nc-nd", "cc by", "cc by nc nd( [1-4] [05])?", True),
    ("cc-by-nc-sa", "cc by", "cc by nc sa( [1-4] [05])?", True),
    ("cc-by-nc", "cc by", "cc by nc( [1-4] [05])?", True),
    ("cc-by-nd", "cc by", "cc by nd( [1-4] [05])?", True),
    ("cc-by-sa", "cc by", "cc by sa( [1-4] [05])?", True),
    ("cc-by", "cc by", "cc by( [1-4] [05])?", True),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike( [1-4] [05])?", True),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial( [1-4] [05])?", True),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike( [1-4] [05])?", True),
    ("cc-by", "creative commons", "creative commons attribution( [1-4] [05])?", True),
    ("cc-zero", "creative commons", "creative commons zero( 1 0)?( universal)?", True),
]

# Sentence forms around a name: prefix, suffix, confidence; the longest forms come first. After the
# prefix LOOSE a bare name of an institute is no license ("governed by the mit students").
LOOSE = "(use|used|covered|governed) (under|by) (the )?(terms of (the )?)?"
FORMS = [
    ("this (work|file|software|program|project|text|page) is (licensed|released|distributed|available) under (the )?(terms of (the )?)?", "", 1.0),
    ("permission is granted to copy distribute and or modify this document under the terms of (the )?", "", 1.0),
    ("(re)?distributed under the (terms|conditions) of (the )?", "", 0.95),
    ("(dual |multi )?licensed under (the )?(terms of (the )?)?", "", 0.95),
    ("(released|published|available|provided) under (the )?(terms of (the )?)?", "", 0.9),
    (LOOSE, "", 0.85),
    ("spdx license identifier ", "", 1.0),
    ("license ", "", 0.75),
    ("", " license", 0.8),
]

# Statements without a family: label, keyword, pattern, confidence.
STATEMENTS = [
    ("reserved", "rights reserved", "copyright( c)?( [0-9]{4})*( [^ ]+){0,6}? all rights reserved", 0.9),
    ("reserved", "rights reserved", "(all|some|no) rights reserved", 0.6),
    ("public-domain", "public domain", "(released|placed|dedicated) (into|in|to) the public domain", 0.95),
    ("public-domain", "public domain", "(this (work|file|text) is in )?(the )?public domain", 0.6),
    ("copyleft", "copyleft", "copyleft", 0.5),
    ("copyright", "copyright", "copyright( c)?( [0-9]{4})+", 0.5),
    ("proprietary", "license", "proprietary( and confidential)? license", 0.8),
    ("see-license", "license", "see (the )?(file )?license( file)?( txt| md)? for (details|more information|the full license)", 0.5),
    ("permissive-grant", "copyright", "permission is hereby granted free of charge to any person obtaining a copy", 0.9),
    ("warranty-disclaimer", "copyright", "in no event shall the (authors or )?copyright holders? be liable", 0.6),
    # sentences of the license texts themselves
    ("mit", "obtaining", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 1.0),
    ("boost-1.0", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", 1.0),
    ("isc", "without fee", "permission to use copy modify and (or )?distribute this software for any purpose with or without fee is hereby granted", 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("bsd-3-clause", "endorse", "neither the names? of( [^ ]+){1,12}? may be used to endorse or promote products", 1.0),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display", 1.0),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented", 1.0),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license", 0.95),
    ("gpl-2.0", "general public", "under the terms of the gnu general public license as published by the free software foundation either version 2", 1.0),
    ("gpl-3.0", "general public", "under the terms of the gnu general public license as published by the free software foundation either version 3", 1.0),
    ("lgpl-2.1", "lesser", "under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1", 1.0),
    ("lgpl-3.0", "lesser", "under the terms of the gnu lesser general public license as published by the free software foundation either version 3", 1.0),
    ("agpl-3.0", "affero", "under the terms of the gnu affero general public license as published by the free software foundation either version 3", 1.0),
    ("gfdl", "invariant", "with no invariant sections no front cover texts and no back cover texts", 1.0),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license", 1.0),
    ("cddl-1.0", "contents", "the contents of this file are subject to the terms of the common development and distribution license", 1.0),
    ("artistic", "intent", "the intent of this document is to state the conditions under which a package may be copied", 1.0),
    ("ofl-1.1", "font software", "this font software is licensed under the sil open font license", 1.0),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 1.0),
    ("cc0-1.0", "waived", "to the extent possible under law( [^ ]+){1,12}? has waived all copyright", 1.0),
]


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float
    name: str  # the part of the pattern that holds the keyword


def rules() -> list[Rule]:
    """All rules in priority order: forms around names, names alone, statements."""
    found = []
    for prefix, suffix, confidence in FORMS:
        for label, word, name, _ in FAMILIES:
            name = name.replace("( license)?", " license") if prefix == LOOSE else name
            found.append((label, word, f"{prefix}{name}{suffix}", confidence, name))
    found += [(label, word, name, 0.6, name) for label, word, name, alone in FAMILIES if alone]
    found += [(*statement, statement[2]) for statement in STATEMENTS]
    return [Rule(label, word, pattern, k, confidence, name) for k, (label, word, pattern, confidence, name) in enumerate(found)]


def literal_runs(pattern: str) -> list[str]:
    """Literal pieces that the joined words hold wherever the pattern matches, from left to right."""
    text = re.sub(r"\[[^]]*\][*+?]?", "\0", f" {pattern} ")
    while "(" in text:  # innermost groups first; \1 stands for an optional group whose branches start with a blank
        text = re.sub(r"\(([^()]*)\)(\{[0-9,]+\}\??|[*+?])?", lambda m: "\1" if m[2] in ("?", "*") and all(
            x.startswith(" ") for x in m[1].split("|")) else "\0", text)
    text = re.sub(r"[^\0\1]\?", "\0", text)
    text = re.sub("\1+ ", " \0 ", text)  # a blank follows, with the group or without it
    return [x for x in re.split("[\0\1]+", text) if x.strip()]


def key_literal(rule: Rule) -> str:
    """The piece around the rule's keyword, the first of its name without one, the keyword where the name has no piece."""
    runs = literal_runs(rule.name)
    return next((x for x in runs if rule.keyword in x), max(runs, key=len, default=rule.keyword))


def form_literal(rule: Rule) -> str:
    """The longest piece of the whole pattern ('' without any)."""
    return max(literal_runs(rule.pattern), key=len, default="")


def joined_words(text: Column) -> Column:
    """' w1 w2 ... wn ', or one blank without words."""
    return F.regexp_replace(F.concat(F.lit(" "), ascii_lower(F.coalesce(text, F.lit(""))), F.lit(" ")), NOT_WORD, " ")


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For every place the merge of 0 and all values before it. Arrays grow only inside blocks
    of ``RUN`` values and over the blocks, so time stays near linear in the number of values."""
    none = F.array().cast("array<int>")

    def each(part: Column, first: Column) -> Column:
        return F.aggregate(part, F.struct(first.alias("at"), none.alias("out")), lambda acc, v: F.struct(
            merge(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), merge))
        return _bind(each(totals, F.lit(0)), lambda first: F.flatten(F.transform(parts, lambda p, k: each(p, F.get(first, k)))))

    def blocks(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda b: F.slice(v, b * RUN + 1, F.lit(RUN)))

    return _bind(values, lambda v: F.when(F.size(v) == 0, none).otherwise(_bind(blocks(v), joined)))


def places(words: Column, pattern: Column) -> Column:
    """(start, end) in words of every match, from left to right; end is past the last word."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def located(sizes: Column) -> Column:
        return _bind(running(F.transform(sizes, lambda s: s["before"] + s["inner"]), lambda a, b: a + b), lambda at: F.transform(
            sizes, lambda s, k: F.struct((F.get(at, k) + s["before"] - 1).alias("start"),
                                         (F.get(at, k) + s["before"] + s["inner"]).alias("end"))))

    def sized(found: Column) -> Column:
        sizes = _bind(F.split(words, pattern), lambda pieces: F.transform(found, lambda x, k: F.struct(
            _blanks(F.get(pieces, k)).alias("before"), _blanks(x).alias("inner"))))
        return F.when(F.size(found) == 0, none).otherwise(_bind(sizes, located))

    return _bind(F.regexp_extract_all(words, pattern, 0), sized)


def bounded(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def key_literals(ruleset: list[Rule]) -> list[str]:
    return sorted({key_literal(r) for r in ruleset})


def met_keys(words: Column, ruleset: list[Rule]) -> Column:
    """Places in ``key_literals`` of the literals that the words hold."""
    keys = key_literals(ruleset)
    literals = F.lit(keys)
    return F.filter(F.sequence(F.lit(0), F.lit(len(keys) - 1)), lambda k: F.contains(words, F.get(literals, k)))


def detections(words: Column, met: Column, ruleset: list[Rule]) -> Column:
    """Matches that survive suppression: start, end, priority, label, confidence."""
    place = {key: k for k, key in enumerate(key_literals(ruleset))}
    key, form = F.lit([place[key_literal(r)] for r in ruleset]), F.lit([form_literal(r) for r in ruleset])
    pattern = F.lit([bounded(r.pattern) for r in ruleset])
    label, confidence = F.lit([r.label for r in ruleset]), F.lit([r.confidence for r in ruleset])
    tried = F.filter(F.sequence(F.lit(0), F.lit(len(ruleset) - 1)),
                     lambda i: F.array_contains(met, F.get(key, i)) & F.contains(words, F.get(form, i)))
    hits = F.flatten(F.transform(tried, lambda i: F.transform(places(words, F.get(pattern, i)), lambda p: F.struct(
        p["start"].alias("start"), (-p["end"]).alias("back"), i.alias("priority"),
        F.get(label, i).alias("label"), F.get(confidence, i).alias("confidence")))))
    # in this order only earlier matches can hold a later one
    return _bind(F.array_sort(hits), lambda every: _bind(
        running(F.transform(every, lambda d: -d["back"]), lambda a, b: F.greatest(a, b)),
        lambda reach: F.filter(every, lambda d, k: F.get(reach, k) < -d["back"])))


def scan(docs: DataFrame, ruleset: list[Rule] | None = None) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score and
    ``detections`` (start, end, label, confidence; places in words)."""
    ruleset = rules() if ruleset is None else ruleset
    kind = "array<struct<start:int,back:int,priority:int,label:string,confidence:double>>"
    words, met = F.col("_words"), F.col("_met")

    def labelled(phrase: str, label: str) -> Column:
        found = F.transform(places(words, F.lit(bounded(phrase))),
                            lambda p: F.struct(p["start"].alias("start"), F.lit(label).alias("label")))
        return F.when(F.contains(words, F.lit(phrase)), found).otherwise(F.array().cast("array<struct<start:int,label:string>>"))

    base = F.flatten(F.array(*[labelled(phrase, label) for phrase, label in BASE]))
    found = (docs.withColumn("_words", joined_words(F.col("text"))).withColumn("_met", met_keys(words, ruleset)).withColumns({
        "n_words": (_blanks(words) - 1).cast("long"),
        "_base": base,
        "_kept": F.when(F.size(met) > 0, detections(words, met, ruleset)).otherwise(F.array().cast(kind))}))
    base_labels = F.coalesce(F.array_distinct(F.transform("_base", lambda b: b["label"])), F.array().cast("array<string>"))
    all_labels = F.array_union(base_labels, F.transform("_kept", lambda d: d["label"]))
    return found.withColumns({
        "n_base": F.coalesce(F.size("_base"), F.lit(0)).cast("long"),
        "first_word": F.array_min(F.transform("_base", lambda b: b["start"])).cast("long"),
        "last_word": F.array_max(F.transform("_base", lambda b: b["start"])).cast("long"),
        "base_labels": F.array_join(F.array_sort(base_labels), ","),
        "labels": F.array_join(F.array_sort(all_labels), ","),
        "score": F.coalesce(F.array_max(F.transform("_kept", lambda d: d["confidence"])),
                            F.when(F.size("_base") > 0, F.lit(0.6)), F.lit(0.0)),
        "detections": F.transform("_kept", lambda d: F.struct(
            d["start"].alias("start"), (-d["back"]).alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence"))),
    }).drop("_words", "_met", "_base", "_kept")
