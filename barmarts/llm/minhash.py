"""Operator 10: MinHash near-duplicates by tensored banding (DataFrame functions only).

A document's set holds its distinct w-word shingles; documents are linked if
100 * |A and B| >= threshold * |A or B|. Classes are the connected components of the links.

Method. Two small collections of ``groups`` hash groups each, every group the concatenation
of ``band`` minhashes, give groups^2 tables: table (i, j) has the key (u_i, v_j). So
2 * groups * band minhashes do the work of groups^2 * 2 * band. Two sets of similarity J
meet in some table with probability (1 - (1 - J^band)^groups)^2; with the defaults
(band 3, groups 12) a pair at exactly J = 0.8 is missed with probability 4e-4, one at
J = 0.85 with 2e-5, and a class is lost only if all its links are.

* Equal sets are one class before anything is paired (pre-aggregated by a 128-bit
  fingerprint), so exact copies cost one row per task.
* A small set takes each minhash over all its shingles; a set of ``ONE_PASS`` shingles or more
  splits the hash range into as many bins and takes each bin's least hash, one pass for all (an empty bin
  gives 0, so two sets agree in a bin with probability J or more).
  Sets of up to 1.25 * ONE_PASS shingles carry both kinds, so any two sets whose sizes allow a
  similarity of 0.8 have a kind in common.
* Of a bucket's sets only those with a partner go on that agrees in at least ``AGREE`` of 42
  eight-bit minhash prints (a pair at J = 0.8 has about 34; fewer than 21 have probability
  5e-6). That is a semi-join, so a bucket yields no pairs at this point.
* In each bucket every set is compared with the bucket's least set only (a star). The
  components of the verified links are then known, and only sets of one bucket that lie in
  different components are compared in a second pass, each pair in the first table where it
  meets. Near copies of one text therefore cost a star, not all pairs, and no link between
  different components is skipped.
* Before a pair is built its sizes must allow the similarity, and so must its odd sketch:
  the number of differing sketch bits never exceeds the size of the symmetric difference,
  so the test loses no link. Links are confirmed on the full sets.

Defined results: null and empty texts, and texts without a word, have an empty set and are
linked with nothing; with fewer words than a shingle the whole sequence is one shingle;
repeated rows are one document; an id with several texts gives a row for each distinct set, and
joins the classes of all its texts (``near_dedup`` judges each text by its own links); every row
with a null doc_id is returned with a null component, kept, and linked with nothing; ties go to
the least doc_id; an empty table gives an empty result. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import Workspace, ascii_lower, connected_components, split_words

SKETCH_WORDS = 8
ONE_PASS = 144
PRINTS = 6  # longs of seven 8-bit prints
AGREE = 21


def shingle_hashes(text: Column, width: int) -> Column:
    """Distinct 64-bit hashes of the w-word shingles; [] without a word."""
    # binding to a lambda variable evaluates the lower-cased text, and below the word hashes, once a text
    words = F.get(F.transform(F.array(ascii_lower(F.coalesce(text, F.lit("")))), split_words), F.lit(0))

    def hashed(h: Column) -> Column:
        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(0)))
        if width == 2:
            each = F.zip_with(starts, F.slice(h, F.lit(2), F.size(starts)), lambda a, b: F.xxhash64(a, b))
        else:
            each = F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(
            F.size(h) < width, F.array(F.xxhash64(h, F.lit(width)))).otherwise(F.array_distinct(each))

    return F.get(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), hashed), F.lit(0))


def small_minhashes(s: Column, hashes: int) -> Column:
    """Every minhash over the whole set."""
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)),
                       lambda j: F.array_min(F.transform(s, lambda x: F.xxhash64(x, j))))


def one_pass_minhashes(s: Column, hashes: int) -> Column:
    """The least hash of each of ``hashes`` (even) bins of the sorted set; an empty bin gives 0."""
    def bin_of(x: Column) -> Column:
        return F.shiftright(F.shiftrightunsigned(x, 32) * hashes, 32)

    def firsts(bins: Column) -> Column:
        first = F.filter(s, lambda x, i: (i == 0) | (F.get(bins, i) != F.get(bins, i - 1)))
        return F.struct(F.array_distinct(bins).alias("bin"), first.alias("least"))

    def spread(found: Column) -> Column:
        # an absent bin is at position 0, whose predecessor gives null
        return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)).cast("array<bigint>"), lambda j: F.coalesce(
            F.get(found["least"], F.array_position(found["bin"], j).cast("int") - 1), F.lit(0).cast("long")))

    found = F.transform(F.array(F.transform(s, bin_of)), firsts)
    return F.get(F.transform(found, spread), F.lit(0))


def signatures(docs: DataFrame, width: int, hashes: int) -> DataFrame:
    """Each row's fingerprint f1, f2 and size n of its set, minhashes small and large."""
    sets = docs.select("doc_id", F.sort_array(shingle_hashes(F.col("text"), width)).alias("s"))
    n = F.size("s")
    return sets.select(
        "doc_id", F.xxhash64("s").alias("f1"), F.xxhash64(F.lit("second"), F.col("s")).alias("f2"), n.alias("n"),
        F.when((n > 0) & (4 * n < 5 * ONE_PASS), small_minhashes(F.col("s"), hashes)).alias("small"),
        F.when(n >= ONE_PASS, one_pass_minhashes(F.col("s"), hashes)).alias("large"))


def group_hashes(kind: str, side: str, groups: int, band: int) -> Column:
    """The ``groups`` group hashes of one collection ("u" or "v") of one kind of minhashes."""
    base = 0 if side == "u" else groups * band
    return F.array(*[F.xxhash64(F.lit(kind + side), F.lit(i), *[F.get(kind, F.lit(base + i * band + k)) for k in range(band)])
                     for i in range(groups)])


def kind_keys(kind: str, groups: int, band: int) -> Column:
    """Keys of all groups^2 tables, table (i, j) at place i * groups + j; [] without minhashes."""
    us, vs = group_hashes(kind, "u", groups, band), group_hashes(kind, "v", groups, band)
    keys = F.flatten(F.transform(us, lambda u: F.transform(vs, lambda v: F.xxhash64(u, v))))
    return F.when(F.col(kind).isNotNull(), keys).otherwise(F.array().cast("array<bigint>"))


def _place_mask(groups: int) -> int:
    """The low bits of a key that number its table: groups^2 for each kind of minhashes."""
    return (1 << (2 * groups * groups - 1).bit_length()) - 1


def table_keys(classes: DataFrame, groups: int, band: int) -> DataFrame:
    """(rep, key): every class in its groups^2 tables; the low bits of a key number the table."""
    mask = _place_mask(groups)
    first = F.when(F.col("small").isNull(), F.lit(groups * groups)).otherwise(0)  # no small ones before the large
    keys = F.concat(kind_keys("small", groups, band), kind_keys("large", groups, band))
    return classes.select("rep", first.alias("_first"), F.posexplode(keys).alias("_p", "_key")).select(
        "rep", F.col("_key").bitwiseAND(F.lit(~mask)).bitwiseOR((F.col("_first") + F.col("_p")).cast("long")).alias("key"))


def with_tables(rows: DataFrame, classes: DataFrame, groups: int, band: int) -> DataFrame:
    """``rows`` (key, rep, ...) with the table (i, j) of the key and the class's group hashes."""
    place = F.col("key").bitwiseAND(F.lit(_place_mask(groups))).cast("int")
    small = place < groups * groups
    at = F.pmod(place, F.lit(groups * groups))
    hashes = {f"{side}s": F.when(small, group_hashes("small", side, groups, band)).otherwise(group_hashes("large", side, groups, band))
              for side in "uv"}
    return rows.join(classes.select("rep", "small", "large"), "rep").withColumns(
        {"i": F.floor(at / groups).cast("int"), "j": F.pmod(at, F.lit(groups)), **hashes}).drop("small", "large")


def _first_table(a: str, b: str) -> Column:
    """The rows' table is the first in which the pair meets, so a pair is built in one table only."""
    def earlier(hashes: str, place: str) -> Column:
        same = F.zip_with(F.col(f"{a}.{hashes}"), F.col(f"{b}.{hashes}"), lambda x, y: x == y)
        return F.exists(F.slice(same, F.lit(1), F.col(f"{a}.{place}")), lambda x: x)
    return ~earlier("us", "i") & ~earlier("vs", "j")


def member_sets(docs: DataFrame, members: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(rep, n, s, x0..): set and odd sketch of every class that shares a bucket."""
    ids = members.select("rep").distinct().join(classes.select("rep", "least", "f1"), "rep")
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("least"))
    # the fingerprint test stays inside the aggregate: as a filter it would become a join key
    # and every text of the corpus would be cut into shingles for it; it also tells an id's texts apart
    sets = (texts.select("rep", "f1", F.sort_array(shingle_hashes(F.col("text"), width)).alias("s"))
            .groupBy("rep").agg(F.first(F.when(F.xxhash64("s") == F.col("f1"), F.col("s")), ignorenulls=True).alias("s")))

    def sketch_word(k: int) -> Column:
        mine = F.filter("s", lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(SKETCH_WORDS - 1)) == k)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))))

    bits = [sketch_word(k).alias(f"x{k}") for k in range(SKETCH_WORDS)]
    return sets.select("rep", F.size("s").alias("n"), "s", *bits)


def prints(classes: DataFrame) -> DataFrame:
    """(rep, n, small0.., large0..): seven 8-bit prints of the first minhashes in each long."""
    def packed(kind: str, k: int) -> Column:
        return F.aggregate(F.slice(kind, 7 * k + 1, 7), F.lit(0).cast("long"),
                           lambda acc, x: F.shiftleft(acc, 8).bitwiseOR(x.bitwiseAND(F.lit(255).cast("long")))).alias(f"{kind}{k}")
    return classes.select("rep", "n", *[packed(kind, k) for kind in ("small", "large") for k in range(PRINTS)])


def _agree(a: str, b: str) -> Column:
    """The pair agrees in at least AGREE prints of a kind that both have, and its sizes fit."""
    low = F.lit(0x007F7F7F7F7F7F7F)

    def equal(kind: str, k: int) -> Column:
        x = F.col(f"{a}.{kind}{k}").bitwiseXOR(F.col(f"{b}.{kind}{k}"))
        # the top bit of a byte stays clear exactly if the byte is 0, that is, the prints are equal
        full = ((x.bitwiseAND(low) + low).bitwiseOR(x)).bitwiseAND(F.lit(0x0080808080808080))
        return F.lit(7) - F.bit_count(full)

    def total(kind: str) -> Column:
        return sum((equal(kind, k) for k in range(1, PRINTS)), equal(kind, 0))

    return (total("small") >= AGREE) | (total("large") >= AGREE)


def _sizes(a: str, b: str, threshold: int) -> Column:
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return 100 * F.least(na, nb) >= threshold * F.greatest(na, nb)


def _possible(a: str, b: str, threshold: int) -> Column:
    """Sizes and odd sketches allow the similarity (never false for a link)."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differing = sum((F.bit_count(F.col(f"{a}.x{k}").bitwiseXOR(F.col(f"{b}.x{k}"))) for k in range(1, SKETCH_WORDS)),
                    F.bit_count(F.col(f"{a}.x0").bitwiseXOR(F.col(f"{b}.x0"))))
    return _sizes(a, b, threshold) & ((100 + threshold) * differing <= (100 - threshold) * (na + nb))


def bucket_members(classes: DataFrame, groups: int, band: int, threshold: int, ws: Workspace) -> DataFrame:
    """(key, rep) of every class that agrees with another one in the bucket."""
    # dealt once by key: the counting and the join read the same shuffle
    keys = table_keys(classes, groups, band).repartition("key")
    shared = keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key")
    rows = ws.store(keys.join(shared, "key").join(prints(classes), "rep"), "rows")
    return rows.alias("l").join(rows.alias("r"), F.expr("l.key = r.key AND l.rep <> r.rep") & _sizes("l", "r", threshold)
                                & _agree("l", "r"), "left_semi").select("key", "rep")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of class representatives that are links, confirmed on their full sets."""
    met = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
           .join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b"))
    both = met.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    return both.where(100 * F.col("i") >= threshold * (F.col("t") - F.col("i"))).select("a", "b")


def near_classes(docs: DataFrame, width: int = 5, threshold: int = 80, groups: int = 12, band: int = 3) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each document's distinct set, one for
    every row without an id.

    ``width``: words a shingle; ``threshold``: similarity in percent, 80 or more (the tests of
    prints and kinds of minhashes are set for that); ``groups`` and ``band``: hash groups in each
    collection and minhashes in each group (2 * groups * band must be even and at least 42).
    """
    return _text_classes(docs, width, threshold, groups, band).select("doc_id", "n_shingles", "component_id")


def _text_classes(docs: DataFrame, width: int, threshold: int, groups: int = 12, band: int = 3) -> DataFrame:
    """(doc_id, f1, n_shingles, first, texts, component_id): ``first`` is the least doc_id that the
    row's own text is linked with, ``texts`` the number of sets under its id, ``component_id`` the
    least one when all texts of an id are joined as well."""
    if threshold < 80:
        raise ValueError("threshold: 80 or more")
    ws = Workspace(docs.sparkSession, "minhash")
    docs = docs.select("doc_id", "text")
    signed = ws.store(signatures(docs, width, 2 * groups * band), "signatures")
    known = signed.where("doc_id IS NOT NULL")
    classes = ws.store(known.where("n > 0").groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("least"), F.first("small").alias("small"), F.first("large").alias("large"))
        # class numbers ascend with the least doc_id: the least one of a bucket, with which the others
        # are compared first, is then the text that came first and not one of its copies
        .repartitionByRange("least", "f1").sortWithinPartitions("least", "f1").withColumn("rep", F.monotonically_increasing_id()), "classes")
    near = ws.store(bucket_members(classes, groups, band, threshold, ws), "near")
    sets = ws.store(member_sets(docs, near, classes, width), "sets")
    sketches = sets.drop("s")
    pivots = near.groupBy("key").agg(F.min("rep").alias("pivot"))
    members = ws.store(near.join(pivots, "key"), "members")

    # first pass: every set with the least pivot that it may be linked with
    star = members.where("rep <> pivot").select("rep", "pivot").distinct()
    star = (star.join(sketches.alias("l"), star["rep"] == F.col("l.rep")).join(sketches.alias("r"), star["pivot"] == F.col("r.rep"))
            .where(_possible("l", "r", threshold)).groupBy(star["rep"].alias("a")).agg(F.min(star["pivot"]).alias("b")))
    links = ws.store(verified(ws.store(star, "star"), sets, threshold), "links-1")
    found = ws.store(connected_components(links, ws, "first"), "components-1")

    # second pass: within a bucket, sets of different components
    placed = (members.join(found.withColumnRenamed("node", "rep"), "rep", "left")
              .select("key", "pivot", "rep", F.coalesce("component", "rep").alias("comp")))
    open_keys = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                           F.max(F.when(F.col("rep") == F.col("pivot"), F.col("comp"))).alias("main"))
                 .where("lo <> hi").select("key", "main"))
    left_over = ws.store(with_tables(placed.select("key", "rep", "comp").join(open_keys, "key").join(sketches, "rep"),
                                     classes, groups, band), "open")
    cross = (left_over.where("comp <> main").alias("l").join(left_over.alias("r"), F.expr(
        "l.key = r.key AND l.comp <> r.comp AND (r.comp = r.main OR l.rep < r.rep)") & _possible("l", "r", threshold) & _first_table("l", "r"))
        .select(F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")).distinct())
    more = ws.store(verified(ws.store(cross, "cross"), sets, threshold), "links-2")
    joined = ws.store(connected_components(links.unionByName(more), ws, "second"), "components-2")

    # which class each text is in, and the least doc_id of the class's component
    texts = ws.store(known.select("doc_id", "f1", "f2", "n").distinct().join(
        classes.select("f1", "f2", "n", "rep", "least"), ["f1", "f2", "n"], "left"), "texts")
    several = ws.store(texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts"), F.min("rep").alias("b")).where("texts > 1"), "several")
    same_id = (texts.select("doc_id", "rep").join(several, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b"))
    links = joined.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(same_id)
    whole = joined if several.isEmpty() else ws.store(connected_components(links, ws, "third"), "components-3")

    def least(components: DataFrame, name: str) -> DataFrame:
        met = components.withColumnRenamed("node", "rep").join(classes.select("rep", "least"), "rep")
        return met.join(met.groupBy("component").agg(F.min("least").alias(name)), "component").select("rep", name)

    rows = (texts.join(least(joined, "_own"), "rep", "left").join(least(whole, "_all"), "rep", "left")
            .join(several.select("doc_id", "texts"), "doc_id", "left"))
    rows = rows.select("doc_id", "f1", F.col("n").cast("long").alias("n_shingles"), F.coalesce("_own", "least", "doc_id").alias("first"),
                       F.coalesce("texts", F.lit(1)).alias("texts"), F.coalesce("_all", "least", "doc_id").alias("component_id"))
    # a text without words has no class; it goes with the other texts of its id
    of_id = rows.where("texts > 1").groupBy("doc_id").agg(F.min("component_id").alias("_id"))
    rows = rows.join(of_id, "doc_id", "left").withColumn("component_id", F.coalesce("_id", "component_id")).drop("_id")
    nameless = signed.where("doc_id IS NULL").select(
        "doc_id", "f1", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("first"), F.lit(1).cast("long").alias("texts"),
        F.col("doc_id").alias("component_id"))
    out = ws.store(rows.unionByName(nameless), "out")
    ws.drop("signatures", "classes", "rows", "near", "members", "sets", "star", "links-1", "components-1", "open", "cross", "links-2",
            "components-2", "texts", "several", "components-3")
    return out


def near_dedup(docs: DataFrame, width: int = 5, threshold: int = 80, **how) -> DataFrame:
    """``docs`` without the rows whose text is not the first of those it is linked with."""
    gone = (_text_classes(docs, width, threshold, **how).where("doc_id <> first").groupBy(F.col("doc_id").alias("_gone"))
            .agg(F.max("texts").alias("_texts"), F.collect_set("f1").alias("_f1")))
    met = docs.join(gone, docs["doc_id"] == gone["_gone"], "left")
    # only rows of ids that hold several texts are fingerprinted again
    mine = F.when(gone["_texts"] > 1, F.array_contains(gone["_f1"], F.xxhash64(F.sort_array(shingle_hashes(docs["text"], width))))).otherwise(True)
    return met.where(gone["_gone"].isNull() | ~mine).select(*[docs[c] for c in docs.columns])
