"""Operator 8: line deduplication by a deletion-neighbourhood join (DataFrame functions only).

A line is its text without white space at both ends; its words are what single blanks
separate. Lines are ordered by (doc_id, text hash, line number). A line is dropped if an earlier line of the
whole table is equal, or, for lines of at least ``min_words`` words, lies within
one word edit (one word inserted, removed or replaced). Lines without a word always stay.

Method. Equal lines are grouped by a 128-bit hash, pre-aggregated per task,
so the rest works on distinct lines. Each distinct line emits hashed keys: the full line
and the line with one word deleted. Lines within one edit share a key: the full key of the
shorter, or the same deletion at the same place. Per key only the earliest line is needed
(every member is within one edit of it), so a key's group is aggregated, never paired, and
a hot key costs one row per task. The earliest witness of each line is then verified on the
words themselves.

To keep the neighbourhood small, a lossless test goes first: two lines within one edit share
the first or the last half, so only lines whose half occurs in another distinct line emit
variants.

Defined results: null and empty texts stay as they are; repeated rows (same doc_id and text)
are one document to the decisions and all of them are returned; several texts under one
doc_id and null ids are separate documents (null ids come first); an empty table gives an
empty result; other columns pass through, columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import SPACES, Workspace

MIN_WORDS = 10
KEY = ["k1", "k2", "n"]


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of the first and last m words for m = n // 2 and (n - 1) // 2; any two lines
    whose lengths differ by at most one word have one m in common."""
    def key(side: str, m: Column, count: Column) -> Column:
        return F.xxhash64(F.lit(side), m, F.call_function("substring_index", line, F.lit(" "), count))
    a, b = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    return F.array_distinct(F.array(key("first", a, a), key("first", b, b), key("last", a, -a), key("last", b, -b)))


def _without(words: Column, i: Column) -> Column:
    return F.concat(F.slice(words, F.lit(1), i), F.slice(words, i + 2, F.greatest(F.size(words) - i - 1, F.lit(0))))


def document_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_th", F.xxhash64("text"))


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line with a word: its place, 128-bit identity, length and half keys."""
    lines = (docs.select("doc_id", "_th", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
             .select("doc_id", "_th", "line_no", F.btrim("raw", F.lit(SPACES)).alias("line")).where("line <> ''"))
    n = (F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1)
    return (lines.withColumn("n", n).select(
        F.struct("doc_id", "_th", "line_no").alias("place"),
        F.xxhash64("line").alias("k1"), F.xxhash64(F.lit("second"), F.col("line")).alias("k2"), "n",
        F.when(F.col("n") >= min_words, _half_keys(F.col("line"), F.col("n"))).alias("halves")))


def candidate_lines(distinct_lines: DataFrame) -> DataFrame:
    """Distinct lines of which a half occurs in another distinct line.

    Only (half, k1) is shuffled; two lines of equal k1 would merely both become candidates."""
    halves = distinct_lines.where("halves IS NOT NULL").select("k1", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    found = halves.join(shared, "half").select("k1").distinct()
    return distinct_lines.where("halves IS NOT NULL").select(*KEY, "first").join(found, "k1", "left_semi")


def with_words(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``lines`` (key columns and the place ``first``) with the words of that place."""
    wanted = lines.groupBy(F.col("first.doc_id").alias("d"), F.col("first._th").alias("t")).agg(
        F.collect_list(F.struct(F.col("first.line_no").alias("line_no"), *KEY)).alias("wanted"))
    texts = docs.select("doc_id", "_th", "text")
    met = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["d"]) & (texts["_th"] == wanted["t"]))
    split = met.select("doc_id", "_th", F.split("text", "\n").alias("lines"), "wanted")
    one = split.select("doc_id", "_th", "lines", F.explode("wanted").alias("x"))
    return one.select(
        *[F.col(f"x.{k}").alias(k) for k in KEY],
        F.struct("doc_id", "_th", F.col("x.line_no").alias("line_no")).alias("first"),
        F.split(F.btrim(F.get("lines", F.col("x.line_no")), F.lit(SPACES)), " ").alias("words")).dropDuplicates(KEY)  # of repeated rows


def variants(lines: DataFrame) -> DataFrame:
    """The full line (cut = -1) and every line with one word deleted, as hashed keys.

    A deletion's key holds the place of the deleted word for partners of equal length, and
    both kinds hold the remaining words' hash for partners of one word less.
    """
    h = lines.withColumn("h", _hashes(F.col("words")))
    cuts = h.select(*KEY, "first", "h", F.explode(F.sequence(F.lit(-1), F.col("n") - 1)).alias("cut"))
    rest = F.when(F.col("cut") < 0, F.col("h")).otherwise(_without(F.col("h"), F.greatest(F.col("cut"), F.lit(0))))
    return cuts.select(*KEY, "first", "cut", F.xxhash64(F.lit("variant"), rest).alias("vkey"))


def witnesses(found: DataFrame) -> DataFrame:
    """For each line the earliest line that shares a key with it within one edit."""
    same = found.where("cut >= 0").groupBy("vkey", "cut", "n").agg(F.min("first").alias("w"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    full = found.where("cut < 0").groupBy("vkey", F.col("n").alias("m")).agg(F.min("first").alias("w"))
    longer = found.where("cut >= 0").groupBy("vkey", (F.col("n") - 1).alias("m")).agg(F.min("first").alias("w"))
    cut = found.where("cut >= 0")
    met = (cut.join(same, ["vkey", "cut", "n"])  # replaced word
           .select(*KEY, "first", "w")
           .unionByName(cut.withColumn("m", F.col("n") - 1).join(full, ["vkey", "m"]).select(*KEY, "first", "w"))
           .unionByName(found.where("cut < 0").withColumn("m", F.col("n")).join(longer, ["vkey", "m"]).select(*KEY, "first", "w")))
    return met.where("w < first").groupBy(*KEY, "first").agg(F.min("w").alias("w"))


def within_one_edit(a: Column, b: Column) -> Column:
    """Word edit distance of two different lines is at most 1, on the words themselves."""
    differs = F.filter(F.transform(a, lambda x, i: F.when(x == F.get(b, i), F.lit(None)).otherwise(i)), lambda i: i.isNotNull())
    p = F.least(F.coalesce(F.array_min(differs), F.size(a)), F.size(b))  # words of the common start
    longer, shorter = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    rest = F.greatest(F.size(longer) - p - 1, F.lit(0))
    start = F.when(F.size(a) == F.size(b), p + 2).otherwise(p + 1)
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (F.slice(longer, p + 2, rest) == F.slice(shorter, start, rest))


def near_duplicates(docs: DataFrame, distinct_lines: DataFrame, ws: Workspace) -> DataFrame:
    """Keys of distinct lines with an earlier distinct line within one word edit."""
    lines = ws.store(with_words(docs, candidate_lines(distinct_lines)), "candidates")
    near = witnesses(variants(lines))
    mine = lines.select(*KEY, F.col("words").alias("a"))
    theirs = lines.select(F.col("first").alias("w"), F.col("words").alias("b"))
    checked = near.join(mine, KEY).join(theirs, "w").where(within_one_edit(F.col("a"), F.col("b")))
    return checked.select(*KEY).distinct()


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` reduced to the lines kept, n_lines and n_dropped (both lines).

    ``min_words``: lines with fewer words are compared by equality only.
    """
    ws = Workspace(docs.sparkSession, "line-dedup")
    docs = document_key(docs)
    lines = ws.store(line_table(docs, min_words), "lines")
    distinct_lines = ws.store(
        lines.groupBy(*KEY).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("c"),
                                F.first("halves").alias("halves")), "distinct")
    near = near_duplicates(docs, distinct_lines, ws).withColumn("near", F.lit(True))
    # written, so that the join below has plain exchanges on both sides and a hot line is split (skew join)
    bad = ws.store(distinct_lines.select(*KEY, "first", "c").join(near, KEY, "left")
                   .where("c > 1 OR near").select(*KEY, "first", F.coalesce("near", F.lit(False)).alias("near")), "bad")
    dropped = (lines.select("place", *KEY).join(bad, KEY).where("near OR place <> first")
               .select(F.col("place.doc_id").alias("_d"), F.col("place._th").alias("_t"), F.col("place.line_no").alias("no"))
               .groupBy("_d", "_t").agg(F.collect_set("no").alias("_drops")))
    dropped = ws.store(dropped, "dropped")
    ws.drop("lines", "distinct", "candidates", "bad")  # before the texts are shuffled once more
    met = docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["_d"]) & (docs["_th"] == dropped["_t"]), "left").drop("_d", "_t", "_th")
    split = met.withColumn("_lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drops"))
    text = F.when(F.col("_drops").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n"))
    return split.withColumns({
        "n_lines": F.coalesce(F.size("_lines"), F.lit(0)),
        "n_dropped": F.coalesce(F.size("_drops"), F.lit(0)),
        "text": text,
    }).drop("_lines", "_drops")
