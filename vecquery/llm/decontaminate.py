"""Benchmark decontamination over a distributed positional inverted index; DataFrame operations only.

``build_index`` stores the postings of the training texts: one row (token, document, position) for every occurrence
of a token that the test items use. ``find_windows`` looks up windows of ``WINDOW`` consecutive item words: the two
rarest terms of a window are read first and their lists, each shifted by the term's offset in the window, are
intersected; only what is left is held against the lists of the remaining terms. ``find_near`` uses the same lists for
proximity: all distinct terms of a window inside a span of bounded length, in any order.

A document row is known by its id and a hash of its text, so rows that share an id are judged one by one.

Defined results: a null or empty text has no words, no hits and ``contaminated`` false; an item without words has
no window; an item without an id counts for hits but is not named; repeated items and windows count once per ``item_id``; repeated document rows each get their result.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vecquery.sources.tables import write_stage

WINDOW = 10
#: Candidate documents are broadcast up to so many rows of two 8-byte numbers; beyond, the join shuffles.
SENT_DOCUMENTS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: All of ASCII but digits and letters stands between words.
_BETWEEN = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def words(text: Column) -> Column:
    """Words of the text with A-Z in lower case: what lies between becomes spaces, at which a plain split cuts."""
    return F.array_remove(F.split(F.translate(text, _BETWEEN + _UPPER, " " * len(_BETWEEN) + _LOWER), " "), "")


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, item_key, start, len, q, token``: every window, one row per word of it."""
    parts = (
        items.select("item_id", F.xxhash64("text").alias("item_key"), words(F.col("text")).alias("w"))
        .filter(F.size("w") > 0)
        .dropDuplicates(["item_id", "item_key"])
        .withColumn("len", F.least(F.lit(size), F.size("w")))
    )
    cut = parts.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("len"))))
    return cut.select(
        "item_id", "item_key", "start", "len", F.posexplode(F.slice("w", F.col("start") + 1, F.col("len"))).alias("q", "token")
    )


def read_documents(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``token, doc_id, doc_key, pos, n_words``, stored: all that is needed of the texts, from one pass over them.

    Rows with a ``token`` are the postings of the tokens in ``vocabulary(token)``; rows with ``n_words`` are one per document row.
    """
    cut = words(F.col("text"))
    read = documents.select(
        "doc_id", F.xxhash64("text").alias("doc_key"), F.coalesce(F.size(cut), F.lit(0)).cast("bigint").alias("n"), cut.alias("w")
    )
    tokens = read.select("doc_id", "doc_key", F.greatest("n", F.lit(0)).alias("n"), F.posexplode_outer("w").alias("pos", "token"))
    known = vocabulary.select("token").distinct().withColumn("known", F.lit(True))
    kept = tokens.withColumn("n_words", F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("n"))).join(known, "token", "left")
    return write_stage(
        kept.filter("known OR n_words IS NOT NULL").select(F.when(F.col("known"), F.col("token")).alias("token"), "doc_id", "doc_key", "pos", "n_words"),
        "postings",
    )


def postings(read: DataFrame) -> DataFrame:
    return read.filter("token IS NOT NULL").select("token", "doc_id", "doc_key", "pos")


def build_index(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``token, doc_id, doc_key, pos``, stored: postings of all tokens in ``vocabulary(token)``."""
    return postings(read_documents(documents, vocabulary))


def _same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.doc_key") == F.col(f"{b}.doc_key"))


def _ordered_windows(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, with their terms from the rarest on."""
    counts = index.groupBy("token").agg(F.count("*").alias("n"))
    return (
        windows.join(counts, "token", "left")
        .groupBy("item_id", "item_key", "start", "len")
        .agg(
            F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "q", "token"))).alias("terms")
        )
        .filter(F.col("terms")[0]["n"] > 0)
    )


def find_windows(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, doc_key, item_id, pos, len``: where windows occur word for word in documents."""
    ordered = write_stage(_ordered_windows(index, windows), "windows")
    first = ordered.select("item_id", "len", "terms", F.col("terms")[0]["token"].alias("token"))
    # the rarest term's list, shifted to where the window would begin
    begun = index.join(first, "token").withColumn("at", F.col("pos") - F.col("terms")[0]["q"]).filter("at >= 0")
    begun = begun.select("doc_id", "doc_key", "item_id", "at", "len", F.slice("terms", 2, F.greatest("len", F.lit(1))).alias("rest"))
    # the second rarest term's list, shifted likewise
    rare = ordered.filter("len > 1").select(F.col("terms")[1]["token"].alias("token")).distinct()
    second = index.join(rare, "token", "left_semi").alias("i")
    both = begun.filter("len > 1").alias("b").join(
        second,
        _same_document("b", "i")
        & (F.col("b.rest")[0]["token"] == F.col("i.token"))
        & (F.col("b.at") + F.col("b.rest")[0]["q"] == F.col("i.pos")),
    ).select("b.doc_id", "b.doc_key", "b.item_id", "b.at", "b.len", F.slice("b.rest", 2, F.greatest("b.len", F.lit(1))).alias("rest"))
    left = write_stage(
        both.unionByName(begun.filter("len = 1")).distinct(), "candidates"
    )
    return _all_terms(index, left).select("doc_id", "doc_key", "item_id", F.col("at").alias("pos"), "len")


def _all_terms(index: DataFrame, left: DataFrame) -> DataFrame:
    """Candidates all of whose remaining terms stand where they should."""
    done = left.filter(F.size("rest") == 0)
    open_ = left.filter(F.size("rest") > 0)
    documents = open_.select("doc_id", "doc_key").distinct()
    small = documents.limit(SENT_DOCUMENTS + 1).count() <= SENT_DOCUMENTS
    documents = (F.broadcast(documents) if small else documents).alias("d")
    near = index.alias("i").join(documents, _same_document("i", "d"), "left_semi").distinct().alias("i")
    wanted = open_.select("*", F.explode("rest").alias("t")).alias("c")
    met = wanted.join(
        near,
        _same_document("c", "i")
        & (F.col("c.at") + F.col("c.t.q") == F.col("i.pos"))
        & (F.col("c.t.token") == F.col("i.token")),
    ).select("c.*")
    keys = ["doc_id", "doc_key", "item_id", "at", "len", "rest"]
    whole = met.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") == F.size("rest"))
    return whole.select(*keys).unionByName(done.select(*keys))


def find_near(index: DataFrame, windows: DataFrame, span: int = 2 * WINDOW) -> DataFrame:
    """``doc_id, doc_key, item_id, start, pos``: the window's distinct terms all occur within ``span`` words from ``pos`` on.

    The lists are read around the rarest term. A match begins at an occurrence of one of the terms.
    """
    ordered = _ordered_windows(index, windows)
    terms = ordered.withColumn("need", F.array_distinct(F.transform("terms", lambda t: t["token"]))).withColumn(
        "token", F.col("need")[0]
    )
    rare = index.join(terms.select("item_id", "item_key", "start", "need", "token"), "token")
    rare = rare.withColumnRenamed("pos", "mid").drop("token").alias("r")
    near = rare.join(
        index.distinct().alias("i"),
        _same_document("r", "i")
        & F.array_contains("r.need", F.col("i.token"))
        & (F.abs(F.col("i.pos") - F.col("r.mid")) < span),
    ).select("r.*", "i.pos", "i.token")
    group = ["doc_id", "doc_key", "item_id", "item_key", "start", "mid", "need"]
    ahead = W.partitionBy(*group).orderBy("pos").rangeBetween(0, span - 1)
    return (
        near.distinct()
        .withColumn("found", F.size(F.collect_set("token").over(ahead)))
        .filter((F.col("found") == F.size("need")) & (F.col("pos") <= F.col("mid")) & (F.col("mid") < F.col("pos") + span))
        .select("doc_id", "doc_key", "item_id", "start", "pos")
        .distinct()
    )


def hits(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, doc_key, n_hit, item_ids`` for the documents with occurrences of item windows.

    ``n_hit`` is the length of the union of all occurrences; ``item_ids`` are sorted as strings.
    """
    found = write_stage(find_windows(index, windows), "occurrences")
    key = ["doc_id", "doc_key"]
    # occurrences in one document: merged from left to right, which is the work of one row of documents
    order = W.partitionBy(*key).orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("pos") + F.col("len")
    covered = (
        found.groupBy(*key, "pos").agg(F.max("len").alias("len"))
        .withColumn("upto", F.coalesce(F.max(end).over(order), F.lit(0)))
        .groupBy(*key)
        .agg(F.sum(F.greatest(F.lit(0), end - F.greatest("pos", "upto"))).alias("n_hit"))
    )
    named = (
        found.select(*key, F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    )
    return covered.alias("h").join(named.alias("n"), _same_document("h", "n")).select("h.*", "n.item_ids")


def contamination(documents: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, doc_key, n_words, n_hit, item_ids, contaminated`` for every document row."""
    windows = item_windows(items, size)
    read = read_documents(documents, windows)
    rows = read.filter("n_words IS NOT NULL").select("doc_id", "doc_key", "n_words").alias("d")
    return rows.join(hits(postings(read), windows).alias("h"), _same_document("d", "h"), "left").select(
        "d.doc_id", "d.doc_key", "d.n_words",
        F.coalesce("h.n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("h.item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("h.n_hit").isNotNull().alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no window of an item occurs."""
    windows = item_windows(items, size)
    found = write_stage(hits(build_index(documents, windows), windows).select("doc_id", "doc_key"), "contaminated")
    small = found.limit(SENT_DOCUMENTS + 1).count() <= SENT_DOCUMENTS
    rows = documents.select(F.struct("*").alias("row"), F.xxhash64("text").alias("doc_key")).alias("d")
    found = (F.broadcast(found) if small else found).alias("h")
    same = F.col("d.row.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.doc_key") == F.col("h.doc_key"))
    return rows.join(found, same, "left_anti").select("d.row.*")
