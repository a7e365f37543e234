"""Benchmark passages in training documents by a positional inverted index.

DataFrame and SQL functions only. The index is sharded by document: each task
writes its documents' postings (term, row, position), ordered by term, so that
one term's postings are a short run of every file. Test windows are looked up
from their rarest term; the lists of the next terms, moved by their offsets
in the window, are intersected with what is left.

A term is the XXH64 of its word (64 bits).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mallscope.llm.common import scratch, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(column: str) -> Column:
    """Words of a text after lower-casing A-Z; null has none."""
    lower = F.translate(F.coalesce(F.col(column).cast("string"), F.lit("")),
                        string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, SEPARATORS), lambda w: w != "")


def build_index(docs: DataFrame, path: str) -> None:
    """Write the postings of every word of every row of ``docs``.

    Columns: ``term``, ``row`` (a number for each row of ``docs``), ``pos``
    (words from 0). Each row also has one head posting, pos -1, that carries
    ``doc_id``, ``text_hash`` (XXH64 of the text) and ``n_words``; elsewhere
    these are null. Only doc_id and text are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("d"), "text").select(
        F.monotonically_increasing_id().alias("row"), "d", F.xxhash64(text).alias("h"),
        F.concat(F.array(F.lit("")), words("text")).alias("w"))
    head = F.col("at") == 0
    (rows.select("row", "d", "h", F.size("w").alias("n"), F.posexplode("w").alias("at", "word"))
     .select(F.xxhash64("word").alias("term"), "row", (F.col("at") - 1).alias("pos"),
             F.when(head, F.col("d")).alias("doc_id"), F.when(head, F.col("h")).alias("text_hash"),
             F.when(head, (F.col("n") - 1).cast("bigint")).alias("n_words"))
     .sortWithinPartitions("term")
     .write.option("compression", "zstd").option("parquet.block.size", str(16 << 20)).parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("term bigint, row bigint, pos int, doc_id bigint, text_hash bigint, "
                             "n_words bigint").parquet(path)


def test_windows(items: DataFrame, window: int = 10) -> DataFrame:
    """item_id, window_id and ``terms``: every ``window`` words in a row of an
    item; a shorter item that has words is one window."""
    w = items.select(F.col("item_id"), words("text").alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return (w.distinct().select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.transform(F.slice("w", F.col("s") + 1, F.lit(window)),
                                           lambda x: F.xxhash64(x)).alias("terms"))
            .groupBy("terms").agg(F.collect_set("item_id").alias("items"))
            .select(F.xxhash64("terms").alias("window_id"), "terms", "items"))


def search(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """window_id, row, start, length and ``exact``: where windows occur.

    With ``slop`` 0 these are exact phrases. Otherwise a window also counts
    where its rarest term stands and each further one is at most ``slop``
    words off its place (proximity matches; ``exact`` is then false).
    """
    spark = index.sparkSession
    postings = index.filter("pos >= 0").select("term", "row", "pos")
    # document-independent term counts, of the test terms only; the table is
    # written so that its size is known and Spark broadcasts it only if small
    terms = written(windows.select(F.explode("terms").alias("term")).distinct(), "test-terms")
    counts = written(postings.select("term").join(terms, "term").groupBy("term").count(), "term-counts")
    places = windows.select("window_id", F.size("terms").alias("length"),
                            F.posexplode("terms").alias("offset", "term"))
    # (count, offset, term) of each window from the rarest on; a window with a
    # term that no document holds can't occur
    ranked = (places.join(counts, "term").groupBy("window_id", "length")
              .agg(F.array_sort(F.collect_list(F.struct("count", "offset", "term"))).alias("by_rarity"))
              .filter(F.size("by_rarity") == F.col("length")))
    ranked = written(ranked, "ranked-windows")
    first = ranked.select("window_id", "length", F.col("by_rarity")[0]["term"].alias("term"),
                          F.col("by_rarity")[0]["offset"].alias("offset"),
                          F.try_element_at("by_rarity", F.lit(2))["term"].alias("term2"),
                          F.try_element_at("by_rarity", F.lit(2))["offset"].alias("offset2"))
    first = written(first, "rarest")
    needed = written(first.select("term").union(first.select("term2")).filter("term is not null").distinct(),
                     "needed-terms")
    short = written(postings.join(needed, "term"), "rare-postings")
    found = (short.join(first, "term")
             .select("window_id", "length", "row", (F.col("pos") - F.col("offset")).alias("start"),
                     "term2", "offset2")
             .filter(F.col("start") >= -slop if slop else F.col("start") >= 0))
    moved = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    pairs = (found.filter("term2 is not null")
             .select("window_id", "length", "row", "start", F.col("term2").alias("term"),
                     (F.col("start") + F.col("offset2")).alias("place"))
             .select("*", moved.alias("moved"))
             .withColumn("pos", F.col("place") + F.col("moved"))
             .join(short, ["row", "term", "pos"], "left_semi")
             .select("window_id", "length", "row", "start").distinct())
    left = written(pairs.union(found.filter("term2 is null").select("window_id", "length", "row", "start")), "aligned")
    # the remaining lists, read only for rows that are still in question
    rows = written(left.select("row").distinct(), "aligned-rows")
    rest = postings.join(rows, "row", "left_semi").join(terms, "term", "left_semi")
    wanted = (left.join(ranked.select("window_id", F.explode(F.slice("by_rarity", 3, 1 << 20)).alias("t")), "window_id")
              .select("window_id", "row", "start", F.col("t.term").alias("term"),
                      (F.col("start") + F.col("t.offset")).alias("place"))
              .select("*", moved.alias("moved"))
              .withColumn("pos", F.col("place") + F.col("moved")))
    met = (wanted.join(rest, ["row", "term", "pos"], "left_semi")
           .groupBy("window_id", "row", "start").agg(
               F.countDistinct("place").alias("met"),
               F.sum((F.col("moved") == 0).cast("int")).alias("in_place")))
    checked = left.join(met, ["window_id", "row", "start"], "left").filter(
        F.coalesce("met", F.lit(0)) == F.greatest(F.col("length") - 2, F.lit(0)))
    if not slop:
        return checked.select("window_id", "row", "start", "length", F.lit(True).alias("exact"))
    second = first.select("window_id", "term2", "offset2")
    checked = checked.join(second, "window_id").withColumn("pos", F.col("start") + F.col("offset2"))
    at_place = short.select("row", F.col("term").alias("term2"), "pos", F.lit(True).alias("second_in_place"))
    checked = checked.join(at_place, ["row", "term2", "pos"], "left")
    exact = (F.coalesce("in_place", F.lit(0)) == F.greatest(F.col("length") - 2, F.lit(0))) & (
        F.col("term2").isNull() | F.coalesce("second_in_place", F.lit(False))) & (F.col("start") >= 0)
    return checked.select("window_id", "row", "start", "length", exact.alias("exact"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per row of ``docs``: how far test items occur in it.

    ``n_words``; ``n_hit``, the words inside any occurrence of a window;
    ``n_items`` and ``items_sha256`` (item ids sorted as strings,
    comma-joined) of the items with occurring windows; ``contaminated``.
    Null and empty texts have no words; items without words are passed over.
    A null item id is no id to be listed, but its item's words are hit like
    any other's; repeated rows each get the result; an empty table on
    either side gives no rows or no hits. Columns beside doc_id, text and
    item_id aren't read. ``text_hash`` tells rows of one doc_id apart.
    """
    spark = docs.sparkSession
    path = scratch(spark, "positional-index")
    build_index(docs, path)
    index = read_index(spark, path)
    windows = written(test_windows(items.select("item_id", "text"), window), "windows")
    hits = written(search(index, windows), "window-hits")
    spots = (hits.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos"))
             .distinct().groupBy("row").agg(F.count("*").alias("n_hit")))
    # at most one row per item and document reaches the list
    named = (hits.select("row", "window_id").distinct()
             .join(windows.select("window_id", F.explode("items").alias("item_id")), "window_id")
             .select("row", F.col("item_id").cast("string").alias("item_id")).distinct()
             .groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("ids")))
    heads = index.filter("pos = -1").select("row", "doc_id", "text_hash", "n_words")
    joined = heads.join(spots, "row", "left").join(named, "row", "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"), "text_hash")
