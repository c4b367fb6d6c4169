"""Benchmark decontamination with DataFrame functions only.

The normalised n-grams of the benchmark are a set of known size, broadcast as
a hash table.  Every window of training words is probed against it; the join
compares the windows' words, so a hit is verified as it is found.  Hit spans or
whole documents are then removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import content_id, lower_ascii, or_empty

#: A word is a run of a-z, 0-9 and everything beyond ASCII (fixed pattern).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text that is not lower-cased yet.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Distinct benchmark windows broadcast at most (about 100 bytes each); a larger set is left to the planner.
BROADCAST_WINDOWS = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words; none for NULL."""
    return F.regexp_extract_all(lower_ascii(or_empty(text)), F.lit(WORD), F.lit(0))


def windows_of(words: Column, length: Column) -> Column:
    """Every run of ``length`` words, joined by a space; none in shorter texts."""
    return F.when(
        F.size(words) >= length,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - length + 1), lambda i: F.array_join(F.slice(words, i, length), " ")
        ),
    ).otherwise(F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, n: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """(window, len, items): one row per distinct window, with the sorted ids of the items that hold it.

    An item of fewer than ``n`` words is one window; one without words has none.
    """
    words = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    words = words.withColumn("len", F.least(F.lit(n), F.size("words"))).filter(F.col("len") > 0)
    windows = words.select("item", "len", F.explode(windows_of(F.col("words"), F.col("len"))).alias("window"))
    return windows.groupBy("window", "len").agg(F.sort_array(F.collect_set("item")).alias("items"))


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: the key, ``content``, ``n_words``, ``covered`` and ``items``.

    ``covered`` holds the word positions (from 0) inside any occurrence of a
    window, ``items`` the ids (as strings) of the items with such windows, both
    sorted.  NULL texts have no words; a NULL item id is no item, though its
    words are hit.  Repeated rows and keys give one row each; other columns are
    ignored; if either table is empty there are no hits.

    Documents are not shuffled: windows are probed where they are read, and one
    small row per document is grouped afterwards.
    """
    found = benchmark_windows(benchmark, n, item, item_text)
    # The lengths in use (n of them at most) and the size of the set to broadcast.
    sizes = {r["len"]: r["count"] for r in found.groupBy("len").count().collect()}
    if sum(sizes.values()) <= BROADCAST_WINDOWS:
        found = F.broadcast(found)
    rows = docs.select(
        F.col(key).alias("key"),
        content_id(F.col(text)).alias("content"),
        F.monotonically_increasing_id().alias("row"),
        words_of(F.col(text)).alias("words"),
    )
    # Counted below the Generate, so that no window carries the words of its whole text along.
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    lengths = sorted(sizes, reverse=True) or [n]
    probes = rows.select(
        "key",
        "content",
        "row",
        "n_words",
        F.posexplode_outer(F.concat(*[windows_of(F.col("words"), F.lit(m)) for m in lengths])).alias("at", "window"),
    )
    # Windows of one length follow those of another: where in the text the probe starts.
    start, before = F.lit(None).cast("long"), F.lit(0).cast("long")
    for m in lengths:
        start = F.when(F.col("len") == m, F.col("at") - before).otherwise(start)
        before = before + F.greatest(F.col("n_words") - m + 1, F.lit(0))
    hits = probes.join(found, "window", "left").withColumn("start", start)
    # The first row of each document stays, hit or not, so that every document comes out.
    hits = hits.filter(F.col("len").isNotNull() | F.coalesce(F.col("at") == 0, F.lit(True)))
    spans = F.when(F.col("len").isNotNull(), F.sequence(F.col("start"), F.col("start") + F.col("len") - 1))
    grouped = hits.select("row", "key", "content", "n_words", spans.alias("span"), "items").groupBy(
        "row", "key", "content", "n_words"
    )
    return grouped.agg(F.collect_list("span").alias("spans"), F.collect_list("items").alias("items")).select(
        F.col("key").alias(key),
        "content",
        "n_words",
        F.sort_array(F.array_distinct(F.flatten("spans"))).alias("covered"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
    )


def drop_contaminated(docs: DataFrame, hits: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all their columns stay."""
    dirty = hits.filter(F.size("covered") > 0).select(F.col(key).alias("__key"), F.col("content").alias("__content"))
    same = docs[key].eqNullSafe(dirty["__key"]) & (content_id(docs[text]) == dirty["__content"])
    return docs.join(dirty.distinct(), same, "left_anti")


def cut_spans(docs: DataFrame, hits: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the covered words taken out of the text; clean texts stay as they are.

    What stands between two words goes with the word before it.
    """
    dirty = hits.filter(F.size("covered") > 0).select(
        F.col(key).alias("__key"), F.col("content").alias("__content"), F.col("covered").alias("__covered")
    )
    dirty = dirty.dropDuplicates(["__key", "__content"])
    same = docs[key].eqNullSafe(dirty["__key"]) & (content_id(docs[text]) == dirty["__content"])
    words = F.regexp_extract_all(F.col(text), F.lit(ANY_CASE_WORD), F.lit(0))
    gaps = F.split(F.col(text), ANY_CASE_WORD, -1)
    parts = F.arrays_zip(
        F.sequence(F.lit(0), F.size(gaps) - 1).alias("i"), gaps.alias("gap"), words.alias("word")
    )

    def covered(position: Column) -> Column:
        return F.array_contains("__covered", position.cast("long"))

    kept = F.transform(
        parts,
        lambda x: F.concat(
            F.when(covered(x["i"] - 1), F.lit("")).otherwise(x["gap"]),
            F.when(covered(x["i"]), F.lit("")).otherwise(F.coalesce(x["word"], F.lit(""))),
        ),
    )
    joined = docs.join(dirty, same, "left")
    joined = joined.withColumn(
        "__cut", F.when(F.col("__covered").isNull(), F.col(text)).otherwise(F.array_join(kept, ""))
    )
    return joined.select(*[F.col("__cut").alias(c) if c == text else docs[c] for c in docs.columns])
