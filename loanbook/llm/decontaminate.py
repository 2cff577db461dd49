"""Benchmark decontamination: which words of a document stand in a window of words of a benchmark item.

The windows of all items, each distinct one once, are the phrases that are
looked for in the positional index of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import staged
from loanbook.llm.positional_index import build_index, search, words_of

WINDOW = 10
EMITTED = 20_000  # windows of an Arrow batch


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Rows item_id (string), phrase and words of every window of every item.

    A window is `window` consecutive words; an item of fewer words, but not
    none, is one window. `phrase` is its words joined by spaces.
    """
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found = [], []
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
                words = words_of(text.as_py() or b"")
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    ids.append(item), found.append(words[at : at + window])
                    if len(ids) == EMITTED:
                        yield _windows(ids, found)
                        ids, found = [], []
        yield _windows(ids, found)

    return rows.mapInArrow(cut, "item_id string, phrase binary, words array<binary>")


def _windows(ids: list, found: list[list[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.string()), pa.array([b" ".join(w) for w in found], pa.binary()), pa.array(found, pa.list_(pa.binary()))],
        names=["item_id", "phrase", "words"],
    )


def _covered(hits: Column) -> Column:
    """Number of words inside any of the hits, which are sorted by start."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    step = lambda done, hit: F.struct(
        (done["n"] + F.greatest(hit["end"] - F.greatest(hit["start"], done["reach"]), F.lit(0))).alias("n"),
        F.greatest(done["reach"], hit["end"]).alias("reach"),
    )
    return F.aggregate(hits, start, step, lambda done: done["n"]).cast("long")


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits and items.

    `n_hit` counts the words inside any occurrence of a window of any item,
    `items` are the ids, sorted as strings, of the items with occurring
    windows, `items_sha256` the digest of these joined by commas (of the empty
    string if there are none), and `hits` the occurrences as (start, end) in
    words. `slop` above 0 takes proximity matches as well, see `search`.

    Null texts have no words. Rows equal in id or text are documents of their
    own. Items of one id are one item; windows of items without an id count as
    hits but name no item. Empty tables give no rows, or documents without
    hits; other columns are not read.
    """
    index = build_index(docs, id_col, text_col)
    pairs = staged(item_windows(items, window, item_id_col, item_text_col), "windows")
    phrases = pairs.select("phrase", "words").dropDuplicates(["phrase"]).withColumn("phrase_no", F.monotonically_increasing_id())
    phrases = staged(phrases, "phrases")
    named = pairs.join(phrases.select("phrase", "phrase_no"), "phrase").select("phrase_no", "item_id").distinct()

    hits = search(index, phrases, slop).groupBy("block", "place").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("found"))
    hits = staged(hits.select(
        "block", "place", _covered(F.col("found")).alias("n_hit"), F.array_sort(F.array_distinct("found.phrase_no")).alias("phrase_nos"),
        F.transform("found", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"))).alias("hits"),
    ), "hits")
    sets = staged(named_sets(hits.select("phrase_nos").distinct(), named), "item-sets")
    known = hits.join(sets, "phrase_nos").drop("phrase_nos")
    n_hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return index.rows().join(staged(known, "contaminated"), ["block", "place"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "hits",
        listed.alias("items"),
    )


def named_sets(sets: DataFrame, named: DataFrame) -> DataFrame:
    """The sorted item ids of every distinct set of phrases, so that a passage common to many documents is resolved once."""
    numbered = staged(sets.withColumn("set_no", F.monotonically_increasing_id()), "phrase-sets")
    ids = numbered.select("set_no", F.explode("phrase_nos").alias("phrase_no")).join(named, "phrase_no").where("item_id is not null")
    ids = ids.groupBy("set_no").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return numbered.join(ids, "set_no", "left").select("phrase_nos", "items")
