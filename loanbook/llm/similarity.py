"""Jaccard similarity join of documents on word n-grams, by MinHash banding.

1. Every text becomes the set of its hashed word n-grams; texts with equal sets
   are one class, whatever their number.
2. The MinHash values of a class are cut into bands. The number of bands and of
   rows per band are the ones with most rows, hence fewest false candidates,
   that reach the wanted recall at the threshold with at most MOST_HASHES.
   Classes are shuffled on the hash of each band; classes that share one, a
   bucket, are candidates. Bands with the same bucket count once.
3. Candidate pairs are verified on their full sets, bucket by bucket, and a pair
   of several buckets in its first one only. Where the buckets of connected
   candidates overlap so much that they hold more pairs than these candidates
   have altogether, the candidates are compared as one bucket. So long chains of
   buckets cost what their buckets cost, and a thick crowd of near copies no
   more than its pairs. A bucket is cut into blocks of bounded size and pairs of
   blocks are compared, each in a task of its own; a task counts links and
   returns one row per class, so the number of rows does not grow with the
   square of a bucket.
4. Connected components over the links give the near-duplicate groups.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanbook.llm.common import runs_by_size, staged
from loanbook.llm.components import connected_components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.995
MOST_HASHES = 256
BLOCK_CLASSES = 512
BLOCK_GRAMS = 200_000
CHUNK_GRAMS = 1 << 17  # n-grams whose MinHash values are computed at a time
CHUNK_COLUMNS = 4096
BATCH_ROWS = 2000
NAMES = ("doc_id", "text", "row")
SEED = 20_240_601
WORD = re.compile(r"\w+")
GRAM_MIX = np.uint64(0x9E3779B97F4A7C15)
OUT_MIX = np.uint64(0xD6E8FEB86659FD93)


def choose_bands(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """Bands and rows per band: the most rows for which pairs at the threshold share a band with the wanted chance."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("the recall needs more hashes than allowed")
    return best


def gram_set(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of lower-cased words.

    A text of fewer words has one n-gram of all of them; without words none.
    """
    words = np.array([xxhash.xxh3_64_intdigest(w) for w in WORD.findall(text.lower())], dtype=np.uint64)
    if not len(words):
        return words
    if len(words) < n:
        words = np.concatenate((words, np.zeros(n - len(words), np.uint64)))
    count = len(words) - n + 1
    grams = words[:count].copy()
    for k in range(1, n):
        grams = grams * GRAM_MIX + words[k : k + count]
    return np.unique((grams ^ (grams >> np.uint64(31))) * OUT_MIX)


def hash_parameters(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return random.integers(0, 1 << 32, hashes, np.uint32) | np.uint32(1), random.integers(0, 1 << 32, hashes, np.uint32)


def minhashes(sets: list[np.ndarray], factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """MinHash values of non-empty sets, one row per set."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), len(factors)), np.uint32)
    for k, (factor, shift) in enumerate(zip(factors, shifts, strict=True)):
        out[:, k] = np.minimum.reduceat(values * factor + shift, starts)
    return out


def band_hashes(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band, different for equal values in different bands."""
    cut = values.reshape(len(values), bands, rows).astype(np.uint64)
    mixed = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * OUT_MIX, cut.shape[:2]).copy()
    for k in range(rows):
        mixed = (mixed ^ cut[:, :, k]) * GRAM_MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _signatures(source: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """Rows (doc_id, text, row) with the digest and size of their n-gram set and their band hashes, written once and numbered."""
    factors, shifts = hash_parameters(bands * rows)

    def signatures(texts: list[str]) -> list[pa.Array]:
        sets = [gram_set(text, n) for text in texts]
        digests = [
            xxhash.xxh3_128_digest(grams.tobytes() if len(grams) else b"\x00" + text.encode("utf-8", "surrogatepass"))
            for text, grams in zip(texts, sets, strict=True)
        ]
        filled = [g for g in sets if len(g)]
        hashed = [
            band_hashes(minhashes(filled[start:end], factors, shifts), bands, rows)
            for start, end in runs_by_size([len(g) for g in filled], CHUNK_GRAMS)
        ]
        flat = np.concatenate(hashed).ravel() if hashed else np.zeros(0, np.int64)
        offsets = np.cumsum([0] + [bands * (len(g) > 0) for g in sets]).astype(np.int32)
        sizes = pa.array([len(g) for g in sets], pa.int64())
        return [pa.array(digests, pa.binary()), sizes, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                found = signatures([text or "" for text in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*NAMES, "digest", "n_grams", "bands"])

    added = StructType.fromDDL("digest binary, n_grams long, bands array<long>")
    signed = source.mapInArrow(run, StructType([*source.schema.fields, *added.fields]))
    return staged(signed.withColumn("row_no", F.monotonically_increasing_id()), "signatures")


def count_links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which sets are at least `threshold` alike: left against right, or left against itself without the diagonal."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1  # a gram of one set only adds to no intersection
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rows = slice(0, len(left))
    cols = rows if right is None else slice(len(left), len(sets))
    common = np.zeros((len(left), len(left) if right is None else len(right)), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, width, CHUNK_COLUMNS):
        a, b = np.searchsorted(column, (first, first + CHUNK_COLUMNS))
        table = np.zeros((len(sets), min(CHUNK_COLUMNS, width - first)), np.float32)
        table[owner[a:b], column[a:b] - first] = 1
        common += table[rows] @ table[cols].T
    alike = common + 1e-6 >= threshold * (sizes[rows][:, None] + sizes[cols][None, :] - common)
    if right is None:
        np.fill_diagonal(alike, False)
    return alike


def _smallest_reached(links: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Smallest label in the component of each row of a square, symmetric link matrix."""
    labels = labels.copy()
    while True:
        near = np.where(links, labels[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(labels, near)
        if np.array_equal(new, labels):
            return labels
        labels = new


def met_before(left: list, right: list, unit: int) -> np.ndarray:
    """Which pairs share a bucket with a number below `unit`; each class has the sorted numbers of its buckets, or None."""
    earlier = [np.zeros(0, np.int64) if x is None else np.asarray(x, np.int64) for x in [*left, *right]]
    earlier = [x[x < unit] for x in earlier]
    numbers, place = np.unique(np.concatenate(earlier), return_inverse=True)
    table = np.zeros((len(earlier), len(numbers)), np.float32)
    table[np.repeat(np.arange(len(earlier)), [len(x) for x in earlier]), place] = 1
    return table[: len(left)] @ table[len(left) :].T > 0


def compare_blocks(part: pd.DataFrame, lo: int, hi: int, threshold: float, unit: int = 0) -> pd.DataFrame:
    """Verify the pairs of two blocks (or of one) of a bucket that no earlier bucket has: links, linked rows and local root per class."""
    a, b = part[part["block"] == lo], part[part["block"] == hi]
    here, there = list(a["buckets"]), list(b["buckets"])
    decode = lambda column: [np.frombuffer(x, dtype=np.uint64) for x in column]
    ids, copies = a["cid"].to_numpy(np.int64), a["copies"].to_numpy(np.float64)
    if lo == hi:
        links = count_links(decode(a["grams"]), None, threshold) & ~met_before(here, here, unit)
        n_links, n_rows = links.sum(axis=1), links @ copies
    else:
        if a.empty or b.empty:
            return pd.DataFrame({"cid": [], "n_links": [], "n_linked_rows": [], "root": []}, dtype=np.int64)
        cross = count_links(decode(a["grams"]), decode(b["grams"]), threshold) & ~met_before(here, there, unit)
        other = b["copies"].to_numpy(np.float64)
        n_links = np.concatenate((cross.sum(axis=1), cross.sum(axis=0)))
        n_rows = np.concatenate((cross @ other, cross.T @ copies))
        ids = np.concatenate((ids, b["cid"].to_numpy(np.int64)))
        links = np.zeros((len(ids), len(ids)), bool)
        links[: len(a), len(a) :], links[len(a) :, : len(a)] = cross, cross.T
    linked = n_links > 0
    root = _smallest_reached(links, ids)
    return pd.DataFrame({
        "cid": ids[linked], "n_links": n_links[linked].astype(np.int64),
        "n_linked_rows": np.rint(n_rows[linked]).astype(np.int64), "root": root[linked],
    })


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, threshold: float = THRESHOLD,
    recall: float = RECALL, most_hashes: int = MOST_HASHES, carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: doc_id, class_id, set_id, n_copies, n_links, n_linked_docs, kept, and struct `row` of `carry`.

    Rows of equal n-gram sets form a set: `set_id` is its smallest id,
    `n_copies` its number of rows. `n_links` counts the other sets that are at
    least `threshold` alike, `n_linked_docs` the rows of these. `class_id` is
    the smallest id of the connected near-duplicate group, and `kept` marks one
    row of each: of those with that id, the first written. Null counts as empty; texts without a
    word are alike only if equal. Rows equal in id and text are copies. Null ids
    rank last, so a group's id is null only if all are. An empty table gives an
    empty result; other columns are read only when listed in `carry`.
    """
    bands, rows = choose_bands(threshold, recall, most_hashes)
    others = [F.col(c) for c in carry or [] if c != text_col] or [F.lit(0).alias("none")]
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct(*others).alias("row"))
    signed = _signatures(source, n, bands, rows)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no")
    classes = signed.groupBy("digest").agg(
        F.min(first).alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n_grams").alias("n_grams")
    )
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    links, groups = _verified_links(signed, classes, n, threshold)
    full = classes.join(links, "cid", "left").join(groups.withColumnRenamed("node", "cid"), "cid", "left").select(
        "digest", "rep", "copies", "cid", F.coalesce("root", "cid").alias("root"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_linked_rows", F.lit(0)).cast("long").alias("n_linked_docs"),
    )
    full = staged(full, "class-links")
    keepers = staged(full.groupBy("root").agg(F.min("rep").alias("keeper")), "keepers")
    named = full.join(keepers, "root").hint("merge")  # classes grow with the rows
    whole = F.struct(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in carry or []])
    return signed.select("doc_id", "digest", "row_no", *(["text", "row"] if carry else [])).join(named, "digest").select(
        "doc_id", F.col("keeper.doc_id").alias("class_id"), F.col("rep.doc_id").alias("set_id"),
        F.col("copies").alias("n_copies"), "n_links", "n_linked_docs", (F.col("row_no") == F.col("keeper.row_no")).alias("kept"),
        *([whole.alias("row")] if carry else []),
    )


def _verified_links(signed: DataFrame, classes: DataFrame, n: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links per class (cid, n_links, n_linked_rows) and the components of the links (node, root)."""
    reps = classes.select("cid", "copies", "n_grams", F.col("rep.row_no").alias("row_no"))
    banded = signed.select("row_no", "bands").join(reps.select("cid", "row_no"), "row_no")
    members = staged(banded.select("cid", F.explode("bands").alias("band")), "bands")
    near = staged(comparison_units(members).join(reps, "cid"), "candidates")
    sizes = near.groupBy("unit").agg(F.count(F.lit(1)).alias("classes"), F.sum("n_grams").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("classes") / BLOCK_CLASSES), F.ceil(F.col("grams") / BLOCK_GRAMS), F.lit(1)).cast("int")
    sizes = staged(sizes.select("unit", F.least(blocks, F.col("classes")).cast("int").alias("blocks")), "unit-sizes")
    near = near.join(sizes, "unit").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    chosen = near.groupBy("row_no", "cid", "copies").agg(F.collect_list(F.struct("unit", "buckets", "blocks", "block")).alias("places"))
    # A class has as many places as bands at most; its text is read and its set made once.
    texts = signed.select("row_no", "text").join(chosen.hint("merge"), "row_no")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [gram_set(text.as_py() or "", n).tobytes() for text in batch.column("text")]
            columns = [batch.column(c) for c in ("cid", "copies", "places")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(grams, pa.binary())], names=["cid", "copies", "places", "grams"])

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return compare_blocks(part, key[1], key[2], threshold, key[0])

    kind = texts.schema["places"].dataType.simpleString()
    held = texts.mapInArrow(sets, f"cid long, copies long, places {kind}, grams binary")
    held = held.withColumn("place", F.explode("places")).select("cid", "copies", "grams", "place.*")
    pairs = held.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "unit", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "cid", "copies", "buckets", "grams",
    )
    found = staged(pairs.groupBy("unit", "lo", "hi").applyInPandas(
        compare, "cid long, n_links long, n_linked_rows long, root long"), "links")
    links = found.groupBy("cid").agg(F.sum("n_links").alias("n_links"), F.sum("n_linked_rows").alias("n_linked_rows"))
    return links, connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))


def comparison_units(members: DataFrame) -> DataFrame:
    """What is compared with what: cid, unit and the sorted numbers of all buckets of the class, from rows (cid, band).

    A unit is a bucket of two classes or more, numbered by its first band, and
    `buckets` tells whether a pair meets in an earlier one. Where the buckets of
    connected candidates have more pairs than all of these candidates together,
    the unit is the whole of them, numbered by its smallest class, without
    `buckets`.
    """
    counted = members.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("cid").alias("b"), F.max("cid").alias("last"),
        F.bit_xor(F.xxhash64("cid")).alias("one"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("two"),
    ).where("n > 1")
    buckets = staged(counted, "buckets")
    edges = members.join(buckets.select("band", "b"), "band").select(F.col("cid").alias("a"), "b").distinct()
    near = connected_components(edges).select(F.col("node").alias("cid"), F.col("root").alias("candidates"))
    # Equal numbers, ends and two hashes of their classes: the same bucket found by several bands.
    distinct = buckets.groupBy("n", "b", "last", "one", "two").agg(F.min("band").alias("unit"))
    placed = staged(distinct.join(near, F.col("b") == F.col("cid")).select("unit", "n", "candidates"), "distinct-buckets")
    crowds = placed.groupBy("candidates").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("by_bucket"))
    sizes = near.groupBy("candidates").agg(F.count(F.lit(1)).cast("double").alias("classes"))
    whole = (F.col("by_bucket") >= F.col("classes") * F.col("classes")).alias("whole")
    crowds = staged(crowds.join(sizes, "candidates").select("candidates", whole), "crowds")
    # Written, so that its size is known: where it is small, the rows of all bands are not moved.
    thin = staged(placed.join(crowds.where("not whole"), "candidates").select("unit"), "thin-buckets")
    inside = members.join(thin, F.col("band") == F.col("unit")).select("cid", "unit")
    own = Window.partitionBy("cid")  # as many rows as bands at most
    listed = inside.withColumn("buckets", F.array_sort(F.collect_list("unit").over(own)))
    thick = near.join(crowds.where("whole"), "candidates").select("cid", F.col("candidates").alias("unit"))
    return listed.unionByName(
        thick.select("cid", "unit", F.lit(None).cast("array<long>").alias("buckets"))
    )
