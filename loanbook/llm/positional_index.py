"""Positional inverted index of documents, with exact phrase and proximity search.

Documents are indexed in blocks of bounded size. A block has one row per term:
the places of that term in the block's words, counted through all documents of
the block, as gaps. So a term that stands in every document is spread over as
many rows as there are blocks, and a search works on one block at a time.

A search takes the words of every phrase in the order of their corpus counts.
Blocks that hold a phrase's rarest word are looked at; its places, shifted by
the word's offset in the phrase, are the candidates, and they are intersected
with the shifted lists of the other words, rarest first. All phrases of a block
are intersected together by binary search in its lists. With a `slop` a word
may stand that many places away from where the phrase has it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import staged

BLOCK_BYTES = 8 << 20  # text of a block; a longer document is a block of its own
BLOCK_DOCS = 1 << 16
CHUNK_PHRASES = 200_000  # phrases that are looked for in a block at a time
RUN_CANDIDATES = 1 << 20
PLACE_BITS = 32

# A-Z become a-z; bytes that are no part of a word (ASCII but digits and letters) become spaces.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, lower-cased letters and non-ASCII characters."""
    return text.translate(WORD_BYTES).split()


class PositionalIndex(NamedTuple):
    """`postings`: block, term, n, gaps. `documents`: block, starts (first places of its documents), doc_ids, n_words."""

    postings: DataFrame
    documents: DataFrame

    def rows(self) -> DataFrame:
        """One row per document: block, place (its number in the block), doc_id, n_words."""
        each = F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "row")
        return self.documents.select("block", each).select("block", "place", F.col("row.doc_ids").alias("doc_id"), "row.n_words")


class _Block:
    """Words of some documents, as numbers of terms in the order they came."""

    def __init__(self) -> None:
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.numbers: list[np.ndarray] = []
        self.doc_ids: list = []
        self.n_bytes = 0

    def add(self, doc_id, text: bytes) -> None:
        words = words_of(text)
        self.numbers.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))
        self.doc_ids.append(doc_id)
        self.n_bytes += len(text)

    def full(self) -> bool:
        return self.n_bytes >= BLOCK_BYTES or len(self.doc_ids) >= BLOCK_DOCS

    def batches(self, block: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The documents of the block, then its terms with their places."""
        n_words = np.array([len(x) for x in self.numbers], np.int64)
        starts = np.cumsum(n_words) - n_words
        lists = [
            pa.array([block], pa.int64()), pa.nulls(1, pa.binary()), pa.array([int(n_words.sum())], pa.int64()), pa.nulls(1, pa.binary()),
            pa.array([starts.astype("<i8").tobytes()], pa.binary()), pa.array([self.doc_ids], pa.list_(id_type)),
            pa.array([n_words], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(lists, names=COLUMNS)
        numbers = np.concatenate(self.numbers)
        size = len(self.vocabulary)
        if not size:
            return
        places = np.argsort(numbers.astype(np.uint16) if size <= 1 << 16 else numbers, kind="stable")
        counts = np.bincount(numbers, minlength=size)
        ends = np.cumsum(counts)
        gaps = np.diff(places, prepend=0)
        gaps[ends - counts] = places[ends - counts]
        gaps = gaps.astype("<i4")
        offsets = np.concatenate(([0], ends * gaps.itemsize)).astype(np.int32)
        held = pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(offsets), pa.py_buffer(gaps)])
        arrays = [pa.array(np.full(size, block)), pa.array(list(self.vocabulary), pa.binary()), pa.array(counts), held]
        none = [pa.nulls(size, pa.binary()), pa.nulls(size, pa.list_(id_type)), pa.nulls(size, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*arrays, *none], names=COLUMNS)


COLUMNS = ["block", "term", "n", "gaps", "starts", "doc_ids", "n_words"]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PositionalIndex:
    """Write the index of all words of all rows to the shared folder.

    Null texts and texts without a word are documents of no words. Ids may be
    null or repeated; every row is a document of its own. An empty table gives
    an empty index; other columns are not read. A text is held by one task,
    with about 30 bytes a word.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        block, id_type = _Block(), None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, text.as_py() or b"")
                if block.full():
                    yield from block.batches(number, id_type)
                    block, number = _Block(), number + 1
        if block.doc_ids:
            yield from block.batches(number, id_type)

    schema = f"block long, term binary, n long, gaps binary, starts binary, doc_ids array<{kind}>, n_words array<long>"
    index = staged(rows.mapInArrow(run, schema), "positional-index")
    return PositionalIndex(
        index.where("term is not null").select("block", "term", "n", "gaps"),
        index.where("term is null").select("block", "starts", "doc_ids", "n_words"),
    )


def search(index: PositionalIndex, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Every occurrence of the phrases (phrase_no long, words array<binary>) in the index.

    Returns block, place and the array `hits` of (start, end, phrase_no), in
    word places of the document; a document may have several rows. With `slop`
    0 these are the exact occurrences. With more, a hit is an occurrence of the
    phrase's rarest word for which every other word stands in the same document
    at most `slop` places from where the phrase would have it; start and end
    then enclose the places found. A phrase with a word that no document has is
    nowhere, and neither is a phrase of no words.
    """
    exploded = phrases.select("phrase_no", F.posexplode("words").alias("offset", "term"))
    terms = staged(exploded.select("term").distinct().withColumn("term_no", F.monotonically_increasing_id()), "phrase-terms")
    totals = index.postings.select("term", "n").join(terms, "term").groupBy("term", "term_no").agg(F.sum("n").alias("total"))
    totals = staged(totals, "term-totals")
    by_rarity = F.array_sort(F.collect_list(F.struct("total", "offset", "term_no")))  # the words of one phrase
    ordered = exploded.join(totals, "term", "left").groupBy("phrase_no").agg(
        by_rarity.alias("words"), F.max(F.col("total").isNull()).alias("nowhere")
    ).where("not nowhere").select(
        "phrase_no", F.col("words.term_no").alias("term_nos"), F.col("words.offset").alias("offsets"),
        F.col("words")[0]["term_no"].alias("rarest"),
    )
    ordered = staged(ordered, "ordered-phrases")
    chunks = max(1, -(-ordered.count() // CHUNK_PHRASES))
    chunk = F.pmod(F.xxhash64("phrase_no"), F.lit(chunks)).alias("chunk")
    every = F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))
    wanted = index.postings.select("block", "term").join(totals.select("term", "term_no"), "term").join(
        ordered, F.col("term_no") == F.col("rarest")
    ).select(F.col("block").alias("in_block"), chunk, "phrase_no", "term_nos", "offsets")
    lists = index.postings.select("block", "term", "n", "gaps").join(totals.select("term", "term_no"), "term").select(
        "block", F.explode(every).alias("chunk"), "term_no", "n", "gaps"
    )
    documents = index.documents.select(
        "block", F.explode(every).alias("chunk"),
        F.lit(None).cast("long").alias("term_no"), F.lit(0).cast("long").alias("n"), F.col("starts").alias("gaps"),
    )

    def intersect(key: tuple, lists: pa.Table, wanted: pa.Table) -> pa.Table:
        return _in_block(key[0].as_py(), lists, wanted, slop)

    return lists.unionByName(documents).groupBy("block", "chunk").cogroup(wanted.groupBy("in_block", "chunk")).applyInArrow(
        intersect, "block long, place int, hits array<struct<start: int, end: int, phrase_no: long>>"
    )


def _in_block(block: int, lists: pa.Table, wanted: pa.Table, slop: int) -> pa.Table:
    """Hits of the wanted phrases in one block, a row per document that has any."""
    numbers = lists.column("term_no").combine_chunks()
    is_docs = numbers.is_null().to_numpy(zero_copy_only=False)
    found: list[tuple[np.ndarray, ...]] = []
    if wanted.num_rows and is_docs.any():
        packed = lists.column("gaps").combine_chunks()
        starts = np.frombuffer(packed[int(is_docs.argmax())].as_py(), "<i8")
        postings = _Postings(numbers.to_numpy(zero_copy_only=False), lists.column("n").to_numpy(), packed, is_docs)
        phrases = _Phrases(wanted, postings.term_nos)
        # The last document ends with the block; places of postings never pass it.
        ends = np.append(starts[1:], np.iinfo(np.int64).max)
        found = [
            _intersect(phrases, first, last, postings, starts, ends, slop)
            for first, last in phrases.runs(postings.counts, RUN_CANDIDATES)
        ]
    place, start, end, phrase = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (list(zip(*found, strict=True)) or [()] * 4))
    order = np.lexsort((end, start, place))
    place, start, end, phrase = place[order], start[order], end[order], phrase[order]
    docs, first = np.unique(place, return_index=True)
    hits = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(phrase, pa.int64())], names=["start", "end", "phrase_no"])
    offsets = pa.array(np.append(first, len(place)).astype(np.int32))
    return pa.table({
        "block": pa.array(np.full(len(docs), block), pa.int64()), "place": pa.array(docs, pa.int32()),
        "hits": pa.ListArray.from_arrays(offsets, hits),
    })


class _Postings:
    """Lists of a block by ascending term number; `keys` are (index of the list, place), ascending."""

    def __init__(self, numbers: np.ndarray, counts: np.ndarray, packed: pa.Array, is_docs: np.ndarray) -> None:
        rows = np.flatnonzero(~is_docs)
        rows = rows[np.argsort(numbers[rows].astype(np.int64), kind="stable")]
        self.term_nos, self.counts = numbers[rows].astype(np.int64), counts[rows].astype(np.int64)
        gaps = np.frombuffer(b"".join(packed[int(r)].as_py() for r in rows), "<i4").astype(np.int64)
        summed = np.cumsum(gaps)
        self.first = np.cumsum(self.counts) - self.counts
        self.places = summed - np.repeat(summed[self.first] - gaps[self.first], self.counts)
        self.keys = np.repeat(np.arange(len(rows), dtype=np.int64) << PLACE_BITS, self.counts) | self.places


class _Phrases:
    """Phrases as a matrix of list indexes and offsets, rarest word first; -1 where a phrase has no more words."""

    def __init__(self, wanted: pa.Table, term_nos: np.ndarray) -> None:
        terms, offsets = wanted.column("term_nos").combine_chunks(), wanted.column("offsets").combine_chunks()
        length = np.diff(terms.offsets.to_numpy())
        inside = np.arange(length.max())[None, :] < length[:, None]
        flat = terms.flatten().to_numpy()
        at = np.searchsorted(term_nos, flat)
        held = term_nos[np.minimum(at, len(term_nos) - 1)] == flat
        self.lists = np.full(inside.shape, -1, np.int64)
        self.offsets = np.zeros(inside.shape, np.int64)
        self.lists[inside], self.offsets[inside] = at, offsets.flatten().to_numpy()
        missing = np.zeros(inside.shape, bool)
        missing[inside] = ~held  # the block lacks a word of the phrase
        whole = ~missing.any(axis=1)
        self.lists, self.offsets, self.length = self.lists[whole], self.offsets[whole], length[whole].astype(np.int64)
        self.numbers = wanted.column("phrase_no").to_numpy()[whole]

    def runs(self, counts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
        """Consecutive phrases with at most `limit` candidates together, or one phrase with more."""
        total = np.cumsum(counts[self.lists[:, 0]])
        first = 0
        while first < len(total):
            before = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, before + limit, "right")))
            yield first, last
            first = last


def _intersect(
    phrases: _Phrases, first: int, last: int, postings: _Postings, starts: np.ndarray, ends: np.ndarray, slop: int
) -> tuple[np.ndarray, ...]:
    """Places of the rarest words, narrowed by the lists of the others: document, start, end and number of every phrase found."""
    lists, offsets = phrases.lists[first:last], phrases.offsets[first:last]
    counts = postings.counts[lists[:, 0]]
    row = np.repeat(np.arange(last - first), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = postings.places[postings.first[lists[row, 0]] + within]
    origin = place - offsets[row, 0]
    doc = np.searchsorted(starts, place, "right") - 1
    low, high = starts[doc], ends[doc]
    lowest, highest = place.copy(), place.copy()
    for k in range(1, lists.shape[1]):
        if not len(row):
            break
        ours = lists[row, k]
        target = origin + offsets[row, k]
        least, most = np.maximum(target - slop, low), np.minimum(target + slop, high - 1)
        at = np.searchsorted(postings.keys, (ours << PLACE_BITS) | np.maximum(least, 0))
        key = postings.keys[np.minimum(at, len(postings.keys) - 1)]
        met = key & ((1 << PLACE_BITS) - 1)
        more = ours >= 0
        kept = ~more | ((at < len(postings.keys)) & (key >> PLACE_BITS == ours) & (met >= least) & (met <= most))
        lowest, highest = np.where(more, np.minimum(lowest, met), lowest), np.where(more, np.maximum(highest, met), highest)
        row, origin, doc, low, high, lowest, highest = (x[kept] for x in (row, origin, doc, low, high, lowest, highest))
    return doc, lowest - low, highest + 1 - low, phrases.numbers[first:last][row]
