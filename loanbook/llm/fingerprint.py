"""Document fingerprints by a homomorphic multiset hash.

A paragraph is hashed to a wide vector, a document is the sum of the vectors of
its paragraphs. Sums are taken modulo powers of two, so their order does not
matter, and a paragraph is inserted or deleted by adding or subtracting its
vector. A vector has two parts:

* EQUAL_LANES random 64-bit lanes modulo 2**64, from an extendable-output hash of
  the paragraph. Equal sums mean equal multisets of paragraphs, except with a chance
  that can be neglected.
* SKETCH_LANES signed counts modulo 2**32: every run of GRAM code points of the
  paragraph adds +1 or -1 to one lane, both chosen by its hash. The squared
  length of the difference of two documents' sketches estimates how many runs
  they do not share, which gives their likeness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import staged

EQUAL_LANES = 32
SKETCH_LANES = 256
GRAM = 16
RANGE_CHARS = 64  # of a text, by which rows equal in id are spread over partitions
SLICE = 1 << 18  # code points hashed at a time
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
MIX = np.uint64(0xD6E8FEB86659FD93)


class Fingerprint:
    """The sum of the vectors of a multiset of paragraphs."""

    __slots__ = ("equal", "sketch")

    def __init__(self, equal: np.ndarray | None = None, sketch: np.ndarray | None = None) -> None:
        self.equal = np.zeros(EQUAL_LANES, np.uint64) if equal is None else equal
        self.sketch = np.zeros(SKETCH_LANES, np.int32) if sketch is None else sketch

    @staticmethod
    def of(parts: list[str]) -> Fingerprint:
        """All paragraphs at once."""
        if not parts:
            return Fingerprint()
        digests = b"".join([hashlib.shake_128(p.encode("utf-8", "surrogatepass")).digest(8 * EQUAL_LANES) for p in parts])
        vectors = np.frombuffer(digests, dtype="<u8").reshape(-1, EQUAL_LANES)
        return Fingerprint(vectors.sum(axis=0, dtype=np.uint64), run_sketch(parts))

    @staticmethod
    def of_text(text: str) -> Fingerprint:
        return Fingerprint.of(paragraphs(text))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal + other.equal, self.sketch + other.sketch)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal - other.equal, self.sketch - other.sketch)

    def insert(self, paragraph: str) -> Fingerprint:
        return self + Fingerprint.of([paragraph])

    def delete(self, paragraph: str) -> Fingerprint:
        return self - Fingerprint.of([paragraph])

    def digest(self) -> bytes:
        """The first part and a digest of the second, which follows from the paragraphs as well."""
        return self.equal.astype("<u8").tobytes() + hashlib.blake2b(self.sketch.astype("<i4").tobytes(), digest_size=16).digest()

    def likeness(self, other: Fingerprint) -> float:
        """Share of runs two documents have in common, 0 to 1; 1 exactly if the paragraphs are the same."""
        if np.array_equal(self.equal, other.equal):
            return 1.0
        a, b = self.sketch.astype(np.float64), other.sketch.astype(np.float64)
        whole = a @ a + b @ b
        if whole == 0:
            return 0.0
        return float(min(1.0, max(0.0, 1 - ((a - b) @ (a - b)) / whole)))


def paragraphs(text: str) -> list[str]:
    """The lines of a text that are not blank, trimmed. An empty text has none."""
    return [part for line in text.split("\n") if (part := line.strip())]


def run_sketch(parts: list[str]) -> np.ndarray:
    """Signed counts of the hashed runs of GRAM code points in paragraphs; a shorter paragraph is one run."""
    joined = "\n".join([p if len(p) >= GRAM else p.ljust(GRAM, "\0") for p in parts])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sketch = np.zeros(SKETCH_LANES, np.int64)
    for at in range(0, len(codes) - GRAM + 1, SLICE):
        points = codes[at : at + SLICE + GRAM - 1]
        ends = np.concatenate(([0], np.cumsum(points == 10)))
        whole = ends[GRAM:] == ends[:-GRAM]  # runs inside one paragraph
        runs = points.astype(np.uint64) + np.uint64(1)
        power, width = BASE, 1
        while width < GRAM:  # a run of 2n points is hashed from its two halves
            runs = runs[:-width] * np.uint64(power) + runs[width:]
            power, width = power * power & MASK, width * 2
        runs = runs[whole]
        runs = (runs ^ (runs >> np.uint64(32))) * MIX
        lane = (runs >> np.uint64(56)).astype(np.int64)
        sign = ((runs >> np.uint64(55)) & np.uint64(1)).astype(np.int64) * 2 - 1
        sketch += np.bincount(lane, weights=sign, minlength=SKETCH_LANES).astype(np.int64)
    return sketch.astype(np.int32)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many code points from the start of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Walked:
    """A document with the fingerprints of its text and of the paragraphs that an edit of its last half leaves alone."""

    __slots__ = ("doc_id", "text", "cut", "head", "whole")

    def __init__(self, doc_id: object, text: str) -> None:
        self.doc_id, self.text = doc_id, text
        self.cut = text.rfind("\n", 0, len(text) - len(text) // 2) + 1
        self.head = Fingerprint.of_text(text[: self.cut])
        self.whole = self.head + Fingerprint.of_text(text[self.cut :])

    def beside(self, following: Walked) -> tuple:
        """The result's columns, given the next document."""
        new = edited(self.text, following.text)
        changed = self.head + Fingerprint.of_text(new[self.cut :])
        return (
            len(self.text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), self.whole.digest(),
            changed.digest(), self.whole.likeness(changed), self.whole.likeness(following.whole),
        )


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
FIELDS = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _batch(ids: list, flags: list, rows: list[tuple | None], texts: list, id_type: pa.DataType) -> pa.RecordBatch:
    rows = [row or (None,) * len(NAMES) for row in rows]
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, id_type), pa.array(flags, pa.string()), pa.array(texts, pa.string()), *columns],
        names=["doc_id", "place", "text", *NAMES],
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text) range-partitioned and sorted by descending id and text, with their partition `part`.

    The start of the text is part of the range, so the rows of a very common id,
    or of none, are spread as well.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    ranged = rows.repartitionByRange(order[0], F.substring("text", 1, RANGE_CHARS).desc())
    return ranged.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document follows in descending id; null ids come last, rows equal
    in id are ordered by their text, and the first row follows the last. A null
    text counts as empty; an empty text has no paragraphs, the fingerprint of
    zeros, and is like another empty one only. A single row is its own next. An
    empty table gives an empty result; other columns are not read.

    Rows are range-partitioned by id and the start of the text, and walked in order; only the first and
    the last row of every partition are matched across partitions afterwards.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before
        part = 0
        for batch in batches:
            ids, flags, out, texts = [], [], [], []
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                row = Walked(doc_id, value.as_py())
                ids.append(last and last.doc_id), flags.append(None if last else f"first {part}")
                out.append(last and last.beside(row)), texts.append(None if last else row.text)
                last = row
            if ids:
                yield _batch(ids, flags, out, texts, batch.schema.field("doc_id").type)
        if last is not None:
            yield _batch([last.doc_id], [f"last {part}"], [None], [last.text], batch.schema.field("doc_id").type)

    walked = staged(in_order(rows).mapInArrow(walk, f"doc_id {kind}, place string, text string, {FIELDS}"), "fingerprints")
    done = walked.where("place is null").select("doc_id", *NAMES)
    ends = walked.where("place is not null").withColumn("side", F.substring_index("place", " ", 1)).withColumn(
        "part", F.substring_index("place", " ", -1).cast("int")
    )
    # At most one first and one last row per partition; their number is the session's partition setting.
    parts = sorted(row["part"] for row in ends.where("side = 'first'").select("part").collect())
    following = dict(zip(parts, parts[1:] + parts[:1], strict=True))
    if not parts:
        return _in_hex(done)
    after = docs.sparkSession.createDataFrame(list(following.items()), "part int, next_part int")
    firsts = ends.where("side = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    lasts = ends.where("side = 'last'").join(F.broadcast(after), "part").select("doc_id", "text", "next_part")  # two numbers a partition

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, others = batch.column("text").to_pylist(), batch.column("next_text").to_pylist()
            out = [Walked(None, text).beside(Walked(None, other)) for text, other in zip(texts, others, strict=True)]
            if out:
                columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *NAMES])

    # Both sides carry whole texts, one a partition: joined by merge at every size.
    closed = lasts.hint("merge").join(firsts, "next_part").select("doc_id", "text", "next_text").mapInArrow(
        close, f"doc_id {kind}, {FIELDS}"
    )
    return _in_hex(done.unionByName(closed))


def _in_hex(found: DataFrame) -> DataFrame:
    """Digests travel as bytes and are written as lowercase hex at the end."""
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})
