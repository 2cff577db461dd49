"""Product codes of vectors, trained and assigned in exact integer arithmetic.

Components are scaled and floored to integers, and a vector is cut into equal
parts with a codebook each. Distances need dot products of integers. They are
computed by float64 BLAS and still are exact: both factors are broken into
limbs so short that every sum of limb products stays below 2^53, where float64
holds all integers; the products are recombined in int64, and the first of the
smallest distances wins. Where a distance might not fit int64, the same
distances are computed with Python's integers.

A round is one pass over the written vectors. A task returns sums and counts
per codebook entry, which are added up exactly, so what reaches the driver is
one codebook, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import staged

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BATCH_ROWS = 8192  # vectors multiplied at a time
FLOAT_BITS = 53
SUM_BITS = 60  # sums of any size travel in limbs of so many bits
LONG_MAX = (1 << 63) - 1

Codebook = list[list[int]]  # entries of one part, as exact integers


def limb_bits(length: int) -> int:
    """Most bits of a limb for which `length` products of two limbs add up to less than 2^53."""
    return (FLOAT_BITS - 1 - math.ceil(math.log2(max(length, 1)))) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of int64 values as float64, lowest first; the last one carries the sign."""
    found, rest = [], values
    while rest.size and (rest.max() >= 1 << bits or rest.min() < -(1 << bits)):
        found.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*found, rest.astype(np.float64)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T of int64 matrices, exact if the result fits int64."""
    bits = limb_bits(left.shape[1])
    total = np.zeros((len(left), len(right)), np.int64)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(limbs(right, bits)):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(part: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry per row (ties to the lower) and the squared distance to it, exact.

    `part` holds int64, or Python integers where components are very large;
    then the distances are Python integers as well.
    """
    largest = max([abs(c) for entry in book for c in entry], default=0)
    if part.dtype != object and part.size:
        largest = max(largest, int(part.max()), -int(part.min()))
    if part.dtype == object or 4 * part.shape[1] * largest * largest > LONG_MAX:
        entries = np.array(book, dtype=object)
        away = ((part.astype(object)[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        away = away.reshape(len(part), len(book))
        best = np.array([min(range(len(row)), key=row.__getitem__) for row in away], np.int64)
        return best, away[np.arange(len(part)), best]
    entries = np.array(book, np.int64).reshape(len(book), part.shape[1])
    away = (entries * entries).sum(axis=1)[None, :] - 2 * exact_products(part, entries)
    best = away.argmin(axis=1)
    return best, (part * part).sum(axis=1) + away[np.arange(len(part)), best]


def as_integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite float64 components: int64, or Python integers if one is too large."""
    scaled = np.floor(vectors * scale)
    if np.isfinite(scaled).all() and (not scaled.size or np.abs(scaled).max() < 2.0**62):
        return scaled.astype(np.int64)
    exact = [_floor(x, scale) for x in vectors.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(vectors.shape)


def _floor(value: float, scale: int) -> int:
    top, bottom = value.as_integer_ratio()
    return top * scale // bottom


def _matrices(batch: pa.RecordBatch, length: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, BATCH_ROWS):
        rows = batch.slice(at, BATCH_ROWS)
        flat = rows.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield rows, as_integers(flat.reshape(rows.num_rows, length), scale)


def _usable(vector: Column) -> Column:
    """No null and no non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def train(vectors: DataFrame, parts: int, entries: int, rounds: int, scale: int, length: int) -> list[Codebook]:
    """Codebooks per part from written rows (vec_id, vector) of `length` components; see `compress`."""
    wide = length // parts
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    first = vectors.orderBy(*order).limit(entries).select("vector").collect()
    start = as_integers(np.array([row["vector"] for row in first], np.float64).reshape(len(first), length), scale)
    books = [[[int(c) for c in row[p * wide : (p + 1) * wide]] for row in start] for p in range(parts)]
    for _ in range(rounds):
        sums = vectors.select("vector").mapInArrow(
            _sums_of(books, length, scale), "part int, entry int, at int, limb int, total long, members long"
        ).groupBy("part", "entry", "at", "limb").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members")
        )
        added: dict[tuple[int, int, int], list[int]] = {}
        for row in sums.collect():  # one codebook: parts x entries x components of a part, a few limbs each
            place = added.setdefault((row["part"], row["entry"], row["at"]), [0, 0])
            place[0] += int(row["total"]) << (SUM_BITS * row["limb"])
            place[1] += row["members"]
        for (part, entry, at), (total, members) in added.items():
            books[part][entry][at] = total // members
    return books


def _sums_of(books: list[Codebook], length: int, scale: int):
    """Per task: the sum of every component of the parts assigned to an entry, in limbs; their number is with limb 0."""
    wide, n_entries = length // len(books), len(books[0])
    names = ["part", "entry", "at", "limb", "total", "members"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(books), n_entries, wide), dtype=object)
        members = np.zeros((len(books), n_entries), np.int64)
        for batch in batches:
            for _, matrix in _matrices(batch, length, scale):
                for p, book in enumerate(books):
                    part = matrix[:, p * wide : (p + 1) * wide]
                    best, _ = nearest(part, book)
                    members[p] += np.bincount(best, minlength=n_entries)
                    for entry in np.unique(best):
                        totals[p, entry] += _exact_sum(part[best == entry])
        rows = []
        for p, e in np.argwhere(members > 0).tolist():
            for at in range(wide):
                for limb, value in enumerate(_sum_limbs(int(totals[p, e, at]))):
                    rows.append((p, e, at, limb, value, 0 if limb else int(members[p, e])))
        kinds = (pa.int32(),) * 4 + (pa.int64(),) * 2
        columns = [[row[k] for row in rows] for k in range(len(names))]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _sum_limbs(value: int) -> list[int]:
    """Limbs of SUM_BITS bits, lowest first; the last one carries the sign."""
    found = []
    while not -(1 << SUM_BITS) <= value < 1 << SUM_BITS:
        found.append(value & ((1 << SUM_BITS) - 1))
        value >>= SUM_BITS
    return [*found, value]


def _exact_sum(part: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    if part.dtype == object or max(int(part.max()), -int(part.min())) * len(part) > LONG_MAX:
        return part.astype(object).sum(axis=0)
    return part.sum(axis=0).astype(object)


def assign(vectors: DataFrame, books: list[Codebook], scale: int, length: int) -> DataFrame:
    """Rows (vec_id, label, vector) with their `code` and `error`, the vector left out."""
    wide = length // len(books)
    kept = vectors.schema["vec_id"], vectors.schema["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in _matrices(batch, length, scale):
                error = np.zeros(len(matrix), dtype=object)
                code = [""] * len(matrix)
                for p, book in enumerate(books):
                    best, away = nearest(matrix[:, p * wide : (p + 1) * wide], book)
                    error += away.astype(object)
                    code = [c + f"{b:02x}" for c, b in zip(code, best.tolist(), strict=True)]
                errors = [int(e) if e <= LONG_MAX else None for e in error]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), pa.array(code, pa.string()), pa.array(errors, pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return vectors.select("vec_id", "label", "vector").mapInArrow(run, f"{kinds}, code string, error long")


def codebooks_sha256(books: list[Codebook]) -> str:
    """Digest of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """One row per kept input row: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are
    dropped. A component x becomes floor(scale * x). Codebooks start as the
    parts of the `entries` smallest ids (ids used twice by their vectors, null
    ids last; fewer rows give fewer entries). Each round assigns all parts,
    ties to the lower index, and moves every used entry to the floored mean of
    its parts. `code` has two hex digits per part, `error` is the squared
    distance summed over the parts, `label_error` its sum over the rows of the
    label (null labels are one label). Equal rows get equal codes and a row each.

    All vectors must have the length most rows have (of equally many the
    larger); rows of another length, empty vectors among them, take no part and
    come back with null `code` and `error`. That length must be a multiple of
    `parts`. An error beyond 64 bits is null and is left out of `label_error`.
    An empty table gives an empty result; other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits per part: 1 to 256 entries")
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    ).where(_usable(F.col("vector")))
    rows = staged(rows, "vectors")
    usual = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = usual["length"] if usual else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    if not length:
        none = rows.select("vec_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return none.select("*", F.col("error").alias("label_error"), F.lit(codebooks_sha256([])).alias("codebooks_sha256"))
    alike = rows.where(F.size("vector") == length)
    books = train(alike, parts, entries, rounds, scale, length)
    other = rows.where(F.size("vector") != length).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    coded = staged(assign(alike, books, scale, length).unionByName(other), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = F.when(F.col("total") <= LONG_MAX, F.col("total")).cast("long")
    totals = coded.groupBy(F.col("label").alias("of")).agg(total.alias("total")).select("of", fits.alias("label_error"))
    # Written first: the optimizer knows its size, and can split the rows of a frequent label if it is large.
    totals = staged(totals, "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )
