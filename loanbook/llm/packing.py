"""Best-fit packing of documents into sequences of several permitted lengths.

Variable-capacity best-fit decreasing: pieces are placed largest first into the
open bin that they leave least room in. If none has room, a bin is opened whose
size costs least: sizes are compared by the cost per unit of the piece and of
the smaller pieces still to come that can fill it up. At the end every bin is
downsized to the smallest permitted length that holds its contents.

Rows are dealt by hash to groups of a bounded expected number of rows; each
group is packed on its own, so neither the driver nor a task sees all lengths,
and only the last bins of a group can be worse filled than in one global run.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import staged

CAPACITIES = (2048, 8192, 32768)
GROUP_ROWS = 4096
SCHEMA = "row_no long, piece int, length int, offset int, bin int, capacity int"


def sequence_cost(overhead: int, attention: int) -> Callable[[int], float]:
    """Cost of a bin: its length, since padding is paid for, attention over it, and a fixed overhead per sequence.

    Attention grows with the square of the length; at `attention` tokens it costs as much as the rest.
    """
    return lambda capacity: overhead + capacity + capacity * capacity / attention


class OpenBins:
    """Open bins ordered by the room they have left."""

    def __init__(self) -> None:
        self._room: list[int] = []  # distinct amounts of room, ascending
        self._bins: dict[int, list[int]] = {}

    def add(self, bin_no: int, room: int) -> None:
        if room <= 0:
            return
        if room not in self._bins:
            bisect.insort(self._room, room)
            self._bins[room] = []
        heapq.heappush(self._bins[room], bin_no)

    def take(self, length: int) -> tuple[int, int] | None:
        """The bin with the least sufficient room, of equal ones the first opened, removed from the open ones, and its room."""
        at = bisect.bisect_left(self._room, length)
        if at == len(self._room):
            return None
        room = self._room[at]
        bins = self._bins[room]
        bin_no = heapq.heappop(bins)
        if not bins:
            del self._bins[room]
            del self._room[at]
        return bin_no, room


def opened_size(length: int, rest: int, capacities: Sequence[int], cost: Callable[[int], float]) -> int:
    """The permitted size with the least cost per unit that it will hold: the piece and what is still to come."""
    fitting = [c for c in capacities if c >= length]
    return min(fitting, key=lambda c: (cost(c) / min(c, length + rest), c))


def best_fit(
    lengths: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float]
) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every piece, and the downsized length of every bin. Lengths are 1 to the largest capacity."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    rest = sum(lengths)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    used: list[int] = []
    open_bins = OpenBins()
    for i in order:
        length = lengths[i]
        rest -= length
        found = open_bins.take(length)
        if found is None:
            found = len(used), opened_size(length, rest, capacities, cost)
            used.append(0)
        bin_no, room = found
        bins[i], offsets[i] = bin_no, used[bin_no]
        used[bin_no] += length
        open_bins.add(bin_no, room - length)
    return bins, offsets, [min(c for c in capacities if c >= held) for held in used]


def cut_pieces(length: int, most: int) -> list[int]:
    """A length as pieces of the largest capacity and what remains."""
    whole, last = divmod(length, most)
    return [most] * whole + [last] * (last > 0)


def _pack_group(rows: pd.DataFrame, capacities: tuple[int, ...], cost: Callable[[int], float]) -> pd.DataFrame:
    rows = rows.sort_values(["length", "row_no"], ascending=[False, True])
    owner, piece, lengths = [], [], []
    for row_no, length in zip(rows["row_no"].tolist(), rows["length"].tolist(), strict=True):
        for k, part in enumerate(cut_pieces(length, capacities[-1])):
            owner.append(row_no)
            piece.append(k)
            lengths.append(part)
    bins, offsets, sizes = best_fit(lengths, capacities, cost)
    return pd.DataFrame({
        "row_no": owner, "piece": piece, "length": lengths, "offset": offsets, "bin": bins,
        "capacity": [sizes[b] for b in bins],
    })


def pack(
    docs: DataFrame, length: Column, id_col: str = "doc_id", capacities: Sequence[int] = CAPACITIES,
    overhead: int = 256, attention: int = 32768, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: doc_id, piece, n_pieces, length, start, bin_id, offset, bin_capacity, bin_filled.

    `length` is the number of tokens of a row; a longer row than the largest
    capacity becomes several pieces, `start` being where the piece begins in
    the row. Rows of length 0 (null and empty texts) take no room: they give
    one row with piece 0 and a null bin. Repeated rows are packed each. Null
    ids stay null. An empty table gives an empty result; other columns are not
    read unless `length` does.
    """
    sizes = tuple(sorted(set(capacities)))
    if not sizes or sizes[0] < 1:
        raise ValueError("capacities must be positive")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("length"))
    rows = staged(rows.withColumn("row_no", F.monotonically_increasing_id()), "pack-rows")
    total = rows.agg(F.sum(F.ceil(F.col("length") / sizes[-1])).alias("pieces")).first()["pieces"] or 0
    groups = max(1, -(-total // group_rows))
    work = rows.where("length > 0").withColumn("pack_group", F.pmod(F.xxhash64("row_no"), F.lit(groups)))
    long_rows = F.col("length") > sizes[-1] * group_rows  # a row of very many pieces: its full bins need no packing
    whole = F.when(long_rows, F.floor(F.col("length") / sizes[-1])).otherwise(0)
    work = work.withColumn("whole", whole.cast("long")).withColumn("rest", F.col("length") - F.col("whole") * sizes[-1])

    cost = sequence_cost(overhead, attention)

    def packed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = _pack_group(part.rename(columns={"rest": "length"}), sizes, cost)
        return out.assign(pack_group=key[0])

    placed = (
        work.where("rest > 0").select("row_no", "pack_group", "rest").groupBy("pack_group")
        .applyInPandas(packed, f"{SCHEMA}, pack_group long")
    )
    placed = staged(placed, "pack-placed")
    filled = placed.groupBy("pack_group", "bin").agg(F.sum("length").cast("int").alias("bin_filled"))
    bins = placed.join(filled, ["pack_group", "bin"]).select(
        "row_no", "piece", F.col("length").alias("part"), "offset", F.col("capacity").alias("bin_capacity"),
        F.concat_ws("-", "pack_group", "bin").alias("bin_id"), "bin_filled",
    )
    at = (F.col("piece") + F.col("whole")).cast("long")
    packed_rows = work.join(bins, "row_no").select(
        "doc_id", at.alias("piece"), _pieces(sizes[-1]), F.col("part").alias("length"),
        (at * sizes[-1]).alias("start"), "bin_id", "offset", "bin_capacity", "bin_filled",
    )
    full = work.where("whole > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("whole") - 1))).select(
        "doc_id", "piece", _pieces(sizes[-1]), F.lit(sizes[-1]).alias("length"),
        (F.col("piece") * sizes[-1]).alias("start"), F.concat_ws("-", F.lit("row"), "row_no", "piece").alias("bin_id"),
        F.lit(0).alias("offset"), F.lit(sizes[-1]).alias("bin_capacity"), F.lit(sizes[-1]).alias("bin_filled"),
    )
    none = F.lit(None)
    empty = rows.where("length <= 0").select(
        "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("n_pieces"), F.lit(0).alias("length"),
        F.lit(0).cast("long").alias("start"), none.cast("string").alias("bin_id"), none.cast("int").alias("offset"),
        none.cast("int").alias("bin_capacity"), none.cast("int").alias("bin_filled"),
    )
    return packed_rows.unionByName(full).unionByName(empty)


def _pieces(most: int) -> Column:
    return F.ceil(F.col("length") / F.lit(most)).cast("long").alias("n_pieces")
