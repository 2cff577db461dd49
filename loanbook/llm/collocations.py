"""Phrase collocations, counted over a prefix-free parse of the texts.

1. Parse. The words of a text are cut where a hash of the next words calls for
   it, so equal passages are cut alike wherever they stand. Every chunk also
   holds the words of the trigger that ends it, which begin the next chunk.
   The dictionary is the distinct chunks of a language with their frequencies;
   a passage that a million documents share is a few rows of it.
2. Count. Phrases are counted inside the distinct chunks, weighted by their
   frequencies. A phrase belongs to the chunk in which it begins before the
   trigger, so what lies in an overlap is counted once.
3. Words are counted first, then pairs of frequent words, then all longer
   phrases whose pairs are frequent, since a phrase with a rare part is rare.
   Tasks learn what is frequent from a bitmap of fixed size; a bit that two
   phrases share costs a needless count and changes no result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanbook.llm.common import runs_by_size, staged

MOST_WORDS = 4
LEAST_COUNT = 30
HELD_PERCENT = 80
PER_LANGUAGE = 2000
NO_LANGUAGE = "und"
SPACING = 48  # words between two triggers, on average
RUN_BYTES = 10 << 20  # chunks that a task counts at a time
MAP_BITS = 24
RANK_SALTS = 256
SCORE_SCALE = 2_000_000
SCORE_BIN = 1000
MIX = np.uint64(0x9E3779B97F4A7C15)
BREAK = b"A"  # stands for the end of a piece; no word holds a capital letter

# A-Z become a-z, marks that end a piece become line feeds, and a tab is a space.
TEXT_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b for b in range(256)
)


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text in order, with BREAKs between its pieces."""
    return text.translate(TEXT_BYTES).replace(b"\n", b" " + BREAK + b" ").split()


def hash_of(lang: str) -> Callable[[bytes], int]:
    """The hash of the words of a language."""
    return partial(xxhash.xxh3_64_intdigest, seed=xxhash.xxh32_intdigest(lang))


def fold(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of the hashes of consecutive words, given per position of the phrase."""
    folded = np.zeros_like(hashes[0])
    for hashed in hashes:
        folded = (folded ^ hashed) * MIX
        folded ^= folded >> np.uint64(32)
    return folded


class _Vocabulary:
    """Numbers of the words of one language within a run, and their hashes."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = count().__next__

    def encode(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))

    def hashes(self, lang: str) -> np.ndarray:
        return np.fromiter(map(hash_of(lang), self.numbers), np.uint64, len(self.numbers))


class _Hashes(dict):
    """Hash of every word of one language that a batch has met."""

    def __init__(self, lang: str) -> None:
        self.hashed = hash_of(lang)

    def __missing__(self, word: bytes) -> int:
        self[word] = value = self.hashed(word)
        return value


def cuts(hashes: np.ndarray, ends: np.ndarray, overlap: int, spacing: int) -> np.ndarray:
    """Where chunks begin in texts that end at `ends`: where a text begins, and wherever the hash of the next `overlap` words of it is a multiple of `spacing`."""
    at = len(hashes) - overlap + 1
    begins = np.concatenate(([0], ends[:-1]))
    if at < 2 or not overlap:
        return begins
    windows = fold([hashes[k : k + at] for k in range(overlap)])
    triggers = np.flatnonzero((windows >> np.uint64(20)) % np.uint64(spacing) == 0)
    inside = triggers + overlap <= ends[np.searchsorted(ends, triggers, "right")]
    return np.union1d(begins, triggers[inside])


def parse(docs: DataFrame, overlap: int, spacing: int = SPACING) -> DataFrame:
    """The dictionary of rows (lang, text): lang, fresh, chunk and its frequency `times`.

    `chunk` is words (and BREAKs) joined by spaces; phrases that begin at its
    first `fresh` words belong to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for first, last in runs_by_size(sizes, RUN_BYTES):
                rows = batch.slice(first, last - first)
                for lang in pc.unique(rows.column("lang")).to_pylist():
                    texts = rows.column("text").filter(pc.equal(rows.column("lang"), lang))
                    yield from _chunks(lang, texts.drop_null().to_pylist(), overlap, spacing)

    chunks = docs.mapInArrow(run, "lang string, fresh int, chunk binary")
    return staged(chunks.groupBy("lang", "fresh", "chunk").agg(F.count(F.lit(1)).alias("times")), "parse")


def _chunks(lang: str, texts: list[bytes], overlap: int, spacing: int) -> Iterator[pa.RecordBatch]:
    """The chunks of some texts of one language."""
    hashed = _Hashes(lang)
    tokens: list[bytes] = []
    ends = []
    for text in texts:
        found = tokens_of(text)
        if found:
            tokens += found
            ends.append(len(tokens))
    if not ends:
        return
    ends = np.array(ends)
    starts = cuts(np.fromiter(map(hashed.__getitem__, tokens), np.uint64, len(tokens)), ends, overlap, spacing)
    stops = np.append(starts[1:], len(tokens))
    reach = np.minimum(stops + overlap, ends[np.searchsorted(ends, starts, "right")])
    chunks = [b" ".join(tokens[start:end]) for start, end in zip(starts.tolist(), reach.tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(lang), len(chunks)), pa.array(stops - starts, pa.int32()), pa.array(chunks, pa.binary())],
        names=["lang", "fresh", "chunk"],
    )


def frequent_bits(phrases: DataFrame) -> np.ndarray:
    """Bitmap of 2^MAP_BITS bits with the bit of every phrase (lang, phrase) set."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                int(fold([np.array([hash_of(lang)(w.encode())], np.uint64) for w in phrase.split(" ")])[0] >> np.uint64(64 - MAP_BITS))
                for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["place"])

    place = F.col("place") + 1  # Spark numbers the bits of a bitmap from 1
    pages = phrases.select("lang", "phrase").mapInArrow(places, "place long").groupBy(F.bitmap_bucket_number(place).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = np.zeros(1 << MAP_BITS >> 3, np.uint8)
    for row in pages.collect():  # at most 2^MAP_BITS bits in all
        page = np.frombuffer(bytes(row["bits"]), np.uint8)
        bits[(row["page"] - 1) * len(page) : row["page"] * len(page)] = page
    return bits


def _is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def count_in_chunks(
    lang: str, chunks: pa.Array, fresh: np.ndarray, times: np.ndarray, sizes: tuple[int, ...], bits: np.ndarray | None
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys (language, tab, phrase) of the phrases of so many words in some distinct chunks of a language, and their weighted counts.

    `bits` are those of frequent phrases one word shorter than the shortest of
    `sizes`; every phrase of that many words in a counted phrase has its bit set.
    """
    lengths = pc.count_substring(chunks, b" ").to_numpy(zero_copy_only=False).astype(np.int64) + 1
    vocabulary = _Vocabulary()
    ids = vocabulary.encode(b" ".join(chunks.to_pylist()).split(b" "))
    words = pa.array(list(vocabulary.numbers), pa.binary())
    keys = pc.binary_join_element_wise(pa.scalar(lang.encode()), words, b"\t")
    ends = np.cumsum(lengths)
    at = np.arange(len(ids))
    stop = np.repeat(ends, lengths)
    if BREAK in vocabulary.numbers:
        breaks = np.where(ids == vocabulary.numbers[BREAK], at, len(ids))
        stop = np.minimum(stop, np.minimum.accumulate(breaks[::-1])[::-1])
    begin = np.flatnonzero((at - np.repeat(ends - lengths, lengths) < np.repeat(fresh, lengths)) & (at + min(sizes) <= stop))
    held = None
    if bits is not None and len(begin):
        part = min(sizes) - 1
        hashes = vocabulary.hashes(lang)
        whole = np.flatnonzero(at + part <= stop)
        held = np.zeros(len(ids) + 1, bool)
        held[whole] = _is_set(bits, fold([hashes[ids[whole + k]] for k in range(part)]))
        begin = begin[held[begin] & held[begin + 1]]
    weights = np.repeat(times, lengths)
    for size in range(min(sizes), max(sizes) + 1):
        if size > min(sizes):
            begin = begin[begin + size <= stop[begin]]
            begin = begin if held is None else begin[held[begin + size - part]]
        if size in sizes and len(begin):
            yield _summed(ids, begin, size, weights, words, keys)


def _summed(
    ids: np.ndarray, begin: np.ndarray, size: int, weights: np.ndarray, words: pa.Array, keys: pa.Array
) -> tuple[pa.Array, np.ndarray]:
    """Keys of the distinct phrases of `size` words that begin at the given places, and the sums of their weights."""
    code = ids[begin]
    if size == 1 and int(weights.sum()) < 1 << 53:  # up to there float64 sums are exact
        counts = np.bincount(code, weights[begin], len(words)).astype(np.int64)
        return keys.filter(pa.array(counts > 0)), counts[counts > 0]
    for k in range(1, size):
        code = np.unique(code, return_inverse=True)[1] if k > 1 else code
        code = code * len(words) + ids[begin + k]
    order = np.argsort(code)
    first = np.flatnonzero(np.diff(code[order], prepend=-1))
    counts = np.add.reduceat(weights[begin][order], first)
    example = begin[order[first]]
    columns = [(words if k else keys).take(pa.array(ids[example + k])) for k in range(size)]
    return (pc.binary_join_element_wise(*columns, b" ") if size > 1 else columns[0]), counts


def count_phrases(dictionary: DataFrame, sizes: tuple[int, ...], bits: np.ndarray | None = None) -> DataFrame:
    """lang, phrase, f and size of all phrases of so many words whose shorter phrases have their bit set; of all without `bits`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.binary_length(batch.column("chunk")).to_pylist()
            for first, last in runs_by_size(lengths, RUN_BYTES):
                rows = batch.slice(first, last - first)
                for lang in pc.unique(rows.column("lang")).to_pylist():
                    ours = rows.filter(pc.equal(rows.column("lang"), lang))
                    for keys, counts in count_in_chunks(
                        lang, ours.column("chunk"), ours.column("fresh").to_numpy().astype(np.int64),
                        ours.column("times").to_numpy(), sizes, bits,
                    ):
                        yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], names=["key", "f"])

    # Language and phrase travel as one key; a phrase holds no tab.
    found = dictionary.select("lang", "fresh", "chunk", "times").mapInArrow(run, "key binary, f long")
    key = F.col("key").cast("string")
    phrase = F.substring_index(key, "\t", -1)
    lang = F.substring(key, F.lit(1), F.char_length(key) - F.char_length(phrase) - 1)
    size = F.char_length(phrase) - F.char_length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1
    return found.groupBy("key").agg(F.sum("f").alias("f")).select(lang.alias("lang"), phrase.alias("phrase"), "f", size.cast("int").alias("size"))


def mine(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = MOST_WORDS, least_count: int = LEAST_COUNT,
    held_percent: int = HELD_PERCENT, per_language: int = PER_LANGUAGE, spacing: int = SPACING,
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Words are lower-cased in A-Z; phrases lie within pieces, which end at
    `.,;:!?` and line breaks. `a` counts the phrase; of its cuts into a first
    part (counted `l`) and the rest (`r`) the one with the lowest
    score = floor(2000000 a / (l + r)) is given, of equal ones the shortest
    first part. `n` counts all words of the language. A phrase is left out if
    it lies inside a longer frequent one that has at least `held_percent` of
    its count. Ranked by score, then count, then the phrase itself in bytes.

    A null language is `und`, a null text is empty. Rows equal in all columns
    count each. Texts without words, empty tables and languages without a
    frequent phrase give no rows; other columns are not read. A text, and a
    chunk without a trigger, is held by one task.
    """
    if most_words < 2:
        raise ValueError("a phrase has two words or more")
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).cast("binary").alias("text")
    )
    dictionary = parse(rows, most_words - 1, spacing)
    words = staged(count_phrases(dictionary, (1,)), "words")
    totals = staged(words.groupBy("lang").agg(F.sum("f").alias("n")), "language-totals")
    frequent = F.col("f") >= least_count
    levels = [words.where(frequent)]
    for sizes in ((2,), tuple(range(3, most_words + 1))):
        if sizes:
            counted = count_phrases(dictionary, sizes, frequent_bits(levels[-1]))
            levels.append(staged(counted.where(frequent), "phrases"))
    counts = reduce(DataFrame.unionByName, levels)
    counts = staged(counts, "frequent")
    chosen = staged(rank(without_held(score(counts), held_percent), per_language), "chosen")
    return chosen.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _part(start, length):
    """Some words of the phrase in `words`, joined."""
    return F.array_join(F.slice("words", start, length), " ")


def score(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more of `counts` (lang, phrase, f, size) with the lowest score of their cuts, in exact decimals."""
    phrases = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    known = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    cut = cut.join(known, ["lang", "first"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    value = F.expr(f"cast({SCORE_SCALE} as decimal(8,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("best")
    found = cut.groupBy("lang", "phrase", "size", "a").agg(best)
    return staged(found.select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score"), "scored")


def without_held(scored: DataFrame, held_percent: int) -> DataFrame:
    """Scored phrases but those inside a longer one with `held_percent` of their count; the longer one may itself be left out."""
    longer = scored.where("size > 2").select("lang", "a", "size", F.split("phrase", " ").alias("words"))
    inside = longer.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1))
    ).select("lang", _part(F.col("start"), F.col("length")).alias("phrase"), "a")
    held = inside.groupBy("lang", "phrase").agg(F.max("a").alias("held"))
    most, own = F.col("held").cast("decimal(19,0)") * 100, F.col("a").cast("decimal(19,0)") * held_percent
    return scored.join(held, ["lang", "phrase"], "left").where(F.col("held").isNull() | (most < own)).drop("held")


def rank(scored: DataFrame, per_language: int) -> DataFrame:
    """The first phrases of every language.

    Bins of scores are counted, and only the highest bins that hold the wanted
    number go on. These are ranked in parts, cut by hash, so that one task
    orders a bounded number at the end, also where many scores are equal.
    """
    binned = scored.withColumn("bin", F.floor(F.col("score") / SCORE_BIN))
    higher = Window.partitionBy("lang").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    counts = binned.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"))  # at most SCORE_SCALE / 2 / SCORE_BIN + 1 bins a language
    reached = counts.withColumn("before", F.coalesce(F.sum("n").over(higher), F.lit(0))).where(F.col("before") < per_language)
    top = binned.join(reached.select("lang", "bin"), ["lang", "bin"], "left_semi").drop("bin")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))
    ours = Window.partitionBy("lang", "salt").orderBy(*order)
    few = top.withColumn("salt", salt).withColumn("rank", F.row_number().over(ours)).where(F.col("rank") <= per_language)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= per_language)
