"""Document quality by a linear-chain conditional random field over lines.

Every line gets features of its own text (shares of character classes, repeated
words, shape of words) and those of the lines before and after it. A chain with
the labels bad and good scores each line and each step between lines; forward
and backward recursions give the probability that a line is good given the
whole document, and the mean of these, weighted by line length, is the quality
of the document.

Training labels are per document: every line of a training document carries the
document's label. The fit uses a bounded sample: at most SAMPLE_DOCS rows that
have a label, those with the smallest hash of id, text and number among equal
rows, and at most SAMPLE_LINES consecutive lines of each. Scoring reads whole
texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import judged, runs_by_size

SAMPLE_DOCS = 4000
SAMPLE_LINES = 100
COPIES = 1 << 16  # equal rows numbered at a time
CHUNK_CHARS = 1 << 19  # characters whose features are computed at a time; a longer text stands alone
ROUNDS = 200
RATE = 0.1
RIDGE = 0.02
THRESHOLD = 0.7

LOWER, UPPER, DIGIT, SPACE, POINT, SYMBOL = range(6)
BASE = (
    "length", "upper", "digit", "space", "point", "symbol", "words", "word_length", "same_as_last", "distinct",
    "symbol_end", "bare_symbol", "closed", "repeated", "capital_words",
)
BINNED = ("upper", "digit", "symbol", "same_as_last", "symbol_end", "bare_symbol", "capital_words")
CUTS = (0.05, 0.25)


_TABLES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Class of each code point of the basic plane; what lies beyond counts as a symbol. Made once."""
    if _TABLES:
        return _TABLES[0]
    table = np.full(65536, SYMBOL, np.uint8)
    for code in range(65536):
        char = chr(code)
        if char.isspace():
            table[code] = SPACE
        elif char.isupper():
            table[code] = UPPER
        elif char.isalpha():
            table[code] = LOWER
        elif char.isdigit():
            table[code] = DIGIT
        elif char in ".,;:!?'\"()-":
            table[code] = POINT
    _TABLES.append(table)
    return table


def _starts(flags: np.ndarray) -> np.ndarray:
    """Where runs of true values begin."""
    return np.flatnonzero(flags & ~np.concatenate(([False], flags[:-1])))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, dtype=np.float64) if len(starts) else np.zeros(0)


def _repeats(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each item whether its owner has an equal value earlier."""
    order = np.lexsort((value, owner))
    same = np.zeros(len(order), bool)
    same[1:] = (owner[order][1:] == owner[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(order), bool)
    out[order] = same
    return out


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of some texts: the text's position, the length in characters, and the base features."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = np.where(codes < 65536, _classes()[np.minimum(codes, 65535)], np.uint8(SYMBOL))
    ends = np.flatnonzero(codes == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    text_of_line = np.repeat(np.arange(len(texts)), [t.count("\n") + 1 for t in texts])
    length = (ends - starts).astype(np.float64)
    chars = np.maximum(length, 1)
    per_class = [_sums(kind == k, starts) for k in range(6)]
    letters = np.maximum(per_class[LOWER] + per_class[UPPER], 1)

    inside = kind != SPACE
    word_at = _starts(inside)
    word_end = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False])))
    line_of_word = np.searchsorted(starts, word_at, side="right") - 1
    words = np.bincount(line_of_word, minlength=len(starts)).astype(np.float64)
    many = np.maximum(words, 1)
    begun = np.concatenate(([0], word_at))  # what stands before the first word is space and counts nothing
    within = np.arange(len(codes)) - np.repeat(begun, np.diff(np.append(begun, len(codes))))
    weight = (within.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = np.where(inside, (codes.astype(np.uint64) + np.uint64(1)) * (weight ^ (weight >> np.uint64(31))), np.uint64(0))
    word_hash = np.add.reduceat(mixed, word_at) if len(word_at) else np.zeros(0, np.uint64)
    text_of_word = text_of_line[line_of_word]
    same = np.zeros(len(word_at), bool)
    same[1:] = (word_hash[1:] == word_hash[:-1]) & (text_of_word[1:] == text_of_word[:-1])
    last = kind[word_end]
    bare = (last == SYMBOL) & (word_end == word_at)
    capital = (kind[word_at] == UPPER) & (word_end > word_at + 1) & (kind[np.minimum(word_at + 1, len(kind) - 1)] == UPPER)

    def per_line(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line_of_word, weights=flags, minlength=len(starts)) / many

    line_hash = np.bincount(line_of_word, minlength=len(starts)).astype(np.uint64)
    np.add.at(line_hash, line_of_word, word_hash)
    last_char = kind[np.maximum(ends - 1, 0)]
    features = np.stack([
        np.log1p(length) / 8, per_class[UPPER] / letters, per_class[DIGIT] / chars, per_class[SPACE] / (chars + 1),
        per_class[POINT] / chars, per_class[SYMBOL] / chars, np.log1p(words) / 6,
        (length + 1 - per_class[SPACE]) / many / 16, per_line(same), 1 - per_line(_repeats(line_of_word, word_hash)),
        per_line(last == SYMBOL), per_line(bare), ((last_char == POINT) & (length > 0)).astype(np.float64),
        _repeats(text_of_line, line_hash).astype(np.float64), per_line(capital),
    ], axis=1)
    return text_of_line, length, features.astype(np.float32)


def with_neighbours(text_of_line: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Inputs of the chain: own features and their bins, the features of the lines around, and a constant."""
    cut = [BASE.index(name) for name in BINNED]
    bins = [(base[:, cut] > c).astype(np.float32) for c in CUTS]
    before, after = np.zeros_like(base), np.zeros_like(base)
    follows = text_of_line[1:] == text_of_line[:-1]
    before[1:][follows] = base[:-1][follows]
    after[:-1][follows] = base[1:][follows]
    return np.concatenate([base, *bins, before, after, np.ones((len(base), 1), np.float32)], axis=1)


class Chains:
    """Documents as chains of lines, walked side by side, longest first."""

    def __init__(self, text_of_line: np.ndarray, n_texts: int) -> None:
        counts = np.bincount(text_of_line, minlength=n_texts)
        starts = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        self.first = starts[order]
        self.counts = counts[order]
        most = int(self.counts[0]) if n_texts else 0
        self.active = np.searchsorted(-self.counts, -np.arange(1, most + 1), side="right")

    def odds(self, unary: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward odds (good : bad) of every line; the marginal odds are their product."""
        pull = np.exp(np.clip(unary, -30, 30))
        move = np.exp(step)
        forward, backward = pull.copy(), np.ones_like(pull)
        for t in range(1, len(self.active)):
            at = self.first[: self.active[t]] + t
            r = forward[at - 1]
            forward[at] = pull[at] * (move[0, 1] + r * move[1, 1]) / (move[0, 0] + r * move[1, 0])
        for t in range(len(self.active) - 1, 0, -1):
            at = self.first[: self.active[t]] + t
            s = pull[at] * backward[at]
            backward[at - 1] = (move[1, 0] + move[1, 1] * s) / (move[0, 0] + move[0, 1] * s)
        return forward, backward


class LineModel:
    """Weights of the lines' features and of the steps between labels."""

    def __init__(self, weights: np.ndarray, step: np.ndarray) -> None:
        self.weights, self.step = weights, step

    def score(self, texts: list[str]) -> np.ndarray:
        """Quality of each text."""
        if not texts:
            return np.zeros(0)
        text_of_line, length, base = line_features(texts)
        unary = with_neighbours(text_of_line, base) @ self.weights
        forward, backward = Chains(text_of_line, len(texts)).odds(unary.astype(np.float64), self.step)
        odds = forward * backward
        good = odds / (1 + odds)
        weight = length + 1  # an empty line or text still has its line end
        total = np.bincount(text_of_line, weights=weight, minlength=len(texts))
        return np.bincount(text_of_line, weights=weight * good, minlength=len(texts)) / total


def fit(text_of_line: np.ndarray, base: np.ndarray, label_of_text: np.ndarray) -> LineModel:
    """Maximum conditional likelihood of the lines' labels, with a ridge, by full-batch Adam steps."""
    x = with_neighbours(text_of_line, base)
    n_texts = len(label_of_text)
    chains = Chains(text_of_line, n_texts)
    y = label_of_text[text_of_line].astype(np.float64)
    follows = np.flatnonzero(text_of_line[1:] == text_of_line[:-1]) + 1
    # A text counts as one example however many lines it has, and both labels count alike.
    share = np.where(label_of_text == 1, 0.5 / max(1, (label_of_text == 1).sum()), 0.5 / max(1, (label_of_text == 0).sum()))
    weight = (share / np.maximum(np.bincount(text_of_line, minlength=n_texts), 1))[text_of_line]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[follows - 1].astype(int), y[follows].astype(int)), weight[follows])
    params = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for k in range(1, ROUNDS + 1):
        step = params[-4:].reshape(2, 2)
        unary = x @ params[:-4]
        forward, backward = chains.odds(unary, step)
        odds = forward * backward
        good = odds / (1 + odds)
        into = np.exp(np.clip(unary[follows], -30, 30)) * backward[follows]
        r = forward[follows - 1]
        joint = np.stack([np.ones_like(r), into, r, r * into], axis=1) * np.exp(step).ravel()
        joint *= (weight[follows] / joint.sum(axis=1))[:, None]
        grad = np.concatenate([x.T @ (weight * (good - y)), (joint.sum(axis=0) - seen.ravel())]) + RIDGE * params / len(params)
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        params -= RATE * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-6)
    return LineModel(params[:-4].astype(np.float32), params[-4:].reshape(2, 2))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base features of at most SAMPLE_LINES consecutive lines of each text, from a place fixed by its length; equal rows once."""
    seen: set[int] = set()
    for batch in batches:
        new, rows = [], []
        for at, (place, text) in enumerate(zip(batch.column("place").to_pylist(), batch.column("text"), strict=True)):
            if place in seen:
                continue
            seen.add(place)
            _, _, base = line_features([text.as_py()])
            start = (len(text.as_py()) * 2654435761) % max(1, len(base) - SAMPLE_LINES + 1)
            new.append(at)
            rows.append(base[start : start + SAMPLE_LINES].tobytes())
        kept = batch.select(["place", "quality", "times"]).take(pa.array(new, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rows, pa.binary())], names=[*kept.schema.names, "lines"])


def _chosen(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The sample's texts by id and hash, how often each is in it, and a place in its order; at most SAMPLE_DOCS rows.

    Rows meet their labels before the sample is drawn, and without their texts.
    """
    equal = docs.groupBy("labelled", "text_hash").agg(F.count("*").alias("copies")).join(named, "labelled")
    runs = equal.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    last = F.least(F.col("first") + (COPIES - 1), F.col("copies") - 1)
    rows = runs.select("labelled", "text_hash", "quality", F.explode(F.sequence("first", last)).alias("copy"))
    rows = rows.withColumn("place", F.xxhash64("labelled", "text_hash", "copy"))
    drawn = rows.orderBy("place", "labelled", "text_hash", "copy").limit(SAMPLE_DOCS)
    return drawn.groupBy("labelled", "text_hash", "quality").agg(F.min("place").alias("place"), F.count("*").cast("int").alias("times"))


def train(docs: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> LineModel | None:
    """Fit the chain on a bounded sample of labelled rows; None if the sample lacks one of the two labels.

    `where` says which labelled ids may be used. An id with several labels takes
    the majority's, good on a tie; null labels and null ids teach nothing.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull())
    usable = usable if where is None else usable.where(where)
    named = usable.groupBy(F.col(id_col).alias("labelled")).agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("labelled"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    chosen = F.broadcast(_chosen(texts.select("labelled", "text_hash"), named))  # at most SAMPLE_DOCS rows
    sample = texts.join(chosen, ["labelled", "text_hash"]).select("place", "quality", "times", "text")
    once = sample.mapInArrow(_sample_features, "place long, quality int, times int, lines binary")
    found = once.groupBy("place", "quality", "times").agg(F.min("lines").alias("lines")).toArrow().sort_by("place")
    found = found.take(np.repeat(np.arange(found.num_rows), found.column("times").to_numpy()))
    label = np.array(found.column("quality").to_pylist(), dtype=np.int64)
    if len(set(label.tolist())) < 2:
        return None
    parts = [np.frombuffer(b, np.float32).reshape(-1, len(BASE)) for b in found.column("lines").to_pylist()]
    text_of_line = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return fit(text_of_line, np.concatenate(parts), label)


def score_documents(docs: DataFrame, model: LineModel | None, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Per row: struct `row` of the given `columns` (all by default), and `score`, the quality from 0 to 1.

    Null counts as empty; an empty text is one empty line. Without a model every
    score is 0.5. Repeated rows and nulls in the columns stay as they are; an
    empty table gives an empty result.
    """
    chosen = columns or docs.columns
    if model is None:
        return docs.select(F.struct(*[F.col(c) for c in chosen]).alias("row"), F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.step))

    def judge(texts: pa.Array) -> list[pa.Array]:
        model = LineModel(*shared.value)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        scores = [
            model.score([text or "" for text in texts.slice(start, end - start).to_pylist()])
            for start, end in runs_by_size(sizes, CHUNK_CHARS)
        ]
        return [pa.array(np.concatenate(scores) if scores else np.zeros(0))]

    return judged(docs, text_col, chosen, judge, "score double")
