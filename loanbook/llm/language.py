"""Language identification by multilingual mixture inference.

A model holds, for each language, the smoothed probabilities of hashed
character trigrams, counted over all training documents. A document is a
mixture of languages: expectation-maximisation finds the proportions that make
its trigrams likeliest. The set of languages grows in the order of their
proportions as long as the likelihood, less a penalty per language, rises; the
proportions within that set give the prediction.

A proportion says nothing of how well a text fits: gibberish also has a likeliest
language. The fit of a text is its mean log-likelihood per trigram under its
mixture; `learn_fit` takes the distribution of fits over the rows the model
learned from, and a text is judged by how far it lies below their mean, in
standard deviations of a text of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import judged

BUCKETS = 1 << 15  # hashed trigrams; with the number of languages this bounds the model
SMOOTHING = 0.5
ROUNDS = 12
DOUBT = 256.0  # trigrams of doubt about every language
PENALTY = 4.0  # per language, in units of log(number of trigrams)
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
OTHERS = regex.compile(r"[^\p{L}\p{M}]+")
SLICE = 1 << 20  # characters hashed at a time
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def trigram_counts(text: str) -> np.ndarray:
    """How often each bucket of trigrams occurs in a lower-cased text; runs of characters other than letters are a space."""
    words = OTHERS.sub(" ", text.lower())
    codes = np.frombuffer(f" {words.strip()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(codes) - 2, SLICE):
        part = codes[at : at + SLICE + 2].astype(np.uint64)
        mixed = part[:-2] * MIX[0] + part[1:-1] * MIX[1] + part[2:] * MIX[2]
        bucket = (mixed ^ (mixed >> np.uint64(29))) * MIX[0] >> np.uint64(49)
        counts += np.bincount(bucket.astype(np.int64), minlength=BUCKETS)
    return counts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language of one partition."""
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            counts = trigram_counts(text.as_py())
            if lang in found:
                found[lang] += counts
            else:
                found[lang] = counts
    for lang, counts in found.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))],
            names=["lang", "bucket", "n"],
        )


class Model:
    """Languages and the probabilities of the buckets in each."""

    def __init__(self, langs: list[str], prob: np.ndarray) -> None:
        self.langs, self.prob = langs, prob

    @staticmethod
    def of_counts(langs: list[str], counts: np.ndarray) -> Model:
        """From the counts of each language's buckets, smoothed."""
        smooth = counts.astype(np.float64) + SMOOTHING
        return Model(langs, (smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))

    def mixture(self, text: str) -> np.ndarray:
        """Proportions of all languages in a text; zeros if it has no letter or nothing was learned."""
        return self.measured(text)[0]

    def measured(self, text: str) -> tuple[np.ndarray, float, float, float]:
        """The proportions; mean and variance of the log-likelihood of a trigram; number of trigrams."""
        share = np.zeros(len(self.langs))
        if not self.langs or not LETTER.search(text):
            return share, 0.0, 0.0, 0.0
        counts = trigram_counts(text)
        at = np.flatnonzero(counts)
        if not len(at):
            return share, 0.0, 0.0, 0.0
        n, prob = counts[at].astype(np.float32), self.prob[at]
        total = float(n.sum())
        if len(self.langs) == 1:
            share[0] = 1
        else:
            full, _ = fit_mixture(prob, n, np.full(len(self.langs), 1 / len(self.langs), np.float32))
            order = np.argsort(-full, kind="stable")
            best = None
            for size in range(1, len(order) + 1):
                chosen = order[:size]
                start = full[chosen] / max(full[chosen].sum(), 1e-12) if size > 1 else np.ones(1, np.float32)
                part, likelihood = fit_mixture(prob[:, chosen], n, start.astype(np.float32), 1 if size == 1 else ROUNDS)
                scored = likelihood - PENALTY * size * np.log(total + 1)
                if best is not None and scored <= best[0]:
                    break
                best = scored, chosen, part
            share[best[1]] = best[2]
        logs = np.log(np.maximum(prob @ share, 1e-12))
        mean = float(n @ logs) / total
        return share, mean, float(n @ (logs - mean) ** 2) / total, total

    def predict(self, text: str) -> tuple[str, float]:
        return self.named(self.mixture(text))

    def named(self, share: np.ndarray) -> tuple[str, float]:
        if not share.any():
            return UNKNOWN, 0.0
        top = int(share.argmax())
        return self.langs[top], float(min(1.0, share[top]))


class Fit(NamedTuple):
    """Distribution of fits: their mean, the variance between texts and that of one trigram within a text, and the trigrams learned per language."""

    learned: dict[str, float]
    mean: float
    between: float
    within: float

    def deviation(self) -> Column:
        """Standard deviations of a measured text's fit above the mean; 0 for a text without trigrams.

        What is known of a language is as uncertain as its learned text is
        short: the variance of DOUBT trigrams over those learned is added, so
        texts of a language that hardly taught anything deviate little.
        """
        if not self.learned:
            return F.lit(0.0)
        learned = F.create_map(*[F.lit(x) for pair in self.learned.items() for x in pair])[F.col("lang_pred")]
        variance = F.lit(self.between) + F.lit(self.within) * (1 / F.greatest("trigrams", F.lit(1.0)) + DOUBT / learned)
        far = (F.col("fit_mean") - self.mean) / F.sqrt(variance)
        return F.when((F.col("trigrams") > 0) & learned.isNotNull() & (variance > 0), far).otherwise(0.0)


def fit_mixture(prob: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Expectation-maximisation of mixture proportions, and the log-likelihood reached."""
    share = start
    total = n.sum()
    for _ in range(rounds):
        new = share * ((n / (prob @ share)) @ prob) / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float((n * np.log(prob @ share)).sum())


def _taught(docs: DataFrame, text_col: str, lang_col: str, where: Column | None) -> DataFrame:
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), (F.lit(True) if where is None else where).alias("use"))
    return rows.where("use and text is not null and lang is not null").select("text", "lang")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", where: Column | None = None) -> Model:
    """Count trigrams over all rows with a language; the driver gets at most BUCKETS counts per language.

    Rows with a null text or language teach nothing. There are as many
    languages as distinct labels, a few hundred for real language codes.
    """
    rows = _taught(docs, text_col, lang_col, where)
    counts = rows.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    langs, place = np.unique(np.array(table.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
    dense = np.zeros((len(langs), BUCKETS), np.int64)
    dense[place, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return Model.of_counts(langs.tolist(), dense)


MEASURES = "lang_pred string, score double, fit_mean double, fit_variance double, trigrams double"


def measure(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Per row: struct `row` of the given `columns` (all by default), lang_pred, score, fit_mean, fit_variance and trigrams.

    `score` is the share of the predicted language in the text; the fit is the
    mean log-likelihood of its trigrams, with their variance and number. A null
    text or one without a letter is `und` with score 0 and no trigrams, and so
    is every text if nothing was learned. Repeated rows and nulls in the columns
    stay as they are; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.prob))

    def judge(texts: pa.Array) -> list[pa.Array]:
        model = Model(*shared.value)
        measured = [model.measured(text.as_py() or "") for text in texts]
        named = [model.named(share) for share, *_ in measured]
        numbers = [[f[1] for f in named], *[[m[k] for m in measured] for k in (1, 2, 3)]]
        return [pa.array([f[0] for f in named], pa.string()), *[pa.array(x, pa.float64()) for x in numbers]]

    return judged(docs, text_col, columns or docs.columns, judge, MEASURES)


def identify(docs: DataFrame, model: Model, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """Per row: struct `row` of the given `columns` (all by default), lang_pred and score, as `measure` has them."""
    return measure(docs, model, text_col, columns).select("row", "lang_pred", "score")


def learn_fit(measured: DataFrame, lang: Column, where: Column | None = None) -> Fit:
    """Distribution of the fits of the measured rows (in `where`) with a language; the driver gets a row per language."""
    mean, variance, n = F.col("fit_mean"), F.col("fit_variance"), F.col("trigrams")
    sums = {"texts": F.lit(1.0), "fits": mean, "squares": mean * mean, "inverse": 1 / n, "spread": n * variance, "taught": n}
    taught = lang.isNotNull() & (n > 0)
    rows = measured.where(taught if where is None else taught & where).groupBy(lang.alias("lang"))
    table = rows.agg(*[F.sum(value).alias(name) for name, value in sums.items()]).toArrow().sort_by("lang")
    if not table.num_rows:
        return Fit({}, 0.0, 0.0, 0.0)
    texts, fits, squares, inverse, spread, taught = (sum(table.column(name).to_pylist()) for name in sums)
    mean, within = fits / texts, spread / taught
    between = max(0.0, squares / texts - mean * mean - within * inverse / texts)
    learned = dict(zip(table.column("lang").to_pylist(), table.column("taught").to_pylist(), strict=True))
    return Fit(learned, mean, between, within)
