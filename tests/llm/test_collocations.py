"""Collocations against loops over words, and the parse against the texts it stands for."""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanbook.llm import collocations
from loanbook.llm.collocations import BREAK, cuts, mine, parse, tokens_of

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
NAMES = "lang string, text string"


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def plain(rows, most_words=4, least=30, held=80, best=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for words in pieces(text):
            for size in range(1, most_words + 1):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in frequent.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    most[p[i : i + size]] = max(most[p[i : i + size]], a)
        chosen = []
        for p, a in frequent.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * most[p] < held * a:
                chosen.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for place, (score, a, phrase, left, right) in enumerate(sorted(chosen)[:best], 1):
            out.append((lang, place, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=200)
@given(st.text(st.sampled_from("aB .,\n\t\r\x0b\x1c é") | st.characters(codec="utf-8"), max_size=40))
def test_tokens(text):
    split, now = [], []
    for token in [*tokens_of(text.encode()), BREAK]:
        if token == BREAK:
            split += [now] if now else []
            now = []
        else:
            now.append(token.decode())
    assert split == list(pieces(text))


@pytest.mark.parametrize("spacing", (1, 3, 24, 10**9))
def test_parse_gives_every_phrase_once(spark, spacing):
    texts = ["a b c d e f g h i j", "a b c d e f g h i j", "la " * 50, "x", "", None, "a. b. c d, e f g h i j k l m n"] * 2
    rows = spark.createDataFrame([("en", t) for t in texts], NAMES).withColumn("text", F.col("text").cast("binary"))
    found = Counter()
    for r in parse(rows, 3, spacing).collect():
        words = bytes(r.chunk).split(b" ")
        assert r.fresh <= len(words) <= r.fresh + 3
        for size in range(1, 5):
            for i in range(min(r.fresh, len(words) - size + 1)):
                if BREAK not in words[i : i + size]:
                    found[tuple(words[i : i + size])] += r.times
    want = Counter()
    for t in texts:
        for words in pieces(t):
            for size in range(1, 5):
                want.update(tuple(w.encode() for w in words[i : i + size]) for i in range(len(words) - size + 1))
    assert found == want


def test_equal_passages_are_cut_alike():
    passage = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    one = np.concatenate((np.arange(7, dtype=np.uint64), passage))
    a, b = cuts(passage, np.array([500]), 3, 24), cuts(one, np.array([507]), 3, 24) - 7
    assert set(a[a > 0]) == set(b[b > 0])


@pytest.mark.parametrize("run, bits, spacing", ((6 << 20, 24, 24), (200, 24, 5), (100, 15, 1)))
def test_equals_the_loops_on_the_given_documents(spark, small, monkeypatch, run, bits, spacing):
    """A bitmap with many shared bits, small runs and other cuts give the same rows."""
    monkeypatch.setattr(collocations, "RUN_BYTES", run)
    monkeypatch.setattr(collocations, "MAP_BITS", bits)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()][: 200 if run > 1000 else 60]
    frame = spark.createDataFrame(rows, NAMES)
    assert got(mine(frame, least_count=5, spacing=spacing)) == plain(rows, least=5)
    if run > 1000:
        assert got(mine(frame, least_count=3, per_language=10, most_words=3)) == plain(rows, 3, 3, best=10)


def test_odd_rows(spark, odd):
    rows = [(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()]
    more = [("en", "New York City is. new york, NEW YORK city"), (None, "a b a b a b"), ("und", "a b"), ("xx", "?!. ,\n"), ("de", None)] * 4
    clash = {c: F.lit("x") for c in ("fresh", "chunk", "times", "phrase", "f", "a", "l", "r", "n", "rank", "size", "held", "salt", "first")}
    frame = odd.select("lang", "text").unionByName(spark.createDataFrame(more, NAMES)).withColumns(clash)
    assert got(mine(frame, least_count=3)) == plain(rows + more, least=3)
    assert got(mine(frame, least_count=2, held_percent=100)) == plain(rows + more, least=2, held=100)


def test_empty(spark, nothing):
    assert mine(nothing).collect() == []
    assert mine(spark.createDataFrame([("en", "a b"), (None, None)], NAMES)).collect() == []


def test_scores_of_very_large_counts_are_exact(spark):
    big = 2**61 + 1
    counts = spark.createDataFrame([("en", "a", big, 1), ("en", "b", big + 2, 1), ("en", "a b", big, 2)], "lang string, phrase string, f long, size int")
    row = collocations.score(counts).first()
    assert (row.score, row.l, row.r) == (2000000 * big // (2 * big + 2), big, big + 2)


@pytest.mark.parametrize("best", (1, 7, 400))
def test_rank_of_equal_and_crowded_scores(spark, best):
    pick = np.random.default_rng(best)
    rows = [(str(pick.choice(["en", "fr", "de"])), f"p{i}", int(pick.choice([5, 999, 1000, 1000, 1000, 250_000, 999_999])), int(pick.integers(30, 33))) for i in range(3000)]
    rows += [("xx", "alone", 0, 30)]
    got = collocations.rank(spark.createDataFrame(rows, "lang string, phrase string, score long, a long").repartition(7), best)
    want = []
    for lang in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[2], -r[3], r[1]))
        want += [(lang, k, r[1]) for k, r in enumerate(order[:best], 1)]
    assert sorted((r.lang, r["rank"], r.phrase) for r in got.collect()) == sorted(want)
