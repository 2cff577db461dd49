"""Decontamination and phrase search against loops over words."""

from __future__ import annotations

import hashlib
import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanbook.llm import positional_index
from loanbook.llm.decontaminate import decontaminate
from loanbook.llm.positional_index import build_index, search, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = plain_words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[at : at + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for k in {len(x) for x in wins}:
            for at in range(len(w) - k + 1):
                items_here = wins.get(tuple(w[at : at + k]))
                if items_here:
                    hit.update(range(at, at + k)), found.update(items_here)
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(df):
    rows = df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    return sorted((tuple(r) for r in rows), key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


@settings(max_examples=200)
@given(st.text(st.sampled_from("aZ09 \t\n.-_é漢\x00\x7f@[`{") | st.characters(codec="utf-8"), max_size=40))
def test_words(text):
    assert [w.decode() for w in words_of(text.encode())] == plain_words(text)


ONE = "one two three four five six seven eight nine ten"
ODD_ITEMS = [
    (1, ONE + " eleven"), (2, ONE), (3, "Short Item"), (4, None), (5, ""), (6, "?!"), (None, "no id here at all"), (7, "ÀÉ漢字 b"),
    (1, "second row of item one"), (8, " ".join("la" for _ in range(12))), (2, ONE),
]


@pytest.mark.parametrize("block_bytes, chunk", ((64, 3), (8 << 20, 200_000)))
def test_odd_rows_equal_the_loops(spark, odd, monkeypatch, block_bytes, chunk):
    monkeypatch.setattr(positional_index, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(positional_index, "CHUNK_PHRASES", chunk)
    extra = [
        (50, "x " + ONE.upper() + " eleven y"), (51, ONE), (51, ONE), (52, "one two three four five six seven eight nine"),
        (53, "a short-item, short ITEM."), (54, "àé漢字 b ÀÉ漢字 b"), (55, "la " * 30), (56, "no id here at all short"), (57, "ten " + ONE + " " + ONE),
        (None, "second row of item one"), (58, "short"), (59, "item"),
    ]
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()] + extra
    clash = {c: F.lit("x") for c in ("block", "term", "n", "gaps", "starts", "place", "hits", "phrase", "words", "item_id", "n_words")}
    rows, items = frames(spark, docs, ODD_ITEMS)
    rows = rows.withColumns(clash)
    items = items.withColumns({c: F.lit("x") for c in ("phrase", "words", "doc_id", "phrase_no", "term_no")})
    assert got(decontaminate(rows, items)) == plain(docs, ODD_ITEMS)


def test_empty_tables(spark, nothing):
    _, items = frames(spark, [], ODD_ITEMS)
    assert decontaminate(nothing, items).collect() == []
    docs, none = frames(spark, [(1, ONE), (2, None)], [])
    assert got(decontaminate(docs, none)) == plain([(1, ONE), (2, None)], [])
    _, wordless = frames(spark, [], [(4, None), (5, "...")])
    assert got(decontaminate(docs, wordless)) == plain([(1, ONE), (2, None)], [])


def test_hits_and_items_are_returned(spark):
    docs, items = frames(spark, [(1, "x " + ONE + " eleven y short item")], ODD_ITEMS)
    row = decontaminate(docs, items).first()
    assert [(h.start, h.end) for h in row.hits] == [(1, 11), (2, 12), (13, 15)] and row["items"] == ["1", "2", "3"]


def test_windows_of_documents_are_found_in_all_that_hold_them(spark, texts):
    """Passages cut out of the documents themselves, common words and all."""
    held = [(i, " ".join(plain_words(t)[5:40])) for i, t in texts[::7] if len(plain_words(t)) > 8]
    docs, items = frames(spark, texts, held)
    assert got(decontaminate(docs, items)) == plain(texts, held)


def near(words, phrase, slop, totals):
    """Places of the phrase's rarest word with every other word at most slop places from its own."""
    offset = min(range(len(phrase)), key=lambda k: (totals[phrase[k]], k))
    found = []
    for at, word in enumerate(words):
        if word == phrase[offset] and all(
            any(words[p] == w for p in range(max(0, at - offset + k - slop), min(len(words), at - offset + k + slop + 1)))
            for k, w in enumerate(phrase)
        ):
            found.append(at)
    return found


@pytest.mark.parametrize("slop", (0, 1, 3))
def test_proximity(spark, slop, monkeypatch):
    monkeypatch.setattr(positional_index, "BLOCK_BYTES", 50)
    monkeypatch.setattr(positional_index, "RUN_CANDIDATES", 4)
    import random

    pick = random.Random(slop)
    docs = [(i, " ".join(pick.choice("abcde") for _ in range(pick.randint(0, 30)))) for i in range(40)]
    phrases = [(k, [pick.choice("abcde").encode() for _ in range(pick.randint(1, 4))]) for k in range(25)] + [(90, [b"zz", b"a"]), (91, [])]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = build_index(rows)
    found = search(index, spark.createDataFrame(phrases, "phrase_no long, words array<binary>"), slop)
    hits = found.join(index.rows(), ["block", "place"]).select("doc_id", F.explode("hits").alias("h")).collect()
    totals = {w.encode(): sum(t.split().count(w) for _, t in docs) for w in "abcde"}
    want = []
    for doc, text in docs:
        for k, phrase in phrases:
            if phrase and all(w in totals for w in phrase):
                want += [(doc, k)] * len(near([w.encode() for w in text.split()], phrase, slop, totals))
    assert sorted((r.doc_id, r.h.phrase_no) for r in hits) == sorted(want)
    if slop == 0:
        words = {doc: text.split() for doc, text in docs}
        assert all([w.encode() for w in words[r.doc_id][r.h.start : r.h.end]] == dict(phrases)[r.h.phrase_no] for r in hits)
