"""Extra and clashing columns, repeated rows and null ids where the other tests have none."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from loanbook.llm import line_quality
from loanbook.llm.fingerprint import fingerprint_documents
from loanbook.llm.page_text import extract
from loanbook.llm.url_filter import filter_urls

NAMES = (
    "text", "n_chars", "row", "host", "path", "rule", "verdict", "part", "place", "next_part", "side", "length", "fingerprint", "near_next",
    "expression", "prefix", "digest", "rest", "kept",
)


def clash(frame, own):
    return frame.withColumns({name: F.lit(f"own {name}") for name in NAMES if name not in own})


def rows_of(frame):
    return Counter(map(str, frame.collect()))


def test_fingerprints_of_odd_rows(odd, nothing):
    plain = odd.select("doc_id", "text")
    got = fingerprint_documents(clash(odd, ("doc_id", "text")))
    assert got.count() == odd.count() and got.columns == fingerprint_documents(plain).columns
    assert rows_of(got) == rows_of(fingerprint_documents(plain))
    assert fingerprint_documents(clash(nothing, ("doc_id", "text"))).collect() == []


def test_urls_of_odd_rows(spark):
    urls = ["http://a.net/x", "http://a.net/x", None, "", "http://example.com/de/1", "HTTP://Example.NET/en/2"]
    pages = spark.createDataFrame([(i % 4 if i else None, u) for i, u in enumerate(urls * 2)], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow")], "host string, path string, verdict string")
    rules = rules.withColumns({"page_id": F.lit(1), "url": F.lit("own"), "rule": F.lit("own")})
    got, want = filter_urls(clash(pages, ("page_id", "url")), rules), filter_urls(pages, rules.select("host", "path", "verdict"))
    assert got.columns == want.columns and got.count() == len(urls) * 2 and rows_of(got) == rows_of(want)
    assert Counter(r.verdict for r in got.collect()) == {"block": 4, "allow": 8}


def test_pages_of_odd_rows(spark):
    html = ["<p>Some text here.</p>", "<p>Some text here.</p>", None, "", "<p>" + "long words " * 30_000 + "</p>"]
    pages = spark.createDataFrame([(i if i else None, "u", h) for i, h in enumerate(html)] * 2, "page_id long, url string, html string")
    got = extract(clash(pages, ("page_id", "url", "html")))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and rows_of(got) == rows_of(extract(pages))
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 0, 0, 15, 15, 15, 15, 329_999, 329_999]


def test_halves_of_joined_texts_are_told_apart(spark):
    """A good and a bad document joined: the chain tells their lines apart."""
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = line_quality.train(docs, labels)
    rows = docs.join(labels, "doc_id").where("size(split(text, '\\n')) between 5 and 60").orderBy("doc_id").select("text", "quality").collect()
    good, bad = ([r.text for r in rows if r.quality == q][:20] for q in (1, 0))
    apart = [line_quality_of(model, a, b) for a, b in zip(good, bad, strict=False)]
    assert len(apart) >= 10 and np.mean(apart) >= 0.7


def line_quality_of(model, good, bad):
    """Whether the whole of the two scores between its halves, and nearer to neither end than they do."""
    first, second, both = model.score([good, bad, good + "\n" + bad])
    return first > both > second and first - second > 0.2
