"""Exact dedup, URL rules and sharding against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import threading
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loanbook.llm.common import scratch_dropped, staged
from loanbook.llm.queries import LLM_QUERIES
from loanbook.llm.radix_dedup import radix_dedup
from loanbook.llm.shards import hash_bits, shard, write_shards
from loanbook.llm.url_filter import filter_urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for doc_id in ids:
            out[doc_id, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    return out, len(groups)


@pytest.mark.parametrize("width,growth", [(64, 8), (1, 2), (3, 1)])
def test_dedup_is_equality(spark, odd, width, growth):
    rows = odd.where("length(text) < 100 or text is null") if growth == 1 else odd
    got = radix_dedup(rows, first_width=width, growth=growth).collect()
    want, groups = plain_dedup([(r.doc_id, r.text) for r in rows.select("doc_id", "text").collect()])
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_dedup_carries_rows(odd, nothing):
    kept = radix_dedup(odd, carry=odd.columns).where("kept").select("row.*")
    assert kept.dtypes == odd.dtypes
    assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in odd.collect()}
    assert radix_dedup(nothing).collect() == []


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(LOWER)
    fits = [(len(h) + len(p), v == "block", h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, False, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_against_all_rules(spark):
    rng = random.Random(3)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/en/x", "block"), ("org", "", "block"),
             ("b.org", "/", "allow"), ("b.org", "/", "block"), ("com", "/a/b/c/", "block")]
    hosts = ["net", "NET", "example.net", "x.a.Example.NET", "org", "b.org", "c.b.org", "q.com", "notnet", "", "..net", "ÉX.net"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/en/xy/z", "/a/b/c/d", "/a/b/c", "//", "/en/?q=/x", "#/en/", "?a://b"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "http:/net/", "x://" + "a." * 300 + "net" + "/y" * 500]
    pages = spark.createDataFrame([(i if rng.random() < 0.9 else None, u, "own") for i, u in enumerate(urls)], "page_id long, url string, host string")
    book = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, book).collect())
    assert got == Counter((r.page_id, *plain_verdict(r.url, rules)) for r in pages.collect())
    assert {r.verdict for r in filter_urls(pages, book.limit(0)).collect()} == {"allow"}
    assert filter_urls(pages.limit(0), book).collect() == []


def plain_shards(rows, limit):
    """The extendible hashing of (bits, bytes), one bucket at a time."""
    out, todo = {}, [""]
    while todo:
        prefix = todo.pop()
        held = [r for r in rows if r[0].startswith(prefix)]
        if held and (sum(r[1] for r in held) <= limit or len(held) == 1):
            out.update({r[0]: (prefix, sum(x[1] for x in held), len(held)) for r in held})
        elif held:
            todo += [prefix + "0", prefix + "1"]
    return out


@pytest.mark.parametrize("limit", [200, 5_000, 10**9])
def test_shards_against_plain_splitting(spark, texts, limit):
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in shard(rows, limit).collect()}
    bits = {r.doc_id: r.bits for r in rows.select("doc_id", hash_bits(rows.doc_id).alias("bits")).collect()}
    want = plain_shards([(bits[i], len((t or "").encode())) for i, t in texts], limit)
    assert {i: (r.shard, r.shard_bytes, r.shard_rows) for i, r in got.items()} == {i: want[bits[i]] for i, _ in texts}
    assert all(r.fits or r.shard_rows == 1 for r in got.values())


def test_shards_split_one_key_and_equal_rows(spark, odd, nothing):
    hot = spark.createDataFrame([(1, "same text")] * 300 + [(1, f"text {i}") for i in range(300)] + [(None, None)] * 50, "doc_id long, text string")
    got = shard(hot, 100).collect()
    assert len(got) == 650 and all(r.fits for r in got)
    assert Counter(r.shard for r in got) == {r.shard: r.shard_rows for r in got}
    assert len(shard(odd, 64).collect()) == odd.count()
    assert shard(nothing, 10).collect() == []
    with pytest.raises(ValueError):
        shard(nothing, 0)


def test_the_query_splits_a_table_of_some_mebibytes(spark):
    got = LLM_QUERIES["op7_sharding"](spark, "/root/testdata/sf0.1").select("shard", "depth", "shard_bytes", "fits").distinct().collect()
    assert len(got) > 8 and all(r.fits and r.depth > 0 and r.shard_bytes <= 1 << 20 for r in got)


def test_written_shards_hold_every_row_once(spark, odd, nothing, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(odd, path, 64)
    back = spark.read.parquet(path)
    names = [c for c in odd.columns if c != "shard"]
    assert Counter(map(str, back.select(names).collect())) == Counter(map(str, odd.select(names).collect()))
    sizes = back.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    assert len(sizes) > 3 and all(r.n <= 64 or r.rows == 1 for r in sizes) and all(r.shard.startswith("b") for r in sizes)
    write_shards(nothing, str(tmp_path / "none"), 64)


def test_threads_do_not_drop_each_others_tables(spark):
    """A block of one thread ends while another thread still reads what it staged in its own."""
    ready, done = threading.Event(), threading.Event()
    found = {}

    def long_run():
        with scratch_dropped(spark):
            table = staged(spark.range(7).toDF("n"), "long")
            ready.set()
            done.wait(60)
            found["rows"] = table.count()
            found["file"] = table.inputFiles()[0]

    worker = threading.Thread(target=long_run)
    with scratch_dropped(spark):
        worker.start()
        ready.wait(60)
        mine = staged(spark.range(3).toDF("n"), "short").inputFiles()[0]
    done.set()
    worker.join()
    exists = [Path(f.removeprefix("file://")).exists() for f in (mine, found["file"])]
    assert found["rows"] == 7 and exists == [False, False]
