"""Vector codes against plain Python integers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from loanbook.llm.vector_codes import compress, exact_products, limb_bits, limbs, nearest

NAMES = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The same by loops over Python integers: {vec_id: (code, error, label_error)} and the digest of the codebooks."""
    kept = [(i, [math.floor(scale * x) if abs(x) < 1e15 else int(x) * scale for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0))
    wide = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * wide : (p + 1) * wide]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def best(x, book):
        away = [sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)) for entry in book]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[best(cut(v, p), book)[0]].append(cut(v, p))
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else entry for e, entry in enumerate(book)]
    out, by_label = {}, defaultdict(int)
    for i, v, label in kept:
        found = [best(cut(v, p), book) for p, book in enumerate(books)]
        out[i] = "".join(f"{b:02x}" for b, _ in found), sum(e for _, e in found), label
        by_label[label] += out[i][1]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return {i: (code, error, by_label[label]) for i, (code, error, label) in out.items()}, digest


def found(df):
    rows = df.collect()
    assert len({r.codebooks_sha256 for r in rows}) <= 1
    return {r.vec_id: (r.code, r.error, r.label_error) for r in rows}, rows[0].codebooks_sha256


def test_products_are_exact():
    random = np.random.default_rng(5)
    for top in (5, 1 << 20, 1 << 27, 1 << 29):
        a, b = random.integers(-top, top, (40, 8)), random.integers(-top, top, (16, 8))
        assert (exact_products(a, b) == a @ b.T).all()
        assert (exact_products(-abs(a) - 1, abs(b)) == (-abs(a) - 1) @ abs(b).T).all()
    edge = np.array([[-(1 << 22), (1 << 22) - 1, 1 << 22, -1, 0, -(1 << 28), 1 << 28, 7]])
    assert exact_products(edge, edge)[0, 0] == sum(int(x) ** 2 for x in edge[0])
    assert 8 * (1 << limb_bits(8)) ** 2 <= 1 << 53
    for part in limbs(edge, limb_bits(8)):
        assert np.abs(part).max() <= 1 << limb_bits(8)


def test_ties_go_to_the_lower_entry_and_large_parts_are_exact():
    book = [[0, 0], [2, 0], [2, 0]]
    assert [x.tolist() for x in nearest(np.array([[1, 0], [2, 0]]), book)] == [[0, 1], [1, 0]]
    huge = [[10**15, 0], [10**15 + 1, 0]]
    index, away = nearest(np.array([[10**15 + 1, 3]], dtype=np.int64), huge)
    assert index.tolist() == [1] and away.tolist() == [9]


@pytest.mark.parametrize("scale", (4096, 1 << 21))
def test_equals_plain_integers_on_the_given_table(spark, small, scale):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in vectors.collect()]
    assert found(compress(vectors, scale=scale)) == plain(rows, scale=scale)


def test_odd_rows(spark):
    random = np.random.default_rng(3)
    good = [(i, [float(x) for x in random.normal(size=16)], [1, 2, None][i % 3]) for i in range(60)]
    good += [(100, [0.0] * 16, None), (101, [-0.5 / 4096] * 16, 1), (102, [1e300, *[0.0] * 15], 7), (None, [0.25] * 16, None)]
    bad = [(200, None, 1), (201, [None, *[0.0] * 15], 1), (202, [float("nan"), *[0.0] * 15], 1), (203, [float("-inf"), *[1.0] * 15], 2)]
    other = [(300, [], 1), (301, [1.0] * 8, 9)]
    names = {c: "x" for c in ("code", "error", "of", "total", "part", "vector", "length")}
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(good + bad + other, NAMES).withColumns({k: F.lit(v) for k, v in names.items()})
    got, digest = found(compress(rows.repartition(5)))
    want, plain_digest = plain(good)
    assert digest == plain_digest
    assert {i: got.pop(i)[:2] for i in (300, 301)} == {300: (None, None), 301: (None, None)}
    assert got[102][0] == want[102][0]
    assert {i: row for i, row in got.items() if i != 102} == {i: row for i, row in want.items() if i != 102}
    twice = compress(spark.createDataFrame(good[:20] * 2, NAMES)).collect()
    assert len(twice) == 40 and len({(r.vec_id, r.code, r.error) for r in twice}) == 20
    few, _ = found(compress(spark.createDataFrame(good[:3], NAMES)))
    assert [few[i][1] for i in range(3)] == [0, 0, 0]


def test_empty_and_bad_shapes(spark):
    assert compress(spark.createDataFrame([], NAMES)).collect() == []
    assert compress(spark.createDataFrame([(1, None, 1)], NAMES)).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        compress(spark.createDataFrame([(1, [1.0] * 9, 1)], NAMES))
