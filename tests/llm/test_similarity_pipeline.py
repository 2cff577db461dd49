"""The similarity join and the pipeline against plain versions."""

from __future__ import annotations

import random
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from loanbook.llm import components, language, line_quality, similarity
from loanbook.llm.components import connected_components
from loanbook.llm.queries import LLM_QUERIES, LLM_SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_join(rows, threshold=0.8):
    """class_id, set_id, n_copies, n_links, n_linked_docs of each row, from all pairs."""
    sets = defaultdict(list)
    for k, (doc_id, text) in enumerate(rows):
        grams = similarity.gram_set(text or "")
        sets[frozenset(grams.tolist()) if len(grams) else "text " + (text or "")].append(k)
    keys = list(sets)
    smallest = [min((rows[k][0] for k in sets[key] if rows[k][0] is not None), default=None) for key in keys]
    links = [(a, b) for a in range(len(keys)) for b in range(a) if isinstance(keys[a], frozenset) and isinstance(keys[b], frozenset)
             and len(keys[a] & keys[b]) >= threshold * len(keys[a] | keys[b])]
    near = defaultdict(list)
    for a, b in links:
        near[a].append(b), near[b].append(a)
    root = roots(range(len(keys)), links)
    groups = defaultdict(list)
    for k, r in root.items():
        groups[r].append(k)
    out = []
    for k, key in enumerate(keys):
        ids = [smallest[j] for j in groups[root[k]] if smallest[j] is not None]
        row = (str(min(ids, default=None)), str(smallest[k]), len(sets[key]), len(near[k]), sum(len(sets[keys[j]]) for j in near[k]))
        out += [(str(rows[i][0]), *row) for i in sets[key]]
    return sorted(out), len(groups)


def result(frame, **options):
    got = similarity.near_duplicates(frame, **options).collect()
    return sorted((str(r.doc_id), str(r.class_id), str(r.set_id), r.n_copies, r.n_links, r.n_linked_docs) for r in got), sum(r.kept for r in got)


def edits(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_join_is_all_pairs(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_CLASSES", 6)  # the group of near copies spans many blocks
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    other = [f"v{rng.randrange(500)}" for _ in range(90)]
    rows = [(i, edits(rng, base, rng.choice((0, 1, 1, 2)))) for i in range(40)] + [(100 + i, edits(rng, other, i)) for i in range(6)]
    rows += [(200 + i, edits(rng, [f"u{i}x{k}" for k in range(60)], 0)) for i in range(10)]
    rows += [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == plain_join(rows)
    assert similarity.near_duplicates(nothing).collect() == []


def test_join_carries_rows(odd):
    kept = similarity.near_duplicates(odd, carry=odd.columns).where("kept").select("row.*")
    assert kept.dtypes == odd.dtypes and {tuple(r) for r in kept.collect()} <= {tuple(r) for r in odd.collect()}


def test_bands_reach_the_recall():
    bands, rows = similarity.choose_bands(0.8, 0.995, 256)
    assert bands * rows <= 256 and 1 - (1 - 0.8**rows) ** bands >= 0.995
    with pytest.raises(ValueError):
        similarity.choose_bands(0.1, 0.999, 5)
    factors, shifts = similarity.hash_parameters(512)
    a, b = np.arange(900), np.arange(100, 1000)
    mixed = [(s.astype(np.uint64) + np.uint64(1)) * similarity.GRAM_MIX for s in (a, b)]
    agree = np.equal(*similarity.minhashes([(m ^ (m >> np.uint64(31))) * similarity.OUT_MIX for m in mixed], factors, shifts)).mean()
    assert abs(agree - 0.8) < 0.08


def test_blocks_count_what_sets_count():
    rng = random.Random(9)
    sets = [np.array(sorted(rng.sample(range(60), rng.randint(1, 50))), dtype=np.uint64) for _ in range(30)]
    want = np.array([[len(set(a) & set(b)) >= 0.5 * len(set(a) | set(b)) for b in sets] for a in sets])
    assert np.array_equal(similarity.count_links(sets, None, 0.5), want & ~np.eye(30, dtype=bool))
    assert np.array_equal(similarity.count_links(sets[:10], sets[10:], 0.5), want[:10, 10:])


def bucket_members(buckets):
    return [(cid, band) for band, cids in buckets.items() for cid in cids]


def units_of(spark, buckets):
    frame = spark.createDataFrame(bucket_members(buckets), "cid long, band long").repartition(4)
    units, lists = defaultdict(set), {}
    for r in similarity.comparison_units(frame).collect():
        units[r.unit].add(r.cid)
        lists[(r.unit, r.cid)] = r.buckets
    return units, lists


def pairs_compared(units, lists):
    """Every pair that some unit verifies, by the rule of first buckets."""
    found = defaultdict(int)
    for unit, cids in units.items():
        cids = sorted(cids)
        mask = similarity.met_before([lists[(unit, c)] for c in cids], [lists[(unit, c)] for c in cids], unit)
        for i, a in enumerate(cids):
            for j in range(i):
                found[(cids[j], a)] += not mask[i, j]
    return found


def test_a_chain_costs_what_its_buckets_cost(spark):
    """5,000 classes of which only neighbours share a band, found by two bands each."""
    chain = {10**6 + 2 * i + k: (i, i + 1) for i in range(4999) for k in range(2)}
    units, lists = units_of(spark, chain)
    assert sum(len(cids) ** 2 for cids in units.values()) == 4 * 4999
    assert pairs_compared(units, lists) == {(i, i + 1): 1 for i in range(4999)}


def test_a_crowd_costs_its_pairs(spark):
    rng = random.Random(12)
    crowd = {10**6 + band: rng.sample(range(200), 150) for band in range(29)}
    units, lists = units_of(spark, crowd)
    assert [len(cids) for cids in units.values()] == [len({c for cids in crowd.values() for c in cids})]
    assert set(pairs_compared(units, lists).values()) == {1}


def test_every_pair_of_a_bucket_is_compared_once(spark):
    rng = random.Random(13)
    buckets = {(1 << 40) + band: set(rng.sample(range(1500), rng.choice((1, 2, 2, 2, 3, 5)))) for band in range(1500)}
    buckets |= {(1 << 50) + band: cids for band, cids in enumerate(list(buckets.values())[:200])}  # the same buckets by other bands
    buckets[7] = set(range(2000, 2040))
    units, lists = units_of(spark, buckets)
    want = {(a, b) for cids in buckets.values() for a in cids for b in cids if a < b}
    found = pairs_compared(units, lists)
    assert want <= {pair for pair, n in found.items() if n} and max(found.values()) == 1


def test_thin_and_thick_groups_give_all_links(spark, monkeypatch):
    """Chains of texts, each like the next one only, beside a crowd."""
    monkeypatch.setattr(similarity, "BLOCK_CLASSES", 4)
    rng = random.Random(14)
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(80)]
    base = [f"c{rng.randrange(400)}" for _ in range(120)]
    rows += [(1000 + i, edits(rng, base, rng.choice((0, 1)))) for i in range(25)]
    rows += [(2000 + i, rows[rng.randrange(80)][1]) for i in range(20)]
    got, want = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), plain_join(rows)
    assert got == want
    assert max(r[4] for r in want[0] if int(r[0]) < 80) < 10 < len({r[0] for r in want[0] if r[1] == "0"})


def test_components(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(500, 500)] + [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == roots({n for e in edges for n in e}, edges)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_few_tables_are_written(spark, monkeypatch):
    """A round of components writes its labels once, and what one step alone reads is not written."""
    written = []
    for module in (components, similarity):
        monkeypatch.setattr(module, "staged", lambda df, label, inner=module.staged: written.append(label) or inner(df, label))
    path = connected_components(spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long"))
    assert {r.root for r in path.collect()} == {0}
    assert written.count("edges") == 1 and written.count("labels") <= 9 and len(written) <= 10
    written.clear()
    words = [f"w{k}" for k in range(120)]
    docs = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(20)]
    assert similarity.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).count() == 20
    assert len([label for label in written if label not in ("edges", "labels")]) <= 12


def plain_pipeline(spark, folder):
    """Ids that the first four stages keep, one document at a time."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language.train(docs, where=corpus_pipeline.crc_of_id(3) != 1)
    rows = [r for r in docs.collect() if (p := model.predict(r.text or ""))[0] != "und" and p[1] >= corpus_pipeline.LEAST_SHARE]
    frame = spark.createDataFrame(rows, docs.schema)
    lines = line_quality.train(frame, spark.read.parquet(f"{folder}/labels.parquet"), where=corpus_pipeline.crc_of_id(4) != 2)
    rows = [r for r in rows if lines.score([r.text or ""])[0] >= line_quality.THRESHOLD]
    best = {}
    for r in rows:
        key = (r.text or "").translate(LOWER)
        if key not in best or r.doc_id > best[key].doc_id:
            best[key] = r
    rows = list(best.values())
    joined, _ = plain_join([(r.doc_id, r.text) for r in rows])
    kept = {int(c) for _, c, *_ in joined}
    return {r.doc_id: len((r.text or "").encode()) for r in rows if r.doc_id in kept}


def test_pipeline_is_the_plain_one(spark, small):
    got = corpus_pipeline.run(spark, small).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == plain_pipeline(spark, small)


def test_language_stage_rejects_what_fits_no_language(spark):
    folder = "/root/testdata/sf0.01"
    rng = random.Random(12)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gibberish = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(300))
    own = docs.where("lang = 'fr' and length(text) > 300").first().text[:300]
    texts = {-1: gibberish, -2: "Tämä on suomenkielinen teksti joka kertoo metsistä ja järvistä. " * 3, -3: "Это русский текст о лесах и озёрах. " * 5, -4: own}
    more = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in texts.items()], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(more), folder).select("doc_id").collect()}
    assert {i for i in texts if i in kept} == {-4}
    only = docs.where("lang = 'en' and length(text) between 20 and 60").agg(F.min("doc_id")).first()[0]
    model = language.train(docs, where=(F.col("lang") != "en") | (F.col("doc_id") == only))
    seen = language.measure(docs.where("length(text) > 400"), model).cache()
    fit = language.learn_fit(seen, F.col("row.lang"), (F.col("row.lang") != "en") | (F.col("row.doc_id") == only))
    named = seen.where("lang_pred = 'en'").agg(F.count(F.lit(1)).alias("n"), F.min(fit.deviation()).alias("least")).first()
    assert named.n > 0 and named.least > corpus_pipeline.LEAST_FIT  # a language that taught one short text judges nobody
    assert language.learn_fit(seen, F.col("row.lang"), F.lit(False)).learned == {}


def test_pipeline_of_odd_tables(spark, odd, nothing, small, tmp_path):
    """Nulls, repeated rows and empty tables through all stages; only the last stage's table stays."""
    for name, rows in (("odd", odd.select("doc_id", "text", "lang", "source", "n_chars")), ("none", nothing)):
        folder = str(tmp_path / name)
        rows.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert (out.count() > 0) == (name == "odd") and {"doc_id", "length"} <= set(out.columns)
        assert out.count() == 0 or {f.rsplit("/", 2)[1] for f in out.inputFiles()} == {"packing"}
        stages = {f.rsplit("/", 2)[0] for f in out.inputFiles()}
        assert all([p.name for p in Path(s.removeprefix("file://")).iterdir()] == ["packing"] for s in stages)


def test_stages_take_odd_rows(spark, odd, nothing, small):
    for frame in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, small)
            assert out.dtypes == frame.dtypes, name
            assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in frame.collect()}
        assert corpus_pipeline.STAGES[-1][1](spark, frame, small).count() >= frame.count()


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    want = con.sql(LLM_SQL[name])
    columns = sorted(want.columns)
    rows = LLM_QUERIES[name](spark, folder).select(*columns).collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want.select(", ".join(columns)).fetchall()))
