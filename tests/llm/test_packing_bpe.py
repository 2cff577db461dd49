"""Best-fit packing against a linear scan, and BPE against the tokenizer library."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanbook.llm.bpe import EditableText, Encoder, Prefixes, encode_documents, read_ranks
from loanbook.llm.packing import best_fit, cut_pieces, opened_size, pack, sequence_cost

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SIZES = (8, 20, 50)
COST = sequence_cost(2, 50)


def scan_best_fit(lengths, capacities, cost):
    """Best fit by looking at every open bin."""
    bins, rest = [], sum(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        rest -= lengths[i]
        fitting = [b for b in bins if b[0] >= lengths[i]]
        if fitting:
            chosen = min(fitting, key=lambda b: b[0])
        else:
            chosen = [opened_size(lengths[i], rest, capacities, cost), []]
            bins.append(chosen)
        chosen[0] -= lengths[i]
        chosen[1].append(lengths[i])
    return bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_is_the_scan(lengths):
    bins, offsets, sizes = best_fit(lengths, SIZES, COST)
    held = defaultdict(list)
    for length, b, offset in zip(lengths, bins, offsets, strict=True):
        held[b].append((offset, length))
    for b, parts in held.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sizes[b] and not any(c < sizes[b] and c >= at for c in SIZES)
    assert sorted(sum(n for _, n in p) for p in held.values()) == sorted(sum(b[1]) for b in scan_best_fit(lengths, SIZES, COST))


def test_cost_chooses_the_size():
    assert opened_size(5, 100, SIZES, lambda c: c * c) == 8  # short sequences are cheap
    assert opened_size(5, 100, SIZES, lambda c: 100 + c) == 50  # each sequence costs much
    assert opened_size(5, 0, SIZES, lambda c: 100 + c) == 8  # nothing left to fill a larger one
    assert cut_pieces(120, 50) == [50, 50, 20] and cut_pieces(100, 50) == [50, 50] and cut_pieces(0, 50) == []


@pytest.mark.parametrize("group_rows", [1, 4, 4096])
def test_pack_places_every_piece_once(odd, nothing, group_rows):
    rows = odd.select("doc_id", "text", "piece")
    got = pack(rows, F.octet_length("text"), capacities=SIZES, group_rows=group_rows).collect()
    assert sorted(r.length for r in got if r.piece == 0 and r.length == 0) == [0, 0]
    assert all(r.bin_id is None for r in got if r.length == 0)
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode())) for r in rows.collect())
    total = defaultdict(int)
    for r in got:
        total[r.doc_id] += r.length
        assert r.n_pieces == -(-next(n for _, i, n in want if n >= r.start + r.length and i == (r.doc_id or 0)) // 50) or r.doc_id in (None, 11)
    sums = defaultdict(int)
    for is_null, doc_id, n in want:
        sums[None if is_null else doc_id] += n
    assert total == sums
    bins = defaultdict(list)
    for r in got:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for parts in bins.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.bin_filled == sum(p.length for p in parts) <= r.bin_capacity
            at += r.length
        assert not any(c < parts[0].bin_capacity and c >= at for c in SIZES)
    assert pack(nothing, F.octet_length("text")).collect() == []


@pytest.fixture(scope="module")
def both():
    ranks = read_ranks(PATH)
    return Encoder(ranks, public_tokenizers.PATTERN), tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ALPHABET = "abcdefghijklmnopqrstuvwxyz" * 3 + "éäñ'  \n\t0123 ABC!?%—漢字🙂²\x1c"


def random_text(rng, most):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most)))


def test_encoding_is_the_librarys(both, texts):
    own, library = both
    rng = random.Random(1)
    for text in [random_text(rng, 60) for _ in range(1500)] + [t or "" for _, t in texts] + ["a" * 3000, " " * 500, "ab" * 2000, "\n" * 99]:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_appends_and_edits_are_exact(both):
    own, library = both
    rng = random.Random(2)
    for _ in range(300):
        text = EditableText(own, random_text(rng, 80))
        for _ in range(4):
            start = rng.randint(0, len(text.text))
            text.edit(start, min(len(text.text), start + rng.randint(0, 6)), random_text(rng, 6))
            text.append(random_text(rng, 3))
            assert text.encoded() == library.encode_ordinary(text.text)
        data = random_text(rng, 60).encode()
        prefixes = Prefixes(own.vocabulary, data)
        start = rng.randint(0, len(data))
        end = min(len(data), start + rng.randint(0, 5))
        prefixes.edit(start, end, b"xyz")
        prefixes.append(b" more")
        assert prefixes.last == Prefixes(own.vocabulary, data[:start] + b"xyz" + data[end:] + b" more").last


def test_edits_stay_near(both):
    own, _ = both
    text = EditableText(own, "some words here " * 2000)
    assert text.edit(16_000, 16_002, "zz") < 10 and text.append(" end") < 10
    prefixes = Prefixes(own.vocabulary, b"thequickbrownfox" * 500)
    assert prefixes.edit(4000, 4001, b"q") < 1000


def test_documents(both, odd, nothing):
    _, library = both
    got = encode_documents(odd, PATH, public_tokenizers.PATTERN).collect()
    want = sorted((str(r.doc_id), len(library.encode_ordinary(r.text or "")), hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r in odd.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256) for r in got) == want
    ids = b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary("same row"))
    assert hashlib.sha256(ids).hexdigest() in {r.ids_sha256 for r in got if r.doc_id == 11}
    assert encode_documents(nothing, PATH, public_tokenizers.PATTERN).collect() == []
