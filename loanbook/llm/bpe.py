"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string there is exactly one token that the encoding
of this prefix can end in. It is the token whose predecessor, the last token of
the prefix before it, stays beside it when both are merged again. Storing this
one token per prefix gives

* encoding: follow the stored tokens back from the end;
* appends: continue the table, nothing before it changes;
* edits: keep the table up to the edit and recompute until it agrees with the
  old one over the longest token's length, from where it stays the same.

The text is first split by the tokenizer's pattern and every match is encoded
separately; a match that is a token itself is that token.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_PIECES = 200_000  # bounds of a task's memory; a full cache is emptied, pieces keep the generation before
CACHED_PREFIXES = 500_000
CACHED_PAIRS = 1_000_000
SHORT = 64  # bytes of a piece whose prefixes are kept
BATCH_ROWS = 2_000
SCHEMA = "doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens by rank, how each is merged, and which pairs of tokens stay apart."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._halves: dict[int, tuple[int, int]] = {}
        self._apart: dict[int, bool] = {}
        self._last: dict[bytes, int] = {}

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one; the token itself twice if it is a single byte or never made."""
        found = self._halves.get(token)
        if found is None:
            whole = self.tokens[token]
            parts = [self.ranks[whole[i : i + 1]] for i in range(len(whole))]
            while len(parts) > 2:
                made = [
                    self.ranks.get(self.tokens[a] + self.tokens[b], token) for a, b in zip(parts, parts[1:], strict=False)
                ]
                best = min(made)
                if best >= token:
                    break
                at = made.index(best)
                parts[at : at + 2] = [best]
            found = self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else (token, token)
        return found

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the tokens, put side by side, are what merging their bytes together gives again.

        Their inner boundary is crossed if, on the way back through the merges
        of both, a neighbouring pair could have merged before the merge that
        buried one of its two sides.
        """
        pair = left << 32 | right
        known = self._apart.get(pair)
        if known is not None:
            return known
        tokens, ranks, halves = self.tokens, self.ranks, self._halves
        a, b, bound = left, right, 1 << 62
        while True:
            merged = ranks.get(tokens[a] + tokens[b])
            if merged is not None and merged < bound:
                result = False
                break
            inner = (halves.get(a) or self.halves(a))[1]
            first = (halves.get(b) or self.halves(b))[0]
            whole_a, whole_b = inner == a, first == b
            if whole_a and whole_b:
                result = True
                break
            # Undo the later of the two merges; on equal ranks the left one comes first, so the right is undone.
            if whole_b or (not whole_a and a > b):
                bound, a = a, inner
            else:
                bound, b = b + 1, first
        if len(self._apart) >= CACHED_PAIRS:
            self._apart.clear()
        self._apart[pair] = result
        return result

    def last_token(self, prefix: bytes) -> int:
        """The last token of a short prefix; kept, so that pieces which begin alike share the work."""
        known = self._last.get(prefix)
        if known is not None:
            return known
        ranks = self.ranks
        for start in range(max(0, len(prefix) - self.longest), len(prefix)):
            token = ranks.get(prefix[start:])
            if token is not None and (start == 0 or self.stay_apart(self.last_token(prefix[:start]), token)):
                if len(self._last) >= CACHED_PREFIXES:
                    self._last.clear()
                self._last[prefix] = token
                return token
        raise ValueError("the vocabulary lacks a byte")

    def encode_short(self, data: bytes) -> list[int]:
        """Ids of a piece of at most SHORT bytes, by way of the kept prefixes."""
        out = []
        while data:
            token = self.last_token(data)
            out.append(token)
            data = data[: -len(self.tokens[token])]
        return out[::-1]


class Prefixes:
    """The last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def _last_token(self, data: bytes, end: int) -> int:
        ranks, tokens, last, apart = self.vocabulary.ranks, self.vocabulary.tokens, self.last, self.vocabulary.stay_apart
        for start in range(max(0, end - self.vocabulary.longest), end):
            token = ranks.get(data[start:end])
            if token is not None and (start == 0 or apart(last[start - 1], token)):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def append(self, more: bytes) -> None:
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._last_token(self.data, end))

    def edit(self, start: int, end: int, replacement: bytes) -> int:
        """Replace data[start:end]; returns how many prefixes were computed anew."""
        old, tail = self.last, self.last[end:]
        self.data = self.data[:start] + replacement + self.data[end:]
        self.last = old[:start]
        shift, agreed = start + len(replacement), 0
        for at in range(start, len(self.data)):
            self.last.append(self._last_token(self.data, at + 1))
            agreed = agreed + 1 if at >= shift and self.last[at] == tail[at - shift] else 0
            if agreed > self.vocabulary.longest:
                self.last.extend(tail[at + 1 - shift :])
                return at + 1 - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        out, at = [], len(self.last)
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Encoder:
    """Text to ids and back, piece by piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.find = regex.compile(pattern)
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        most = max(self.vocabulary.tokens, default=0)
        self._bytes = [self.vocabulary.tokens.get(i, b"") for i in range(most + 1)]

    def piece(self, piece: str) -> bytes:
        """The ids of one match, as little-endian 32-bit integers."""
        packed = self._older.get(piece)
        if packed is None:
            data = piece.encode("utf-8", "surrogatepass")
            token = self.vocabulary.ranks.get(data)
            if token is not None:
                ids = [token]
            elif len(data) <= SHORT:
                ids = self.vocabulary.encode_short(data)
            else:
                return np.array(Prefixes(self.vocabulary, data).ids(), dtype="<u4").tobytes()
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self._cache) >= CACHED_PIECES:
            self._older, self._cache = self._cache, {}
        self._cache[piece] = packed
        return packed

    def packed(self, text: str) -> bytes:
        piece = self.piece
        return b"".join([self._cache.get(p) or piece(p) for p in self.split(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))


class EditableText:
    """An encoded text that follows appends and edits without being encoded anew.

    Matches that end `LOOKAHEAD` characters before an edit cannot see it and
    stay; splitting starts again behind them and stops when a match begins
    where one began before, behind the edit.
    """

    LOOKAHEAD = 4

    def __init__(self, encoder: Encoder, text: str = "") -> None:
        self.encoder, self.text = encoder, text
        self.starts = [m.start() for m in encoder.find.finditer(text)]
        self.ids = [encoder.piece(p) for p in encoder.split(text)]

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, replacement: str) -> int:
        """Replace text[start:end]; returns how many matches were encoded anew."""
        keep = bisect.bisect_right(self.starts, start - self.LOOKAHEAD) - 1  # ends before the match holding that place
        keep = max(keep, 0)
        at = self.starts[keep] if keep < len(self.starts) else len(self.text)
        if keep == 0:
            at = 0
        shift = len(replacement) - (end - start)
        self.text = self.text[:start] + replacement + self.text[end:]
        old_starts, old_ids = self.starts, self.ids
        starts, ids, made = old_starts[:keep], old_ids[:keep], 0
        for match in self.encoder.find.finditer(self.text, at):
            behind = match.start() - shift
            if behind >= end:
                same = bisect.bisect_left(old_starts, behind)
                if same < len(old_starts) and old_starts[same] == behind:
                    starts += [s + shift for s in old_starts[same:]]
                    ids += old_ids[same:]
                    break
            starts.append(match.start())
            ids.append(self.encoder.piece(match.group()))
            made += 1
        self.starts, self.ids = starts, ids
        return made

    def encoded(self) -> list[int]:
        return np.frombuffer(b"".join(self.ids), dtype="<u4").tolist()


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids. The ids' digest is of little-endian
    unsigned 32-bit integers, the decoded one of the bytes decoded from the
    ids. Repeated rows and null ids stay as they are; an empty table gives an
    empty result; other columns are not read. The vocabulary file must be at
    `ranks_path` on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for whole in batches:
            encoder = encoder or Encoder(read_ranks(ranks_path), pattern)
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                counts, ids_digest, text_digest = [], [], []
                for text in batch.column("text"):
                    packed = encoder.packed(text.as_py())
                    ids = np.frombuffer(packed, dtype="<u4").tolist()
                    counts.append(len(ids))
                    ids_digest.append(hashlib.sha256(packed).hexdigest())
                    text_digest.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()),
                     pa.array(text_digest, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return rows.mapInArrow(run, SCHEMA.format(kind=kind))
