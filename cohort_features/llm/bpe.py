"""Byte-level BPE: texts to ids and ids to bytes, merges by a segment tree.

A text is split by the vocabulary's pattern and every match is encoded alone.
A match that is a token is that token. Otherwise each of its bytes is a leaf
of a segment tree: a live position's leaf holds the rank of the token that it
forms with its next live neighbour (none: no rank), together with the position,
and every inner node the smaller of its two children, so the root is the
leftmost pair of the lowest rank. A merge takes that pair: the right position
dies, and three leaves are set anew (the merged position, the dead one, and
the live neighbour before), each with the nodes above it. A match of n bytes
takes at most n - 1 merges of O(log n), however long it is.

Which token two neighbours form is looked up by their ids, in a table of all
ways to cut a token into two tokens, so it is the token of the joined bytes.

Short matches (64 bytes or fewer) are many and go in lockstep: trees of the
same size lie in one array, and a step merges one pair in each. Longer ones go
one by one. Ids of matches, and of words of several, are kept in bounded caches of the
task. Memory is
that of a batch of texts; a long text is read match by match and only its ids
are held.

Decoding joins the bytes of the ids.

Defined results: null text counts as empty and has no ids; special tokens'
strings are ordinary text; the same text has the same ids wherever it stands;
an id that the vocabulary lacks fails the job, as does a rank file that lacks
one of the 256 bytes; repeated rows are encoded each; an empty table gives no
rows; the names of further columns don't matter, as they are only passed on.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows

SHORT = 64  # bytes of a match that goes in lockstep
TOGETHER = 8192  # trees in lockstep
CACHE = 250_000  # matches, and words, whose ids a task keeps
HELD_CHARS = 1 << 20  # characters of texts encoded together; longer ones are read match by match
HELD_MATCHES = 100_000
NONE = np.int64(1) << 60  # rank of a position without a pair


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Tokens:
    """Tokens and their ids, which are their ranks."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: t for t, i in self.ranks.items()}

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Vocabulary(Tokens):
    """Tokens, the pattern, and the pairs that form tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        super().__init__(ranks_path)
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        ranks = self.ranks
        self.pairs = {
            a << 32 | b: i
            for t, i in ranks.items()
            for k in range(1, len(t))
            if (a := ranks.get(t[:k])) is not None and (b := ranks.get(t[k:])) is not None
        }
        keys = np.array(list(self.pairs), dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array(list(self.pairs.values()), dtype=np.int64)[order], NONE)
        self.matches: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    # --- one long match ------------------------------------------------------

    def merged(self, data: bytes) -> list[int]:
        """Ids of a match that is no token, by one segment tree."""
        n = len(data)
        size = 1 << max(0, n - 1).bit_length()
        pairs, none = self.pairs, int(NONE)
        ids = self.single[np.frombuffer(data, np.uint8)].tolist()
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # live neighbours
        tree = [none] * (2 * size)
        for i in range(n - 1):
            rank = pairs.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[size + i] = rank * size + i  # the smaller: lower rank, then further left
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int) -> None:
            j = after[i]
            rank = pairs.get(ids[i] << 32 | ids[j]) if j < n else None
            k = size + i
            tree[k] = none if rank is None else rank * size + i
            k >>= 1
            while k:
                low = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1

        while tree[1] != none:
            rank, i = divmod(tree[1], size)
            dead = after[i]
            ids[i], after[i] = rank, after[dead]
            if after[i] < n:
                before[after[i]] = i
            after[dead] = n
            put(dead)
            put(i)
            if before[i] >= 0:
                put(before[i])
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    # --- many short matches --------------------------------------------------

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merged_together(self, data: list[bytes]) -> list[bytes]:
        """Ids (as bytes of uint32) of each of many matches of SHORT bytes at
        most, in lockstep."""
        count = len(data)
        n = np.array([len(x) for x in data], dtype=np.int64)
        size = 1 << max(1, int(n.max()) - 1).bit_length()
        flat = np.frombuffer(b"".join(x.ljust(size, b"\0") for x in data), np.uint8).reshape(count, size)
        ids = np.zeros((count, size + 1), dtype=np.int64)  # the last column stands for the end
        ids[:, :size] = self.single[flat]
        places = np.arange(size, dtype=np.int64)
        after = np.tile(places + 1, (count, 1))
        after[places[None, :] + 1 >= n[:, None]] = size  # the end, and what is past it
        before = np.tile(places - 1, (count, 1))
        tree = np.full((count, 2 * size), NONE)
        rank = self._rank(ids[:, : size - 1], ids[:, 1:size])
        rank[places[None, 1:] >= n[:, None]] = NONE
        tree[:, size : 2 * size - 1] = np.where(rank < NONE, rank * size + places[None, :-1], NONE)
        for k in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])

        def put(rows: np.ndarray, i: np.ndarray) -> None:
            j = after[rows, i]
            rank = self._rank(ids[rows, i], ids[rows, j])
            k = size + i
            tree[rows, k] = np.where((j < size) & (rank < NONE), rank * size + i, NONE)
            for _ in range(size.bit_length() - 1):
                k = k >> 1
                tree[rows, k] = np.minimum(tree[rows, 2 * k], tree[rows, 2 * k + 1])

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            rank, i = np.divmod(tree[rows, 1], size)
            dead = after[rows, i]
            then = after[rows, dead]
            ids[rows, i], after[rows, i], after[rows, dead] = rank, then, size
            more = then < size
            before[rows[more], then[more]] = i[more]
            put(rows, dead)
            put(rows, i)
            left = before[rows, i]
            has = left >= 0
            put(rows[has], left[has])
            rows = rows[tree[rows, 1] < NONE]
        live = np.zeros((count, size + 1), dtype=bool)
        at, every = np.zeros(count, dtype=np.int64), np.arange(count)
        while len(every):
            live[every, at[every]] = True
            at[every] = after[every, at[every]]
            every = every[at[every] < size]
        live = live[:, :size]
        flat, ends = ids[:, :size][live].astype("<u4").tobytes(), [0, *(4 * np.cumsum(live.sum(axis=1))).tolist()]
        return [flat[a:b] for a, b in itertools.pairwise(ends)]

    # --- texts ---------------------------------------------------------------

    def learn(self, matches: Iterable[str]) -> None:
        """Ids of matches into the cache of matches."""
        short: dict[int, list[tuple[str, bytes]]] = {}
        for m in matches:
            data = m.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            if whole is not None:
                self.matches[m] = np.array([whole], dtype="<u4").tobytes()
            elif len(data) <= SHORT:
                short.setdefault(max(1, len(data) - 1).bit_length(), []).append((m, data))
            else:
                self.matches[m] = np.array(self.merged(data), dtype="<u4").tobytes()
        for held in short.values():
            for i in range(0, len(held), TOGETHER):
                part = held[i : i + TOGETHER]
                self.matches.update(zip((m for m, _ in part), self.merged_together([d for _, d in part]), strict=True))

    def _ids(self, parts: list[list[str]]) -> list[bytes]:
        """Ids of many lists of matches."""
        known = set(itertools.chain.from_iterable(parts))
        new = known.difference(self.matches)
        if len(self.matches) + len(new) > CACHE:
            self.matches.clear()
            new = known
        self.learn(new)
        of = self.matches.__getitem__
        return [b"".join(map(of, p)) for p in parts]

    def _words(self, words: set[str]) -> None:
        """Ids of a space and a word each into the cache of words."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = words
        listed = list(new)
        for i in range(0, len(listed), HELD_MATCHES):
            some = listed[i : i + HELD_MATCHES]
            self.words.update(zip(some, self._ids([self.pattern.findall(" " + w) for w in some]), strict=True))

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts (uint32). No match spans a space that stands
        before another character than a space, so texts without runs of spaces
        are split there first and each word's matches are looked for once."""
        out: list[bytes | None] = [None] * len(texts)
        words, plain, odd = set(), [], []
        for k, text in enumerate(texts):
            if len(text) > HELD_CHARS:
                found = (m.group() for m in self.pattern.finditer(text))
                parts = iter(lambda f=found: list(itertools.islice(f, HELD_MATCHES)), [])
                out[k] = b"".join(self._ids([p])[0] for p in parts)
            elif "  " in text:
                odd.append((k, self.pattern.findall(text)))
            else:
                first, *rest = text.split(" ")
                plain.append((k, rest))
                odd.append((k, self.pattern.findall(first)))
                words.update(rest)
        for (k, _), ids in zip(odd, self._ids([m for _, m in odd]), strict=True):
            out[k] = ids
        self._words(words)
        of = self.words.__getitem__
        for k, rest in plain:
            out[k] += b"".join(map(of, rest))
        return [np.frombuffer(x, "<u4") for x in out]

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()


@functools.lru_cache(maxsize=2)
def tokens(ranks_path: str) -> Tokens:
    return Tokens(ranks_path)


@functools.lru_cache(maxsize=2)
def vocabulary(ranks_path: str, pattern: str) -> Vocabulary:
    return Vocabulary(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, rows: int = 256) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, ids): the ids of each whole text."""
    path, split = ranks_path or default_ranks(), pattern or default_pattern()

    def run(it):
        vocab = vocabulary(path, split)
        for held in iter(lambda: list(itertools.islice(it, rows)), []):
            size = 0
            part: list[tuple] = []
            for row in [*held, None]:
                if row is not None:
                    part.append(row)
                    size += len(row[1] or "")
                if part and (row is None or size > HELD_CHARS):
                    ids = vocab.encode_many([t or "" for _, t in part])
                    yield from ((doc_id, x.view("<i4")) for (doc_id, _), x in zip(part, ids, strict=True))
                    part, size = [], 0
        vocab.matches.clear()  # workers live on
        vocab.words.clear()

    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, ids) to (doc_id, ids, data): the bytes that the ids stand for,
    which may be no UTF-8 if ids were cut off."""
    path = ranks_path or default_ranks()

    def run(batches):
        vocab = tokens(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = part.column(1)
                flat = ids.flatten().to_numpy().tolist()
                ends = (np.asarray(ids.offsets) - ids.offsets[0].as_py()).tolist()
                data = [vocab.decode(flat[a:b]) for a, b in itertools.pairwise(ends)]
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(data, pa.binary())], names=["doc_id", "ids", "data"])

    held = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return held.mapInArrow(run, "doc_id long, ids array<int>, data binary")


def round_trip(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, data (the decoded bytes)."""
    out = decode(encode(docs, ranks_path, pattern), ranks_path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "data")
