"""Quality classifier: random-indexing word vectors, a two-layer network.

1. Random indexing over the whole corpus. A token (a word, a number, a run of
   punctuation, and for each its shape) has a sparse ternary index vector, a
   fixed function of its hash: 4 of 32 places plus or minus one, one of 4096
   such vectors. A token's
   context vector is the sum of the index vectors around it (two tokens to
   each side), summed over all documents. Tokens share 16,384 rows by hash, so
   a task's table has 4 MB however many words there are; tables are summed in
   pieces over a shuffle and the result (fixed size) goes to the tasks.
2. A document is pooled: mean and spread of its tokens' normalised vectors,
   plus a few counts (shapes, repeats of the token before, distinct share).
3. A network with one hidden layer (numpy, Adam) learns ``quality`` from at
   most ``train_rows`` labelled rows (chosen by hash of doc_id, a documented
   bound); a fifth of them sets the temperature that calibrates its output.

Rows with crc32(doc_id as text) mod 5 = 0 are held out: their labels are never
read. doc_id, lang and source are no inputs.

Defined results: null and empty texts have zero features and get the score
that the network gives them; rows without doc_id are scored, never learned
from and not held out; rows of ``labels`` with a null id or quality are
ignored, as are labels without a document; repeated rows are scored each; with
no label to learn from, or labels of one kind, every score is that share (0.5
without labels); other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.common import bounded_sample, numbered, store, text_or_empty
from cohort_features.llm.words import mix

ROWS, DIM, NONZERO, WINDOW, VECTORS = 1 << 14, 32, 4, 2, 1 << 12
PIECE = 64  # rows of the table that travel together
BUFFER_TOKENS = 100_000
HIDDEN, EPOCHS, RATE, DECAY, BATCH = 32, 60, 3e-3, 1e-4, 256
TRAIN_ROWS = 20_000
FOLD, HELD = 5, 0
THRESHOLD = 0.3

SHAPES = ("lower", "upper", "title", "mixed", "number", "mark")
FEATURES = 2 * DIM + 2 * len(SHAPES) + 5

# kinds of characters: runs of one kind are tokens, white space ends them
SPACE, LETTER, DIGIT, LINE, MARK = range(5)
BLOCK_CHARS = 1 << 18


def _kind(c: str) -> int:
    if c.isspace():
        return SPACE
    if c.isdecimal():
        return DIGIT
    return LETTER if c.isalnum() else LINE if c == "_" else MARK


#: kind of each character of the basic plane, others count as marks
KIND = np.array([_kind(chr(i)) for i in range(1 << 16)] + [MARK], dtype=np.uint8)
UPPER = np.array([chr(i).isupper() for i in range(1 << 16)] + [False])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_POWERS = _powers(_BASE, BLOCK_CHARS)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), BLOCK_CHARS)


def _block_hashes(c: np.ndarray) -> np.ndarray:
    at = np.minimum(c, 1 << 16)
    kind = KIND[at]
    new = np.empty(len(c) + 1, dtype=bool)
    new[0] = new[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:-1])
    edge = np.flatnonzero(new)
    start, end = edge[:-1], edge[1:]
    word = kind[start] != SPACE
    start, end = start[word], end[word]
    x = c.astype(np.uint64) + np.uint64(1)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    long = len(c) > BLOCK_CHARS
    power, inverse = (_powers(_BASE, len(c)), _powers(pow(_BASE, -1, 1 << 64), len(c))) if long else (_POWERS, _INVERSE)
    sums = np.zeros(len(c) + 1, dtype=np.uint64)
    np.cumsum(x * power[: len(c)], out=sums[1:])
    h = mix((sums[end] - sums[start]) * inverse[start] ^ (end - start).astype(np.uint64))
    uppers = np.zeros(len(c) + 1, dtype=np.int32)
    np.cumsum(UPPER[at], out=uppers[1:])
    n, up, first = end - start, uppers[end] - uppers[start], UPPER[at[start]]
    shape = np.where(up == 0, 0, np.where((up == n) & (n > 1), 1, np.where((up == 1) & first, 2, 3)))
    shape = np.where(kind[start] == LETTER, shape, np.where(kind[start] == DIGIT, 4, 5))
    return (h & ~np.uint64(7)) | shape.astype(np.uint64)


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the text's tokens in order (a polynomial over the
    characters, from prefix sums), each with its shape's number in the lowest
    3 bits. Long texts go in blocks that end after white space."""
    c = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    blocks, i = [np.zeros(0, dtype=np.uint64)], 0
    while i < len(c):
        j = min(i + BLOCK_CHARS, len(c))
        if j < len(c):
            gaps = np.flatnonzero(KIND[np.minimum(c[i:j], 1 << 16)] == SPACE)
            if not len(gaps):  # a run without white space longer than a block
                gaps = np.flatnonzero(KIND[np.minimum(c[i:], 1 << 16)] == SPACE)[:1]
            j = i + int(gaps[-1]) + 1 if len(gaps) else len(c)
        blocks.append(_block_hashes(c[i:j]))
        i = j
    return blocks[1] if len(blocks) == 2 else np.concatenate(blocks)


def _row(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(3)) & np.uint64(ROWS - 1)).astype(np.uint16)


#: rows of the shapes as tokens of their own
SHAPE_ROWS = np.arange(len(SHAPES)) * 2477 % ROWS


def _index_vectors() -> np.ndarray:
    """The fixed sparse ternary vectors; a token's is chosen by 12 hash bits."""
    rng = np.random.default_rng(32)
    out = np.zeros((VECTORS, DIM), dtype=np.int8)
    for v in out:
        v[rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


INDEX_VECTORS = _index_vectors()


def index_vectors(h: np.ndarray) -> np.ndarray:
    return INDEX_VECTORS[((h >> np.uint64(17)) & np.uint64(VECTORS - 1)).astype(np.int64)]


def context_counts(docs: list[np.ndarray]) -> np.ndarray:
    """Summed index vectors of the neighbours of each row's tokens."""
    out = np.zeros((ROWS, DIM))
    docs = [h for h in docs if len(h)]
    if not docs:
        return out
    gap = np.zeros((WINDOW, DIM), dtype=np.int8)  # nothing is near over a document's end
    v = np.concatenate([x for h in docs for x in (index_vectors(h), gap)])
    near = np.zeros(v.shape, dtype=np.int16)
    for d in range(1, WINDOW + 1):
        near[d:] += v[:-d]
        near[:-d] += v[d:]
    inside = np.ones(len(v), dtype=bool)
    ends = np.cumsum([len(h) + WINDOW for h in docs])
    for d in range(1, WINDOW + 1):
        inside[ends - d] = False
    near, h = near[inside], np.concatenate(docs)
    rows = _row(h)
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    out[rows[first]] += np.add.reduceat(near[order], first, axis=0, dtype=np.int64)
    shape = h & np.uint64(7)
    for k, row in enumerate(SHAPE_ROWS):
        out[row] += near[shape == k].sum(axis=0, dtype=np.int64)
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors (ROWS x DIM), from all documents."""

    def count(rows):
        total, held, n = np.zeros((ROWS, DIM)), [], 0
        for (text,) in rows:
            h = token_hashes(text)
            for i in range(0, len(h), BUFFER_TOKENS):
                held.append(h[i : i + BUFFER_TOKENS])
                n += len(held[-1])
                if n >= BUFFER_TOKENS:
                    total += context_counts(held)
                    held, n = [], 0
        total += context_counts(held)
        for k, piece in enumerate(total.reshape(ROWS // PIECE, -1)):
            if piece.any():
                yield k, piece.tobytes()

    def add(rows):
        sums: dict[int, np.ndarray] = {}
        for k, piece in rows:
            sums[k] = sums.get(k, 0.0) + np.frombuffer(piece)
        for k, piece in sums.items():
            yield k, piece.astype(np.float32).tobytes()

    pieces = map_rows(map_rows(docs.select("text"), count, "piece int, data binary").repartition("piece"), add, "piece int, data binary")
    table = np.zeros((ROWS // PIECE, PIECE * DIM), dtype=np.float32)
    for r in pieces.collect():  # 256 rows of 8 kB, whatever the corpus
        table[r["piece"]] = np.frombuffer(r["data"], dtype=np.float32)
    table = table.reshape(ROWS, DIM)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Features of one text; long texts are pooled in pieces."""
    out = np.zeros(FEATURES, dtype=np.float32)
    h = token_hashes(text)
    n = len(h)
    if not n:
        return out
    total, square = np.zeros(DIM), np.zeros(DIM)
    for i in range(0, n, BUFFER_TOKENS):
        v = vectors[_row(h[i : i + BUFFER_TOKENS])]
        total += v.sum(axis=0)
        square += (v * v).sum(axis=0)
    mean = total / n
    shape = (h & np.uint64(7)).astype(np.int64)
    k = len(SHAPES)
    share = np.bincount(shape, minlength=k)[:k] / n
    turn = np.bincount(shape[1:][shape[1:] == shape[:-1]], minlength=k)[:k] / n
    distinct = len(np.unique(h)) / n
    again = float(np.mean(h[1:] == h[:-1])) if n > 1 else 0.0
    mark = h[shape == SHAPES.index("mark")]
    same_mark = np.unique(mark, return_counts=True)[1].max() / n if len(mark) else 0.0
    tail = (np.log1p(n) / 10, distinct, again, same_mark, np.log1p(n) * distinct / 10)
    return np.concatenate([mean, np.sqrt(np.maximum(square / n - mean * mean, 0)), share, turn, tail]).astype(np.float32)


class Network:
    """Two layers, tanh between, one logit; standardised inputs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rate = float(y.mean()) if len(y) else 0.5
        self.constant = len(np.unique(y)) < 2
        if self.constant:
            return
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        check = np.arange(len(y)) % 5 == 0
        if len(np.unique(y[check])) < 2 or len(np.unique(y[~check])) < 2:
            check = np.zeros(len(y), dtype=bool)
        z, t = ((x - self.mean) / self.scale)[~check], y[~check].astype(np.float64)
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(t))
            for i in range(0, len(t), BATCH):
                at = order[i : i + BATCH]
                a = np.tanh(z[at] @ p[0] + p[1])
                d = (1 / (1 + np.exp(-np.clip(a @ p[2] + p[3], -30, 30))) - t[at]) / len(at)
                back = np.outer(d, p[2]) * (1 - a * a)
                grads = [z[at].T @ back + DECAY * p[0], back.sum(axis=0), a.T @ d + DECAY * p[2], np.array([d.sum()])]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        if check.any():
            logit, t = self.logit(x[check]), y[check]
            grid = np.exp(np.linspace(-2, 3, 101))
            loss = [np.logaddexp(0, np.where(t == 1, -1, 1) * logit / g).mean() for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def held_out(doc_id: Column, fold: int = FOLD, held: int = HELD) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % fold == held, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: rid, doc_id, held_out, score, predicted."""
    text = numbered(docs, "doc_id", text_or_empty().alias("text"))
    vectors = word_vectors(text)

    def features(rows):
        for rid, doc_id, t in rows:
            yield rid, doc_id, pooled(t, vectors).tobytes()

    made = store(map_rows(text, features, "rid long, doc_id long, features binary"), "features")
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna().filter(~held_out(F.col("doc_id")))
    sample = bounded_sample(made.join(known, "doc_id").select("features", "quality", "doc_id", "rid"), train_rows, "doc_id", "rid", "quality")
    x = np.array([np.frombuffer(r["features"], dtype=np.float32) for r in sample]).reshape(-1, FEATURES).astype(np.float64)
    net = Network(x, np.array([r["quality"] for r in sample]))

    def score(rows):
        for held in iter(lambda: list(itertools.islice(rows, 1024)), []):
            x = np.frombuffer(b"".join(f for _, _, f in held), dtype=np.float32).reshape(-1, FEATURES)
            yield from ((rid, doc_id, s) for (rid, doc_id, _), s in zip(held, net.score(x.astype(np.float64)).tolist(), strict=True))

    out = map_rows(made, score, "rid long, doc_id long, score double")
    return out.select("rid", "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
