"""Language identification as inference of a mixture of languages.

Each language's model is the smoothed distribution of its character trigrams
(letters, lower case, words apart), counted over all learning documents into
65,536 hashed cells; a task holds one table per language and the tables are
summed in pieces over a shuffle. A document's trigrams are taken as drawn from
a mixture of languages: expectation-maximisation estimates the proportions,
and the set of languages is chosen by penalised likelihood, adding languages
in order of their weight while the log-likelihood grows by more than the
penalty. The prediction is the language with the largest proportion.

Only documents with crc32(doc_id as text) mod 4 other than 2 and a non-null
lang are learned from; doc_id, lang and source are no inputs.

Defined results: a null text or one without letters is ``und`` with score 0,
as is every text if there is nothing to learn from; rows without doc_id are
not held out and are learned from if they have a lang; repeated rows count
each; ties go to the language that sorts first; texts of any length are
counted whole; other columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.quality import held_out
from cohort_features.llm.words import mix

CELLS, PIECE = 1 << 16, 1 << 12
FOLD, HELD = 4, 2
SMOOTH = 0.5
ROUNDS = 25
OVERLAP = 3.0  # neighbouring trigrams share letters, so each counts a third
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Per code point: whether it is a letter (no digit, other numeral or underscore)."""
    return np.fromiter((c.isalpha() for c in map(chr, range(0x110000))), bool, 0x110000)


def trigrams(text: str | None) -> np.ndarray:
    """Cells of the text's letter trigrams, in order; empty without letters."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = np.zeros(len(c) + 2, dtype=bool)  # a gap before and after the text
    letter[1:-1] = _letters()[c]
    if not letter.any():
        return np.zeros(0, dtype=np.int64)
    spaced = np.full(len(letter), 32, dtype=np.uint64)
    np.copyto(spaced[1:-1], c, where=letter[1:-1])
    c = spaced[np.r_[True, letter[1:] | letter[:-1]]]  # of each run of gaps the first
    return (mix((c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]) & np.uint64(CELLS - 1)).astype(np.int64)


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their log distributions (languages x CELLS)."""

    def count(rows):
        tables: dict[str, np.ndarray] = {}
        for lang, text in rows:
            table = tables.setdefault(lang, np.zeros(CELLS, dtype=np.int64))
            cells, n = np.unique(trigrams(text), return_counts=True)
            table[cells] += n
        for lang, table in tables.items():
            for k, piece in enumerate(table.reshape(-1, PIECE)):
                yield lang, k, piece.tobytes()

    def add(rows):
        sums: dict[tuple[str, int], np.ndarray] = {}
        for lang, k, piece in rows:
            sums[lang, k] = sums.get((lang, k), 0) + np.frombuffer(piece, dtype=np.int64)
        for (lang, k), piece in sums.items():
            yield lang, k, piece.tobytes()

    learning = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), FOLD, HELD)).select("lang", "text")
    pieces = map_rows(learning, count, "lang string, piece int, data binary").repartition("lang", "piece")
    tables: dict[str, np.ndarray] = {}
    for r in map_rows(pieces, add, "lang string, piece int, data binary").collect():  # 16 rows of 32 kB a language
        tables.setdefault(r["lang"], np.zeros((CELLS // PIECE, PIECE)))[r["piece"]] = np.frombuffer(r["data"], dtype=np.int64)
    langs = sorted(tables)
    counts = np.array([tables[x].ravel() for x in langs]).reshape(len(langs), CELLS)
    return langs, np.log((counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * CELLS)).astype(np.float32)


def _mixture(p: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood by expectation-maximisation."""
    share = np.full(len(p), 1 / len(p))
    total = n.sum()
    for _ in range(rounds if len(p) > 1 else 0):
        new = share * (p @ (n / (share @ p))) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-4:
            break
    return share, float(n @ np.log(share @ p))


def infer(cells: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions over all languages (0 outside the chosen set) and the score
    of the largest: its proportion, for a single language its posterior."""
    at, n = np.unique(cells, return_counts=True)
    n = n.astype(np.float64)
    log = logs[:, at].astype(np.float64)
    single = log @ n
    p = np.exp(log - log.max(axis=0))  # per trigram scaled; ratios are all that counts
    full, _ = _mixture(p, n)
    order = [int(np.argmax(single)), *(k for k in np.argsort(-full, kind="stable").tolist() if k != int(np.argmax(single)))]
    chosen, share, best = order[:1], np.ones(1), _mixture(p[order[:1]], n)[1]
    penalty = OVERLAP * (0.5 * np.log(n.sum()) + 1)
    for k in order[1:]:
        if full[k] < 0.02:
            break
        new, like = _mixture(p[[*chosen, k]], n)
        if like - best <= penalty:
            break
        chosen, share, best = [*chosen, k], new, like
    out = np.zeros(len(logs))
    out[chosen] = share
    if len(chosen) == 1:
        odds = np.exp((single - single.max()) / OVERLAP)
        return out, float(odds[chosen[0]] / odds.sum())
    return out, float(out.max())


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, and
    ``languages``, the chosen set with its proportions."""
    langs, logs = learn(docs)

    def run(rows):
        for doc_id, text in rows:
            cells = trigrams(text)
            if not len(cells) or not langs:
                yield doc_id, UNKNOWN, 0.0, []
                continue
            share, score = infer(cells, logs)
            parts = [{"lang": langs[k], "share": float(share[k])} for k in np.argsort(-share, kind="stable").tolist() if share[k] > 0]
            yield doc_id, langs[int(np.argmax(share))], score, parts

    out = map_rows(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double, languages array<struct<lang: string, share: double>>")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLD, HELD).alias("held_out"), "lang_pred", "score", "languages")
