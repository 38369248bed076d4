"""Personal data by weak supervision over spans.

Base patterns (exact rules for email, ip, card and phone) always stand. The
method adds spans: looser patterns propose candidates, and seven labelers vote
on every span, base or proposed: the base rule, a shape rule, a checksum or
range rule, a gazetteer (top-level domains, cue words of the kind) in the text
before, free standing borders, nothing but digits around, and absence of
words that deny (version, section and the like). Votes are counted over the
whole corpus per kind and vote pattern (a bounded table), expectation-
maximisation (Dawid and Skene) estimates each labeler's reliability and each
pattern's probability, and these soft labels train the final span classifier,
a logistic regression on the span's form and context words. A candidate is
added if the classifier and the votes both give 0.9 and it overlaps no base
span and no earlier added span of its kind.

The classifier learns from at most ``train_spans`` spans, chosen by hash (a
documented bound); votes are counted over all.

Defined results: null text counts as empty, with no spans; repeated rows are
searched each; ties between spans go to the earlier and longer; long texts are
searched whole in linear time; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.common import bounded_sample, store

KINDS = ("email", "ip", "card", "phone")
TRAIN_SPANS = 50_000
LEAST = 0.9
CELLS = 1 << 12
CONTEXT = 48  # characters looked at on either side

# fixed values of the contract: the base patterns
EMAIL_AFTER = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
#: in every text that LOOSE's email pattern matches
AT_WORD = re.compile(r"[\[(]at[\])]| at [A-Za-z0-9-]+(?:\.[A-Za-z0-9-]| dot | ?[\[(]dot[\])])")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LOOSE = {
    "email": re.compile(r"\b[A-Za-z0-9._%+-]{1,64}(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]{1,63}){1,8}\b"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[./][0-9]{4}){3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])|(?<![0-9+.-])00[1-9][0-9 ().-]{7,18}[0-9](?![0-9-])"),
}
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "correo", "courriel", "adresse"),
    "ip": ("ip", "ipv4", "ipv6", "host", "server", "address", "addr", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "telefono"),
}
TLDS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
DENIALS = ("version", "release", "section", "chapter", "figure", "isbn", "order", "serial", "v")
LABELERS = 7
WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, looking left from each ``@``."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL_AFTER.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the base rules, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [(1, *m.span()) for m in IP.finditer(text) if all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in m[0].split("."))]
        out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that overlap no base span of any kind."""
    taken = sorted((a, b) for _, a, b in base)
    out = []
    has_digit = DIGIT.search(text)
    for k, kind in enumerate(KINDS):
        if not (has_digit if kind != "email" else AT_WORD.search(text)):
            continue
        i = 0
        for m in LOOSE[kind].finditer(text):
            a, b = m.span()
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if i == len(taken) or taken[i][0] >= b:
                out.append((k, a, b))
    return out


def votes(text: str, kind: int, a: int, b: int, is_base: bool) -> int:
    """The labelers' votes as bits."""
    span = text[a:b]
    digits = _digits(span)
    before = text[max(0, a - CONTEXT) : a].lower()
    words = WORD.findall(before)[-4:]
    left, right = text[a - 1 : a], text[b : b + 1]
    name = KINDS[kind]
    shape = {"email": "." in span or "dot" in span.lower(), "ip": True, "card": 13 <= len(digits) <= 19, "phone": 9 <= len(digits) <= 15}[name]
    if name == "card":
        check = luhn(digits)
    elif name == "phone":
        check = digits.lstrip("0")[-10:][:1] not in ("", "0", "1")
    elif name == "email":
        check = WORD.findall(span.lower())[-1:] != [] and WORD.findall(span.lower())[-1] in TLDS
    else:
        check = ":" in span or not span.startswith(("0.", "00"))
    listed = any(w in CUES[name] for w in words) or (name == "email" and check)
    free = not (left.isalnum() or right.isalnum())
    bare = not any(c.isdigit() for c in text[max(0, a - 2) : a] + text[b : b + 2])
    plain = not any(w in DENIALS for w in words[-2:])
    return sum(int(v) << i for i, v in enumerate((is_base, shape, check, listed, free, bare, plain)))


def form(text: str, kind: int, a: int, b: int) -> list[int]:
    """Hashed features of a span: its form and the words around it."""
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]", "9", text[a:b]))
    said = [f"f:{shape}", f"n:{min(40, b - a)}", f"l:{text[a - 1 : a]}", f"r:{text[b : b + 1]}", "bias"]
    said += [f"b:{w}" for w in WORD.findall(text[max(0, a - CONTEXT) : a].lower())[-3:]]
    said += [f"a:{w}" for w in WORD.findall(text[b : b + CONTEXT].lower())[:2]]
    return sorted({xxhash.xxh3_64_intdigest(f"{kind} {s}") % CELLS for s in said})


def reliabilities(counts: dict[tuple[int, int], int], rounds: int = 100) -> dict[tuple[int, int], float]:
    """(kind, votes) -> probability that such a span is personal data."""
    out: dict[tuple[int, int], float] = {}
    for kind in range(len(KINDS)):
        keys = [k for k in counts if k[0] == kind]
        if not keys:
            continue
        v = np.array([[(k[1] >> i) & 1 for i in range(LABELERS)] for k in keys], dtype=np.float64)
        n = np.array([counts[k] for k in keys], dtype=np.float64)
        p = np.clip(v.mean(axis=1), 0.05, 0.95)  # start: share of votes
        for _ in range(rounds):
            w1, w0 = n * p, n * (1 - p)
            prior = np.clip((w1.sum() + 1) / (n.sum() + 2), 0.01, 0.99)
            yes = (w1 @ v + 4) / (w1.sum() + 5)  # labelers are taken to be right more often than not
            no = (w0 @ v + 1) / (w0.sum() + 5)
            log1 = np.log(prior) + v @ np.log(yes) + (1 - v) @ np.log(1 - yes)
            log0 = np.log(1 - prior) + v @ np.log(no) + (1 - v) @ np.log(1 - no)
            p = 1 / (1 + np.exp(np.clip(log0 - log1, -50, 50)))
        out |= {k: float(x) for k, x in zip(keys, p, strict=True)}
    return out


def train(rows: list[tuple[list[int], float]], epochs: int = 8, seed: int = 10) -> np.ndarray:
    """Logistic regression on hashed features with soft labels."""
    w, rng = np.zeros(CELLS), np.random.default_rng(seed)
    for e in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            at, y = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[at].sum(), -30, 30)))
            w[at] -= 0.3 / (1 + e) * (p - y + 1e-4 * w[at])
    return w


def find_pii(docs: DataFrame, train_spans: int = TRAIN_SPANS, least: float = LEAST) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base
    spans), base_sha256, spans (base and added), and n_added (of all kinds)."""

    def search(rows):
        for doc_id, text in rows:
            text = text or ""
            base = base_spans(text)
            said = [(*s, True) for s in base] + [(*s, False) for s in loose_spans(text, base)]
            yield doc_id, [{"kind": k, "a": a, "b": b, "base": is_base, "votes": votes(text, k, a, b, is_base), "form": form(text, k, a, b)} for k, a, b, is_base in said]

    span = "struct<kind: int, a: int, b: int, base: boolean, votes: int, form: array<int>>"
    found = store(map_rows(docs.select("doc_id", "text"), search, f"doc_id long, spans array<{span}>"), "spans")
    each = found.filter(F.size("spans") > 0).select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    counts = {(r["kind"], r["votes"]): r["n"] for r in each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    belief = reliabilities(counts)
    sample = bounded_sample(each.drop("base"), train_spans, "doc_id", "kind", "a", "b")
    w = train([(r["form"], belief[r["kind"], r["votes"]]) for r in sample])

    def decide(rows):
        for doc_id, spans in rows:
            base = [(s["kind"], s["a"], s["b"]) for s in spans if s["base"]]
            text = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base)
            kept, end = list(base), {}
            for s in spans:
                p = 1 / (1 + np.exp(-np.clip(w[s["form"]].sum(), -30, 30)))
                if not s["base"] and min(p, belief[s["kind"], s["votes"]]) >= least and s["a"] >= end.get(s["kind"], 0):
                    kept.append((s["kind"], s["a"], s["b"]))
                    end[s["kind"]] = s["b"]
            kept.sort()
            n = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
            yield doc_id, *n, hashlib.sha256(text.encode()).hexdigest(), ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in kept), len(kept) - len(base)

    return map_rows(found, decide, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
