"""Plain versions of what the operators compute, and the rows to try them on."""

import hashlib
import re
from collections import Counter

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("row", T.StringType()), T.StructField("places", T.IntegerType()), T.StructField("node", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("_own0", T.StringType()), T.StructField("bucket", T.StringType()), T.StructField("kind", T.StringType())])
LOREM = "the quick brown fox jumps over a lazy dog while seven wise owls éat Ünder forty two old oak trees near that quiet river bank " * 3


def rows():
    """Nulls in every column, empty, blank and long texts, ties, copies, near copies, shared passages, and extra columns with names that operators use."""
    words = [f"w{i}" for i in range(90)]
    texts = [
        LOREM, LOREM, LOREM.replace("seven", "eight", 1), LOREM.upper(), "", None, "  \t\n ", "one", "ONE", "one two", "x" * 60, "x" * 60 + "y", "a b " * 80, "a " * 5000,
        " ".join(words), "before " + " ".join(words[10:80]) + " after", " ".join(reversed(words)), "ß日本語 " * 30, "0 1 2 3 " * 20, "   x", LOREM + " ".join(words),
        " ".join(words[:50]) + "\n\n" + LOREM, "é" * 70, " ".join(f"z{i}" for i in range(3000)), " ".join(f"z{i}" for i in range(100, 3000))]
    sources = ["a", "b", None, "hot", "hot"]
    out = [(i, t, ["en", "de", None][i % 3], sources[i % 5], None if t is None else len(t), "r", 1, None, "s", "o", "b", None) for i, t in enumerate(texts)]
    return out + [(100, None, None, None, None, None, None, None, None, None, None, None)]


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near_components(docs, k, percent):
    sets = {}
    for d, t in docs:
        w = tokens("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def repeated_words(docs, window):
    words = [(d, tokens(t)) for d, t in docs]
    seen = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


def earlier_bytes(docs, length):
    first = {}
    key = lambda d: 2**63 if d is None else d
    for d, t in sorted(docs, key=lambda r: key(r[0])):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], key(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < key(d):
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)
