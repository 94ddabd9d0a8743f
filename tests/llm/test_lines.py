"""Line dedup against a plain version."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmart.llm import lines
from tests.llm.brute import SCHEMA

BLANKS = " \t\n\x0b\x0c\r"
LICENCE = "Permission is hereby granted to any person"


def plain(docs, least=20, times=3):
    lower = {c: c + 32 for c in range(65, 91)}
    key = lambda line: line.strip(BLANKS).translate(lower)
    holders, size = defaultdict(Counter), lambda d: -1 if d is None else d
    for n, (d, t) in enumerate(docs):
        for line in set(map(key, (t or "").split("\n"))):
            if len(line) >= least:
                holders[line][n] = size(d)
    keeper = {k: max(v.values()) for k, v in holders.items() if len(v) >= times}
    out = []
    for d, t in docs:
        own = (t or "").split("\n")
        kept = [x for x in own if keeper.get(key(x), -1) <= size(d)]
        out.append((d, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def digest(df, **more):
    out = lines.drop_repeated_lines(df, **more)
    return Counter(tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256)).collect())


def texts():
    short, wide = "only nineteen chars", "é" * 20
    return [
        f"a\n{LICENCE}\nb", f"{LICENCE.upper()}  \nx", f"\t {LICENCE}\r\n{LICENCE}", f"{LICENCE}", f"{LICENCE}\n", short, short, short, short + "s", f" {short}S", short + "s\x0b",
        wide, f"{wide}\n{wide}", f"x\n{wide}", wide.upper(), "é" * 19, "é" * 19, "é" * 19, "", None, "\n\n\n", " " * 50, " " * 50 + "\n", " " + "n" * 19, " " + "n" * 19, " " + "N" * 19,
        "twice only, and never three times", "twice only, and never three times", "\n".join(f"line number {i % 40:04d} of a long text" for i in range(5000)),
        "line number 0007 of a long text\nline number 0008 of a long text", "line number 0007 of a long text", "日本語" * 7, "日本語" * 7 + "\n", "\n" + "日本語" * 7]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, None, None, "r", 1, None, "s", "o", "b", None) for d, t in rows], SCHEMA)


@pytest.mark.parametrize("part_lines", [1 << 17, 3])
def test_lines_match_a_plain_version(spark, part_lines):
    rows = [(i * 7 % 41, t) for i, t in enumerate(texts())]
    for docs in (rows, rows + rows[:9] + [(None, t) for _, t in rows[:6]], [(None, LICENCE)] * 4, [(5, LICENCE)] * 4 + [(6, None)]):
        assert digest(frame(spark, docs), part_lines=part_lines) == plain(docs)


def test_small_parts_and_many_segments(spark, monkeypatch):
    """Parts and segments are cut on the workers by numbers that the driver hands over."""
    monkeypatch.setattr(lines, "SEGMENT_LINES", 7)
    rows = [(i, f"{LICENCE}\nnumber {i % 60} of some repeated lines\nown line of document {i}") for i in range(400)]
    assert digest(frame(spark, rows)) == plain(rows)


def test_lines_of_the_given_documents(spark, given):
    docs = [(r.doc_id, r.text) for r in given.collect()]
    want = plain(docs)
    assert digest(given) == want and sum(r[2] for r in want)
    assert digest(given, least_chars=5, least_docs=2) == plain(docs, 5, 2)


def test_texts_keep_their_columns(spark, odd, none):
    out = lines.drop_repeated_lines(odd)
    assert out.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.lang, r.source) for r in out.collect()) == Counter((r.doc_id, r.lang, r.source) for r in odd.collect())
    assert digest(odd) == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert lines.drop_repeated_lines(out).columns == out.columns
    assert lines.drop_repeated_lines(none).count() == 0
    assert digest(odd.withColumn("doc_id", F.col("doc_id").cast("int"))) == digest(odd)


def test_filters_have_no_false_negatives():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 20_000, dtype=np.int64).view(np.uint64)
    seen = lines.SeenTwice(20_000)
    for part in np.array_split(hashes, 10):
        seen.add(part, np.zeros(len(part), bool))
    false = len(seen.suspects(hashes))
    assert false < 200  # a handful of lines go on to be cleared
    again = hashes[::5]
    seen.add(again, np.zeros(len(again), bool))
    assert np.isin(again, seen.suspects(hashes)).all() and len(seen.suspects(hashes)) <= len(again) + 400
    one = lines.SeenTwice(10)
    one.add(hashes[:4], np.array([True, False, True, False]))
    assert set(hashes[[0, 2]]) <= set(one.suspects(hashes[:4]))
