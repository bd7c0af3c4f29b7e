"""Runs of words against a plain search, and their digests."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from wagegrid.llm import periodic
from wagegrid.llm.queries import QUERIES


def plain_runs(words):
    """(start, length, period) of all runs, period by period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def kept_words(words, runs):
    lost = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in lost]


def sequence(draw):
    letters, n = draw.choice([1, 2, 3, 5, 60]), draw.choice([0, 1, 2, 11, 12, 13, 40, 120])
    words = [draw.randrange(letters) for _ in range(n)]
    if n and draw.random() < 0.6:
        a, p = draw.randrange(n), draw.randint(1, max(1, n // 3))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_of_random_sequences():
    draw = random.Random(3)
    for _ in range(150):
        held = [sequence(draw) for _ in range(draw.randint(1, 9))]
        codes = np.array([w for words in held for w in words], np.int64)
        bounds = np.cumsum([0, *map(len, held)])
        want = [[i, *run] for i, words in enumerate(held) for run in plain_runs(words)]
        assert periodic.find_runs(codes, bounds).tolist() == want


@pytest.mark.parametrize("words", [[0] * 500, ([0] * 6 + [1]) * 40, [0, 1] * 100 + [0, 0] * 50])
def test_runs_within_runs(words):
    got = periodic.find_runs(np.array(words), np.array([0, len(words)]))
    assert [tuple(r[1:]) for r in got.tolist()] == plain_runs(words)


def test_extensions_of_all_places():
    draw = random.Random(8)
    words = [draw.randrange(2) for _ in range(70)] * 2 + [1] * 30
    grammar, n = periodic.Grammar(np.array(words), np.array([0, len(words)])), len(words)
    a, b = np.triu_indices(n, 1)
    ahead = grammar.agree(a, b, True)
    behind = grammar.agree(a, b, False)
    for i, j, x, y in zip(a.tolist(), b.tolist(), ahead.tolist(), behind.tolist(), strict=True):
        assert x == next((k for k in range(n - j) if words[i + k] != words[j + k]), n - j)
        assert y == next((k for k in range(i) if words[i - k - 1] != words[j - k - 1]), i)


def digests(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(kept_words(words, runs))),
    )


def test_query_against_plain_search(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 8_000]
    assert len(rows) > 150
    want = {r.doc_id: digests(*r) for r in rows}
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_recompressed_runs"](spark, sf).collect()}
    assert sum(w[1] > 0 for w in want.values()) > 10
    assert {k: got[k] for k in want} == want


def test_nulls_empty_and_odd_blanks(spark):
    beat = "tick tock " * 8
    rows = [(1, None, 7), (2, "", 7), (3, " \t\n", 7), (4, beat, 7), (4, beat, 7), (None, "a\u00a0b " * 12, 7), (5, "A a " * 6 + "\u2003", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = periodic.with_runs(docs, collapsed_col="short").collect()
    found = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.short) for r in got)
    assert found == [
        (0, [(0, 12, 1)], "a\u00a0b"), (1, [], None), (2, [], ""), (3, [], ""), (4, [(0, 16, 2)], "tick tock"),
        (4, [(0, 16, 2)], "tick tock"), (5, [(0, 12, 2)], "A a \u2003"),
    ]
    assert periodic.with_runs(docs.where("doc_id < 0")).count() == 0
    assert periodic.run_digests(docs).where("n_runs = 0 AND start IS NULL AND exponent_milli IS NULL").count() == 3


def test_long_text(spark):
    text = " ".join(f"w{i % 40_000}" for i in range(100_000))
    row = periodic.with_runs(spark.createDataFrame([(text,)], "text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, 100_000, 40_000)]
