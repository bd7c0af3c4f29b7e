"""Lines of a bucket that are not like its leader: compared without a row for each pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm import line_dedup

SCHEMA = "doc_id long, text string"


def _word(rng: np.random.Generator, size: int) -> str:
    return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), size))


def _lines(unlike: int, each: int = 1, seed: int = 3) -> list[str]:
    """Lines that have 14 words in common and 6 of their own, and near copies of them."""
    rng = np.random.default_rng(seed)
    shared = [_word(rng, 3) for _ in range(14)]
    found = []
    for _ in range(unlike):
        line = " ".join(shared + [_word(rng, 14) for _ in range(6)])
        found += [line] + [f"{line[:-2]}{_word(rng, 2)}" for _ in range(each - 1)]
    return found


def _components(lines: list[str]) -> dict[str, str]:
    """Of each line, the first of its group by all pairs that share a key and are similar."""
    keys = [set(k) for k in line_dedup._line_facts(pa.array(lines), with_keys=True)["keys"].to_pylist()]
    first = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if first[i] != first[j] and keys[i] & keys[j] and line_dedup.similar(lines[i], lines[j]):
                old, new = max(first[i], first[j]), min(first[i], first[j])
                first = [new if f == old else f for f in first]
    return {line: lines[f] for line, f in zip(lines, first, strict=True)}


def _rows_checked(spark, monkeypatch, unlike: int) -> int:
    seen = []
    written, checked = settings.written, line_dedup._checked

    def count_members(df, name, compact=False):
        out = written(df, name, compact)
        seen.append(out.count() if name == "line-mixed" else 0)
        return out

    def count_pairs(pairs, texts):
        seen.append(pairs.count())
        return checked(pairs, texts)

    monkeypatch.setattr(settings, "written", count_members)
    monkeypatch.setattr(line_dedup, "_checked", count_pairs)
    rows = [(i, line) for i, line in enumerate(_lines(unlike))]
    assert line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA)).where("n_dropped > 0").count() == 0
    monkeypatch.undo()
    return sum(seen)


def test_rows_of_pairs_grow_with_the_lines(spark, monkeypatch):
    few, many = (_rows_checked(spark, monkeypatch, n) for n in (60, 240))
    assert many <= 8 * few


@pytest.mark.parametrize("block", [4, 512])
def test_groups_behind_an_unlike_leader(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "_BLOCK", block)
    lines = list(dict.fromkeys(_lines(20, each=3)))
    want = _components(lines)
    assert len(set(want.values())) == 20
    docs = spark.createDataFrame(list(enumerate(lines)), SCHEMA)
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert {lines[i] for i, r in got.items() if r.n_dropped == 0} == set(want.values())


def test_similar_lines_by_changed_words():
    rng = np.random.default_rng(5)
    for _ in range(400):
        words = [_word(rng, int(rng.integers(1, 6))) for _ in range(int(rng.integers(1, 30)))]
        other = list(words)
        for _ in range(int(rng.integers(0, 4))):
            at, kind = int(rng.integers(0, len(other))), int(rng.integers(0, 3))
            other[at : at + 1] = [[_word(rng, 3)], [other[at], _word(rng, 2)], []][kind] if len(other) > 1 else [_word(rng, 3)]
        a, b = " ".join(words), " ".join(other)
        distance = line_dedup.edit_distance(a, b)
        most = int(0.1 * max(len(a), len(b)) + 1e-9)
        assert line_dedup.similar(a, b) == (distance <= most)
        assert not line_dedup._reworded(a, b, distance - 1)


def test_votes_of_blocks_of_any_size():
    rng = np.random.default_rng(7)
    held = np.array([0, 3, 1, 300, 0, 255, 256, 2, 4])
    own = rng.integers(0, 1 << 63, held.sum(), dtype=np.uint64) * np.uint64(2)
    own += rng.integers(0, 2, len(own), dtype=np.uint64)
    want, at = [], 0
    for n in held.tolist():
        bits = np.unpackbits(own[at : at + n].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=int)
        want.append(int(np.packbits(2 * bits > n).view(np.uint64)[0]))
        at += n
    assert line_dedup._majorities(own, held).tolist() == want


def test_documents_left_alone_and_rows_that_repeat(spark):
    rows = [
        (1, "one two three\nfour five six\none two three"), (2, None), (None, "one two three\none two three"), (3, ""),
        (4, "seven eight nine ten\n\nfour five six"), (5, "eleven twelve thirteen"),
    ]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, SCHEMA)).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [tuple(r) for r in got] == [
        (None, "one two three\none two three", 2, 0), (1, "one two three\nfour five six", 3, 1), (2, None, 0, 0),
        (3, "", 1, 0), (4, "seven eight nine ten\n", 3, 1), (5, "eleven twelve thirteen", 1, 0),
    ]
