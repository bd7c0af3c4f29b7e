"""The manifest against a plain tree, level by level."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wagegrid.llm import merkle
from wagegrid.llm.queries import QUERIES

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    values = (row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def paths(level):
    """The last node, and of every leaf the siblings: (digest or None, whether it stands left)."""
    at, found = list(range(len(level))), [[] for _ in level]
    while len(level) > 1:
        for i, a in enumerate(at):
            found[i].append((level[a ^ 1] if (a ^ 1) < len(level) else None, a % 2 == 1))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [a // 2 for a in at]
    return level[0], found


def plain_manifest(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    inner = {n: paths([leaf for *_, leaf, _ in sorted(trees[n], key=lambda t: t[:3])]) for n in names}
    root, upper = paths([inner[n][0] for n in names])
    out = []
    for n, above in zip(names, upper, strict=True):
        subroot, below = inner[n]
        for (_, _, leaf, row), path in zip(sorted(trees[n], key=lambda t: t[:3]), below, strict=True):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            now = leaf_of(row, 1) if tampered else leaf
            for sibling, left in [*path, *above]:
                now = sha(now if sibling is None else sibling + now if left else now + sibling)
            siblings = sha("".join(s for s, _ in [*path, *above] if s))
            out.append((row[0], leaf, subroot, root, siblings, now, now == root))
    return sorted(out, key=repr)


def checked(docs):
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    made = merkle.checked_manifest(docs, COLUMNS, "lang", "doc_id", crc % 7 == 0, {"n_chars": F.col("n_chars") + 1})
    return sorted(map(tuple, made.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Trees of 1, 2, 3, 5, 8, 9 and 90 leaves, null and repeated ids, equal rows, nulls everywhere."""
    rows = [(i, f"s{i % 3}", "big", i * 7 % 11, f"text {i}") for i in range(90)]
    for size in (1, 2, 3, 5, 8, 9):
        rows += [(1000 * size + i, None if i % 2 else "ü", f"l{size}", None if i % 3 else i, None if i == 1 else "") for i in range(size)]
    rows += [(None, "s", "l5", 4, "no id"), (None, "s", "l5", 4, "no id"), (7, "other", "big", 1, "again"), (7, "s1", None, 7, "x" * 70_000),
             (3, None, "é", 1, "10:ab"), (4, None, "=", 1, "-"), (5, None, "", 1, None)]
    return rows, spark.createDataFrame(
        [(*r, "mine", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, level int"
    ).repartition(4).cache()


@pytest.mark.parametrize("levels", [8, 1, 2])
def test_manifest_equals_a_plain_tree(odd_docs, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rows, docs = odd_docs
    assert checked(docs) == plain_manifest(rows)


def test_without_broadcasts_and_in_slices(odd_docs, monkeypatch):
    monkeypatch.setattr("wagegrid.settings.small_side", lambda df, *_: df)
    monkeypatch.setattr(merkle, "ROWS_PER_SLICE", 9)
    rows, docs = odd_docs
    assert checked(docs) == plain_manifest(rows)


def test_one_row_and_none(odd_docs):
    rows, docs = odd_docs
    assert checked(docs.where("doc_id < -1")) == []
    (only,) = checked(docs.where("doc_id = 1000"))
    assert only == plain_manifest([r for r in rows if r[0] == 1000])[0]
    assert only[1] == only[2] == only[3] and only[4] == sha("")


def test_manifest_keeps_columns_and_finds_any_change(odd_docs):
    rows, docs = odd_docs
    leaves = docs.withColumn("leaf", merkle.leaf_digest(*[F.col(c) for c in COLUMNS])).withColumn("root", F.lit(1))
    made = merkle.manifest(leaves, "leaf", "lang", "doc_id")
    assert made.columns == [*docs.columns, "leaf", "subroot", "root", "proof"]
    changed = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.concat("text", F.lit("!")))
    held = made.select(
        (merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("true"),
        (merkle.folded(changed, F.col("proof")) == F.col("root")).alias("false"), "text",
    ).collect()
    assert len(held) == len(rows) and all(r.true for r in held)
    assert not any(r.false for r in held if r.text is not None)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS).collect()]
    got = QUERIES["op13_pointer_manifest"](spark, sf)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(rows)
