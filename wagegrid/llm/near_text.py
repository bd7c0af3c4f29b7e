"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact checks.

1. One pass over the texts gives every document the size of its shingle set, a
   128-bit digest of the set and a MinHash signature of ``BANDS * ROWS`` values (each
   value is the smallest of the set's hashes thrown into its slot, over rounds, so one
   hash per shingle fills most of a signature and small sets fill theirs too).
2. Documents with equal sets form a class; only the smallest id of a class goes on.
3. Ids that share a band form a bucket.  In a bucket, ids are compared with one leader,
   not with each other; what joins the leader's component is done.  Two such rounds with
   different leaders leave few buckets with ids of several components, and only there
   pairs across components are compared, block by block inside tasks, which hand on
   links alone.
4. A candidate pair is compared ``STEP`` signature values at a time and dropped once
   the posterior probability (uniform prior) that its similarity reaches the threshold
   falls below ``MISS``.  Survivors are checked on their full sets.
5. Components of the checked links join the classes back together.

A link at exactly 0.8 shares no band with probability (1 - 0.8**6)**32 = 6e-5.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm import words
from wagegrid.llm.common import map_batches
from wagegrid.llm.graph import components

BANDS = 32
ROWS = 6
VALUES = BANDS * ROWS
STEP = 32
#: Probability at which a pair that reaches the threshold may be dropped.
MISS = 1e-6
#: Throws of a whole set before slots left empty take the smallest of a hash of their own.
_THROWS = 6
#: Ids compared with each other at a time.
_BLOCK = 512
#: Keys of shared bands up to this number are broadcast (16 bytes each).
_BROADCAST_KEYS = 500_000


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (uint32) of non-empty sets of hashes, one row per set."""
    found = np.zeros((len(sets), VALUES), np.uint32)
    full = np.zeros((len(sets), VALUES), bool)
    live = np.arange(len(sets))
    for throw in range(_THROWS):
        if not len(live):
            return found
        hashed = words.mix(np.concatenate([sets[i] for i in live]), throw + 1)
        row = np.repeat(np.arange(len(live), dtype=np.uint64), [len(sets[i]) for i in live])
        slot = ((hashed >> np.uint64(32)) * np.uint64(VALUES)) >> np.uint64(32)
        keys = np.sort(((row * np.uint64(VALUES) + slot) << np.uint64(32)) | (hashed & np.uint64(0xFFFFFFFF)))
        cell = (keys >> np.uint64(32)).astype(np.int64)
        first = np.ones(len(cell), bool)
        np.not_equal(cell[1:], cell[:-1], out=first[1:])
        cell, value = cell[first], keys[first].astype(np.uint32)
        at, slot_at = live[cell // VALUES], cell % VALUES
        fresh = ~full[at, slot_at]
        found[at[fresh], slot_at[fresh]] = value[fresh]
        full[at, slot_at] = True
        live = live[~full[live].all(axis=1)]
    for i in live.tolist():
        slots = np.flatnonzero(~full[i])
        for part in np.array_split(sets[i], max(1, len(sets[i]) * len(slots) // 1_000_000)):
            own = words.mix(part[:, None] ^ words.mix(slots.astype(np.uint64), 77)[None, :], 78)
            low = (own >> np.uint64(32)).astype(np.uint32).min(axis=0)
            found[i, slots] = np.where(full[i, slots], np.minimum(found[i, slots], low), low)
            full[i, slots] = True
    return found


def band_keys(found: np.ndarray) -> np.ndarray:
    """One hash per band (int64), different in different bands."""
    parts = found.reshape(len(found), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        keys = words.mix(keys * np.uint64(0xC2B2AE3D27D4EB4F) + parts[:, :, i])
    return keys.view(np.int64)


def _digests(held: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of hashes."""
    return tuple(int(words.mix(held, 101 + k).sum(dtype=np.uint64).view(np.int64)) for k in (0, 1))


def _sketches(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
    sets = list(words.each_set(batch.column("text"), size))
    counts = np.array([len(s) for s in sets], np.int64)
    digests = np.array([_digests(s) for s in sets], np.int64).reshape(-1, 2)
    some = np.flatnonzero(counts)
    found = np.zeros((len(sets), VALUES), np.uint32)
    for part in np.array_split(some, max(1, int(counts.sum()) // 500_000)):
        found[part] = signatures([sets[i] for i in part.tolist()])
    keys = band_keys(found)
    return pa.record_batch({
        "doc_id": batch.column("doc_id"),
        "n_shingles": pa.array(counts),
        "d1": pa.array(digests[:, 0]),
        "d2": pa.array(digests[:, 1]),
        "signature": pa.array([row.tobytes() for row in found], pa.binary()),
        "bands": pa.ListArray.from_arrays(
            pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel())
        ),
    })


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(values compared, fewest matches that are not dropped) after each step.

    With a uniform prior, m matches of n give a Beta(m + 1, n - m + 1) posterior; its
    mass above the threshold is the chance of at most m successes in n + 1 throws.
    """
    bounds = []
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < miss and m < n:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        bounds.append((n, m))
    return bounds


def survivors(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs of signature rows that no step dropped."""
    live = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    begin = 0
    for n, fewest in bounds:
        matches = matches + (left[live, begin:n] == right[live, begin:n]).sum(axis=1)
        keep = matches >= fewest
        live, matches, begin = live[keep], matches[keep], n
        if not len(live):
            break
    return live


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, VALUES)


class _Checker:
    """Checks candidate pairs (u, v) against signatures and full sets."""

    def __init__(self, sketches: DataFrame, docs: DataFrame, size: int, percent: int):
        self.sketches, self.docs, self.size, self.percent = sketches, docs, size, percent
        self.bounds = least_matches(percent / 100)

    def links(self, pairs: DataFrame, pruned: bool = False) -> DataFrame:
        """The pairs that link, written to the shared folder."""
        if not pruned:
            pairs = self._pruned(pairs)
        return self._checked(settings.written(pairs.select("u", "v"), "candidates"))

    def _pruned(self, pairs: DataFrame) -> DataFrame:
        percent, bounds = self.percent, self.bounds
        signed = self.sketches.where("n_shingles > 0").select("doc_id", "n_shingles", "signature")
        joined = _with_both(settings.written(pairs, "pairs"), signed)

        def prune(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            a = batch.column("n_shingles_u").to_numpy()
            b = batch.column("n_shingles_v").to_numpy()
            batch = batch.filter(pa.array(100 * np.minimum(a, b) >= percent * np.maximum(a, b)))
            if not batch.num_rows:
                return None
            live = survivors(_rows(batch.column("signature_u")), _rows(batch.column("signature_v")), bounds)
            return batch.select(["u", "v"]).take(pa.array(live))

        return map_batches(joined, prune, f"u {_id_type(self.docs)}, v {_id_type(self.docs)}")

    def _checked(self, pairs: DataFrame) -> DataFrame:
        size, percent = self.size, self.percent
        ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct()
        ids = settings.small_side(settings.written(ids, "candidate-ids"))

        def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
            held = [s.tobytes() for s in words.each_set(batch.column("text"), size)]
            return pa.record_batch({"doc_id": batch.column("doc_id"), "held": pa.array(held, pa.binary())})

        made = map_batches(
            self.docs.join(ids, "doc_id", "left_semi").select("doc_id", "text"), sets,
            f"doc_id {_id_type(self.docs)}, held binary",
        )
        joined = _with_both(pairs, settings.written(made, "sets"))

        def check(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = np.zeros(batch.num_rows, bool)
            sides = zip(batch.column("held_u").to_pylist(), batch.column("held_v").to_pylist(), strict=True)
            for i, (a, b) in enumerate(sides):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if len(a) and len(b):
                    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                    shared = int((b[at] == a).sum())
                    keep[i] = 100 * shared >= percent * (len(a) + len(b) - shared)
            return batch.select(["u", "v"]).filter(pa.array(keep))

        kind = _id_type(self.docs)
        return settings.written(map_batches(joined, check, f"u {kind}, v {kind}"), "checked")


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _with_both(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """The pairs with the facts of both ends, as ``<name>_u`` and ``<name>_v``."""
    for end in ("u", "v"):
        renamed = facts.withColumnsRenamed({c: end if c == "doc_id" else f"{c}_{end}" for c in facts.columns})
        pairs = pairs.join(renamed, end)
    return pairs


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents link when ``100 * shared >= percent * united`` holds for their sets of
    ``shingle``-word runs.  A text with fewer words is one run; a null, empty or blank
    text has an empty set and links with nothing.  A row with a null id links with
    nothing and is kept.  Repeated rows and rows that share an id are one node of the
    graph and all come back.  Other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = _id_type(docs)
    sketches = settings.written(
        map_batches(
            docs, lambda batch: _sketches(batch, shingle),
            f"doc_id {kind}, n_shingles long, d1 long, d2 long, signature binary, bands array<long>",
        ),
        "sketches",
    )
    some = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    classes = settings.written(classes, "classes")
    several = settings.small_side(classes.where("n > 1").drop("n"))
    copies = settings.written(
        some.select("d1", "d2", "doc_id").join(several, ["d1", "d2"]).where("doc_id <> rep")
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")),
        "copies",
    )
    reps = some.select("d1", "d2", "doc_id", "bands").join(
        classes.select("d1", "d2", F.col("rep").alias("doc_id")), ["d1", "d2", "doc_id"], "left_semi"
    )
    keys = settings.unfolded(reps.select("doc_id", "bands"), "bands", "key").select("key", "doc_id")
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    shared = settings.small_side(settings.written(shared.select("key"), "shared-bands"), _BROADCAST_KEYS)
    buckets = settings.written(keys.join(shared, "key").distinct(), "buckets")

    checker = _Checker(some, docs, shingle, percent)
    links = copies
    labels = None
    for turn in range(2):
        now = _labelled(buckets, labels)
        leader = F.min(F.struct(F.xxhash64("doc_id", F.lit(turn)) if turn else F.lit(0), "doc_id", "label"))
        led = now.groupBy("key").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), leader.alias("l")
        ).where("lo < hi").select("key", F.col("l.doc_id").alias("v"), F.col("l.label").alias("of"))
        pairs = now.join(led, "key").where("label <> of").select(F.col("doc_id").alias("u"), "v").distinct()
        links = links.unionByName(checker.links(pairs))
        labels = components(links)
    for spanning in (True, False):
        now = _labelled(buckets, labels)
        rest = settings.written(_across(now, some, docs, checker, spanning), "across")
        found = checker.links(rest, pruned=True)
        links = links.unionByName(found)
        labels = components(links)
        if not spanning or found.count() == rest.count():
            break
    out = sketches.select("doc_id", "n_shingles").join(
        labels.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    )
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def _labelled(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return buckets.withColumn("label", F.col("doc_id"))
    joined = buckets.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return joined.select("key", "doc_id", F.coalesce("component", "doc_id").alias("label"))


def _across(now: DataFrame, sketches: DataFrame, docs: DataFrame, checker: _Checker, spanning: bool) -> DataFrame:
    """Pairs of different components in a bucket that link by the low halves of their hashes.

    A bucket is dealt by hash into blocks of about ``_BLOCK`` ids; a task compares two
    blocks by signature and then by sets of 32-bit hashes, which can only overstate what
    two sets share, so no link is missed.  With ``spanning`` a task hands on just the pairs that
    join components not yet joined in its block.  A pair comes from the first band it shares.
    """
    kind = _id_type(sketches)
    percent, bounds, size_of_run = checker.percent, checker.bounds, checker.size
    mixed = now.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")
    ).where("lo < hi").select("key", F.ceil(F.col("n") / _BLOCK).cast("int").alias("blocks"))
    members = settings.written(now.join(mixed, "key"), "mixed")
    ids = settings.small_side(settings.written(members.select("doc_id").distinct(), "mixed-ids"))

    def halves(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(words.each_set(batch.column("text"), size_of_run))
        digests = np.array([_digests(s) for s in sets], np.int64).reshape(-1, 2)
        return pa.record_batch({
            "doc_id": batch.column("doc_id"), "d1": pa.array(digests[:, 0]), "d2": pa.array(digests[:, 1]),
            "held": pa.array([s.astype(np.uint32).tobytes() for s in sets], pa.binary()),
        })

    # an id given with several texts has several sets: each goes with its own signature
    each = ["doc_id", "d1", "d2"]
    sets = map_batches(
        docs.join(ids, "doc_id", "left_semi").select("doc_id", "text"), halves,
        f"doc_id {kind}, d1 long, d2 long, held binary",
    )
    facts = sketches.join(ids, "doc_id", "left_semi").select(*each, "n_shingles", "signature").join(sets, each)
    facts = settings.written(facts.dropDuplicates(each).drop("d1", "d2"), "mixed-facts")
    members = members.withColumn("own", F.pmod(F.hash("doc_id"), "blocks"))
    members = settings.unfolded(members, F.sequence(F.lit(0), F.col("blocks") - 1), "other")
    members = members.select(
        "key", "doc_id", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("low"), (F.col("own") >= F.col("other")).alias("high"),
    ).join(facts, "doc_id")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(-1, VALUES)
        keys = band_keys(found)
        here = keys == group["key"].iloc[0]
        group, found, keys = group[here.any(axis=1)], found[here.any(axis=1)], keys[here.any(axis=1)]
        band = int(here.any(axis=0).argmax())
        label, size = group["label"].to_numpy(), group["n_shingles"].to_numpy()
        held = [np.sort(np.frombuffer(h, np.uint32)) for h in group["held"]]
        low, high = np.flatnonzero(group["low"]), np.flatnonzero(group["high"])
        same = group["i"].iloc[0] == group["j"].iloc[0]
        root = np.unique(label, return_inverse=True)[1]  # of each member's component, as far as joined here
        left, right = [], []
        for a in low.tolist():
            others = high[high > a] if same else high
            others = others[label[others] != label[a]]
            n = size[others]
            others = others[100 * np.minimum(n, size[a]) >= percent * np.maximum(n, size[a])]
            others = others[(keys[others] == keys[a]).argmax(axis=1) == band]
            if not len(others):
                continue
            live = survivors(np.broadcast_to(found[a], (len(others), VALUES)), found[others], bounds)
            for b in others[live].tolist():
                if spanning and root[a] == root[b]:
                    continue
                at = np.minimum(np.searchsorted(held[b], held[a]), len(held[b]) - 1)
                shared = int((held[b][at] == held[a]).sum())
                if 100 * shared >= percent * (size[a] + size[b] - shared):
                    left.append(a)
                    right.append(b)
                    root[root == root[b]] = root[a]
        ids = group["doc_id"].to_numpy()
        return pd.DataFrame({"u": ids[np.array(left, np.int64)], "v": ids[np.array(right, np.int64)]})

    return members.groupBy("key", "i", "j").applyInPandas(compare, f"u {kind}, v {kind}")
