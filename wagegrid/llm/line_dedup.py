"""Fuzzy line duplicates: SimHash, pigeonhole blocks, edit similarity, one kept per group.

A line is compared by its words: runs of bytes that are neither white space nor ASCII
punctuation, A-Z as a-z, joined by one blank.  Lines with equal words form a class.
Classes that share a key and whose edit similarity (1 - distance / longer length) is at least
``SIMILARITY`` link.

A line's SimHash has one block of 64 bits for every ``BLOCK_WORDS`` words or so, at least
``LEAST_BLOCKS``; a word (its first use, its second, ...) votes in the block its hash names.  A changed word touches two
blocks at most, so that a line whose changes touch less than half of its blocks keeps two
neighbouring blocks as they were (the last block neighbours the first).  A class is filed
under every pair of neighbouring blocks.  The number of blocks grows with the length, in steps
of about 1.4; a line near the edge is filed for both numbers.

Keys travel once, packed by tasks, to the slot that their key names; it keeps the keys of several
classes.  In a bucket, classes are compared with one leader, not with each other.  Where that leaves
classes in several components, these are compared block by block inside tasks, which hand on only
the links that join what they have not joined yet: no table holds a row for each pair of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm import words
from wagegrid.llm.common import give_back, map_batches, slices, with_columns
from wagegrid.llm.graph import components

#: Words for each block of the SimHash, and fewest blocks.
BLOCK_WORDS = 4
LEAST_BLOCKS = 8
#: Words that two neighbouring blocks must hold to be a key (or all of a shorter line), for
#: lines of at least so many words.
KEY_WORDS = ((0, 2), (10, 3), (25, 4))
#: Least edit similarity of linked lines.
SIMILARITY = 0.9
#: A line is filed for its own number of words and for one that is longer by so much.
_LONGER = 0.93

#: Bytes of text whose lines are worked on at a time.
_SLICE_BYTES = 4 << 20

_APART = np.zeros(256, bool)
_APART[list(b"\t\n\x0b\x0c\r !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = np.where(_APART[_LOWER], 32, _LOWER).astype(np.uint8).tobytes()
#: Bytes of a key in buckets: classes that share no more than these are told apart by their texts.
_KEY_BYTES = 6
#: Keys packed at a time, and keys of a slot.
_SLOT_KEYS = 500_000
#: Classes compared with each other at a time, and rows of them in a task's group.
_BLOCK = 512
_GROUP_ROWS = 5_000
#: Bins in which the characters of a line are counted.
_BINS = 32
_BASES = (0x9FB21C651E98DF25, 0xA0761D6478BD642F)


def plain(line: str) -> str:
    """The line as it is compared."""
    return b" ".join(line.encode().translate(_PLAIN).split()).decode()


def _blocks(n: np.ndarray) -> np.ndarray:
    """Blocks of the SimHash of lines with ``n`` words."""
    step = np.floor(2 * np.log2(np.maximum(n / BLOCK_WORDS, 1)))
    return np.maximum(LEAST_BLOCKS, np.floor(2 ** (step / 2)).astype(np.int64))


def _told_apart(hashes: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A word's first, second, ... use in a line as words of their own, so that no word that is
    often used decides a block.
    """
    mixed = hashes ^ words.mix(line.astype(np.uint64), 5)
    order = np.argsort(mixed)
    new = np.ones(len(order), bool)
    np.not_equal(mixed[order][1:], mixed[order][:-1], out=new[1:])
    firsts, again = np.flatnonzero(new), np.flatnonzero(~new)
    use = np.zeros(len(order), np.uint64)
    use[order[again]] = again - firsts[np.searchsorted(firsts, again) - 1]
    return words.mix(hashes + use * np.uint64(0xD1B54A32D192ED03), 4)


def _majorities(own: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The SimHash of every block, for words in order of blocks that hold ``held`` each: for every
    bit, what most of its words say.
    """
    simhash = np.zeros(len(held), np.uint64)
    by_size = np.argsort(held, kind="stable")
    sizes, at = held[by_size], (np.cumsum(held) - held)[by_size]
    # the votes of a bit are a byte, eight of them an integer; larger blocks are counted one by one
    first, last = np.searchsorted(sizes, [1, 256])
    votes = np.zeros((last, 64), np.uint8)
    bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
    for k in range(int(sizes[last - 1]) if last else 0):
        some = np.searchsorted(sizes[:last], k, side="right")
        votes.view(np.uint64)[some:] += bits[at[some:last] + k]
    most = votes[first:] > (sizes[first:last, None] // 2).astype(np.uint8)
    simhash[by_size[first:last]] = np.packbits(most, axis=1).view(np.uint64).ravel()
    for block, begin, n in zip(by_size[last:].tolist(), at[last:].tolist(), sizes[last:].tolist(), strict=True):
        full = np.unpackbits(own[begin : begin + n].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        simhash[block] = np.packbits(2 * full > n).view(np.uint64)[0]
    return simhash


def _keys_for(own: np.ndarray, n: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) for lines of ``n`` words, told apart, with the given numbers of blocks."""
    line = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(blocks) - blocks
    block = first[line] + (own % blocks[line].astype(np.uint64)).astype(np.int64)
    held = np.bincount(block, minlength=int(blocks.sum()))
    simhash = _majorities(own[np.argsort(block, kind="stable")], held)
    of = np.repeat(np.arange(len(n)), blocks)
    after = np.arange(1, len(held) + 1)
    after[first + blocks - 1] = first
    number = (np.arange(len(held)) - first[of] + 1024 * blocks[of]).astype(np.uint64)
    keys = words.mix(words.mix(simhash, 1) + words.mix(simhash[after], 2) * np.uint64(3) + words.mix(number, 3))
    least = np.select([n >= size for size, _ in reversed(KEY_WORDS)], [k for _, k in reversed(KEY_WORDS)])
    enough = held + held[after] >= np.minimum(n, least)[of]
    return of[enough], keys[enough].view(np.int64)


def _line_keys(hashes: np.ndarray, starts: np.ndarray, n: np.ndarray) -> pa.ListArray:
    """The keys that every line is filed under."""
    words_of = np.repeat(np.arange(len(n)), n)
    own = _told_apart(hashes[np.repeat(starts - np.cumsum(n) + n, n) + np.arange(len(words_of))], words_of)
    line, keys = _keys_for(own, n, _blocks(n))
    near_edge = _blocks(n / _LONGER) != _blocks(n)
    other = np.flatnonzero(near_edge)
    if len(other):
        also, more = _keys_for(own[near_edge[words_of]], n[other], _blocks(n[other] / _LONGER))
        line, keys = np.concatenate([line, other[also]]), np.concatenate([keys, more])
    order = np.argsort(line, kind="stable")
    ends = np.searchsorted(line[order], np.arange(len(n) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[order]))


def _line_facts(texts: pa.Array, with_keys: bool = False) -> dict[str, np.ndarray | pa.Array]:
    """Of every line with words: its text, number, two hashes and length, in order, and its keys."""
    data, at = words.text_bytes(texts)
    found: dict[str, list] = {k: [] for k in ("text", "line", "h1", "h2", "length")}
    keys = [pa.array([], pa.list_(pa.int64()))]
    for first, last in slices(np.diff(at).tolist(), words.BATCH_BYTES):
        part = _LOWER[data[at[first] : at[last]]]
        offsets = at[first : last + 1] - at[first]
        if not len(part):
            continue
        apart = _APART[part]
        edge = np.ones(len(part) + 1, bool)
        edge[1:-1] = apart[:-1]
        edge[offsets] = True
        starts = np.flatnonzero(~apart & edge[:-1])
        edge[:-1] = apart
        edge[offsets] = True
        ends = np.flatnonzero(~apart & edge[1:]) + 1
        if not len(starts):
            continue
        hashes = words.word_hashes(part, starts, ends)
        # a line begins at a text or behind a line feed
        begins = np.union1d(offsets[:-1][offsets[:-1] < offsets[1:]], np.flatnonzero(part == 10) + 1)
        begins = begins[begins < len(part)]
        text = np.searchsorted(offsets, begins, side="right") - 1
        number = np.arange(len(begins)) - np.searchsorted(begins, offsets[text])
        bounds = np.append(np.searchsorted(starts, begins), len(starts))
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        a, b = bounds[full], bounds[full + 1]
        for k, base in zip(("h1", "h2"), _BASES, strict=True):
            sums = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(hashes * words.powers(base, len(hashes)), out=sums[1:])
            raw = (sums[b] - sums[a]) * words.powers(pow(base, -1, 1 << 64), len(hashes))[a]
            found[k].append(words.mix(raw).view(np.int64))
        if with_keys:
            keys.append(_line_keys(hashes, a, b - a))
        widths = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=widths[1:])
        found["length"].append(widths[b] - widths[a] + (b - a) - 1)
        found["text"].append(text[full] + first)
        found["line"].append(number[full])
    facts = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in found.items()}
    return facts | {"keys": pa.concat_arrays(keys)} if with_keys else facts


def _lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each class in every text (its repeats need no look elsewhere).

    ``again`` tells whether the text repeats it; ``keys`` holds ``_KEY_BYTES`` of each key.
    """
    for whole in batches:
        sizes = pc.fill_null(pc.binary_length(whole.column("text")), 0).to_pylist()
        for first, last in slices(sizes, _SLICE_BYTES):
            batch = whole.slice(first, last - first)
            facts = _line_facts(batch.column("text"), with_keys=True)
            keys = facts.pop("keys")
            if not len(keys):
                continue
            order = np.lexsort((facts["line"], facts["h2"], facts["h1"], facts["text"]))
            new = np.ones(len(order), bool)
            new[1:] = np.any([facts[k][order][1:] != facts[k][order][:-1] for k in ("text", "h1", "h2")], axis=0)
            again = np.diff(np.append(np.flatnonzero(new), len(order))) > 1
            order = order[new]
            keys = keys.take(pa.array(order))
            data = keys.flatten().to_numpy().view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes()
            ends = (keys.offsets.to_numpy() - keys.offsets[0].as_py()) * np.int32(_KEY_BYTES)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(facts["text"][order])),
                **{k: pa.array(facts[k][order]) for k in ("line", "h1", "h2", "length")},
                "again": pa.array(again),
                "keys": pa.Array.from_buffers(pa.binary(), len(order), [None, pa.py_buffer(ends), pa.py_buffer(data)]),
            })
            give_back()


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance by bit-parallel columns held in one big integer."""
    begin = 0
    end = min(len(a), len(b))
    while begin < end and a[begin] == b[begin]:
        begin += 1
    tail = 0
    while tail < end - begin and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[begin : len(a) - tail], b[begin : len(b) - tail]
    if not a or not b:
        return max(len(a), len(b))
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = mask, 0, len(a)
    for c in b:
        match = where.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        right = down | (mask & ~(diagonal | up))
        left = up & diagonal
        distance += bool(right & top) - bool(left & top)
        right = (right << 1 | 1) & mask
        up = (left << 1 & mask) | (mask & ~(diagonal | right))
        down = right & diagonal
    return distance


def _reworded(a: str, b: str, most: int) -> bool:
    """Whether ``most`` edits are enough to change, drop or add the words in which ``b`` differs."""
    x, y = a.split(" "), b.split(" ")
    i = j = edits = 0
    while i < len(x) and j < len(y):
        if x[i] != y[j]:
            if x[i + 1 : i + 2] != y[j + 1 : j + 2]:
                if i + 1 < len(x) and x[i + 1] == y[j]:
                    edits += len(x[i]) + 1
                    i += 1
                    continue
                if j + 1 < len(y) and x[i] == y[j + 1]:
                    edits += len(y[j]) + 1
                    j += 1
                    continue
            edits += max(len(x[i]), len(y[j]))
            if edits > most:
                return False
        i += 1
        j += 1
    return edits + sum(len(w) + 1 for w in x[i:] + y[j:]) <= most


def _grams(text: str) -> np.ndarray:
    """How often the runs of three characters fall into each of 4,096 bins."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    return np.bincount(mixed >> np.uint32(20), minlength=4096)


def similar(a: str, b: str) -> bool:
    """Whether the edit similarity is large enough.

    Lines whose words differ in few places are known to be alike from the edits that change these
    words.  An edit changes three runs of three characters at most, so that lines with too few runs in
    common are told apart without working out their distance.
    """
    longer = max(len(a), len(b))
    most = int((1 - SIMILARITY) * longer + 1e-9)
    if longer - min(len(a), len(b)) > most:
        return False
    if _reworded(a, b, most):
        return True
    if longer >= 40 and np.minimum(_grams(a), _grams(b)).sum() < longer - 2 - 3 * most:
        return False
    return edit_distance(a, b) <= most


def _key_numbers(data: np.ndarray) -> np.ndarray:
    """Rows of ``_KEY_BYTES`` bytes as numbers."""
    whole = np.zeros((len(data), 8), np.uint8)
    whole[:, :_KEY_BYTES] = data
    return whole.view(np.uint64).ravel()


def _buckets(lines: DataFrame) -> DataFrame:
    """(key, h1, v) for all classes under each key that several classes share; v is the least of them."""
    n_keys = lines.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    slots = -(-n_keys // (_KEY_BYTES * _SLOT_KEYS)) or 1

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        h1, firsts = np.unique(table.column("h1").to_numpy(), return_index=True)
        rows = table.column("keys").take(pa.array(firsts)).to_pylist()
        keys = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, _KEY_BYTES)
        each = np.repeat(h1, [len(r) // _KEY_BYTES for r in rows])
        slot = (_key_numbers(keys) % np.uint64(slots)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        filed = np.hstack([keys, each.view(np.uint8).reshape(-1, 8)])[order]
        full, begin = np.unique(slot[order], return_index=True)
        ends = (np.append(begin, len(order)) * filed.shape[1]).astype(np.int32)
        held = pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(ends), pa.py_buffer(filed.tobytes())])
        return pa.record_batch({"slot": pa.array(full), "held": held})

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("keys").nbytes
            if size >= _KEY_BYTES * _SLOT_KEYS:
                yield packed(held)
                held, size = [], 0
                give_back()
        if size:
            yield packed(held)
        give_back()

    def shared(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table.column("held").to_pylist()), np.uint8).reshape(-1, _KEY_BYTES + 8)
        key = _key_numbers(rows[:, :_KEY_BYTES])
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        some = order[np.append(same, False) | np.insert(same, 0, False)]
        key, h1 = key[some], rows[some, _KEY_BYTES:].copy().view(np.int64).ravel()
        order = np.lexsort((h1, key))
        key, h1 = key[order], h1[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (h1[1:] != h1[:-1])
        key, h1 = key[new], h1[new]
        _, first, of, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        several = n[of] > 1
        give_back()
        return pa.table({
            "key": pa.array(key[several].view(np.int64)), "h1": pa.array(h1[several]), "v": pa.array(h1[first][of][several]),
        })

    filed = lines.select("h1", "keys").mapInArrow(pack, "slot long, held binary")
    return settings.written(filed.groupBy("slot").applyInArrow(shared, "key long, h1 long, v long"), "line-buckets")


def _class_texts(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(h1, value, size): the line of each class in ``ids`` as it is compared, and its bytes."""
    ids = settings.small_side(settings.written(ids, "line-ids"))
    places = settings.written(classes.select("h1", "doc_id", "line").join(ids, "h1"), "line-places")
    lists = places.groupBy(F.col("doc_id").alias("#doc")).agg(
        F.collect_list("line").alias("#line"), F.collect_list("h1").alias("#h1")
    )
    if places.count() <= settings.BROADCAST_ROWS:
        lists = F.broadcast(lists)
    held = docs.select("doc_id", "text").join(lists, F.col("doc_id") == F.col("#doc")).select("text", "#line", "#h1")

    def own(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, names = [], []
        for text, lines, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = text.split("\n")
            for line, h1 in zip(lines, hashes, strict=True):
                if line < len(rows):
                    found.append(rows[line])
                    names.append(h1)
        # several texts may share an id: of these, the one that holds the line
        facts = _line_facts(pa.array(found, pa.string()))
        right = facts["text"][facts["h1"] == np.array(names, np.int64)[facts["text"]]]
        texts = [plain(found[i]) for i in right.tolist()]
        return pa.record_batch({
            "h1": pa.array(np.array(names, np.int64)[right]), "value": pa.array(texts, pa.string()),
            "size": pa.array(facts["length"][facts["h1"] == np.array(names, np.int64)[facts["text"]]]),
        })

    lines = map_batches(held, own, "h1 long, value string, size long")
    return settings.written(lines.groupBy("h1").agg(F.min("value").alias("value"), F.min("size").alias("size")), "line-texts")


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of classes whose lines are similar enough, written down."""
    pairs = settings.small_side(settings.written(pairs, "line-pairs"))
    joined = texts.toDF("u", "value_u", "size_u").join(pairs, "u").join(texts.toDF("v", "value_v", "size_v"), "v")
    joined = joined.where(F.least("size_u", "size_v") >= SIMILARITY * F.greatest("size_u", "size_v"))

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = zip(batch.column("value_u").to_pylist(), batch.column("value_v").to_pylist(), strict=True)
        return batch.select(["u", "v"]).filter(pa.array([similar(a, b) for a, b in both]))

    return settings.written(map_batches(joined.select("u", "v", "value_u", "value_v"), check, "u long, v long"), "line-links")


def _counts(texts: list[str]) -> np.ndarray:
    """How often the characters of each text fall into each of ``_BINS`` bins."""
    data, at = words.text_bytes(pa.array(texts, pa.string()))
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    begins = (data & 0xC0) != 0x80
    bins = row[begins] * _BINS + data[begins] % _BINS
    return np.bincount(bins, minlength=len(texts) * _BINS).reshape(-1, _BINS).astype(np.int32)


def _across(buckets: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) that join the components left among the classes of a bucket, written down.

    Classes of a bucket's largest component stay in one block of about ``_BLOCK``, the others meet these
    blocks and each other's.  A task compares blocks of buckets with one leader (they hold much the same
    classes), each pair once, and hands on only links that join what it has not joined yet.
    """
    labels = settings.small_side(labels.withColumnRenamed("node", "h1"))
    now = buckets.where("h1 <> v").join(labels, "h1", "left")
    now = now.select("key", "h1", "v", F.coalesce("component", "h1").alias("label"))
    parts = now.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(
        F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("n"), F.count("*").alias("several")
    ).where("several > 1").select(
        "key", F.col("m.label").alias("home"), F.ceil(F.col("m.n") / _BLOCK).cast("int").alias("homes"),
        F.ceil((F.col("n") - F.col("m.n")) / _BLOCK).cast("int").alias("others"),
    )
    members = now.join(mixed, "key").withColumn(
        "own", F.pmod(F.xxhash64("h1"), F.when(F.col("label") == F.col("home"), F.col("homes")).otherwise(F.col("others"))).cast("int")
    )

    def at(i: Column, j: Column, low: Column, high: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), low.alias("low"), high.alias("high"))

    own, homes, yes, no = F.col("own"), F.col("homes"), F.lit(True), F.lit(False)
    each_home, each_other = F.sequence(F.lit(0), homes - 1), F.sequence(F.lit(0), F.col("others") - 1)
    met = F.when(
        F.col("label") == F.col("home"), F.transform(each_other, lambda o: at(o, own, no, yes))
    ).otherwise(F.concat(
        F.transform(each_home, lambda o: at(own, o, yes, no)),
        F.transform(each_other, lambda o: at(F.least(own, o), homes + F.greatest(own, o), own <= o, own >= o)),
    ))
    members = settings.unfolded(members.select("key", "h1", "v", "label", "homes", met.alias("met")), "met", "m")
    members = settings.written(members.select("key", "h1", "v", "label", "homes", "m.*"), "line-mixed")
    groups = -(-members.count() // _GROUP_ROWS) or 1
    members = members.withColumn("group", F.pmod(F.xxhash64("v", "i", "j"), F.lit(groups))).drop("v")
    needed = members.select(F.col("group").alias("to"), F.col("h1").alias("name")).distinct()
    held = needed.join(texts.withColumnRenamed("h1", "name"), "name")

    def compare(table: pa.Table, texts: pa.Table) -> pa.Table:
        names, first = np.unique(texts.column("name").to_numpy(), return_index=True)
        lines = texts.column("value").take(pa.array(first)).to_pylist()
        size, chars = texts.column("size").to_numpy()[first], np.array([len(v) for v in lines], np.int64)
        counts = _counts(lines)
        at = {c: table.column(c).to_numpy() for c in table.column_names}
        known = np.isin(at["h1"], names)
        at = {c: v[known] for c, v in at.items()}
        order = np.lexsort((at["h1"], at["j"], at["i"], at["key"]))
        at = {c: v[order] for c, v in at.items()}
        row = np.searchsorted(names, at["h1"])
        root = np.zeros(len(names), np.int64)  # of each class's component, as far as joined here
        root[row] = np.unique(at["label"], return_inverse=True)[1]
        new = np.ones(len(order), bool)
        new[1:] = np.any([at[c][1:] != at[c][:-1] for c in ("key", "i", "j")], axis=0)
        bounds = np.append(np.flatnonzero(new), len(order)).tolist()
        apart: set[tuple[int, int]] = set()
        left, right = [], []
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            same = at["homes"][begin] + at["i"][begin] == at["j"][begin]
            high = row[begin:end][at["high"][begin:end]]
            for a in row[begin:end][at["low"][begin:end]].tolist():
                others = high[high > a] if same else high
                n = size[others]
                near = np.minimum(n, size[a]) >= SIMILARITY * np.maximum(n, size[a])
                others = others[near & (root[others] != root[a])]
                # an edit takes one character from one bin and gives one to another at most
                moved = np.abs(counts[others] - counts[a]).sum(axis=1)
                longer = np.maximum(chars[others], chars[a])
                for b in others[moved <= 2 * ((1 - SIMILARITY) * longer + 1e-9)].tolist():
                    pair = (a, b) if a < b else (b, a)
                    if root[a] == root[b] or pair in apart:
                        continue
                    if similar(lines[a], lines[b]):
                        left.append(a)
                        right.append(b)
                        root[root == root[b]] = root[a]
                    else:
                        apart.add(pair)
        u, v = names[np.array(left, np.int64)], names[np.array(right, np.int64)]
        give_back()
        return pa.table({"u": pa.array(np.maximum(u, v)), "v": pa.array(np.minimum(u, v))})

    pairs = members.groupBy("group").cogroup(held.groupBy("to")).applyInArrow(compare, "u long, v long")
    return settings.written(pairs, "line-links")


def _links(lines: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (u, v) between classes, by h1, that span every component of lines that share keys."""
    buckets = _buckets(lines)
    texts = _class_texts(buckets.select("h1").distinct(), classes, docs)
    pairs = buckets.where("h1 <> v").select(F.col("h1").alias("u"), "v").distinct()
    links = _checked(pairs, texts)
    return links.unionByName(_across(buckets, components(links), texts))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, text, n_lines, n_dropped for every row of ``docs``; see ``without_repeats``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return without_repeats(docs)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with repeated lines cut from the text, and n_lines and n_dropped.

    Lines end at a line feed.  Of every connected group of lines the first occurrence
    stays (smallest id, then line); all others go, within a text too.  Lines
    without words stay.  A null text stays null and counts no lines; an empty one has
    one line without words.  Rows with a null id are left as they are and are not
    compared.  Rows that share an id are one document given several times: a line that
    stays in one of them stays in all.  Columns named n_lines or n_dropped are replaced.
    """
    plain_docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = plain_docs.schema["doc_id"].dataType.simpleString()
    held = plain_docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    lines = settings.written(
        held.mapInArrow(_lines, f"doc_id {kind}, line long, h1 long, h2 long, length long, again boolean, keys binary"),
        "lines",
    )
    classes = settings.written(
        lines.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("doc_id"), F.min_by("line", "doc_id").alias("line"), F.count("*").alias("n"),
        ), "line-classes",
    )
    labels = settings.small_side(components(_links(lines, classes, held)).withColumnRenamed("node", "h1"))
    # classes that do not hold the kept occurrence of their group
    grouped = classes.join(labels, "h1", "left").withColumn("component", F.coalesce("component", "h1"))
    groups = settings.small_side(settings.written(labels.select("component").distinct(), "line-groups"))
    linked = settings.written(grouped.join(groups, "component", "left_semi"), "line-linked")
    kept = linked.groupBy("component").agg(F.min(F.struct("doc_id", "line", "h1")).alias("k")).select("k.h1")
    lost = settings.written(linked.select("h1", "h2").join(kept, "h1", "left_anti"), "line-lost")
    again = classes.where("n > 1").join(settings.small_side(lost), ["h1", "h2"], "left_anti")
    fates = again.select("h1", "h2", F.col("doc_id").alias("keeper")).unionByName(
        lost.withColumn("keeper", F.lit(None).cast(kind))
    )
    fates = settings.small_side(settings.written(fates, "line-fates"))
    # all occurrences but the kept one, as lists of lines by document, and documents that repeat a line
    drops = lines.join(fates, ["h1", "h2"]).where("keeper IS NULL OR doc_id <> keeper").select("doc_id", "line")
    drops = drops.unionByName(lines.where("again").select("doc_id", F.lit(None).cast("long").alias("line")))
    drops = drops.groupBy(F.col("doc_id").alias("#id")).agg(F.collect_set("line").alias("#lines"))
    drops = settings.written(drops, "line-drops")
    few = drops.agg(F.sum(F.size("#lines") + 1)).first()[0] or 0
    return _without(docs, F.broadcast(drops) if few <= settings.BROADCAST_ROWS else drops, id_col, text_col)


def _without(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts without the given lines and without repeats inside a text; others stay as they are."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, given = batch.column(text_col), batch.column("#lines")
        n_lines = pc.fill_null(pc.add(pc.count_substring(texts, "\n"), 1), 0)
        touched = pc.and_(given.is_valid(), texts.is_valid())
        cuts, known = texts.filter(touched), given.filter(touched).to_pylist()
        facts = _line_facts(cuts)
        bounds = np.searchsorted(facts["text"], np.arange(len(cuts) + 1))
        out, lost = [], np.zeros(batch.num_rows, np.int64)
        n_dropped = []
        for i, text in enumerate(cuts.to_pylist()):
            part = slice(bounds[i], bounds[i + 1])
            keys = zip(facts["h1"][part].tolist(), facts["h2"][part].tolist(), strict=True)
            first: dict[tuple[int, int], int] = {}
            gone, dropped = set(), set(known[i])
            for number, key in zip(facts["line"][part].tolist(), keys, strict=True):
                if first.setdefault(key, number) != number or number in dropped:
                    gone.add(number)
            out.append("\n".join(r for k, r in enumerate(text.split("\n")) if k not in gone) if gone else text)
            n_dropped.append(len(gone))
        lost[touched.to_numpy(zero_copy_only=False)] = n_dropped
        return with_columns(batch.drop_columns(["#lines"]), **{
            text_col: pc.replace_with_mask(texts, touched, pa.array(out, texts.type)),
            "n_lines": n_lines.cast(pa.int64()), "n_dropped": pa.array(lost),
        })

    rows = docs.drop("n_lines", "n_dropped")
    schema = rows.withColumns({c: F.lit(None).cast("long") for c in ("n_lines", "n_dropped")}).schema
    return map_batches(rows.join(drops, F.col(id_col) == F.col("#id"), "left").drop("#id"), cut, schema)
