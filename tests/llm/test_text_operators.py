"""Near copies, lines, mixing, tokens and languages against plain Python."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from wagegrid.llm import bpe, hmm, language, line_dedup, mixing, near_text, words
from wagegrid.llm.common import give_back, held_out
from wagegrid.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, k):
    w = lowered(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def reachable(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(docs, size):
    got = near_text.near_duplicates(docs, shingle=size, percent=80).collect()
    rows = [(r.doc_id, shingles(r.text, size)) for r in docs.select("doc_id", "text").collect()]
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(s)) for i, s in rows)
    links = [
        (i, j) for k, (i, a) in enumerate(rows) for j, b in rows[:k]
        if a and b and i is not None and j is not None and i != j and 100 * len(a & b) >= 80 * len(a | b)
    ]
    least = reachable({i for i, _ in rows if i is not None}, links)
    assert links
    for r in got:
        assert r.component_id == least.get(r.doc_id)
        assert r.kept == (r.component_id == r.doc_id)


def test_near_duplicates_of_nothing(no_docs):
    assert near_text.near_duplicates(no_docs).collect() == []


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(3)
    for n in (1, 5, 40, 3000):
        a = draw.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 5], draw.integers(0, 1 << 62, n // 5).astype(np.uint64)])
        x, y = near_text.signatures([a, b])
        shared = n - n // 5
        assert abs((x == y).mean() - shared / (n + n // 5)) < 0.12


def test_pruning_keeps_pairs_at_the_threshold():
    bounds = near_text.least_matches(0.8)
    draw = np.random.default_rng(4)
    left = draw.integers(0, 1 << 30, (2000, near_text.VALUES)).astype(np.uint32)
    same = draw.random((2000, near_text.VALUES)) < 0.8
    right = np.where(same, left, left + 1)
    assert len(near_text.survivors(left, right, bounds)) >= 1998
    assert len(near_text.survivors(left, np.where(draw.random(same.shape) < 0.4, left, left + 1), bounds)) == 0


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = ["A b\x0bC\x1c d", None, "", "ünï Cödé\r\nx", "  ", "a" * 3_000_000]
    for part in words.each_words(pa.array(texts)):
        for i in range(part.last - part.first):
            own = slice(part.bounds[i], part.bounds[i + 1])
            found = [bytes(part.data[a:b]).decode() for a, b in zip(part.starts[own], part.ends[own], strict=True)]
            assert found == lowered(texts[part.first + i])


def plain_lines(rows):
    """Kept and dropped lines by comparing all classes of lines with each other."""
    import pyarrow as pa

    where = defaultdict(list)
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n") if i is not None and text is not None else []):
            if p := line_dedup.plain(line):
                where[p].append((i, k))
    names = sorted(where)
    keys = [set(k) for k in line_dedup._line_facts(pa.array(names, pa.string()), with_keys=True)["keys"].to_pylist()]
    links = [
        (a, b) for i, a in enumerate(names) for j, b in enumerate(names[:i]) if keys[i] & keys[j] and line_dedup.similar(a, b)
    ]
    least = reachable(names, links)
    first = {}
    for name in names:
        for spot in where[name]:
            first[least[name]] = min(first.get(least[name], spot), spot)
    return {spot for name in names for spot in where[name] if spot != first[least[name]]}, links


def test_line_dedup_equals_brute_force(spark, docs):
    long = "this line has very many words so that one changed letter moves few bits of its hash " * 6
    more = spark.createDataFrame(
        [(900, f"{long}\nShort line!\nshort, LINE\n\nlast"), (901, long[:-3] + "x\nown words here"), (902, "short line")],
        "doc_id long, text string",
    )
    frame = docs.select("doc_id", "text", "lines").unionByName(more, allowMissingColumns=True)
    got = line_dedup.line_dedup(frame).collect()
    rows = frame.select("doc_id", "text").collect()
    dropped, links = plain_lines([(r.doc_id, r.text) for r in rows])
    assert links
    wanted = Counter()
    for r in rows:
        lines = r.text.split("\n") if r.text is not None else []
        gone = [k for k in range(len(lines)) if (r.doc_id, k) in dropped]
        text = "\n".join(x for k, x in enumerate(lines) if k not in gone) if r.text is not None else None
        wanted[r.doc_id, text, len(lines), len(gone)] += 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == wanted


@pytest.mark.parametrize("n", [5, 8, 12, 20, 35, 60, 100])
@pytest.mark.parametrize("edit", ["letter", "word", "swap", "two words", "three words"])
def test_line_keys_find_edited_lines(n, edit):
    """Most of the edited lines that are similar enough share a key with the line."""
    import pyarrow as pa

    draw = random.Random(f"{n} {edit}")
    before, after = [], []
    while len(before) < 150:
        own = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(n)]
        new = list(own)
        for i in draw.sample(range(n), {"two words": 2, "three words": 3}.get(edit, 1)):
            if edit == "letter":
                new[i] = new[i][:-1] + "z"
            elif edit == "swap":
                new[i - 1], new[i] = new[i], new[i - 1]
            else:
                new[i] = "".join(draw.choice("qrstuv") for _ in range(4)) if draw.random() < 0.7 else ""
        new = " ".join(w for w in new if w)
        if not line_dedup.similar(" ".join(own), new):
            if n < 20 and edit != "letter":
                return  # a line this short is seldom similar after such an edit
            continue
        before.append(" ".join(own))
        after.append(new)
    keys = [line_dedup._line_facts(pa.array(t), with_keys=True)["keys"].to_pylist() for t in (before, after)]
    assert sum(bool(set(a) & set(b)) for a, b in zip(*keys, strict=True)) >= (0.85 if n > 5 and edit in ("letter", "word", "swap") else 0.7) * len(before)


def test_keys_find_similar_lines_of_the_documents(sf):
    """Recall against all pairs of lines that share a pair of words."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{sf}/documents.parquet", columns=["text"]).column("text").to_pylist()
    names = sorted({p for t in texts if t for line in t.split("\n") if (p := line_dedup.plain(line))})
    found = defaultdict(list)
    for i, name in enumerate(names):
        for pair in set(pairwise(name.split())):
            found[pair].append(i)
    near = {(i, j) for held in found.values() if len(held) < 500 for i, j in combinations(held, 2)}
    near = [(i, j) for i, j in near if line_dedup.similar(names[i], names[j])]
    keys = [set(k) for k in line_dedup._line_facts(pa.array(names), with_keys=True)["keys"].to_pylist()]
    assert len(near) > 20 and sum(bool(keys[i] & keys[j]) for i, j in near) >= 0.95 * len(near)


def test_line_dedup_of_nothing(no_docs):
    assert line_dedup.line_dedup(no_docs).collect() == []


def test_edit_distance():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]

    draw = np.random.default_rng(0)
    for _ in range(200):
        a, b = ("".join(draw.choice(list("abü"), draw.integers(0, 12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == slow(a, b)


def test_tokens_are_those_of_the_public_library(docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranks)}, special_tokens={})
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tokenizer().digests(docs).collect()}
    wanted = set()
    for r in docs.select("doc_id", "text").collect():
        ids = plain.encode_ordinary(r.text or "")
        wanted.add((r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                    hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == wanted
    codec = bpe.Codec(ranks, bpe.model_bytes(ranks), public_tokenizers.PATTERN)
    for text in ("it's  we'LL\r\n\t ", "日本語 ① x՘y 𝒳\U00033338z", "\x1c \x85　a", "<unk><s>", " " * 500, "é" * 4000):
        ids = codec.encode([text])[0]
        assert ids == plain.encode_ordinary(text)
        assert codec.decode(ids).decode() == text


def test_encode_and_decode_keep_columns(docs, no_docs):
    made = tokenizer().decode(tokenizer().encode(docs.drop("lines")))
    assert made.columns == ["doc_id", "text", "lang", "source", "score", "n_chars", "ids", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in made.collect())
    assert tokenizer().digests(no_docs).collect() == []


def test_languages(docs, no_docs):
    learn = docs.where(~held_out(F.col("doc_id"), 3, 1))
    got = language.predict_language(docs, language.learn_profiles(learn)).collect()
    facts = {r.doc_id: r for r in docs.collect()}
    clean = [r for r in got if r.doc_id is not None and r.doc_id < 120 and r.doc_id != 5]
    assert sum(r.lang_pred == facts[r.doc_id].lang for r in clean) >= 0.98 * len(clean)
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (150, 151, 152, 155, 156):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert all(r.lang_pred == "und" for r in language.predict_language(docs, language.learn_profiles(no_docs)).collect())
    assert language.predict_language(no_docs, language.learn_profiles(docs)).collect() == []


def test_profile_of_a_text():
    grams = language.text_profiles(["Ab, a", None, "1!", "aa"])
    def code(s):
        return sum(ord(c) << 21 * (len(s) - 1 - i) for i, c in enumerate(s))
    assert set(grams[0].tolist()) == {code(g) for g in ("a", "b", " a", "ab", "b ", "a ", " ab", "ab ", " a ")}
    assert grams[0][0] in (code("a"), code(" a"))
    assert [len(g) for g in grams[1:3]] == [0, 0]


def test_hidden_markov_model(docs, no_docs):
    kept_back = held_out(F.col("doc_id"), 7, 2)
    got = hmm.score_documents(docs, ~kept_back, states=3, core=40).collect()
    rows = docs.select("doc_id", "text").collect()
    counts, n = Counter(), 0
    for r in rows:
        if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            counts.update([*lowered(r.text), None])
    total, distinct = sum(counts.values()), len(counts)
    wanted = Counter()
    for r in rows:
        tokens = [*lowered(r.text), None]
        base = sum(np.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        wanted[r.doc_id, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(float(base), 5)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == wanted
    prose = [r for r in got if r.doc_id is not None and r.doc_id < 120]
    assert sum(r.score for r in prose) > sum(r.base_score for r in prose)
    assert {r.n_known for r in hmm.score_documents(docs, F.lit(False)).collect()} == {0}
    assert hmm.score_documents(no_docs, F.lit(True)).collect() == []


def test_language_model_learns_from_all_documents(docs):
    got = hmm.score_documents(docs, F.lit(True), states=2, core=5000, steps=2).collect()
    symbols = hmm.learn_symbols(hmm.count_words(docs), docs.count(), 5000)
    rows = hmm.encode(docs.select("doc_id", "text"), symbols).collect()
    seqs = [np.frombuffer(r.seq, np.int32) for r in rows]
    overall = (symbols.counts + 1) / (symbols.counts + 1).sum()
    model = hmm.first_model(overall, 2)
    for _ in range(2):
        model = hmm.fitted(*hmm.Trellis(seqs, model).expected(), overall)
    wanted = hmm.Trellis(seqs, model).log10()
    assert np.allclose(sorted(r.score for r in got), sorted(wanted))


def test_forward_recursion_and_expected_counts():
    draw = np.random.default_rng(1)
    model = hmm.Model(*(x / x.sum() if x.ndim == 1 else x for x in (draw.random(2), np.full((2, 2), 0.5), draw.random((3, 2)))))
    model.move = np.array([[0.8, 0.2], [0.3, 0.7]])
    model.emit /= model.emit.sum(axis=0)
    seqs = [np.array(s, np.int32) for s in ([0, 1, 2], [2], [1, 1, 0, 2])]

    def paths(seq):
        out = {}
        for p in np.ndindex(*(2,) * len(seq)):
            x = model.start[p[0]] * model.emit[seq[0], p[0]]
            for t in range(1, len(seq)):
                x *= model.move[p[t - 1], p[t]] * model.emit[seq[t], p[t]]
            out[p] = x
        return out

    logs = hmm.Trellis(seqs, model).log10()
    assert np.allclose(logs, [np.log10(sum(paths(s).values())) for s in seqs])
    start, moves, emit = hmm.Trellis(seqs, model).expected()
    want = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    for s in seqs:
        all_of = paths(s)
        for p, x in all_of.items():
            x /= sum(all_of.values())
            want[0][p[0]] += x
            for t, k in enumerate(p):
                want[2][s[t], k] += x
                if t:
                    want[1][p[t - 1], k] += x
    assert np.allclose(start, want[0]) and np.allclose(moves, want[1]) and np.allclose(emit, want[2])


def test_long_sequences_are_scaled_now_and_then():
    draw = np.random.default_rng(4)
    model = hmm.first_model(draw.random(50) ** 8 + 1e-9, 3)
    seqs = [draw.integers(0, 50, n).astype(np.int32) for n in (700, 9, 8, 1, 33)]
    trellis = hmm.Trellis(seqs, model)
    _, scale = trellis.forward()
    at = np.repeat(np.arange(trellis.steps), trellis.alive)
    assert (scale[at % hmm._SCALED != 0] == 1).all() and (scale[at % hmm._SCALED == 0] < 1).all()
    starts, moves, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((50, 3))
    for seq, found in zip(seqs, trellis.log10(), strict=True):
        a, b = [model.start * model.emit[seq[0]]], [np.ones(3)]
        logs = 0.0
        for t in range(1, len(seq) + 1):
            logs += np.log10(a[-1].sum())
            a[-1] = a[-1] / a[-1].sum()
            if t < len(seq):
                a.append((a[-1] @ model.move) * model.emit[seq[t]])
        for s in seq[:0:-1]:
            b.append(model.move @ (model.emit[s] * b[-1]))
            b[-1] = b[-1] / b[-1].sum()
        b.reverse()
        assert np.isclose(found, logs)
        for t, s in enumerate(seq):
            emit[s] += a[t] * b[t] / (a[t] @ b[t])
            if t:
                both = model.move * np.outer(a[t - 1], model.emit[s] * b[t])
                moves += both / both.sum()
        starts += a[0] * b[0] / (a[0] @ b[0])
    got = hmm.Trellis(seqs, model).expected()
    assert all(np.allclose(x, y) for x, y in zip(got, (starts, moves, emit), strict=True))


def test_freed_memory_goes_back_and_few_profiles_are_held(spark, monkeypatch):
    def held():
        with open("/proc/self/smaps_rollup") as file:
            return sum(int(x) for x in re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", file.read())) / 1024

    made = [bytes(700) for _ in range(300_000)]
    some = made[::500]
    del made
    before = held()
    give_back()
    assert len(some) == 600 and held() < before - 100
    calls, profiles = [], language.text_profiles
    monkeypatch.setattr(language, "_SCORED_CHARS", 50)
    monkeypatch.setattr(language, "text_profiles", lambda texts: calls.append(texts) or profiles(texts))
    monkeypatch.setattr(language, "map_batches", lambda df, make, schema: make)
    learned = spark.createDataFrame([("en", ord("a"), 0), ("de", ord("z"), 0)], "lang string, gram long, place int")
    texts = pa.array(["a aa", None, "z zz" * 30, "", "a b", "zu"])
    score = language.with_language(spark.createDataFrame([], "text string"), learned)
    got = score(pa.record_batch({"text": texts}))
    assert got.column("lang_pred").to_pylist() == ["en", "und", "de", "und", "en", "de"]
    assert len(calls) == 3 and [t for part in calls for t in part] == texts.to_pylist()


def test_mixing(docs, no_docs):
    documents, pieces = mixing.mix(docs, block=50, shard_blocks=7)
    got = mixing.taken(documents, pieces).collect()
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    targets = mixing.source_targets(sizes)
    assert list(targets)[-1] is None or None in targets
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in rows)
    for source, size in sizes.items():
        own = [r for r in got if r.source_size == size and r.target == targets[source]]
        assert abs(sum(r.taken for r in own) - targets[source]) <= 1
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    per_shard = Counter()
    for p in pieces.collect():
        per_shard[p.shard] += p.words
    assert max(per_shard.values()) <= 7 * 50
    again = mixing.taken(*mixing.mix(docs, block=50, shard_blocks=7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.taken(*mixing.mix(no_docs)).collect() == []


def test_targets_stop_at_three_times_the_size():
    targets = mixing.source_targets({"a": 100, "b": 10, None: 1000})
    assert targets["b"] == 30 and abs(sum(targets.values()) - 1110) < 1e-6
    assert targets["a"] == 270 and targets[None] == 810
    assert mixing.source_targets({}) == {}


def test_tree_deals_every_block_once():
    quotas = np.array([17, 0, 301, 5])
    seen = defaultdict(list)
    for shard in range(9):
        for source, first, n in mixing.shard_runs(quotas, 9, shard, seed=3):
            seen[source] += range(first, first + n)
    assert {k: sorted(v) for k, v in seen.items()} == {i: list(range(q)) for i, q in enumerate(quotas) if q}


def test_mixed_documents_hold_the_taken_words(docs):
    made = mixing.mixed_documents(docs, block=50, shard_blocks=7)
    assert made.columns == docs.columns
    got = Counter()
    for r in made.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
    want = Counter()
    for r in mixing.taken(*mixing.mix(docs, block=50, shard_blocks=7)).collect():
        want[r.doc_id] += r.taken
    assert +got == +want


def test_rows_that_share_an_id_are_mixed_apart(spark):
    """One id with several sizes, sources and texts, null ids, equal rows: no row is taken too often."""
    text = lambda n, w="w": " ".join(f"{w}{i}" for i in range(n))
    rows = [(1, text(10), "a"), (1, text(50), "a"), (1, text(3), "b"), (2, text(11), "b"), (1, text(10, "v"), "a"), (1, text(10), "a"),
            (None, text(7), "a"), (None, text(9), None), (None, text(9), None), (3, None, "b"), (4, "", None)]
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, source string, row string, size int")
    runs = []
    for parts in (1, 4):
        documents, pieces = mixing.mix(docs.repartition(parts), block=4, shard_blocks=3)
        got = mixing.taken(documents, pieces).collect()
        assert len(got) == len(rows) and all(r.taken <= 3 * r["size"] for r in got)
        kept = {r.row: r for r in documents.collect()}
        words = Counter()
        for p in pieces.collect():
            words[kept[p.row].source] += p.words
            assert 0 <= p.first_word and p.first_word + p.words <= kept[p.row]["size"] and p["pass"] < 3
        targets = {r.source: r.target for r in kept.values()}
        assert {s: words[s] for s in targets} == {s: round(t) for s, t in targets.items()}
        runs.append(Counter(map(tuple, got)))
        made = mixing.mixed_documents(docs.repartition(parts), block=4, shard_blocks=3)
        runs.append(Counter(map(tuple, made.collect())))
        taken = Counter()
        for r in made.collect():
            taken[r.source] += len((r.text or "").split())
        assert taken == words
    assert runs[:2] == runs[2:]


def test_languages_of_texts_with_any_character():
    """Characters that part nothing and texts behind them keep their n-grams."""
    odd = ["ab\0cd", "\0\0", "x\0", None, "İstanbul\0 ß", "\u2028 z", "plain words"]
    alone = [language.text_profiles([t])[0].tolist() for t in odd]
    assert [p.tolist() for p in language.text_profiles(odd)] == alone
    assert alone[0] == language.text_profiles(["ab cd"])[0].tolist() and alone[1] == [] == alone[3]


def test_distance_of_languages_is_out_of_place(spark, docs):
    """Every prediction by plain lists of n-grams and ranks."""
    def ranked(texts):
        counts = Counter()
        for t in texts:
            for w in "".join(c if c.isalpha() else " " for c in t.lower()).split():
                w = f" {w} "
                counts.update(g for k in (1, 2, 3) for i in range(len(w) - k + 1) if (g := w[i : i + k]).strip())
        return counts

    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    best = lambda counts: [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[: language.PROFILE]]
    rows = [r for r in docs.select("doc_id", "text", "lang").collect() if r.text is not None and len(r.text) < 5_000]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language.learn_profiles(frame)
    want = {}
    for name in sorted({r.lang for r in rows if r.lang}):
        want[name] = {g: i for i, g in enumerate(best(ranked([r.text for r in rows if r.lang == name])))}
    assert {(r.lang, r.gram): r.place for r in profiles.collect()} == {(n, code(g)): i for n, p in want.items() for g, i in p.items()}
    for r in language.with_language(frame, profiles).collect():
        own = best(ranked([r.text]))
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        off = {n: sum(abs(i - p[g]) if g in p else language.PROFILE for i, g in enumerate(own)) for n, p in want.items()}
        name = min(off, key=lambda n: (off[n], n))
        assert r.lang_pred == name and abs(r.score - (1 - off[name] / (len(own) * language.PROFILE))) < 1e-12


def test_ids_of_long_and_many_texts(spark):
    """Slices of bytes give the ids of the texts, in their rows."""
    texts = ["word " * 60_000, None, "", *[f"text number {i}" for i in range(3000)], "ünï " * 90_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    found = {r.doc_id: r.ids for r in tokenizer().encode(frame).collect()}
    codec = bpe.Codec(ranks := bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), bpe.model_bytes(ranks), public_tokenizers.PATTERN)
    for i, ids in enumerate(codec.encode(texts)):
        assert found[i] == ids
