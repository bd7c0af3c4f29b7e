"""Vectors, pages, quality, the pipeline and the entry without this package."""

import random
import subprocess
import sys
import time

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from wagegrid.llm import ann, graph, html_extract, near_vectors, quality
from wagegrid.llm.common import held_out
from wagegrid.llm.markup_blocks import read_blocks


def usable(vectors):
    rows = {r.vec_id: r.embedding for r in vectors.collect() if r.vec_id is not None and r.embedding and len(r.embedding) == 8}
    return {i: np.array(v) for i, v in rows.items() if None not in v and np.isfinite(v).all() and any(v)}


def test_nearest(vectors):
    got = ann.nearest(vectors, vectors.where("vec_id % 5 = 0"), k=20).collect()
    held = usable(vectors)
    asked = [i for i in held if i % 5 == 0]
    assert {r.query_id for r in got} == set(asked)
    hits = total = 0
    for q in asked:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        best = sorted(((-(held[q] * v).sum(), i) for i, v in held.items() if i != q))[:20]
        assert [r.rank for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(abs(r.score - (held[q] * held[r.vec_id]).sum()) <= 1e-9 * abs(r.score) for r in own)
        hits += len({r.vec_id for r in own} & {i for _, i in best})
        total += 20
    assert hits >= 0.9 * total


def test_nearest_with_few_or_no_candidates(spark, vectors):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [2.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.nearest(few, few.where("vec_id % 20 = 0"), k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 3, 2.0), (0, 2, 20, 1.0), (20, 1, 3, 2.0), (20, 2, 0, 1.0)]
    none = vectors.where("vec_id < -1")
    assert ann.nearest(none, none).collect() == []


def test_search_by_parts_reaches_recall():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(3000, 32))
    import pandas as pd

    search = ann._Search(32, 10)
    top = float(np.sqrt((x * x).sum(axis=1)).max())
    asked = pd.DataFrame({"query_id": range(100_000, 100_060), "vector": list(draw.normal(size=(60, 32))), "bound": -np.inf})
    got = search.in_region(pd.DataFrame({"vec_id": range(3000), "vector": list(x)}), asked, top)
    hits = 0
    for q, v in zip(asked["query_id"], asked["vector"], strict=True):
        hits += len(set(np.argsort(-(x @ v))[:10]) & set(got["vec_id"][got["query_id"] == q]))
    assert hits >= 0.95 * 600
    assert abs(ann.chi_square_point(12, 0.95) - 21.026) < 1e-3


def test_near_vectors_equal_brute_force(vectors):
    got = near_vectors.near_vectors(vectors, 0.95).collect()
    held = usable(vectors)
    unit = {i: v / np.sqrt((v * v).sum()) for i, v in held.items()}
    links = {(a, b) for a in unit for b in unit if a != b and (unit[a] * unit[b]).sum() >= 0.95}
    least = {i: i for i in held}
    for _ in held:
        for a, b in links:
            least[a] = min(least[a], least[b])
    assert len(got) == vectors.count() and links
    for r in got:
        assert r.n_links == sum(a == r.vec_id for a, _ in links)
        assert r.component_id == least.get(r.vec_id, r.vec_id)
        assert r.kept == (r.component_id == r.vec_id)
    assert near_vectors.near_vectors(vectors.where("vec_id < -1")).collect() == []


def test_traversal_visits_by_growing_distance():
    first, second = np.array([0.0, 0.3, 0.1]), np.array([0.2, 0.0])
    i, j = near_vectors.traversal(first, second, 0.31)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 0), (2, 1)]
    sums = first[i] + second[j]
    assert (np.diff(sums) >= -1e-12).all()


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    least = {n: n for e in links for n in e if n is not None}
    for _ in range(70):
        for a, b in links:
            if a is not None and b is not None:
                least[a] = least[b] = min(least[a], least[b])
    assert got == {n: c for n, c in least.items() if n != c}


def test_blocks_of_awkward_pages():
    began = time.perf_counter()
    pages = ['<a href="x>t</a>' + "<p>abc</p>" * 20_000, "<b>" * 20_000, "<div class=result>" * 20_000 + "x", "<li>x" * 20_000,
             "<a " + ' x="y"' * 20_000 + ">t", "<!--" * 20_000, "<script>" * 20_000, '<a "' * 20_000, None, "", "<", "a < b"]
    read = [read_blocks(p) for p in pages]
    assert time.perf_counter() - began < 20
    assert len(read[0]) >= 20_000 and read[-1][0].text == "a < b" and read[-3] == read[-4] == []
    page = "<p>One&nbsp;<b>two</b>three<br>four &lt;5<script>no</script><style>p{}</style><!-- no --> six</p>"
    assert [b.text for b in read_blocks(page)] == ["One twothree", "four <5", "six"]


def test_labeller_learns_and_generalises(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    labeller = html_extract.learn_labeller(pages)
    rows = [read_blocks(r.html) for r in pages.collect()]
    right = total = 0
    for blocks, p in zip(rows, labeller.label(rows), strict=True):
        right += sum((q >= 0.5) == html_extract.page_label(b) for b, q in zip(blocks, p, strict=True))
        total += len(blocks)
    assert right >= 0.98 * total
    draw, right, total = random.Random(99), 0, 0
    content = [b.text for b in rows[0] if html_extract.page_label(b)]
    other = [b.text for b in rows[1]]
    for _ in range(30):
        made = read_blocks(html_extract.made_up_page(content, other, draw))
        p = labeller.label([made])[0]
        right += sum((q >= 0.5) == b.mark for b, q in zip(made, p, strict=True) if b.mark is not None)
        total += sum(b.mark is not None for b in made)
    assert right >= 0.9 * total
    odd = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 2), (None, "u", "<p>", 3)], "page_id long, url string, html string, text int")
    got = html_extract.extract_text(odd, labeller).collect()
    assert [(r.text, r.n_chars) for r in got] == [("", 0)] * 3
    assert html_extract.extract_text(pages.limit(0), html_extract.learn_labeller(pages.limit(0))).collect() == []


def test_quality_rules(spark, docs, no_docs):
    draw = random.Random(4)
    good = [(1000 + i, " ".join(draw.choice(["plain", "words", "of", "a", "text", f"w{draw.randrange(99)}"]) for _ in range(60)), 1) for i in range(150)]
    bad = [(2000 + i, " ".join(draw.choice(["BUY!!", "$$$", "now%%"]) for _ in range(60)), 0) for i in range(150)]
    texts = spark.createDataFrame(good + bad, "doc_id long, text string, label int")
    labels = texts.select("doc_id", F.col("label").alias("quality"))
    kept_back = held_out(F.col("doc_id"), 4, 2)
    got = {r.doc_id: r for r in quality.score_quality(texts, labels, ~kept_back).collect()}
    assert sum(got[i].predicted == y for i, _, y in good + bad) >= 0.98 * 300
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    one = quality.score_quality(docs, labels.where("quality = 1").withColumn("doc_id", F.col("doc_id") - 1000), F.lit(True))
    assert one.count() == docs.count() and {r.predicted for r in one.collect()} == {1}
    assert {r.score for r in quality.score_quality(docs, labels.where("false"), F.lit(True)).collect()} == {0.5}
    assert quality.score_quality(no_docs, labels, F.lit(True)).collect() == []


def test_pipeline_stages(spark, docs, no_docs):
    stages = dict(corpus_pipeline.STAGES)
    frame = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (frame, no_docs.select(*frame.columns)):
        held = rows
        for name, stage in stages.items():
            held = stage(spark, held, "")
            if name != "tokens":
                assert held.columns == frame.columns
            held = spark.createDataFrame(held.collect(), held.schema)
        assert held.columns == [*frame.columns, "ids", "n_tokens"]
    named = {r.doc_id for r in stages["language"](spark, frame, "").collect()}
    assert not named & {150, 151, 152, 155, 156} and set(range(5)) <= named
    twice = spark.createDataFrame([(1, "a b c d e f g", "en", "s", 13)] * 3 + [(2, "a b c d e f g", "en", "s", 13), (3, "x", "en", "s", 1)], frame.schema)
    assert sorted(r.doc_id for r in stages["near_documents"](spark, twice, "").collect()) == [1, 3]
    assert sorted(r.doc_id for r in stages["lines"](spark, twice.distinct(), "").collect()) == [1, 3]


def test_entry_without_this_package():
    code = (
        "import sys; sys.modules.update({'wagegrid.llm': None, 'corpus_pipeline': None})\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) >= 83 and not any(n.startswith('op') and n[2].isdigit() for n in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries()) and 'pipeline' not in e.queries()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
