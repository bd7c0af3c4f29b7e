"""Quality by a sparse rule ensemble compiled to column expressions.

Statistics of whole texts feed a small forest; every path from a root to a node is a rule, a
conjunction of bounds on statistics.  A lasso logistic regression weighs the rules, most
of them with zero; the rest become one expression over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm import words
from wagegrid.llm.common import map_batches

#: Labelled rows that rules and weights are fitted on, about; drawn by a hash of the id.
SAMPLE = 20_000
TREES = 12
DEPTH = 3
#: Strength of the lasso.
LASSO = 0.0005
#: Least score of a predicted 1.
PREDICTED = 0.7

STATISTICS = (
    "words", "word_length", "distinct_words", "top_word", "repeats", "distinct_pairs", "upper", "digits",
    "stops", "symbols", "pipes", "marks", "wide", "long_words", "line_length", "distinct_lines",
    "mark_ends", "capital_words",
)

_KIND = np.zeros(256, np.int8)
_KIND[65:91] = 1  # capitals
_KIND[97:123] = 2
_KIND[48:58] = 3
_KIND[list(b".,;:")] = 4
_KIND[list(b"!?")] = 5
_KIND[list(b"|")] = 6
_KIND[list(b"#$%&*+<=>@\\^_`~{}[]/")] = 7
_KIND[128:] = 8


def _shares(kind: np.ndarray, offsets: np.ndarray, which: int) -> np.ndarray:
    sums = np.zeros(len(kind) + 1, np.int64)
    np.cumsum(kind == which, out=sums[1:])
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def _spans(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def text_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """One number per text and statistic; a null or empty text has zeros."""
    data, at = words.text_bytes(texts)
    out: dict[str, list[np.ndarray]] = {name: [] for name in STATISTICS}
    for part in words.each_words(texts):
        offsets = at[part.first : part.last + 1] - at[part.first]
        kind = _KIND[data[at[part.first] : at[part.last]]]
        n = np.diff(part.bounds)
        each = np.maximum(n, 1)
        lengths = (part.ends - part.starts).astype(np.float64)
        letters = _shares(kind, offsets, 1) + _shares(kind, offsets, 2)
        out["words"].append(n.astype(np.float64))
        out["word_length"].append(_spans(lengths, part.bounds) / each)
        out["long_words"].append(_spans(lengths > 20, part.bounds) / each)
        out["upper"].append(_shares(kind, offsets, 1) / np.maximum(letters, 1e-9))
        for name, which in (("digits", 3), ("stops", 4), ("marks", 5), ("pipes", 6), ("symbols", 7), ("wide", 8)):
            out[name].append(_shares(kind, offsets, which))
        last = kind[part.ends - 1] if len(part.ends) else np.zeros(0, np.int8)
        first = kind[part.starts] if len(part.starts) else np.zeros(0, np.int8)
        out["mark_ends"].append(_spans(np.isin(last, (5, 7)), part.bounds) / each)
        out["capital_words"].append(_spans(first == 1, part.bounds) / each)
        same = np.zeros(len(part.hashes), bool)
        same[1:] = part.hashes[1:] == part.hashes[:-1]
        same[part.bounds[:-1][part.bounds[:-1] < len(same)]] = False
        out["repeats"].append(_spans(same, part.bounds) / each)
        few, top, pairs, lines, widths = [], [], [], [], []
        breaks = np.flatnonzero(data[at[part.first] : at[part.last]] == 10)
        for i in range(part.last - part.first):
            own = np.sort(part.hashes[part.bounds[i] : part.bounds[i + 1]])
            marks = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])) if len(own) else np.zeros(1, int)
            few.append((len(marks) - 1) / max(len(own), 1))
            top.append((np.diff(marks).max() if len(own) else 0) / max(len(own), 1))
            runs = words.shingle_hashes(part.hashes[part.bounds[i] : part.bounds[i + 1]], 2)
            pairs.append(len(words.distinct(runs)) / max(len(runs), 1))
            inside = breaks[np.searchsorted(breaks, offsets[i]) : np.searchsorted(breaks, offsets[i + 1])]
            edges = np.concatenate([[offsets[i]], inside, [offsets[i + 1]]])
            begins = part.hashes[np.minimum(np.searchsorted(part.starts, edges[:-1]), max(len(part.hashes) - 1, 0))] \
                if len(part.hashes) else edges[:-1]
            lines.append(len(np.unique(begins)) / len(begins))
            widths.append((offsets[i + 1] - offsets[i]) / len(begins))
        for name, values in (("distinct_words", few), ("top_word", top), ("distinct_pairs", pairs),
                             ("distinct_lines", lines), ("line_length", widths)):
            out[name].append(np.array(values, np.float64))
    return {name: np.concatenate(v) if v else np.zeros(0) for name, v in out.items()}


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of every row's whole text."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = text_statistics(batch.column("text"))
        return pa.record_batch({"doc_id": batch.column("doc_id"), **{k: pa.array(v) for k, v in found.items()}})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, run, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


#: A bound on a statistic: (name, True for "at most", threshold).
Bound = tuple[str, bool, float]


@dataclass
class Rules:
    """Weighted rules; a rule is a set of bounds that all hold."""

    intercept: float
    weights: dict[frozenset[Bound], float]

    def score(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in sorted(self.weights.items(), key=lambda x: sorted(x[0])):
            total = total + F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def condition(rule: frozenset[Bound]) -> Column:
    found = F.lit(True)
    for name, below, bound in sorted(rule):
        found = found & (F.col(name) <= bound if below else F.col(name) > bound)
    return found


def tree_rules(model) -> list[frozenset[Bound]]:
    """The rules of all paths in a forest over ``STATISTICS``."""
    found: dict[frozenset[Bound], None] = {}

    def walk(node, path: dict[tuple[str, bool], float]) -> None:
        if path:
            found[frozenset((name, below, t) for (name, below), t in path.items())] = None
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, bound = STATISTICS[split.featureIndex()], split.threshold()
        low, high = path.get((name, True), bound), path.get((name, False), bound)
        walk(node.leftChild(), path | {(name, True): min(bound, low)})
        walk(node.rightChild(), path | {(name, False): max(bound, high)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def learn_rules(labelled: DataFrame, sample: int = SAMPLE, seed: int = 3) -> Rules:
    """Rules and weights from rows of statistics with an int ``label``.

    About ``sample`` rows take part, chosen by a hash of doc_id.  Rows with a null label
    do not.  With one label only, or no rows, the score is that label, or a half.
    """
    labelled = labelled.where("label IS NOT NULL")
    counts = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Rules({0: -30.0, 1: 30.0}.get(next(iter(counts), None), 0.0), {})
    rate = min(1.0, sample / sum(counts.values()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int(rate * (1 << 30))
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features")
    held = settings.written(labelled.where(chosen).withColumn("label", F.col("label").cast("double")), "rule-sample", compact=True)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="0.5", maxBins=64,
    ).fit(vectors.transform(held).select("features", "label"))
    rules = tree_rules(forest)
    if not rules:
        share = counts.get(1, 0) / sum(counts.values())
        return Rules(float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), {})
    names = [f"rule{i}" for i in range(len(rules))]
    on = held.select("label", *[condition(r).cast("double").alias(n) for r, n in zip(rules, names, strict=True)])
    on = VectorAssembler(inputCols=names, outputCol="features").transform(on).select("features", "label")
    model = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(settings.written(on, "rules", compact=True))
    weights = model.coefficients.toArray().tolist()
    return Rules(float(model.intercept), {r: w for r, w in zip(rules, weights, strict=True) if w})


def score_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier) and predicted for every row of ``docs``.

    Learns from labels of rows where ``learn`` (over doc_id) holds; scores see the text
    alone.  A null text scores as an empty one.  Several labels of one doc_id count as
    one, the smallest.  Repeated rows each get their result; other columns are not looked at.
    """
    found = settings.written(statistics(docs, id_col, text_col), "statistics")
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.where(learn & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"))
    rules = learn_rules(found.join(marks, "doc_id"))
    return found.withColumn("score", rules.score()).select(
        "doc_id", "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted")
    )
