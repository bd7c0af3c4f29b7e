"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm import (
    ann,
    bpe,
    hmm,
    html_extract,
    language,
    line_dedup,
    merkle,
    mixing,
    near_text,
    near_vectors,
    periodic,
    quality,
    warc,
)
from wagegrid.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: The vocabulary file and the pattern of the tokenizer queries.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def tokenizer(name: str = VOCABULARY) -> bpe.Tokenizer:
    return bpe.Tokenizer(public_tokenizers.path(name), public_tokenizers.PATTERN)


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return settings.spread(spark.read.parquet(f"{folder}/{name}.parquet").select(*columns))


@_query
def op1_projected_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@_query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    kept_back = held_out(F.col("doc_id"), 4, 2)
    scored = quality.score_quality(docs, labels, learn=~kept_back)
    return scored.select("doc_id", kept_back.alias("held_out"), "score", "predicted")


@_query
def op3_language_ranks(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text", "lang")
    kept_back = held_out(F.col("doc_id"), 3, 1)
    found = language.predict_language(docs, language.learn_profiles(docs.where(~kept_back)))
    return found.select("doc_id", kept_back.alias("held_out"), "lang_pred", "score")


@_query
def op4_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizer().digests(_table(spark, folder, "documents", "doc_id", "text"))


@_query
def op5_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, folder, "documents", "doc_id", "text"))


@_query
def op6_block_labeller(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages", "page_id", "url", "html")
    return html_extract.extract_text(pages, html_extract.learn_labeller(pages))


@_query
def op7_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    kept_back = held_out(F.col("doc_id"), 7, 2)
    scored = hmm.score_documents(docs, learn=~kept_back)
    return scored.select(
        "doc_id", kept_back.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op8_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return near_text.near_duplicates(_table(spark, folder, "documents", "doc_id", "text"), shingle=2, percent=80)


@_query
def op9_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, folder, "embeddings", "vec_id", "embedding"), cosine=0.95)


@_query
def op10_splitting_tree(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(*mixing.mix(_table(spark, folder, "documents", "doc_id", "text", "source")))


@_query
def op11_chunked_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages", "page_id", "url", "html")
    return warc.round_trip(pages, settings.new_folder(spark, "warc"))


@_query
def op12_recompressed_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return periodic.run_digests(docs, repeat=F.when(crc % 10 == 0, F.floor(crc / 10)))


@_query
def op13_pointer_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "source", "lang", "n_chars", "text")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return merkle.checked_manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], tree="lang", key="doc_id",
        tampered=crc % 7 == 0, changed={"n_chars": F.col("n_chars") + 1},
    )


_WORD = r"[^\x20\x09-\x0D]+"


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text of ASCII characters, bit by bit."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_value(ascii(substr({text}, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1)))"
    shifted = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {steps}), "
        f"lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE {shifted} END))"
    )


#: SQL twins, for the operators whose result SQL can state.
SQL: dict[str, str] = {}

SQL["op8_minhash_bayes"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM w),
sized AS (SELECT doc_id, s, len(s) AS n FROM s),
flat AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared, any_value(a.n) AS n, any_value(b.n) AS m
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id),
link AS (SELECT x, y FROM common WHERE 100 * shared >= 80 * (n + m - shared)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sized
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
least AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT doc_id, n AS n_shingles, c AS component_id, doc_id = c AS kept FROM sized JOIN least ON x = doc_id
"""

SQL["op9_multi_index"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) = len(list_filter(e, lambda x: isfinite(x)))
    AND list_sum(list_transform(e, lambda x: x * x)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
least AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, l.c AS component_id, v.vec_id = l.c AS kept
FROM v JOIN least l ON l.x = v.vec_id LEFT JOIN degree d ON d.x = v.vec_id
"""

_FIVE_BITS = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, 5 * {i} + 1, 5))::BIGINT >> {shift}) & 31) + 1, 1)"
_BASE32 = " || ".join(_FIVE_BITS.format(i=i, shift=shift) for i in range(8) for shift in (15, 10, 5, 0))

SQL["op11_chunked_warc"] = f"""
SELECT page_id, strlen(payload) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, payload, sha1(payload) AS sha, max(page_id) OVER (PARTITION BY payload) AS last
      FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))
"""

_SIZED = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_SIZED.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"
_HEIGHT = "CASE WHEN count(*) > 1 THEN length(bin(count(*) - 1)) ELSE 0 END"

SQL["op13_pointer_manifest"] = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF.format(n_chars="n_chars")} AS leaf,
    {_LEAF.format(n_chars="(n_chars + 1)")} AS changed, {_crc32_sql("doc_id::VARCHAR")} % 7 = 0 AS tampered
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaf),
height AS (SELECT tree, {_HEIGHT} AS height FROM placed GROUP BY tree),
node AS (
  SELECT tree, 0 AS level, place, leaf AS h FROM placed
  UNION ALL
  SELECT n.tree, n.level + 1, n.place // 2, sha256(string_agg(n.h, '' ORDER BY n.place))
  FROM node n JOIN height t ON n.tree = t.tree AND n.level < t.height GROUP BY n.tree, n.level, n.place // 2),
sub AS (
  SELECT n.tree, n.h AS subroot, row_number() OVER (ORDER BY n.tree) - 1 AS place
  FROM node n JOIN height t ON n.tree = t.tree AND n.level = t.height),
top_height AS (SELECT {_HEIGHT} AS height FROM sub),
top AS (
  SELECT 0 AS level, place, subroot AS h FROM sub
  UNION ALL
  SELECT n.level + 1, n.place // 2, sha256(string_agg(n.h, '' ORDER BY n.place))
  FROM top n, top_height t WHERE n.level < t.height GROUP BY n.level, n.place // 2),
root AS (SELECT h AS root FROM top, top_height WHERE level = height),
step AS (
  SELECT p.tree, p.place, l.level AS step, s.h AS sibling, (p.place >> l.level) & 1 AS odd
  FROM placed p JOIN height t ON p.tree = t.tree, LATERAL (SELECT unnest(range(0, t.height)) AS level) l
  LEFT JOIN node s ON s.tree = p.tree AND s.level = l.level AND s.place = xor(p.place >> l.level, 1)
  UNION ALL
  SELECT p.tree, p.place, t.height + l.level, s.h, (u.place >> l.level) & 1
  FROM placed p JOIN height t ON p.tree = t.tree JOIN sub u ON u.tree = p.tree, top_height h,
    LATERAL (SELECT unnest(range(0, h.height)) AS level) l
  LEFT JOIN top s ON s.level = l.level AND s.place = xor(u.place >> l.level, 1)),
proof AS (SELECT tree, place, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof FROM step GROUP BY tree, place),
folding AS (
  SELECT tree, place, 0 AS step, CASE WHEN tampered THEN changed ELSE leaf END AS h FROM placed
  UNION ALL
  SELECT f.tree, f.place, f.step + 1,
    sha256(CASE WHEN s.odd = 1 THEN s.sibling || f.h ELSE f.h || coalesce(s.sibling, '') END)
  FROM folding f JOIN step s ON s.tree = f.tree AND s.place = f.place AND s.step = f.step),
folded AS (SELECT tree, place, arg_max(h, step) AS h FROM folding GROUP BY tree, place)
SELECT p.doc_id, p.leaf, s.subroot, r.root, coalesce(o.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.root AS verified
FROM placed p JOIN sub s ON s.tree = p.tree JOIN folded f ON f.tree = p.tree AND f.place = p.place, root r
LEFT JOIN proof o ON o.tree = p.tree AND o.place = p.place
"""
