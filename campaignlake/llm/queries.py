"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import os
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_text, langid, licenses, merkle, mixing, neardup, neighbours, packing, periodic, pii, quality, setjoin, toxicity
from .common import remainder, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file (``LLM_TOKENIZER_DIR`` overrides)."""
    folder = os.environ.get("LLM_TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = packing.tokenize(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(tokens, with_ids=False)


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 20 = 0"), 20)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(table(spark, sf_dir, "documents"), remainder("doc_id", 4) != 2)
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return out.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return out.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "n_misspelled", "n_quoted")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op10_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_components(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(remainder("doc_id", 3) == 0, merkle.leaf_digest(*[lowered if c == "text" else F.col(c) for c in merkle.COLUMNS]))
    manifest = merkle.build(docs, tampered=tampered)
    proved = merkle.prove(manifest)
    root = F.lit(manifest.root).cast("binary")
    folded = merkle.fold(F.coalesce("tampered", "digest"), F.col("proof"))
    return proved.select(F.col("order").alias("doc_id"), merkle.hex_text(F.col("digest")).alias("leaf"),
                         merkle.hex_text(F.col("subroot")).alias("subroot"), merkle.hex_text(root).alias("root"),
                         merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                         merkle.hex_text(folded).alias("folded_root")).withColumn(
                             "verified", F.col("folded_root") == F.col("root"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; where 10 divides the id's crc32, the words from one
    place on repeat with a period, both following from the crc32."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"),
                                                              (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(*[F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")])
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), "best.length",
        (-F.col("best.p")).alias("period"), F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    def names(c: str) -> Column:
        return F.transform(c, lambda x: x["label"])

    def listed(a: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(a)), ",")

    found, starts = licenses.scan(table(spark, sf_dir, "documents")), F.transform("places", lambda x: x["start"])
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        listed(names("places")).alias("base_labels"),
                        listed(F.concat(names("places"), names("notices"))).alias("labels"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_hnsw": op2_hnsw,
    "op3_mix": op3_mix,
    "op4_neardup": op4_neardup,
    "op5_langid": op5_langid,
    "op6_quality": op6_quality,
    "op7_html": op7_html,
    "op8_toxicity": op8_toxicity,
    "op9_pii": op9_pii,
    "op10_setjoin": op10_setjoin,
    "op11_manifest": op11_manifest,
    "op12_runs": op12_runs,
    "op13_licenses": op13_licenses,
}
_REACH = """
closure(node, low) AS (SELECT a, a FROM links UNION SELECT l.b, c.low FROM closure c JOIN links l ON l.a = c.node
                       WHERE c.low < l.b),
found AS (SELECT node, MIN(low) AS low FROM closure GROUP BY node)"""

_TREE = """
  SELECT {key}, lvl + 1, rank // 8, sha256(string_agg(d, '' ORDER BY rank)), (n + 7) // 8
  FROM {tree} WHERE n > 1 GROUP BY {key}, lvl, rank // 8, n"""
_SEGMENTS = """
  SELECT x.{key}, x.lvl, x.rank, COALESCE(string_agg(y.d, '' ORDER BY y.rank) FILTER (y.rank < x.rank), '') AS l,
         COALESCE(string_agg(y.d, '' ORDER BY y.rank) FILTER (y.rank > x.rank), '') AS r
  FROM {tree} x JOIN {tree} y ON x.{key} = y.{key} AND x.lvl = y.lvl AND x.rank // 8 = y.rank // 8
  WHERE x.n > 1 GROUP BY ALL"""
_LEAF = "sha256(" + " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_TEXTS = [(t, label, licenses.plain_words(text), [licenses.plain_words(k) for k in keys])
          for t, (label, text, keys) in enumerate(licenses.TEMPLATES)]
_NAMES = [(licenses.plain_words(p), label) for p, label in licenses.PHRASES.items()]
_AHEAD = 2 * licenses.SLACK * (1 + max(len(w) for _, _, w, _ in _TEXTS))
_NOTICES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED.replace("text", "COALESCE(text, '')", 1)},
                                                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tw(t, pos, word) AS (VALUES {_values([(t, i, x) for t, _, w, _ in _TEXTS for i, x in enumerate(w)])}),
keys(t, pos, k) AS (VALUES {", ".join(f"({t}, {licenses._position(w, k)}, {k})" for t, _, w, ks in _TEXTS for k in ks)}),
named(t, label) AS (VALUES {_values([(t, label) for t, label, _, _ in _TEXTS])}),
flat AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
seen AS (SELECT word, COUNT(DISTINCT r) AS df FROM flat WHERE word IN (SELECT word FROM tw) GROUP BY word),
ranked AS (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY COALESCE(df, 0), word) AS k
           FROM (SELECT DISTINCT t, word FROM tw) LEFT JOIN seen USING (word)),
rare AS (SELECT t, word, COUNT(*) OVER (PARTITION BY t) AS size FROM ranked WHERE k <= {licenses.RARE}),
agreed AS (SELECT r, t, size, g, (i - pos + {_AHEAD} + g * {licenses.SLACK}) // {2 * licenses.SLACK} AS b, COUNT(DISTINCT word) AS m
           FROM flat JOIN rare USING (word) JOIN tw USING (t, word), range(2) x(g)
           GROUP BY ALL HAVING COUNT(DISTINCT word) >= ceil({licenses.SHARE} * size)),
starts AS (SELECT r, t, m / size AS share, b * {2 * licenses.SLACK} - {_AHEAD} - g * {licenses.SLACK} AS s FROM agreed),
stand AS (SELECT DISTINCT s.* FROM starts s JOIN d USING (r) WHERE NOT EXISTS (
            SELECT 1 FROM keys k WHERE k.t = s.t AND len(list_filter(
              range(greatest(s.s + k.pos - {licenses.SLACK}, 0), greatest(s.s + k.pos + {3 * licenses.SLACK} + 1, 0)),
              lambda p: d.w[p + 1:p + len(k.k)] = k.k)) = 0)),
places AS (SELECT r, label, unnest(list_filter(range(len(w)), lambda p: w[p + 1:p + len(k)] = k)) AS s
           FROM d, (VALUES {", ".join(f"({w}, '{label}')" for w, label in _NAMES)}) p(k, label)),
found AS (SELECT r, label FROM places UNION SELECT r, label FROM stand JOIN named USING (t))"""

# SQL can express the exact joins and digests; the other results come from trained models,
# random codes or graphs, hashes or positions in texts (see tests/llm).
ORACLE: dict[str, str] = {
    "op4_neardup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id
          AND len(p.e) = len(q.e) AND list_cosine_similarity(p.e, q.e) >= 0.93),
n AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a), {_REACH}
SELECT m.vec_id, COALESCE(n.n, 0) AS n_links, COALESCE(f.low, m.vec_id) AS component_id,
       m.vec_id = COALESCE(f.low, m.vec_id) AS kept
FROM embeddings m LEFT JOIN n ON n.a = m.vec_id LEFT JOIN found f ON f.node = m.vec_id""",
    "op10_setjoin": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
common AS (SELECT p.doc_id AS a, q.doc_id AS b, p.n AS na, q.n AS nb, COUNT(*) AS c FROM e p JOIN e q USING (x)
           WHERE p.doc_id <> q.doc_id AND 100 * p.n >= 90 * q.n AND 100 * q.n >= 90 * p.n GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 90 * (na + nb - c)), {_REACH}
SELECT s.doc_id, len(s.s) AS n_shingles, COALESCE(f.low, s.doc_id) AS component_id
FROM s LEFT JOIN found f ON f.node = s.doc_id""",
    "op11_manifest": f"""
WITH RECURSIVE codes AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, s: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t FROM range(256) r(i)),
ids AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id FROM documents),
crc AS (SELECT id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(id, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS c FROM ids, codes),
leaves AS (SELECT doc_id, lang, {_LEAF.format(text="text")} AS leaf,
             CASE WHEN c % 3 = 0 THEN {_LEAF.format(text=_LOWERED)} ELSE {_LEAF.format(text="text")} END AS shown
           FROM documents LEFT JOIN crc ON id = CAST(doc_id AS VARCHAR)),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, COUNT(*) OVER (PARTITION BY lang) AS n,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves),
nodes AS (SELECT tree, 0 AS lvl, rank, leaf AS d, n FROM ranked UNION ALL {_TREE.format(key="tree", tree="nodes")}),
subroots AS (SELECT tree, d FROM nodes WHERE n = 1),
above AS (SELECT 0 AS tree, 0 AS lvl, tree AS rank, d, COUNT(*) OVER () AS n FROM subroots
          UNION ALL {_TREE.format(key="tree", tree="above")}),
low AS ({_SEGMENTS.format(key="tree", tree="nodes")}),
high AS ({_SEGMENTS.format(key="tree", tree="above")}),
steps AS (SELECT tree, list({{'l': l, 'r': r, 'd': ''}} ORDER BY lvl) AS p FROM (
            SELECT s.tree, h.lvl, h.l, h.r FROM subroots s JOIN high h ON h.rank = s.tree // CAST(pow(8, h.lvl) AS BIGINT)) GROUP BY tree),
paths AS (SELECT k.tree, k.rank, list({{'l': l, 'r': r, 'd': ''}} ORDER BY lvl) AS p
          FROM ranked k JOIN low w ON w.tree = k.tree AND w.rank = k.rank // CAST(pow(8, w.lvl) AS BIGINT) GROUP BY ALL),
proofs AS (SELECT k.*, s.d AS subroot, (SELECT d FROM above WHERE n = 1) AS root,
             list_concat(COALESCE(p.p, []), COALESCE(h.p, [])) AS p
           FROM ranked k JOIN subroots s USING (tree) LEFT JOIN paths p ON p.tree = k.tree AND p.rank = k.rank
           LEFT JOIN steps h ON h.tree = k.tree),
folded AS (SELECT *, list_reduce(list_concat([{{'l': '', 'r': '', 'd': shown}}], p),
                                 lambda a, s: {{'l': '', 'r': '', 'd': sha256(s.l || a.d || s.r)}}).d AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root,
       folded_root = root AS verified FROM folded""",
    "op13_licenses": f"""{_NOTICES},
b AS (SELECT r, COUNT(*) AS n, MIN(s) AS first, MAX(s) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found GROUP BY r),
m AS (SELECT r, MAX(share) AS share FROM stand GROUP BY r)
SELECT doc_id, len(w) AS n_words, COALESCE(n, 0) AS n_base, first AS first_word, last AS last_word, COALESCE(b.labels, '') AS base_labels,
       COALESCE(l.labels, '') AS labels, CASE WHEN n > 0 THEN 1.0 ELSE COALESCE(share, 0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r) LEFT JOIN m USING (r)""",
}
