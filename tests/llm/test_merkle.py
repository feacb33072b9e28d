import hashlib
import string
import zlib

from pyspark.sql import functions as F

from campaignlake.llm import merkle, queries

from .tables import DOCS, awkward_docs, docs_frame

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        run = i // 8 * 8
        yield "".join(level[run:i]), "".join(level[i + 1:run + 8])
        i //= 8


def brute_force(rows):
    """Rows (doc_id, text, lang, source, n_chars) -> the query's rows."""
    groups = {}
    for d, text, lang, source, n in rows:
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf((d, source, lang, n, text)), (d, text, lang, source, n)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order]
    top, out = tree([t[-1][0] for t in trees]), []
    for k, g in enumerate(order):
        for i, (_, _, own, (d, text, lang, source, n)) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = [*siblings(trees[k], i), *siblings(top, k)]
            now = own
            if d is not None and text is not None and zlib.crc32(str(d).encode()) % 3 == 0:
                now = leaf((d, source, lang, n, text.translate(LOWER)))
            for left, right in path:
                now = digest(left + now + right)
            out.append((d, own, trees[k][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), now, now == top[-1][0]))
    return sorted(out, key=str)


def run(spark, tmp_path, rows, partitions=3):
    # a column of another meaning under the operator's inner names
    docs = spark.createDataFrame(rows, DOCS).repartition(partitions)
    for c in ("digest", "rank", "tree", "order", "group", "path", "children", "tampered", "height"):
        docs = docs.withColumn(c, F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11_manifest(spark, str(tmp_path)).collect()), key=str)


def test_awkward_rows_ragged_levels_many_groups_and_repeats(spark, tmp_path):
    rows = awkward_docs() + [(None, "AbC é", None, None, None)]
    # groups of 1, 8, 9, 64, 65 and 130 leaves, twenty of one leaf (two levels above the groups), a row 150 times
    sizes, k = {"a": 1, "b": 8, "c": 9, "ü": 64, None: 65, "": 130, **{f"g{i}": 1 for i in range(20)}}, 0
    for g, n in sizes.items():
        for _ in range(n):
            k += 1
            rows.append((k * 7919 % 10_007, f"Text {k} É", g, "s", k))
    rows += [(5, "Same", "en", "s", 4)] * 150
    assert run(spark, tmp_path, rows, partitions=8) == brute_force(rows)


def test_one_leaf_and_empty_table(spark, tmp_path):
    rows = [(1, None, None, None, None)]
    assert run(spark, tmp_path / "one", rows) == brute_force(rows)
    assert run(spark, tmp_path / "none", []) == []


def test_requested_proofs_only(spark):
    manifest = merkle.build(docs_frame(spark, clash=False))
    every = {(r["tree"], r["rank"]): r for r in merkle.prove(manifest).collect()}
    asked = [k for i, k in enumerate(sorted(every)) if i % 5 == 0]
    requests = spark.createDataFrame(asked + asked[:2], "tree long, rank long")
    got = merkle.prove(manifest, requests)
    found = {(r["tree"], r["rank"]): r.asDict(True) for r in got.collect()}
    assert found == {k: every[k].asDict(True) for k in asked}
    root = F.lit(manifest.root)
    assert got.where(merkle.fold(F.col("digest"), F.col("proof")) != root).count() == 0
    # another leaf does not fold to the root
    assert got.where(merkle.fold(F.reverse("digest").cast("binary"), F.col("proof")) == root).count() == 0


def test_records_are_content_addressed(spark):
    manifest = merkle.build(docs_frame(spark, [(7, "same", "en", "s", 4)] * 64, clash=False))
    # eight equal nodes at the first level are one record
    assert manifest.levels[0].count() == 1
    for r in manifest.levels[0].collect() + manifest.levels[1].collect():
        assert hashlib.sha256("".join(c.hex() for c in map(bytes, r["children"])).encode()).digest() == bytes(r["digest"])
