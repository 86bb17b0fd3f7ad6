"""Merkle trees against a brute-force version."""

import hashlib

import pytest
from pyspark.sql import functions as F

from oreflow.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves, fan):
    """The root and, for each leaf, (left, right) digests of its runs from the leaf up."""
    paths = [[] for _ in leaves]
    nodes = [(h, [k]) for k, h in enumerate(leaves)]
    while len(nodes) > 1:
        parents = []
        for at in range(0, len(nodes), fan):
            run = nodes[at : at + fan]
            for k, (_, own) in enumerate(run):
                for i in own:
                    paths[i].append(("".join(h for h, _ in run[:k]), "".join(h for h, _ in run[k + 1 :])))
            parents.append((sha(*(h for h, _ in run)), sum((own for _, own in run), [])))
        nodes = parents
    return nodes[0][0], paths


def brute(rows, fan):
    """(doc_id, lang, leaf, subroot, root, path) of rows (doc_id, lang, text)."""
    groups = {}
    for doc_id, lang, text in rows:
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf((doc_id, lang, text)), doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in names]
    root, upper = tree([r for r, _ in trees], fan)
    out = []
    for g, (subroot, paths), above in zip(names, trees, upper):
        for (_, _, h, doc_id), path in zip(sorted(groups[g], key=lambda x: x[:3]), paths):
            out.append((doc_id, g, h, subroot, root, tuple(path + above)))
    return out


def got(df):
    return [(r.doc_id, r.lang, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in df.collect()]


def key(row):
    return (row[0] is not None, row[0] or 0, row[1] or "", row[2:])


ROWS = (
    [(k, "en", f"text {k}") for k in range(75)]
    + [(k, "fr", "é" * k) for k in range(100, 116)]
    + [(5, "en", "text 5"), (5, "en", "another"), (None, "en", None), (None, "en", ""), (None, None, None)]
    + [(300, "", "no language"), (301, "Ω", "one alone"), (302, "z", "x"), (303, "z", None)]
)
COLUMNS = ("doc_id", "lang", "text")


@pytest.mark.parametrize("fan,block", [(2, 1024), (2, 4), (3, 9), (5, 5)])
def test_manifest(spark, monkeypatch, fan, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    clashing = [F.lit("x").alias(c) for c in ("tree", "place", "block", "node", "path", "digest", "root", "_slot")]
    docs = spark.createDataFrame(ROWS, "doc_id long, lang string, text string").repartition(7).select("*", *clashing)
    df = merkle.manifest(docs, columns=COLUMNS, fan=fan, carry={"size": F.octet_length("text")})
    assert sorted(got(df), key=key) == sorted(brute(ROWS, fan), key=key)
    bad = df.where(merkle.fold(F.col("path"), F.col("leaf")) != F.col("root"))
    assert bad.count() == 0
    forged = df.where(merkle.fold(F.col("path"), merkle.digest(F.col("leaf"))) == F.col("root"))
    assert forged.count() == 0
    assert df.where("size = 200").count() == 1


def test_manifest_of_few_rows(spark, no_docs, odd_docs):
    assert merkle.manifest(no_docs).count() == 0
    one = merkle.manifest(spark.createDataFrame([(1, "en", "a")], "doc_id long, lang string, text string"), columns=COLUMNS)
    row = one.first()
    assert row.leaf == row.subroot == row.root == leaf((1, "en", "a")) and row.path == []
    assert merkle.manifest(odd_docs).count() == odd_docs.count()
