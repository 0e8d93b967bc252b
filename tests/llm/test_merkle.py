"""The Merkle manifest against a bottom-up build in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from salescope.llm import merkle
from salescope.llm.queries import op11_merkle_manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    values = (None if v is None else str(v) for v in row)
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def fold_up(leaves):
    """Root of the leaves, and for each the (before, after) of every level."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, k in zip(paths, at, strict=True):
            run = k - k % 16
            path.append(("".join(level[run:k]), "".join(level[k + 1:run + 16])))
        level = [sha("".join(level[k:k + 16])) for k in range(0, len(level), 16)]
        at = [k // 16 for k in at]
    return level[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text); one result a row, as the query's."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rs in groups.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
    trees = {s: fold_up([brute_leaf(r) for r in groups[s]]) for s in order}
    root, tops = fold_up([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        for r, path in zip(groups[s], trees[s][1], strict=True):
            path = path + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = brute_leaf((*r[:4], r[4] and r[4].translate(LOWER))) if hit else brute_leaf(r)
            for before, after in path:
                node = sha(before + node + after)
            out.append((r[0], brute_leaf(r), trees[s][0], root, sha("".join(b + a for b, a in path)), node, node == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, digest string, _tree long, carried int"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def run(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = op11_merkle_manifest(spark, str(tmp_path)).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in out), key=repr)


def corpus(n, sources):
    return [(i * 7 % 1000, sources[i * i % len(sources)], [None, "en"][i % 2], i, ["", None, "Text É " * (i % 9)][i % 3])
            for i in range(n)]


@pytest.mark.parametrize("rows", [
    corpus(700, ["big"] * 4 + [None, "é", "z", "Z", ""]),           # one source with most rows; four levels
    corpus(300, [f"s{k}" for k in range(40)]),                       # the tree of sources has two levels
    corpus(17, ["one"]),                                             # a last run of one node, a single source
    [(1, "a", None, None, "Only A")],                                # a lone leaf is the root
    [(None, None, None, None, None), (None, "a", "en", 3, "X"), (5, "a", "en", 3, "X"), (5, "a", "en", 3, "X"),
     (5, "a", "de", 3, "Y"), (-3, "a", "", 0, ""), (10, "b", "en", 1, "Long " * 200_000)],
], ids=["hot", "sources", "run of one", "single", "odd"])
def test_query_against_brute_force(spark, tmp_path, rows):
    assert run(spark, tmp_path, rows) == sorted(brute(rows), key=repr)


def test_nothing(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_tampering_shows_only_where_a_text_changes(spark, tmp_path):
    rows = [(i, "s", "en", 1, ["Upper", "lower", None][i % 3]) for i in range(60)]
    for r in run(spark, tmp_path, rows):
        changed = zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[0] % 3 == 0
        assert r[6] == (not changed)


def test_proofs_of_some_leaves_and_shared_records(spark):
    same = [(1, "a", None, None, "same")] * 64 + [(k, "b", None, None, "t") for k in range(20)]
    docs = spark.createDataFrame(same, "doc_id long, source string, lang string, n_chars long, text string")
    manifest = merkle.build(docs, carried=F.col("doc_id"))
    # Four equal runs of sixteen equal leaves are one record, beside the two of source b.
    assert manifest.records[0].count() == 3
    got = merkle.prove(manifest, manifest.leaves.where("_tree = 'b' and _rank in (0, 17)")).collect()
    assert sorted(r.carried for r in got) == [0, 17]
    folded = merkle.prove(manifest).select(merkle.fold(F.col("leaf"), F.col("path")).alias("f"), "root").distinct().collect()
    assert len(folded) == 1 and folded[0].f == folded[0].root
