"""The conversation trie against a nested dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from salescope.llm import prefix_trie
from salescope.llm.queries import op13_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_nodes(convs):
    """convs: id -> list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1]) if node else 0
    return sorted(((cs[0], len(node), members[node[:-1]][0] if node else None, len(cs), children[node], leaves[node],
                    saved[node], hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
                   for node, cs in members.items()), key=lambda r: r[:2])


def brute_query(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    for c, turns in own.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0,
                                  hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()))
        own[c] = [t[1:] for t in turns]
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return brute_nodes(rebuilt)


def got(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=lambda r: r[:2])


def random_rows(seed, n, longest, words):
    r = random.Random(seed)
    shared = [(k, r.choice(["user", "assistant"]), r.choice(words)) for k in range(longest)]
    rows = []
    for c in r.sample(range(4 * n), n):
        same = r.randrange(longest)  # a common beginning, then turns of its own
        rows += [(c, *t) for t in shared[:same]]
        rows += [(c, k, r.choice(["user", None]), r.choice(words)) for k in range(same, r.randint(same, longest))]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, key string, digest long, block int, _rank int"


@pytest.mark.parametrize("rows", [
    random_rows(1, 150, 8, ["a", "b", None, "cccé", ""]),
    random_rows(2, 60, 23, ["x", "longer text"]),
    random_rows(3, 400, 3, ["only"]),                               # few nodes with very many members and long id lists
    [(c, k, "user", "the same") for c in range(700) for k in range(3)],
    [(None, 0, "user", "none"), (7, None, None, None), (7, None, "", ""), (7, 2, "user", "z" * 400_000), (7, 2, "user", "a"),
     (100, 0, "user", "q"), (103, 0, "user", "r"), (103, 0, "user", "r"), (2 ** 40, 5, "user", "s")],
], ids=["mixed", "long", "few nodes", "copies", "odd"])
def test_query_against_brute_force(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], SCHEMA)
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_prefix_trie(spark, str(tmp_path))) == brute_query(rows)


def test_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op13_prefix_trie(spark, str(tmp_path)).count() == 0


def test_operator_without_turns_and_many_blocks(spark):
    rows = [(1, k, "user", "same") for k in range(90)] + [(2, k, "user", "same" if k < 50 else "other") for k in range(90)]
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    convs = spark.createDataFrame([(1,), (2,), (3,)], "conv long")
    want = brute_nodes({1: [("user", "same")] * 90, 2: [("user", "same")] * 50 + [("user", "other")] * 40, 3: []})
    assert got(prefix_trie.prefix_trie(turns, convs)) == want
    empty = prefix_trie.prefix_trie(turns.limit(0), convs)
    assert got(empty) == brute_nodes({1: [], 2: [], 3: []})


def test_chain_digests_group_equal_beginnings(spark):
    rows = [(c, k, "user", f"{k} {c if k > 5 else 0}") for c in (1, 2) for k in range(8)]
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    blocks = turns.groupBy("conv", F.expr("_rank div 4").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("_rank", "digest", "chars"))).alias("turns"))
    chained = prefix_trie._chained(blocks, 1)
    distinct = {(r["from"], r.to) for r in chained.select("from", "to").collect()}
    assert len(distinct) == 3 and len({f for f, _ in distinct}) == 2
