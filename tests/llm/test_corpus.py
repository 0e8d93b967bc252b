import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from salescope.llm import dart_minhash, decontaminate, sharding, substring_dedup


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def prose(rng, n, words=4000):
    out = [f"w{k}" + ("." if rng.random() < 0.1 else "") for k in rng.integers(0, words, n)]
    return " ".join(out)


# sharding


def test_tree_finds_the_tightest_fit():
    rng = np.random.default_rng(2)
    tree, held = sharding.FreeSpace(), set()
    for k in range(3000):
        if rng.random() < 0.6:
            item = (int(rng.integers(1, 500)), k)
            held.add(item)
            tree.insert(*item)
        else:
            size = int(rng.integers(1, 500))
            want = min((x for x in held if x[0] >= size), default=None)
            assert tree.take(size) == want
            held.discard(want)


def test_best_fit_decreasing_against_a_scan():
    rng = np.random.default_rng(3)
    sizes = sorted(rng.integers(1, 100, 400).tolist(), reverse=True)
    free, want = [], []
    for s in sizes:
        fits = [(f, b) for b, f in enumerate(free) if f >= s]
        if fits:
            b = min(fits)[1]
        else:
            b = len(free)
            free.append(100)
        free[b] -= s
        want.append(b)
    got = sharding.best_fit_decreasing(sizes, 100)
    assert list(got) == want
    load = Counter()
    for s, b in zip(sizes, got, strict=True):
        load[b] += s
    assert max(load.values()) <= 100 and len(load) == len(free)
    packed = sharding.pack_into(sizes, 8)
    assert len(set(packed)) == 8


@pytest.mark.parametrize("hot", [0, 300])
def test_shards(spark, hot):
    rng = np.random.default_rng(4)
    rows = [(i, "x" * int(rng.integers(0, 400)) + str(i // 2)) for i in range(1200)] \
        + [(5000 + i, "hot " * 40) for i in range(hot)] + [(9001, None), (9002, ""), (9003, "y" * 9000)]
    out = sharding.shard_by_bytes(docs(spark, rows), 8).toPandas()
    assert len(out) == len(rows)
    load = out.groupby("shard")["size"].sum()
    assert len(load) == 8 and load.max() - load.min() <= 0.02 * load.mean()
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    homes = out.groupby("group_digest").shard.nunique()
    assert (homes > 1).sum() == (1 if hot else 0)  # only a group larger than a shard is split
    assert out.set_index("doc_id")["size"][[9001, 9002, 9003]].tolist() == [8, 8, 9008]


def test_shards_odd_rows(odd, nothing):
    assert sharding.shard_by_bytes(odd, 3).count() == 7
    assert sharding.shard_by_bytes(nothing, 3).count() == 0


# substring dedup


def brute_substrings(rows):
    """Spans as tuples of texts, in a dictionary of all places."""
    places, spans, found = defaultdict(list), {}, {}
    for i, text in sorted(rows):
        starts, words, _ = substring_dedup.pieces(text)
        edges = [*starts, len(text)]
        parts = [" ".join(text[a:b].split()).lower() for a, b in zip(edges, edges[1:], strict=False)]
        mine = set()
        for a in range(len(parts)):
            for b in range(a + 2, len(parts) + 1):
                if words[a:b].sum() >= substring_dedup.MIN_WORDS:
                    mine.add((a, b))
                    break
        for b in range(len(parts), 1, -1):
            for a in range(b - 2, -1, -1):
                if words[a:b].sum() >= substring_dedup.MIN_WORDS:
                    mine.add((a, b))
                    break
        spans[i] = (text, edges, parts, mine)
        for a, b in mine:
            places[tuple(parts[a:b])].append((i, a))
    for i, (text, edges, parts, mine) in spans.items():
        drop = {k for a, b in mine if min(places[tuple(parts[a:b])]) != (i, a) for k in range(a, b)}
        edges = [0, *edges[1:]]
        found[i] = "".join(text[edges[k]:edges[k + 1]] for k in range(len(parts)) if k not in drop), len(drop)
    return found


def test_substrings_against_brute_force(spark):
    rng = np.random.default_rng(5)
    shared = [prose(rng, 60) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(rng, int(rng.integers(0, 120))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, shared[i % 4])
        rows.append((i, (" " if i % 2 else "\n").join(parts)))
    rows += [(100, rows[7][1]), (101, shared[0] + "\n" + shared[0]), (102, shared[1].replace(".", ""))]
    got = {r.doc_id: (r.text, r.n_removed) for r in substring_dedup.substring_dedup(docs(spark, rows)).collect()}
    want = brute_substrings(rows)
    assert got == want
    assert got[100][0] == "" and all(got[i][1] == 0 for i in range(60) if i % 3)
    for i in range(60):  # a passage of 60 words goes but for where it is first
        if i % 3 == 0 and i >= 12:
            assert len(got[i][0].split()) <= len(rows[i][1].split()) - 50


def run_on(rng, n):
    return " ".join(f"w{k}" + ("." if rng.random() < 0.03 else "") for k in rng.integers(0, 4000, n))


def test_no_window_of_fifty_words_stands_twice(spark):
    """At the level of words, whatever the pieces are: passages of run-on text between differing neighbours."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(300):
        passage = run_on(rng, 50 + k % 25)
        rows += [(2 * k + j, " ".join([run_on(rng, int(rng.integers(0, 60))), passage, run_on(rng, int(rng.integers(0, 60)))]))
                 for j in range(2)]
    windows = Counter()
    for r in substring_dedup.substring_dedup(docs(spark, rows)).collect():
        tokens = r.text.lower().split()
        windows.update({tuple(tokens[k:k + 50]) for k in range(len(tokens) - 49)})
    assert max(windows.values()) == 1


def test_passages_are_cut_alike():
    """Twenty words of equal pieces in every fifty, also where words repeat and sentences are short."""
    rng = np.random.default_rng(9)
    for k in range(3000):
        few, stops = (3, 40, 4000)[k % 3], (0.0, 0.03, 0.1)[k // 3 % 3]
        tokens = [[f"{c}{w}" + ("." if rng.random() < stops else "") for w in rng.integers(0, few, n)]
                  for c, n in (("w", 50), ("x", int(rng.integers(0, 40))), ("y", int(rng.integers(0, 40))),
                               ("x", int(rng.integers(0, 40))), ("y", int(rng.integers(0, 40))))]
        found = []
        for before, after in (tokens[1:3], tokens[3:5]):
            _, words, hashes = substring_dedup.pieces(" ".join(before + tokens[0] + after))
            ends = np.cumsum(words) - len(before)
            found.append({(int(e - w), int(e), int(h)) for w, e, h in zip(words, ends, hashes, strict=True)
                          if e - w >= 0 and e <= 50})
        assert sum(e - b for b, e, _ in found[0] & found[1]) >= substring_dedup.MIN_WORDS


def test_rows_of_one_id_are_judged_on_their_own_texts(spark):
    rng = np.random.default_rng(11)
    copy, own, other = (". ".join(prose(rng, 12).replace(".", "") for _ in range(4)) + "." for _ in range(3))
    rows = [(1, copy), (2, copy), (2, own), (None, other), (None, None), (2, own)]
    got = [(r.doc_id, r.text) for r in substring_dedup.substring_dedup(docs(spark, rows)).collect()]
    want = [(1, copy), (2, ""), (2, own), (2, own), (None, other), (None, "")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_substrings_odd_rows(odd, nothing):
    got = substring_dedup.substring_dedup(odd).collect()
    assert sorted((r.doc_id, r.n_removed > 0) for r in got) == [
        (1, False), (2, False), (3, False), (4, False), (5, False), (5, False), (6, False)]  # 6 is one piece
    assert substring_dedup.substring_dedup(nothing).count() == 0


# decontamination


def brute_alignment(words, item):
    h = np.zeros((len(words) + 1, len(item) + 1))
    for i, w in enumerate(words, 1):
        for j, v in enumerate(item, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if v == w else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(6)
    for _ in range(200):
        words, item = rng.integers(0, 6, rng.integers(1, 40)), rng.integers(0, 6, rng.integers(1, 15))
        score, end, item_end = decontaminate.align(words, item)
        assert score == brute_alignment(words, item)
        if score:
            assert brute_alignment(words[:end], item[:item_end]) == score


def test_contamination(spark):
    rng = np.random.default_rng(7)
    items = [(k, prose(rng, 40)) for k in range(12)] + [(50, None), (51, ""), (52, "two words"), (53, "")]
    items.append((60, items[0][1]))

    def edited(text, every):
        w = text.split()
        return " ".join("changed" if k % every == every - 1 else x for k, x in enumerate(w))

    rows = [(i, prose(rng, 300)) for i in range(50)]
    rows += [(100 + k, prose(rng, 80) + " " + items[k][1] + "\n" + prose(rng, 500)) for k in range(12)]
    rows += [(200 + k, prose(rng, 80) + " " + edited(items[k][1], 5).upper() + " " + prose(rng, 50)) for k in range(12)]
    rows += [(300 + i, items[3][1]) for i in range(100)] + [(400, None), (401, "")]
    out = decontaminate.matches(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(100 + k, k) for k in range(12)} | {(200 + k, k) for k in range(12)} | {(300 + i, 3) for i in range(100)} \
        | {(100, 60), (200, 60)}
    assert {(r.doc_id, r.item_id) for r in out} == want and len(out) == len(want)
    texts = dict(rows)
    for r in out:
        assert texts[r.doc_id][r.start:r.end] == r.passage
        if r.doc_id < 200 or r.doc_id >= 300:
            assert r.score == 1 and re.findall(r"\w+", r.passage) == re.findall(r"\w+", dict(items)[r.item_id])
        else:
            assert 0.5 <= r.score < 1


def test_every_third_word_replaced_or_one_put_in(spark):
    rng = np.random.default_rng(17)
    items = [(k, prose(rng, n)) for k, n in enumerate([9, 12, 20, 30, 41, 60] * 4)]
    rows = []
    for k, text in items:
        words = text.split()
        rows.append((k, " ".join("changed" if j % 3 == 2 else w for j, w in enumerate(words))))
        rows.append((100 + k, " ".join(w + " inserted" if j % 2 else w for j, w in enumerate(words))))
        rows.append((200 + k, " ".join(w for j, w in enumerate(words) if j % 4 != 3)))
    rows = [(i, f"{prose(rng, 50)} {t} {prose(rng, 50)}") for i, t in rows]
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # frequent copies do not hide their seeds
    out = decontaminate.matches(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id % 100, r.item_id) for r in out if r.doc_id < 300} == {(k, k) for k in range(24)}
    assert len({r.doc_id for r in out if r.doc_id < 300}) == 72 and sum(r.doc_id >= 300 for r in out) == 60


def test_contamination_in_blocks_and_odd_rows(spark, odd, nothing, monkeypatch):
    bench = spark.createDataFrame([(1, "equal words here five of"), (2, "long long long"), (3, None)],
                                  "item_id long, text string")
    want = {(4, 1), (5, 1), (6, 2)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(odd, bench).collect()} == want
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 30)
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(odd, bench).collect()} == want
    assert decontaminate.matches(nothing, bench).count() == 0
    assert decontaminate.matches(odd, bench.limit(0)).count() == 0


# near duplicates


def weighted(text):
    w = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter([()])


def brute_classes(rows):
    sets = {i: weighted(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b:
                shared = sum((sets[a] & sets[b]).values())
                if shared >= 0.8 * sum((sets[a] | sets[b]).values()):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(8)
    for size in (1, 4, 50, 2000):
        sets, true = [], []
        for _ in range(30):
            e = rng.integers(0, 2**63, size, dtype=np.uint64)
            a, b = rng.integers(1, 9, size), rng.integers(1, 9, size)
            b = np.where(rng.random(size) < 0.6, a, b)
            sets += [(e, a), (e, b)]
            true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        sig = dart_minhash.signatures(sets)
        same = (sig[::2] == sig[1::2]).mean(1)
        assert abs(same.mean() - np.mean(true)) < 0.03


def test_classes_against_brute_force(spark, monkeypatch):
    """Templates with many edited copies, chains, and texts that only share passages."""
    rng = np.random.default_rng(9)
    rows, n = [], 0
    for _ in range(6):
        base = prose(rng, 150).split()
        for _ in range(25):
            words = list(base)
            for k in rng.integers(0, 150, rng.integers(0, 5)):
                words[k] = f"edit{n}"
            rows.append((n, " ".join(words)))
            n += 1
    chain = prose(rng, 200).split()
    for _ in range(20):  # each close to the next, the ends far apart
        chain = chain[5:] + prose(rng, 5).split()
        rows.append((n, " ".join(chain)))
        n += 1
    passage = prose(rng, 100)
    rows += [(n + k, passage + " " + prose(rng, 60)) for k in range(60)]
    rows += [(2000, rows[3][1]), (2001, rows[3][1].upper()), (2002, None), (2003, ""), (2004, "a b"), (2005, "A b!")]
    want = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == want
    monkeypatch.setattr(dart_minhash, "BLOCK_BYTES", 20_000)  # many blocks a group
    monkeypatch.setattr(dart_minhash, "MAX_BROADCAST", 0)
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == want


def test_near_duplicates_odd_rows(spark, odd, nothing):
    got = dart_minhash.near_duplicates(odd).collect()
    assert sorted((r.doc_id, r.class_id, r.kept) for r in got) == [
        (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 4, False), (5, 4, False), (6, 6, True)]
    assert dart_minhash.near_duplicates(nothing).count() == 0
    none = dart_minhash.near_duplicates(docs(spark, [(None, "a b c"), (None, "A b c"), (1, "x y"), (None, "x y")]))
    assert sorted((str(r.doc_id), str(r.class_id), r.kept) for r in none.collect()) == [
        ("1", "1", True), ("None", "1", False), ("None", "None", True), ("None", "None", True)]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 7), (10, 11), (11, 11), (20, 21), (21, 22), (20, 22)]
    out = dart_minhash.components(spark.createDataFrame(links, "_a long, _b long"))
    assert {r._node: r._class for r in out.collect()} == {**{k: 1 for k in range(1, 8)}, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20}
