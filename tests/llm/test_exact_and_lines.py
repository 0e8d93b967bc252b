import hashlib
from collections import defaultdict

from salescope.llm import exact_dedup, line_dedup

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_exact_duplicates_against_a_dictionary(spark):
    rows = [(i, ["Same", "same", "SAME", "É", "é", "", None, f"own {i}"][i % 8]) for i in range(200)]
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(AZ)].append(i)
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs(spark, rows)).collect()}
    assert len(got) == 200
    for text, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(ids), len(ids), i == max(ids))
            assert got[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    kept = exact_dedup.exact_dedup(docs(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {max(ids) for ids in groups.values()}


def test_a_full_filter_only_shuffles_more(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 1)
    monkeypatch.setattr(exact_dedup, "BITMAP_BITS", 64)
    monkeypatch.setattr(exact_dedup, "BITS_PER_ROW", 0)
    rows = [(i, f"text {i % 150}") for i in range(300)]
    out = exact_dedup.exact_duplicates(docs(spark, rows)).collect()
    assert all(r.group_size == 2 and r.keep_id == r.doc_id % 150 + 150 for r in out)


def test_exact_duplicates_odd_rows(odd, nothing):
    got = exact_dedup.exact_duplicates(odd).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == [
        (1, 2, 2), (2, 2, 2), (3, 3, 1), (4, 5, 3), (5, 5, 3), (5, 5, 3), (6, 6, 1)]
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    assert exact_dedup.exact_dedup(odd).columns == odd.columns


def brute_lines(rows, min_chars=20, min_docs=3):
    strip = " \t\n\x0b\x0c\r"
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[line.strip(strip).translate(AZ)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        keys = [line.strip(strip).translate(AZ) for line in lines]
        kept = [line for line, k in zip(lines, keys, strict=True)
                if not (len(k) >= min_chars and len(holders[k]) >= min_docs and i != max(holders[k]))]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_line_dedup_against_brute_force(spark):
    common = "A line that many documents hold, \xc9t\xe9."
    rows = [(i, "\n".join([f"first of {i}", common.upper() if i % 3 else f"\t{common} ", "",
                           f"shared by a few documents {i % 40}", "short", common][: i % 7]))
            for i in range(160)] + [(1000, None), (1001, ""), (1002, "\n\n"), (-5, common)]
    want = brute_lines(rows)
    for batches, fanout in ((1, 2), (5, 2), (7, 3)):
        got = line_dedup.line_dedup(docs(spark, rows), batches=batches, fanout=fanout).collect()
        assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in got} == want


def test_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    for b in range(4):
        runs.ingest(spark.createDataFrame([(b, bytearray(b"a")), (b, bytearray([b]))], "_id long, _h binary"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert [(bytes(r._h), r._top) for r in runs.repeated(3).collect()] == [(b"a", 3)]
    runs.close()


def test_line_dedup_odd_rows(odd, nothing):
    out = line_dedup.line_dedup(odd)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "_id", "score", "kept", "text", "n_lines", "n_dropped"]
    assert out.count() == odd.count()
    assert line_dedup.line_dedup(nothing).count() == 0


def test_rows_of_one_id_keep_their_own_lines(spark):
    common = "a line that many documents hold"
    rows = [(1, common + "\nrest"), (1, "a unique first line nobody else has"), (2, common), (3, common), (3, "alone " * 9),
            (None, common), (None, "a second unique line, without an id")]
    got = sorted(((r.doc_id, r.text) for r in line_dedup.line_dedup(docs(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, "rest"), (1, rows[1][1]), (2, ""), (3, common), (3, rows[4][1]), (None, ""), (None, rows[6][1])], key=repr)


def test_exact_dedup_keeps_other_texts_of_an_id(spark):
    rows = [(5, "a"), (5, "unique b"), (9, "A"), (None, "c"), (None, "a")]
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, "unique b"), (9, "A"), (None, "c")], key=repr)


def test_tables_of_runs_go_when_a_run_fails(spark, monkeypatch):
    monkeypatch.setattr(line_dedup.LineRuns, "repeated", lambda *_: 1 / 0)
    before = {t.name for t in spark.catalog.listTables()}
    try:
        line_dedup.line_dedup(docs(spark, [(1, "a line that is long enough")]))
    except ZeroDivisionError:
        pass
    assert {t.name for t in spark.catalog.listTables()} == before
