"""Exact and near dedup, repeats, contamination: against plain versions, on odd rows and none."""

import numpy as np
import plain

from callscope.llm import decontamination, exact_dedup, near_dedup, substring_dedup
from callscope.llm.queries import ORACLES, QUERIES

ITEMS = "item_id long, text string"


def test_exact_groups(odd_docs, odd_rows, no_docs, collected):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert collected(exact_dedup.dedup_groups(odd_docs), *columns) == sorted(plain.exact(odd_rows), key=repr)
    assert exact_dedup.dedup_groups(no_docs).count() == 0


def test_exact_dedup_keeps_rows_whole(odd_docs, odd_rows):
    kept = exact_dedup.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(found) == len({t or "" for _, t in odd_rows})
    wanted = {(k, h) for _, k, _, _, h in plain.exact(odd_rows)}
    assert {(d, plain.sha(t or "")) for d, t in found} == wanted


def test_directory_doubles_where_keys_crowd(spark):
    low = spark.range(400).selectExpr("shiftright(xxhash64(id), 8) & 72057594037927935 AS key")
    buckets = exact_dedup.directory(low, "key", bucket_keys=100, max_depth=12)
    depths = {d for _, d in buckets}
    assert max(depths) > 8  # all keys start with eight zeros
    assert sum(2.0**-d for _, d in buckets) == 1.0  # the buckets cover all hashes once
    rows = exact_dedup.with_bucket(low, "key", buckets)
    assert rows.count() == 400
    assert rows.groupBy("bucket").count().agg({"count": "max"}).first()[0] <= 110


def test_colliding_keys_are_told_apart():
    import pyarrow as pa

    entries = [(0, 5, "a", 1, 1), (0, 5, "b", 2, 1), (0, 5, "a", 9, 2), (1, 5, "a", None, 1)]
    names = ["bucket", "key", "text", "keep_id", "n"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, e, strict=True)) for e in entries])
    out = [r for b in exact_dedup._own([batch]) for r in b.to_pylist()]
    assert [(r["bucket"], r["chain"], r["text"], r["keep_id"], r["n"]) for r in out] == [
        (0, 0, "a", 9, 3),
        (0, 1, "b", 2, 1),
        (1, 0, "a", None, 1),
    ]


def test_near_components(odd_docs, odd_rows, no_docs, collected):
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert collected(near_dedup.near_components(odd_docs), *columns) == sorted(plain.near(odd_rows), key=repr)
    assert near_dedup.near_components(no_docs).count() == 0


def test_near_dedup_keeps_rows_whole(odd_docs, odd_rows):
    kept = near_dedup.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    wanted = sorted([d for d, _, _, k in plain.near(odd_rows) if k], key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == wanted


def test_links_that_no_leader_has(make_docs, collected):
    """Chains of edits: neighbours are similar, the ends are not."""
    words = [f"c{i}" for i in range(120)]
    rows = []
    for i in range(24):
        rows.append((100 + i, " ".join(words)))
        words[(i * 5) % 120] = f"e{i}"
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert collected(near_dedup.near_components(make_docs(rows)), *columns) == sorted(plain.near(rows), key=repr)


def test_alike_members_of_a_bucket_are_compared_in_bounded_memory():
    """Every pair of 700 members is alike and of two components; each band but the first leaves them to it."""
    import tracemalloc

    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))] * 700
    regs = near_dedup.registers(sets[:1]).repeat(700, axis=0)
    wide = (near_dedup.registers(sets[:1], near_dedup._SEEDS[near_dedup.ROUNDS :]) & 255).astype(np.uint8).repeat(700, axis=0)
    n, block, component = np.full(700, 900), np.zeros(700, np.int64), np.arange(700)
    keys = near_dedup._band_matrix(regs[:1]).view(np.int64)[0]
    tracemalloc.start()
    pairs = [near_dedup._across(int(k), True, block, component, n, regs, wide) for k in keys[:2]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(zip(*(x.tolist() for x in pairs[0]), strict=True)) == {(i, j) for j in range(700) for i in range(j)}
    assert len(pairs[1][0]) == 0
    assert peak < 100 << 20
    other = rng.integers(1, 256, wide.shape).astype(np.uint8)
    none, _ = near_dedup._across(int(keys[0]), True, block, component, n, regs, other)
    assert len(none) == 0


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    whole = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for share in (0.5, 0.75, 0.9):
        n = int(2000 * 2 * share / (1 + share))
        a, b = whole[:2000], whole[2000 - n : 4000 - n]
        regs = near_dedup.registers([np.unique(a), np.unique(b)])
        got, used = near_dedup.estimate(regs[:1], regs[1:], np.array([2000]), np.array([2000]))
        assert used[0] == near_dedup.ROUNDS * near_dedup.BUCKETS
        assert abs(got[0] - share) < 0.16


def test_repeats(odd_docs, odd_rows, no_docs, collected):
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert collected(substring_dedup.remove_repeats(odd_docs), *columns) == sorted(plain.repeats(odd_rows), key=repr)
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    texts = substring_dedup.remove_repeats(odd_docs, with_text=True).collect()
    assert all(plain.sha(r.kept_text) == r.kept_sha256 for r in texts)


def _items(spark, odd_rows):
    by = dict(odd_rows)
    passage = by[12 * 3].split()
    rows = [(3, " ".join(passage)), (20, " ".join(passage[2:15]).upper() + "!"), (100, "w1, w2"), (7, None), (8, "..."), (9, "one"), (3, "w3 w4 w5"), (None, "w6")]
    return rows, spark.createDataFrame(rows, ITEMS)


def test_contamination(spark, odd_docs, odd_rows, no_docs, collected, monkeypatch):
    rows, items = _items(spark, odd_rows)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    wanted = sorted(plain.contamination(odd_rows, [r for r in rows if r[0] is not None]), key=repr)
    assert collected(decontamination.contamination_digest(odd_docs, items), *columns) == wanted
    monkeypatch.setattr(decontamination, "MAX_AUTOMATON_WORDS", 14)  # several automata, one after the other
    assert collected(decontamination.contamination_digest(odd_docs, items), *columns) == wanted
    assert decontamination.contamination_digest(no_docs, items).count() == 0
    clean = decontamination.contamination_digest(odd_docs, items.limit(0))
    assert clean.where("contaminated").count() == 0 and clean.count() == len(odd_rows)


def test_item_ids_of_any_type(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "x")], "doc_id long, text string")
    items = spark.sql("SELECT 1.5D AS d, date '2024-01-02' AS t, true AS b, 7Y AS y, 'z' AS s, 2.50BD AS n, 'b c d e f g h i j k' AS text")
    for item, shown in (("d", "1.5"), ("t", "2024-01-02"), ("b", "true"), ("y", "7"), ("s", "z"), ("n", "2.50")):
        found = {r.doc_id: (r._n_hit, r._items) for r in decontamination.contamination(docs, items, item=item).collect()}
        assert found == {1: (10, [shown]), 2: (0, [])}, item


def test_decontaminate(spark, odd_docs, odd_rows):
    rows, items = _items(spark, odd_rows)
    hits = plain.contamination(odd_rows, [r for r in rows if r[0] is not None])
    kept = decontamination.decontaminate(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((h[0] for h in hits if not h[5]), key=repr)
    cut = decontamination.decontaminate(odd_docs, items, max_coverage=0.5).collect()
    by_id = {h[0]: h for h in hits if 0 < h[2] <= 0.5 * h[1]}
    for r in cut:
        if r.doc_id in by_id and plain.plain_words(dict(odd_rows)[r.doc_id]) != plain.plain_words(r.text):
            assert len(plain.plain_words(r.text)) == by_id[r.doc_id][1] - by_id[r.doc_id][2]


def test_against_sql(spark):
    import compare

    con = compare.duck("/root/testdata/sf0.001")
    for name, sql in ORACLES.items():
        assert compare.difference(QUERIES[name](spark, "/root/testdata/sf0.001"), con, sql) is None, name
