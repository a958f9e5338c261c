"""Vector codes: the tree against every distance, the query against its SQL, and odd inputs."""

import hashlib

import duckdb
import numpy as np
import pytest

from tidegrid.llm import vector_codes as vc
from tidegrid.llm.catalog import ORACLES, op11_vector_codes

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("reach", [1, 3, 40, 1 << 27])
def test_tree_finds_the_nearest_entry_and_the_lower_of_ties(reach):
    random = np.random.default_rng(reach)
    for count in (1, 2, 5, 16, 90):
        entries = random.integers(-reach, reach + 1, (count, 4))
        queries = np.concatenate((random.integers(-reach, reach + 1, (400, 4)), entries))
        which, far = vc.nearest(vc.build(entries), entries, queries)
        every = ((queries[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (which == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()


def test_tree_leaves_subtrees_out():
    random = np.random.default_rng(1)
    middle = random.integers(-100_000, 100_000, (8, 8))
    entries = np.concatenate([m + random.integers(-50, 50, (32, 8)) for m in middle])
    met = []
    squared = vc._squared

    def counted(a, b):
        met.append(len(a))
        return squared(a, b)

    tree = vc.build(entries)
    vc._squared = counted
    try:
        vc.nearest(tree, entries, entries)
    finally:
        vc._squared = squared
    assert sum(met) < 0.5 * len(entries) ** 2


def brute(rows, parts=8, entries=16, rounds=6):
    """The contract over (vec_id, vector, label) rows with whole vectors of equal length."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0], r[1]))
    v = np.floor(np.array([r[1] for r in kept], dtype=np.float64) * 4096).astype(object)
    cut = v.reshape(len(kept), parts, -1)
    books = [[list(cut[i, p]) for i in range(min(entries, len(kept)))] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for i in range(len(kept)):
                groups.setdefault(near(p, cut[i, p])[1], []).append(cut[i, p])
            for e, members in groups.items():
                books[p][e] = [int(sum(c) // len(members)) for c in zip(*members)]
    out = []
    for i, r in enumerate(kept):
        found = [near(p, cut[i, p]) for p in range(parts)]
        out.append((r[0], r[2], "".join(f"{e:02x}" for _, e in found), int(sum(d for d, _ in found))))
    totals = {}
    for _, label, _, error in out:
        totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted((a, b, c, d, totals[b]) for a, b, c, d in out), digest


def told(spark, rows, schema=SCHEMA):
    coded, books = vc.compress(spark.createDataFrame(rows, schema), "vec_id", "embedding", "label")
    return coded.collect(), books


def test_nulls_ties_and_repeats(spark):
    random = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in random.normal(size=16).round(1)], i % 3 if i % 5 else None) for i in range(60)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (100, None, 2), (101, [None] * 16, 2), (102, [float("nan")] * 16, 0), (103, [float("inf")] * 16, 0)]
    rows = [(i, v, 9 if label is None else label) for i, v, label in rows]
    got, books = told(spark, [(i, v, None if label == 9 else label) for i, v, label in rows])
    want, digest = brute(rows)
    assert sorted((r["vec_id"], 9 if r["label"] is None else r["label"], r["code"], r["error"], r["label_error"]) for r in got) == want
    assert books.sha256() == digest


def test_few_rows_ragged_and_huge_vectors_and_no_rows(spark):
    assert told(spark, []) == ([], None)
    assert told(spark, [(1, None, 1)]) == ([], None)
    got, books = told(spark, [(1, [1.0] * 16, 1), (2, [], 1), (None, [3.0e38] * 5, None)])
    assert books.values.shape == (8, 3, 2) and [r["error"] for r in got] == [0, 0, 0]
    clash = spark.createDataFrame([(1, [0.5] * 8, 2, "a", 3)], "vec_id long, embedding array<float>, label int, Code string, ints int")
    assert vc.compress(clash, "vec_id", "embedding", "label")[0].head()["code"] == "00" * 8


def test_labels_seldom_and_often(spark):
    coded = spark.createDataFrame([(i, i if i < 3000 else None, i % 7) for i in range(5000)], "id long, label long, error long")
    got = {r["id"]: r["label_error"] for r in vc.with_totals(coded, "label").collect()}
    often = sum(i % 7 for i in range(3000, 5000))
    assert got == {i: i % 7 if i < 3000 else often for i in range(5000)}


def test_query_agrees_with_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    cursor = con.execute(ORACLES["op11_vector_codes"])
    names = [d[0] for d in cursor.description]
    got = op11_vector_codes(spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall()) and got
