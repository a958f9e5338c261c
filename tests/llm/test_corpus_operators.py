"""Jaccard join, classifier, mixing, sharding and the pipeline on small inputs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegrid.llm.jaccard_join import Threshold, jaccard_components, small_boundary
from tidegrid.llm.mixing import fit_rates, mix, mixing_rates
from tidegrid.llm.quality_classifier import fit, remainder, score
from tidegrid.llm.sharding import assign_shards, ring, walk

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


def components_by_brute_force(rows, n=4):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = []
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append((key, frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()))
    top = list(range(len(sets)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                top[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(sets):
        least[find(i)].append(key)
    return {sets[i][0]: (len(sets[i][1]), min(least[find(i)])) for i in range(len(sets))}


def near_copies(seed):
    random.seed(seed)
    word = lambda: random.choice("abcdefgh") + random.choice("klmnop") + str(random.randint(0, 40))
    passage = [word() for _ in range(60)]
    rows = []
    for size in (3, 4, 8, 9, 10, 16, 22, 27, 30, 60, 200):
        for _ in range(3):
            base = [word() for _ in range(size)]
            rows.append(base)
            for _ in range(random.randint(1, 7)):
                copy = list(base)
                for _ in range(random.randint(0, max(1, size // 40))):
                    copy[random.randint(0, len(copy) - 1)] = word()
                rows.append(copy + [word() for _ in range(random.randint(0, 2))])
    rows += [passage + [word() for _ in range(random.randint(1, 12))] for _ in range(12)]
    rows = [" ".join(r).upper() if random.random() < 0.2 else "  ".join(r) for r in rows]
    return [(i, t) for i, t in enumerate([*rows, "", None, "x", "x", "\n"])]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame([(*r, 0) for r in rows], DOCS + ", n long")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert got == components_by_brute_force(rows)


def test_components_of_no_and_repeated_rows(spark):
    assert jaccard_components(spark.createDataFrame([], DOCS)).count() == 0
    got = jaccard_components(spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (3, "A B c d e"), (None, "q")], DOCS)).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == [("3", 2, "3"), ("5", 2, "3"), ("5", 2, "3"), ("None", 1, "None")]


def test_small_sets_have_their_own_path():
    limit = Threshold(85, 100)
    assert limit.subset_sizes(7, 10) == [6, 7] and limit.subset_sizes(5, 10) == []
    assert small_boundary({10: 1000, 300: 1}, limit) > 10


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    odds = fit(docs, labels.where(remainder(F.col("doc_id")) != 0))
    held = score(docs.where(remainder(F.col("doc_id")) == 0), odds, ["doc_id"]).join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.3) == (r["label"] == 1) for r in held]) > 0.95


def test_quality_of_null_empty_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "good words here", 0.0), (2, "bad! bad! bad!", 0.0), (3, None, 0.0), (4, "", 0.0), (4, "", 0.0)], DOCS + ", score_text double")
    odds = fit(docs, spark.createDataFrame([(1, 1), (2, 0), (2, 0), (9, 1), (None, 1), (3, None)], "doc_id long, label int"))
    got = {r["doc_id"]: r["score"] for r in score(docs, odds, ["doc_id", "score_text"]).collect()}
    assert got[3] == got[4] and got[1] > got[2] and all(0 <= s <= 1 for s in got.values())
    assert score(docs.limit(0), odds, ["doc_id"]).count() == 0
    alone = fit(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert {r["score"] for r in score(docs, alone, ["doc_id"]).collect()} == {0.5}


def test_rates_solve_the_least_squares(spark):
    random.seed(2)
    rows = []
    for i in range(60):
        p = sorted([random.random(), random.random()])
        p = [round(p[0], 3), round(p[1] - p[0], 3), round(1 - p[1], 3)]
        rows.append((p, random.randint(1, 500), 1 + (i % 7 == 0)))
    targets = [0.7, 0.2, 0.1]
    members = spark.createDataFrame(rows, "mix_p array<double>, mix_tokens long, mix_copies long")
    got = {tuple(r["mix_p"]): r["mix_rate"] for r in fit_rates(members, targets, steps=300).collect()}
    p, t = np.array([r[0] for r in rows]), np.array([r[1] * r[2] for r in rows], dtype=float)
    rate = np.ones(len(rows))
    for _ in range(60000):
        pull = p @ ((p * (rate * t)[:, None]).sum(0) / t.sum() - targets)
        rate = np.maximum(0, rate - 0.5 * (pull + 0.001 * (rate - 1)))
    mine = np.array([got[tuple(r[0])] for r in rows])
    loss = lambda r: 0.5 * (((p * (r * t)[:, None]).sum(0) / t.sum() - targets) ** 2).sum() + 0.0005 * (t / t.sum() * (r - 1) ** 2).sum()
    assert mine.min() >= 0 and loss(mine) <= loss(rate) + 1e-5 and loss(mine) < loss(np.ones(len(rows)))


def test_mixing_rows(spark):
    docs = spark.createDataFrame(
        [(i, ("fine prose word " if i % 2 else "vile junk noise ") * 20, "t") for i in range(40)] + [(90, None, "t"), (91, "", "t"), (90, None, "t"), (None, "fine", "t")],
        DOCS + ", word string",
    )
    labels = spark.createDataFrame([(i, "good" if i % 2 else "poor") for i in range(20)] + [(3, "zzz"), (None, "good"), (777, "good")], "doc_id long, domain string")
    rates = mixing_rates(docs, labels, {"good": 0.8, "poor": 0.2})
    told = {r["doc_id"]: r for r in rates.collect()}
    assert told[1]["mix_p"][0] > 0.9 > 0.1 > told[2]["mix_p"][0] and told[1]["mix_rate"] > 1 > told[2]["mix_rate"] >= 0
    assert told[90]["mix_tokens"] == 0 and told[90]["mix_copies"] == 2
    tokens = sum(r["mix_tokens"] * r["mix_copies"] * r["mix_rate"] * r["mix_p"][0] for r in told.values())
    assert tokens / sum(r["mix_tokens"] * r["mix_copies"] for r in told.values()) == pytest.approx(0.8, abs=0.02)
    mixed = mix(docs, rates)
    assert mixed.columns == docs.columns
    n = Counter(r["doc_id"] for r in mixed.collect())
    assert sum(n[i] for i in range(1, 40, 2)) > sum(n[i] for i in range(0, 40, 2))
    assert mix(docs.limit(0), mixing_rates(docs.limit(0), labels, {"good": 1.0})).count() == 0


def test_shards_are_even_and_gapless(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = assign_shards(docs, 8).collect()
    assert len(rows) == docs.count()
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean, largest = sum(size.values()) / 8, max(r["size"] for r in rows)
    assert set(size) == set(range(8)) and max(size.values()) < 1.01 * mean + 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    more = {r["doc_id"]: r["shard"] for r in assign_shards(docs, 9).collect()}
    assert np.mean([more[r["doc_id"]] != r["shard"] for r in rows]) < 0.35


def test_shards_of_hot_null_and_no_rows(spark):
    rows = [(7, "same text")] * 500 + [(i, None) for i in range(100)] + [(None, "")] * 3
    got = assign_shards(spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", bin int"), 4).collect()
    assert len(got) == len(rows)
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] != 7} == {(8, 0)}
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    assert max(size.values()) - min(size.values()) <= 40
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)
    assert assign_shards(spark.createDataFrame([], DOCS), 4).count() == 0


def test_walk_fills_no_shard_over_its_bound():
    random.seed(4)
    homes = ring(10, nodes=16)
    loads = {b: random.randint(1, 1000) for b in range(0, len(homes), 3)}
    loads[9] = 200_000
    ranges = walk(loads, homes, 10, 1.01)
    taken, by_bin = Counter(), defaultdict(list)
    for r in ranges:
        taken[r.shard] += r.high - r.low
        by_bin[r.bin].append((r.low, r.high))
    assert max(taken.values()) <= 1.01 * sum(loads.values()) / 10 + 2
    for b, parts in by_bin.items():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] == loads[b] and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))


def test_pipeline_keeps_columns_and_lets_decisions_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = before = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == before.columns and [t for _, t in docs.dtypes] == [t for _, t in before.dtypes]
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert placed.count() == counts[-1] == corpus_pipeline.run(spark, sf).count()
    empty = before.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
