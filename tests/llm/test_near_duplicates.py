"""The near-duplicate stage of the pipeline against brute force at its own rule."""

import random
import re

import corpus_pipeline


def kept_by_brute_force(rows, n=5):
    sets = []
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        sets.append((key, {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()))
    top = {key: key for key, _ in rows}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    return {key for key, _ in rows if find(key) == key}


def between_the_rules(seed):
    """Copies that 5 words at 0.8 link and 4 words at 0.85 do not, among others near both limits."""
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    rows = []
    for size, edits, more in ((100, 2, 0), (200, 4, 0), (200, 0, 40), (200, 0, 55), (100, 4, 0), (30, 0, 5), (12, 0, 2), (9, 0, 2), (6, 0, 1), (4, 0, 0)):
        for _ in range(3):
            base = [word() for _ in range(size)]
            copy = list(base)
            for e in range(edits):
                copy[(2 * e + 1) * size // (2 * edits)] = word()
            rows += [base, copy + [word() for _ in range(more)]]
    return [(i, t) for i, t in enumerate([*(" ".join(r) for r in rows), "", ""])]


def test_stage_equals_brute_force_at_five_words(spark):
    rows = between_the_rules(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert set(kept) == kept_by_brute_force(rows) and len(kept) == len(set(kept))
    assert not {1, 7, 13} & set(kept)  # the second of the first pair of each of the first three kinds


def test_one_row_of_each_group_stays_whatever_the_keys(spark):
    random.seed(8)
    text = [" ".join("".join(random.choices("abcdefghij", k=6)) for _ in range(40)) for _ in range(6)]
    rows = [
        (1, text[0], "a"), (2, text[0], "b"), (2, text[1], "c"),  # key 2 is a copy once, and once unique
        (3, text[2], "d"), (3, text[2], "d"), (3, text[2].upper(), "e"),  # repeated rows and a copy under one key
        (None, text[3], "f"), (None, text[3] + " more", "g"), (None, text[4], "h"),  # copies without a key
        (None, text[5], "i"), (7, text[5], "j"),
        (8, "", "k"), (8, "", "k"), (None, None, "l"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `copy_hash` string")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = out.collect()
    assert len([r for r in got if (r["text"] or "").lower() == text[2]]) == 1
    assert len([r for r in got if r["copy_hash"] in "fg"]) == 1
    assert sorted(r["copy_hash"] for r in got if r["copy_hash"] not in "defg") == ["a", "c", "h", "j", "k", "k", "l"]


def test_slots_keep_every_value_and_thin_the_rest(spark):
    from tidegrid.llm.storage import in_slots, slots_of

    some = spark.createDataFrame([(i * 37,) for i in range(2000)] + [(None,)], "rep long")
    rows = spark.range(-10, 80_000).selectExpr("id AS k", "id AS bits")
    got = {r["k"] for r in in_slots(rows, "k", slots_of(some, "rep")).collect()}
    wanted = {r["rep"] for r in some.collect()} & {r["k"] for r in rows.collect()}
    assert wanted <= got and len(got) < len(wanted) + 200
    assert in_slots(rows, "k", slots_of(some.limit(0), "rep")).count() == 0
