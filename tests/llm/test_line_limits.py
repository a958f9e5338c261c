"""Verdicts of the line rules in hosts of different sizes."""

from tidegrid.llm import line_rules


def test_a_line_is_common_in_a_hot_host_as_in_a_small_one(spark):
    body = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    boiler = "common line " + " ".join(f"b{j}" for j in range(98))
    rows = [(i, f"{boiler}\n{body(i, 60)}", "small") for i in range(25)]
    rows += [(i + 10_000, f"{boiler}\n{body(i, 60)}", "hot") for i in range(25)]
    rows += [(i + 20_000, f"{boiler}\n{body(i, 60)}", "few") for i in range(20)]
    rows += [(i + 30_000, body(i, 3), "hot") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["kept"], r["n_words_left"]) for r in line_rules.line_rules(docs).collect()}
    assert all(got[i] == got[i + 10_000] == (False, 60) for i in range(25))
    assert all(got[i + 20_000] == (True, 160) for i in range(20))


def test_columns_that_clash_by_case(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 7, "x", 8), (2, None, None, 7, "y", 9)], "doc_id long, text string, source string, N_WORDS int, rules_Told string, Salt int")
    got = line_rules.line_rules(docs, cleaned="Text").orderBy("doc_id").collect()
    assert [(r["n_words"], r["rules_Told"], r["Salt"], r["n_words_left"]) for r in got] == [(2, "x", 8, 2), (0, "y", 9, 0)]
    assert [r["Text"] for r in got] == ["a b", ""] and "N_WORDS" not in got[0].asDict()


def test_lines_and_words_left_equal_brute_force(spark):
    import random
    import re
    from collections import defaultdict

    random.seed(6)
    lines = ["", " ", "one", "Two  words", "two words", "a b c d", *[f"line {i} of some" for i in range(12)]]
    rows = [(i, random.choice(["\n", "\r\n"]).join(random.choices(lines, k=random.randint(0, 9))), random.choice(["h", "g", None])) for i in range(400)]
    rows += [(1000 + i, "copied line\none", "h") for i in range(300)]
    norm = lambda line: " ".join(re.findall(r"[^\x20\x09-\x0D]+", line)).lower()
    held = defaultdict(set)
    for _, text, host in rows:
        for line in text.split("\n"):
            if norm(line):
                held[host, norm(line)].add(text)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = {r["doc_id"]: r for r in line_rules.line_rules(docs, cleaned="left_over").collect()}
    gone = 0
    for i, text, host in rows:
        stay = [x for x in text.split("\n") if len(held.get((host, norm(x)), ())) <= line_rules.LEAST]
        gone += len(text.split("\n")) - len(stay)
        assert got[i]["n_words_left"] == len(norm(" ".join(stay)).split())
        assert norm(got[i]["left_over"]) == norm(" ".join(stay))
    assert gone > 500 and len(got) == len(rows)
