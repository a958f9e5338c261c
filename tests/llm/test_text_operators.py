"""Token counts, words, URL filter, main text, tiling, line rules and licences on small inputs."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidegrid.llm import decontamination, line_rules, main_text, token_counts, url_filter, words
from tidegrid.llm.license_scan import oracle, scan_licences

MODEL = "piece_bpe_32k.model"
ODD = ["", " ", "  a  b ", "\n", "a\tb\r\nc", "İé漢字😀", "<s>hi</s><unk>", "▁x", "12 345", "x" * 5000, "²³ ½", "a\x00b"]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    random.seed(3)
    signs = ["a", "e", "th", "ing", " ", "  ", "\n", "é", "漢", "😀", "1", "_", "!", "ª", "क", "ि", "\n ", " \n"]
    texts = ODD + ["".join(random.choices(signs, k=random.randint(0, 40))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r["doc_id"]: r for r in token_counts.count_tokens(docs, MODEL).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_bytes"], got[i]["n_tokens"]) == (len(t.encode()), len(model.encode(t)))
        assert got[i]["over_limit"] == (len(model.encode(t)) > 4096)


def test_token_counts_of_null_repeated_and_no_rows(spark):
    docs = frame(spark, [(1, None), (1, None), (None, "a b")])
    assert sorted((r["n_tokens"], r["n_bytes"]) for r in token_counts.count_tokens(docs).collect()) == [(0, 0), (0, 0), (2, 3)]
    assert token_counts.count_tokens(frame(spark, [])).count() == 0


def test_words_are_runs_of_what_is_not_blank():
    texts = ["a b", "", None, " x\ty ", "one", "é\u00a0ü z", "A" * 2_000_000 + " b"]
    got = []
    for t in words.slices(pa.array(texts), most=6):
        w = words.words_of(t)
        got += [t.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
        again = words.words_of(t)
        assert (w.key == again.key).all()
    assert got == [x for t in texts for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    one = next(words.slices(pa.array(["x yy x", "yy"])))
    key = words.words_of(one).key
    assert key[0] == key[2] and key[1] == key[3] and key[0] != key[1]


RULES = [url_filter.Rule(*r) for r in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"))]


def test_url_hosts_paths_and_rules(spark):
    urls = {
        1: ("https://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        2: ("x://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        3: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        4: ("http://a.com?x://y", "a.com", "", None, None),
        5: (None, "", "", None, "block"),
        6: ("no scheme", "", "", None, "block"),
        7: ("://", "", "", None, "block"),
        8: ("http://É.COM:80/Ä", "É.com:80", "/Ä", None, None),
    }
    pages = spark.createDataFrame([(k, v[0], "h") for k, v in urls.items()], "page_id long, url string, host string")
    for r in url_filter.judge_urls(pages, RULES, ["page_id"]).collect():
        _, host, path, rule, verdict = urls[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0), RULES, ["page_id"]).count() == 0


def test_url_scores_equal_brute_force(spark):
    random.seed(5)
    texts = sorted({f"{random.choice(['aa', 'ab', 'ba'])}.{random.choice(['com', 'net', 'org'])}/{random.randint(0, 99)}" for _ in range(120)})
    grams = [(("\x02" * 4 + t)[i : i + 5], t) for t in texts for i in range(len(t))]
    yes = Counter(g for g, t in grams if ".com" in t)
    no = Counter(g for g, t in grams if ".net" in t)

    def chance(counts, gram):
        if not gram:
            return 1 / 256
        length, own = len(gram), defaultdict(int)
        for g, n in counts.items():
            if g[5 - length : -1] == gram[:-1]:
                own[g[-1]] += n
        total, kinds = sum(own.values()), len(own)
        shorter = chance(counts, gram[1:])
        return (own[gram[-1]] + kinds * shorter) / (total + kinds) if total else shorter

    table = spark.createDataFrame([(g, yes[g], no[g]) for g in {g for g, _ in grams}], "gram string, yes long, no long")
    for r in url_filter.log_ratios(table).collect():
        assert r["ratio"] == pytest.approx(math.log(chance(yes, r["gram"])) - math.log(chance(no, r["gram"])), abs=1e-9)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><p>Site header, with words, and words.</p></header><nav><ul><li><a href=x>Home</a><li><a>More</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, you know, and so on and on and on.</p></div>
<div id="content"><div class="post"><h1>Title &amp; more</h1>
<p>First part, with commas, and long enough to be prose that somebody reads.<p>Second
 part &lt;b&gt; with <b>bold<br> text</b>, a <a href=y>link</a>, and more of it here.</p><table><tr><td>cell, one<td>cell two</table>
<div class="ad">Buy this, now, it is good, and cheap, and good.</div></div>
<div id="comments"><p>Nice one, I liked it, a lot, thanks for all of it, really.</p></div></div>
<aside>side, side, side</aside><form><p>name, mail</p></form><footer>&copy; foot</footer><script>var t="</p>";</script></body></html>"""


def test_main_text_keeps_the_article_alone():
    assert main_text.main_text(PAGE).split("\n\n") == [
        "Title & more",
        "First part, with commas, and long enough to be prose that somebody reads.",
        "Second part <b> with bold text, a link, and more of it here.",
        "cell, one",
        "cell two",
    ]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<script>x", "<!-- x", "</div></p>", "<nav>a</nav>", "<div " + 'a="' * 50])
def test_main_text_of_broken_pages(page):
    assert isinstance(main_text.main_text(page), str)


def test_main_text_of_deep_and_cut_pages():
    assert main_text.main_text("<div>" * 20000 + "deep words") == "deep words"
    assert main_text.main_text("<article><p>a b</p><p>c &am") == "a b\n\nc &am"
    assert main_text.main_text("plain &eacute; text") == "plain é text"


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None)], "page_id long, url string, html string, n_chars string")
    got = main_text.extract(pages, ["page_id", "url"]).collect()
    assert sorted(r["n_chars"] for r in got) == sorted([0, len(main_text.main_text(PAGE)), len(main_text.main_text(PAGE))])
    assert main_text.extract(pages.limit(0), ["page_id"]).count() == 0


def covered_by_brute_force(item, doc, least):
    in_item, in_doc, covered = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not in_item[i + n] and not in_doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return covered
        n, i, j = best
        in_item[i : i + n] = in_doc[j : j + n] = [True] * n
        in_item, in_doc = in_item[: len(item)], in_doc[: len(doc)]
        covered += n


def test_tiles_equal_brute_force():
    random.seed(11)
    for _ in range(120):
        item = [random.randint(0, 30) for _ in range(random.randint(1, 40))]
        doc = [random.randint(0, 30) for _ in range(random.randint(0, 30))]
        for _ in range(random.randint(0, 3)):
            a = random.randint(0, len(item))
            doc[random.randint(0, len(doc)) : 0] = item[a : a + random.randint(1, 12)]
        got = decontamination.tiles(item, doc, 3)
        assert sum(t[2] for t in got) == covered_by_brute_force(item, doc, 3)
        assert all(item[i : i + n] == doc[j : j + n] for i, j, n in got)


def test_contaminated_documents(spark):
    passage = "The quick brown fox jumps over the lazy dog while seven wizards mix green potions in a copper kettle"
    half = passage.split()
    docs = frame(spark, [
        (1, "Intro. " + passage.upper() + " End."),
        (2, " ".join(half[10:]) + ". And then: " + " ".join(half[:10])),
        (3, "Nothing to see here, the quick brown fox only"),
        (4, None), (5, ""), (None, passage), (1, "other"),
    ])
    bench = spark.createDataFrame([(7, passage), (8, None), (9, "tiny one"), (7, passage)], "item_id long, text string")
    for most in (1 << 20, 1):
        got = sorted((str(r["doc_id"]), r["item_id"], r["covered_words"]) for r in decontamination.contaminated(docs, bench, block_seeds=most).collect())
        assert got == sorted([("1", 7, len(half))] * 2 + [("2", 7, len(half))] * 2 + [("None", 7, len(half))] * 2)
        left = decontamination.without_contaminated(docs, bench, block_seeds=most).collect()
        assert sorted(r["text"] or "" for r in left) == ["", "", "Nothing to see here, the quick brown fox only", "other"]
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0


def base_by_brute_force(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)]


def test_base_counts_equal_brute_force(spark):
    random.seed(7)
    signs = ["a", "b", "é", "#", "|", " ", " ", "  ", "\n", "\n", "\t", "\r\n", "a b c", "漢"]
    texts = ["".join(random.choices(signs, k=random.randint(0, 60))) for _ in range(300)] + ["", None, "\n\n", "a\na\n a", "x y z x y z"]
    docs = spark.createDataFrame([(i, t, "h", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, n_words long")
    rows = {r["doc_id"]: r for r in line_rules.line_rules(docs).collect()}
    for i, t in enumerate(texts):
        expected = base_by_brute_force(t or "")
        assert [rows[i][c] for c in line_rules.COUNTS] == expected
        assert rows[i]["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])


def test_common_lines_are_removed_and_depleted_documents_rejected(spark):
    body = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    boiler = "Common  LINE 12 " + " ".join(f"b{j}" for j in range(57))
    rows = [(i, f"{boiler}\n{body(i, 80)}", "h") for i in range(30)]
    rows += [(100 + i, f"common line 12 {' '.join(f'b{j}' for j in range(57))}\n{body(900 + i, 20)}", "h") for i in range(3)]
    rows += [(200 + i, f"{boiler}\n{body(200 + i, 80)}", "other") for i in range(5)]
    rows += [(300 + i, "copied line " + body(7, 60), "h") for i in range(40)] + [(400, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for salts in (32, 1):
        got = {r["doc_id"]: r for r in line_rules.line_rules(docs, least=10, share=0.01, cleaned="clean", salts=salts).collect()}
        assert all(got[i]["kept"] and got[i]["clean"] == body(i, 80) and got[i]["n_words_left"] == 80 for i in range(30))
        assert not any(got[100 + i]["kept"] or got[100 + i]["base_failed"] for i in range(3))
        assert all(got[200 + i]["kept"] and got[200 + i]["n_words_left"] == 140 for i in range(5))
        assert all(got[300 + i]["kept"] for i in range(40))  # equal texts are one document
        assert got[400]["base_failed"] and not got[400]["kept"]
    assert line_rules.line_rules(docs.limit(0)).count() == 0


def test_licences(spark):
    texts = {
        1: "Intro here. Licensed under the Apache License, Version 2.0.\nMore",
        2: "GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
        3: None, 4: "", 5: "All rights reserved. All Rights  Reserved!", 6: "nothing", 7: "see the License.",
        8: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and. The above copyright notice and this permission notice shall be included in all copies.",
    }
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, licences string")
    got = {r["doc_id"]: r for r in scan_licences(docs, ["doc_id"]).collect()}
    assert [got[i]["licences"] for i in (1, 5, 8)] == ["Apache-2.0", "All-Rights-Reserved", "MIT"]
    assert [got[i]["sentence_ids"] for i in (3, 4, 6)] == ["", "", ""] and got[7]["left_ids"] == "NOTICE"
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(texts), "text": pa.array(list(texts.values()), pa.string())}))
    for k, ids, licences, left in con.execute(oracle()).fetchall():
        assert (ids, licences, left) == (got[k]["sentence_ids"], got[k]["licences"], got[k]["left_ids"])
    assert scan_licences(docs.limit(0), ["doc_id"]).count() == 0


def test_slots_keep_what_is_there(spark):
    from tidegrid.llm.storage import in_slots, slots_of

    some = spark.range(0, 3000, 3).withColumnRenamed("id", "key")
    left = in_slots(spark.range(3000).withColumnRenamed("id", "bucket"), "bucket", slots_of(some, "key"))
    kept = {r["bucket"] for r in left.collect()}
    assert kept >= set(range(0, 3000, 3)) and len(kept) < 1100 and left.columns == ["bucket"]
