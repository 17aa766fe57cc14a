import random
import re

import pytest
from pyspark.sql import functions as F

from llm_cases import plain
from panelkit.llm import secret_scan as module
from panelkit.llm.secret_scan import FEATURES, candidates, described, dictionary, label_by_rule, scored, secret_scan, train

KEY = re.compile(r"[A-Za-z0-9+/_=\-]{16,}")


def test_candidates_as_brute_force(hard_docs):
    want = []
    for doc, text in plain(hard_docs):
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        for i, w in enumerate(words):
            want += [(doc, i, k, w, words[i - 1] if i else "", words[i - 2] if i > 1 else "", (words + [""])[i + 1], c) for k, c in enumerate(KEY.findall(w))]
    got = candidates(hard_docs, path_col="lang").select("doc_id", "position", "place", "word", "before", "earlier", "after", "candidate")
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted(want, key=str) and want


def test_features_by_hand(spark):
    entries = spark.createDataFrame([("abcd", 3), ("bcdef", 1), ("mnop", 1)], "entry string, count long")
    text = "my api_key = \"abcdefmnop012345XY\" plainabcdwordmnop"
    docs = spark.createDataFrame([(1, text, "a/test/b.py"), (2, "nothing", None)], "doc_id long, text string, source string")
    rows = {r.candidate: r for r in described(candidates(docs), entries).collect()}
    a, b = rows["abcdefmnop012345XY"], rows["plainabcdwordmnop"]
    assert (a.length, a.digits, a.capitals, a.small, a.symbols) == (18, 6 / 18, 2 / 18, 10 / 18, 0)
    assert a.hexadecimal == 12 / 18 and a.distinct == 1 and a.kind_changes == 2 / 18 and a.case_changes == 0
    assert a.coverage == 10 / 18 and b.coverage == 8 / 17
    assert (a.path_depth, a.path_code, a.path_sample, a.named_before, a.named_after, a.assigned, a.quoted) == (2, 1, 1, 1, 0, 1, 1)
    assert (b.named_before, b.assigned, b.quoted) == (0, 0, 1 - 1)
    assert -8 < b.likelihood < 0 and -8 < a.likelihood < 0


def texts(n=400, seed=2):
    rng, rows = random.Random(seed), []
    for i in range(n):
        prose = " ".join("".join(rng.choices(["the", "on", "er", "ing", "sh", "ble"], k=rng.randint(1, 4))) for _ in range(30))
        if i % 4 == 0:
            prose += f' token = "{"".join(rng.choices("0123456789abcdef", k=40))}" end'
        if i % 3 == 0:
            prose += " " + "".join(rng.choices(["the", "on", "er", "ing", "sh", "ble"], k=9)) + " more"
        rows.append((i, prose))
    return rows


def test_forest_scores_after_rows_were_observed(spark):
    """A session that has counted rows while writing cannot be sent to tasks; the forest has to be free of it."""
    from panelkit.session import store_counted

    assert store_counted(spark.range(5), "observed")[1] == 5
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts(80)], "doc_id long, text string, source string")
    assert {r.doc_id for r in secret_scan(docs).collect() if r.secret} == set(range(0, 80, 4))


def test_forest_removes_words_and_keeps_keys(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts()], "doc_id long, text string, source string")
    rows = secret_scan(docs).collect()
    assert {r.doc_id for r in rows if r.secret} == set(range(0, 400, 4))
    assert any(not r.secret for r in rows)


def test_held_out_accuracy_without_the_words_beside(spark):
    """Keys whose neighbours say nothing are found by their characters."""
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts()], "doc_id long, text string, source string")
    bare = spark.createDataFrame([(i, re.sub(r'token = "(\w+)"', r"\1", t), "s") for i, t in texts(seed=9)], "doc_id long, text string, source string")
    entries = dictionary(docs)
    learned = label_by_rule(described(candidates(docs), entries))
    mixed = learned.unionByName(learned.withColumns({"named_before": F.lit(0.0), "assigned": F.lit(0.0), "quoted": F.lit(0.0)}))
    told = scored(described(candidates(bare), entries), train(mixed)).collect()
    right = [(r.score >= 0.5) == bool(re.fullmatch("[0-9a-f]{40}", r.candidate)) for r in told]
    assert sum(right) / len(right) > 0.95


def test_hard_cases_and_empty_tables(hard_docs, no_docs):
    assert secret_scan(no_docs, path_col="lang").count() == 0
    rows = secret_scan(hard_docs.withColumn("score", F.lit(1)).withColumn("word", F.lit("x")), path_col="block").collect()
    assert {r.score for r in rows} == {0.0}  # all labels say no
    assert len([r for r in rows if r.doc_id == 103]) == 1 and not {100, 101, 102} & {r.doc_id for r in rows}


def test_no_python_on_executors(hard_docs):
    plan = secret_scan(hard_docs, path_col="lang")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
