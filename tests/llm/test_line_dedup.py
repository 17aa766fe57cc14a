import random
import re

from pyspark.sql import functions as F

from llm_cases import SCHEMA, plain
from panelkit.llm.line_dedup import line_dedup, op10_line_dedup


def brute(rows, leading=3, similarity=0.75, least=5):
    key = lambda doc: float("-inf") if doc is None else doc
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            tokens = tuple("<*>" if re.search(rb"[0-9]", t) else t for t in line.encode().split())
            if len(tokens) >= least:
                first[tokens] = min(first.get(tokens, key(doc)), key(doc))
    leaves = {}
    for tokens in first:
        leaves.setdefault((len(tokens), tokens[:leading]), []).append(tokens)
    begun = {}
    for lines in leaves.values():
        templates = []
        for line in sorted(lines, key=lambda t: first[t]):
            share = [sum(a == b and b is not None or b is None and a == "<*>" for a, b in zip(line, t)) / len(line) for t, _ in templates]
            best = max(range(len(share)), key=lambda i: (share[i], -i)) if share else None
            if best is not None and share[best] >= similarity:
                templates[best][0][:] = [a if a == b else None for a, b in zip(line, templates[best][0])]
            else:
                best = len(templates)
                templates.append((list(line), first[line]))
            begun[line] = templates[best][1]
    out = []
    for doc, text in rows:
        kept, lines = [], text.split("\n") if text else []
        for line in lines:
            tokens = tuple("<*>" if re.search(rb"[0-9]", t) else t for t in line.encode().split())
            if len(tokens) < least or begun[tokens] >= key(doc):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def boilerplate(seed=11):
    """One long line per document, so that no two lines are first seen in the same one."""
    rng, rows = random.Random(seed), []
    for i in range(150):
        line = rng.choice([
            f"posted on {rng.randrange(99)} by user{rng.randrange(9)} in the big {rng.choice(['red', 'blue', 'old'])} {rng.choice(['hall', 'room'])}",
            f"own line number of {i} words {' '.join(rng.choices('abcdefgh', k=rng.randrange(6)))}",
            " ".join(rng.choices("ab", k=rng.choice([5, 6, 8]))),
        ])
        rows.append((i, "\n".join(rng.sample([line, "", "short line", "a 1 b"], 4))))
    return rows


def test_templates_as_brute_force(spark):
    frame = spark.createDataFrame([(i, t, None, None, None, None) for i, t in boilerplate()], SCHEMA).repartition(3)
    got = sorted([tuple(r) for r in line_dedup(frame, min_tokens=5).collect()], key=str)
    assert got == brute(boilerplate())
    assert sum("posted on" in r[3] for r in got) <= 4 and 30 < sum(r[2] for r in got) < 140


def test_hard_cases_as_brute_force(hard_docs):
    got = sorted([tuple(r) for r in line_dedup(hard_docs, similarity=1.0, min_tokens=5).collect()], key=str)
    assert got == brute(plain(hard_docs), similarity=1.0)
    assert sum(r[2] for r in got) >= 10


def test_carried_columns(hard_docs, no_docs):
    rows = line_dedup(hard_docs, carry=["lang", "block", "id"]).collect()
    assert len(rows) == hard_docs.count() and all(r.lang == "en" and r.block is None and r.id == 7 for r in rows)
    assert line_dedup(no_docs, carry=["lang"]).count() == 0


def test_short_lines_recur_as_they_are(spark):
    texts = ["All rights reserved.\nPage 1 of 9\nyes", "All rights  reserved.\nPage 2 of 9\n\nAll rights reserved", "Page 1 of 9\nno", "7\nyes", "8\nyes no"]
    frame = spark.createDataFrame([(i, t, None, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: r.kept for r in line_dedup(frame).collect()}
    assert got == {0: texts[0], 1: "Page 2 of 9\n\nAll rights reserved", 2: "no", 3: "7", 4: "8\nyes no"}


def test_every_length_as_brute_force(hard_docs):
    def first_seen(rows):
        first = {}
        for doc, text in rows:
            for line in (text or "").split("\n"):
                tokens = line.encode().split()
                tokens = tuple(tokens if len(tokens) < 5 else ("<*>" if re.search(rb"[0-9]", t) else t for t in tokens))
                yield doc, line, tokens
                first[tokens] = min(first.get(tokens, float("inf")), float("-inf") if doc is None else doc)
        yield first

    rows = plain(hard_docs)
    *lines, first = first_seen(rows)
    want = sorted(str((doc, line)) for doc, line, tokens in lines if not tokens or first[tokens] >= (float("-inf") if doc is None else doc))
    got = line_dedup(hard_docs, similarity=1.0).collect()
    # What loses all its lines is empty, like what had one empty line.
    got = sorted(str((r.doc_id, line)) for r in got if r.n_dropped < r.n_lines or not r.n_lines for line in r.kept.split("\n"))
    assert got == want


def test_query_takes_every_length(spark):
    name = "/root/testdata/sf0.001"
    want = line_dedup(spark.read.parquet(f"{name}/documents.parquet"), min_tokens=1).agg(F.sum("n_dropped")).first()[0]
    assert op10_line_dedup(spark, name).agg(F.sum("n_dropped")).first()[0] == want
