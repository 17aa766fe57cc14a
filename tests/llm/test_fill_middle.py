import hashlib
import re

import pytest
from pyspark.sql import functions as F

from llm_cases import SCHEMA, plain
from panelkit.llm.fill_middle import fill_in_middle, restored


def brute(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    low, high = sorted([h1 % (n + 1), h2 % (n + 1)])
    prefix, middle, suffix = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(docs):
    found = fill_in_middle(docs)
    rows = found.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = [brute(*d) for d in plain(docs)]
    assert sorted(map(str, (tuple(r)[:6] for r in rows))) == sorted(map(str, want))
    texts = sorted((str(d), t or "") for d, t in plain(docs))
    assert sorted((str(r.doc_id), r.back) for r in rows) == texts
    return rows


def test_equals_brute_force(hard_docs):
    check(hard_docs)


def test_markers_control_bytes_and_bits_of_markers(spark):
    odd = ["<P>a", "x<S>", "<M>", "<P", "a <S<P b> c", "\x00a\x00", "é ß 漢字𝄞x\x7f\x80\xff", "<", "a", "\n", "ab" * 50, "\xff\xfe a", "<<<>>> P> S>"]
    docs = spark.createDataFrame([(100 * k + i, t) for k in range(30) for i, t in enumerate(odd)], "doc_id long, text string")
    forms = {r.form for r in check(docs)}
    assert forms == {"plain", "psm", "spm"}


def test_text_beyond_a_slice(spark):
    docs = spark.createDataFrame([(i, f"né{i}w, " * 600_000) for i in range(2)] + [(2, "ends here")], "doc_id long, text string")
    check(docs)


def test_empty_table(no_docs):
    assert fill_in_middle(no_docs).collect() == []


@pytest.mark.parametrize("percent, spm, form", [(100, 0, "plain"), (0, 100, "spm"), (0, 0, "psm")])
def test_shares_are_parameters(spark, percent, spm, form):
    docs = spark.createDataFrame([(i, f"text {i}", "en", 1, 1, True) for i in range(50)], SCHEMA)
    assert {r.form for r in fill_in_middle(docs, plain_percent=percent, spm_percent=spm).collect()} == {form}
