import hashlib
import random
import re

from pyspark.sql import functions as F

from llm_cases import plain
from panelkit.llm.private_data import BASE_KINDS, KINDS, as_text, automaton, find_private, masked, spans_of

ANCHORS = automaton()
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = 0
        for i, d in enumerate(reversed(digits)):
            d = int(d) * (1 + i % 2)
            total += d // 10 + d % 10
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), i, m.end()) for i, kind in enumerate(BASE_KINDS) for m in re.finditer(PATTERNS[kind], text or "") if holds(kind, m[0]))


def base(text):
    return [s for s in spans_of(text, ANCHORS) if s[1] < len(BASE_KINDS)]


def added(text):
    return [(KINDS[k], text[s:e]) for s, k, e in spans_of(text, ANCHORS) if k >= len(BASE_KINDS)]


def test_base_spans_of_random_texts_equal_the_expressions():
    rng = random.Random(5)
    bits = list("0123456789....@@++-- ()aZ%_é,\n") + ["1.2.3.4", "a@b.c", "4111111111111111", "+1 555 555 5555", "255", "256.", "://", "iban "]
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 30)))
        assert base(text) == brute(text), text


def test_base_spans_at_the_borders():
    for text in ["a@b.c@d.e", "a@b@c.d", "a@b.c.@d.e", "1.2.3.4.5.6.7.8", "1.2.3.4.5", "1.2.3.256.1.1.1.1", "0000001.0255.3.4", "9" * 5000 + ".1.1.1",
                 "4111 1111 1111 1111 4111-1111-1111-1111", "41111111111111-11 2", "+1+12345678901", "+(1)2345678901", "+1(234)567-8901)", "+12", "+1 2", "x@-.-", "@a.b", ".@a.b."]:
        assert base(text) == brute(text), text


def test_added_addresses():
    assert added("write to jörg.groß@bücher.example now") == [("address", "jörg.groß@bücher.example")]
    assert added('"ann b"@example.org, x') == [("address", '"ann b"@example.org')]
    assert added("root@[10.0.0.7] root@[10.0.0.999]") == [("address", "root@[10.0.0.7]")]
    assert added("ann (at) example (dot) org; bob[at]mail.example.com") == [("address", "ann (at) example (dot) org"), ("address", "bob[at]mail.example.com")]
    assert added("plain@example.org and é@ü or a(at)b") == []


def test_added_logins():
    assert added("see ftp://ann:pw@files.example.org/x, http://example.org/@ann") == [("login", "ftp://ann:pw@files.example.org")]
    assert added("postgres://u@10.0.0.1:5432/db and ://u@x.org and http://@x.org") == [("login", "postgres://u@10.0.0.1:5432")]


def test_added_accounts():
    assert added("IBAN: DE89 3704 0044 0532 0130 00 AND MORE") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert added("iban GB82WEST12345698765433") == []
    assert added("SSN 078-05-1120; ssn 666-05-1120; ssn 000051120") == [("account", "078-05-1120")]
    assert added("Account no. 12345678, accountant 12345678, passport C01234567, account 123") == [("account", "12345678"), ("account", "C01234567")]


def test_rows_equal_brute_force(spark, hard_docs):
    extra = [(200, "mail a.b+c@mail.example.com or +1 (499) 555-6503 at 188.54.39.104 with 4111 1111 1111 1111."), (201, ("née x@y.zz 10.0.0.1 " * 90_000))]
    docs = hard_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = find_private(docs).select("doc_id", as_text(F.filter("spans", lambda s: s["base"])).alias("spans")).collect()
    want = [(d, ",".join(f"{BASE_KINDS[k]}:{s}:{e}" for s, k, e in brute(t))) for d, t in plain(docs)]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def test_query_is_derived_from_the_spans(spark):
    from panelkit.llm.private_data import op13_private_data

    sf = "/root/testdata/sf0.001"
    texts = dict(plain(spark.read.parquet(f"{sf}/documents.parquet")))
    rows = op13_private_data(spark, sf).collect()
    assert len(rows) == len(texts) and sum(r.n_email for r in rows) > 0
    for r in rows:
        spans = brute(texts[r.doc_id])
        told = ",".join(f"{BASE_KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in BASE_KINDS] == [s for s in told.split(",") if s]


def test_masked_text():
    text = "ftp://ann:pw@files.example.org/x or ann@example.org, 10.0.0.1"
    assert masked(text, spans_of(text, ANCHORS)) == "[login]/x or [email], [ip]"


def test_mask_column_and_empty_table(spark, no_docs):
    docs = spark.createDataFrame([(1, "to a@b.cc"), (2, None)], "doc_id long, text string")
    assert [tuple(r) for r in find_private(docs, mask=True).select("doc_id", "masked").orderBy("doc_id").collect()] == [(1, "to [email]"), (2, "")]
    assert find_private(no_docs).collect() == []
