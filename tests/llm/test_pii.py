"""Personal data against the plain definitions in Python, and the query's SQL."""

import hashlib
import random
import re

import pytest
from common_rows import LONG, frame, ids

from envlake.llm.pii import find_pii, pii_report


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def slow(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


CARD = "4539 1488 0343 6467"
TEXTS = ["", None, "mail a.b+c@x-y.co.uk, a@b.com_x@c.de a@b @c.de x@y.z..q", f"card {CARD} 4539148803436467 4539-1488 0343 6468 12",
         "1.2.3.4.5.6.7.8 256.1.1.1 01.02.003.004 1.2.3 9.9.9.9a 0000000255.1.1.1", "+1 (555) 123-4567. +49 30 1234 +123456789012345678 +1+2 3456 7890",
         "é日本 a@b.co ñ +1 555 123 4567 日", "IBAN GB82WEST12345698765432 DE89370400440532013000 DE89370400440532013001",
         f"{CARD}-1 {CARD}{CARD}", "4 5 3 9 1 4 8 8 0 3 4 3 6 4 6 7"]


def test_base_spans_match_the_definitions(spark):
    rnd = random.Random(8)
    bits = ["@", ".", "a", "b.co", "+", "1", "23", "4539148803436467", " ", "-", "(", "255", "1.2.3.4", "é", "_", "x@y.z"]
    texts = TEXTS + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(40))) for _ in range(600)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in pii_report(df).collect():
        want = slow(texts[r.doc_id])
        base = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (texts[r.doc_id], r.spans, base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[2] == k for w in want) for k in ("email", "ip", "card", "phone")]
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("iban")) == base


def test_iban_and_context_scores(spark):
    texts = ["IBAN GB82WEST12345698765432", "GB82WEST12345698765432", "GB82WEST12345698765433", f"visa {CARD}", CARD]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.scores for r in pii_report(df).collect()}
    assert got == {0: "iban:5:100", 1: "iban:0:85", 2: "", 3: "card:5:95", 4: "card:0:75"}


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "a.b@" + "c." * 100_000,
                                  "x@y" + ".z" * 50_000, "1 " * 100_000, "A1" * 100_000])
def test_very_long_runs_take_linear_time(spark, text):
    assert pii_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).count() == 1
    pii_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()


def test_plan_is_native(spark):
    plan = pii_report(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_awkward_rows(spark):
    got = pii_report(frame(spark))
    assert ids(got) == ids(frame(spark)) and LONG
    assert {r.spans for r in got.collect()} == {""}
    assert find_pii(frame(spark, [])).count() == 0
