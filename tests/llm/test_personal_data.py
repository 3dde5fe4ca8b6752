import hashlib
import random
import re
import time

import pytest

from spillway.llm import personal_data as pii
from spillway.llm.common import Workspace
from spillway.llm.queries import op13_personal_data
from tests.llm.helpers import CASES, clashing, documents, plain

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def brute(text):
    return [(kind, m.start(), m.end()) for kind, expression in CONTRACT.items()
            for m in re.finditer(expression, text or "") if holds(kind, m[0])]


def base_of(found):
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["base"]] for r in found.select("doc_id", "base").collect()}


PIECES = ["a", "b.c", "@", "@x", ".", "..", "-", "_", "%", "+", "+1", "4", "16", "255", "256", "000", "1.2.3", "1.2.3.4", " ", "(", ")", "\n",
          "4539578763621486", "4539 5787-6362 1486", "12345678", "é", "\U0001f600", "+49 (30) 1234-567", "x.y@mail.example.org", ":", "\x1f"]


def test_base_spans_equal_plain_expressions(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(40))), "en", "s", 0) for i in range(4000)]
    got = base_of(pii.scan(documents(spark, rows)))
    for i, text, *_ in rows:
        assert got[i] == brute(text), text


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = op13_personal_data(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        written = [f"{k}:{s}:{e}" for k, s, e in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in CONTRACT] == [sum(w[0] == k for w in want) for k in CONTRACT]
        assert set(written) <= set(filter(None, r["spans"].split(",")))


def test_many_spans_and_long_stretches_take_little_time(spark):
    many = "1.2.3.4 +1 (555) 123-4567 " * 3000
    long = ["1" * 300_000, "1-" * 300_000, "a." * 300_000, "+1" + "(" * 300_000, "a@" * 100_000, "1." * 100_001, "@" + "b" * 300_000]
    begin = time.monotonic()
    got = base_of(pii.scan(documents(spark, [(0, many, "en", "s", 0)])))
    assert got[0] == brute(many)
    found = base_of(pii.scan(documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(long)])))
    assert len(found) == len(long) and found[1] == [] and len(found[5]) == 25_000
    assert time.monotonic() - begin < 60


@pytest.fixture(scope="module")
def learned(spark):
    """Documents with e-mail addresses, phone numbers and noise, written as the base expressions want them and otherwise."""
    rng = random.Random(3)
    words = "river stone talk under nothing green window market seven paper".split()
    rows = []
    for i in range(1500):
        said = [rng.choice(words) for _ in range(rng.randrange(5, 40))]
        if i % 3 == 0:
            said.insert(3, f"call +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} now")
        if i % 4 == 0:
            said.insert(2, f"mail jo.{i}@post{i % 7}.example.org today")
        if i % 5 == 0:
            said.insert(1, f"order {rng.randrange(10**15, 10**16)} sent")
        rows.append((i, " ".join(said), "en", "s", 0))
    rows.append((9001, "please mail jo.17 (at) post3.example.org today", "en", "s", 0))
    rows.append((9002, "please call 1 (212) 555-0123 now", "en", "s", 0))
    rows.append((9003, "river stone 1234567890123456 talk", "en", "s", 0))
    found = pii.find_personal_data(documents(spark, rows), Workspace(spark, "t")).collect()
    return {r[1]: [] for r in rows}, {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in found}


def test_trees_add_spans_written_otherwise(learned):
    _, spans = learned
    assert spans[9001] == ["email_like"]
    assert spans[9002] == ["phone_like"]
    assert spans[9003] == []
    clean = [i for i in range(1500) if i % 3 and i % 4]
    assert not any(k.endswith("_like") for i in clean for k in spans[i])


def test_odd_cases(spark):
    found = pii.find_personal_data(documents(spark), Workspace(spark, "t"))
    assert found.count() == len(CASES)
    assert plain(pii.find_personal_data(clashing(documents(spark)), Workspace(spark, "t"))) == plain(found)
    assert pii.find_personal_data(documents(spark, []), Workspace(spark, "t")).count() == 0


def test_no_python_worker_on_the_main_path(spark):
    found = pii.find_personal_data(documents(spark), Workspace(spark, "t"))
    for plan in (found, pii.scan(documents(spark)), pii.vectors(pii.scan(documents(spark)))):
        text = plan._jdf.queryExecution().toString()  # noqa: SLF001
        assert "Python" not in text and "Arrow" not in text
