import hashlib
import random
import re

from capplan.llm import pii


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base(text):
    patterns = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )
    for kind, pattern in patterns:
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            if kind == "ip" and any(int(part) > 255 for part in match.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            yield kind, *match.span()


def expected(text):
    spans = list(base(text))
    listed = ",".join(":".join(map(str, s)) for s in spans)
    counts = [sum(s[0] == kind for s in spans) for kind in ("email", "ip", "card", "phone")]
    return (*counts, hashlib.sha256(listed.encode()).hexdigest())


def digests(frame):
    return {r.doc_id: tuple(r)[1:] for r in pii.digest(pii.find_personal_data(frame, "doc_id")).collect()}


def test_base_spans_are_those_of_the_patterns(spark):
    pick = random.Random(3)
    parts = ["1", "2.", ".", "255", "256", "a", "@", "b.c", "-", " ", "+", "(", ")", "4111111111111111", "4111 1111-1111 1111"]
    parts += ["é", "\x01", "\x02", "\n", "_", "+1 555", "a@b.c", "000", "1.2.3.4", "😀", "GB82 WEST 1234 5698 7654 32"]
    docs = [(i, "".join(pick.choice(parts) for _ in range(pick.randint(0, 25)))) for i in range(1500)]
    docs += [(9001, "1" * 3000), (9002, "a" * 3000 + "@"), (9003, "1.2.3.4 " * 500), (9004, "+1" + "(" * 3000)]
    found = digests(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    for doc, text in docs:
        assert found[doc][:5] == expected(text), text[:200]


def test_long_runs_cost_no_more_than_they_should(spark):
    docs = [(1, "1" * 300_000), (2, "a" * 300_000 + "@"), (3, "1 " * 150_000), (4, "A1" * 150_000)]
    assert all(r[0] == 0 for r in digests(spark.createDataFrame(docs, "doc_id long, text string")).values())


def test_checksums_and_context(spark):
    docs = [
        (1, "iban DE89 3704 0044 0532 0130 00 end"),
        (2, "iban DE88 3704 0044 0532 0130 00 end"),
        (3, "device imei 490154203237518"),
        (4, "number 490154203237518"),
        (5, "card 4111 1111 1111 1111"),
        (6, "card 4111 1111 1111 1112"),
    ]
    rows = pii.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id").collect()
    found = {r.doc_id: [(s.kind, s.value, round(s.score, 1)) for s in r.spans] for r in rows}
    assert found == {
        1: [("iban", "DE89 3704 0044 0532 0130 00", 0.9)],
        2: [],
        3: [("imei", "490154203237518", 0.6)],
        4: [],
        5: [("card", "4111 1111 1111 1111", 1.0)],
        6: [],
    }


def test_no_python_in_the_plan(spark, odd):
    plan = pii.digest(pii.find_personal_data(odd, "doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_input(spark, odd, none):
    rows = pii.digest(pii.find_personal_data(odd, "doc_id")).collect()
    assert len(rows) == odd.count() and all(r.spans == "" for r in rows)
    assert pii.digest(pii.find_personal_data(none, "doc_id")).count() == 0
