import hashlib
import re
from collections import Counter

from helpers import docs, folder, scraps
from postline.llm.pii import find_pii, op2_pii_spans

KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    found = []
    for kind, pattern in KINDS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans_equal_brute_force(spark, tmp_path):
    pieces = ["a", "b@", "c.d", "1", "23", ".", "@", "+", "-", " ", "(", ")", "4111 1111 1111 1111", "é", "😀", "256",
              "1.2.3.4", "0007.1.2.3", "+1 (555) 123-4567", "x@y.z", "_", "%", "\n", "9" * 20]
    rows = list(enumerate(scraps(5, pieces, 800, 25)))
    rows += [(None, None), (None, "a@b.c"), (9000, ""), (9001, "a@b.c"), (9001, "a@b.c"), (9002, "x@y.z " * 2000),
             (9003, "9" * 100_000), (9004, "a" * 100_000), (9005, "+1" + "(" * 50_000), (9006, "1." * 20_000 + "9")]
    path = folder(tmp_path, documents=docs(spark, rows).withColumnRenamed("source", "kind"))
    got = op2_pii_spans(spark, path).collect()
    want = Counter((i, hashlib.sha256(",".join(brute(t)).encode()).hexdigest()) for i, t in rows)
    assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[9002].n_email == 2000 and by_id[9000].spans == "" and by_id[9006].n_ip == 5000


def test_checksums_and_context(spark):
    rows = docs(spark, [
        (1, "transfer to account GB82 WEST 1234 5698 7654 32 please"), (2, "GB82 WEST 1234 5698 7654 33"),
        (3, "amex card 378282246310005"), (4, "number 378282246310005"), (5, "ssn 123-45-6789"), (6, "part 123-45-6789"),
        (7, "call +49 (30) 1234567"), (8, "order +49 (30) 1234567")])
    got = {r.doc_id: r for r in find_pii(rows).collect()}
    assert [s.kind for s in got[1].pii_added] == ["iban"] and got[2].pii_added == []
    assert [s.kind for s in got[3].pii_added] == ["card_short"] and got[4].pii_added == []
    assert [s.kind for s in got[5].pii_added] == ["ssn"] and got[6].pii_added == []
    assert got[7].pii_base[0].score > got[8].pii_base[0].score
    assert set(rows.columns) <= set(find_pii(rows).columns)


def test_empty_table(spark, tmp_path):
    assert op2_pii_spans(spark, folder(tmp_path, documents=docs(spark, []))).collect() == []


def test_no_python_in_the_plan(spark, tmp_path):
    plan = op2_pii_spans(spark, folder(tmp_path, documents=docs(spark, [(1, "a")])))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "Exchange" not in plan
