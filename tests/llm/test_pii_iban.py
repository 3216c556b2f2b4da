import random

from helpers import docs
from postline.llm.pii import IBAN_LENGTHS, find_pii


def check_digits(country, rest):
    turned = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{country}{98 - int(turned) % 97:02d}{rest}"


def spaced(iban):
    return " ".join(iban[i:i + 4] for i in range(0, len(iban), 4))


def test_the_end_is_found_whatever_follows(spark):
    rnd = random.Random(3)
    ibans = ["ES9121000418450200051332", "BE68539007547034", "GB82WEST12345698765432"]
    ibans += [check_digits(c, "".join(rnd.choice("0123456789") for _ in range(n - 4))) for c, n in IBAN_LENGTHS.items()]
    ibans += [check_digits("ZZ", "1234567890123456")]  # no listed country
    texts = []
    for iban in ibans:
        for form in (iban, spaced(iban)):
            for tail in ("", ".", " Banco", " Bank", " EUR", " USD 1200", " 25 Euro", " OK", "\n1234 5678"):
                texts.append(("account ", form, tail))
    # the text of each, and the span that is due
    rows = docs(spark, [(i, "".join(t)) for i, t in enumerate(texts)])
    got = {r.doc_id: [(s.kind, s.start, s.end, s.value) for s in r.pii_base + r.pii_added] for r in find_pii(rows).collect()}
    for i, (head, form, tail) in enumerate(texts):
        due = ("iban", len(head), len(head) + len(form), form)
        assert due in got[i] or any(k == "card" for k, *_ in got[i]), (texts[i], got[i])
    assert sum(any(s[0] == "iban" for s in x) for x in got.values()) > 0.9 * len(texts)


def test_two_in_a_row_and_wrong_ones(spark):
    a, b = "BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"
    rows = docs(spark, [(1, f"konto {a} {b}"), (2, "konto BE68 5390 0754 7035 EUR"), (3, "xBE68 5390 0754 7034"), (4, f"é😀 {a} X")])
    got = {r.doc_id: [s.value for s in r.pii_added if s.kind == "iban"] for r in find_pii(rows).collect()}
    assert got == {1: [a, b], 2: [], 3: [], 4: [a]}
