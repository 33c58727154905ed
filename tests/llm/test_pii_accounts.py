"""Account numbers before capital words and digits, of all countries, against a loop over all starts."""

import random

from pyspark.sql import functions as F

from clickfolk.llm import pii


def checked(code, n, spaced):
    body = "".join(random.choice("0123456789" if i % 3 else "0123456789ABZ") for i in range(n - 4))
    number = int("".join(str(int(c, 36)) for c in f"{body}{code}00"))
    plain = f"{code}{98 - number % 97:02d}{body}"
    return " ".join(plain[i : i + 4] for i in range(0, n, 4)) if spaced else plain


def plain_numbers(text):
    def fine(value):
        plain = value.replace(" ", "")
        spaced = " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))
        return (value in (plain, spaced) and plain.isalnum() and plain == plain.upper() and plain[2:4].isdigit()
                and pii.IBAN_REGISTRY.get(plain[:2]) == len(plain)
                and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1)

    def touches(c):
        return c.isascii() and c.isalnum()

    return [(i, j) for i in range(len(text)) if not (i and touches(text[i - 1])) and text[i : i + 2] in pii.IBAN_REGISTRY
            for j in range(i + 15, min(i + 43, len(text) + 1)) if not (j < len(text) and touches(text[j])) and fine(text[i:j])]


def test_accounts_equal_loop(spark):
    random.seed(6)
    assert len(pii.IBAN_REGISTRY) > 80
    ends = ["", " BIC", " I pay", " 12 May", " 1234 5678", ".", " and", " BIC FOR 2024 NOW", "X", "é"]
    begins = ["account ", "IBAN ", "bank NO12 ", "konto LU99 ", "x account:", "account ünd "]
    rows = []
    for code, n in pii.IBAN_REGISTRY.items():
        for spaced in (False, True):
            rows += [random.choice(begins) + checked(code, n, spaced) + end + " bank" for end in ends]
    rows += [f"account {checked('AT', 20, True)} {checked('BE', 16, True)} {checked('DE', 22, False)} bank" for _ in range(20)]
    rows += ["account AT61 1904 3002 3457 3201 BIC"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    found = pii.find_spans(df, base=[]).withColumn("m", pii.masked(F.col("text"), F.col("spans"))).collect()
    near = 0
    for r in found:
        got, want = [(s.start, s.end) for s in r.spans if s.kind == "iban"], plain_numbers(r.text)
        assert got == want, r.text
        near += len(got)
    assert near > 9 * 2 * len(pii.IBAN_REGISTRY) - 100
    assert [r.m for r in found if r.doc_id == len(rows) - 1] == ["account [IBAN] BIC"]
