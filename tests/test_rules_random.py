"""The text rules on thousands of random values, against plain Python."""

import datetime
import random
import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from claimsieve.functions import rules


def whole(text):
    match = re.fullmatch(r"[ \t\n]*([+-]?[0-9]+)(\.[0-9]*)?[ \t\n]*", text)
    number = int(match[1]) if match else None
    return number if number is not None and -(2**31) <= number < 2**31 else None


def money(text):
    try:
        number = Decimal(text.replace(",", "").strip())
    except InvalidOperation:
        return None
    if not number.is_finite():
        return None
    rounded = number.quantize(Decimal("0.01"), ROUND_HALF_UP)
    return rounded if abs(rounded) < 10**12 else None


def day(text):
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text) or text.startswith("0000"):
        return None
    try:
        return datetime.date(*map(int, text.split("-")))
    except ValueError:
        return None


def title(text):
    return " ".join(word[:1].upper() + word[1:].lower() for word in text.strip(" ").split(" "))


def numbers(r):
    sign, digits = r.choice(["", "", "-", "+"]), str(r.randrange(10 ** r.randrange(1, 15)))
    tail = r.choice(["", "", ".", f".{r.randrange(10 ** r.randrange(1, 5))}", "x", " 1"])
    text = sign + (f"{int(digits):,}" if r.random() < 0.3 else digits) + tail
    return r.choice(["", " ", "\t"]) + text + r.choice(["", " "])


def dates(r):
    text = f"{r.randrange(1, 2400):04d}-{r.randrange(14):02d}-{r.randrange(33):02d}"
    return text if r.random() < 0.8 else r.choice([text + " ", text[1:], text.replace("-", "/"), text + "\n", text[:-1]])


def words(r):
    return "".join(r.choice("aB zÄé-'1\t") for _ in range(r.randrange(12)))


@pytest.mark.parametrize(
    ("rule", "model", "values"),
    [
        (rules.whole_number, whole, numbers),
        (rules.safe_decimal, money, lambda r: numbers(r).replace("\t", "")),
        (rules.strict_date, day, dates),
        (rules.titled, title, words),
    ],
    ids=["whole_number", "safe_decimal", "strict_date", "titled"],
)
def test_rule_equals_its_model(spark, rule, model, values):
    r = random.Random(11)
    texts = sorted({values(r) for _ in range(4000)})
    table = spark.createDataFrame([(text,) for text in texts], "v string")
    found = {row.v: row.out for row in table.select("v", rule(F.col("v")).alias("out")).collect()}
    assert {text: value for text, value in found.items() if value != model(text)} == {}
    assert any(value is None for value in found.values()) or rule is rules.titled
