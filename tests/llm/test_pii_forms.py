"""Personal data beside other numbers, and in its printed, national and international forms."""

import re

import pytest

from touchline.llm import pii

SCHEMA = "doc_id long, text string"


def texts(spark, rows):
    return [r["text"] for r in sorted(pii.pseudonymise(spark.createDataFrame(list(enumerate(rows)), SCHEMA)).collect(), key=lambda r: r["doc_id"])]


def luhn(s):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(re.sub(r"\D", "", s)))) % 10 == 0


CARDS = ["4111-1111-1111-1111", "4111111111111111", "4111 1111 1111 1111", "3782 822463 10005", "378282246310005", "3056 930902 5904"]
BESIDE = ["{} 123", "1 {}", "2024 {}", "{} 12/27", "{} 2024", "1 2 3 {} 4 5", "{} 415-555-2671", "no. 7 {}, 8", "{}\n12"]


def test_cards_beside_other_numbers(spark):
    cases = [(c, b) for c in CARDS for b in BESIDE] + [("4111-1111-1111-1111", "{}-123"), ("4111-1111-1111-1111", "1-{}")]
    alone = dict(zip(CARDS, texts(spark, CARDS)))
    assert all(luhn(v) and v != c for c, v in alone.items())
    for (card, beside), got in zip(cases, texts(spark, [b.format(c) for c, b in cases])):
        if "415" in beside:
            assert got.startswith(alone[card] + " ") and not got.endswith("415-555-2671")
        else:
            assert got == beside.format(alone[card]), (card, beside, got)
    two = "4111 1111 1111 1111 3782 822463 10005"
    assert texts(spark, [two]) == [f"{alone['4111 1111 1111 1111']} {alone['3782 822463 10005']}"]
    kept = ["1234 5678 9012 3456 78", "2024 2025 2026 2027 1 2 3 4", "x4111111111111111", "1.4111111111111111", "41111111111111112222"]
    assert texts(spark, kept) == kept


FORMS = ["(415) 555-2671", "+1-415-555-2671", "415.555.2671", "+1 415 555 2671", "+14155552671", "1-415-555-2671", "+49 30 901820",
         "+44 20 7946 0958", "+442079460958", "+33 1 42 68 53 00", "+351 21 123 4567", "24.12.2023", "DE89 3704 0044 0532 0130 00", "BE68 5390 0754 7034"]


@pytest.mark.parametrize("around", ["<{}>", "call {}.", "{}", "a {}, 7 b"])
def test_forms(spark, around):
    for form, got in zip(FORMS, texts(spark, [around.format(f) for f in FORMS])):
        shape = re.compile(re.escape(around).replace(r"\{\}", "(" + "".join(r"\d" if c.isdigit() else re.escape(c) for c in form) + ")"))
        assert (m := shape.fullmatch(got)) and m[1] != form, (form, got)
        if form[:2] in ("DE", "BE"):
            v = m[1].replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def test_one_value_has_one_pseudonym_in_all_forms(spark):
    digits = lambda v: re.sub(r"\D", "", v)[-10:]
    assert len({digits(v) for v in texts(spark, FORMS[:6])}) == 1
    assert len({re.sub(r"\D", "", v) for v in texts(spark, ["+44 20 7946 0958", "+442079460958"])}) == 1
    iso, dotted = texts(spark, ["2023-12-24", "24.12.2023"])
    assert dotted.split(".")[::-1] == iso.split("-")
    printed, bare = texts(spark, ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000"])
    assert printed.replace(" ", "") == bare
    beside = texts(spark, ["BE68 5390 0754 7034 2024", "BE68 5390 0754 7034"])
    assert beside[0] == beside[1] + " 2024"


def test_what_only_looks_alike_stays(spark):
    kept = ["32.12.2023", "24.13.2023", "1.24.12.2023", "v415.555.2671", "415.555.2671.5", "+12", "3+4155552", "DE88 3704 0044 0532 0130 00"]
    assert texts(spark, kept) == kept
