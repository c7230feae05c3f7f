"""Pseudonyms as permutations: no two values share one, each can be taken back, each is found again as what it was."""

import datetime
import random
import time

import pytest

from lakewright.llm import pii

SWAP, BACK = pii.Pseudonymizer(b"key"), pii.Pseudonymizer(b"key", inverse=True)

FORMS = {
    "iso": lambda d: f"{d.year:04d}-{d.month:02d}-{d.day:02d}",
    "short iso": lambda d: f"{d.year:04d}/{d.month}/{d.day}",
    "day first": lambda d: f"{d.day:02d}.{d.month:02d}.{d.year:04d}",
    "short day first": lambda d: f"{d.day}/{d.month}/{d.year:04d}",
    "half short": lambda d: f"{d.day:02d}-{d.month}-{d.year:04d}",
    "month first": lambda d: f"{d.month:02d}/{d.day:02d}/{d.year:04d}",
    "short month first": lambda d: f"{d.month}/{d.day}/{d.year:04d}",
}


def test_dates_of_200_years_in_every_form_are_permuted():
    first, last = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
    days = [datetime.date.fromordinal(o) for o in range(first, last + 1, 7)]
    by_separator = {}
    for form in FORMS.values():
        for text in map(form, days):
            by_separator.setdefault(next(c for c in text if not c.isdigit()), set()).add(text)
    for texts in by_separator.values():
        swapped = {t: SWAP(t)[0] for t in texts}
        assert len(set(swapped.values())) == len(texts)
        assert all([len(x) for x in new.replace(".", "/").replace("-", "/").split("/")] == [len(x) for x in t.replace(".", "/").replace("-", "/").split("/")] for t, new in swapped.items())
        assert all(BACK(new)[0] == t for t, new in swapped.items())


@pytest.mark.parametrize("text", ["12/25/2020", "1/2/2020", "2020-02-29", "29.02.2000", "0099-12-31", "0001-01-01", "9999-12-31", "31/1/1899", "1/31/2100"])
def test_single_dates_come_back(text):
    new, kinds = SWAP(text)
    assert kinds == {"date": 1} and BACK(new)[0] == text


def test_a_day_is_linked_across_separators_and_orders():
    assert SWAP("2020-05-06")[0].split("-") == SWAP("06.05.2020")[0].split(".")[::-1] == SWAP("06/05/2020")[0].split("/")[::-1]


@pytest.mark.parametrize("text", ["30/02/2020", "2020-13-01", "32.01.2020", "13/32/2020", "0000-01-01", "2021-02-29"])
def test_what_is_no_date_stays(text):
    assert SWAP(text) == (text, {})


def digits(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def valid(kind, rng):
    if kind == "card":
        body = digits(rng, rng.choice([12, 13, 14, 15, 18]))
        return None if not body.strip("0") else body + pii.luhn_digit(body)
    if kind == "ssn":
        return f"{digits(rng, 3)}-{digits(rng, 2)}-{digits(rng, 4)}"
    if kind == "phone":
        return rng.choice(["+1 ({}) {}-{}", "({}) {}-{}", "1-{}-{}-{}", "{} {} {}", "+1{}{}{}"]).format(digits(rng, 3), digits(rng, 3), digits(rng, 4))
    if kind == "phone abroad":
        return f"+{rng.choice(['44', '49', '1', '7', '351'])} {digits(rng, 3)} {digits(rng, 4)}" + rng.choice(["", " " + digits(rng, 3)])
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "iban":
        body = "".join(rng.choice("ABCDEFGHIJ0123456789") for _ in range(rng.choice([12, 16, 18])))
        return "DE" + pii._iban_check("DE", body) + body
    if kind == "email":
        return f"{rng.choice('abcXYZ019')}{digits(rng, 2)}.x{rng.choice('pqr')}@ma{rng.choice('abc')}l.example.com"
    return rng.choice(["token = {}", "password: {}", "api_key={}"]).format("".join(rng.choice("abcdef0123" if rng.random() < 0.5 else "aZf9_") for _ in range(rng.choice([8, 9, 20]))))


@pytest.mark.parametrize("kind", ["card", "ssn", "phone", "phone abroad", "ip", "iban", "email", "secret"])
def test_values_come_back_and_never_meet(kind):
    rng = random.Random(kind)
    texts = {t for _ in range(3_000) if (t := valid(kind, rng))}
    swapped = {t: SWAP(t) for t in texts}
    found = {t: new for t, (new, kinds) in swapped.items() if kinds}
    assert len(found) > 50 and all(sum(swapped[t][1].values()) == 1 for t in found)
    assert len(set(found.values())) == len(found)
    assert all(BACK(new) == (t, swapped[t][1]) for t, new in found.items())
    assert sum(t != new for t, new in found.items()) > 0.99 * len(found)


def test_small_sets_are_permuted_whole():
    """Nine unlike digits in a local number of few free digits: every value once."""
    texts = [f"+99 {i:03d} {j:03d}" for i in range(0, 1000, 37) for j in range(0, 1000, 7)]
    assert len({SWAP(t)[0] for t in texts}) == len(texts)
    hexes = [f"token = {i:08x}" for i in range(0, 1 << 32, (1 << 32) // 2_003)]
    new = [SWAP(t)[0] for t in hexes]
    assert len(set(new)) == len(hexes) and all(BACK(n)[0] == t for t, n in zip(hexes, new))


def test_a_key_is_needed(docs_of):
    with pytest.raises(TypeError):
        pii.Pseudonymizer()
    with pytest.raises(ValueError):
        pii.pseudonymize(docs_of(["x"]), b"")
    assert pii.Pseudonymizer(b"one")("2020-05-06") != pii.Pseudonymizer(b"two")("2020-05-06")


def test_many_values_cost_linear_time():
    def seconds(n):
        text = " ".join(f"u{i}@example.com 10.{i % 250}.{i // 250 % 250}.7" for i in range(n))
        began = time.perf_counter()
        _, kinds = SWAP(text)
        assert kinds == {"email": n, "ip": n}
        return time.perf_counter() - began

    seconds(100)
    assert seconds(20_000) < 40 * seconds(1_000)  # 20 times the values


def test_pseudonyms_of_odd_tables(docs_of):
    texts = ["", None, "mail a.b@example.com", "x " * 200_000 + "10.1.2.3", "mail a.b@example.com", "no value"]
    docs = docs_of(texts, [1, None, 2, 3, 2, None])
    rows = pii.pseudonymize(docs, b"key").collect()
    assert len(rows) == 6 and [r.text is None for r in rows] == [t is None for t in texts]
    assert rows[2].text == rows[4].text != texts[2] and rows[5].text == "no value" and len(rows[3].text) > 400_000
    assert pii.pseudonymize(docs_of([]), b"key").count() == 0
