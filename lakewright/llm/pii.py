"""PII: format-preserving Feistel pseudonyms.

Validated values are permuted under a key inside the set of valid values of their format: a card number
stays a number that passes Luhn's test, a date stays a date written the same way. The permutation depends
on the kind and the value, not on document, place or separators, so equal values stay linked everywhere, no
two values share a pseudonym, and who holds the key can take every pseudonym back.
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import math
import re
import string
from array import array
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices

ROUNDS = 10
KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date", "secret")


class Feistel:
    """Keyed permutation of range(size): alternating modular Feistel rounds, walked until inside the range."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size, self.a = size, math.isqrt(size - 1) + 1
        self.b = -(-size // self.a)
        self.bytes = max(8, (size.bit_length() + 7) // 8 + 4)
        self.key = hashlib.blake2b(tweak.encode(), key=key[:64], digest_size=32).digest()

    def _f(self, i: int, half: int) -> int:
        data = bytes([i]) + half.to_bytes(half.bit_length() // 8 + 1, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=min(64, self.bytes)).digest(), "big")

    def __call__(self, x: int) -> int:
        if self.size < 2:
            return x
        while True:
            left, right = divmod(x, self.b)
            for i in range(0, ROUNDS, 2):
                left = (left + self._f(i, right)) % self.a
                right = (right + self._f(i + 1, left)) % self.b
            if (x := left * self.b + right) < self.size:
                return x

    def inverse(self, x: int) -> int:
        if self.size < 2:
            return x
        while True:
            left, right = divmod(x, self.b)
            for i in range(ROUNDS - 2, -1, -2):
                right = (right - self._f(i + 1, left)) % self.b
                left = (left - self._f(i, right)) % self.a
            if (x := left * self.b + right) < self.size:
                return x


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        x = int(c) * (2 - i % 2)
        total += x - 9 * (x > 9)
    return str(-total % 10)


def _classes(text: str) -> list[str]:
    """The alphabet that each character of text stays in; '' for characters that stay."""
    sets = (string.ascii_lowercase, string.ascii_uppercase, string.digits)
    return [next((s for s in sets if c in s), "") for c in text]


class Pseudonymizer:
    """Finds the values of a text and puts their pseudonyms in their places."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] = KINDS, inverse: bool = False):
        if not key:
            raise ValueError("pseudonyms need a secret key")
        self.key, self.inverse = key, inverse
        self.finders = [f for f in FINDERS if f[0] in kinds]
        self._permutation = functools.lru_cache(4096)(lambda tweak, size: Feistel(key, tweak, size))

    def permute(self, tweak: str, x: int, size: int) -> int:
        f = self._permutation(tweak, size)
        return f.inverse(x) if self.inverse else f(x)

    def mixed(self, tweak: str, text: str, alphabets: list[str], fits: Callable[[str], bool] = lambda new: True) -> str:
        """text with each character permuted, all together, inside its alphabet; on and on until the new text fits, as the old does."""
        size, x = 1, 0
        for c, a in zip(text, alphabets, strict=True):
            if a:
                size, x = size * len(a), x * len(a) + a.index(c)
        while True:
            left, out = self.permute(f"{tweak}:{size}", x, size), []
            x = left
            for c, a in zip(reversed(text), reversed(alphabets), strict=True):
                if a:
                    left, r = divmod(left, len(a))
                    c = a[r]
                out.append(c)
            if fits(new := "".join(reversed(out))):
                return new

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of the values, in order; where two overlap, the kind named first holds."""
        found: list[tuple[int, int, str, str]] = []
        taken = bytearray()
        digits, lower = _DIGIT.search(text), text.lower()
        for kind, need, pattern, replace in self.finders:
            if kind != "email" and kind != "secret" and not digits or need is not None and need not in text:
                continue
            if kind == "secret" and not (digits and "AKIA" in text or any(k in lower for k in _SECRET_WORDS)):
                continue
            for m in pattern.finditer(text):
                if taken and any(taken[m.start() : m.end()]):
                    continue
                if (new := replace(self, m)) is not None:
                    found.append((m.start(), m.end(), kind, new))
                    taken = taken or bytearray(len(text))
                    taken[m.start() : m.end()] = b"\1" * (m.end() - m.start())
        return sorted(found)

    def __call__(self, text: str) -> tuple[str, Counter]:
        out, at, kinds = [], 0, Counter()
        for start, end, kind, new in self.spans(text):
            out += [text[at:start], new]
            at = end
            kinds[kind] += 1
        return "".join([*out, text[at:]]), kinds


def _refill(shape: str, characters: str) -> str:
    """shape with its letters and digits replaced, in order."""
    it = iter(characters)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _email(p: Pseudonymizer, m: re.Match) -> str:
    whole = m.group()
    body, _, tld = whole.rpartition(".")
    return p.mixed("email", body, _classes(body)) + "." + tld


def _card(p: Pseudonymizer, m: re.Match) -> str | None:
    digits = re.sub("[^0-9]", "", m.group())
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    # The first digit names the network: it stays.
    body = digits[0] + p.mixed("card" + digits[0], digits[1:-1], [string.digits] * (len(digits) - 2), lambda new: (digits[0] + new).strip("0") != "")
    return _refill(m.group(), body + luhn_digit(body))


def _ssn_index(area: int, group: int, serial: int) -> int:
    rank = area - 1 - (area > 666)
    return (rank * 99 + group - 1) * 9999 + serial - 1


def _ssn(p: Pseudonymizer, m: re.Match) -> str | None:
    area, group, serial = map(int, m.groups())
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    rest, serial = divmod(p.permute("ssn", _ssn_index(area, group, serial), 898 * 99 * 9999), 9999)
    rank, group = divmod(rest, 99)
    area = rank + 1 + (rank >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _national(digits: str) -> bool:
    """Ten digits of the North American plan, with or without its 1."""
    return len(digits) in (10, 11) and digits[:-10] in ("", "1") and digits[-10] not in "01" and digits[-7] not in "01"


def _phone(p: Pseudonymizer, m: re.Match) -> str | None:
    digits = re.sub("[^0-9]", "", m.group())
    plus = m.group().startswith("+")
    if (not plus or digits[0] == "1") and _national(digits):
        high = string.digits[2:]
        new = p.mixed("nanp", digits[-10:], [high, *[string.digits] * 2, high, *[string.digits] * 6])
        return _refill(m.group(), digits[:-10] + new)
    if not plus or not 8 <= len(digits) <= 15:
        return None
    # Other numbers after a plus keep two digits, and none becomes one of that plan.
    abroad = lambda new: digits[0] != "1" or not _national(digits[:2] + new)
    return _refill(m.group(), digits[:2] + p.mixed("phone" + digits[:2], digits[2:], [string.digits] * (len(digits) - 2), abroad))


def _ip(p: Pseudonymizer, m: re.Match) -> str | None:
    parts = m.group().split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts) or parts[0] == "0":
        return None
    a, b, c, d = map(int, parts)
    x = p.permute("ip", ((a - 1) << 24) | b << 16 | c << 8 | d, 255 << 24)
    return f"{(x >> 24) + 1}.{x >> 16 & 255}.{x >> 8 & 255}.{x & 255}"


def _iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country) + '00') % 97:02d}"


def _iban(p: Pseudonymizer, m: re.Match) -> str | None:
    flat = m.group().replace(" ", "")
    country, check, body = flat[:2], flat[2:4], flat[4:]
    if not 11 <= len(body) <= 30 or _iban_check(country, body) != check:
        return None
    new = p.mixed("iban" + country, body, _classes(body))
    return _refill(m.group(), country + _iban_check(country, new) + new)


@functools.lru_cache(64)
def _days(low: int, month_width: int, day_width: int, late: bool) -> array:
    """Ordinals of the days of 200 years that can be written so: one digit holds 1 to 9; late: days above the twelfth."""
    high = min(9999, low + 199) if low > 1 else 99
    first, last = datetime.date(low, 1, 1).toordinal(), datetime.date(high, 12, 31).toordinal()
    each = map(datetime.date.fromordinal, range(first, last + 1))
    return array("i", [d.toordinal() for d in each if (month_width == 2 or d.month < 10) and (day_width == 2 or d.day < 10) and (not late or d.day > 12)])


def _date(p: Pseudonymizer, m: re.Match) -> str | None:
    """Year, month and day, or day, month and year; month, day and year where the middle can be no month.

    A date is permuted among the days of the same 200 years that its form can say: as many digits for the month and
    the day, and for m/d/y, days above the twelfth. So it is read as the same form again. The forms of y-m-d and
    d/m/y share a permutation: a day is linked across them.
    """
    sep = m["s1"] or m["s2"]
    parts = m.group().split(sep)
    for y, mo, d in [(0, 1, 2)] if m["s1"] else [(2, 1, 0), (2, 0, 1)]:
        try:
            day = datetime.date(int(parts[y]), int(parts[mo]), int(parts[d]))
        except ValueError:
            continue
        late = (y, mo) == (2, 0)
        low = max(1, (day.year - 100) // 200 * 200 + 100)
        form = (low, len(parts[mo]), len(parts[d]), late)
        days = _days(*form)
        new = datetime.date.fromordinal(days[p.permute("date" + "-".join(map(str, form)), bisect.bisect_left(days, day.toordinal()), len(days))])
        values = {y: new.year, mo: new.month, d: new.day}
        return sep.join(str(values[i]).zfill(len(parts[i])) for i in range(3))
    return None


def _secret(p: Pseudonymizer, m: re.Match) -> str | None:
    value = m["aws"] or m["value"]
    if m["aws"]:
        new = "AKIA" + p.mixed("aws", value[4:], [string.ascii_uppercase + string.digits] * (len(value) - 4))
    elif re.fullmatch("[0-9a-f]+", value):
        new = p.mixed("hex", value, [string.digits + "abcdef"] * len(value))
    else:
        new = p.mixed("secret", value, _classes(value), lambda new: re.fullmatch("[0-9a-f]+", new) is None)
    at = m.start("aws") if m["aws"] else m.start("value")
    return m.group()[: at - m.start()] + new + m.group()[at - m.start() + len(value) :]


_DIGIT = re.compile("[0-9]")
_SECRET_WORDS = ("passw", "passphrase", "pwd", "secret", "token", "api_key", "api-key", "apikey")

#: kind, a text that any match holds, pattern, pseudonym (None: not valid, left alone). Earlier kinds hold.
FINDERS: list[tuple[str, str | None, re.Pattern, Callable[[Pseudonymizer, re.Match], str | None]]] = [
    ("email", "@", re.compile(r"(?<![\w.%+-])[A-Za-z0-9_%+-][\w.%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-])", re.ASCII), _email),
    ("secret", None, re.compile(r"""(?<![0-9A-Za-z])(?:(?P<aws>AKIA[0-9A-Z]{16})|(?i:passw(?:or)?d|passphrase|pwd|secret|(?:access_?|auth_?)?token|api[_-]?key)\s{0,3}[=:]\s{0,3}["']?(?P<value>[0-9A-Za-z_+/-]{8,}))(?![0-9A-Za-z])"""), _secret),
    ("iban", None, re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"), _iban),
    ("card", None, re.compile(r"(?<![\w.+-])(?:[0-9]{13,19}|[0-9]{4}(?P<s>[ -])[0-9]{4}(?P=s)[0-9]{4}(?P=s)[0-9]{1,7}|[0-9]{4}(?P<t>[ -])[0-9]{6}(?P=t)[0-9]{5})(?![\w-])"), _card),
    ("ssn", "-", re.compile(r"(?<![\w-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![\w-])"), _ssn),
    ("phone", None, re.compile(r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|(?:1[ .-])?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|(?:1[ .-])?[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4})(?![\w-])"), _phone),
    ("ip", ".", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])"), _ip),
    ("date", None, re.compile(r"(?<![\w./-])(?:[0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2}(?=T[0-9]|(?!\w|[./-][0-9]))|[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4}(?!\w|[./-][0-9]))"), _date),
]


def pseudonymize(docs: DataFrame, key: bytes, kinds: tuple[str, ...] = KINDS, text: str = "text") -> DataFrame:
    """docs with the pseudonyms in the text column; other columns, rows and their order within files stay.

    Null texts stay null; empty texts and texts without values stay as they are, byte for byte. Very long texts are
    read whole. Repeated rows and rows without a doc_id each keep their row. No rows: none. Map-only: nothing is
    shuffled. The key is the caller's secret; without it there are no pseudonyms (ValueError).
    """

    def run(batches):
        swap = Pseudonymizer(key, kinds)
        for part in (p for batch in batches for p in slices(batch)):
            column = part.schema.get_field_index(text)
            new = [None if t is None else swap(t)[0] for t in part.column(column).to_pylist()]
            yield part.set_column(column, part.schema.field(column), pa.array(new, part.schema.field(column).type))

    Pseudonymizer(key, kinds)
    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame, key: bytes, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """doc_id, n_values, kinds (as card:2,ip:1; sorted), text (pseudonymised) of every whole document.

    Null texts give null text, 0 and ''. Repeated rows and null doc_ids keep their rows.
    """
    state: dict = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        swap = state.setdefault("swap", Pseudonymizer(key, kinds))
        out = [(None, Counter()) if t is None else swap(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "n_values": pa.array([sum(c.values()) for _, c in out], pa.int64()),
                "kinds": pa.array([",".join(f"{k}:{c[k]}" for k in sorted(c)) for _, c in out], pa.string()),
                "text": pa.array([t for t, _ in out], pa.string()),
            }
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(source, run, "doc_id long, n_values long, kinds string, text string")
