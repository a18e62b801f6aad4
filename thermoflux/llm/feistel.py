"""Format-preserving pseudonyms for personal numbers and dates (operator 3).

Found values are validated (Luhn, mod 97, calendar, octet and block ranges) and replaced by a
keyed permutation of their own format: the value is a number in a domain of known size, an
alternating Feistel network over two halves permutes the least such pair of halves that holds
the domain, and cycle-walking brings the result back into it.  Check digits are recomputed, so
a pseudonym is valid again.  Equal values of a kind get equal pseudonyms in every document;
different ones stay different; the key holder can invert.  So that no value maps to itself, the
permutation E is used as ``E^-1(E(x) + 1 mod size)``.

Kinds: e-mail (letters and digits of the local part, each within its class), payment card
(all digits but the first six and the check digit, Luhn), IBAN (the digits after the check
digits, mod 97), US social security number, telephone number (the national number; all printed
forms of one number link, one without a country code counts as of code 1), IPv4 address, date
(year first, day first with dots, day or month first with slashes, 1900-2099; all printed forms
of one day link).  Known forms only: IPv6 addresses, for one, stay.

Defined cases: a null text stays null and an empty one empty; repeated rows give repeated rows;
an empty table gives no rows; extra columns are kept; a value in a domain of one element stays.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutation of range(size) for one kind of value."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size, self.key, self.tweak = size, hashlib.blake2b(key, digest_size=32).digest(), tweak.encode()[:64]
        root = 1
        while root * root < size:
            root <<= 1
        # root is a power of two: halves a * root + b with a below the least number that suffices
        self.b = max(2, root)
        self.a = max(2, -(-size // self.b))

    def _round(self, r: int, half: int, size: int) -> int:
        data = self.tweak + b"|%d|%d|%d|%d" % (self.size, r, size, half)
        wide = hashlib.blake2b(data, key=self.key, digest_size=16 + size.bit_length() // 8).digest()
        return int.from_bytes(wide, "big") % size

    def _once(self, x: int, back: bool) -> int:
        a, b = divmod(x, self.b)
        for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            if r % 2:
                step = self._round(r, a, self.b)
                b = (b - step if back else b + step) % self.b
            else:
                step = self._round(r, b, self.a)
                a = (a - step if back else a + step) % self.a
        return a * self.b + b

    def forward(self, x: int) -> int:
        x = self._once(x, False)
        while x >= self.size:
            x = self._once(x, False)
        return x

    def backward(self, x: int) -> int:
        x = self._once(x, True)
        while x >= self.size:
            x = self._once(x, True)
        return x

    def moved(self, x: int, step: int = 1) -> int:
        """A permutation without fixed points (size 2 or more); step -1 inverts it."""
        return self.backward((self.forward(x) + step) % self.size)


@lru_cache(maxsize=4096)
def permutation(key: bytes, tweak: str, size: int) -> Feistel:
    return Feistel(key, tweak, size)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def put_digits(shape: str, digits: str) -> str:
    """``shape`` with its ASCII digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in shape)


def digits_of(value: str) -> str:
    return "".join(c for c in value if c in "0123456789")


def move_number(digits: str, key: bytes, tweak: str, step: int) -> str:
    n = len(digits)
    return f"{permutation(key, f'{tweak}{n}', 10 ** n).moved(int(digits), step):0{n}d}"


def card(m: re.Match, key: bytes, step: int) -> str | None:
    d = digits_of(m[0])
    if not 13 <= len(d) <= 19 or not luhn(d) or len(set(d)) == 1:
        return None
    body = d[:6] + move_number(d[6:-1], key, "card" + d[:6], step)
    return put_digits(m[0], body + next(c for c in "0123456789" if luhn(body + c)))


def iban(m: re.Match, key: bytes, step: int) -> str | None:
    flat = m[0].replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(flat) <= 34 or number(flat[4:] + flat[:4]) % 97 != 1:
        return None
    body = put_digits(flat[4:], move_number(digits_of(flat[4:]), key, "iban" + flat[:2] + re.sub(r"\d", "0", flat[4:]), step)) if digits_of(flat[4:]) else flat[4:]
    check = 98 - number(body + flat[:2] + "00") % 97
    made = iter(f"{flat[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(made) for c in m[0])


def ssn(m: re.Match, key: bytes, step: int) -> str | None:
    def valid(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    d = digits_of(m[0])
    if not valid(d):
        return None
    # 898 areas (000, 666 and 9xx left out), 99 groups, 9,999 serials: a dense domain
    area = int(d[:3]) - 1 - (int(d[:3]) > 666)
    x = permutation(key, "ssn", 898 * 99 * 9999).moved((area * 99 + int(d[3:5]) - 1) * 9999 + int(d[5:]) - 1, step)
    rest, serial = divmod(x, 9999)
    area, group = divmod(rest, 99)
    return put_digits(m[0], f"{area + 1 + (area >= 665):03d}{group + 1:02d}{serial + 1:04d}")


#: Country calling codes of two digits; 1 and 7 have one, all others three.
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
                            "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def country_code(digits: str) -> str:
    return digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


def ten_digit_number(d: str) -> bool:
    """Whether area and exchange are ones that the plan of country code 1 gives out."""
    return len(d) == 10 and d[0] > "1" and d[3] > "1"


def phone(m: re.Match, key: bytes, step: int) -> str | None:
    """The national number is permuted as a whole under its country code (1 if none is given),
    whatever stands between its digits, so all printed forms of a number stay linked."""
    d = digits_of(m[0])
    code = country_code(d) if m[0][0] == "+" else ""
    own = d[len(code):]
    if not 7 <= len(d) <= 15 or len(own) < 4 or (m["plain"] and not ten_digit_number(own)):
        return None
    new = own
    while True:  # a number that can be told without a mark stays one
        new = move_number(new, key, "phone" + (code or "1"), step)
        if ten_digit_number(new) == ten_digit_number(own):
            return put_digits(m[0], code + new)


def ip(m: re.Match, key: bytes, step: int) -> str | None:
    octets = m[0].split(".")
    if any(int(o) > 255 or o != str(int(o)) for o in octets):
        return None
    x = 0
    for o in octets:
        x = x << 8 | int(o)
    x = permutation(key, "ip", 1 << 32).moved(x, step)
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def day_class(t: datetime.date) -> tuple[bool, bool, bool]:
    """What a printed form shows of a date besides its digits: whether the day can be read as
    a month, and whether day and month have two digits.  Kept, so every form fits again."""
    return t.day > 12, t.day > 9, t.month > 9


def date(m: re.Match, key: bytes, step: int) -> str | None:
    """The calendar day is permuted, within its ``day_class``; how it is written stays."""
    parts = re.split(r"[-./]", m[0])
    a, b, c = (int(x) for x in parts)
    year_first = len(parts[0]) == 4
    orders = [(a, b, c)] if year_first else [(c, b, a)] + [(c, a, b)] * ("/" in m[0])  # day first; month first if only that is a date
    for k, order in enumerate(orders):
        try:
            old = datetime.date(*order)
        except ValueError:
            continue
        if not FIRST_DAY <= old.toordinal() <= LAST_DAY:
            return None
        many, new = permutation(key, "date", LAST_DAY - FIRST_DAY + 1), old
        while True:
            new = datetime.date.fromordinal(FIRST_DAY + many.moved(new.toordinal() - FIRST_DAY, step))
            if day_class(new) == day_class(old):
                break
        made = [new.year, new.month, new.day] if year_first else [new.day, new.month, new.year] if k == 0 else [new.month, new.day, new.year]
        sign = m[0][len(parts[0])]
        return sign.join(f"{v:0{len(p)}d}" for v, p in zip(made, parts, strict=True))
    return None


def email(m: re.Match, key: bytes, step: int) -> str | None:
    local, host = m["local"], m["host"]
    part, rest = local, "@" + host
    x, size = 0, 1
    for c in part:
        n = 10 if "0" <= c <= "9" else 26 if "a" <= c.lower() <= "z" and c.isascii() else 1
        x, size = x * n + (int(c) if n == 10 else ord(c.lower()) - 97 if n == 26 else 0), size * n
    if size < 2:
        return None
    shape = re.sub(r"[0-9]", "0", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", part)))
    x = permutation(key, "mail" + hashlib.blake2b((shape + rest.lower()).encode(), digest_size=8).hexdigest(), size).moved(x, step)
    out = []
    for c in reversed(part):
        n = 10 if "0" <= c <= "9" else 26 if "a" <= c.lower() <= "z" and c.isascii() else 1
        x, d = divmod(x, n)
        out.append(str(d) if n == 10 else chr((97 if c.islower() else 65) + d) if n == 26 else c)
    return "".join(reversed(out)) + rest


#: Kinds in the order in which they are tried at a place.
KINDS: list[tuple[str, str, Callable[[re.Match, bytes, int], str | None]]] = [
    ("email", r"(?P<local>[^\W_](?:[\w.+%-]{0,62}[\w+%-])?)@(?P<host>(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.)+[A-Za-z][A-Za-z0-9-]{1,30})", email),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("card", r"(?<![\d.+-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d-])", card),
    ("phone", r"(?<![\w.+])(?:(?P<code>\+\d{1,3}[ .-]?)(?P<rest>\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{7,13}|\d{1,4}(?:[ .-]\d{2,8}){1,4})|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4}|(?P<plain>\d{3}(?P<space>[ .])\d{3}(?P=space)\d{4}))(?!\.?\w|-)", phone),
    ("ssn", r"(?<![\w-])(?:\d{3}-\d{2}-\d{4}|(?<!\d )\d{3} \d{2} \d{4}(?! \d))(?![\w-])", ssn),
    ("ip", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)", ip),
    ("date", r"(?<![\w./-])(?:\d{4}(?P<sign>[-/])\d{2}(?P=sign)\d{2}|\d{2}\.\d{2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?=T\d\d|(?![\w/-]))", date),
]
PATTERNS = [(name, re.compile(pattern, 0 if name == "email" else re.ASCII), make) for name, pattern, make in KINDS]
#: Most texts hold neither, and are done after one pass.
MAYBE = re.compile(r"[@0-9]")


def pseudonymise(text: str, key: bytes, step: int = 1) -> tuple[str, dict[str, int]]:
    """The text with each validated value replaced, and how many of each kind.  No value
    spans a line feed, so only lines with a digit or an at sign are looked at closely."""
    counts = dict.fromkeys((name for name, _, _ in PATTERNS), 0)
    if not MAYBE.search(text):
        return text, counts
    lines = text.split("\n")
    for k, line in enumerate(lines):
        if MAYBE.search(line):
            lines[k] = replaced(line, key, step, counts)
    return "\n".join(lines), counts


def replaced(line: str, key: bytes, step: int, counts: dict[str, int]) -> str:
    # Each kind's results are out of the later kinds' sight.
    segments: list[tuple[str, bool]] = [(line, False)]
    for name, pattern, make in PATTERNS:
        after: list[tuple[str, bool]] = []
        for segment, done in segments:
            if done or not ("@" in segment if name == "email" else MAYBE.search(segment)):
                after.append((segment, done))
                continue
            at = 0
            for m in pattern.finditer(segment):
                new = make(m, key, step)
                if new is not None:
                    after += [(segment[at:m.start()], False), (new, True)]
                    at, counts[name] = m.end(), counts[name] + 1
            after.append((segment[at:], False))
        segments = after
    return "".join(s for s, _ in segments)


def pseudonyms(text: Column, key: str, step: int = 1) -> Column:
    """Struct of the replaced text and the counts by kind."""
    secret, names = key.encode(), [name for name, _, _ in PATTERNS]

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [(None, *[0] * len(names)) if t is None else (lambda new, n: (new, *n.values()))(*pseudonymise(t, secret, step)) for t in texts]
        return pd.DataFrame(rows, columns=["text", *names])

    fields = ", ".join(["text string", *(f"{n} bigint" for n in names)])
    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, fields)(text.cast("string"))


def with_pseudonyms(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with its text replaced; other columns stay as they are; map-only."""
    return docs.withColumn(text, pseudonyms(docs[text], key)["text"])


def pseudonym_counts(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_values, one count for each kind) for each row of ``docs``."""
    names = [name for name, _, _ in PATTERNS]
    made = docs.select("doc_id", pseudonyms(docs["text"], key).alias("p"))
    total = sum((F.col("p")[n] for n in names[1:]), F.col("p")[names[0]])
    return made.select("doc_id", F.col("p")["text"].alias("text"), total.alias("n_values"), *[F.col("p")[n].alias(f"n_{n}") for n in names])
