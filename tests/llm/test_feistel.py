"""Operator 3: permutations, formats, validity and links."""

import re

import pytest

from thermoflux.llm import feistel

KEY = b"test"


@pytest.mark.parametrize("size", [2, 3, 5, 10, 16, 97, 1000, 4097])
def test_permutation_without_fixed_points(size):
    f = feistel.Feistel(KEY, "t", size)
    made = [f.moved(i) for i in range(size)]
    assert sorted(made) == list(range(size)) and all(a != b for a, b in enumerate(made))
    assert [f.moved(x, -1) for x in made] == list(range(size))
    assert [f.backward(f.forward(i)) for i in range(size)] == list(range(size))


VALUES = {
    "email": ["hein.19@mail5.example.com", "ción.00@mail.example.org", "A.b_C9@x-y.co.uk"], "card": ["4785380592391139", "4111-1111-1111-1111", "4111 1111 1111 1111", "378282246310005"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"], "ssn": ["078-05-1120", "078 05 1120"],
    "phone": ["+1 (743) 555-3824", "+14155550123", "(415) 555-0123", "555-123-4567", "+44 20 7946 0958", "+49 30 12345678", "415 555 0123", "415.555.0123", "+358 9 1234567"],
    "ip": ["152.143.123.131", "8.8.8.8"], "date": ["1984-02-29", "31/12/1999", "12/31/1999", "29.02.2000", "2020/03/05", "3/5/1990", "11/9/1990", "1/31/1990"],
}


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_value(kind, value):
    for around in ("{}", "x {} y", "({}),", "{}###", "{}.", "to {}, and {}!"):
        text = around.format(value, value)
        new, counts = feistel.pseudonymise(text, KEY)
        assert counts[kind] == text.count(value) == sum(counts.values()) and value not in new
        assert feistel.pseudonymise(new, KEY)[1][kind] == counts[kind]  # still valid
        assert feistel.pseudonymise(new, KEY, -1)[0] == text  # the key holder's way back
        shape = lambda s: re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
        assert shape(new) == shape(text) or kind == "ip"
    assert feistel.pseudonymise(value, KEY)[0] != feistel.pseudonymise(value, b"other")[0]


@pytest.mark.parametrize("text", ["1234567812345678", "0000000000000000", "2.0. and 3.4.5.6.7", "999.1.1.1", "v1.2.3.4", "30.02.2001", "1999-13-01", "000-12-3456", "GB00 WEST 1234 5698 7654 32",
                                  "an @ sign", "12 words", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "", "1 2 3 4 5 6 7 8 9", "115 555 0123", "415 155 0123", "12 415 55 0123 4", "3.5.1990"])
def test_other_text_stays(text):
    assert feistel.pseudonymise(text, KEY) == (text, dict.fromkeys(VALUES, 0) | {})


def test_neighbours():
    new, counts = feistel.pseudonymise("4451718024887799 27.65.93.188 4451718024887799\n1984-02-29", KEY)
    assert counts["card"] == 2 and counts["ip"] == counts["date"] == 1
    a, _, b = new.split("\n")[0].split()
    assert a == b  # equal values stay linked


def test_dates_stay_dates_one_to_one():
    made = set()
    for y in range(1996, 2001):
        for m in range(1, 13):
            for d in range(1, 29):
                for form in (f"{y:04d}-{m:02d}-{d:02d}", f"{m:02d}/{d:02d}/{y:04d}" if d > 12 else f"{d:02d}/{m:02d}/{y:04d}"):
                    new, counts = feistel.pseudonymise(form, KEY)
                    assert counts["date"] == 1 and feistel.pseudonymise(new, KEY, -1)[0] == form
                    made.add(new)
    assert len(made) == 5 * 12 * 28 * 2


def test_rows(spark, odd, none):
    got = feistel.pseudonym_counts(odd, "k").collect()
    want = [(r.doc_id, None if r.text is None else feistel.pseudonymise(r.text, b"k")[0]) for r in odd.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)
    whole = feistel.with_pseudonyms(odd, "k")
    assert whole.columns == odd.columns and whole.count() == odd.count()
    assert [r.n_values for r in got if r.doc_id == 14] == [5]
    assert feistel.pseudonym_counts(none, "k").count() == 0


FORMS = [["+14155550123", "+1 (415) 555-0123", "(415) 555-0123", "415-555-0123", "415 555 0123", "415.555.0123", "+1 415 555 0123", "+1-415-555-0123"],
         ["+442079460958", "+44 20 7946 0958"], ["+358 9 1234567", "+35891234567"]]


@pytest.mark.parametrize("forms", FORMS)
def test_every_form_of_a_number_links(forms):
    made = {f: feistel.pseudonymise(f"call {f} now", KEY) for f in forms}
    assert all(c["phone"] == 1 for _, c in made.values())
    national = {feistel.digits_of(t)[-10:] for t, _ in made.values()}
    assert len({n[-9:] for n in national}) == 1 and feistel.digits_of(forms[0])[-9:] not in {n[-9:] for n in national}


@pytest.mark.parametrize("y,m,d", [(2020, 3, 5), (1999, 12, 31), (1984, 2, 29), (2001, 11, 12), (1950, 10, 3), (1977, 4, 11)])
def test_every_form_of_a_day_links(y, m, d):
    forms = {f"{y}-{m:02d}-{d:02d}": "ymd", f"{y}/{m:02d}/{d:02d}": "ymd", f"{d:02d}.{m:02d}.{y}": "dmy", f"{d:02d}/{m:02d}/{y}": "dmy", f"{d}/{m}/{y}": "dmy",
             f"{y}-{m:02d}-{d:02d}T10:00:00Z": "ymd"}
    if d > 12:
        forms |= {f"{m:02d}/{d:02d}/{y}": "mdy", f"{m}/{d}/{y}": "mdy"}
    found = set()
    for form, order in forms.items():
        new, counts = feistel.pseudonymise(f"on {form} it", KEY)
        assert counts["date"] == 1 and feistel.pseudonymise(new, KEY, -1)[0] == f"on {form} it"
        parts = [int(x) for x in re.split("[-./]", new.split()[1].split("T")[0])]
        found.add(tuple(parts[order.index(c)] for c in "ymd"))
    assert len(found) == 1 and (y, m, d) not in found


def test_rows_against_the_plain_permutation(spark):
    """The table's pseudonyms are those of the Feistel network, worked out here by hand."""
    import hashlib

    def network(size, tweak, x):
        key = hashlib.blake2b(b"k", digest_size=32).digest()
        b = 2
        while b * b < size:
            b *= 2
        a = max(2, -(-size // b))

        def f(r, half, n):
            wide = hashlib.blake2b(tweak.encode() + f"|{size}|{r}|{n}|{half}".encode(), key=key, digest_size=16 + n.bit_length() // 8).digest()
            return int.from_bytes(wide, "big") % n

        def once(v, back):
            hi, lo = divmod(v, b)
            for r in (reversed(range(8)) if back else range(8)):
                if r % 2 == 0:
                    hi = (hi + (-1 if back else 1) * f(r, lo, a)) % a
                else:
                    lo = (lo + (-1 if back else 1) * f(r, hi, b)) % b
            return hi * b + lo

        def walk(v, back):
            v = once(v, back)
            while v >= size:
                v = once(v, back)
            return v

        return walk((walk(x, False) + 1) % size, True)

    x = network(1 << 32, "ip", 10 << 24 | 1 << 16 | 2 << 8 | 3)
    body = network(10 ** 9, "card4111119", 111111111)
    docs = spark.createDataFrame([(1, "10.1.2.3 and 4111 1111 1111 1111")], "doc_id long, text string")
    text = feistel.pseudonym_counts(docs, "k").first().text
    assert text.split(" and ")[0] == ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
    assert feistel.digits_of(text.split(" and ")[1])[:-1] == f"411111{body:09d}"
