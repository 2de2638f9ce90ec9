import re

from hypothesis import given, settings
from hypothesis import strategies as st

from linemend.llm.pii import DEMO_KEY, Feistel, Pseudonyms, iban_rest, luhn_ok, pii_spans, pseudonymise

P, BACK = Pseudonyms(), Pseudonyms(back=True)
VALUES = {
    "email": "anna.b+x42@mail.example.com", "iban": "DE89 3704 0044 0532 0130 00", "date": "1987-03-09", "ip": "70.214.118.188", "ssn": "123-45-6789", "card": "4111 1111 1111 1111",
    "phone": "+1 (555) 010-9999", "secret": "04dbebab91ab85687d33eeaaf9ac699e1188f962",
}


def test_permutation_of_any_size():
    for size in (1, 2, 3, 10, 97, 366, 1000):
        f = Feistel(DEMO_KEY, size, b"t")
        out = [f.apply(x) for x in range(size)]
        assert sorted(out) == list(range(size)) and [f.apply(y, back=True) for y in out] == list(range(size))


@settings(max_examples=50, deadline=None)
@given(st.integers(2, 10**40), st.data())
def test_inverse(size, data):
    x = data.draw(st.integers(0, size - 1))
    f = Feistel(b"k" * 16, size, b"t")
    assert f.apply(f.apply(x), back=True) == x


def test_each_kind_keeps_its_format_and_can_be_undone():
    for kind, v in VALUES.items():
        new, spans = P.text(f"See {v}, please.")
        assert [s[0] for s in spans] == [kind] and v not in new
        value = new[4:-9]
        assert re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", v))) == re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", value))) or kind in ("ip", "secret")
        assert BACK.text(new)[0] == f"See {v}, please."
    assert luhn_ok(re.sub(r"\D", "", P.text(VALUES["card"])[0])) and iban_rest(P.text(VALUES["iban"])[0].replace(" ", "")) == 1


def test_linked_across_notations():
    a, b = P.text("4111111111111111")[0], P.text("4111-1111-1111-1111")[0]
    assert a == b.replace("-", "")
    d = [P.text(x)[0] for x in ("1987-03-09", "09.03.1987", "03/09/1987")]
    y, m, day = d[0].split("-")
    assert d[1] == f"{day}.{m}.{y}" and d[2] == f"{m}/{day}/{y}"


def test_invalid_values_stay():
    for x in ("4111111111111112", "9111111111111116", "0000000000000018", "1987-13-09", "30.02.2000", "256.1.1.1", "000-12-3456", "DE00 3704 0044 0532 0130 00", "version 2.0.1", "12345", "1.2.3.4.5", "a@b", "0000 0000 0000 0000", "x" * 40, "1" * 40):
        assert P.text(x) == (x, []), x


def test_value_inside_a_longer_invalid_one():
    new, spans = P.text("9999 999 +1 (555) 010-9999 4111111111111111")
    assert [s[0] for s in spans] == ["phone", "card"]


def test_operator(spark):
    text = f"a {VALUES['card']} b {VALUES['ip']} c {VALUES['card']}"
    rows = [(1, text, "k"), (2, None, "k"), (3, "", "k"), (4, "nothing here 12", "k"), (None, VALUES["email"], "k"), (1, text, "k"), (6, "w " * 50_000 + VALUES["ssn"], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kinds string")
    out = sorted(((r.doc_id, r.text, r.n_values, [tuple(v) for v in r["values"]]) for r in pii_spans(df).collect()), key=str)
    want = sorted(((i, P.text(t)[0], len(P.text(t)[1]), P.text(t)[1]) for i, t, _ in rows), key=str)
    assert out == want
    kept = pseudonymise(df)
    assert kept.schema == df.schema and sorted((r.text or "" for r in kept.collect())) == sorted(P.text(t)[0] or "" for _, t, _ in rows)
    assert pii_spans(df.limit(0)).count() == 0


def digits(x):
    return re.sub(r"\D", "", P.text(x)[0])


def test_phones_and_mail_linked_across_notations():
    assert digits("+4915112345678") == digits("+49 151 12345678") == digits("+49-151-1234-5678") != "4915112345678"
    us = [digits(x) for x in ("+1 (555) 010-9999", "1 (555) 010-9999", "(555) 010-9999", "555-010-9999", "555.010.9999")]
    assert {x[-10:] for x in us} == {us[0][1:]} and us[0][0] == us[1][0] == "1"
    a, b = P.text("John.Doe@x.com")[0], P.text("john.doe@x.com")[0]
    assert a.lower() == b and a[0].isupper() and a.split(".")[1][0].isupper() and b != "john.doe@x.com"
    for x in ("6011000990139424", "2223003122003222", "3782 822463 10005", "+4915112345678", "1 (555) 010-9999", "555-010-9999", "John.Doe@x.com", "+442071838750", "+1 555 010 9999"):
        assert BACK.text(P.text(x)[0])[0] == x


def test_versions_are_no_addresses():
    for x in ("version 1.2.3.4 build", "v1.2.3.4", "Release: 10.0.0.1"):
        assert P.text(x) == (x, [])
    assert P.text("host 10.0.0.1")[1]
