"""Operator 9: personal data, replaced by format-preserving Feistel pseudonyms.

Values are found by pattern and validated (Luhn, mod 97, octets, calendar, digit
counts).  A valid value is written as a number in the finite domain of its kind
and permuted there by a keyed Feistel network with cycle walking; the result is
written back in the same format: same separators, letter case and length, check
digits made valid again.  A permutation keeps equal values equal and different values
different, in all documents and in every notation of a kind: a date, a card or IBAN with
and without separators, hex digits and mail addresses in either case, a phone number
with any separators and, for country code 1, with or without it.  The key's holder can
undo it.

Kinds: card (13-19 digits, an issuer's prefix, which stays, and Luhn), iban (mod 97), ssn, phone (international or
bracketed forms, 10-15 digits), ip (four octets), email (local part; the domain
stays), date (ISO, day.month.year, month/day/year; 1900-2099), secret (keys with a
known prefix, and runs of 32, 40 or 64 hex digits).

Results: a null text stays null and an empty one empty; a text without valid
values is returned unchanged; a pseudonym may equal its value only where the
permutation has a fixed point.  Extra columns are kept by ``pseudonymise``.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import lean, small_batches, table

#: For tests and the driver's query; production passes a secret key of its own.
DEMO_KEY = b"linemend demonstration key, replace me"
ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
ROWS_OUT, VALUE_CACHE = 512, 100_000

# One alternative for each kind; earlier ones win where two could start.
PATTERN = re.compile(
    r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))
  | (?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))
  | (?P<date>(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w/-]|\.\d))
  | (?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))
  | (?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|(?:\d{1,3}[ .-])?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w))
  | (?P<secret>(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk[-_](?:live_|test_|proj-)?[A-Za-z0-9]{16,}|xox[abpr]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})(?![A-Za-z0-9_]))
    """,
    re.VERBOSE | re.ASCII,
)
#: No kind matches without one of these.
HINT = re.compile(r"[0-9@_]|sk-|xox|AKIA|ASIA|[a-f]{32}")
# Country calling codes of one and two digits; all others have three.
CALLING = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
# Issuer prefixes of card numbers (of 16 digits if not said otherwise).
ISSUERS = (
    (r"4", (13, 16, 19)), (r"5[1-5]|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720", (16,)), (r"3[47]", (15,)), (r"30[0-5]|36|38", (14,)),
    (r"35", (16,)), (r"6011|64[4-9]|65|62", (16, 17, 18, 19)),
)
ISSUERS = tuple((re.compile(pattern), lengths) for pattern, lengths in ISSUERS)
#: Words before four numbers that make them a version and no address.
VERSION = re.compile(r"(?:\bv|\b(?:version|ver|release|build|firmware|section|chapter|clause)s?)[.:]?\s*\Z", re.IGNORECASE)
#: Prefixes of secrets, which stay.
PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|sk[-_](?:live_|test_|proj-)?|xox[abpr]-|AIza")


class Feistel:
    """A keyed permutation of 0 .. size-1 for any size: an unbalanced two-part
    network over the next larger a * b, walked on until it lands inside."""

    def __init__(self, key: bytes, size: int, tweak: bytes):
        self.size, self._key = size, hmac.new(key, tweak, hashlib.sha256).digest()
        self.a = max(1, int(size**0.5) if size < 1 << 100 else 1 << (size.bit_length() // 2))
        self.b = -(-size // self.a)

    def _mask(self, i: int, x: int, below: int) -> int:
        digest = hashlib.blake2b(b"%d:%d" % (i, x), key=self._key, digest_size=32).digest()
        return int.from_bytes(digest, "big") % below

    def apply(self, x: int, back: bool = False) -> int:
        if not 0 <= x < self.size:
            raise ValueError("outside the domain")
        sign = -1 if back else 1
        while True:
            left, right = divmod(x, self.b)
            for i in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                if i % 2:
                    right = (right + sign * self._mask(i, left, self.b)) % self.b
                else:
                    left = (left + sign * self._mask(i, right, self.a)) % self.a
            x = left * self.b + right
            if x < self.size:
                return x


def luhn_digit(body: str) -> str:
    total = 0
    for i, ch in enumerate(reversed(body)):
        d = int(ch) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def luhn_ok(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def iban_rest(text: str) -> int:
    """Mod 97 of an IBAN without separators, country and check digits last."""
    return int("".join(str(int(ch, 36)) for ch in text[4:] + text[:4])) % 97


def refill(like: str, digits: str) -> str:
    """Digits put into the places of the digits of ``like``."""
    source = iter(digits)
    return "".join(next(source) if ch.isdigit() else ch for ch in like)


class Pseudonyms:
    """Finds, validates and permutes.  ``back`` undoes."""

    def __init__(self, key: bytes = DEMO_KEY, back: bool = False):
        self._key, self._back = key, back
        self._networks: dict[tuple[int, bytes], Feistel] = {}
        self._known: dict[tuple[str, str], str | None] = {}
        self._kinds: dict[str, Callable[[str], str | None]] = {k: getattr(self, f"_{k}") for k in PATTERN.groupindex}

    def _permute(self, x: int, size: int, tweak: str) -> int:
        at = (size, tweak.encode())
        if at not in self._networks:
            if len(self._networks) > 4096:
                self._networks.clear()
            self._networks[at] = Feistel(self._key, *at)
        return self._networks[at].apply(x, self._back)

    def _digits(self, digits: str, tweak: str) -> str:
        return str(self._permute(int(digits), 10 ** len(digits), tweak)).zfill(len(digits))

    def _letters(self, text: str, tweak: str) -> str:
        """Each character stays in its class: digit, lower case, upper case, other."""
        classes = [("0123456789", 10) if c.isdigit() else ("abcdefghijklmnopqrstuvwxyz", 26) if c.islower() else ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26) if c.isupper() else (c, 1) for c in text]
        size, x = 1, 0
        for (alphabet, n), ch in zip(classes, text, strict=True):
            size, x = size * n, x * n + alphabet.index(ch)
        shape = "".join("9" if n == 10 else a[0] if n == 26 else a for a, n in classes)
        x, out = self._permute(x, size, f"{tweak}:{shape}"), []
        for alphabet, n in reversed(classes):
            x, k = divmod(x, n)
            out.append(alphabet[k])
        return "".join(reversed(out))

    def _card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not luhn_ok(digits) or len(set(digits)) == 1:
            return None
        head = next((m.group() for issuer, lengths in ISSUERS if len(digits) in lengths and (m := issuer.match(digits))), None)
        if head is None:
            return None
        body = head + self._digits(digits[len(head) : -1], "card" + head)
        return refill(text, body + luhn_digit(body))

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_rest(plain) != 1:
            return None
        body = self._letters(plain[4:], "iban" + plain[:2])
        check = 98 - iban_rest(plain[:2] + "00" + body)
        source = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(ch if ch == " " else next(source) for ch in text)

    def _ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = 898  # 1-899 without 666
        x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        x, serial = divmod(self._permute(x, areas * 99 * 9999, "ssn"), 9999)
        area, group = divmod(x, 99)
        area += 1
        return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _phone(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if text[0] != "+" and len(digits) == 10:  # as written within the countries of code 1
            digits = "1" + digits
        code = m.group() if (m := CALLING.match(digits)) else ""
        rest = digits[len(code) :]
        if not 10 <= len(digits) <= 15 or len(rest) < 6:
            return None
        new = self._digits(rest, "phone" + code)
        return refill(text, (code + new)[-sum(c.isdigit() for c in text) :])

    def _ip(self, text: str) -> str | None:
        octets = text.split(".")
        if any(int(x) > 255 or len(x) > 1 and x[0] == "0" for x in octets):
            return None
        x = self._permute(int.from_bytes(bytes(map(int, octets)), "big"), 1 << 32, "ip")
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _email(self, text: str) -> str | None:
        local, _, domain = text.partition("@")
        new = self._letters(local.lower(), "email")
        return "".join(n.upper() if c.isupper() else n for n, c in zip(new, local, strict=True)) + "@" + domain

    def _date(self, text: str) -> str | None:
        parts = re.split(r"([-./])", text)
        order = {"-": (0, 2, 4), ".": (4, 2, 0), "/": (4, 0, 2)}[parts[1]]  # year, month, day
        try:
            day = datetime.date(*(int(parts[i]) for i in order))
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        first, size = FIRST_DAY.toordinal(), LAST_DAY.toordinal() - FIRST_DAY.toordinal() + 1
        day = datetime.date.fromordinal(first + self._permute(day.toordinal() - first, size, "date"))
        padded = any(len(parts[i]) == 2 and parts[i][0] == "0" for i in order[1:]) or all(len(parts[i]) == 2 for i in order[1:])
        for i, value in zip(order, (day.year, day.month, day.day), strict=True):
            parts[i] = f"{value:04d}" if i == order[0] else f"{value:02d}" if padded else str(value)
        return "".join(parts)

    def _secret(self, text: str) -> str | None:
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
            if text.isdigit() or text.isalpha():
                return None
            new = f"{self._permute(int(text, 16), 16 ** len(text), 'hex'):0{len(text)}x}"
            return new if text == text.lower() else new.upper()
        head = PREFIX.match(text).group()
        return head + self._letters(text[len(head) :], "secret" + head)

    def value(self, kind: str, text: str) -> str | None:
        """The pseudonym of a value, None if it isn't valid."""
        at = (kind, text)
        if at not in self._known:
            if len(self._known) >= VALUE_CACHE:
                self._known.clear()
            self._known[at] = self._kinds[kind](text)
        return self._known[at]

    def text(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of each value in the original."""
        if not text or not HINT.search(text):
            return text, []
        out, spans, done, at = [], [], 0, 0
        while (m := PATTERN.search(text, at)) is not None:
            kind = m.lastgroup
            new = None if kind == "ip" and VERSION.search(text, max(0, m.start() - 16), m.start()) else self.value(kind, m.group())
            if new is None:
                # not valid: what starts later inside it may be
                at = m.start() + 1
                while at < len(text) and text[at - 1].isalnum() and text[at].isalnum():
                    at += 1
                continue
            out += [text[done : m.start()], new]
            spans.append((kind, m.start(), m.end()))
            done = at = m.end()
        if not spans:
            return text, []
        return "".join([*out, text[done:]]), spans


def pseudonymise(docs: DataFrame, key: bytes = DEMO_KEY, text_col: str = "text") -> DataFrame:
    """The same rows and columns with personal data replaced in ``text_col``."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        names = Pseudonyms(key)
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(k, ROWS_OUT)
                texts = pa.array([names.text(t.as_py())[0] for t in batch.column(at)], batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(replaced, docs.schema)


def pii_spans(docs: DataFrame, key: bytes = DEMO_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text (pseudonymised), n_values, values (kind, start and end
    in the original, in code points)."""
    small_batches(docs.sparkSession)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        names = Pseudonyms(key)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(k, ROWS_OUT)
                rows = [names.text(t.as_py()) for t in batch.column(1)]
                spans = [[{"kind": a, "start": b, "end": c} for a, b, c in s] for _, s in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([t for t, _ in rows], pa.string()), pa.array([len(s) for _, s in rows], pa.int64()), pa.array(spans, kind)],
                    names=["doc_id", "text", "n_values", "values"],
                )

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(found, "doc_id bigint, text string, n_values bigint, values array<struct<kind: string, start: int, end: int>>")


def op9_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(table(spark, sf_dir, "documents"))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.col("values.kind"))), ",")
    return found.select("doc_id", "text", "n_values", kinds.alias("kinds"))
