"""Format-preserving pseudonyms for personal data.

What looks like personal data is validated (check digits, calendar, octets), read as a number within
its format, and sent through a keyed Feistel permutation of exactly that range: a card number becomes
another valid card number, a date another date of its century, letters stay letters and digits
digits. The same value has the same pseudonym in every document, so links between documents stay;
whoever has the key can go back. Rows are independent: there is no table of values and no shuffle.

The key is a parameter without a default: whoever knows it can go back. :func:`session_key` takes it from the session's
settings. Equal values have equal pseudonyms in every document; a date in two notations is two values.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
import secrets
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

ROUNDS = 8
#: Characters of a long value that are permuted together.
BLOCK = 48
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
HEX = DIGITS + "abcdef"

#: The session's setting with the key, as text.
KEY_SETTING = "spark.rankloom.pseudonym.key"
_drawn: dict[str, bytes] = {}

_PATTERN = re.compile(
    r"""
    (?P<email>[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,})
  | (?P<lead>(?i:\b(?:api[_-]?key|access[_-]?key|secret|token|password|passwd|auth)\b)\s*[=:]\s*["']?)
        (?P<secret>[A-Za-z0-9_\-+/]{8,})
  | (?<![\w.])(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?![\w]|\.\d)
  | \b(?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)\b
  | (?<![\w.+\-])(?P<date>\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{2}-\d{2}-\d{4})(?![\w\-])
  | (?<![\w.+\-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w\-])
  | (?<![\w.+\-])(?P<card>\d(?:[ \-]?\d){12,18})(?!\w|-(?!\d)|\.\d)
  | (?P<phone>(?<![\w+])\+\d{1,3}(?:[ .\-]?\(?\d{1,4}\)?){2,5}(?![\w]) | (?<![\w.+\-])(?:\(\d{3}\)[ ]?|\d{3}[\-.])\d{3}[\-.]\d{4}(?![\w\-]))
    """,
    re.VERBOSE,
)
#: Something that every kind has.
_HINT = re.compile(r"[0-9@]|[=:]")

Permute = Callable[[int, int, bytes], int]


class Feistel:
    """Keyed permutation of 0 to size - 1 for any size."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.inverse = hashlib.blake2b(key, digest_size=32).digest(), inverse

    def _mix(self, round_: int, half: int, most: int, tweak: bytes) -> int:
        message = b"%d|%d|%d|" % (round_, most, half) + tweak
        return int.from_bytes(hashlib.blake2b(message, key=self.key, digest_size=64).digest(), "big") % most

    def __call__(self, value: int, size: int, tweak: bytes) -> int:
        if size < 2:
            return value
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(value, b)
            for step in range(ROUNDS):
                k = ROUNDS - 1 - step if self.inverse else step
                sign = -1 if self.inverse else 1
                if k % 2:
                    right = (right + sign * self._mix(k, left, b, tweak)) % b
                else:
                    left = (left + sign * self._mix(k, right, a, tweak)) % a
            value = left * b + right
            if value < size:  # the square is a little larger than the range: walk on
                return value


def _alphabet(char: str, letters: str) -> str:
    if char in DIGITS and letters != HEX:
        return DIGITS
    if letters == HEX:
        return HEX if char in HEX else HEX.upper()
    return LOWER if char in LOWER else LOWER.upper()


def _characters(text: str, permute: Permute, tweak: bytes, letters: str = LOWER) -> str:
    """ASCII digits and letters permuted within their kind, all else in its place."""
    places = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    out, before = list(text), b""
    for at in range(0, len(places), BLOCK):
        block = places[at : at + BLOCK]
        alphabets = [_alphabet(text[i], letters) for i in block]
        number = 0
        for i, alphabet in zip(block, alphabets):
            number = number * len(alphabet) + alphabet.index(text[i])
        # The tweak binds the format and the blocks before, as one that goes back can read them.
        plain = "".join(text[i] for i in block).encode()
        shape = "".join("d" if a == DIGITS else "x" if a.lower().startswith("0") else "a" for a in alphabets).encode()
        number = permute(number, math.prod(map(len, alphabets)), tweak + b"|%d|" % at + shape + b"|" + before)
        for i, alphabet in zip(reversed(block), reversed(alphabets)):
            number, digit = divmod(number, len(alphabet))
            out[i] = alphabet[digit]
        coded = "".join(out[i] for i in block).encode()
        before = plain if getattr(permute, "inverse", False) else coded
    return "".join(out)


def _luhn(digits: str) -> int:
    """Check digit behind ``digits``."""
    total = 0
    for i, char in enumerate(reversed(digits)):
        double = int(char) * (2 - i % 2)
        total += double - 9 * (double > 9)
    return -total % 10


def _filled(shape: str, digits: str) -> str:
    """The digits of a string replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in shape)


def _card(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    if len(set(digits)) < 2 or _luhn(digits[:-1]) != int(digits[-1]):
        return None
    body = digits[:-1]
    coded = str(permute(int(body), 10 ** len(body), b"card%d" % len(body))).zfill(len(body))
    return _filled(text, coded + str(_luhn(coded)))


def _ssn(text: str, permute: Permute) -> str | None:
    area, group, serial = map(int, text.split("-"))
    areas = [n for n in range(1, 900) if n != 666]
    if area not in areas or not group or not serial:
        return None
    number = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(permute(number, len(areas) * 99 * 9999, b"ssn"), 9999)
    return f"{areas[rest // 99]:03d}-{rest % 99 + 1:02d}-{serial + 1:04d}"


def _ip(text: str, permute: Permute) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 for p in parts):
        return None
    number = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, b"ip")
    return ".".join(map(str, number.to_bytes(4, "big")))


def _remainder(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(text: str, permute: Permute) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _remainder(plain) != 1:
        return None
    body = _characters(plain[4:], permute, b"iban" + plain[:2].encode())
    coded = f"{plain[:2]}{98 - _remainder(plain[:2] + '00' + body):02d}{body}"
    left = iter(coded)
    return "".join(c if c == " " else next(left) for c in text)


_DATE_ORDERS = ("ymd", "dmy", "mdy")


def _date(text: str, permute: Permute) -> str | None:
    parts = re.split(r"\D", text)
    for order in _DATE_ORDERS:
        named = dict(zip(order, parts))
        if len(named["y"]) != 4:
            continue
        try:
            day = datetime.date(int(named["y"]), int(named["m"]), int(named["d"]))
        except ValueError:
            continue
        first = max(day.year // 100 * 100, 1)
        start = datetime.date(first, 1, 1).toordinal()
        size = datetime.date(day.year // 100 * 100 + 99, 12, 31).toordinal() - start + 1
        # A day of 12 or less can be read both ways; only those that stay so are in its range.
        days = [start + i for i in range(size)] if order == "ymd" else _readable(start, size, order)
        coded = datetime.date.fromordinal(days[permute(_place(days, day.toordinal()), len(days), b"date%d" % first + order.encode())])
        fields = {"y": f"{coded.year:04d}", "m": f"{coded.month:02d}", "d": f"{coded.day:02d}"}
        left = iter(fields[o] for o in order)
        return re.sub(r"\d+", lambda _: next(left), text)
    return None


_readable_days: dict[tuple[int, str], list[int]] = {}


def _readable(start: int, size: int, order: str) -> list[int]:
    """Days of a century that are read in this order: month first only where day first fails."""
    if (start, order) not in _readable_days:
        days = map(datetime.date.fromordinal, range(start, start + size))
        _readable_days[start, order] = [d.toordinal() for d in days if order == "dmy" or d.day > 12]
    return _readable_days[start, order]


def _place(days: list[int], day: int) -> int:
    return bisect_left(days, day)


def _phone(text: str, permute: Permute) -> str | None:
    country = re.match(r"\+\d{1,3}(?=[ .\-(])|\+\d", text)
    head = country.group() if country else ""
    digits = re.sub(r"\D", "", text[len(head) :])
    if not 6 <= len(digits) <= 14:
        return None
    coded = permute(int(digits), 10 ** len(digits), b"phone" + head.encode() + b"%d" % len(digits))
    return head + _filled(text[len(head) :], str(coded).zfill(len(digits)))


def _email(text: str, permute: Permute) -> str:
    """The name and the domain are permuted apart, so that one domain stays one; the last label stays."""
    name, domain = text.rsplit("@", 1)
    host, _, top = domain.rpartition(".")
    return f"{_characters(name, permute, b'name')}@{_characters(host, permute, b'host')}.{top}"


def _secret(text: str, permute: Permute) -> str | None:
    if not any(c.isdigit() for c in text):
        return None
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text)
    if hexadecimal and text == text.upper() and text != text.lower():
        return _characters(text.lower(), permute, b"secret", HEX).upper()
    return _characters(text, permute, b"secret", HEX if hexadecimal else LOWER)


_KINDS = {"email": _email, "secret": _secret, "ip": _ip, "iban": _iban, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}
KINDS = tuple(_KINDS)


#: Digits of the parts of a card as cards are written, and as one part.
CARDS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), *((n,) for n in range(13, 20))}
#: Characters of an IBAN by country.
IBANS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_RUN = re.compile(r"\d+(?:[ \-]\d+)*")
_TOKEN = re.compile(r"\W*\w+")
_ENDED = re.compile(r"(?!\w|-(?!\d)|\.\d)")
#: A span is no longer than this.
_REACH = 80

Span = tuple[str, int, int]


def _cards(text: str, start: int, end: int, stop: int) -> Iterator[tuple[int, int]]:
    """Where a card can stand in what looks like one, with short numbers before or behind it: first as
    cards are written, then from the start on, longer ones first."""
    run = _RUN.match(text, start, min(end + _REACH, stop)).group()
    parts = [(start + m.start(), start + m.end()) for m in re.finditer(r"\d+", run)]
    for i, (first, _) in enumerate(parts):
        if first >= end:
            break
        for n in (1, 3, 4):
            behind = parts[i : i + n]
            if len(behind) == n and tuple(b - a for a, b in behind) in CARDS and _ENDED.match(text, behind[-1][1]):
                yield first, behind[-1][1]
    for last in sorted({last for _, last in parts if last <= end} | {end}, reverse=True):
        if sum(map(str.isdigit, text[start:last])) >= 13:
            yield start, last


def _ibans(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Ends of an IBAN in what looks like one: by its country, then longer ones first."""
    ends = [m.end() for m in re.finditer(r"\w+", text[start:end])]
    wanted = IBANS.get(text[start : start + 2])
    for last in sorted(ends, key=lambda n: (len(text[start : start + n].replace(" ", "")) != wanted, -n)):
        yield start, start + last


_CHECKED: dict[str, Callable[[str], bool]] = {
    "card": lambda value: _card(value, _same) is not None,
    "iban": lambda value: _iban(value, _same) is not None,
}


def _same(value: int, size: int, tweak: bytes) -> int:
    return value


def _spans(text: str) -> tuple[list[Span], list[Span]]:
    """Valid values in order, and what was tried as a card or an IBAN and is none."""
    found: list[Span] = []
    failed: dict[Span, None] = {}

    def scan(at: int, stop: int) -> None:
        while match := _PATTERN.search(text, at, stop):
            kind = match.lastgroup
            start, end = match.span(kind)
            token = _TOKEN.match(text, start).end()
            if kind not in _CHECKED:
                if _KINDS[kind](match.group(kind), _same) is not None:
                    found.append((kind, start, end))
                    at = end
                else:
                    at = token if kind == "phone" else end  # a card can stand behind a plus
                continue
            for first, last in _cards(text, start, end, stop) if kind == "card" else _ibans(text, start, end):
                if _CHECKED[kind](text[first:last]):
                    if first > start:
                        scan(token, first)
                    found.append((kind, first, last))
                    at = last
                    break
                failed[kind, first, last] = None
            else:
                at = token

    scan(0, len(text))
    return found, sorted(failed, key=lambda span: span[1:])


def pseudonymized(text: str, permute: Permute, found: Counter | None = None) -> str:
    """The text with every valid value replaced; ``found`` counts the kinds."""
    if not _HINT.search(text):
        return text
    spans, failed = _spans(text)
    if found is not None:
        found.update(kind for kind, _, _ in spans)
    starts = [start for _, start, _ in failed]
    now, coded = list(text), [""] * len(spans)
    # What was no value must be none in the new text either, or the way back would take it for one: a
    # value is permuted again until that holds. The way back takes the values in the opposite order.
    order = range(len(spans))
    for i in reversed(order) if getattr(permute, "inverse", False) else order:
        kind, start, end = spans[i]
        near = [f for f in failed[bisect_left(starts, start - _REACH) : bisect_left(starts, end)] if f[2] > start]
        value = text[start:end]
        while True:
            again = _KINDS[kind](value, permute)
            value = value if again is None else again
            if again is None or len(value) != end - start:
                break
            now[start:end] = value
            if not any(_CHECKED[other]("".join(now[a:b])) for other, a, b in near):
                break
        coded[i] = value
    out, at = [], 0
    for (_, start, end), value in zip(spans, coded):
        out += [text[at:start], value]
        at = end
    return "".join([*out, text[at:]])


def session_key(spark: SparkSession) -> bytes:
    """The key in ``spark.rankloom.pseudonym.key``; where it is unset, a random one, the same for the whole application.

    With a random key values stay linked within the application, nobody can go back, and another run
    gives other pseudonyms.
    """
    key = spark.conf.get(KEY_SETTING, None)
    if key:
        return key.encode()
    return _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def pseudonymize(docs: DataFrame, key: bytes, inverse: bool = False) -> DataFrame:
    """``docs (doc_id, text, ...)`` with personal data in ``text`` replaced; all columns and rows stay.

    A null text stays null and an empty one empty; what fails validation (a card number with a wrong
    check digit, a date that is none) stays as it is; valid cards and IBANs are found beside short numbers
    and words that could be parts of them. Repeated rows get equal results, long texts go through whole, and an
    empty table stays empty. ``inverse`` goes back with the same key.
    """
    return _replaced(docs, key, inverse, False)


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """``(doc_id, text, n_email, n_secret, ...)``: the new texts, and how many of each kind were replaced.

    A row for every row of ``docs``, see :func:`pseudonymize`; other columns are ignored.
    """
    return _replaced(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), key, False, True)


def _replaced(docs: DataFrame, key: bytes, inverse: bool, counted: bool) -> DataFrame:
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index("text")
    schema = StructType([StructField(f.name, f.dataType, True) for f in plain.schema])
    for kind in KINDS if counted else ():
        schema = schema.add(f"n_{kind}", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Feistel(key, inverse)
        for batch in batches:
            texts, counts = [], []
            for value in batch.column(at):
                found: Counter = Counter()
                text = value.as_py()
                texts.append(text if text is None else pseudonymized(text, permute, found))
                counts.append(found)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            more = [pa.array([c[kind] for c in counts], pa.int64()) for kind in KINDS] if counted else []
            yield pa.RecordBatch.from_arrays([*columns, *more], schema.names)

    return plain.mapInArrow(work, schema).toDF(*names, *schema.names[len(names) :])
