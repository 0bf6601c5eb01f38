"""PII: format-preserving Feistel pseudonyms.

Validated values (payment cards, telephone numbers, IP addresses, account and social security
numbers, calendar dates, e-mail addresses) are numbered within their format. A keyed Feistel
network permutes the numbers, walking on where it leaves the domain, and the result is written
back in the place and format of the value. The mapping has an inverse for holders of the key,
and equal values become equal pseudonyms in every document.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradeledger.llm.common import map_texts

ROUNDS = 8
KINDS = ("card", "phone", "ip", "iban", "ssn", "date", "email")
#: Values with a remembered pseudonym per task; beyond it the memory starts anew.
MEMORY = 100_000


class Feistel:
    """Keyed permutations of 0 .. size - 1, one for each tweak."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int) -> int:
        data = tweak + bytes([i]) + half.to_bytes(40, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=40).digest(), "big")

    def _network(self, value: int, bits: int, tweak: bytes, back: bool) -> int:
        right_bits = bits // 2
        left_bits = bits - right_bits
        left, right = value >> right_bits, value & ((1 << right_bits) - 1)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if i % 2 == 0:
                left ^= self._round(tweak, i, right) & ((1 << left_bits) - 1)
            else:
                right ^= self._round(tweak, i, left) & ((1 << right_bits) - 1)
        return left << right_bits | right

    def permute(self, value: int, size: int, tweak: bytes, back: bool = False) -> int:
        """Place of ``value`` in the permutation; cycle walking keeps it below ``size``."""
        if size < 2:
            return value
        bits = max((size - 1).bit_length(), 2)
        value = self._network(value, bits, tweak, back)
        while value >= size:
            value = self._network(value, bits, tweak, back)
        return value


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def refill(text: str, digits: str) -> str:
    """``text`` with its ASCII digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in text)


def luhn(digits: str) -> int:
    """Check digit that makes ``digits`` plus it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def card(value: str, net: Feistel, back: bool) -> str | None:
    d = digits_of(value)
    if not 13 <= len(d) <= 19 or d[0] == "0" or luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    n = len(d) - 2  # first digit (the network) and check digit aside
    body = str(net.permute(int(d[1:-1]), 10**n, b"card%d" % len(d), back)).zfill(n)
    head = d[0] + body
    return refill(value, head + str(luhn(head)))


def unassigned(digits: str) -> bool:
    """Area or exchange that the North American plan does not give out."""
    return digits[0] in "01" or digits[3] in "01"


def phone(value: str, net: Feistel, back: bool) -> str | None:
    d = digits_of(value)
    if value.startswith("+") and not d.startswith("1"):
        if not 8 <= len(d) <= 15 or d[0] == "0":
            return None
        rest = d[3:]  # two digits of country and the first of the area stay
        return refill(value, d[:3] + str(net.permute(int(rest), 10 ** len(rest), b"tel" + d[:3].encode(), back)).zfill(len(rest)))
    own = d[1:] if len(d) == 11 and d[0] == "1" else d
    if len(own) != 10:
        return None
    if unassigned(own):  # a number all the same, where the country code says so
        if not value.startswith("+"):
            return None
        at = net.permute(int(own), 10**10, b"tel1", back)
        while not unassigned(f"{at:010d}"):
            at = net.permute(at, 10**10, b"tel1", back)
        return refill(value, f"1{at:010d}")
    at = (int(own[:3]) - 200) * 8_000_000 + (int(own[3:6]) - 200) * 10_000 + int(own[6:])
    at = net.permute(at, 800 * 8_000_000, b"nanp", back)
    made = f"{at // 8_000_000 + 200}{at // 10_000 % 800 + 200}{at % 10_000:04d}"
    return refill(value, d[: len(d) - 10] + made)


def national(value: str, net: Feistel, back: bool) -> str | None:
    """A trunk zero, an area and a number: 9 to 12 digits in groups."""
    d = digits_of(value)
    if not 9 <= len(d) <= 12:
        return None
    rest = d[2:]  # the zero and the first digit of the area stay
    return refill(value, d[:2] + str(net.permute(int(rest), 10 ** len(rest), b"trunk" + d[:2].encode(), back)).zfill(len(rest)))


def ip6(value: str, net: Feistel, back: bool) -> str | None:
    """Hexadecimal digits are permuted in place; groups keep their lengths and ``::`` its place."""
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return None
    if not any(c.isdigit() for c in value):
        return None  # two words
    digits = value.replace(":", "")
    at = int(digits, 16)
    while True:
        at = net.permute(at, 16 ** len(digits), b"ipv6%d" % len(digits), back)
        made = f"{at:0{len(digits)}x}"
        if any(c.isdigit() for c in made):
            break
    left = iter(made.upper() if value != value.lower() else made)
    return "".join(c if c == ":" else next(left) for c in value)


def ip(value: str, net: Feistel, back: bool) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    at = net.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, b"ipv4", back)
    return ".".join(map(str, at.to_bytes(4, "big")))


def iban_check(country: str, body: str) -> int:
    """Check number of an account number, remainder 98 - n mod 97."""
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def iban(value: str, net: Feistel, back: bool) -> str | None:
    plain = value.replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or not check.isdigit() or iban_check(country, body) != int(check):
        return None
    n = digits_of(body)
    if not n:
        return None
    made = refill(body, str(net.permute(int(n), 10 ** len(n), b"iban" + country.encode(), back)).zfill(len(n)))
    plain = iter(f"{country}{iban_check(country, made):02d}{made}")
    return "".join(c if c == " " else next(plain) for c in value)


def ssn(value: str, net: Feistel, back: bool) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
        return None
    place = area - 1 - (area > 666)  # 898 areas, 99 groups, 9999 serials
    at = net.permute((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, b"ssn", back)
    place, group, serial = at // 9999 // 99, at // 9999 % 99 + 1, at % 9999 + 1
    return f"{place + 1 + (place >= 665):03d}-{group:02d}-{serial:04d}"


def calendar_day(year: int, month: int, day: int, net: Feistel, back: bool) -> datetime.date | None:
    """The permuted day, within the same century, so that it reads like a date of its time."""
    try:
        at = datetime.date(year, month, day).toordinal()
    except ValueError:
        return None
    if year < 1000:
        return None
    first = datetime.date(year // 100 * 100, 1, 1).toordinal()
    end = datetime.date(year // 100 * 100 + 99, 12, 31).toordinal()
    return datetime.date.fromordinal(first + net.permute(at - first, end - first + 1, b"date%d" % (year // 100), back))


def date(value: str, net: Feistel, back: bool) -> str | None:
    """Year first, or day (or month) last: 2024-05-01, 01.05.2024, 5/1/2024."""
    mark = next(c for c in value if not c.isdigit())
    parts = value.split(mark)
    if len(parts) != 3:
        return None
    a, b, c = map(int, parts)
    if len(parts[0]) == 4:
        order = "ymd"
    elif mark == "/" and a <= 12:  # month first, unless it can't be
        order = "mdy"
    else:
        order = "dmy"
    at = dict(zip(order, (a, b, c)))
    day = calendar_day(at["y"], at["m"], at["d"], net, back)
    if day is None:
        return None
    # the pseudonym must be read back in the same order; two digits are the plain format
    if order == "dmy" and mark == "/" and day.day <= 12:
        return slash_dmy(at, net, back)
    made = {"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}
    return mark.join(made[x] for x in order)


def short_date(value: str, net: Feistel, back: bool) -> str | None:
    """A year of two digits is one from 2000 on."""
    head, year = value[:-2], value[-2:]
    made = date(f"{head}20{year}", net, back)
    return made and made[:-4] + made[-2:]


#: Names of the months by language. A name of several languages belongs to the first.
MONTHS = {
    "en": ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"),
    "fr": ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"),
    "de": ("januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"),
    "es": ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
    "short": ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"),
}
MONTH_OF: dict[str, tuple[str, int]] = {}
for _language, _names in MONTHS.items():
    for _i, _name in enumerate(_names):
        MONTH_OF.setdefault(_name, (_language, _i + 1))
A_MONTH = "|".join(sorted(MONTH_OF, key=len, reverse=True))
NAMED_DATE = re.compile(r"([0-9]{1,2}|[^\W\d_]+)(\W+(?:de )?)([0-9]{1,2}|[^\W\d_]+)(\W+(?:de )?)([0-9]{4})")


def named_date(value: str, net: Feistel, back: bool) -> str | None:
    """A month by its name, day or month first: 1 May 2024, May 1, 2024, 1. Mai 2024, 1 de mayo de 2024."""
    first, gap, second, other, year = NAMED_DATE.fullmatch(value).groups()
    word, number = (second, first) if first.isdigit() else (first, second)
    language, month = MONTH_OF[word.lower()]
    day = calendar_day(int(year), month, int(number), net, back)
    while day is not None and MONTH_OF[MONTHS[language][day.month - 1]][0] != language:
        day = calendar_day(day.year, day.month, day.day, net, back)  # a name that would be read in another language
    if day is None:
        return None
    name = MONTHS[language][day.month - 1]
    name = name.upper() if word.isupper() and len(word) > 1 else name.capitalize() if word[0].isupper() else name
    made = (str(day.day), name) if first.isdigit() else (name, str(day.day))
    return f"{made[0]}{gap}{made[1]}{other}{day.year:04d}"


def slash_dmy(at: dict[str, int], net: Feistel, back: bool) -> str | None:
    """dd/mm/yyyy with a day over 12: walk on to the next such day of the permutation."""
    day = calendar_day(at["y"], at["m"], at["d"], net, back)
    while day.day <= 12:
        day = calendar_day(day.year, day.month, day.day, net, back)
    return f"{day.day:02d}/{day.month:02d}/{day.year:04d}"


def email(value: str, net: Feistel, back: bool) -> str | None:
    """Letters and digits of everything but the top-level domain, each kept in its class."""
    local, _, domain = value.rpartition("@")
    name, _, top = domain.rpartition(".")
    if ".." in value or local[-1] == "." or not name:
        return None
    head = f"{local}@{name}"
    classes = [letters_like(c) for c in head]
    at, size = 0, 1
    for c, own in zip(head, classes):
        at = at * len(own) + own.index(c)
        size *= len(own)
    shape = "".join(own[0] for own in classes)
    at = net.permute(at, size, b"mail" + hashlib.blake2b(shape.encode(), digest_size=16).digest(), back)
    made: list[str] = []
    for own in reversed(classes):
        at, d = divmod(at, len(own))
        made.append(own[d])
    return "".join(reversed(made)) + "." + top


@lru_cache(maxsize=4096)
def letters_like(c: str) -> str:
    """What may stand for a character of a name: digits for a digit, letters of its case and neighbourhood for a letter."""
    if "0" <= c <= "9":
        return "0123456789"
    if not c.isalpha():
        return c
    block = ord(c) // 128 * 128
    return "".join(x for x in map(chr, range(block, block + 128)) if x.isalpha() and x.isupper() == c.isupper() and x.islower() == c.islower())


#: What a date looks like, for the other end of an interval without spaces.
DATE_SHAPE = r"(?:[12][0-9]{3}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][12][0-9]{3})(?![0-9])"
#: One pattern per format. Bounded repeats keep the search linear in the text.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", r"(?:(?<![\w.%+\u0300-\u036f-])|(?<=\.\.)(?!\.))(?:[\w%+\u0300-\u036f-]|\.(?!\.)){1,64}@(?:[^\W_](?:[^\W_]|-){0,62}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("date", r"(?:(?<![0-9./-])|(?<=[0-9][/-]))(?:[12][0-9]{3}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[12][0-9]{3})(?:(?![0-9]|[./-][0-9])|(?=[/-]" + DATE_SHAPE + "))"),
    ("short_date", r"(?<![0-9./-])[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}(?![0-9]|[./-][0-9])"),
    ("named_date", rf"(?i:(?<!\w)(?:[0-9]{{1,2}}\.? (?:de )?(?:{A_MONTH})\.?(?: de)? |(?:{A_MONTH})\.? [0-9]{{1,2}},? )[12][0-9]{{3}}(?![0-9]))"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("ip6", r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9]|\.[0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,4}(?:[ -]?[0-9]{3})?|[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9])"),
    ("phone", r"(?<![0-9+])\+[0-9][0-9 ().-]{6,20}[0-9](?![0-9])|(?<![0-9(])\(?[2-9][0-9]{2}(?:\)[ .-]?|[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"),
    ("national", r"(?<![0-9+.,:/-])\(?0[1-9][0-9]{0,4}\)?(?:[ ./-][0-9]{2,8}){1,4}(?![0-9])"),
)
MAKERS: dict[str, Callable[[str, Feistel, bool], str | None]] = {
    "card": card, "phone": phone, "national": national, "ip": ip, "ip6": ip6, "iban": iban, "ssn": ssn, "date": date,
    "short_date": short_date, "named_date": named_date, "email": email,
}
#: Kind that the values of a format are counted as, where it has another name.
KIND_OF = {"national": "phone", "ip6": "ip", "short_date": "date", "named_date": "date"}
EXTRA = 2  # groups inside the date pattern


def combined() -> re.Pattern:
    """All formats in one pattern; a format's group is found by its name."""
    parts, groups = [], 0
    for name, pattern in PATTERNS:
        groups += 1
        if name == "date":
            pattern = pattern.replace(r"\1", rf"\{groups + 1}").replace(r"\2", rf"\{groups + 2}")
        parts.append(f"(?P<{name}>{pattern})")
        groups += EXTRA if name == "date" else 0
    return re.compile("|".join(parts))


FINDER = combined()
#: Formats of several groups: what follows may look like one more.
GROUPED = {name: re.compile(pattern) for name, pattern in PATTERNS if name in ("iban", "card", "phone", "national")}
#: Where a value begins inside a run of digit groups, the run ends before it.
NEXT_VALUE = re.compile(
    rf"[ (](?={DATE_SHAPE}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}(?![0-9])|\+?\(?[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}}(?![0-9])"
    r"|[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,4}(?![0-9])|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]))"
)
#: Put behind a pseudonym that would be read back together with what follows (fixed value, word joiner).
MARK = "\u2060"
DATE_BEFORE = re.compile(r"(?<![0-9./-])" + DATE_SHAPE + r"[/-]\Z")
#: Every value holds a digit or an @: only their surroundings are searched. A value begins at most
#: BEFORE characters before its first one and ends at most so many behind its last one.
TRIGGER = re.compile(r"[0-9]+|@")
BEFORE, AFTER_DIGIT, AFTER_AT = 70, 60, 620


def windows(text: str) -> list[tuple[int, int]]:
    """Merged ranges of ``text`` that can hold values."""
    found: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(m.start() - BEFORE, 0), m.end() + (AFTER_AT if text[m.start()] == "@" else AFTER_DIGIT)
        if found and a <= found[-1][1]:
            found[-1][1] = max(b, found[-1][1])
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


class Pseudonymiser:
    """Replaces every validated value of a text; remembers values it has seen."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.net, self.back = Feistel(key), back
        self.memory: dict[tuple[str, str], str | None] = {}

    def value(self, name: str, value: str) -> str | None:
        at = (name, value)
        if at not in self.memory:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            self.memory[at] = MAKERS[name](value, self.net, self.back)
        return self.memory[at]

    def shorter(self, name: str, value: str) -> tuple[int, str] | None:
        """(length, pseudonym) of the longest valid value that ``value``, not valid as a whole, begins with."""
        for end in range(len(value) - 1, 0, -1):
            if value[end] in " ()./-" and GROUPED[name].fullmatch(value, 0, end):
                made = self.value(name, value[:end])
                if made is not None:
                    return end, made
        return None

    def joins(self, name: str, made: str, rest: str) -> bool:
        """Whether a pseudonym makes a longer valid value with the groups behind it."""
        ends = [e for e in range(1, len(rest) + 1) if e == len(rest) or rest[e] in " ()./-"]
        return any(GROUPED[name].fullmatch(made + rest[:e]) and self.value(name, made + rest[:e]) is not None for e in ends)

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        counts = dict.fromkeys(KINDS, 0)
        parts, end = [], 0
        for a, b in windows(text):
            part = text[a:b]
            at = max(end - a, 0)
            while m := FINDER.search(part, at):
                name, whole, stop = name_of(m), m.group(), m.end()
                if name in ("phone", "national") and (cut := NEXT_VALUE.search(whole + part[stop : stop + 24], 1)) and cut.start() < len(whole):
                    # another value begins inside the run of groups
                    whole = whole[: cut.start()].rstrip(" ().-/") if GROUPED[name].fullmatch(whole[: cut.start()].rstrip(" ().-/")) else whole
                    stop = m.start() + len(whole)
                made = self.value(name, whole)
                if name == "date" and part[m.start() - 1 : m.start()] in ("/", "-") and not DATE_BEFORE.search(part[max(m.start() - 12, 0) : m.start()]):
                    made = None  # neither alone nor the end of an interval
                if made is None and name in GROUPED and (found := self.shorter(name, whole)):
                    stop, made = m.start() + found[0], found[1]
                if made is None:  # not valid: look again behind the first word of it
                    at = m.start() + 1
                    while at < m.end() and part[at].isalnum():
                        at += 1
                    continue
                counts[KIND_OF.get(name, name)] += 1
                parts += [text[end : a + m.start()], made]
                marked = part[stop : stop + 1] == MARK
                if self.back:
                    stop += marked
                elif marked or name in ("iban", "card") and self.joins(name, made, m.group()[stop - m.start() :]):
                    parts.append(MARK)
                at = stop
                end = a + at
        return "".join([*parts, text[end:]]) if parts else text, counts


def name_of(m: re.Match) -> str:
    return next(name for name, _ in PATTERNS if m.group(name) is not None)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", keep: list[str] | None = None, back: bool = False) -> DataFrame:
    """``keep`` columns (with the text replaced in place) and the number of values of each kind.

    Counts are n_card .. n_email (long). Values that fail validation (Luhn, check numbers,
    calendar, ranges) stay as they are. Equal values get equal pseudonyms whatever stands around
    them; where a card or account number's pseudonym would be read together with the group
    behind it, a word joiner marks its end. Dates are written with two digits (day numbers beside
    a month's name without a leading zero), addresses of version 6 in one case. Null texts stay null,
    texts without a value stay the same. With ``back`` the pseudonyms are turned into the values again.
    Not looked for: names, postal addresses, coordinates, hardware addresses, passport and tax numbers.
    """
    keep = list(docs.columns) if keep is None else keep
    secret = key.encode()

    def make():
        worker = Pseudonymiser(secret, back)

        def step(texts):
            new, counts = [], [[] for _ in KINDS]
            for t in texts:
                made, found = (None, dict.fromkeys(KINDS, 0)) if t is None else worker.text(t.decode())
                new.append(None if made is None else made.encode())
                for column, kind in zip(counts, KINDS):
                    column.append(found[kind])
            return [new, *counts]

        return step

    return map_texts(docs, text, [T.StructField(f"n_{k}", T.LongType()) for k in KINDS], make, keep, replace_text=True)
