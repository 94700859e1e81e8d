"""Personal data: format-preserving Feistel pseudonyms.

Numbers and dates that pass their kind's validation are permuted under a key
within their own format: a card number becomes another number of the same
length, first digit and valid Luhn digit, a date another date of its range in
the same notation. Equal values get equal pseudonyms in every document, so
they stay linked; without the key the value cannot be told from the pseudonym.

Each kind maps a value to a place in a domain of known size and back. The place
goes through a keyed Feistel network over two coordinates, walked on while it
falls outside the domain, which makes it a permutation of the domain.

Kinds (first come, first served where spans overlap): e-mail addresses (the
name; the domain stays), IBANs (mod-97), payment cards (Luhn), North American
phone numbers, social security numbers, IPv4 addresses, dates (year-month-day
and day or month first), access keys and assigned secrets. What fails its
validation stays, except phone numbers written with +1: the notation tells
them, so those with an area or office code that is never given out are permuted
among themselves. A null text stays null, an empty one empty; rows are
rewritten one by one, so repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import small_batches, wrapped

ROUNDS = 8
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
HEX = "0123456789abcdef"


class Cipher:
    """A keyed permutation of 0 .. n - 1 for any n, one per tweak."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, k: int, value: int) -> int:
        data = f"{tweak}|{k}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n <= 1:
            return x
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        tweak = f"{tweak}|{n}"
        rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        sign = -1 if back else 1
        while True:
            left, right = x // b, x % b
            for k in rounds:
                if k % 2:
                    right = (right + sign * self._round(tweak, k, left)) % b
                else:
                    left = (left + sign * self._round(tweak, k, right)) % a
            x = left * b + right
            if x < n:
                return x


# -- domains --------------------------------------------------------------------

def _mixed(text: str, alphabets: list[str], cipher: Cipher, tweak: str, back: bool) -> str:
    """Permute a string within the product of its characters' alphabets."""
    x, n = 0, 1
    for c, a in zip(text, alphabets):
        x, n = x * len(a) + a.index(c), n * len(a)
    x = cipher.permute(x, n, tweak, back)
    out = []
    for a in reversed(alphabets):
        x, k = divmod(x, len(a))
        out.append(a[k])
    return "".join(reversed(out))


def _classes(text: str) -> list[str]:
    return [next((a for a in (DIGITS, LOWER, UPPER) if c in a), c) for c in text]


def _refill(pattern: str, chars: str, keep: str) -> str:
    """``pattern`` with its characters out of ``keep`` replaced in order."""
    it = iter(chars)
    return "".join(next(it) if c in keep else c for c in pattern)


def _luhn(digits: str) -> int:
    """The check digit after ``digits``."""
    s = sum(int(c) if k % 2 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
    return -s % 10


def email(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    name = m["name"]
    return _mixed(name, _classes(name), cipher, "email", back) + m[0][len(name):]


def iban(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    # words in capitals may follow: the longest run of groups that is valid
    text, rest = m[0], ""
    while (new := _iban(text.replace(" ", ""), cipher, back)) is None:
        text, space, word = text.rpartition(" ")
        if not space:
            return None
        rest = space + word + rest
    return _refill(text, new, DIGITS + UPPER) + rest


def _iban(flat: str, cipher: Cipher, back: bool) -> str | None:
    check = lambda country, body: 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    country, body = flat[:2], flat[4:]
    if not 11 <= len(body) <= 30 or int(flat[2:4]) != check(country, body):
        return None
    body = _mixed(body, _classes(body), cipher, "iban", back)
    return f"{country}{check(country, body):02d}{body}"


def card(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    d = re.sub(r"\D", "", m[0])
    if not 13 <= len(d) <= 19 or d[0] == "0" or len(set(d)) == 1 or _luhn(d[:-1]) != int(d[-1]):
        return None
    body = d[0] + _mixed(d[1:-1], [DIGITS] * (len(d) - 2), cipher, "card" + d[0], back)
    return _refill(m[0], body + str(_luhn(body)), DIGITS)


def phone(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    d = m["area"] + m["office"] + m["line"]
    alphabets = [DIGITS[2:], DIGITS, DIGITS, DIGITS[2:], *[DIGITS] * 6]
    valid = lambda d: all(c in a for c, a in zip(d, alphabets))
    head = m[0][:m.start("area") - m.start()]
    if valid(d):
        new = _mixed(d, alphabets, cipher, "phone", back)
    elif head.startswith("+1"):
        # written as a number in full: a permutation of the ten digits that are no valid number
        new = _mixed(d, [DIGITS] * 10, cipher, "phone+1", back)
        while valid(new):
            new = _mixed(new, [DIGITS] * 10, cipher, "phone+1", back)
    else:
        return None
    return head + _refill(m[0][len(head):], new, DIGITS)


def ssn(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    a, g, s = (int(x) for x in m[0].split("-"))
    if not 1 <= a <= 899 or a == 666 or not g or not s:
        return None
    areas = a - 1 - (a > 666)
    x = cipher.permute((areas * 99 + g - 1) * 9999 + s - 1, 898 * 99 * 9999, "ssn", back)
    x, s = divmod(x, 9999)
    a, g = divmod(x, 99)
    return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"


def ipv4(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    p = [int(x) for x in m[0].split(".")]
    if any(x > 255 for x in p) or not 1 <= p[0] <= 223 or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")):
        return None
    x = int.from_bytes(bytes(p), "big") - (1 << 24)
    x = cipher.permute(x, 223 << 24, "ipv4", back) + (1 << 24)
    return ".".join(map(str, x.to_bytes(4, "big")))


FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def date(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    if m["y"]:
        parts, order = (int(m["y"]), int(m["m"]), int(m["d"])), "ymd"
    else:
        a, b, y = int(m["a"]), int(m["b"]), int(m["y2"])
        parts, order = ((y, a, b), "mdy") if b > 12 else ((y, b, a), "dmy")
    try:
        day = dt.date(*parts).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    month_first = order == "mdy"
    # a date whose notation shows the month by a day over 12 must keep that
    while True:
        day = FIRST_DAY + cipher.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date" + order, back)
        got = dt.date.fromordinal(day)
        if not month_first or got.day > 12:
            break
    digits = {"ymd": f"{got.year:04d}{got.month:02d}{got.day:02d}", "dmy": f"{got.day:02d}{got.month:02d}{got.year:04d}",
              "mdy": f"{got.month:02d}{got.day:02d}{got.year:04d}"}[order]
    return _refill(m[0], digits, DIGITS)


def access_key(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    body = m[0][4:]
    return m[0][:4] + _mixed(body, _classes(body), cipher, "key", back)


def secret(m: re.Match, cipher: Cipher, back: bool) -> str | None:
    v = m["value"]
    alphabets = [HEX] * len(v) if all(c in HEX for c in v) else _classes(v)
    head = m[0][:m.start("value") - m.start()]
    return head + _mixed(v, alphabets, cipher, f"secret{len(v)}", back) + m[0][len(head) + len(v):]


Kind = Callable[[re.Match, Cipher, bool], "str | None"]

KINDS: dict[str, tuple[re.Pattern, Kind]] = {
    "email": (re.compile(r"(?<![\w.+-])(?P<name>[A-Za-z0-9][A-Za-z0-9._+-]{0,63})@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"), email),
    "iban": (re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"), iban),
    "card": (re.compile(r"(?<![\w.+-])(?:\d{13,19}|\d{4}(?P<c>[ -])\d{4}(?P=c)\d{4}(?P=c)\d{1,7}|\d{4}(?P<e>[ -])\d{6}(?P=e)\d{5})(?![\w-])"), card),
    "phone": (re.compile(r"(?<![\w+])(?:\+?1[ .-]?)?\(?(?P<area>\d{3})\)?[ .-](?P<office>\d{3})[ .-](?P<line>\d{4})(?![\w-])"), phone),
    "ssn": (re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), ssn),
    "ipv4": (re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"), ipv4),
    "date": (re.compile(r"(?<![\w/.-])(?:(?P<y>\d{4})(?P<s>[-/.])(?P<m>\d{2})(?P=s)(?P<d>\d{2})"
                        r"|(?P<a>\d{2})(?P<s2>[-/.])(?P<b>\d{2})(?P=s2)(?P<y2>\d{4}))(?![\w/-])"), date),
    "access_key": (re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)"), access_key),
    "secret": (re.compile(r"(?i:password|passwd|token|secret|api_key)[ ]?[=:][ ]?[\"']?(?P<value>[A-Za-z0-9]{16,64})(?!\w)"), secret),
}


def rewrite(text: str | None, cipher: Cipher, kinds: dict = KINDS, back: bool = False) -> tuple[str | None, dict[str, int]]:
    """``text`` with its validated values replaced, and their number by kind.
    ``back`` turns pseudonyms into the values again."""
    if not text:
        return text, {}
    taken, found, used = [], {}, bytearray(len(text))
    for name, (pattern, permute) in kinds.items():
        for m in pattern.finditer(text):
            if used.find(1, m.start(), m.end()) >= 0:
                continue
            new = permute(m, cipher, back)
            if new is not None:
                used[m.start():m.end()] = b"\x01" * (m.end() - m.start())
                taken.append((m.start(), m.end(), new))
                found[name] = found.get(name, 0) + 1
    out, at = [], 0
    for s, e, new in sorted(taken):
        out += (text[at:s], new)
        at = e
    return "".join(out) + text[at:], found


def pseudonymise(docs: DataFrame, key: bytes, kinds: dict = KINDS) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``pii`` (in place of a column of
    that name), the number of values replaced by kind, a map."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("text string, pii map<string,int>")
    def rewritten(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cipher = Cipher(key)
        for t in texts:
            got = [rewrite(x, cipher, kinds) for x in t]
            yield pd.DataFrame({"text": [x for x, _ in got], "pii": [n for _, n in got]})

    cols = [F.col(f"_row.`{c}`") if c != "text" else F.col("got.text").alias("text")
            for c in docs.columns if c != "pii"]
    return wrapped(docs, got=rewritten(F.col("text"))).select(*cols, F.col("got.pii").alias("pii"))
