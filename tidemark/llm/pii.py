"""Format-preserving pseudonyms for personal data.

Numbers and dates are found by pattern, checked (card checksum, account checksum, octets,
calendar) and replaced by a keyed Feistel permutation of the values of their format: a card
number becomes another valid card number, a date another date written the same way.  The
permutation depends on the key and the kind alone, so equal values get equal pseudonyms in
every document, however they are spaced or dashed, and different values different ones.
A value may stand directly before another: of the readings of a run of digits those are taken
that pass their checks and cover most of it.

Kinds: ``email``, ``iban``, ``card``, ``phone``, ``ip``, ``ssn``, ``date``.  Decimal digits of
any script count; a pseudonym is written in the script of the value's first digit, and values
that differ in script alone stay linked.  A phone number keeps its country code and length; with
or without a trunk ``(0)`` it is the same number.  What fails its check stays, and so do a date
before 1900 or after 2099, a date written out or with a two-digit year, an account in lower case,
a national number without its code other than a North American one, and an address behind a
``v``, which is a version.  Searches take time in proportion to the text, whatever it holds.  A null text stays null, an empty
one empty; texts are treated whole; equal texts become equal texts; an empty table stays empty.
All columns are kept.  The two added ones, ``n_pii`` and ``pii_spans``, replace columns of
those names.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from datetime import date
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import add_columns

ROUNDS = 10
PIECE = 320  # characters, as many as an address may have
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]*")
FOREIGN_DIGIT = re.compile(r"(?![0-9])\d")
STARTS = re.compile(r"\d+|\+(?=\d)|\((?=\d)|[A-Z]{2}(?=\d\d)", re.A)
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
                  r"(?![A-Za-z0-9])", re.A)
DATE = re.compile(r"(?<![\d./-])(?:\d{4}(?P<a>[-/.])\d{1,2}(?P=a)\d{1,2}"
                  r"|\d{1,2}(?P<b>[-/.])\d{1,2}(?P=b)\d{4})(?!\d|[./-]\d)", re.A)
IP = re.compile(r"(?<![\d.vV])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", re.A)
SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!\d|-\d)", re.A)
CARD = re.compile(r"(?<![\dA-Za-z])\d(?:[ -]?\d){12,18}(?![\dA-Za-z])", re.A)
PHONE = re.compile(r"\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\d)"
                   r"|(?<![\d.(+-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d|[.-]\d)", re.A)
# How the digits of a card are grouped, if at all.
CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}
IBAN_SIZES = {p[:2]: int(p[2:]) for p in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 "
    "EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 "
    "IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 "
    "NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 "
    "TN24 TR26 UA29 VA22 VG24 XK20").split()}
# Digits of a national number by country code; other codes allow 8 to 15 digits in all.
PLANS = {code: (int(low), int(high)) for code, low, high in (p.split(":") for p in (
    "1:10:10 7:10:10 20:8:10 27:9:9 30:10:10 31:9:9 32:8:9 33:9:9 34:9:9 36:8:9 39:6:11 40:9:9 "
    "41:9:9 43:6:13 44:9:10 45:8:8 46:7:10 47:8:8 48:9:9 49:6:11 51:8:9 52:10:11 54:10:11 "
    "55:10:11 56:9:9 57:10:10 58:10:10 60:8:10 61:9:9 62:8:12 63:8:10 64:8:10 65:8:8 66:8:9 "
    "81:9:10 82:8:10 84:9:10 86:10:11 90:10:10 91:10:10 92:9:10 94:9:9 98:10:10 212:9:9 213:8:9 "
    "216:8:8 234:8:10 254:9:9 351:9:9 352:6:9 353:7:9 354:7:7 358:6:11 359:8:9 370:8:8 371:8:8 "
    "372:7:8 380:9:9 381:8:9 385:8:9 386:8:8 420:9:9 421:9:9 852:8:8 886:8:9 966:9:9 971:8:9 "
    "972:8:9").split())}


class Cipher:
    """Permutations of 0 .. n - 1 under one key."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def mix(self, tweak: bytes, turn: int, value: int, bits: int) -> int:
        size = (bits + 7) // 8
        data = turn.to_bytes(1, "big") + bits.to_bytes(4, "big") + value.to_bytes(size, "big")
        out, block = b"", 0
        while len(out) < size:
            out += hashlib.blake2b(tweak + b"\0" + block.to_bytes(4, "big") + data,
                                   key=self.key).digest()
            block += 1
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def permute(self, value: int, n: int, tweak: str, back: bool = False) -> int:
        """Balanced Feistel rounds over the next even number of bits, walked until below n."""
        if n < 2:
            return value
        bits = ((n - 1).bit_length() + 1) // 2
        mask, name = (1 << bits) - 1, tweak.encode()
        while True:
            left, right = value >> bits, value & mask
            if back:
                for turn in reversed(range(ROUNDS)):
                    left, right = right ^ self.mix(name, turn, left, bits), left
            else:
                for turn in range(ROUNDS):
                    left, right = right, left ^ self.mix(name, turn, right, bits)
            value = left << bits | right
            if value < n:
                return value


def digits_of(text: str) -> str:
    return "".join(c for c in text if c.isdecimal() and c.isascii())


def put_digits(text: str, digits: str) -> str:
    """The text with its digits replaced in order."""
    given = iter(digits)
    return "".join(next(given) if c.isdecimal() and c.isascii() else c for c in text)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_rest(account: str) -> int:
    """The remainder by 97 of the account with its head moved to the end."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def letters(cipher: Cipher, text: str, tweak: str) -> str:
    """ASCII letters and digits replaced by others of their class; all else stays.

    A long text is permuted piece by piece, each under a digest of what stands before it, as
    whole numbers of a million digits would take too long.
    """
    if len(text) > PIECE:
        seen, out = hashlib.blake2b(), []
        for at in range(0, len(text), PIECE):
            out.append(letters(cipher, text[at:at + PIECE], f"{tweak} {seen.hexdigest()}"))
            seen.update(text[at:at + PIECE].encode())
        return "".join(out)
    value, n = 0, 1
    classes = []
    for c in text:
        base = (10, "0") if c in "0123456789" else (26, "a") if "a" <= c <= "z" else (
            26, "A") if "A" <= c <= "Z" else None
        classes.append(base)
        if base:
            value, n = value * base[0] + ord(c) - ord(base[1]), n * base[0]
    shape = "".join(b[1] if b else c for b, c in zip(classes, text, strict=True))
    value = cipher.permute(value, n, f"{tweak} {shape}")
    out = []
    for base, c in zip(reversed(classes), reversed(text), strict=True):
        if base:
            value, digit = divmod(value, base[0])
            c = chr(ord(base[1]) + digit)
        out.append(c)
    return "".join(reversed(out))


def _email(cipher: Cipher, text: str) -> str:
    """Local part and domain change together; the top-level domain stays."""
    body, dot, top = text.rpartition(".")
    return letters(cipher, body.lower(), "email") + dot + top


def _card(cipher: Cipher, text: str) -> str | None:
    digits = digits_of(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    size = len(digits) - 1
    body = str(cipher.permute(int(digits[:-1]), 10 ** size, f"card {size}")).zfill(size)
    return put_digits(text, body + luhn_digit(body))


def _iban(cipher: Cipher, text: str) -> str | None:
    """The account part changes; the check digits follow it."""
    account = text.replace(" ", "")
    if not 15 <= len(account) <= 34 or iban_rest(account) != 1:
        return None
    body = letters(cipher, account[4:], f"iban {account[:2]}")
    check = 98 - iban_rest(account[:2] + "00" + body)
    given = iter(f"{account[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(given) for c in text)


def country_code(digits: str) -> str:
    """The code at the start of an international number; those not listed have three digits."""
    return next((digits[:n] for n in (1, 2, 3) if digits[:n] in PLANS), digits[:3])


def _phone(cipher: Cipher, text: str) -> str | None:
    """The country code and a trunk zero in brackets stay; the national number changes."""
    head, trunk, tail = text.partition("(0)") if text.startswith("+") else (text, "", "")
    digits = digits_of(head + tail)
    code = country_code(digits) if text.startswith("+") else ""
    rest = digits[len(code):]
    if not 8 <= len(digits) <= 15 or not rest or len(digits_of(head)) < len(code):
        return None
    # A North American number without its code is the same number.
    tweak = "phone 1" if code == "1" or (not code and len(rest) == 10) else f"phone {code}"
    size = len(rest)
    made = code + str(cipher.permute(int(rest), 10 ** size, f"{tweak} {size}")).zfill(size)
    split = len(digits_of(head))
    return put_digits(head, made[:split]) + trunk + put_digits(tail, made[split:])


def _ip(cipher: Cipher, text: str) -> str | None:
    octets = [int(o) for o in text.split(".")]
    if max(octets) > 255:
        return None
    value = cipher.permute(int.from_bytes(bytes(octets), "big"), 1 << 32, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _ssn(cipher: Cipher, text: str) -> str | None:
    """Areas 000, 666 and 9xx, group 00 and serial 0000 are not given out."""
    def valid(v: int) -> bool:
        area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(digits_of(text))
    if not valid(value):
        return None
    value = cipher.permute(value, 10 ** 9, "ssn")
    while not valid(value):
        value = cipher.permute(value, 10 ** 9, "ssn")
    return put_digits(text, f"{value:09d}")


def _date(cipher: Cipher, text: str) -> str | None:
    """Year first, or year last with the day first where that is a date, else the month; with
    slashes the month where that is a date, else the day.  A date keeps its order, separators
    and, where it fits, unpadded parts."""
    sep = next(c for c in text if not c.isdigit())
    parts = [int(p) for p in text.split(sep)]
    if len(text.split(sep)[0]) == 4:
        orders = [(0, 1, 2)]
    else:
        orders = [(2, 0, 1), (2, 1, 0)] if sep == "/" else [(2, 1, 0), (2, 0, 1)]
    for order in orders:
        try:
            day = date(*(parts[i] for i in order)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        count = LAST_DAY - FIRST_DAY + 1
        new = day
        while True:
            new = FIRST_DAY + cipher.permute(new - FIRST_DAY, count, "date")
            made = date.fromordinal(new)
            # A date of the second order must not read in the first, so walk on where it would.
            if order == orders[0] or made.day > 12:
                break
        values = dict(zip(order, (made.year, made.month, made.day), strict=True))
        padded = all(len(p) >= 2 for p in text.split(sep))
        return sep.join(
            f"{values[i]:04d}" if i == order[0] else
            f"{values[i]:02d}" if padded else str(values[i]) for i in range(3))
    return None


def borders(text: str) -> list[int]:
    """The ends of a match's tokens, the last one first."""
    return [i for i in range(len(text), 0, -1)
            if text[i - 1].isalnum() and not text[i:i + 1].isalnum()]


def _in_plan(text: str) -> bool:
    digits = digits_of(text)
    code = country_code(digits)
    low, high = PLANS.get(code, (0, 15))
    return low <= len(digits) - len(code) - ("(0)" in text) <= high


def _card_rank(text: str) -> tuple[bool, bool, int]:
    """Usual groups first, then sixteen digits, then the longest."""
    groups = re.split("[ -]", text)
    size = sum(map(len, groups))
    usual = len(groups) == 1 or (
        tuple(map(len, groups)) in CARD_GROUPS and not ("-" in text and " " in text))
    return not usual, size != 16, -size


def _readings(cipher: Cipher, text: str, start: int) -> Iterator[tuple[int, str, str, bool]]:
    """End, kind, pseudonym and whether oddly grouped, of what starts here and passes its check.

    A pattern may run on into the next number, so its shorter ends are tried as well: an
    account's registered length first, a card's best end, and all ends a phone's plan allows.
    """
    def ends(pattern: re.Pattern) -> list[str]:
        m = pattern.match(text, start)
        return [m[0][:i] for i in borders(m[0])] if m else []

    first = text[start]
    if first.isalpha():
        size = IBAN_SIZES.get(text[start:start + 2])
        for part in sorted(ends(IBAN), key=lambda p: len(p.replace(" ", "")) != size):
            if made := _iban(cipher, part):
                yield start + len(part), "iban", made, False
                return
        return
    if first.isdecimal():
        for kind, pattern, maker in (("date", DATE, _date), ("ip", IP, _ip), ("ssn", SSN, _ssn)):
            if (m := pattern.match(text, start)) and (made := maker(cipher, m[0])):
                yield m.end(), kind, made, False
        for part in sorted(ends(CARD), key=_card_rank):
            if made := _card(cipher, part):
                yield start + len(part), "card", made, _card_rank(part)[0]
                break
    if first == "+":
        parts = ends(PHONE)
        parts = [p for p in parts if 8 <= len(digits_of(p)) <= 15 and _in_plan(p)] or parts
    else:
        parts = ends(PHONE)[:1]
    for part in parts:
        if made := _phone(cipher, part):
            yield start + len(part), "phone", made, False


def _apart(found: list, others: list) -> list:
    """Those of the readings that overlap none of the others."""
    if not others:
        return found
    others = sorted((s, e) for s, e, _, _ in others)
    starts = [s for s, _ in others]
    reach = list(accumulate((e for _, e in others), max))  # the furthest end so far
    return [f for f in found
            if not (i := bisect_left(starts, f[1])) or reach[i - 1] <= f[0]]


def _chosen(found: list[tuple[int, int, str, str]], text: str) -> list[tuple[int, int, str, str]]:
    """Of readings that overlap, those that cover most digits and letters; the first of equals."""
    found = sorted(found, key=lambda f: (f[0], -f[1]))
    starts = [f[0] for f in found]
    best, take = [0] * (len(found) + 1), [0] * len(found)
    for i in reversed(range(len(found))):
        start, end, _, _ = found[i]
        after = bisect_left(starts, end)
        covered = sum(map(str.isalnum, text[start:end])) + best[after]
        best[i] = max(covered, best[i + 1])
        take[i] = after if covered == best[i] else 0
    out, i = [], 0
    while i < len(found):
        if take[i]:
            out.append(found[i])
        i = take[i] or i + 1
    return out


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of addresses: a domain behind an ``@``, and what of a local part stands before."""
    floor, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at - BEFORE_AT.match(text[floor:at][::-1]).end()
            if start < at:
                yield start, domain.end()
                floor = domain.end()
        floor, at = max(floor, at + 1), text.find("@", at + 1)


def _in_script_of(made: str, given: str) -> str:
    """ASCII digits in the script of the first digit of the given value."""
    first = next(filter(str.isdecimal, given), "0")
    zero = ord(first) - unicodedata.decimal(first)
    return made if zero == ord("0") else "".join(
        chr(zero + int(c)) if c.isdecimal() else c for c in made)


def replace(text: str, cipher: Cipher) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the spans replaced in the given text."""
    if not text.isascii() and FOREIGN_DIGIT.search(text):
        folded = FOREIGN_DIGIT.sub(lambda m: str(unicodedata.decimal(m[0])), text)
        return _replaced(text, folded, cipher)
    return _replaced(text, text, cipher)


def _replaced(given: str, text: str, cipher: Cipher) -> tuple[str, list[str]]:
    """``text`` is the given text with all digits ASCII."""
    mails = [(start, end, "email", _email(cipher, text[start:end]))
             for start, end in _mails(text)]
    plain, odd = [], []
    for m in STARTS.finditer(text):
        for end, kind, made, oddly in _readings(cipher, text, m.start()):
            (odd if oddly else plain).append((m.start(), end, kind, made))
    plain = _apart(plain, mails)
    # An oddly grouped card gives way to whatever else the same digits are; to a phone, which
    # has no check, only if it has not the sixteen digits of most cards.
    odd = _apart(odd, mails + [f for f in plain if f[2] != "phone"])
    phones = [f for f in plain if f[2] == "phone"]
    odd = [f for f in odd if len(digits_of(text[f[0]:f[1]])) == 16 or _apart([f], phones)]
    out, spans, at = [], [], 0
    for start, end, kind, made in sorted(mails + _chosen(plain + odd, text)):
        out += [given[at:start], _in_script_of(made, given[start:end])]
        spans.append(f"{kind}:{start}:{end}")
        at = end
    return "".join([*out, given[at:]]), spans


def pseudonymise(df: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """All rows and columns, the text with pseudonyms, their number and spans."""
    def start():
        cipher = Cipher(key)

        def work(texts: list[str | None]) -> tuple[list, list, list]:
            rows = [(t, []) if t is None else replace(t, cipher) for t in texts]
            return ([r[0] for r in rows], [len(r[1]) for r in rows],
                    [",".join(r[1]) for r in rows])

        return work

    return add_columns(df, text, [("n_pii", "long", pa.int64()),
                                  ("pii_spans", "string", pa.string())], start, replaced=True)
