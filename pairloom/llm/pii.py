"""PII: numbers and dates about people, replaced by format-preserving pseudonyms."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pairloom.llm.arrow import add_columns

ROUNDS = 8
#: Characters of an address that are permuted together; a longer one is permuted piece by piece.
PIECE = 64


@dataclass(frozen=True)
class Key:
    """The secret, and whether values are replaced by pseudonyms or pseudonyms by values."""

    secret: bytes
    undo: bool = False


def _round(x: int, r: int, bits: int, key: Key, salt: bytes) -> int:
    """bits pseudo-random bits from x: as many digests as that takes."""
    data, out, width = x.to_bytes(-(-bits // 8), "big"), b"", -(-bits // 8) + 8
    while len(out) < width:
        person = (len(out) // 64 << 8 | r).to_bytes(16, "big")
        out += hashlib.blake2b(data, key=key, digest_size=min(64, width - len(out)), person=person, salt=salt).digest()
    return int.from_bytes(out, "big") & ((1 << bits) - 1)


def permute(x: int, size: int, key: Key, tweak: str) -> int:
    """A keyed permutation of 0..size-1: a balanced Feistel network over the least even number of bits that holds them,
    walked until it comes back within the range. Backwards (key.undo) it takes every value to where it came from."""
    half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
    mask, salt = (1 << half) - 1, hashlib.blake2b(tweak.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    while True:
        left, right = x >> half, x & mask
        for r in reversed(range(ROUNDS)) if key.undo else range(ROUNDS):
            if key.undo:
                left, right = right ^ _round(left, r, half, key.secret, salt), left
            else:
                left, right = right, left ^ _round(right, r, half, key.secret, salt)
        x = left << half | right
        if x < size:
            return x


# The alphabets within which a character of an address or account is permuted.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
)
_PLACE = {c: (a, i) for a in ALPHABETS for i, c in enumerate(a)}


@cache
def _alphabet(page: int, category: str) -> str:
    """Letters or digits of one case and script: those of a category among 256 neighbours in Unicode."""
    return "".join(c for i in range(page << 8, (page + 1) << 8) if unicodedata.category(c := chr(i)) == category and c not in _PLACE)


def _place(c: str) -> tuple[str, int] | None:
    """The alphabet of a letter or digit and its place there; None for any other character."""
    if c in _PLACE or not c.isalnum():
        return _PLACE.get(c)
    letters = _alphabet(ord(c) >> 8, unicodedata.category(c))
    return letters, letters.index(c)


def permute_text(s: str, key: Key, tweak: str, good: Callable[[str], bool] = lambda s: True) -> str:
    """Permute all strings of s's pattern of alphabets; other characters stay. good(): which of them are valid; the walk
    goes on until it meets a valid one, so valid ones are permuted among themselves."""
    places = [_place(c) for c in s]
    shape = "".join((str(ALPHABETS.index(p[0])) if p[0] in ALPHABETS else p[0][0]) if p else c for p, c in zip(places, s, strict=True))
    size = x = 0
    for p in places:
        if p:
            x, size = x * len(p[0]) + p[1], (size or 1) * len(p[0])
    if not size:
        return s
    while True:
        x = permute(x, size, key, f"{tweak}/{shape}")
        out, rest = [], x
        for p, c in zip(reversed(places), reversed(s), strict=True):
            if p:
                rest, i = divmod(rest, len(p[0]))
                c = p[0][i]
            out.append(c)
        if good(made := "".join(reversed(out))):
            return made


def luhn_digit(digits: str) -> str:
    """The check digit for the digits before it."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """digits in the places of shape's digits."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _card(s: str, key: Key) -> str | None:
    d = _digits(s)
    if luhn_digit(d[:-1]) != d[-1] or not d.strip("0"):
        return None
    body = permute_text(d[:-1], key, "card")
    return _refill(s, body + luhn_digit(body))


def _phone(s: str, key: Key) -> str | None:
    d = _digits(s)
    if not 8 <= len(d) <= 15:
        return None
    code = len(_digits(re.match(r"\+[0-9]{1,3}|", s)[0]))
    return _refill(s, d[:code] + permute_text(d[code:], key, "phone"))


def _good_id(s: str) -> bool:
    a, b, c = s.split("-")
    return a not in ("000", "666") and a[0] != "9" and b != "00" and c != "0000"


def _id_number(s: str, key: Key) -> str | None:
    return permute_text(s, key, "id", _good_id) if _good_id(s) else None


def _address(s: str, key: Key) -> str | None:
    parts = [int(p) for p in s.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in s.split(".")):
        return None
    x = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "address")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _mail(s: str, key: Key) -> str | None:
    """The local part is permuted, piece by piece where it is long: a piece depends on what stands before it."""
    local, at, domain = s.partition("@")
    if not any(map(_place, local)):
        return None
    new, before = "", f"mail/{domain.lower()}"
    for i in range(0, len(local), PIECE):
        old = local[i : i + PIECE]
        made = permute_text(old, key, before)
        new += made
        before = f"{hashlib.blake2b((before + (made if key.undo else old)).encode('utf-8', 'surrogatepass')).hexdigest()}/{domain.lower()}"
    return new + at + domain


def _check_digits(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def _account(s: str, key: Key) -> str | None:
    c = s.replace(" ", "")
    if not 15 <= len(c) <= 34 or _check_digits(c[:2], c[4:]) != c[2:4]:
        return None
    body = permute_text(c[4:], key, f"account/{c[:2]}")
    it = iter(c[:2] + _check_digits(c[:2], body) + body)
    return "".join(x if x == " " else next(it) for x in s)


_FIRST, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def _date(s: str, key: Key) -> str | None:
    a, b, c = re.split(r"[-/.]", s)
    orders = ("ymd",) if len(a) == 4 else ("dmy", "mdy") if "/" in s else ("dmy",)
    for order in orders:
        parts = dict(zip(order, (a, b, c), strict=True))
        try:
            day = date(int(parts["y"]), int(parts["m"]), int(parts["d"])).toordinal()
        except ValueError:
            continue
        if _FIRST <= day <= _LAST:
            new = date.fromordinal(_FIRST + permute(day - _FIRST, _LAST - _FIRST + 1, key, "date"))
            put = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
            return "".join(put[k] + sep for k, sep in zip(order, (*re.findall(r"[-/.]", s), ""), strict=True))
    return None


# What each kind looks like before it is validated, in the order in which they are tried at a place.
KINDS = {
    "mail": (r"(?<![\w.%+-])[\w.%+-]++@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}", _mail),
    "account": (r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _account),
    "address": (r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])", _address),
    "date": (r"(?<![\w])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?!\w)", _date),
    "id": (r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", _id_number),
    "card": (r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", _card),
    "phone": (r"(?<!\w)(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])|(?<!\w)\+[0-9]{8,15}(?!\w)", _phone),
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, (p, _) in KINDS.items()))
#: An address that starts right where another one ends.
_NEXT = re.compile(f"(?P<mail>{KINDS['mail'][0].partition(')')[2]})")
_SIGNS = re.compile("[0-9@]")


#: Digits with single separators, as far as any card can reach that starts in a card's match; the groups cards are written in.
_RUN = re.compile("[0-9](?:[ -]?[0-9]){0,37}")
_GROUP = re.compile("[0-9]+")
_CARD_GROUPS = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")


def _card_within(text: str, m: re.Match, key: Key, row: int) -> tuple[int, int, str | None]:
    """Start, end and pseudonym of a card at m's place, at the greatest length that is valid and ends with a group of
    digits. Other groups than those of cards count for the whole match only, before `row` not at all (one row of figures
    in ten passes the check at any length), and not if they cut a card. Groups after a hyphen are starts, too. No card:
    the end of the last group that was tried as a start."""
    groups = [g.span() for g in _GROUP.finditer(text, m.start(), _RUN.match(text, m.start()).end())]
    ends = [e for _, e in groups if text[e : e + 1] in ("", " ", "-") or not re.match(r"\w", text[e])]
    if ends and ends[-1] == groups[-1][1] and text[ends[-1] : ends[-1] + 1] == "-" and not text[ends[-1] + 1 : ends[-1] + 2].isdigit():
        ends.pop()

    def lengths(s: int) -> list[int]:
        return [e for e in reversed(ends) if 13 <= e - s <= 37 and 13 <= len(_digits(text[s:e])) <= 19]

    def shaped(s: int) -> list[int]:
        return [e for e in lengths(s) if _CARD_GROUPS.fullmatch(text, s, e) and _card(text[s:e], key)]

    tried = m.start()
    for s, tried in groups:
        if s > m.start() and text[s - 1] != "-":
            return s, groups[groups.index((s, tried)) - 1][1], None
        for e in lengths(s):
            usual = _CARD_GROUPS.fullmatch(text, s, e)
            if (usual or ((s, e) == m.span() and s >= row)) and (new := _card(text[s:e], key)):
                if usual or not any(x > e for t, _ in groups if s < t < e for x in shaped(t)):
                    return s, e, new
    return m.start(), tried, None


def _account_within(text: str, m: re.Match, key: Key, row: int) -> tuple[int, int, str | None]:
    """The same for an account: at the greatest length that is valid and ends before a space."""
    ends = [m.start() + x.start() for x in re.finditer(" ", m[0])]
    for e in (m.end(), *reversed(ends)):
        new = _account(text[m.start() : e], key)
        if new:
            return m.start(), e, new
    return m.start(), min([m.end(), *ends]), None


_WITHIN = {"account": _account_within, "card": _card_within}


def pseudonymise(text: str | None, key: Key) -> tuple[str | None, list[str]]:
    """The text with every validated value permuted within its format, and the kinds found, in order. A value is
    replaced as a whole; what doesn't validate stays, save that it is tried as the kinds that come after. Cards and
    accounts are found next to other figures and capitals: shorter ends and later starts are tried at the borders of
    groups (cards: in the groups cards are written in). Telephone numbers have no check, so part of a row of figures that is no card isn't taken for one."""
    found: list[str] = []
    if not text or not _SIGNS.search(text):
        return text, found
    kinds, out, done, at, row = list(KINDS), [], 0, 0, 0
    while m := (_NEXT.match(text, at) if found[-1:] == ["mail"] and at == done else None) or _ANY.search(text, at):
        k = m.lastgroup
        start, at, new = m.start(), m.end(), None
        if k in _WITHIN:
            start, at, new = _WITHIN[k](text, m, key, row)
        elif k != "phone" or start >= row:
            new = KINDS[k][1](m[0], key)
        else:
            at = _GROUP.search(text, start).end()
        if new is None and (k != "phone" or start >= row):
            for k in kinds[kinds.index(m.lastgroup) + 1 :]:
                if re.fullmatch(KINDS[k][0], m[0]) and (new := KINDS[k][1](m[0], key)) is not None:
                    start, at = m.span()
                    break
        if new is not None:
            found.append(k)
            out += text[done:start], new
            done = at
        elif m.lastgroup == "card":
            row = max(row, m.end())
    return "".join((*out, text[done:])), found


def pseudonymise_documents(docs: DataFrame, secret: bytes, undo: bool = False) -> DataFrame:
    """docs (text) -> the same rows and columns, text with pseudonyms, and kinds array<string>, n_found long.

    Kinds: mail addresses (the local part, in any script and of any length; the domain stays), bank accounts (IBAN,
    checked), IPv4 addresses, dates (of 1900 to 2099, in three notations), US social security numbers, telephone numbers
    (the country code stays), card numbers (Luhn-checked). Each is permuted by a Feistel network keyed with `secret` (up
    to 64 bytes, which are not kept anywhere) among the valid values of its format: lengths, separators and check digits
    hold, equal values have equal pseudonyms in all documents (cards, dates and telephone numbers also across notations),
    different ones different ones. Whoever has the secret can undo it: `undo` gives the original texts, as pseudonyms
    validate where values do. Nothing is stored and no document looks at another one, so the work is one pass without a
    shuffle. In a format of very few values one may be its own pseudonym. An address without any letter or digit stays
    and isn't counted.

    A null text stays null and an empty one empty, both with no kinds. A text of any length is read whole, in time in
    proportion to it. Other columns pass through; kinds and n_found are replaced.
    """
    key = Key(secret, undo)

    def compute(batch: pa.RecordBatch) -> list:
        done = [pseudonymise(t, key) for t in batch.column("text").to_pylist()]
        return [pa.array([t for t, _ in done], pa.string()), pa.array([k for _, k in done], pa.list_(pa.string())), pa.array([len(k) for _, k in done], pa.int64())]

    return add_columns(docs, [("text", T.StringType()), ("kinds", T.ArrayType(T.StringType())), ("n_found", T.LongType())], compute)
