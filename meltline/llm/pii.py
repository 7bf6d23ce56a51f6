"""Format-preserving pseudonyms for personal data.

Numbers and dates are found by their form, validated (check digits, number ranges, real dates), and permuted within the
set of valid values of the same form by a keyed Feistel network. So equal values become equal pseudonyms in all
documents, different values stay different, check digits hold, and spelling (separators, brackets, order) is kept. The
network P on 0 to n-1 is used as P^-1(P(x) + 1 mod n), which is a permutation too but leaves no value where it is.
Values that leave the valid set walk on along their cycle until they are in it again.
"""

from __future__ import annotations

import calendar
import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mapped, slices

ROUNDS = 8
CACHE = 1 << 16


class Permutation:
    """A keyed permutation of 0 to size-1 without fixed points (for size > 1)."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size, self.key, self.tweak = size, hashlib.blake2b(key, digest_size=32).digest(), f"{kind}/{size}/".encode()
        self.left = max(1, math.isqrt(size - 1) + 1) if size > 1 else 1
        self.right = -(-size // self.left)

    def _round(self, i: int, half: int) -> int:
        said = self.tweak + i.to_bytes(1, "big") + half.to_bytes((half.bit_length() + 7) // 8, "big")
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=64).digest(), "big")

    def _walk(self, x: int, back: bool) -> int:
        while True:  # left * right may exceed size: walk until inside
            a, b = divmod(x, self.right)
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if i % 2:
                    b = (b + sign * self._round(i, a)) % self.right
                else:
                    a = (a + sign * self._round(i, b)) % self.left
            x = a * self.right + b
            if x < self.size:
                return x

    def __call__(self, x: int) -> int:
        return self._walk((self._walk(x, False) + 1) % self.size, True)


def luhn(digits: str) -> int:
    """The check digit to append to some digits."""
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _refill(spelling: str, digits: str) -> str:
    """The spelling with its digits replaced in turn."""
    turn = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(turn), spelling)


def _number(digits: str, valid: Callable[[str], bool], permute: Permutation) -> str:
    x = int(digits)
    while True:
        x = permute(x)
        if valid(out := str(x).zfill(len(digits))):
            return out


def _phone_ok(d: str) -> bool:
    return d[0] in "23456789" and d[3] in "23456789"


def _ssn_ok(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


#: No value starts inside a word or number, nor at a group of thousands after a comma.
_START = r"(?<![\w.@+-])(?!(?<=\d,)\d{3}(?![\d.-]))"
_SPELLINGS = {
    "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "iban": r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?",
    "iso": r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}",
    "day": r"\d{1,2}[-/.]\d{1,2}[-/.]\d{4}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "card": r"\d(?:[ -]?\d){12,18}",
    "intl": r"\+[2-9]\d{0,2}[ .-]?(?:\(?\d{1,4}\)?[ .-]?){2,5}\d{2,4}",
    "phone": r"(?:\+?1[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}",
}
_ONE = {kind: re.compile(rf"{_START}(?:{form})(?![\w@])", re.A) for kind, form in _SPELLINGS.items()}
_FORMS = re.compile(
    rf"""{_START}(?:{"|".join(f"(?P<{kind}>{form})" for kind, form in _SPELLINGS.items())})(?![\w@])"""
    r"""|(?<=[\s(,;:"'])(?P<plus>\+1[ .-]?(?:\(\d{3}\)[ ]?|\d{3}[ .-]?)\d{3}[ .-]?\d{4})(?!\w)""",
    re.A,
)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}")
_SECRET = re.compile(r"""(?i:(?:token|secret|passw(?:or)?d|api[_-]?key|key)["']?\s{0,3}[:=]\s{0,3})["']?([0-9a-fA-F]{24,128})(?![0-9a-zA-Z])""")
_MAY_HOLD = re.compile(r"[0-9](?:[^A-Za-z\n]?[0-9]){5}|[0-9][-/.][0-9]{1,2}[-/.][0-9]", re.A)


def _groupings(kind: str, value: str) -> list[str]:
    """What a found value may be without its last groups: cards by their fewest digits first, others longest first."""
    if kind not in ("card", "iban", "intl"):
        return [value]
    found = [value[: m.start()] for m in re.finditer(r"(?<=[0-9A-Z)])[ .-]", value)] + [value]
    return found if kind == "card" else found[::-1]


def _looks_like_card(value: str) -> bool:
    """One run of digits, or an issuer's number in the groups usual on cards."""
    sizes = [len(g) for g in re.split("[ -]", value)]
    usual = sizes in ([4, 6, 4], [4, 6, 5]) or max(sizes) == 4 and set(sizes[:-1]) == {4}
    return len(sizes) == 1 or usual and not (" " in value and "-" in value) and bool(re.match("[3-6]|2[2-7]", value))


class Pseudonyms:
    """of() a found value by its kind: its pseudonym, or None where it isn't valid."""

    def __init__(self, key: bytes):
        self.key, self.made, self.known = key, {}, {}

    def permute(self, kind: str, size: int) -> Permutation:
        if (kind, size) not in self.made:
            self.made[kind, size] = Permutation(self.key, kind, size)
        return self.made[kind, size]

    def of(self, kind: str, value: str) -> str | None:
        if (kind, value) not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[kind, value] = getattr(self, f"_{kind}")(value)
        return self.known[kind, value]

    def _ip(self, v: str) -> str | None:
        parts = list(map(int, v.split(".")))
        if max(parts) > 255 or v in ("0.0.0.0", "127.0.0.1", "255.255.255.255"):
            return None
        if any(len(p) > 1 and p[0] == "0" for p in v.split(".")):
            return None
        ranges = [((0, 10), (10, 90), (100, 156))[len(p) - 1] for p in v.split(".")]
        x, size = 0, 1
        for n, (low, wide) in zip(parts, ranges):
            x, size = x * wide + n - low, size * wide
        permute = self.permute("ip" + "".join(str(len(p)) for p in v.split(".")), size)
        while True:
            y = x = permute(x)
            out = []
            for low, wide in reversed(ranges):
                y, n = divmod(y, wide)
                out.append(low + n)
            if (0 < out[-1] < 224 and out[-1] != 127) == (0 < parts[0] < 224 and parts[0] != 127):
                return ".".join(map(str, reversed(out)))

    def _card(self, v: str) -> str | None:
        digits = re.sub(r"\D", "", v)
        if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or not digits.strip("0"):
            return None
        body = _number(digits[1:-1], lambda d: True, self.permute("card", 10 ** (len(digits) - 2)))
        return _refill(v, digits[0] + body + str(luhn(digits[0] + body)))

    def _ssn(self, v: str) -> str | None:
        digits = v.replace("-", "")
        return _refill(v, _number(digits, _ssn_ok, self.permute("ssn", 10**9))) if _ssn_ok(digits) else None

    def _phone(self, v: str) -> str | None:
        digits = re.sub(r"\D", "", v)
        head, own = digits[:-10], digits[-10:]
        valid = _phone_ok
        if v[0] == "+" or "(" in v:  # the spelling says that it is a phone, whatever its area code begins with
            valid = lambda d: d[3] in "23456789" and (d[0] in "01") == (own[0] in "01")
        return _refill(v, head + _number(own, valid, self.permute("phone", 10**10))) if valid(own) else None

    _plus = _phone

    def _intl(self, v: str) -> str | None:
        code = re.match(r"\+(\d{1,3})(?=\D)|\+(\d{2})", v)
        head = code[1] or code[2]
        own = re.sub(r"\D", "", v)[len(head) :]
        if not 6 <= len(own) <= 13:
            return None
        return _refill(v, head + _number(own, lambda d: (d[0] == "0") == (own[0] == "0"), self.permute("intl", 10 ** len(own))))

    def _iban(self, v: str) -> str | None:
        packed = v.replace(" ", "")
        if not 15 <= len(packed) <= 34 or mod97(packed[4:] + packed[:4]) != 1:
            return None
        digits = re.sub(r"\D", "", packed[4:])
        if not digits:
            return None
        body = _refill(packed[4:], _number(digits, lambda d: True, self.permute("iban", 10 ** len(digits))))
        out = packed[:2] + f"{98 - mod97(body + packed[:2] + '00'):02d}" + body
        turn = iter(out)
        return "".join(" " if c == " " else next(turn) for c in v)

    def _date(self, v: str, order: tuple[int, int, int]) -> str | None:
        fields = re.findall(r"\d+", v)
        gaps = re.findall(r"\D", v)
        year, month, day = (int(fields[i]) for i in order)
        if gaps[0] != gaps[1] or not (1900 <= year <= 2099 and 1 <= month <= 12 and 1 <= day <= calendar.monthrange(year, month)[1]):
            return None
        first, wide = datetime.date(1900, 1, 1).toordinal(), [len(f) for f in fields]
        n = datetime.date(2099, 12, 31).toordinal() - first + 1
        x = datetime.date(year, month, day).toordinal() - first
        padded = all(len(f) == 2 or i == order[0] for i, f in enumerate(fields)) and any(f[0] == "0" for f in fields) or min(wide) == 2
        while True:
            x = self.permute("date", n)(x)
            new = datetime.date.fromordinal(first + x)
            out = ["", "", ""]
            for i, part in zip(order, (new.year, new.month, new.day)):
                out[i] = str(part).zfill(wide[i] if padded else 1)
            if padded or all(len(a) == w for a, w in zip(out, wide)):
                return gaps[0].join(out)

    def _iso(self, v: str) -> str | None:
        return self._date(v, (0, 1, 2))

    def _day(self, v: str) -> str | None:
        return self._date(v, (2, 1, 0)) or self._date(v, (2, 0, 1))

    def _spelled(self, kind: str, v: str, classes: tuple[str, ...]) -> str:
        """Each character of v permuted within its class, all of them at once."""
        of = [next((c for c in classes if x in c), None) for x in v]
        size, x = 1, 0
        for c, ch in zip(of, v):
            if c:
                x, size = x * len(c) + c.index(ch), size * len(c)
        shape = "".join(str(classes.index(c)) if c else "-" for c in of)
        x = self.permute(f"{kind}{shape}", size)(x) if size > 1 else x
        out = list(v)
        for i in reversed(range(len(v))):
            if of[i]:
                x, k = divmod(x, len(of[i]))
                out[i] = of[i][k]
        return "".join(out)

    _CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")

    def _email(self, v: str) -> str | None:
        local, _, host = v.rpartition("@")
        return f"{self._spelled('email@' + host.lower(), local, self._CLASSES)}@{host}" if re.search(r"[A-Za-z0-9]", local) else None

    def _secret(self, v: str) -> str | None:
        hexes = ("0123456789abcdef",) if v == v.lower() else ("0123456789ABCDEF",) if v == v.upper() else self._CLASSES
        return self._spelled("secret", v, hexes)

    def _sure(self, text: str, at: int) -> tuple[tuple[str, str] | None, str | None]:
        """Kind and spelling of the value that starts at a place, and the card there that doesn't look like one."""
        odd = None
        for kind, form in _ONE.items():
            m = form.match(text, at)
            for v in _groupings(kind, m[0]) if m else ():
                if self.of(kind, v) is None:
                    continue
                if kind != "card" or _looks_like_card(v):
                    return (kind, v), odd
                odd = odd or v
        return None, odd

    def values(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        """Start, end, kind and spelling of valid values; where none is at a place, the search goes on right behind it."""
        at = 0
        while m := _FORMS.search(text, at):
            start = m.start()
            if m.lastgroup == "plus":
                found = ("plus", m[0]) if self.of("plus", m[0]) is not None else None
            else:
                found, odd = self._sure(text, start)
                if not found and odd and not any(self._sure(text, start + g.start())[0] for g in re.finditer(r"(?<=[ -])\d", odd)):
                    found = ("card", odd)
            at = start + (len(found[1]) if found else 1)
            if found:
                yield start, at, *found

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        found: list[tuple[int, int, str, str]] = []
        if "@" in text:
            found += [(m.start(), m.end(), "email", m[0]) for m in _EMAIL.finditer(text)]
        if _MAY_HOLD.search(text):
            found += self.values(text)
        if "=" in text or ":" in text:
            found += [(m.start(1), m.end(1), "secret", m[1]) for m in _SECRET.finditer(text)]
        if not found:
            return text, {}
        out, at, counts = [], 0, {}
        for start, end, kind, value in sorted(found, key=lambda f: (f[0], -f[1])):
            new = self.of(kind, value) if start >= at else None
            if new is not None:
                out += [text[at:start], new]
                at = end
                counts[kind] = counts.get(kind, 0) + 1
        return "".join([*out, text[at:]]), counts


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, n_found, kinds for every row of docs, the text with pseudonyms in place of personal data.

    Found are e-mail addresses (the local part), IPv4 addresses, payment card numbers, IBANs, US social security
    numbers, phone numbers, dates from 1900 to 2099 and hexadecimal secrets. Numbers that don't validate stay as they
    are. kinds counts the values by kind. Null text stays null, empty stays empty, both with nothing found; an empty
    table gives an empty result; other columns aren't read. The same key gives the same pseudonyms everywhere.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key.encode())
        for batch, got in slices(batches):
            done = [names.text(t.decode()) if t is not None else (None, {}) for t in got]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array([t for t, _ in done], pa.string()),
                    pa.array([sum(c.values()) for _, c in done], pa.int64()),
                    pa.array([list(c.items()) for _, c in done], pa.map_(pa.string(), pa.int64())),
                ],
                ["doc_id", "text", "n_found", "kinds"],
            )

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, text string, n_found long, kinds map<string,long>")
