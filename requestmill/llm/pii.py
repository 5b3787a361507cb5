"""Format-preserving pseudonyms of personal data by a keyed Feistel network.

A value is validated, read as a number within the set of all valid values of its format, permuted
there, and written in its own layout. Equal values get equal pseudonyms in all documents,
different ones different pseudonyms, and the key's holder can undo it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestmill.llm.common import sliced

ROUNDS = 10
BLOCK = 60  # symbols that are permuted as one number
REMEMBERED, LONG = 50_000, 200  # values, and characters of those that are not remembered
FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days
LETTERS = "abcdefghijklmnopqrstuvwxyz"


class Feistel:
    """Keyed permutation of 0 .. size - 1 for any size, by walking a cycle back into range."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: bytes, n: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        found, block = b"", 0
        while len(found) < size:
            said = b"%b|%d|%d|%d|%x" % (tweak, bits, n, block, half)
            found += blake2b(said, key=self.key, digest_size=64).digest()
            block += 1
        return int.from_bytes(found[:size], "big") & ((1 << bits) - 1)

    def _walk(self, x: int, size: int, tweak: bytes, rounds: range) -> int:
        if size < 2:
            return x
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        tweak = b"%b|%d" % (tweak, size)
        while True:
            left, right = x >> bits, x & mask
            for n in rounds:
                left, right = right, left ^ self._round(tweak, n, right, bits)
            x = right << bits | left  # halves swapped: the same walk backwards undoes it
            if x < size:
                return x

    def forward(self, x: int, size: int, tweak: bytes) -> int:
        return self._walk(x, size, tweak, range(ROUNDS))

    def backward(self, x: int, size: int, tweak: bytes) -> int:
        return self._walk(x, size, tweak, range(ROUNDS - 1, -1, -1))


@dataclass(frozen=True)
class Walk:
    """A key's permutations in one direction."""

    feistel: Feistel
    backward: bool = False

    def __call__(self, x: int, size: int, tweak: bytes) -> int:
        return (self.feistel.backward if self.backward else self.feistel.forward)(x, size, tweak)


def permuted(values: list[int], sizes: list[int], walk: Walk, tweak: bytes) -> list[int]:
    """Symbols, each below its size, permuted as one number, or in blocks where there are many.

    Blocks are chained from left to right and then back, so each depends on all others. The time is
    linear in the number of symbols, and no number has more than ``BLOCK`` of them.
    """
    if len(values) <= BLOCK:
        return _block(values, sizes, walk, tweak)
    if len(tweak) > 64:
        tweak = blake2b(tweak, digest_size=32).digest()
    cuts = [slice(k, k + BLOCK) for k in range(0, len(values), BLOCK)]
    blocks, bounds = [values[c] for c in cuts], [sizes[c] for c in cuts]
    count = len(blocks)

    def step(k: int, beside: int, turn: bytes) -> None:
        other = repr(blocks[beside]).encode() if 0 <= beside < count else b""
        own = b"%b|%b|%d|%d|" % (tweak, turn, k, count)
        blocks[k] = _block(blocks[k], bounds[k], walk, own + blake2b(other, digest_size=16).digest())

    # a block's neighbour is one that the same pass has been through, so the way back knows it, too
    passes = [(range(count), -1, b"there"), (range(count - 1, -1, -1), 1, b"back")]
    if walk.backward:
        passes = [(order[::-1], off, turn) for order, off, turn in reversed(passes)]
    for order, off, turn in passes:
        for k in order:
            step(k, k + off, turn)
    return [v for b in blocks for v in b]


def _block(values: list[int], sizes: list[int], walk: Walk, tweak: bytes) -> list[int]:
    x, size = 0, 1
    for v, s in zip(values, sizes, strict=True):
        x, size = x * s + v, size * s
    x = walk(x, size, tweak)
    out = []
    for s in reversed(sizes):
        x, v = divmod(x, s)
        out.append(v)
    return out[::-1]


def luhn_digit(digits: str) -> int:
    """The check digit behind ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2 == 0:
            d = d * 2 - 9 * (d > 4)
        total += d
    return -total % 10


def _filled(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in layout)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _plain_digits(text: str, walk: Walk, kind: bytes) -> str:
    digits = [int(c) for c in _digits(text)]
    return _filled(text, "".join(map(str, permuted(digits, [10] * len(digits), walk, kind))))


def _number(text: str, walk: Walk) -> str:
    """Payment card numbers keep a valid check digit; other long numbers are permuted whole."""
    digits = _digits(text)
    if len(digits) > 19 or luhn_digit(digits[:-1]) != int(digits[-1]):
        # valid numbers are permuted among themselves, so these must be, too
        n = len(digits)
        if len(digits) > 19:
            return _plain_digits(text, walk, b"number")
        stem, last = int(digits[:-1]), int(digits[-1])
        off = (last - luhn_digit(digits[:-1])) % 10 - 1
        x = walk(stem * 9 + off, 9 * 10 ** (n - 1), b"number")
        stem_text = str(x // 9).zfill(n - 1)
        return _filled(text, stem_text + str((luhn_digit(stem_text) + x % 9 + 1) % 10))
    stem = str(walk(int(digits[:-1]), 10 ** (len(digits) - 1), b"card")).zfill(len(digits) - 1)
    return _filled(text, stem + str(luhn_digit(stem)))


def _phone_class(own: str) -> tuple[bool, bool]:
    """What patterns ask of a number: North American or not, a zero in front or not."""
    return bool(re.fullmatch("[2-9][0-9]{2}[2-9][0-9]{6}", own)), own[:1] == "0"


def _phone(text: str, walk: Walk) -> str:
    """Country code and trunk zero stay; the last ten digits, or all of fewer, are permuted.

    Numbers of one class are permuted among themselves, so that each is found again.
    """
    digits = _digits(text)
    code = re.match(r"\+([0-9]{1,3})(?=[ .(-])", text)
    first = len(code[1]) if code else 0
    first += digits[first : first + 1] == "0"
    own = min(10, len(digits) - first)
    kept, own_digits = digits[:-own], digits[-own:]
    wanted, x = _phone_class(own_digits), int(own_digits)
    while True:
        x = walk(x, 10**own, b"phone")
        new = str(x).zfill(own)
        if _phone_class(new) == wanted:
            return _filled(text, kept + new)


def _address(text: str, walk: Walk) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    x = walk(int.from_bytes(bytes(parts), "big"), 1 << 32, b"ipv4")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _social(text: str, walk: Walk) -> str | None:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = (int(p) for p in re.split("[- ]", text))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x = walk(x, 898 * 99 * 9999, b"ssn")
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return _filled(text, f"{area + 1 + (area > 664):03d}{group + 1:02d}{serial + 1:04d}")


# Lengths of the IBAN registry.
IBAN_LENGTHS = {
    said[:2]: int(said[2:])
    for said in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 "
        "DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 "
        "IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 "
        "MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
        "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}


def _iban_ends(text: str) -> list[int]:
    """Where an IBAN at the start of ``text`` may end: at its country's length, else the longest first."""
    ends, count = [], 0
    for k, c in enumerate(text, 1):
        count += c != " "
        if c != " " and (k == len(text) or text[k] == " "):
            ends.append((k, count))
    length = IBAN_LENGTHS.get(text[:2])
    if length:
        return [k for k, count in ends if count == length]
    return [k for k, count in reversed(ends) if count > 11]


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _iban(text: str, walk: Walk) -> str | None:
    flat = text.replace(" ", "")
    country, check, rest = flat[:2], flat[2:4], flat[4:]
    if f"{_iban_check(country, rest):02d}" != check:
        return None
    rest = _mixed(rest, walk, b"iban" + country.encode())
    flat = f"{country}{_iban_check(country, rest):02d}{rest}"
    new = iter(flat)
    return "".join(c if c == " " else next(new) for c in text)


def _mixed(text: str, walk: Walk, kind: bytes) -> str:
    """Digits stay digits, ASCII letters stay letters of their case, the rest stays."""

    def alphabet(c: str) -> str:
        if c in "0123456789":
            return "0123456789"
        return LETTERS if c in LETTERS else LETTERS.upper() if c in LETTERS.upper() else ""

    sets = [alphabet(c) for c in text]
    shape = "".join("9" if s[:1] == "0" else s[:1] or c for c, s in zip(text, sets, strict=True))
    values = [s.index(c) for c, s in zip(text, sets, strict=True) if s]
    sizes = [len(s) for s in sets if s]
    tweak = kind + b"|" + shape.encode("utf-8", "surrogatepass")
    new = iter(permuted(values, sizes, walk, tweak))
    return "".join(s[next(new)] if s else c for c, s in zip(text, sets, strict=True))


def _email(text: str, walk: Walk) -> str:
    local, _, domain = text.rpartition("@")
    return f"{_mixed(local, walk, b'email')}@{domain}"


def _secret(text: str, walk: Walk) -> str:
    """Hexadecimal secrets stay hexadecimal."""
    for digits in ("0123456789abcdef", "0123456789ABCDEF"):
        if set(text) <= set(digits):
            values = [int(c, 16) for c in text]
            return "".join(digits[v] for v in permuted(values, [16] * len(text), walk, b"hex"))
    return _mixed(text, walk, b"secret")


def _day(year: str, month: str, day: str) -> int | None:
    try:
        n = (date(int(year), int(month), int(day)) - FIRST_DAY).days
    except ValueError:
        return None
    return n if 0 <= n < DAYS else None


def _date(text: str, walk: Walk) -> str | None:
    """Year first; else day or month first, whichever is a date, day first if both are."""
    a, b, c = re.split(r"[-/.]", text)
    layouts = ["ymd"] if len(a) == 4 else ["mdy", "dmy"] if "/" in text else ["dmy", "mdy"]
    for layout in layouts:
        part = dict(zip(layout, (a, b, c), strict=True))
        n = _day(part["y"], part["m"], part["d"])
        if n is None:
            continue
        # in "mdy" layouts a new day above 12 could be read only one way; both ways are kept
        # apart, so that the way back is known: days up to 12 stay up to 12
        low = layout == "ymd" or int(part["d"]) > 12
        fits = lambda d: layout == "ymd" or (d.day > 12) == low
        while True:
            n = walk(n, DAYS, b"date" + layout.encode())
            new = FIRST_DAY + timedelta(days=n)
            if fits(new):
                break
        said = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        seps = [s for s in text if s in "-/."]
        return said[layout[0]] + seps[0] + said[layout[1]] + seps[1] + said[layout[2]]
    return None


# An e-mail address is looked for from its @ outwards.
LOCAL_END, DOMAIN = "\"'(),;:|<>[]@", re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PATTERNS: list[tuple[str, str, Callable[[str, Walk], str | None]]] = [
    (
        "secret",
        r"(?<=\")[0-9A-Za-z_\-]{20,}(?=\")|"
        r"(?<![0-9A-Za-z])(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}(?![0-9A-Za-z])",
        _secret,
    ),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?!\w)", _iban),
    (
        "phone",
        r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?![\w-])|"
        # the digits of an international number are counted, as its groups are of any size
        r"(?<![\w.])\+(?=\d(?:[ .-]?\d){7,14}(?![\w-]|[ .]\d))\d{1,3}(?:[ .-]?\d{1,4}){2,7}(?![\w-])|"
        r"(?<![\w.])\+33[ .-]?[1-9](?:[ .-]?\d{2}){4}(?![\w-])|"
        r"(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\w-])|"
        r"(?<![\w.-])(?:1[-. ])?\d{3}([-. ])\d{3}\1\d{4}(?![\w-])|"
        r"(?<![\w.-])1[-. ]\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?![\w-])|"
        r"(?<![\w.,/-])[2-9]\d{2}[2-9]\d{6}(?![\w/-]|[.,]\d)|"
        # national ones with a trunk zero: nine to eleven digits in all, no social security number
        r"(?<![\w.,/-])(?!\d{3}-\d{2}-\d{4}(?!\d))(?!\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.))"
        r"(?=0(?:[ .-]?\d){8,10}(?![\w-]|[ .]\d))0[1-9]\d{0,3}(?:([ .-]?)\d{2,8})(?:\2\d{2,4}){0,3}(?![\w-])",
        _phone,
    ),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _social),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", _address),
    (
        "date",
        r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/-]|\.\d)",
        _date,
    ),
    (
        "number",
        r"(?<![\w-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])|"
        r"(?<!\d)\d{13,}(?!\d)",
        _number,
    ),
]


def _numbered(pattern: str, first: int) -> str:
    """Back references of a pattern whose groups start at ``first``."""
    return re.sub(r"\\([1-9])", lambda m: f"\\{first + int(m[1]) - 1}", pattern)


def _compiled() -> re.Pattern:
    """One pattern of all kinds; a kind is known by its group's name."""
    parts, groups = [], 1
    for name, pattern, _ in PATTERNS:
        # the digit class stands for ASCII digits here; others are not personal numbers
        pattern = pattern.replace(r"\d", "[0-9]")
        parts.append(f"(?P<{name}>{_numbered(pattern, groups + 1)})")
        groups += 1 + re.compile(pattern).groups
    return re.compile("|".join(parts))


class Pseudonymizer:
    def __init__(self, key: bytes, backward: bool = False):
        self.walk = Walk(Feistel(key), backward)
        self.pattern = _compiled()
        self.kinds = {name: make for name, _, make in PATTERNS} | {"email": _email}
        self.each = {name: re.compile(p.replace(r"\d", "[0-9]")) for name, p, _ in PATTERNS}
        self.known: dict[tuple[str, str], str | None] = {}
        self.any = re.compile(r"[0-9@]|\"[A-Za-z_\-]{20}")

    def value(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None where the value is not valid."""
        if len(text) > LONG:
            return self.kinds[kind](text, self.walk)
        if (kind, text) not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[kind, text] = self.kinds[kind](text, self.walk)
        return self.known[kind, text]

    def _ibans(self, text: str) -> tuple[int, str | None]:
        """(end, pseudonym) of the IBAN that ``text`` starts with; the end alone if its check fails."""
        for end in _iban_ends(text):
            if (new := self.value("iban", text[:end])) is not None:
                # for a country without a length, so that the way back finds the same end
                while text[:2] not in IBAN_LENGTHS and self._end(new + text[end:]) != end:
                    new = self.value("iban", new)
                return end, new
        return (_iban_ends(text)[:1] or [0])[0] if text[:2] in IBAN_LENGTHS else 0, None

    @staticmethod
    def _end(text: str) -> int:
        flat = ((k, text[:k].replace(" ", "")) for k in _iban_ends(text))
        return next((k for k, f in flat if f"{_iban_check(f[:2], f[4:]):02d}" == f[2:4]), 0)

    def _at(self, text: str, m: re.Match) -> tuple[int, str | None, str]:
        """(end, pseudonym, kind) of the first kind that has a valid value where ``m`` starts.

        Without one, the end is where to go on: behind what has the shape of one whole IBAN of its
        country, else one character further, for kinds begin at borders of words.
        """
        after = m.start() + 1
        for kind, pattern in self.each.items():
            if not (found := m if kind == m.lastgroup else pattern.match(text, m.start())):
                continue
            if kind == "iban":
                size, new = self._ibans(found[0])
                end = found.start() + size
                if new is None and size:
                    after = end
            else:
                end, new = found.end(), self.value(kind, found[0])
            if new is not None:
                return end, new, kind
        return after, None, ""

    def replaced(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The new text, and (start, end, kind) of each replaced value in the old one."""
        if not self.any.search(text):
            return text, []
        spans: list[tuple[int, int, str]] = []
        out: list[str] = []
        done = 0
        at = 0
        mail = _next_mail(text, 0)
        m = self.pattern.search(text)
        while mail or m:
            if mail and mail[0] < at:  # what lies before was replaced as something else
                mail = _next_mail(text, at)
            elif mail and (not m or mail[0] <= m.start()):
                start, at = mail
                out += [text[done:start], self.value("email", text[start:at])]
                spans.append((start, at, "email"))
                done = at
                mail = _next_mail(text, at)
                m = self.pattern.search(text, at) if m and m.start() < at else m
            elif m:
                start = m.start()
                at, new, kind = self._at(text, m)
                m = self.pattern.search(text, at)
                if new is not None:
                    out += [text[done:start], new]
                    spans.append((start, at, kind))
                    done = at
        return "".join([*out, text[done:]]), spans


def _next_mail(text: str, at: int) -> tuple[int, int] | None:
    """(start, end) of the first e-mail address from ``at`` on."""
    sign = text.find("@", at)
    while sign >= 0:
        start = sign
        while start > at and not (text[start - 1] in LOCAL_END or text[start - 1].isspace()):
            start -= 1
        if start < sign and (found := DOMAIN.match(text, sign)):
            return start, found.end()
        sign = text.find("@", sign + 1)
    return None


def _replace_batches(key: bytes, backward: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonymizer(key, backward)
        for batch in sliced(batches):
            at = batch.schema.get_field_index("text")
            found = [
                (None, None) if t is None else own.replaced(t)
                for t in batch.column(at).to_pylist()
            ]
            columns = list(batch.columns)
            columns[at] = pa.array([f[0] for f in found], pa.string())
            spans = [
                [{"start": a, "end": b, "kind": k} for a, b, k in f[1] or []] for f in found
            ]
            kind = pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
            )
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(spans, kind)], [*batch.schema.names, "__llm_spans"]
            )

    return run


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("kind", T.StringType()),
        ]
    )
)


def pseudonyms(docs: DataFrame, key: bytes, backward: bool = False) -> DataFrame:
    """``docs`` with new texts and a column __llm_spans of what was replaced in the old ones.

    All other columns pass through, whatever their names. A null text stays null, an empty one empty,
    values that are not valid stay as they are. Rows given twice give equal rows, an
    empty table none. Nothing is shuffled. ``backward`` restores the values.
    """
    rows = docs.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*rows.schema.fields, T.StructField("__llm_spans", SPANS)])
    return rows.mapInArrow(_replace_batches(key, backward), schema)
