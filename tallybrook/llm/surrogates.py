"""Personal data replaced by surrogates of the same type, gender, script and format.

A surrogate is a keyed permutation of its entity within the entity's own format: digits become
digits, vowels vowels of the same script, checksums are made anew. Being a permutation, it gives
one entity the same surrogate in every text and two entities different ones, without a table.
What it may still do is hit a value that some text really holds. These cases are found over the
distinct entities of the corpus and drawn again until the surrogates are apart from each other
and from the originals; only entities drawn again have to be joined to their texts. Names are
drawn part by part, so that a family name has one surrogate with and without a given name.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import slices, stored, texts_of, unused

KEY = "surrogate key"
# A format with fewer values than this many for each of its originals is full: there the first
# draw stays. In any other every draw is apart from all others with even chances at least.
ROOM = 4
_ROUNDS = 8

# Letters are replaced within their group; other characters stay.
LETTERS = (
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "áéíóúàèìòùäöüâêîôûåæøœãõąęěůűő",
    "çñşšžčćđğłńśźżřťďň",
    "аеиоуыэюя",
    "бвгджзклмнпрстфхцчшщ",
    "іїєўґђљњћџ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
    "άέήίόύώ",
)
# Letters of scripts without cases are replaced within their range of code points.
RANGES = (
    ("Hebrew", 0x05D0, 0x05EA),
    ("Arabic", 0x0627, 0x063A),
    ("Arabic", 0x0641, 0x064A),
    ("Devanagari", 0x0915, 0x0939),
    ("Thai", 0x0E01, 0x0E2E),
    ("Hiragana", 0x3042, 0x3093),
    ("Katakana", 0x30A2, 0x30F3),
    ("Han", 0x4E00, 0x9FA5),
    ("Hangul", 0xAC00, 0xD7A3),
)
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Monsieur", "Signor"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Signora"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    ("latin", "m"): ("James", "John", "Robert", "Michael", "David", "Thomas", "Peter", "Daniel", "Carlos", "Pierre"),
    ("latin", "f"): ("Mary", "Linda", "Susan", "Sarah", "Karen", "Anna", "Laura", "Julia", "Carmen", "Claire"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Сергей", "Андрей", "Дмитрий", "Николай"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна"),
}


class Entity(NamedTuple):
    """A kind of personal data, where it stands, and its value without format."""

    kind: str
    start: int
    end: int
    value: str


def luhn(digits: str) -> int:
    """The sum that a card number's digits must have a multiple of ten of."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total


def iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


_CARD = re.compile(
    r"(?<!\d)(?:\d{13,19}|\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{6}\1\d{4,5}))(?!\d)"
)
_IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
# With a country code 8 to 15 digits in groups; else what a country writes: (3) 3-4, 3-3-4,
# an area code with its zero and 5 to 8 digits, or the eleven digits of a mobile number.
_PHONE = re.compile(
    r"(?<![\w+])(?:\+\d{1,3}(?:[ ./-]?\(\d{1,4}\))?(?:[ .-]?\d{1,15}){1,7}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}([ .-])\d{3}\1\d{4}"
    r"|\(?[0٠۰]\d{2,4}\)?[ /-]\d{3,4}[ -]?\d{2,4}|1[3-9]\d{9})(?![\w-]|\.\d)"
)
_PHONE_DIGITS = range(8, 16)
_EMAIL = re.compile(
    r"(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@(?:[\w-]+\.)+(?:xn--[A-Za-z0-9-]+|[^\W\d_]{2,})(?![\w-])"
)
_IBAN = re.compile(
    r"(?<!\w)[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)"
)
_BIG = "A-ZÀ-ÖØ-ÞĄĆČĎĐĘĚĞŁŃŇŐŒŘŚŞŠŤŮŰŹŻŽЀ-ЯҐΆΈΉΊΌΎΏΑ-Ω"
_CAPITAL = rf"(?:[{_BIG}]['’])?[{_BIG}]\w+(?:['’-][{_BIG}]\w+)*"
_NAME = re.compile(
    rf"(?<!\w)(?:(?P<title>{'|'.join(t for ts in TITLES.values() for t in ts)})\.? (?P<full>{_CAPITAL}(?: {_CAPITAL})?)"
    rf"|(?P<given>(?:{'|'.join(n for ns in GIVEN.values() for n in ns)}) {_CAPITAL}))(?!\w)"
)


def _gender(name: str, title: str | None) -> str:
    for (_, gender), names in GIVEN.items():
        if name.split(" ")[0] in names:
            return gender
    return next((g for g, ts in TITLES.items() if title in ts), "n")


def _plain(c: str) -> str:
    return str(unicodedata.decimal(c)) if c.isdecimal() else c


def _digits(text: str) -> str:
    """The decimal digits of any script, as ASCII ones."""
    return "".join(_plain(c) for c in text if c.isdecimal())


def _numbers(text: str) -> Iterator[Entity]:
    for m in _IBAN.finditer(text):
        shown = m[0]
        while iban_rest(shown.replace(" ", "")) != 1 and " " in shown:
            shown = shown.rsplit(" ", 1)[0]  # the last group may be a word that follows
        value = shown.replace(" ", "")
        if len(value) >= 15 and iban_rest(value) == 1:
            yield Entity("iban", m.start(), m.start() + len(shown), value)
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if luhn(digits) % 10 == 0 and digits.strip("0"):
            yield Entity("card", *m.span(), digits)
    for m in _IP.finditer(text):
        if all(int(p) < 256 for p in m[0].split(".")):
            yield Entity("ip", *m.span(), ".".join(str(int(p)) for p in m[0].split(".")))
    for m in _IP6.finditer(text) if text.count(":") > 1 else ():
        groups = [g for g in m[0].split(":") if g]
        try:
            value = ipaddress.IPv6Address(m[0]).exploded
        except ValueError:
            continue
        if len(groups) > 2:  # two are as often names in a program
            yield Entity("ip6", *m.span(), value)
    for m in _SSN.finditer(text):
        yield Entity("ssn", *m.span(), _digits(m[0]))


def _phones(text: str, found: list[Entity]) -> Iterator[Entity]:
    """Telephone numbers; groups at the end that belong to what follows are left to it."""
    for m in _PHONE.finditer(text):
        shown, fits = m[0], []
        while True:
            end = m.start() + len(shown)
            if len(_digits(shown)) in _PHONE_DIGITS and not any(e.start < end and m.start() < e.end for e in found):
                fits.append(shown)
            shorter = re.sub(r"[ .-]\d+$", "", shown)
            if shorter == shown or shown[0] != "+":
                break
            shown = shorter
        if fits:
            # After +1 and +7 come ten digits; elsewhere the longest number is taken.
            ten = [f for f in fits if re.match(r"\+[17](?!\d\b|\d\d\b)", f) and len(_digits(f)) == 11]
            shown = (ten or fits)[0]
            # What says what kind of number it is stays: country code, zero, range of mobiles.
            prefix = r"\+\d{1,3}(?:[ ./-]?\(0\))?(?=\D|$)|\(?0|1[3-9](?=\d{9}$)"
            kept = re.match(prefix, "".join(map(_plain, shown)))
            digits, keep = _digits(shown), len(_digits(kept[0])) if kept else 0
            yield Entity("phone", m.start(), m.start() + len(shown), f"{digits[:keep]}+{digits[keep:]}")


def entities(text: str) -> list[Entity]:
    """What is found in a text: leftmost first, and of overlapping ones the first listed kind."""
    found: list[Entity] = []
    if "@" in text:
        found += [Entity("email", *m.span(), "".join(map(_lower, m[0]))) for m in _EMAIL.finditer(text)]
    if re.search(r"\d{2}|::", text) or _IP.search(text):
        found += _numbers(text)
        found += _phones(text, found)
    for m in _NAME.finditer(text):
        group = "full" if m["full"] else "given"
        found.append(Entity(f"name-{_gender(m[group], m['title'])}", *m.span(group), m[group]))
    taken, out = [], []
    whole = [e for e in found if e.kind.startswith("name")]
    for part, kind in {p: e.kind for e in whole for p in e.value.split(" ")}.items():
        # A part of a name that stands alone is the same person.
        for m in re.finditer(rf"(?<!\w){re.escape(part)}(?!\w)", text):
            found.append(Entity(kind, *m.span(), part))
    for e in found:  # kinds come in order of trust
        if not any(e.start < b and a < e.end for a, b in taken):
            taken.append((e.start, e.end))
            out.append(e)
    return sorted(out, key=lambda e: e.start)


def permuted(value: int, size: int, key: str, tweak: str) -> int:
    """A keyed permutation of ``range(size)``: a Feistel network, walked until it is in range."""
    if size < 2:
        return value
    half = ((size - 1).bit_length() + 1) // 2
    mask, secret = (1 << half) - 1, hashlib.blake2b(key.encode()).digest()
    while True:
        a, b = value >> half, value & mask
        for r in range(_ROUNDS):
            data = f"{tweak}|{r}|{b}".encode()
            mixed = hashlib.shake_256(secret + data).digest((half + 7) // 8)
            a, b = b, a ^ (int.from_bytes(mixed, "big") & mask)
        value = a << half | b
        if value < size:
            return value


def _lower(c: str) -> str:
    """The character in lower case, as it is where that would be several characters."""
    return c.lower() if len(c.lower()) == 1 else c


def _upper(c: str) -> str:
    return c.upper() if len(c.upper()) == 1 else c


@lru_cache(maxsize=1 << 16)
def _alphabet(c: str) -> str:
    if c.isascii() and c.isdigit():
        return "0123456789"
    if span := next((r for r in RANGES if r[1] <= ord(c) <= r[2]), None):
        return "".join(map(chr, range(span[1], span[2] + 1)))
    return next((group for group in LETTERS if _lower(c) in group), _lower(c))


def _shape(groups: list[str]) -> str:
    return ".".join(str(LETTERS.index(g)) if g in LETTERS else g[0] for g in groups)


def reshaped(text: str, key: str, tweak: str) -> str:
    """``text`` with all letters and digits permuted together, each within its own group."""
    groups, value, size = [_alphabet(c) for c in text], 0, 1
    for c, group in zip(text, groups, strict=True):
        value, size = value * len(group) + group.index(_lower(c)), size * len(group)
    # The format is part of the tweak, so that each has a permutation of its own.
    value, out = permuted(value, size, key, f"{tweak}|{_shape(groups)}"), []
    for c, group in zip(reversed(text), reversed(groups), strict=True):
        value, i = divmod(value, len(group))
        new = group[i] if len(group) > 1 else c
        out.append(_upper(new) if c.isupper() else new)
    return "".join(reversed(out))


def _ip_class(n: int) -> str:
    """Addresses are replaced within their class."""
    a, b = n >> 24, n >> 16 & 255
    if a == 10 or (a, b) == (192, 168) or a == 172 and 16 <= b < 32:
        return f"private {a}"
    return "special" if a in (0, 127) or a >= 224 else "public"


def surrogate(kind: str, value: str, key: str, draw: int = 0) -> str:
    """The surrogate of an entity's value; for each ``draw`` another permutation."""
    tweak = f"{kind}|{draw}"
    if kind == "email":
        local, domain = value.split("@")
        labels = domain.split(".")
        fixed = 2 if labels[-2:-1] == ["example"] else 1
        head = ".".join(labels[:-fixed])
        new = reshaped(f"{local}@{head}", key, f"{tweak}|{'.'.join(labels[-fixed:])}")
        return ".".join([new, *labels[-fixed:]]) if head else new + ".".join(labels[-fixed:])
    if kind == "card":
        body = value[0] + reshaped(value[1:-1], key, f"{tweak}|{value[0]}")
        return body + str(-luhn(body + "0") % 10)
    if kind == "ip":
        n = sum(int(p) << 24 - 8 * i for i, p in enumerate(value.split(".")))
        same, m = _ip_class(n), permuted(n, 1 << 32, key, tweak)
        while _ip_class(m) != same:
            m = permuted(m, 1 << 32, key, tweak)
        return ".".join(str(m >> s & 255) for s in (24, 16, 8, 0))
    if kind == "ip6":
        # Groups that are zero stay so, and the first one, which says what kind of address it is.
        first, *rest = (int(g, 16) for g in value.split(":"))
        zero, n, used = [g == 0 for g in rest], 0, [g for g in rest if g]
        for g in used:
            n = n * 0xFFFF + g - 1
        n = permuted(n, 0xFFFF ** len(used), key, f"{tweak}|{first}|{zero}")
        new = []
        for z in reversed(zero):
            n, g = (n, -1) if z else divmod(n, 0xFFFF)
            new.append(g + 1)
        return ":".join(f"{g:04x}" for g in [first, *reversed(new)])
    if kind == "iban":
        body = reshaped(value[4:].lower(), key, f"{tweak}|{value[:2]}").upper()
        return f"{value[:2]}{98 - iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        country, digits = value.split("+")  # a prefix that stays, and the rest
        return f"{country}+{reshaped(digits, key, f'{tweak}|{country}')}"
    if kind.startswith("name"):
        # Parts are replaced one by one, so that a family name alone stays the same person's.
        return " ".join(_name_part(p, key, draw) for p in value.split(" "))
    return reshaped(value, key, tweak)


def _name_part(part: str, key: str, draw: int) -> str:
    for (script, gender), names in GIVEN.items():
        if part in names:
            # A keyed ring of the names, in which each steps to another one.
            tweak, n = f"given|{script}|{gender}", len(names)
            ring = sorted(names, key=lambda x: permuted(names.index(x), n, key, tweak))
            return ring[(ring.index(part) + 1 + draw % (n - 1)) % n]
    # A replacement must not read as one of the given names, which others are replaced by.
    new, known = reshaped(part, key, f"name|{draw}"), {n for ns in GIVEN.values() for n in ns}
    while new in known:
        new = reshaped(new, key, f"name|{draw}")
    return new


def rendered(entity: Entity, original: str, value: str) -> str:
    """A surrogate's value in the format in which the original stands in the text."""
    if entity.kind in ("card", "ssn", "phone"):
        digits = iter(c for c in value if c.isdigit())
        # Digits of a script are followed by its others, from zero on.
        return "".join(
            chr(ord(c) - unicodedata.decimal(c) + int(next(digits))) if c.isdecimal() else c for c in original
        )
    if entity.kind == "iban":
        rest = iter(value)
        return "".join(c if c == " " else next(rest) for c in original)
    if entity.kind == "ip6":
        groups = [g if len(original) == 39 else f"{int(g, 16):x}" for g in value.split(":")]
        new = ipaddress.IPv6Address(value).compressed if "::" in original else ":".join(groups)
        return new.upper() if original != original.lower() else new
    if entity.kind == "email":
        return "".join(_upper(n) if o.isupper() else n for n, o in zip(value, original, strict=True))
    return value


def drawn_parts(e: Entity) -> list[tuple[str, str]]:
    """What is drawn for an entity: the parts of a name, one kind for all names, or its value."""
    return [("name", p) for p in e.value.split(" ")] if e.kind.startswith("name") else [(e.kind, e.value)]


def replaced(text: str, key: str, draws: dict[tuple[str, str], int] | None = None) -> str:
    out, at = [], 0
    for e in entities(text):
        value = " ".join(surrogate(k, v, key, (draws or {}).get((k, v), 0)) for k, v in drawn_parts(e))
        out += [text[at : e.start], rendered(e, text[e.start : e.end], value)]
        at = e.end
    return "".join([*out, text[at:]])


def _found(docs: DataFrame, text: str) -> DataFrame:
    """``kind, value, at``: the entities of every text, with the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = {
                (kind, value, at)
                for t, at in zip(texts_of(batch, text), batch.column("_at").to_pylist(), strict=True)
                for e in entities(t)
                for kind, value in drawn_parts(e)
            }
            columns = zip(*sorted(rows), strict=True) if rows else ((), (), ())
            kinds, values, ats = map(list, columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(ats, pa.int64())],
                ["kind", "value", "at"],
            )

    plain = docs.select(F.col(f"`{text}`").alias(text), F.xxhash64(f"`{text}`").alias("_at"))
    return plain.mapInArrow(run, "kind string, value string, at long")


def _drawn(table: DataFrame, key: str) -> DataFrame:
    """``table`` of ``kind, value, draw, settled`` with each one's surrogate as ``new``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "draw")), strict=True)
            new = pa.array([surrogate(k, v, key, d) for k, v, d in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, new], [*batch.schema.names, "new"])

    return table.mapInArrow(run, "kind string, value string, draw int, settled boolean, new string")


def format_of(kind: str, value: str) -> tuple[str, float]:
    """The format within which a value is replaced, and how many values it has."""
    fixed, free = "", value
    if kind == "email":
        local, domain = value.split("@")
        labels = domain.split(".")
        cut = -2 if labels[-2:-1] == ["example"] else -1
        fixed, free = ".".join(labels[cut:]), f"{local}@{'.'.join(labels[:cut])}"
    elif kind == "card":
        fixed, free = value[0], value[1:-1]
    elif kind == "ip":
        a, b, *_ = value.split(".")
        fixed, free = _ip_class(int(a) << 24 | int(b) << 16), "0" * 8
    elif kind == "ip6":
        first, *rest = value.split(":")
        zero = "".join("z" if g == "0000" else "x" for g in rest)
        return f"{first}|{zero}", float(0xFFFF ** zero.count("x"))
    elif kind == "iban":
        fixed, free = value[:2], value[4:].lower()
    elif kind == "phone":
        fixed, free = value.split("+")
    groups, size = [_alphabet(c) for c in free], 1.0
    for group in groups:
        size = min(size * len(group), 1e300)
    return f"{fixed}|{_shape(groups)}", size


def _in_full_formats(originals: DataFrame) -> DataFrame:
    """``kind, value`` of the entities whose format has no ``ROOM`` for surrogates apart from all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist(), strict=True)
            found = [format_of(k, v) for k, v in pairs]
            columns = [pa.array([f for f, _ in found], pa.string()), pa.array([n for _, n in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "format", "size"])

    formats = originals.mapInArrow(run, "kind string, value string, format string, size double")
    full = formats.groupBy("kind", "format").agg(F.count("*").alias("n"), F.min("size").alias("size"))
    return formats.join(full.where(F.col("n") * ROOM > F.col("size")).select("kind", "format"), ["kind", "format"]).select(
        "kind", "value"
    )


def drawn_again(found: DataFrame, key: str) -> DataFrame | None:
    """``kind, value, draw`` of the entities whose first surrogate won't do; None if there is none.

    A surrogate won't do if it is another entity's too, or an original of the corpus; entities are
    drawn until theirs does. Listed given names, and entities of formats that are full, keep their
    first surrogate, which no other entity's first one equals: these may read as originals do.
    """
    originals = stored(found.select("kind", "value").distinct(), "entities")
    listed = [n for names in GIVEN.values() for n in names]
    settled = F.col("kind").startswith("name") & F.col("value").isin(listed)
    table = originals.withColumns({"draw": F.lit(0), "settled": settled})
    taken = originals.select("kind", F.col("value").alias("new"), F.lit(True).alias("original"))
    shared = Window.partitionBy("kind", "new").orderBy(F.desc("settled"), "draw", "value")
    full = None
    while True:
        judged = stored(
            _drawn(table, key)
            .withColumn("turn", F.row_number().over(shared))
            .join(taken, ["kind", "new"], "left")
            .withColumn("bad", ~F.col("settled") & ((F.col("turn") > 1) | F.col("original").isNotNull())),
            "draws",
        )
        if judged.where("bad").isEmpty():
            break
        if full is None:
            full = stored(_in_full_formats(originals).withColumn("full", F.lit(True)), "full")
            judged = judged.join(full, ["kind", "value"], "left").withColumn(
                "settled", F.col("settled") | F.col("full").isNotNull()
            )
        again = F.when(F.col("settled"), 0).when(F.col("bad"), F.col("draw") + 1).otherwise(F.col("draw"))
        table = judged.select("kind", "value", again.alias("draw"), "settled")
    again = judged.where("draw > 0").select("kind", "value", "draw")
    return None if again.isEmpty() else again


def with_surrogates(docs: DataFrame, key: str = KEY, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced; one row per row, same columns.

    Null texts stay null, texts without personal data stay as they are. ``n_chars``, where there,
    is the new length of a text that changed. Rows with equal texts get equal ones; extra columns
    may have any name. No rows give no rows.
    """
    found = stored(_found(docs, text), "found")
    again = drawn_again(found, key)
    at, draws, new = (unused(docs, n) for n in ("at", "draws", "new"))
    rows = docs.withColumn(at, F.xxhash64(f"`{text}`"))
    if again is None:
        rows = rows.withColumn(draws, F.lit(None).cast("array<struct<kind:string,value:string,draw:int>>"))
    else:
        per_text = (
            found.join(again, ["kind", "value"])
            .groupBy(F.col("at").alias(at))
            .agg(F.collect_set(F.struct("kind", "value", "draw")).alias(draws))
        )
        rows = rows.join(per_text, at, "left")
    given = docs.columns
    types = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for t, drawn in zip(batch.column(text).to_pylist(), batch.column(draws).to_pylist(), strict=True):
                draw_of = {(d["kind"], d["value"]): d["draw"] for d in drawn or []}
                out.append(t if t is None else replaced(t, key, draw_of))
            columns = [
                pa.array(out, batch.schema.field(text).type) if c == text else batch.column(c) for c in given
            ]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(text)], [*given, new])

    schema = rows.select(*[f"`{c}`" for c in given]).schema.add(new, types[text].dataType)
    done = rows.select(*[f"`{c}`" for c in given], f"`{draws}`").mapInArrow(run, schema)
    if n_chars in given:
        length = F.length(f"`{text}`").cast(types[n_chars].dataType)
        changed = ~F.col(f"`{text}`").eqNullSafe(F.col(f"`{new}`"))
        done = done.withColumn(n_chars, F.when(changed, length).otherwise(F.col(f"`{n_chars}`")))
    return done.select(*[f"`{c}`" for c in given])
