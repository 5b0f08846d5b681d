"""Surrogates for personal data: keyed replacements that keep type, format, script and gender.

Detected entities are mail addresses, IP addresses, account numbers, card numbers, social security numbers, phone numbers,
and names after a title or another cue (a name label, an introduction, a salutation, a closing). The other mentions of such
a name in its document, in full or by the surname, are found without a cue. Not found are names that have no cue anywhere
in their document, and given names that stand alone.

An entity consists of parts: a name of given names and a surname, a mail address of its domain and the rest; all others
are one part. Each part gets a replacement drawn from a keyed hash of it, so the same part has the same replacement in
every entity and document that holds it, and nothing about it can be read off without the key. Given names follow the
gender of the title, letters stay in their script and case; separators, lengths, country codes and check digits stay valid.

All distinct parts of the corpus are held against each other, as they are read and whatever their gender: a part whose
replacement is that of another one, or is itself a real part of the corpus, draws again with the next number until no two
meet. A redrawn surname is redrawn in full names and alone. Names get longer with the number of their draw, mail addresses,
domains and phone numbers after several draws, so a corpus may hold more of them than there are short replacements; card,
account and social security numbers have one length, hence at most about 10^11, 10^11 and 10^9 replacements. Most parts
draw once, so documents are rewritten with the key and the few exceptions.

Defined cases: a null text stays null; a text without entities stays as it is; repeated rows are rewritten alike; an
empty table gives an empty result. Only doc_id and text are read. Texts may be long and names have any number of parts:
the work grows in proportion to the text, however many names it holds.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from cohortlens.llm.common import BROADCAST_IDS
from cohortlens.sources.scratch import written

KINDS = ("email", "ip", "iban", "card", "ssn", "phone", "name")
#: Draws in the same format before a replacement may be longer than what it replaces, and draws of a name per syllable.
_SAME_FORMAT, _SAME_SYLLABLES = 8, 2
#: Fixed lists: titles by gender (f, m, or either).
_TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Madame", "Sra", "Srta", "Señora", "Doña", "Госпожа", "Κυρία"),
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Sr", "Señor", "Don", "Господин", "Κύριος"),
    "": ("Dr", "Prof"),
}
_GENDERS = {t: g for g, titles in _TITLES.items() for t in titles}
_NAME = r"[^\W\d_a-zß-öø-ÿа-яё][^\W\d_]+(?:[-'’][^\W\d_]+)?"
_ADDRESS = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
_ENTITY = re.compile(
    r"(?P<email>[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    rf"|(?P<ip>{_ADDRESS})"
    r"|(?P<card>(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)|\d{1,5})(?:[ .-]?\d{2,5}){1,5}|\(\d{3}\)[ -]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-]))"
    rf"|(?P<name>\b(?:{'|'.join(t for titles in _TITLES.values() for t in titles)})\b\.?[  ](?:{_NAME})(?:[  ](?:{_NAME}))*)"
)
_HINT = re.compile(r"[0-9@]")
#: One kind each, to try at a place where another kind's check failed.
_IP = re.compile(_ADDRESS)
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_HOME_PHONE = re.compile(r"(?<![\w.])(?:\(\d{3}\)[ -]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])")
#: Fixed list: card numbers as issued, by grouping and first digits, the longer ones first.
_CARDS = tuple(re.compile(rf"(?<![\w.+-]){form}(?![\w-])") for form in (
    r"[456]\d{3}([ -])\d{4}\1\d{4}\1\d{4}\1\d{3}", r"(?:[3-6]\d{3}|22(?:0[0-4]|2[1-9]|[3-9]\d)|2[3-6]\d{2}|27(?:[01]\d|20))([ -])\d{4}\1\d{4}\1\d{4}", r"3[47]\d{2}([ -])\d{6}\1\d{5}",
    r"3[0689]\d{2}([ -])\d{6}\1\d{4}", r"\d{13,19}",
))
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}")
#: Fixed list: characters of an account number by country (the registry's).
_IBAN_LENGTHS = {country: int(n) for n, countries in (e.split(":") for e in (
    "15:NO;16:BE;18:DK FI FO GL NL SD FK;19:MK SI;20:AT BA EE KZ LT LU XK MN;21:CH HR LI LV;22:BG BH CR DE GB GE IE ME RS VA;"
    "23:AE GI IL IQ OM SO TL;24:AD CZ ES MD PK RO SA SE SK TN VG;25:LY PT ST;26:IS TR;27:BI DJ FR GR IT MC MR SM;"
    "28:AL AZ BY CY DO GT HN HU LB NI PL SV;29:BR EG PS QA UA;30:JO KW MU YE;31:MT SC;32:LC;33:RU"
).split(";")) for country in countries.split()}
#: Digits of a phone number with its country code at most, and at least where another entity follows it.
_MOST_DIGITS, _LEAST_DIGITS = 15, 8
_TITLE = re.compile(rf"\b(?:{'|'.join(t for titles in _TITLES.values() for t in titles)})\b")
#: Fixed lists: what stands before an untitled name, and capitalised words that end a name.
_CUE = re.compile(
    r"(?:\b(?:[Mm]y name is|[Mm]y name['’]s|[Mm]ein Name ist|[Ii]ch heiße|[Jj]e m['’]appelle|[Mm]on nom est|[Mm]e llamo|[Mm]i nombre es|"
    r"[Мм]еня зовут|[Μμ]ε λένε|Dear|Cher|Chère|Lieber|Liebe|Querido|Querida|Уважаемый|Уважаемая|Αγαπητέ|Αγαπητή)[  ]+"
    r"|\b(?:Full [Nn]ame|Name|NAME|[Ss]igned|Patient|Customer|Contact|[Aa]uthor|Nombre|Nom|Имя|ФИО|Όνομα)[  ]?:[  ]*"
    r"|\b(?:[Ss]incerely|[Rr]egards|[Yy]ours truly|[Mm]it freundlichen Grüßen|[Cc]ordialement|[Aa]tentamente|[Сс] уважением),[  ]*\r?\n?\s*)"
    rf"(?P<name>(?:{_NAME})(?:[  ](?:{_NAME}))*)"
)
_NOT_NAMES = frozenset(
    "The An On In At By To Of And But For From With He She It They We You Is Was Has Had Will Who That This All Sir Madam Customer Team "
    "Friends Friend Colleagues Sie Er Es Der Die Das Und Ich Wir Le La Les Il Elle Et Je Nous El Los Las Ella Yo Он Она Они Мы Вы Это И "
    "Address Email Mail Phone Date Tel Age Title".split()
)
#: A part of a name in a text, and how much of it stands before a hyphen or an apostrophe.
_PART = re.compile(r"([^\W\d_]+)(?:[-'’][^\W\d_]+)?")
_WORD_START = re.compile(r"(?<![\w-])[^\W\d_]+")
_GOES_ON = re.compile(r"\w|-\w")
#: Syllables of invented names, by script; fixed values.
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve vo".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то".split(),
    "greek": "βα βε βο γα γο δα δε δο κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το".split(),
}
_ENDINGS = {"latin": {"f": "na", "m": "nor", "": "nis"}, "cyrillic": {"f": "на", "m": "нор", "": "нис"}, "greek": {"f": "να", "m": "νορ", "": "νις"}}
#: First and last letters by script: replacements are drawn from between.
_LETTERS = (("a", "z"), ("α", "ω"), ("а", "я"))


def _luhn(digits: str) -> int:
    return sum(d if i % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for i, d in enumerate(int(c) for c in reversed(digits))) % 10


def _iban_rest(compact: str) -> int:
    turned = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97


def _valid(kind: str, said: str) -> bool:
    if kind == "card":
        digits = re.sub(r"\D", "", said)
        return _luhn(digits) == 0 or len(digits) == 16 and digits[0] in "3456"
    if kind == "iban":
        return _iban_rest(said.replace(" ", "")) == 1
    return True


def canonical(kind: str, said: str) -> str:
    """One spelling per entity."""
    if kind == "email":
        return said.lower()
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", said)
    if kind == "phone":
        return ("+" if said.startswith("+") else "") + re.sub(r"\D", "", said)
    if kind == "iban":
        return said.replace(" ", "")
    if kind == "name":
        title, *names = re.split(r"\.?[  ]", said)
        return " ".join([_GENDERS.get(title, "") + ":", *names])
    return said


def _iban_end(text: str, start: int) -> int | None:
    """Where an account number ends: after the length of its country, else where the longest one that checks ends."""
    m = _IBAN.match(text, start)
    if not m:
        return None
    ends = [i + 1 for i in range(start, m.end()) if text[i] != " "]
    length = _IBAN_LENGTHS.get(text[start : start + 2])
    tried = [length] if length else range(len(ends), 14, -1)
    return next((
        ends[n - 1] for n in tried if n <= len(ends) and not text[ends[n - 1] : ends[n - 1] + 1].isalnum()
        and _valid("iban", text[start : ends[n - 1]])
    ), None)


def _card_end(text: str, start: int, checked: bool) -> int | None:
    """Where a card number in one of the issued forms ends; ``checked``: its check digit has to be right."""
    ends = [m.end() for form in _CARDS if (m := form.match(text, start))]
    right = [e for e in ends if _luhn(re.sub(r"\D", "", text[start:e])) == 0]
    return next(iter(right), None) or next((e for e in ends if not checked and _valid("card", text[start:e])), None)


def _strict(text: str, start: int, checked: bool) -> tuple[int, str] | None:
    """(end, kind) of an entity in a form of its own at ``start``."""
    if end := _iban_end(text, start):
        return end, "iban"
    if end := _card_end(text, start, checked):
        return end, "card"
    for kind, form in (("ip", _IP), ("ssn", _SSN), ("phone", _HOME_PHONE)):
        if m := form.match(text, start):
            return m.end(), kind
    return None


def _inside(text: str, start: int, end: int) -> int | None:
    """Where the first entity in a form of its own begins after ``start`` and before ``end``."""
    return next((i for i in range(start + 1, end) if not text[i - 1].isalnum() and _strict(text, i, True)), None)


def _phone_end(text: str, start: int, end: int) -> int:
    """The end of an international phone number, before an entity that follows it and within the digits one can have."""
    digits = lambda upto: sum(c.isdigit() for c in text[start:upto])
    at = start
    while (at := _inside(text, at, end)) is not None:
        cut = start + len(text[start:at].rstrip(" .-("))
        if digits(cut) >= _LEAST_DIGITS:
            end = cut
            break
    while digits(end) > _MOST_DIGITS:
        cut = max(text.rfind(c, start, end) for c in " .-")
        if cut <= start or digits(cut) < _LEAST_DIGITS:
            break
        end = cut
    return end


def _scanned(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of every entity, in order. Where a check fails, other kinds and shorter ends are tried from the
    same start, then the search goes on right after it; only entities that are found take their characters with them."""
    at, loose = 0, 0  # before ``loose``, a run of digits that is no card as a whole was seen
    while m := _ENTITY.search(text, at):
        start, end, kind = m.start(), m.end(), m.lastgroup
        if kind in ("iban", "card"):
            found = _strict(text, start, start < loose)
            if not found and kind == "card" and start >= loose:
                loose = end
                if _valid(kind, m.group()) and _inside(text, start, end) is None:
                    found = end, kind
        else:
            found = _phone_end(text, start, end) if kind == "phone" and m.group()[0] == "+" else end, kind
        if found:
            yield start, *found
        at = found[0] if found else start + 1


def _trimmed(said: str) -> str:
    """A name up to the first word in it that belongs to no name, and without a possessive ending."""
    words = list(re.finditer("[^  ]+", said))
    said = next((said[: one.end()] for one, two in zip(words, words[1:]) if two.group() in _NOT_NAMES), said)
    return said[:-2] if said.endswith(("'s", "’s")) else said


def _mention(text: str, start: int, spelled: set[tuple[str, ...]], beginnings: set[tuple[str, ...]]) -> tuple[int, tuple[str, ...]] | None:
    """(end, parts) of the longest name of ``spelled`` that stands at ``start``."""
    best, tried = None, [(start, ())]
    while tried:
        longer = []
        for at, parts in tried:
            m = _PART.match(text, at)
            for end in sorted({m.end(1), m.end()}) if m else ():
                said = (*parts, text[at:end])
                if said in spelled and not _GOES_ON.match(text, end) and (best is None or end > best[0]):
                    best = end, said
                if said in beginnings and text[end : end + 1] in (" ", "\u00a0"):
                    longer.append((end + 1, said))
        tried = longer
    return best


def _names(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """The untitled names of a document: those after a cue, and the other mentions of all names found, in full or by surname."""
    known: dict[tuple[str, ...], str] = {}  # names as parts, gender
    for *_, kind, entity in found:
        if kind == "name":
            gender, *parts = entity.split(" ")
            known.setdefault(tuple(parts), gender)
    for m in _CUE.finditer(text):
        parts = re.split("[  ]", _trimmed(m["name"]))
        if parts[0] not in _NOT_NAMES and parts[0] not in _GENDERS:
            known.setdefault(tuple(parts), ":")
    if not known:
        return []
    for parts, gender in list(known.items()):
        known.setdefault(parts[-1:], gender)
    genders: dict[tuple[str, ...], str] = {}
    for parts, gender in known.items():
        genders.setdefault(tuple(p.upper() for p in parts), gender)
    spelled = {*known, *genders}
    beginnings = {parts[:n] for parts in spelled for n in range(1, len(parts))}
    heads = {_PART.match(parts[0])[1] for parts in spelled}
    taken = bytearray(len(text))
    for a, b, *_ in found:
        taken[a:b] = b"\1" * (b - a)
    out, at = [], 0
    for m in _WORD_START.finditer(text):
        if m.start() < at or m.group() not in heads:
            continue
        mention = _mention(text, m.start(), spelled, beginnings)
        if mention:
            at, parts = mention
            if not any(taken[m.start() : at]):
                out.append((m.start(), at, "name", " ".join([genders[tuple(p.upper() for p in parts)], *parts])))
    return out


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of every entity, in order."""
    if not text or not (_HINT.search(text) or _TITLE.search(text) or _CUE.search(text)):
        return []
    found = []
    for a, b, kind in _scanned(text):
        if kind == "name":
            b = a + len(_trimmed(text[a:b]))
        said = canonical(kind, text[a:b])
        if not said.endswith(":"):
            found.append((a, b, kind, said))
    return sorted(found + _names(text, found))


class _Draw:
    """A stream of numbers that depends on the key and the drawn thing only."""

    def __init__(self, key: str, *thing: str):
        self._key, self._thing, self._block, self._left = key.encode(), "\0".join(thing).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self._left) < 4:
            self._left += hmac.new(self._key, self._block.to_bytes(4, "big") + self._thing, hashlib.sha256).digest()
            self._block += 1
        number, self._left = int.from_bytes(self._left[:4], "big"), self._left[4:]
        return number * n >> 32


def _letter(c: str, draw: _Draw) -> str:
    if c.isdigit():
        return str(draw.below(10))
    if not c.isalpha():
        return c
    low = c.lower()
    for first, last in _LETTERS:
        if first <= low <= last or first == "a" and ord(low) < 0x250:
            new = chr(ord(first) + draw.below(ord(last) - ord(first) + 1))
            new = "σ" if new == "ς" else new
            return new.upper() if c != low else new
    return chr(ord(low) - ord(low) % 32 + draw.below(32)) if ord(low) > 0x2E80 else c


def _invented(part: str, key: str, attempt: int) -> str:
    """An invented name part in the script of the old one, given as ``name_parts`` has it."""
    sign = ":" if ":" in part else "/"
    gender, _, low = part.partition(sign)
    script = "cyrillic" if "а" <= low[:1] <= "я" else "greek" if "α" <= low[:1] <= "ω" else "latin"
    draw = _Draw(key, "name", part, str(attempt))
    syllables = (_SYLLABLES[script][draw.below(len(_SYLLABLES[script]))] for _ in range(3 + attempt // _SAME_SYLLABLES))
    return "".join(syllables) + (_ENDINGS[script][gender] if sign == ":" else "")


def name_parts(entity: str) -> list[str]:
    """The parts of a name in canonical form: given names as ``f:anna``, ``m:john`` or ``:kim``, the surname as ``/smith``."""
    gender, *names = entity.lower().split(" ")
    return [gender + n for n in names[:-1]] + ["/" + names[-1]]


def parts_of(kind: str, entity: str) -> list[tuple[str, str]]:
    """(kind, part) of everything in an entity that gets a replacement of its own."""
    if kind == "name":
        return [("name", part) for part in name_parts(entity)]
    if kind == "email":
        return [("domain", entity.rpartition("@")[2]), ("email", entity)]
    return [(kind, entity)]


def _digits(form: str, draw: _Draw, keep: int = 0) -> str:
    """Every digit after the first ``keep`` drawn anew, the first drawn one not zero."""
    out, seen = [], 0
    for c in form:
        if c.isdigit():
            seen += 1
            if seen > keep:
                c = str(1 + draw.below(9)) if seen == keep + 1 else str(draw.below(10))
        out.append(c)
    return "".join(out)


def drawn(kind: str, part: str, key: str, attempt: int = 0) -> str:
    """The replacement of a part; that of a mail address still has the real domain."""
    draw = _Draw(key, kind, part, str(attempt))
    longer = attempt // _SAME_FORMAT
    if kind == "name":
        return _invented(part, key, attempt)
    if kind == "email":
        local, _, domain = part.rpartition("@")
        return "".join(_letter(c, draw) for c in local + "a" * longer) + "@" + domain
    if kind == "domain":
        host, _, top = part.rpartition(".")
        return "".join(_letter(c, draw) for c in host + "a" * longer) + "." + top
    if kind == "ip":
        octets = ((0, 10), (10, 90), (100, 156))
        widths = [(0, 256) if longer else octets[len(o) - 1] for o in part.split(".")]
        return ".".join(str(least + draw.below(n)) for least, n in widths)
    if kind == "card":
        new = part[0] + _digits(part[1:], draw)
        if _luhn(part) == 0:
            new = next(new[:-1] + d for d in "0123456789" if _luhn(new[:-1] + d) == 0)
        return new
    if kind == "ssn":
        return _digits(part, draw) if longer else "9" + _digits(part[1:], draw)
    if kind == "phone":
        keep = max(0, len(part) - 1 - 10) if part.startswith("+") else 0
        return _digits(part + "0" * longer, draw, keep)
    rest = "".join(str(draw.below(10)) if c.isdigit() else _letter(c, draw) for c in part[4:])
    check = 98 - int("".join(str(int(c, 36)) for c in rest + part[:2] + "00")) % 97
    return f"{part[:2]}{check:02d}{rest}"


def surrogate(kind: str, entity: str, key: str, attempts: Mapping[tuple[str, str], int]) -> str:
    """The replacement of a canonical form, in canonical form; ``attempts``: numbers of draws of parts that draw again."""
    new = [drawn(k, part, key, attempts.get((k, part), 0)) for k, part in parts_of(kind, entity)]
    if kind == "email":
        return new[1].rpartition("@")[0] + "@" + new[0]
    if kind == "name":
        gender, *names = entity.split(" ")
        return " ".join([gender, *(n.upper() if old.isupper() and len(old) > 1 else n.capitalize() for old, n in zip(names, new))])
    return new[0]


def _formatted(kind: str, said: str, new: str) -> str:
    """The replacement with the separators and the case of what was said."""
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(said, new)) if len(said) == len(new) else new
    if kind == "name":
        pieces = re.split(r"(\.?[  ])", said)
        parts = new.split(" ")[1:]
        if len(pieces) // 2 + 1 == len(parts):  # no title
            return "".join(part + sep for part, sep in zip(parts, [*pieces[1::2], ""]))
        return pieces[0] + "".join(sep + part for sep, part in zip(pieces[1::2], parts))
    signs = iter(new.lstrip("+") if kind == "phone" else new)
    return new if kind == "ip" else "".join(next(signs) if c.isalnum() else c for c in said) + "".join(signs)


def rewritten(text: str | None, key: str, attempts: Mapping[tuple[str, str], int]) -> tuple[str | None, dict[str, int]]:
    """The text with replacements, and the number of entities by kind."""
    found = entities(text)
    out, at, counts = [], 0, dict.fromkeys(KINDS, 0)
    for start, end, kind, entity in found:
        new = surrogate(kind, entity, key, attempts)
        out += [text[at:start], _formatted(kind, text[start:end], new)]
        at = end
        counts[kind] += 1
    return (text if not found else "".join(out) + text[at:]), counts


def _part_rows(docs: DataFrame) -> DataFrame:
    """(text_key, kind, part): the distinct parts of the entities of every distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for text in batch.column(0):
                said = text.as_py()
                found = entities(said)
                if found:
                    name = _text_key(said)
                    rows.update((name, *part) for *_, kind, entity in found for part in parts_of(kind, entity))
            columns = list(zip(*sorted(rows))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["text_key", "kind", "part"])

    return docs.select("text").mapInArrow(run, "text_key string, kind string, part string").distinct()


def _text_key(text: str) -> str:
    return xxhash.xxh3_128_hexdigest(text)


def assigned(rows: DataFrame, key: str) -> DataFrame:
    """(kind, part, attempt, surrogate) of all distinct parts, no two surrogates alike and none a real part."""

    @F.arrow_udf("string")
    def draw(kinds: pa.Array, found: pa.Array, attempts: pa.Array) -> pa.Array:
        each = zip(kinds.to_pylist(), found.to_pylist(), attempts.to_pylist())
        return pa.array([drawn(k, part, key, a) for k, part, a in each], pa.string())

    real = written(rows.select("kind", "part").distinct(), "parts")
    # What is read of a part of a name: neither its gender nor its place.
    read = F.when(F.col("kind") == "name", F.regexp_replace("part", "^[fm]?[:/]", "")).otherwise(F.col("part"))
    taken = written(real.select("kind", read.alias("surrogate")).distinct().withColumn("real", F.lit(True)), "real-parts")
    table = written(real.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("kind", "part", "attempt")), "surrogates")
    while True:
        # Of parts with one replacement, the one that has drawn least often keeps it, then the first.
        keeper = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "part")).alias("keeper"), F.count("*").alias("n"))
        shared = keeper.where("n > 1").select("kind", "surrogate", F.col("keeper.part").alias("keeper"))
        marked = table.join(shared, ["kind", "surrogate"], "left").join(taken, ["kind", "surrogate"], "left")
        again = F.coalesce(F.col("real"), F.lit(False)) | F.coalesce(F.col("keeper") != F.col("part"), F.lit(False))
        marked = written(marked.select("kind", "part", "attempt", "surrogate", again.alias("again")), "surrogates")
        lost = marked.where("again")
        if not lost.limit(1).count():
            return marked.drop("again")
        redrawn = lost.withColumn("attempt", F.col("attempt") + 1).withColumn("surrogate", draw("kind", "part", "attempt"))
        table = written(marked.where("not again").unionByName(redrawn).drop("again"), "surrogates")


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """Per document: doc_id, the rewritten text, and the number of entities by kind (``n_email`` and so on).

    Keep the key secret, keep one to keep replacements stable, and change it to make them unlinkable.
    """
    if not key:
        raise ValueError("a key is needed: without one replacements can be computed by anyone")
    rows = written(_part_rows(docs), "text-parts")
    exceptions = written(assigned(rows, key).where("attempt > 0").select("kind", "part", "attempt"), "exceptions")
    few = exceptions.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    counts = ", ".join(f"n_{k} int" for k in KINDS)

    def rewrite(known: dict[tuple[str, str], int]):
        def one(texts: pa.Array, own: pa.Array | None = None) -> pa.Array:
            out: list[str | None] = []
            found: list[dict[str, int]] = []
            for i, text in enumerate(texts):
                mine = known
                if own is not None and own[i].is_valid:
                    mine = {(e["kind"], e["part"]): e["attempt"] for e in own[i].as_py()}
                new, n = rewritten(text.as_py(), key, mine)
                out.append(new)
                found.append(n)
            columns = [pa.array(out, pa.string())] + [pa.array([n[k] for n in found], pa.int32()) for k in KINDS]
            return pa.StructArray.from_arrays(columns, names=["text", *[f"n_{k}" for k in KINDS]])

        return one

    schema = f"text string, {counts}"
    slim = docs.select("doc_id", "text")
    if few:
        known = {(r["kind"], r["part"]): r["attempt"] for r in exceptions.toLocalIterator()}
        one = rewrite(known)

        @F.arrow_udf(schema)
        def alone(texts: pa.Array) -> pa.Array:
            return one(texts)

        new: Column = alone(F.col("text"))
    else:
        # Too many for every worker to hold: each text meets its own exceptions.
        own = rows.join(exceptions, ["kind", "part"]).groupBy("text_key").agg(
            F.collect_list(F.struct("kind", "part", "attempt")).alias("own")
        )

        @F.arrow_udf("string")
        def keyed(texts: pa.Array) -> pa.Array:
            return pa.array([_text_key(t.as_py()) if t.is_valid else None for t in texts], pa.string())

        slim = slim.withColumn("text_key", keyed("text")).join(own, "text_key", "left")
        one = rewrite({})

        @F.arrow_udf(schema)
        def with_own(texts: pa.Array, own: pa.Array) -> pa.Array:
            return one(texts, own)

        new = with_own(F.col("text"), F.col("own"))
    return slim.withColumn("__new", new).select("doc_id", "__new.*")
