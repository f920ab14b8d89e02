"""Surrogates for personal data: keyed, of the same type and form, distinct and consistent.

An entity's replacement is a keyed permutation of all texts of its form, so no table of what was
replaced is needed and every task decides alone: the same entity gets the same surrogate in every
document (coreference), and two entities of one form never share one. A Feistel network orders the
numbers that an entity's free places can spell, and the replacement is some keyed steps further in
that order, which goes through all of them before it comes back. Results that break a rule of the
type (an octet above 255, a wrong check digit, a leading zero) are stepped over, which keeps it one
to one, and no entity stands for itself unless its form allows no other; then it is left and not
counted. What is free depends on the type:

* e-mail: letters of any script and digits of the local part, each among its kind; the domain's
  names likewise, its last label stays;
* phone: digits after the country code; whether they start with 0 stays, as do punctuation and grouping;
* IPv6 addresses: the groups that are not 0; the kind of address stays;
* IPv4 addresses, card numbers (with or without a right check digit), IBANs (checked), other long
  numbers, hexadecimal secrets and key tokens: digits among digits, letters among letters;
* names after a title or a known first name: consonants among consonants and vowels among vowels
  of their script; the last letter stays, which carries the gender of most names, and known first
  names, whatever their case, are replaced by known ones of the same gender and script, each by the
  next in one keyed cycle over them. What is found so is replaced wherever else the text has it as a
  whole word.

`collisions` checks the promise on results: originals that share a surrogate. `checked` writes
results and tells of any.
"""

from __future__ import annotations

import hashlib
import logging
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from ipaddress import IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import quoted, ship, written

logger = logging.getLogger(__name__)

# Titles, first names by gender and script, and the letters of the scripts.
TITLES = {
    "m": "Mr Mister Sir Herr Herrn Monsieur Señor Signor Господин".split(),
    "f": "Mrs Ms Miss Madam Frau Madame Mme Mlle Señora Sra Doña Signora Госпожа".split(),
    "": "Dr Prof Professor Doktor Docteur Doctor".split(),
}
FIRST_NAMES = {
    ("latin", "f"): "Anna Maria Laura Julia Sarah Emma Sophie Elena Lucia Carmen Claire Camille Marie Katharina "
    "Susanne Petra Monika Jennifer Jessica Linda Patricia Elizabeth Barbara Susan Karen Nancy Lisa Margaret Sandra "
    "Emily Isabel Teresa Rosa Paula Ines Chloe Manon Heike Ursula Sabine".split(),
    ("latin", "m"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony "
    "Steven Paul Andrew Peter Hans Klaus Jürgen Wolfgang Stefan Andreas Jean Pierre Michel Philippe Alain Jacques "
    "Carlos Juan Jose Luis Antonio Miguel Pedro Pablo Diego Javier Fernando".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Сергей Александр Дмитрий Алексей Андрей Михаил Николай Владимир Павел".split(),
}
ALPHABETS = (
    "aeiouy",
    "bcdfghjklmnpqrstvwxz",
    "áàâäãåéèêëíìîïóòôöõúùûü",
    "ñçšžčř",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
    "0123456789",
)
_KIND = {letter: alphabet for alphabet in ALPHABETS for letter in alphabet}
_DIGITS, _LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_HEX = "abcdef"

#: First names by name: script and gender, and all names of these.
_known = {name: (key, names) for key, names in FIRST_NAMES.items() for name in names}
#: The names by their small letters.
_as_known = {name.lower(): name for name in _known}
_titles = sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True)
_NAME = r"[A-ZÀ-ÖØ-ÞŠŽČŘА-ЯΑ-Ω][^\W\d_]+(?:[-’'][^\W\d_]+)*"
_FIND = re.compile(
    r"(?P<email>[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![\w]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<abroad>(?<![\w.])00[1-9]\d{0,2}[ ./-]?(?:(?<!\d)|(?=\())"
    r"(?:\(0?\d{0,5}\)[ .-]?)?\d{1,8}(?:[ .-]?\d{2,8}){1,4}(?![ .-]?\d|\w)"
    r"|(?<![\w.])00[1-9]\d{9,11}(?![ .-]?\d|\w))"
    r"|(?P<card>(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)(?:\(\d{1,5}\)[ .-]?)?\d{1,5}(?:[ .-]?\d{2,5}){1,4}(?!\w)"
    r"|(?<![\w.(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
    r"|(?<![\w.-])1[ .-](?:\(\d{3}\)|\d{3})[ .-]\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w.-])(?<!\d[ ,:/])[2-9]\d\d [2-9]\d\d \d{4}(?![\w-]| \d))"
    r"|(?P<national>(?<![\w.(])\(0[1-9]\d{0,3}\)[ .-]?\d{2,8}(?:[ .-]\d{2,8}){0,3}(?!\w)"
    r"|(?<![\w.])(?<!\d[ ,:/-])0[1-9]\d{0,4}(?:(?P<gap>[ .-])\d{2,8}(?:(?P=gap)\d{2,8}){0,4}"
    r"|(?:[ ]?/[ ]?|-)\d{2,8}(?:[ -]\d{2,8}){0,4}|\d{5,9})(?!\w|[.,/-]\d)"
    r"|(?<![\w.])(?<!\d[ ,:/-])(?:[6-9]\d \d{3} \d\d \d\d|[6-9]\d\d (?:\d\d \d\d \d\d|\d{3} \d{3}))(?!\w|[ .,/-]\d))"
    r"|(?P<ipv6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,7}:"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|::(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{1,4})(?![\w:]|\.\d))"
    r"|(?P<secret>(?<![A-Za-z0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}"
    r"|xox[abp]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)(?![A-Za-z0-9]))"
)
_KINDS = [k for k in _FIND.groupindex if k != "gap"]
#: What the groups of _FIND are that are not types themselves, and the digits that a phone number has.
_TYPES = {"abroad": "phone", "national": "phone", "ipv6": "ip"}
_DIGITS_OF = {"phone": (8, 99), "abroad": (10, 17), "national": (9, 13)}
#: Country calling codes, so that a number is the same with and without spaces.
_CODE = re.compile(
    r"(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}|\d{1,2})|1(?=[ .-])"
)
_MAY_BE = re.compile(r"[0-9@]|::|eyJ|AKIA|xox|sk-")
_MENTION = re.compile(r"(?<!\w)" + _NAME + r"(?!\w)")
_PERSON = re.compile(
    r"(?<!\w)(?:(?P<title>" + "|".join(_titles) + r")\.?[ ]+(?P<after>" + _NAME + r"(?:[ ]" + _NAME + r"){0,2})"
    r"|(?P<first>" + "|".join(sorted(_known, key=len, reverse=True)) + r")[ ](?P<last>" + _NAME + r"))(?!\w)"
)


class Surrogates:
    """Replacements under one key."""

    def __init__(self, key: bytes) -> None:
        if len(key) < 16:
            raise ValueError("the key needs 16 bytes at least")
        self.key = key[:64]
        self.of = lru_cache(200_000)(self._of)
        self._cycles: dict[str, dict[str, str]] = {}

    def __reduce__(self):
        return Surrogates, (self.key,)

    def _number(self, message: str, bits: int) -> int:
        size = (bits + 7) // 8
        out = b""
        while len(out) < size:
            out += hashlib.blake2b(f"{len(out)}:{message}".encode(), key=self.key, digest_size=32).digest()
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def permuted(self, kind: str, value: int, size: int, back: bool = False) -> int:
        """A permutation of 0 ... size - 1 that the key and the kind fix, or its inverse."""
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        turns = range(7, -1, -1) if back else range(8)
        while True:
            left, right = value >> half, value & mask
            if back:
                left, right = right, left
            for turn in turns:
                left, right = right, left ^ self._number(f"{kind}|{size}|{turn}|{right}", half)
            if back:
                left, right = right, left
            value = left << half | right
            if value < size:
                return value

    def following(self, kind: str, value: int, size: int) -> Iterator[int]:
        """The numbers after this one in a keyed order of 0 ... size - 1 that closes, this one last."""
        if size < 2:
            yield value
            return
        step = self._number(f"step|{kind}|{size}", 64) % (size - 1) + 1
        while math.gcd(step, size) > 1:
            step = step % (size - 1) + 1
        place = self.permuted(kind, value, size)
        while True:
            place = (place + step) % size
            found = self.permuted(kind, place, size, back=True)
            yield found
            if found == value:
                return

    def spelled(self, kind: str, text: str, alphabets: list[str | None], allowed=lambda text: True) -> str:
        """The text with the places that have an alphabet changed within it, to one that is allowed.

        The text itself if it is the only one.
        """
        size, value = 1, 0
        for letter, alphabet in zip(text, alphabets):
            if alphabet:
                size *= len(alphabet)
                value = value * len(alphabet) + alphabet.index(letter.lower())
        form = "".join(c if a is None else f"<{ord(a[0])}>" for c, a in zip(text.lower(), alphabets))
        result = text
        for rest in self.following(f"{kind}|{form}", value, size):
            out = []
            for letter, alphabet in zip(reversed(text), reversed(alphabets)):
                if alphabet:
                    rest, i = divmod(rest, len(alphabet))
                    out.append(alphabet[i].upper() if letter.isupper() else alphabet[i])
                else:
                    out.append(letter)
            result = "".join(reversed(out))
            if allowed(result):
                break
        return result

    def _of(self, kind: str, text: str) -> str:
        if kind == "email":
            local, domain = text.split("@")
            names, _, last = domain.rpartition(".")
            return self._plain("local", local) + "@" + self._plain("domain", names) + "." + last
        if kind == "ip" and ":" in text:
            return self._ipv6(text)
        if kind == "ip":
            numbers = list(map(int, text.split(".")))
            value = int.from_bytes(bytes(numbers), "big")
            for new in self.following("ip", value, 1 << 32):
                if 0 < new >> 24 < 224 and new >> 24 not in (10, 127):
                    break
            return ".".join(map(str, new.to_bytes(4, "big")))
        if kind == "name":
            return self._name(text)
        if kind == "phone":
            # the country code stays; a national number has none
            code = _CODE.match(text)
            return self._numeral("phone", text, code.end() if code else 0)
        if kind == "card":
            valid = luhn(text)
            return self._numeral("card", text, 0, lambda t: luhn(t) == valid)
        if kind == "iban":
            plain = text.replace(" ", "")
            if iban(plain) is None:
                return self._plain("iban", text)
            body = self._plain("iban-body", plain[:2] + plain[4:])[2:]
            body = iban(plain[:2] + "00" + body, make=True)
            out = iter(body)
            return "".join(c if c == " " else next(out) for c in text)
        if kind == "ssn":
            return self._numeral("ssn", text)
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
            new = self.spelled("hex", text.lower(), [_DIGITS + _HEX] * len(text))
            return new.upper() if text.upper() == text else new
        head = re.match(r"AKIA|gh[pousr]_|sk-|xox[abp]-|eyJ|", text)[0]
        return head + self._plain("token", text[len(head) :])

    def _ipv6(self, text: str) -> str:
        """Groups that are not 0 among such, so that an address may be shortened as before.

        The first one stays within 2000::/3, or as it is outside it.
        """
        packed = IPv6Address(text).packed
        groups = [packed[i] << 8 | packed[i + 1] for i in range(0, 16, 2)]
        unicast = 0x2000 <= groups[0] < 0x4000
        free = [i for i, g in enumerate(groups) if g and (i or unicast)]
        least = [0x2000 if i == 0 else 1 for i in free]
        sizes = [0x2000 if i == 0 else 0xFFFF for i in free]
        size, start = math.prod(sizes), 0
        for i, low, n in zip(free, least, sizes):
            start = start * n + groups[i] - low
        kind = "ipv6|" + "".join("x" if i in free else f"{g:x}," for i, g in enumerate(groups))
        value = next(self.following(kind, start, size))
        for i, low, n in reversed(list(zip(free, least, sizes))):
            value, rest = divmod(value, n)
            groups[i] = rest + low
        new = IPv6Address(b"".join(g.to_bytes(2, "big") for g in groups))
        if "::" in text:
            out = new.compressed
        else:
            out = new.exploded if len(text) == 39 else ":".join(f"{g:x}" for g in groups)
        return out.upper() if text == text.upper() else out

    def _plain(self, kind: str, text: str) -> str:
        """Letters among letters, digits among digits, the rest as it is."""
        places = [_DIGITS if c in _DIGITS else _LETTERS if c.lower() in _LETTERS else alphabet_of(c) for c in text]
        if kind == "iban-body":
            places[:2] = [None, None]
        return self.spelled(kind, text, places)

    def _numeral(self, kind: str, text: str, skip: int = 0, allowed=lambda text: True) -> str:
        """Digits after `skip` by the number alone, so that other punctuation gives the same digits."""
        at = [i for i, c in enumerate(text) if c.isdigit() and i >= skip]
        number = "".join(text[i] for i in at)
        zero = number[:1] == "0"
        new = self.spelled(
            kind, number, [_DIGITS] * len(number), lambda t: (t[:1] == "0") == zero and allowed(t)
        )
        out = list(text)
        for i, c in zip(at, new):
            out[i] = c
        return "".join(out)

    def _next(self, script: str, gender: str, names: list[str]) -> dict[str, str]:
        """For each name the one after it in a keyed order that closes, so that none stays."""
        kind = f"first|{script}|{gender}"
        if kind not in self._cycles:
            order = sorted(names, key=lambda name: (self._number(f"{kind}|{name}", 128), name))
            self._cycles[kind] = dict(zip(order, order[1:] + order[:1]))
        return self._cycles[kind]

    def _name(self, word: str) -> str:
        """One word of a name."""
        known = _as_known.get(word.lower())
        if known:
            (script, gender), names = _known[known]
            new = self._next(script, gender, names)[known]
            return new.upper() if word.isupper() else new
        places = [alphabet_of(c) for c in word]
        if any(places[:-1]):
            places[-1] = None
        return self.spelled("name", word, places, lambda t: t.lower() not in _as_known)


@lru_cache(10_000)
def alphabet_of(letter: str) -> str | None:
    """The small letters that may stand for a letter; None for other signs.

    Letters outside `ALPHABETS` go with those of the 32 code points that theirs is in.
    """
    small = letter.lower()
    if small in _KIND:
        return _KIND[small] if _turns(small) or letter == small else None
    if not letter.isalpha() or len(small) > 1 or letter not in (small, small.upper()):
        return None
    first = ord(small) & ~31
    near = [chr(i) for i in range(first, first + 32)]
    found = "".join(c for c in near if c.isalpha() and c == c.lower() and c not in _KIND and _turns(c) == _turns(small))
    return found if len(found) > 1 and small in found else None


def _turns(small: str) -> bool:
    """Whether the letter has a capital one that it comes back from."""
    return len(small.upper()) == 1 and small.upper() != small and small.upper().lower() == small


def luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def iban(text: str, make: bool = False) -> str | None:
    """The text if its check digits are right, or with `make` with the right ones."""
    def rest(t: str) -> int:
        return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97

    if make:
        text = text[:2] + "00" + text[4:]
        return text[:2] + f"{98 - rest(text):02d}" + text[4:]
    return text if rest(text) == 1 else None


Span = tuple[int, int, str, str, str]  # start, end, type, original, surrogate


def spans(text: str | None, surrogates: Surrogates) -> list[Span]:
    """Entities of a text in order, without overlap; places are code points."""
    out: list[Span] = []
    if not text:
        return out
    if _MAY_BE.search(text):
        for m in _FIND.finditer(text):
            kind, found = next(k for k in _KINDS if m[k] is not None), m[0]
            least, most = _DIGITS_OF.get(kind, (0, 0))
            if most and not least <= sum(c.isdigit() for c in found) <= most:
                continue
            if kind == "ipv6" and not _is_ipv6(found):
                continue
            kind = _TYPES.get(kind, kind)
            new = surrogates.of(kind, found)
            if new != found:
                out.append((m.start(), m.end(), kind, found, new))
    names = []
    for m in _PERSON.finditer(text):
        words = m["after"] if m["title"] else m[0]
        start = m.start("after") if m["title"] else m.start()
        for word in re.finditer(r"[^\s]+", words):
            at, new = start + word.start(), surrogates.of("name", word[0])
            if new != word[0]:
                names.append((at, at + len(word[0]), "name", word[0], new))
    if names:
        out = _merged(out, names)
        out = _merged(out, _mentions(text, {n[3]: n[4] for n in names}))
    return out


def _merged(found: list[Span], more: list[Span]) -> list[Span]:
    """Both in order, of `more` those that overlap none of `found`; neither overlaps itself."""
    starts = [f[0] for f in found]
    kept = []
    for one in more:
        i = bisect_left(starts, one[1])
        if i == 0 or found[i - 1][1] <= one[0]:
            kept.append(one)
    return sorted(found + kept)


def _mentions(text: str, names: dict[str, str]) -> list[Span]:
    """Whole words anywhere in the text that are one of its names, also in capitals."""
    capital = {name.upper(): new.upper() for name, new in names.items()}
    out: list[Span] = []
    for m in _MENTION.finditer(text):
        places = [(p.start(), p.end()) for p in re.finditer(r"[^-’']+", m[0])]
        i = 0
        while i < len(places):
            a = places[i][0]
            for j in range(min(len(places), i + 6) - 1, i - 1, -1):
                word = m[0][a : places[j][1]]
                new = names.get(word) or capital.get(word)
                if new:
                    out.append((m.start() + a, m.start() + places[j][1], "name", word, new))
                    i = j
                    break
            i += 1
    return out


def _is_ipv6(text: str) -> bool:
    """An address, and not a slice or a name of code, the loopback or no address."""
    try:
        value = int(IPv6Address(text))
    except ValueError:
        return False
    parts = [p for p in text.split(":") if p]
    return value > 1 and sum(map(len, parts)) > 4 and (len(parts) > 2 or any(c.isdigit() for c in text))


def replaced(text: str | None, found: list[Span]) -> str | None:
    if not found:
        return text
    parts, at = [], 0
    for start, end, _, _, surrogate in found:
        parts += (text[at:start], surrogate)
        at = end
    return "".join([*parts, text[at:]])


_RESULT = (
    "text string, n_entities long, "
    "entities array<struct<start:int,end:int,type:string,original:string,surrogate:string>>"
)


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """All columns of `docs` with the text rewritten, and n_entities and entities.

    `entities` lists start, end (code points of the original), type, original and surrogate. A
    null text stays null with no entities; other texts keep every character outside entities.
    Columns of `docs` named n_entities or entities are replaced. An empty table gives no rows.
    Results depend on the key and the text alone, so repeated rows and reruns agree.
    """
    ship(docs.sparkSession)
    surrogates = Surrogates(key)
    kind = T._parse_datatype_string(_RESULT)
    names = ["start", "end", "type", "original", "surrogate"]

    @F.arrow_udf(kind)
    def rewrite(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from pyspark.sql.pandas.types import to_arrow_type

        shape = to_arrow_type(kind)
        for batch in batches:
            rows = []
            for value in batch:
                text = value.as_py()
                found = spans(text, surrogates)
                rows.append(
                    {
                        "text": replaced(text, found),
                        "n_entities": len(found),
                        "entities": [dict(zip(names, span)) for span in found],
                    }
                )
            yield pa.array(rows, shape)

    own = [c for c in docs.columns if c not in ("n_entities", "entities")]
    done = docs.select(
        F.struct(*[quoted(c) for c in own]).alias("row"), rewrite(quoted(text_col).cast("string")).alias("new")
    )
    columns = [
        F.col("new.text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in own
    ]
    return done.select(*columns, F.col("new.n_entities").alias("n_entities"), F.col("new.entities").alias("entities"))


def collisions(results: DataFrame) -> DataFrame:
    """Surrogates of one type that stand for several originals: type, surrogate, n. Ought to be empty.

    Originals that differ in punctuation, case or spaces only count as one.
    """
    each = results.select(F.explode("entities").alias("e")).select("e.type", "e.original", "e.surrogate")
    plain = F.lower(F.regexp_replace("original", r"[\s().+-]", ""))
    return (
        each.select("type", F.lower("surrogate").alias("surrogate"), plain.alias("original"))
        .distinct()
        .groupBy("type", "surrogate")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def checked(results: DataFrame) -> DataFrame:
    """The results, once written; tells in the log of surrogates that stand for several originals.

    Raises RuntimeError if an entity is its own surrogate, which `spans` leaves none of.
    """
    results = written(results, "pii")
    stays = results.select(F.explode("entities").alias("e")).filter("e.original = e.surrogate")
    if not stays.isEmpty():
        raise RuntimeError("an entity is its own surrogate")
    found = collisions(results).limit(5).collect()
    if found:
        logger.warning("surrogates that stand for several originals, such as %s", [tuple(row) for row in found])
    return results
