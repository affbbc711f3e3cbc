"""Detection of personal data and format-keeping surrogates (one text at a time).

An entity has a kind and a canonical form, under which its mentions corefer
(e-mail addresses without case, telephone numbers as digits, names by word).  A
surrogate is drawn for the canonical form from a keyed hash and rendered in the
shape of every mention: same separators, same case, same script, same gender for
names, valid check digits where the original has them.  Digits of every script
count by their value and are rendered in the mention's own script.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

# Forms of address with the gender they tell (m, f or n).
TITLES = {
    "mr": "m", "mister": "m", "sir": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "don": "m", "господин": "m",
    "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "frau": "f", "madame": "f", "mme": "f", "mlle": "f", "señora": "f", "señorita": "f",
    "sra": "f", "doña": "f", "госпожа": "f", "dr": "n", "prof": "n", "professor": "n", "doctor": "n", "doktor": "n",
}
# Common given names with their gender.
GIVEN = {
    **dict.fromkeys("james john robert michael william david richard joseph thomas charles daniel matthew andrew peter paul george henry edward "
                    "hans karl jürgen wolfgang stefan klaus jean pierre michel françois jacques louis carlos josé juan miguel antonio manuel "
                    "иван александр сергей дмитрий".split(), "m"),
    **dict.fromkeys("mary patricia jennifer linda elizabeth barbara susan jessica sarah karen anna emma alice laura emily julia helen margaret "
                    "ursula monika petra sabine claudia marie jeanne nathalie isabelle sophie camille maría carmen josefa dolores lucía "
                    "анна мария ольга елена".split(), "f"),
}

NAME_WORD = r"[^\W\d_a-zа-яß-öø-ÿ][^\W\d_]+(?:[-'’][^\W\d_]+)*"


def _any(words) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


PATTERNS = (
    ("email", r"(?<![\w.%+-])[\w.%+-]*[\w%+-]@(?:[\w-]+\.)+[^\W\d_]{2,}"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b\s*[=:]\s*[\"']?)(?P<secret>[A-Za-z0-9+/_.~-]{6,})"),
    ("awskey", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"),
    ("name", r"(?<![^\W\d_])(?:(?P<title>(?i:" + _any(TITLES) + r"))\.? +(?P<named>" + NAME_WORD + r"(?: " + NAME_WORD + r"){0,2})"
             r"|(?P<full>(?i:" + _any(GIVEN) + r")(?: " + NAME_WORD + r"){1,2}))"),
)
FINDERS = [(kind, re.compile(pattern)) for kind, pattern in PATTERNS]
NAMED = frozenset({*TITLES, *GIVEN})
DIGIT = re.compile("[0-9]")
KEYWORD = re.compile("(?i)passw|pwd|secret|token|key")
WORD = re.compile(r"[^\W\d_]+")


def _by_first_letter(words) -> str:
    """An alternation that branches on the first letter, upper or lower case."""
    first: dict[str, list[str]] = {}
    for w in sorted(words, key=len, reverse=True):
        first.setdefault(w[0], []).append(w[1:])
    return "|".join(f"[{c}{c.upper()}](?iu:{_any(rest)})" for c, rest in first.items())


# what a text must have for any pattern to match (for Java): a cheap sign, or a word
SIGN = r"[\p{Nd}@]"
WORDED = r"(?i:passw|pwd|secret|token|key)|(?U:\b(?:" + _by_first_letter(NAMED) + r")\b)"
CANDIDATE = SIGN + "|" + WORDED
# the decimal digits beyond ASCII, by value
DIGITS = {i: 48 + unicodedata.decimal(c) for i in range(0x80, 0x110000) if unicodedata.category(c := chr(i)) == "Nd"}
OTHER_DIGIT = re.compile("[" + "".join(map(chr, DIGITS)) + "]")


def ascii_digits(text: str) -> str:
    """``text`` with the digits of every script as ASCII digits, place for place."""
    return text if text.isascii() or not OTHER_DIGIT.search(text) else text.translate(DIGITS)


def possible(text: str) -> Iterator[tuple[str, re.Pattern]]:
    """The patterns whose plainest requirement a text meets."""
    digits, keyword = DIGIT.search(text) is not None, KEYWORD.search(text) is not None
    names = not NAMED.isdisjoint(map(str.casefold, WORD.findall(text)))
    needs = {"email": "@" in text, "secret": keyword, "awskey": "AKIA" in text or "ASIA" in text, "name": names}
    return ((kind, finder) for kind, finder in FINDERS if needs.get(kind, digits))


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def fold(text: str) -> str:
    return unicodedata.normalize("NFC", text).casefold()


def mentions(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(begin, end, kind, canonical form) of every mention, left to right, no
    overlaps.  Each word of a name is a mention of its own."""
    text = ascii_digits(text)
    found = sorted(((m.start(), no, kind, m) for no, (kind, finder) in enumerate(possible(text)) for m in finder.finditer(text)), key=lambda x: x[:2])
    upto = 0
    for start, _, kind, m in found:
        if start < upto:
            continue
        upto = m.end()
        if kind == "secret":
            yield m.start("secret"), m.end("secret"), kind, m["secret"]
        elif kind == "name":
            group = "named" if m["named"] else "full"
            parts = [(x.start(), x.end(), x.group()) for x in re.finditer(r"\S+", m[group])]
            gender = TITLES.get(fold(m["title"])) if m["title"] else GIVEN.get(fold(parts[0][2]), "n")
            for no, (a, b, word) in enumerate(parts):
                given = no == 0 and (len(parts) > 1 or fold(word) in GIVEN)
                g = GIVEN.get(fold(word), gender) if given else "n"
                yield m.start(group) + a, m.start(group) + b, f"given-{g}" if given else "surname", fold(word)
        else:
            whole = m.group()
            yield m.start(), m.end(), kind, fold(whole) if kind == "email" else whole if kind in ("ip", "awskey") else re.sub(r"[^0-9A-Za-z]", "", whole)


class Stream:
    """Numbers from a keyed hash of (kind, canonical form, attempt)."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed, self.block, self.state = f"{kind}\x1f{canonical}\x1f{attempt}".encode(), 0, 0
        self.key, self.left = hashlib.sha256(key).digest(), 1

    def below(self, n: int) -> int:
        if self.left < n << 20:
            digest = hashlib.blake2b(self.seed + b"\x1f%d" % self.block, key=self.key).digest()
            self.state, self.left, self.block = int.from_bytes(digest, "big"), 1 << 512, self.block + 1
        self.state, out = divmod(self.state, n)
        self.left //= n
        return out

    def pick(self, seq):
        return seq[self.below(len(seq))]


def like(char: str, draw: Stream, hexadecimal: bool = False) -> str:
    """A character of the same class, case and script."""
    if char.isdigit():
        return str(draw.below(10)) if char.isascii() else chr(ord(char) - unicodedata.digit(char, 0) + draw.below(10))
    if char.isascii() and char.isalpha():
        letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
        return draw.pick(letters.upper() if char.isupper() else letters)
    if "\u0400" <= char <= "\u04ff":
        return draw.pick("АБВГДЕЖЗИКЛМНОПРСТУФ" if char.isupper() else "абвгдежзиклмнопрстуф")
    if "\u0370" <= char <= "\u03ff":
        return draw.pick("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤ" if char.isupper() else "αβγδεζηθικλμνξοπρστ")
    if char.isalpha() and "LATIN" in unicodedata.name(char, ""):
        return draw.pick("ÀÁÂÄÈÉÊËÍÎÏÓÔÖÚÛÜ" if char.isupper() else "àáâäèéêëíîïóôöúûü")
    if char.isalpha():
        return chr(min(max(ord(char) - 8, 0x80) + draw.below(16), 0x10FFFF)) if unicodedata.category(char) == "Lo" else char
    return char


SYLLABLES = {
    "latin": ("ba be bo da de do fa fe ga ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo za ze".split(),
              {"m": "n r s ld rt rd k x mas ric".split(), "f": "na la ia ra line lisa da tta nia ssa".split(), "n": "y li rin mer son berg ton man ville field".split()}),
    "cyrillic": ("ба ве га да ко ла ма на по ра са та ви ли ми ни ро ти".split(),
                 {"m": "н р слав мир дор".split(), "f": "на ла рия ша ся".split(), "n": "нов рин сков ев лин".split()}),
    "greek": ("βα γε δα κο λα μα να πο ρα σα τα".split(), {"m": "ς νης ρος".split(), "f": "να ρα λια".split(), "n": "κης δης ου".split()}),
}


def script_of(word: str) -> str:
    for c in word:
        if "\u0400" <= c <= "\u04ff":
            return "cyrillic"
        if "\u0370" <= c <= "\u03ff":
            return "greek"
    return "latin"


WIDE_FROM, MASK_FROM = 20, 30  # attempts from which a short class gets longer forms, then masks
WIDER = 6  # characters that a longer form has more
SMALL = "abcdefghijklmnopqrstuvwxyz"


def _fixed(kind: str, canonical: str) -> bool:
    """Whether no character of a form can be drawn anew ("________")."""
    drawn = {"secret": canonical, "email": canonical.rpartition(".")[0]}.get(kind, "x")
    return not any(map(str.isalnum, drawn))


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The replacement's canonical form: same kind, length class and script.

    A form without variable characters, and one whose class had no free place in
    ``WIDE_FROM`` attempts, gets a longer form of its kind; from ``MASK_FROM`` on
    it is a keyed mask.  Names grow with the attempts anyway."""
    draw = Stream(key, kind, canonical, attempt)
    named = kind.startswith("given") or kind == "surname"
    if attempt >= MASK_FROM and not named:
        return f"[{kind}-" + "".join(draw.pick("0123456789abcdef") for _ in range(24)) + "]"
    wide = attempt >= WIDE_FROM or _fixed(kind, canonical)
    more = "".join(str(draw.below(10)) for _ in range(WIDER)) if wide else ""
    if wide and kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if wide and kind == "email":
        local, host = ("".join(draw.pick(SMALL) for _ in range(2 * WIDER)) for _ in range(2))
        return f"{local}@{host}.{canonical.rpartition('.')[2]}"
    if wide and kind == "secret":
        return "".join(draw.pick(SMALL) for _ in canonical) + more
    if kind == "ip":
        bounds = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        return ".".join(str(lo + draw.below(hi - lo + 1)) for lo, hi in (bounds[len(octet)] for octet in canonical.split(".")))
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        host, _, top = domain.rpartition(".")
        return "".join(like(c, draw) for c in local) + "@" + "".join(like(c, draw) for c in host) + "." + top
    if named:
        stems, ends = SYLLABLES[script_of(canonical)]
        gender = kind[-1] if kind.startswith("given") else "n"
        n = 2 + draw.below(2) + attempt // 4
        return "".join(draw.pick(stems) for _ in range(n)) + draw.pick(ends[gender])
    if kind == "awskey":
        return canonical[:4] + "".join(draw.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in canonical[4:])
    if kind == "phone":
        keep = len(canonical) - min(len(canonical), 10)  # the country code stays
        rest = "".join(like(c, draw) for c in canonical[keep:]) + more
        return canonical[:keep] + (str(2 + draw.below(8)) + rest[1:] if canonical[keep:keep + 1] not in ("", "0", "1") else rest)
    if kind == "card":
        body = canonical[0] + "".join(str(draw.below(10)) for _ in canonical[1:-1]) + more
        if not luhn_ok(canonical):
            last = [d for d in "0123456789" if not luhn_ok(body + d)]
            return body + draw.pick(last)
        return body + next(d for d in "0123456789" if luhn_ok(body + d))
    if kind == "iban":
        body = canonical[:2] + "00" + "".join(like(c, draw) for c in canonical[4:]) + more
        number = "".join(str(int(c, 36)) for c in body[4:] + body[:4])
        return body[:2] + f"{98 - int(number) % 97:02d}" + body[4:]
    if kind == "ssn":
        return f"{100 + draw.below(565):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}{more}"
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", canonical) is not None
    return "".join(like(c, draw, hexadecimal) for c in canonical)


def in_script(new: str, mention: str) -> str:
    """``new`` with its digits in the script of the mention's digit at the same
    place, or else of its first digit."""
    if mention.isascii() or not OTHER_DIGIT.search(mention):
        return new
    zeros = [ord(c) - unicodedata.decimal(c) if c.isdecimal() else None for c in mention]
    first = next(z for z in zeros if z is not None)
    aligned = zeros + [None] * (len(new) - len(zeros))
    return "".join(chr((first if z is None else z) + int(c)) if c.isascii() and c.isdigit() else c for c, z in zip(new, aligned))


def render(mention: str, kind: str, replacement: str) -> str:
    """The replacement in the shape of the mention; what a longer form has more
    comes last."""
    return replacement if replacement.startswith("[") else in_script(_shaped(mention, kind, replacement), mention)


def _shaped(mention: str, kind: str, replacement: str) -> str:
    if kind.startswith("given") or kind == "surname":
        return replacement.upper() if len(mention) > 1 and mention.isupper() else replacement.capitalize()
    if kind == "email":
        return "".join(r.upper() if m.isupper() else r for m, r in zip(mention, replacement)) if len(mention) == len(replacement) else replacement
    if kind in ("ip", "awskey", "secret"):
        return replacement
    chars = iter(replacement)
    return "".join(next(chars) if c.isascii() and c.isalnum() or c.isdecimal() else c for c in mention) + "".join(chars)
