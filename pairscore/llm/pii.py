"""Personal data in plain and in disguised form, with spans in the source text.

``find_spans`` first applies the plain detectors (email, ip, card, phone). Then a chain of
transducers rewrites the text: look-alike characters become ASCII, invisible ones vanish,
spelled digits become digits, "(at)" and "[dot]" become signs. Each transducer records
which source characters every part of its output came from. The plain detectors run on
the rewritten text too; what they find there is mapped back through the chain and added
unless a plain span of its kind covers it; one that is longer than what was found in
plain form stands beside it.

All offsets are code points, ends exclusive. Null is searched as the empty text. Every
detector is linear in the length of the text, also on one word of any length.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import add_columns, free_name

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ outwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_SET:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            done = match.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    out = []
    for match in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in match.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(match.span())
    return out


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for match in CARD.finditer(text):
        digits = NO_DIGIT.sub("", match.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(match.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [
        m.span() for m in PHONE.finditer(text) if 10 <= len(NO_DIGIT.sub("", m.group())) <= 15
    ]


def plain(text: str) -> list[tuple[str, int, int]]:
    """The spans of all kinds, by start and then by kind."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if HAS_DIGIT.search(text):
        if "." in text:
            found += [("ip", s, e) for s, e in ips(text)]
        found += [("card", s, e) for s, e in cards(text)]
        if "+" in text:
            found += [("phone", s, e) for s, e in phones(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


HAS_DIGIT = re.compile("[0-9]")

# Letters of other scripts that look like these ASCII letters.
LOOK_ALIKES = {
    "a": "аα", "b": "Ь", "c": "сϲ", "d": "ԁ", "e": "еє", "g": "ɡ", "h": "һ", "i": "іι", "j": "ј", "k": "κк", "l": "ӏ",
    "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "т", "u": "υս", "v": "ν", "w": "ԝ",
    "x": "хχ", "y": "уγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ",
    "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "УΥ", "Z": "Ζ",
    "@": "\ufe6b\uff20", ".": "\uff0e\u3002\u2024\ufe52\uff61", "+": "\uff0b\ufe62",
    "-": "\u2010\u2011\u2012\u2013\u2212\uff0d\ufe63", "(": "\uff08", ")": "\uff09", "_": "\uff3f", "%": "\uff05",
    " ": "\u00a0\u2002\u2003\u2009\u202f\u3000",
}
# Characters without width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff\u180e"
# Names of the digits 0 to 9 in the languages of the texts.
DIGIT_NAMES = (
    ("zero", "oh", "null", "zéro", "cero"),
    ("one", "eins", "un", "uno"),
    ("two", "zwei", "deux", "dos"),
    ("three", "drei", "trois", "tres"),
    ("four", "vier", "quatre", "cuatro"),
    ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "sept", "siete"),
    ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
# Words for the signs @ . + in disguised identifiers.
AT_NAMES = ("at", "arroba", "arobase", "klammeraffe")
DOT_NAMES = ("dot", "punkt", "point", "punto", "period")
PLUS_NAMES = ("plus",)

CHARACTERS = {ord(c): plain_one for plain_one, alike in LOOK_ALIKES.items() for c in alike}
CHARACTERS |= {c: chr(0x21 + c - 0xFF01) for c in range(0xFF01, 0xFF5F)}
CHARACTERS |= {ord(c): "" for c in INVISIBLE}
#: Letters are rewritten in a word only beside ASCII letters, digits or signs; digits of any script always.
ODD = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ſ]")
DIGIT_OF = {name: str(d) for d, names in enumerate(DIGIT_NAMES) for name in names}
NUMBER_WORD = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
AT, DOT, PLUS = ("|".join(names) for names in (AT_NAMES, DOT_NAMES, PLUS_NAMES))
# Letters of scripts without blanks between words: an identifier may stand directly beside them.
UNSPACED = "\u0e00-\u0eff\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff"
BEFORE, AFTER = rf"(?<![^\W{UNSPACED}])", rf"(?![^\W{UNSPACED}])"
NUMBER = rf"(?:(?:{NUMBER_WORD}){AFTER}|[0-9]++)"
# At least four numbers in a row with blanks, hyphens, points or spelled points between them.
SPELLED = re.compile(rf"{BEFORE}{NUMBER}(?:(?: (?:{DOT}) |[ -]{{1,2}}|\.){NUMBER}){{3,}}", re.I)
SPELLED_HINT = re.compile(rf"{BEFORE}(?:(?:{NUMBER_WORD})[ .-]{{1,2}}(?:{NUMBER_WORD}|[0-9])|[0-9] (?:{DOT}) [0-9])", re.I)
SPELLED_PART = re.compile(r"[^\W\d]+|[0-9]+|[ -]+|\.")
OPEN, CLOSE = r"[\[({<]", r"[\])}>]"
BRACKET_SIGN = re.compile(rf" ?{OPEN} ?(?:(?P<at>{AT}|@)|(?P<dot>{DOT}|\.)) ?{CLOSE} ?|(?P<atref>&#0*64;|&commat;)|(?P<dotref>&#0*46;|&period;)", re.I)
#: name at host dot tld, all signs spelled without brackets.
SPOKEN = re.compile(
    rf"(?<![\w.%+-])[\w%+-]{{1,64}}(?:(?:\.| (?:{DOT}) )[\w%+-]{{1,64}}){{0,8}}(?:@| (?:{AT}) )"
    rf"[A-Za-z0-9-]{{1,63}}(?: (?:{DOT}) [A-Za-z0-9-]{{1,63}}|\.[A-Za-z0-9-]{{1,63}}){{0,8}} (?:{DOT}) [A-Za-z]{{2,24}}(?!@){AFTER}",
    re.I,
)
SPOKEN_HINT = re.compile(rf" (?:{DOT}) [A-Za-z]", re.I)
SPOKEN_SIGN = re.compile(rf" (?:(?P<at>{AT})|(?P<dot>{DOT})) ", re.I)
PLUS_WORD = re.compile(rf"{BEFORE}(?<![0-9] )(?:{PLUS}) ?(?=[0-9])", re.I)


class Tape:
    """A text and, for each part that was rewritten, where it stood before.

    ``edits`` holds (start, end, new text) in order; positions between them are kept.
    """

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        out, at, size = [], 0, 0
        self.new, self.old = [0], [0]  # parts begin here, in the new and in the old text
        self.whole = [False]  # whether the part is one rewritten unit
        for start, end, text in edits:
            out += [source[at:start], text]
            size += start - at
            self.new += [size, size + len(text)]
            self.old += [start, end]
            self.whole += [True, False]
            size, at = size + len(text), end
        out.append(source[at:])
        self.text = "".join(out)

    def start(self, position: int) -> int:
        """Where the unit holding the new text's character ``position`` begins in the old text."""
        k = bisect_right(self.new, position) - 1
        return self.old[k] if self.whole[k] else self.old[k] + position - self.new[k]

    def end(self, position: int) -> int:
        """Where the unit holding the character before ``position`` ends in the old text."""
        k = bisect_right(self.new, position - 1) - 1
        return self.old[k + 1] if self.whole[k] else self.old[k] + position - self.new[k]


def characters(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for match in ODD.finditer(text):
        char = match.group()
        new = CHARACTERS.get(ord(char))
        if new is None:
            digit = unicodedata.digit(char, None)
            new = None if digit is None else str(digit)
        if new is not None:
            edits.append((match.start(), match.end(), new))
    return edits


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of at least four numbers with a spelled digit or point lose their names and inner gaps."""
    if not SPELLED_HINT.search(text):
        return []
    edits = []
    for match in SPELLED.finditer(text):
        parts = list(SPELLED_PART.finditer(text, match.start(), match.end()))
        if not any(p.group()[0].isalpha() for p in parts):
            continue
        for part in parts:
            word = part.group().lower()
            if word in DIGIT_OF:
                edits.append((part.start(), part.end(), DIGIT_OF[word]))
            elif word.isalpha():
                edits.append((part.start(), part.end(), "."))
            elif word[0] in " -":
                edits.append((part.start(), part.end(), ""))
    return edits


def signs(text: str) -> list[tuple[int, int, str]]:
    """Bracketed at, dot and character references."""
    return [
        (m.start(), m.end(), "@" if m["at"] or m["atref"] else ".") for m in BRACKET_SIGN.finditer(text)
    ]


def spoken(text: str) -> list[tuple[int, int, str]]:
    """Spelled at and dot inside a whole spoken address; spelled plus."""
    edits = []
    if SPOKEN_HINT.search(text):
        for match in SPOKEN.finditer(text):
            edits += [
                (m.start(), m.end(), "@" if m["at"] else ".")
                for m in SPOKEN_SIGN.finditer(text, match.start(), match.end())
            ]
    edits += [(m.start(), m.end(), "+") for m in PLUS_WORD.finditer(text)]
    return sorted(edits)


CHAIN = (characters, spelled_digits, signs, spoken)
#: Scripts with blanks between words, whose letters belong to the address they touch.
SPACED = ("LATIN ", "GREEK ", "CYRILLIC ", "ARMENIAN ")


def joined(char: str) -> bool:
    """Whether ``char`` is a letter beyond ASCII, or a mark on one, that continues a word."""
    return char > "\x7f" and (unicodedata.combining(char) > 0 or char.isalpha() and unicodedata.name(char, "").startswith(SPACED))


def widened(text: str, start: int, end: int) -> tuple[int, int]:
    """An address with the rest of its first and of its last word, where letters beyond ASCII cut them off."""
    if joined(text[start - 1 : start]):
        while start and (text[start - 1] in LOCAL_SET or joined(text[start - 1])):
            start -= 1
    if joined(text[end : end + 1]):
        goes_on = lambda c: c == "-" or c.isascii() and c.isalnum() or joined(c)
        while goes_on(text[end : end + 1]) or text[end : end + 1] == "." and goes_on(text[end + 1 : end + 2]):
            end += 1
    return start, end


def source(tapes: list[Tape], start: int, end: int) -> tuple[int, int]:
    """Where a span of the rewritten text stood in the source."""
    for tape in reversed(tapes):
        start, end = tape.start(start), tape.end(end)
    return start, end


def foreign(part: str, new: str) -> bool:
    """Whether a source text that became ``new`` is a word wholly of another script, with none of its signs rewritten."""
    return not any(c.isascii() and c.isalnum() for c in part) and all(part.count(c) == new.count(c) for c in "@.")


def find_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, found in plain form) by start, then by kind."""
    text = text or ""
    base = plain(text)
    tapes, now = [], text
    for rewrite in CHAIN:
        edits = rewrite(now)
        if edits:
            tapes.append(Tape(now, edits))
            now = tapes[-1].text
    found = [(kind, s, e, True) for kind, s, e in base]
    if tapes:
        for kind, start, end in plain(now):
            first, last = source(tapes, start, end)
            if any(k == kind and s <= first and last <= e for k, s, e in base):
                continue
            wide = widened(now, start, end) if kind == "email" else (start, end)
            if wide != (start, end):
                first, last = source(tapes, *wide)
                if foreign(text[first:last], now[slice(*wide)]):
                    continue
            found.append((kind, first, last, False))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def detect(df: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``df`` plus ``into``: the spans of every text, an empty array where there are none."""

    def make():
        names = ("kind", "start", "end", "base")
        return lambda texts: {into: [[dict(zip(names, s)) for s in find_spans(t)] for t in texts]}

    return add_columns(df, f"`{into}` {SPANS}", text, make)


def redacted(text: str | None) -> str | None:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, start, end, _ in find_spans(text):
        if start >= at:
            out += [text[at:start], "[", kind.upper(), "]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the personal data in ``text`` replaced; null stays null, the columns keep their order."""

    def make():
        return lambda texts: {text: [redacted(t) for t in texts]}

    source = free_name(df, "_source")
    return add_columns(df.withColumn(source, F.col(text)), f"`{text}` string", source, make).select(*df.columns)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: (s["kind"] == kind) & s["base"])).cast("long")
