"""Personal data in texts, disguised writing included, at source offsets.

Plain identifiers are found first, by the base rules below. Then transducers
rewrite the text and keep, for every character they write, the range of source
characters it stands for:

1. characters: look-alike letters, digits and signs of other scripts become
   ASCII, invisible characters vanish;
2. words: spelled digits within a run of digits become digits;
3. signs: ``[at]`` and ``(dot)`` become ``@`` and ``.``; so do the bare words, in
   any mix with plain signs, ``dot`` between four numbers or in the host (and then
   the name) of an address, ``at`` between a name and such a host. Where all dots
   of the host are plain, the host must end in letters and the word before ``at``
   must not be one of a short list ("look at example.com").

The base rules run again over the rewritten text, and what they find is mapped
back. Such a span is added if it covers a rewritten character and overlaps no
base span. Texts without any trigger (most) skip the second pass.

Base rules, leftmost and without overlap within a kind, failing matches dropped
without retries: e-mail; IPv4 address, parts at most 255; payment card of 13 to
19 digits passing the Luhn test; telephone number of 9 to 15 digits after a
plus sign. Offsets are code points, the end exclusive.

Defined results: null and empty texts hold nothing. ``masked`` replaces every
span by its kind in angle brackets; where spans of different kinds overlap, the
union is replaced by the kind that starts first (kinds in the order listed when
they start together).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import by_bytes

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A digit run is entered at its start only, so that no run is tried twice.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> list[Span]:
    """The text before each sign is walked at most once: no run is tried twice."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            spans.append((start, found.end()))
        end = found.end() if found else at + 1
        at = text.find("@", end)
    return spans


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def _octet(part: str) -> bool:
    return len(part) < 3 or len(part) == 3 and part <= "255"


def find_plain(text: str) -> dict[str, list[Span]]:
    """Base spans of each kind."""
    return {
        "email": _emails(text),
        "ip": [
            m.span() for m in _IP.finditer(text)
            if all(_octet(p.lstrip("0")) for p in m.group().split("."))
        ],
        "card": list(_cards(text)),
        "phone": [
            m.span() for m in _PHONE.finditer(text)
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15
        ] if "+" in text else [],
    }


# Letters of other scripts that look like a Latin one.
_LOOKALIKES = dict(zip(
    "АВЕКМНОРСТУХаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορνι",
    "ABEKMHOPCTYXaeopcyxijsdqwABEZHIKMNOPTYXaopvi",
)) | {"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "·": "."}
_INVISIBLE = frozenset("\u00ad\u200b\u200c\u200d\u2060\ufeff")
# Digits as words in the languages of the corpus.
_DIGIT_WORDS = {
    w: str(d)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for d, w in enumerate(words.split())
}
_WORD = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_UNIT = rf"(?:\b(?:{_WORD})\b|[0-9]++)"
_DOT_WORD = r"(?:dot|punkt|point|punto)"
#: A run of digits of which some are words; dots may be words as well.
_SPELLED = re.compile(
    rf"(?:\bplus[ -]+)?{_UNIT}(?:(?:[ .,()-]{{1,3}}|[ ]+{_DOT_WORD}[ ]+){_UNIT}){{3,}}", re.IGNORECASE
)
_SPELLED_TOKEN = re.compile(rf"\b(?:{_WORD}|plus)\b|[ ]+{_DOT_WORD}[ ]+", re.IGNORECASE)
_HAS_WORD = re.compile(rf"\b(?:{_WORD})\b", re.IGNORECASE)
_SIGN = re.compile(
    r"[ ]*[\[({<][ ]*(?P<at>at|@)[ ]*[\])}>][ ]*|[ ]*[\[({<][ ]*(?:dot|punkt|point|punto|\.)[ ]*[\])}>][ ]*",
    re.IGNORECASE,
)
#: What follows the name in an address, the sign or a dot of the host a word.
_HOST = re.compile(
    rf"(?:@|(?<! )[ ]++(?P<at>at)[ ]++)(?=[A-Za-z0-9-])"
    rf"[A-Za-z0-9-]++(?:(?:[ ]++{_DOT_WORD}[ ]++|\.)(?P<last>[A-Za-z0-9-]++))++", re.IGNORECASE
)
_BARE_AT = re.compile(r"[ ]+at[ ]+", re.IGNORECASE)
_BARE_DOT = re.compile(rf"(?<! )[ ]++{_DOT_WORD}[ ]+", re.IGNORECASE)
_DOT_BEFORE = (" dot ", " punkt ", " point ", " punto ")
#: Four numbers, dots as signs or words.
_WORD_IP = re.compile(
    rf"(?<![0-9])[0-9]{{1,3}}(?![0-9])(?:(?:[ ]++{_DOT_WORD}[ ]++|\.)[0-9]{{1,3}}(?![0-9])){{3}}", re.IGNORECASE
)
# Words before "at" that make it no sign where the host has plain dots only.
_NO_NAME = frozenset(
    "a about all am and are arrive arrived available be been buy call called check contact find found go have he "
    "her here him hosted is it live look looked located me meet mirrored more not now often on online only open or "
    "order out page published read register see seen she shop sign site sold start stay that the them there they "
    "this those up us visit was we were work worked working works you".split()
)
#: Texts without any of these hold nothing disguised (for RE2, which is linear).
TRIGGER = (
    rf"(?i)[\[({{<] *(?:at|@|dot|punkt|point|punto|\.) *[\])}}>]| at +[a-z0-9-]+(?: +{_DOT_WORD} |\.[a-z0-9-])"
    rf"|@[a-z0-9.-]+ +{_DOT_WORD} +[a-z0-9-]|[0-9] +{_DOT_WORD} +[0-9]"
    rf"|\b(?:{_WORD})(?:[ .,()-]{{1,3}}| +{_DOT_WORD} +)(?:{_WORD}|[0-9])"
    rf"|[0-9](?:[ .,()-]{{1,3}}| +{_DOT_WORD} +)(?:{_WORD})\b"
    r"|[\x{aa}\x{ad}\x{b2}\x{b3}\x{b7}\x{b9}\x{ba}]|[^\x{00}-\x{ff}]"
)


@lru_cache(maxsize=4096)
def _plain_character(c: str) -> str:
    """What a character outside ASCII reads as."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded.isascii() and not folded.isspace() else c


class Rewritten:
    """A text under rewriting: characters with their source ranges."""

    def __init__(self, text: str):
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))
        self.changed = bytearray(len(text))

    def characters(self) -> None:
        odd = {c: p for c in set(self.text) if c > "\x7f" and (p := _plain_character(c)) != c}
        if not odd:
            return
        out, keep = [], []
        for k, c in enumerate(self.text):
            if c not in odd:
                out.append(c)
                keep.append(k)
            elif odd[c]:
                out.append(odd[c])
                keep.append(k)
                self.changed[k] = 1
            elif keep:  # an invisible character belongs to the one before
                self.changed[keep[-1]] = 1
        starts = [self.starts[k] for k in keep]
        ends = [self.ends[k] for k in keep]
        self.text, self.starts, self.ends = "".join(out), starts, ends
        self.changed = bytearray(self.changed[k] for k in keep)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put a string of one character or none in place of each range."""
        if not edits:
            return
        parts, starts, ends, changed, last = [], [], [], bytearray(), 0
        for a, b, new in edits:
            parts += [self.text[last:a], new]
            starts += self.starts[last:a] + [self.starts[a]] * len(new)
            ends += self.ends[last:a] + [self.ends[b - 1]] * len(new)
            changed += self.changed[last:a] + b"\x01" * len(new)
            last = b
        self.text = "".join(parts) + self.text[last:]
        self.starts = starts + self.starts[last:]
        self.ends = ends + self.ends[last:]
        self.changed = changed + self.changed[last:]

    def spelled_digits(self) -> None:
        edits = []
        for run in _SPELLED.finditer(self.text):
            if not _HAS_WORD.search(run.group()):
                continue
            end = run.start()
            for token in _SPELLED_TOKEN.finditer(self.text, run.start(), run.end()):
                a, b = token.span()
                word = token.group().strip().lower()
                new = _DIGIT_WORDS.get(word) or ("+" if word == "plus" else ".")
                if a > end and new not in ".+" and self.text[end:a] in (" ", "-", ", ", ","):
                    a = end  # one separator between spelled digits goes
                elif new == "+":
                    while b < run.end() and self.text[b] in " -":
                        b += 1
                edits.append((a, b, new))
                end = b
        self.replace(edits)

    def signs(self) -> None:
        self.replace([(*m.span(), "@" if m.group("at") else ".") for m in _SIGN.finditer(self.text)])
        text = self.text
        self.replace([
            (*d.span(), ".") for m in _WORD_IP.finditer(text) for d in _BARE_DOT.finditer(text, *m.span())
        ])
        edits, text = [], self.text
        for m in _HOST.finditer(text):
            dots = [(*d.span(), ".") for d in _BARE_DOT.finditer(text, m.start() + 1, m.end())]
            if not dots and not m.group("at"):
                continue  # written plainly
            here, floor = [], edits[-1][1] if edits else 0
            start = m.start()
            while True:  # names joined by dot words, from right to left
                while start > floor and text[start - 1] in _LOCAL:
                    start -= 1
                dot = next((d for d in _DOT_BEFORE if text[max(0, start - len(d)):start].lower() == d), "")
                if not dot or start - len(dot) <= floor:
                    break
                here.append((start - len(dot), start, "."))
                start -= len(dot)
            if start == m.start():
                continue
            if not dots and not here:
                last = m.group("last")
                if text[start:m.start()].lower() in _NO_NAME or not (last.isalpha() and len(last) > 1):
                    continue
            edits += here[::-1]
            if m.group("at"):
                edits.append((*_BARE_AT.match(text, m.start()).span(), "@"))
            edits += dots
        self.replace(edits)


def find_disguised(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans that appear only once the text is rewritten, at source offsets."""
    none: dict[str, list[Span]] = {k: [] for k in KINDS}
    new = Rewritten(text)
    new.characters()
    new.spelled_digits()
    new.signs()
    if 1 not in new.changed:
        return none
    taken = sorted(s for spans in plain.values() for s in spans)
    for kind, spans in find_plain(new.text).items():
        for a, b in spans:
            source = (new.starts[a], new.ends[b - 1])
            clear = all(source[1] <= s or e <= source[0] for s, e in taken)
            if clear and 1 in new.changed[a:b]:
                none[kind].append(source)
    return none


def find_all(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and base and added spans together."""
    plain = find_plain(text)
    more = find_disguised(text, plain)
    return plain, {k: sorted(plain[k] + more[k]) for k in KINDS}


def find_each(column: pa.Array) -> list[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
    """``find_all`` of every text; those without a trigger are not rewritten."""
    odd = pc.match_substring_regex(column, TRIGGER).to_pylist()
    plain = [find_plain(t or "") for t in column.to_pylist()]
    return [find_all(t.as_py()) if o else (p, p) for t, o, p in zip(column, odd, plain)]


def masked(text: str, spans: dict[str, list[Span]]) -> str:
    every = sorted((a, KINDS.index(k), b) for k, some in spans.items() for a, b in some)
    parts, last = [], 0
    for a, kind, b in every:
        if a >= last:
            parts += [text[last:a], f"<{KINDS[kind]}>"]
        last = max(last, b)
    return "".join(parts) + text[last:]


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


DIGESTS = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_added long"
)


def detect(df: DataFrame) -> DataFrame:
    """Per document of (doc_id, text): counts and digest of the base spans, every
    span, and how many of them the rewriting added."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = find_each(part.column("text"))
                counts = [[len(p[k]) for p, _ in found] for k in KINDS]
                digests = [hashlib.sha256(_listed(p).encode()).hexdigest() for p, _ in found]
                added = [
                    sum(map(len, e.values())) - sum(map(len, p.values())) for p, e in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(digests, pa.string()),
                        pa.array([_listed(e) for _, e in found], pa.string()),
                        pa.array(added, pa.int64()),
                    ],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
                )

    return df.select("doc_id", "text").mapInArrow(work, DIGESTS)


def mask(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced; null stays null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text):
                found = find_each(part.column(text))
                clean = [
                    None if t is None else masked(t, every)
                    for t, (_, every) in zip(part.column(text).to_pylist(), found)
                ]
                at = part.schema.get_field_index(text)
                yield part.set_column(at, text, pa.array(clean, part.schema.field(at).type))

    return df.mapInArrow(work, df.schema)
