"""French number words: a scanner for runs of them, and readers by a small grammar.

A text is scanned once into tokens; rules look at runs of number tokens and at what stands on either side, and so need no
pattern that spells all numbers out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

# --- Fixed values: words for numbers -------------------------------------------------------------------------------
UNITS = {
    "zéro": 0, "un": 1, "une": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "six": 6, "sept": 7, "huit": 8, "neuf": 9,
    "dix": 10, "onze": 11, "douze": 12, "treize": 13, "quatorze": 14, "quinze": 15, "seize": 16,
}
TENS = {"vingt": 20, "trente": 30, "quarante": 40, "cinquante": 50, "soixante": 60}
REGIONAL_TENS = {"septante": 70, "octante": 80, "huitante": 80, "nonante": 90}
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}

VALUES = UNITS | TENS | {"vingts": 20}
SCALES = {"cent": 100, "cents": 100, "mille": 1000, "mil": 1000}
NUMBER_WORDS = frozenset(VALUES) | frozenset(SCALES) | {"et"}
#: Words of days and years.
DATE_WORDS = NUMBER_WORDS - {"zéro", "une"}

_TOKEN = re.compile(r"[\w']+")
_GAP = re.compile(r"[\s-]+")


@dataclass
class Run:
    """Number words beside each other: their places in a text."""

    text: str
    spans: list[tuple[int, int]]

    @property
    def begin(self) -> int:
        return self.spans[0][0]

    @property
    def end(self) -> int:
        return self.spans[-1][1]

    @property
    def words(self) -> list[str]:
        return [self.text[a:b].lower() for a, b in self.spans]


def runs(text: str, vocabulary: frozenset[str]) -> list[Run]:
    """Longest runs of words of the vocabulary with only spaces and hyphens between."""
    out: list[Run] = []
    for m in _TOKEN.finditer(text):
        if m.group().lower() in vocabulary:
            if out and _GAP.fullmatch(text, out[-1].end, m.start()):
                out[-1].spans.append(m.span())
            else:
                out.append(Run(text, [m.span()]))
    return out


def rewritten(text: str, found: Iterable[Run], new: Callable[[Run, str], tuple[int, int, str] | None]) -> str:
    """The text with runs replaced from the last to the first, so that a rule sees what follows a run as rewritten.
    new(run, rest) gives (begin, characters of rest that go, replacement), or None."""
    rest = ""
    at = len(text)
    for run in reversed(list(found)):
        tail = text[run.end : at] + rest
        change = new(run, tail)
        if change is None:
            rest, at = text[run.begin : run.end] + tail, run.begin
        else:
            begin, gone, spelled = change
            rest, at = spelled + tail[gone:], begin
    return text[:at] + rest


# --- Readers -------------------------------------------------------------------------------------------------------
def tail(words: list[str]) -> int | None:
    """0 to 99 in its full spelling: "vingt et un", "soixante et onze" or "soixante onze", "quatre vingts"."""
    match words:
        case [w] if w in UNITS and w != "une":
            return UNITS[w]
        case [w] if w in TENS:
            return TENS[w]
        case ["dix", w] if UNITS.get(w) in (7, 8, 9):
            return 10 + UNITS[w]
        case [w, "et", "un"] if w in TENS:
            return TENS[w] + 1
        case ["soixante", "et", "onze"]:
            return 71
        case ["quatre", "vingt" | "vingts"]:
            return 80
        case ["quatre", "vingt", *rest]:
            low = tail(rest)
            return 80 + low if low and low < 20 else None
        case [w, *rest] if w in TENS and rest:
            low = tail(rest)
            return TENS[w] + low if low and 1 < low < (20 if w == "soixante" else 10) else None
    return None


def year(words: list[str]) -> int | None:
    """1900 to 2099: "mille (mil) neuf cent", "dix neuf cent" or "deux mille", and a number below 100."""
    for head, base in ((["mille", "neuf"], 1900), (["mil", "neuf"], 1900), (["dix", "neuf"], 1900), (["deux", "mille"], 2000)):
        if words[:2] == head:
            if base == 1900:
                if words[2:] == ["cents"] and head[0] != "mil":
                    return base
                if words[2:3] != ["cent"]:
                    return None
            low = words[3:] if base == 1900 else words[2:]
            if not low:
                return base
            n = tail(low)
            return base + n if n else None
    return None


def day(words: list[str]) -> int | None:
    n = tail(words)
    return n if n is not None and 2 <= n <= 31 else None


def number(words: list[str]) -> int | None:
    """One number below a million, read from left to right; None if the words are none, or more than one."""
    if not words or "et" in (words[0], words[-1]):
        return None
    thousands = [k for k, w in enumerate(words) if SCALES.get(w) == 1000]
    if len(thousands) > 1:
        return None
    if thousands:
        head, low = hundred(words[: thousands[0]]), hundred(words[thousands[0] + 1 :])
        return None if head is None or low is None else 1000 * (head or 1) + low
    return hundred(words)


def hundred(words: list[str]) -> int | None:
    """0 to 9999 without "mille": what stands before "cent" counts hundreds."""
    words = [w for w in words if w != "et"]
    at = [k for k, w in enumerate(words) if SCALES.get(w) == 100]
    if len(at) > 1:
        return None
    if at:
        head, low = ten(words[: at[0]]), ten(words[at[0] + 1 :])
        return None if head is None or low is None else 100 * (head or 1) + low
    return ten(words)


def ten(words: list[str]) -> int | None:
    """Words of tens and units: each one either opens a number or fits behind what has been read."""
    value, open_to = 0, 100  # what may follow must be below open_to
    for k, w in enumerate(words):
        v = VALUES.get(w)
        if v is None:
            return None
        if v == 20 and k and VALUES[words[k - 1]] == 4 and value % 100 == 4:
            value, open_to = value + 76, 20
        elif k == 0 or not value:
            value, open_to = value + v, {0: 100, 10: -1, 60: 20}.get(v, 10 if v in TENS.values() else 0)
        elif v < open_to or (open_to == -1 and v in (7, 8, 9)):
            value, open_to = value + v, 10 if v == 10 else 0
        else:
            return None
    return value


def roman(text: str) -> int | None:
    """A lenient reader: a numeral smaller than the largest one behind it counts against it."""
    if any(c not in ROMAN for c in text):
        return None
    values = [ROMAN[c] for c in text]
    return sum(v if v >= max(values[k:]) else -v for k, v in enumerate(values))


def loose(words: Iterable[str], value_of: dict[str, int]) -> int:
    """Lenient: words beside each other add up, four and twenty multiply, cent and mille scale what stands before."""
    done, now, last = 0, 0, None
    for w in words:
        if (v := value_of.get(w)) is None:
            continue
        if v == 1000:
            done, now = done + 1000 * max(now, 1), 0
        elif v == 100:
            now = 100 * max(now, 1)
        elif (last, v) == (4, 20):
            now += 76
        else:
            now += v
        last = v
    return done + now
