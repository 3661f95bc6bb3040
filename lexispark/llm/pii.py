"""Personal data: exact patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole spans of up to LONGEST tokens: shape, length, digits, separators and the words around a span are
features of the span as one piece. A text splits exactly at tokens that no entity can hold (no digit, @ or spelled-out
address word), so the dynamic programming runs over short runs of candidate tokens and chooses boundaries and kinds
of all of a run's spans jointly.
"""

from __future__ import annotations

import functools
import random
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import lean, short_batches

# Kinds, in order; the first four also have exact patterns.
KINDS = ("email", "ip", "card", "phone", "secret")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
# An address starts where its run of digits starts, so later digits of the run needn't be tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SOME = re.compile(r"[0-9@]")
SPELLED = re.compile(r"[(\[][Aa][Tt][)\]]")
# A spelled-out part of an address; a line without one has candidates by their own letters only.
BRACKETED = re.compile(r"[(\[](?:[Aa][Tt]|[Dd][Oo][Tt])[)\]]")

#: Tokens of a span at most.
LONGEST = 6
#: Generated sentences and passes of training, step and ridge.
SENTENCES, PASSES, RATE, RIDGE = 600, 8, 0.5, 1e-4
TOKEN = re.compile(r"[^\s,;:!?\"<>|]+")
GAP = re.compile(r"[\s,;:!?\"<>|]*+")
#: Tokens that candidate() takes, in a line without spelled-out parts; each letter is looked at once.
CANDIDATE = re.compile(r"(?<![^\s,;:!?\"<>|])(?:[^\s,;:!?\"<>|0-9@]*+[0-9@][^\s,;:!?\"<>|]*+|[-()](?![^\s,;:!?\"<>|]))")
#: What spans look like to the features: letters by case, and digits.
MASK = str.maketrans(string.ascii_lowercase + string.ascii_uppercase + string.digits, "a" * 26 + "A" * 26 + "9" * 10)
#: Masked spans whose scores a worker remembers, and the longest of them.
REMEMBERED, SHORT = 100_000, 120

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that don't overlap another of their kind; failing matches go without a retry."""
    out: list[Span] = []
    if not SOME.search(text):
        return out
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and at >= end and (m := DOMAIN.match(text, at + 1)):
            out.append((begin, m.end(), "email"))
            end = m.end()
        at = text.find("@", at + 1)
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((*m.span(), "ip"))
    for kind, pattern, low, high in (("card", CARD, 14, 19), ("phone", PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((*m.span(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidate(token: str) -> bool:
    """What an entity's tokens are made of: a digit or @, brackets, or a spelled-out "at" or "dot" in brackets."""
    return bool(SOME.search(token)) or token.lower() in ("(at)", "[at]", "(dot)", "[dot]") or token in ("-", "(", ")")


def shape(token: str) -> str:
    """Runs of characters as A, a, 9, x (other letters) or themselves, with a count up to 4."""
    out = re.sub(r"[^\W\d_a-zA-Z]+", "x", token)
    return re.sub(r"([Aa9])\1{4,}", r"\1\1\1\1+", re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", out))))


def checked(whole: str) -> bool:
    """Whether a span is 14 digits or more that pass Luhn, with blanks and hyphens at most."""
    digits = sum(map(str.isdigit, whole)) if len(whole) >= 14 else 0
    return digits >= 14 and whole.replace(" ", "").replace("-", "").isdigit() and luhn(re.sub("[^0-9]", "", whole))


@functools.lru_cache(1 << 14)
def parts(piece: tuple[str, ...]) -> tuple[str, ...]:
    """A span's features, whatever its kind. They depend on MASK's image of it, on "(at)" and on checked() alone."""
    whole = " ".join(piece).rstrip(".")
    digits = sum(c.isdigit() for c in whole)
    marks = "".join(sorted({c for c in whole if not c.isalnum() and c != " "}))
    upper, lower = any(c.isupper() for c in whole), any(c.islower() for c in whole)
    return (
        "bias", f"n{len(piece)}", f"d{digits if digits < 20 else 20}", f"m{marks}", f"s{shape(whole)}"[:60], f"u{upper}l{lower}d{digits > 0}",
        f"len{min(len(whole) // 4, 12)}", f"dots{whole.count('.')}", f"at{'@' in whole or '(at)' in whole.lower()}", f"luhn{checked(whole)}",
        f"b{shape(piece[0])}"[:20], f"e{shape(piece[-1])}"[:20],
    )


def segment_features(tokens: list[str], begin: int, end: int, kind: str) -> list[str]:
    return [f"{kind}:{p}" for p in parts(tuple(tokens[begin:end]))]


class SemiCRF:
    """Weights of span features; spans outside entities have one token and kind "none" with features of their own."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[tuple[str, bool, bool], tuple[float, str]] = {}

    def score(self, tokens: list[str], begin: int, end: int, kind: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in segment_features(tokens, begin, end, kind))

    def spans(self, tokens: list[str], end: int) -> list[tuple[int, str, float]]:
        """The spans that end there: begin, kind, score. Kinds other than none need a digit or an @, spelled out or not."""
        mine = [(end - 1, "none", self.score(tokens, end - 1, end, "none"))]
        for begin in range(max(0, end - LONGEST), end):
            if any(SOME.search(t) for t in tokens[begin:end]) or any(t.lower() in ("(at)", "[at]") for t in tokens[begin:end]):
                mine += [(begin, kind, self.score(tokens, begin, end, kind)) for kind in KINDS]
        return mine

    def lattice(self, tokens: list[str]) -> list[list[tuple[int, str, float]]]:
        """For each end, the spans that end there."""
        return [[], *(self.spans(tokens, end) for end in range(1, len(tokens) + 1))]

    def best_kind(self, tokens: list[str], begin: int, end: int, key: tuple[str, bool, bool]) -> tuple[float, str]:
        """The score and kind of the best entity in a span; remembered by what its features depend on."""
        if (found := self.known.get(key)) is None:
            found = max(((self.score(tokens, begin, end, kind), kind) for kind in KINDS), key=lambda x: x[0])
            if len(key[0]) <= SHORT:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[key] = found
        return found

    def decode(self, tokens: list[str]) -> list[tuple[int, int, str]]:
        """The best segmentation's entities, as spans() gives them; in time and memory that grow with the run."""
        best, back = [0.0], [(0, "none")]
        masks, low = [t.translate(MASK) for t in tokens], [t.lower() for t in tokens]
        held = [bool(SOME.search(t)) or x in ("(at)", "[at]") for t, x in zip(tokens, low, strict=True)]
        for end in range(1, len(tokens) + 1):
            top = (best[end - 1] + self.score(tokens, end - 1, end, "none"), 1 - end, "none")
            mask = whole = ""
            some = spelled = False
            for begin in range(end - 1, max(0, end - LONGEST) - 1, -1):
                mask, whole = (f"{masks[begin]} {mask}", f"{tokens[begin]} {whole}") if whole else (masks[begin], tokens[begin])
                some, spelled = some or held[begin], spelled or "(at)" in low[begin]
                if some:
                    score, kind = self.best_kind(tokens, begin, end, (mask, spelled, checked(whole.rstrip("."))))
                    if (best[begin] + score, -begin) > top[:2]:
                        top = (best[begin] + score, -begin, kind)
            best.append(top[0])
            back.append((-top[1], top[2]))
        at, found = len(tokens), []
        while at:
            begin, kind = back[at]
            if kind != "none":
                found.append((begin, at, kind))
            at = begin
        return found[::-1]

    def gradient(self, tokens: list[str], truth: set[tuple[int, int, str]]) -> tuple[dict[str, float], float]:
        """Of the log-likelihood, by forward and backward sums over all segmentations; and the log-likelihood."""
        lattice, n = self.lattice(tokens), len(tokens)
        forward = np.full(n + 1, -np.inf)
        backward = np.full(n + 1, -np.inf)
        forward[0] = backward[n] = 0
        for end in range(1, n + 1):
            forward[end] = np.logaddexp.reduce([forward[b] + s for b, _, s in lattice[end]])
        for end in range(n, 0, -1):
            for b, _, s in lattice[end]:
                backward[b] = np.logaddexp(backward[b], backward[end] + s)
        inside = {k for b, e, _ in truth for k in range(b, e)}
        gold = truth | {(k, k + 1, "none") for k in range(n) if k not in inside}
        out: dict[str, float] = {}
        like = -forward[n]
        for end in range(1, n + 1):
            for b, kind, s in lattice[end]:
                p = ((b, end, kind) in gold) - np.exp(forward[b] + s + backward[end] - forward[n])
                like += s * ((b, end, kind) in gold)
                if abs(p) > 1e-4:
                    for f in segment_features(tokens, b, end, kind):
                        out[f] = out.get(f, 0.0) + p
        return out, like


def _sentence(rng: random.Random) -> tuple[list[str], set[tuple[int, int, str]]]:
    """A generated run of tokens with entities and other numbers."""
    digits = lambda n: "".join(rng.choice(string.digits) for _ in range(n))
    word = lambda: "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 9)))

    def card() -> str:
        body = digits(15)
        return next(body + c for c in string.digits if luhn(body + c))

    def phone() -> list[str]:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([[f"+{rng.randint(1, 99)}", f"({a})", f"{b}-{c}"], [f"({a})", f"{b}-{c}"], [f"{a}-{b}-{c}"], [f"+{rng.randint(1, 99)}", a, b, c], [f"{a}.{b}.{c}"]])

    make = {
        "email": lambda: rng.choice([[f"{word()}.{digits(2)}@{word()}.{word()}.com"], [f"{word()}@{word()}.org"], [word() + digits(1), "(at)", f"{word()}.com"]]),
        "ip": lambda: [".".join(str(rng.randint(0, 255)) for _ in range(4))],
        "card": lambda: (lambda c: rng.choice([[c], [c[k : k + 4] for k in range(0, 16, 4)], ["-".join(c[k : k + 4] for k in range(0, 16, 4))]]))(card()),
        "phone": phone,
        "secret": lambda: ["AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(16)) + rng.choice("0123456789")],
    }
    other = lambda: rng.choice([digits(rng.randint(1, 6)), f"{digits(2)}.{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(1)}", word() + digits(2), digits(16), f"{rng.randint(1, 31)}/{rng.randint(1, 12)}/{digits(4)}", f"{digits(4)}-{digits(2)}-{digits(2)}", "(" + digits(1) + ")", digits(2) + "%", f"{word()}@"])
    tokens: list[str] = []
    spans: set[tuple[int, int, str]] = set()
    for _ in range(rng.randint(1, 3)):
        if rng.random() < 0.6:
            kind = rng.choice(KINDS)
            piece = make[kind]()
            spans.add((len(tokens), len(tokens) + len(piece), kind))
            tokens += piece
        else:
            tokens.append(other())
    return tokens, spans


@functools.lru_cache(2)
def train(seed: int = 11) -> SemiCRF:
    """Conditional likelihood by AdaGrad on SENTENCES generated runs: a bounded sample, alike at every corpus size."""
    rng = random.Random(seed)
    data = [_sentence(rng) for _ in range(SENTENCES)]
    model, seen = SemiCRF({}), {}
    for _ in range(PASSES):
        rng.shuffle(data)
        for tokens, spans in data:
            for f, g in model.gradient(tokens, spans)[0].items():
                g -= RIDGE * model.weights.get(f, 0.0)
                seen[f] = seen.get(f, 0.0) + g * g
                model.weights[f] = model.weights.get(f, 0.0) + RATE * g / np.sqrt(seen[f] + 1e-3)
    model.weights = {f: float(w) for f, w in model.weights.items() if abs(w) > 1e-3}
    return model


def added_spans(text: str, base: list[Span], model: SemiCRF) -> list[Span]:
    """The field's entities that overlap no base span."""
    if not SOME.search(text) and not SPELLED.search(text):
        return []
    out: list[Span] = []
    taken = sorted((b, e) for b, e, _ in base)
    at = -1
    for run in _runs(text):
        for b, e, kind in model.decode([text[x:y] for x, y in run]):
            begin, end = run[b][0], run[e - 1][1]
            while end > begin and text[end - 1] in ".":
                end -= 1
            if end > max(begin, at) and not any(x < end and begin < y for x, y in taken):
                out.append((begin, end, kind))
                at = end
    return out


def _runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Neighbouring candidate tokens of a line, where one has a digit, an @ or a spelled-out one."""
    line = 0
    while line <= len(text):
        end = text.find("\n", line)
        end = len(text) if end < 0 else end
        if SOME.search(text, line, end) or SPELLED.search(text, line, end):
            run: list[tuple[int, int]] = []
            for x, y in _candidates(text, line, end):
                if run and not GAP.fullmatch(text, run[-1][1], x):
                    yield from [run] * _holds(text, run)
                    run = []
                run.append((x, y))
            yield from [run] * _holds(text, run)
        line = end + 1


def _candidates(text: str, line: int, end: int) -> Iterator[tuple[int, int]]:
    """The places of a line's candidate tokens; words next to a spelled-out part of an address belong to it."""
    if not BRACKETED.search(text, line, end):
        yield from (m.span() for m in CANDIDATE.finditer(text, line, end))
        return
    before, now = False, None
    for m in [*TOKEN.finditer(text, line, end), None]:
        part = bool(m) and bool(BRACKETED.fullmatch(m.group()))
        if now and (before or part or candidate(now.group())):
            yield now.span()
        before, now = bool(now) and bool(BRACKETED.fullmatch(now.group())), m


def _holds(text: str, run: list[tuple[int, int]]) -> bool:
    return any(SOME.search(text, x, y) or SPELLED.search(text, x, y) for x, y in run)


FOUND = "doc_id bigint, base array<struct<begin:bigint, end:bigint, kind:string>>, added array<struct<begin:bigint, end:bigint, kind:string>>"


@lean
def _find(batches: Iterable[pa.RecordBatch], model: SemiCRF) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    rows = lambda spans: [{"begin": b, "end": e, "kind": k} for b, e, k in spans]
    for batch in batches:
        base, added = [], []
        for t in batch.column(1):
            text = t.as_py() or ""
            base.append(base_spans(text))
            added.append(added_spans(text, base[-1], model))
        yield pa.record_batch([batch.column(0), pa.array(map(rows, base), kind), pa.array(map(rows, added), kind)], names=["doc_id", "base", "added"])


def personal_data(docs: DataFrame, model: SemiCRF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """FOUND for each row: spans in code points, ends exclusive; base by the patterns, added by the field.

    Null and empty texts have no spans; texts of any length are read whole; repeated rows and null doc_ids give a row
    each; an empty table gives no rows; columns other than the two named are not read.
    """
    short_batches(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(functools.partial(_find, model=model), FOUND)


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    ranked = F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), F.array_position(F.lit(list(KINDS)), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(ranked), lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
