"""Text functions as columns: built-in expressions where they can say it, fused Arrow functions where not."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import chunking, french, similarity

# --- Fixed values ---------------------------------------------------------------------------------------------------
SENTENCE_ENDS = (".", "!", "?", "…")
REFUSALS = ("je ne peux pas", "je suis désolé", "désolé, je", "désolée, je", "i cannot", "i can't", "i'm sorry", "i am sorry", "sorry, i", "i apologize", "as an ai", "en tant qu'ia", "en tant qu'assistant")
ENGLISH = tuple(f" {w} " for w in "the and is of with for that this from has was were are have".split())
FORBIDDEN = "()—–;\"«»/°µ€’+<>=*&#~→×"
UNIT_SYMBOL = r"\b\d+(?:[.,]\d+)?\s*(mg|kg|mL|mmHg|mmol|mEq|mOsm|kDa|ng|mm|cm|UI)\b"
LEAK = r"(?i:\blet me\b|\bI'll\b|\bI will\b|\bhere (?:is|are)\b|\bas requested\b)|\bSentence \d+\s*:|</?t>"
DEFINITION = [("(", ", "), (")", ", "), ("—", ", "), ("–", ", "), (";", ","), ("«", ""), ("»", ""), ('"', ""), ("/", " par "), ("°", " degrés "), ("µ", "micro"), ("€", " euros"), ("’", "'"), ("α", "alpha"), ("β", "bêta"), ("γ", "gamma"), ("δ", "delta"), ("\n", " "), ("\t", " ")]
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def unicode(pattern: str) -> str:
    """A pattern with Unicode classes, as Python reads it."""
    return "(?U)" + pattern


def strip(c: Column) -> Column:
    """Trim of any white space."""
    return F.regexp_replace(c, unicode(r"^\s+|\s+$"), "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, unicode(r"\s+"), " "))


def unaccented(c: Column) -> Column:
    """Accents of Latin letters, by a closed table."""
    return F.translate(c, ACCENTED, PLAIN)


def text_hash(c: Column) -> Column:
    return F.sha2(strip(c), 256)


def alnum_length(c: Column) -> Column:
    return F.char_length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def starts_capital(c: Column) -> Column:
    return F.regexp_extract(c, r"\p{L}", 0).rlike(r"^\p{Lu}")


def respace(c: Column) -> Column:
    """A space behind a stop that is glued to a capitalised word."""
    return F.regexp_replace(c, r"([.,?!])(\p{Lu})(?!\p{Lu})", "$1 $2")


def uncovered(c: Column, alphabet: list[str]) -> Column:
    """Distinct characters outside the alphabet, in the order of their first places."""
    known = F.array(*map(F.lit, alphabet))
    return F.array_distinct(F.filter(F.split(c, ""), lambda x: (x != "") & ~F.array_contains(known, x)))


def sanitised(c: Column) -> Column:
    for old, new in DEFINITION:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(F.regexp_replace(c, r",(?:\s?,)+", ","), r" {2,}", " ")
    c = F.regexp_replace(F.regexp_replace(c, unicode(r"\s+,"), ","), unicode(r",\s*(?=[.!?:])"), "")
    return F.regexp_replace(c, r"^[ ,]+|[ ,]+$", "")


def without_reasoning(c: Column, tag: str = "think") -> Column:
    """Closed blocks go; an open one takes the rest along."""
    return strip(F.regexp_replace(F.regexp_replace(c, rf"(?is)<{tag}>.*?</{tag}>", ""), rf"(?is)<{tag}>.*$", ""))


def blocks(c: Column, tag: str = "t") -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), 1), lambda x: squeeze(x))


def tagged_score(c: Column, tag: str = "score") -> Column:
    return F.least(F.lit(10), F.greatest(F.lit(0), F.nullif(F.regexp_extract(c, rf"(?is)<{tag}>[^<]*?(-?\d+)", 1), F.lit("")).try_cast("int")))


def brand(c: Column) -> Column:
    """The leading capitals up to a number or the end, else the first word, in capitals."""
    caps = F.trim(F.regexp_extract(F.trim(c), r"^([A-ZÉÈÊÀÂÔÎÛÇ\- ]+?)(?=\s*[0-9,]|$)", 1))
    return F.upper(F.coalesce(F.nullif(caps, F.lit("")), F.element_at(F.split(F.trim(c), r"\s+"), 1)))


def dosage(c: Column) -> Column:
    """(value, unit) of a dosage: decimal commas, thousands groups; null where it can't be read."""
    groups = r"^\s*(\d{1,3}(?:[ \u00A0\u202F]\d{3})+|\d+)(?:[.,](\d+))?\s*(\S.*?)\s*$"
    whole = F.regexp_replace(F.regexp_extract(c, groups, 1), r"[ \u00A0\u202F]", "")
    part = F.regexp_extract(c, groups, 2)
    value = F.concat(whole, F.lit("."), F.when(part == "", "0").otherwise(part)).try_cast("decimal(38,9)")
    return F.when(whole != "", F.struct(value.alias("value"), F.lower(F.regexp_extract(c, groups, 3)).alias("unit")))


def preview(c: Column, n: int) -> Column:
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def default_pronunciation(c: Column) -> Column:
    """Letters one by one, digits together, a comma between hyphenated segments."""
    return F.array_join(F.transform(F.split(c, "-"), lambda s: F.array_join(F.regexp_extract_all(s, F.lit(r"\d+|."), 0), " ")), ", ")


def occurs(text: Column, term: Column) -> Column:
    """Whether the term stands in the text in its own case, not inside a word."""
    return F.regexp_like(text, F.concat(F.lit(r"(?U)(?<!\w)\Q"), term, F.lit(r"\E(?!\w)")))


def substituted(text: Column, term: Column, new: Column) -> Column:
    return F.regexp_replace(text, F.concat(F.lit(r"(?U)(?<!\w)\Q"), term, F.lit(r"\E(?!\w)")), new)


def line_reason(c: Column, ignored: str, shortest: int) -> Column:
    """Why a line is left out: the first rule that holds; null for a line that stays."""
    return (
        F.when(F.char_length(c) < shortest, "too_short").when(c.rlike(f"[{re.escape(ignored)}]"), "ignore_char").when(F.contains(c, F.lit(":")), "colon").when(~c.rlike(r"[.?]$"), "no_end_punct")
        .when(c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}"), "all_caps").when(F.char_length(c) < 2, "too_short").when(~c.rlike(r"(?s)^\p{Lu}\P{Lu}"), "not_cap_start")
    )


def release_reason(status: Column, duplicate: Column, text: Column, duration: Column, flagged: Column, fastest: float = 8.0) -> Column:
    words = F.size(F.filter(F.split(text, unicode(r"\s+")), lambda w: w != ""))
    fast = F.coalesce((duration != 0) & (words / F.nullif(duration, F.lit(0.0)) > fastest), F.lit(False))
    return (
        F.when(status == "exhausted", "exhausted").when(duplicate, "duplicate-of-train").when(text.rlike(r"\.\.\.|…"), "ellipsis")
        .when(text.rlike(unicode(LEAK)), "llm-leak").when(fast, "too-fast").when(flagged, "asr-flagged")
    )


def text_reason(c: Column, alphabet: list[str] | None = None, shortest: int = 40, longest: int = 600) -> Column:
    """The first rule of a single generated text that fails; null if all hold."""
    low = F.lower(c)
    english = functools.reduce(lambda a, b: a + b, [F.contains(F.concat(F.lit(" "), low, F.lit(" ")), F.lit(w)).cast("int") for w in ENGLISH])
    tail = F.regexp_replace(F.regexp_replace(c, unicode(r'["\s]+$'), ""), unicode(r"\s+$"), "")
    out = F.when(~F.char_length(c).between(shortest, longest), "length").when(~tail.rlike(r"[.!?…]$"), "incomplete")
    out = out.when(functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(r)) for r in REFUSALS]), "refusal").when(english >= 3, "english")
    out = out.when(c.rlike("[" + re.escape(FORBIDDEN) + "]"), "forbidden_char")
    if alphabet is not None:
        out = out.when(F.size(uncovered(c, alphabet)) > 0, "uncovered_char")
    return out.when(c.rlike(UNIT_SYMBOL), "unit_symbol").when(c.rlike("[\u00a0\t]|  "), "white_space")


def rewrite_reason(source: Column, c: Column, least: float = 0.08, most: float | None = 2.0) -> Column:
    """Rules of a rewrite: complete, no refusal, characters (and colons), units, length against the source."""
    share = F.char_length(c) / F.char_length(source)
    out = F.when(text_reason(c, shortest=0, longest=1 << 30).isNotNull(), text_reason(c, shortest=0, longest=1 << 30)).when(F.contains(c, F.lit(":")), "forbidden_char").when(share < least, "too_short")
    return out if most is None else out.when(share > most, "too_long")


# --- Arrow functions ------------------------------------------------------------------------------------------------
def text_udf(f: Callable[[str], object], kind: str = "string") -> Callable[..., Column]:
    """A vectorised function of one text; null stays null."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else f(x) for x in s], dtype=object)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}  # real types: Spark reads them
    return F.pandas_udf(run, kind)


def pair_udf(f: Callable[[str, str], object], kind: str) -> Callable[..., Column]:
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype=object)

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, kind)


def fold_accents(c: Column) -> Column:
    return text_udf(french.strip_accents)(c)


def compat_key(c: Column) -> Column:
    """NFKC, lower case, punctuation as spaces: the key of "the same sentence"."""
    return text_udf(lambda x: " ".join(re.sub(r"[^\w\s]", " ", unicodedata.normalize("NFKC", x).lower()).split()))(c)


def slug(c: Column, longest: int = 80) -> Column:
    def one(x: str) -> str:
        plain = unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().lower()
        return re.sub(r"[^a-z0-9]+", "_", plain).strip("_")[:longest] or "term"

    return text_udf(one)(c)


def clean_label(c: Column, covered: frozenset[str] = frozenset()) -> Column:
    """C1 controls as Windows characters, composed, compatibility forms where not covered, no trade marks, one space."""

    def one(x: str) -> str:
        x = re.sub("[\x80-\x9f]", lambda m: m.group().encode("latin-1").decode("cp1252", "ignore"), x)
        x = "".join(ch if ch in covered else unicodedata.normalize("NFKC", ch) for ch in unicodedata.normalize("NFC", re.sub("[™®©]", "", x)))
        return " ".join(x.split())

    return text_udf(one)(c)


def label_conventions(c: Column, caps: dict[str, str] | None = None, variants: dict[str, str] | None = None, source: bool = False) -> Column:
    return text_udf(lambda x: french.label_conventions(x, caps, variants, source))(c)


def scoring_fold(c: Column) -> Column:
    return text_udf(french.scoring_fold)(c)


def spoken_form(c: Column) -> Column:
    return text_udf(french.spoken_form)(c)


def percent_symbol(c: Column) -> Column:
    return text_udf(french.percent_symbol)(c)


def residual_units(c: Column) -> Column:
    return text_udf(french.residual_units, "array<string>")(c)


def chunks(c: Column, cap: int = chunking.CAP, floor: int = chunking.FLOOR) -> Column:
    return text_udf(lambda x: chunking.chunk(chunking.strip_parentheses(x), cap, floor), "array<string>")(c)


def cer(reference: Column, hypothesis: Column) -> Column:
    """Character error rate of folded texts, on the JVM; null for an empty reference."""
    return F.levenshtein(reference, hypothesis) / F.nullif(F.char_length(reference), F.lit(0))


def tail_cer(reference: Column, hypothesis: Column, duration: Column, characters: int = 498, seconds: float = 30.0) -> Column:
    return F.when(duration > seconds, cer(F.right(reference, F.lit(characters)), F.right(hypothesis, F.lit(characters))))


def wer(reference: Column, hypothesis: Column) -> Column:
    return pair_udf(similarity.word_error_rate, "double")(reference, hypothesis)


def indel_ratio(a: Column, b: Column) -> Column:
    return pair_udf(similarity.ratio, "double")(a, b)


def partial_ratio(a: Column, b: Column) -> Column:
    return pair_udf(similarity.partial_ratio, "double")(a, b)


def presence(term: Column, text: Column) -> Column:
    return pair_udf(lambda t, x: similarity.term_presence(t, x)[0], "string")(term, text)


def defects(label: Column, heard: Column, second: Column) -> Column:
    """Kinds and words of what a recogniser's transcript shows to be wrong with a clip."""
    def run(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        words = lambda x: re.findall(r"\w+", x.lower())
        return pd.Series([[f"{k}: {w}" for k, w in similarity.asr_defects(words(x), words(y), None if z is None else words(z))] for x, y, z in zip(a, b, c, strict=True)])

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "c": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<string>")(label, heard, second)
