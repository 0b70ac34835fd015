"""Whole-word tokens of any script, with light stems where the language has them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions.english import english_stem
from statuta.functions.paths import ZEROS

SLICE = 200
#: A word is a run of letters, numbers and marks; decimal digits of these scripts count as ASCII ones.
_WORD = regex.compile(r"[\p{L}\p{N}\p{M}]+")
_ASCII_WORD = re.compile("[0-9a-z]+")
_OTHER_DIGIT = re.compile("[" + "".join(f"{chr(z)}-{chr(z + 9)}" for z in ZEROS) + "]")
_DIGITS = {zero + i: str(i) for zero in ZEROS for i in range(10)}

# Light stemming of Arabic: the conjunction (unless it belongs to an article), one article, one
# suffix, each only where enough of the word stays. The affixes are fixed values.
_HEAD = regex.compile("^(?:و(?!ال)(?=...))?(?:(?:[وبكف]?ال|لل)(?=..))?")
_TAIL = regex.compile("(?<=..)(?:ها|ان|ات|ون|ين|يه|ه|ي)$")

#: By language: the marks that words are written without, and letters that count as one.
_WITHOUT = {"ara": regex.compile("[\u064b-\u0670\u065f\u0640]"), "heb": regex.compile("[\u0591-\u05c7\u05f3\u05f4]")}
_ALIKE = {"ara": str.maketrans("أإآٱىة", "اااايه")}
_CODES = {"ar": "ara", "arabic": "ara", "he": "heb", "hebrew": "heb", "en": "eng", "english": "eng"}


def arabic_stem(word: str) -> str:
    """Stem of an Arabic word whose letters are folded."""
    return _TAIL.sub("", _HEAD.sub("", word, count=1), count=1)


STEMMERS: dict[str, Callable[[str], str]] = {"ara": arabic_stem}
#: All stemmers there are; the default keeps English words whole.
ALL_STEMMERS = STEMMERS | {"eng": english_stem}


def folded(lang: str | None) -> str:
    """The code that a language's rules go by; a locale's tag counts by its first part."""
    code = regex.split("[-_]", (lang or "").strip().lower(), maxsplit=1)[0]
    return _CODES.get(code, code)


def tokenise(text: str | None, lang: str | None = None, stemmers: dict[str, Callable[[str], str]] = STEMMERS) -> list[str]:
    """The words of a text in the form they are compared in, in order; none is left out."""
    code, text = folded(lang), text or ""
    if text.isascii():
        # Nothing to normalise, fold or leave out.
        words = _ASCII_WORD.findall(text.lower())
    else:
        plain = unicodedata.normalize("NFKC", text)
        if _OTHER_DIGIT.search(plain):
            plain = plain.translate(_DIGITS)
        if code in _WITHOUT:
            plain = _WITHOUT[code].sub("", plain)
        if code in _ALIKE:
            plain = plain.translate(_ALIKE[code])
        # Casefolding a dotted capital I leaves a dot behind, which is no letter of its own. It makes
        # letters and marks of letters and marks only, so that words begin and end where they did.
        words = _WORD.findall(plain.casefold().replace("i\u0307", "i"))
    return list(map(stemmers[code], words)) if code in stemmers else words


def tokens(text: Column, lang: Column | None = None, stemmers: dict[str, Callable[[str], str]] = STEMMERS) -> Column:
    """Array of the tokens of a text in a language (none given: no language's rules)."""

    @F.arrow_udf("array<string>")
    def found(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, langs in batches:
            # Few texts at a time: their words as Python objects take many times the texts' bytes.
            for at in range(0, len(texts), SLICE):
                part = zip(texts[at : at + SLICE].to_pylist(), langs[at : at + SLICE].to_pylist(), strict=True)
                yield pa.array([tokenise(t, x, stemmers) for t, x in part], pa.list_(pa.string()))

    return found(text.cast("string"), F.lit(None).cast("string") if lang is None else lang)
