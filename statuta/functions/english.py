"""The English (Porter2) stemmer, from its published description."""

from __future__ import annotations

import functools
import re

# Fixed values of the description: words with a stem of their own, words left alone, and suffixes by step.
OWN = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
OWN |= dict.fromkeys(["sky", "news", "howe", "atlas", "cosmos", "bias", "andes"])
AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate",
    "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive",
    "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = dict.fromkeys(["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion"], "")

_V, _C = "[aeiouy]", "[^aeiouy]"
_REGION = re.compile(f"(?:^(?:gener|commun|arsen)|^.*?{_V}{_C})(.*)", re.S)
_NEXT = re.compile(f".*?{_V}{_C}(.*)", re.S)
_SHORT = re.compile(f"(?:{_C}{_V}[^aeiouywxY]|^{_V}{_C})$")
_DOUBLE = re.compile(r"(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$")


def _suffixes(table: dict[str, str]) -> re.Pattern:
    return re.compile("(?:" + "|".join(sorted(table, key=len, reverse=True)) + ")$")


_FIND = {2: _suffixes(STEP_2), 3: _suffixes(STEP_3), 4: _suffixes(STEP_4)}


def _regions(word: str) -> tuple[int, int]:
    """Where the regions R1 and R2 begin."""
    first = _REGION.match(word)
    if first is None:
        return len(word), len(word)
    second = _NEXT.match(word, first.start(1))
    return first.start(1), second.start(1) if second else len(word)


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith("s") and not w.endswith(("us", "ss")) and re.search(_V, w[:-2]):
        return w[:-1]
    return w


def _past(w: str, r1: int) -> str:
    found = re.search("(?:eedly|eed|ingly|edly|ing|ed)$", w)
    if found is None:
        return w
    at = found.start()
    if found[0].startswith("eed"):
        return w[:at] + "ee" if at >= r1 else w
    if not re.search(_V, w[:at]):
        return w
    w = w[:at]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _DOUBLE.search(w):
        return w[:-1]
    return w + "e" if _SHORT.search(w) and r1 >= len(w) else w


def _replaced(w: str, step: int, table: dict[str, str], r1: int, r2: int) -> str:
    """The longest suffix of a step replaced, if its region and the letter before it allow."""
    found = _FIND[step].search(w)
    if found is None:
        return w
    at, end = found.start(), found[0]
    region = r2 if step == 4 or end == "ative" else r1
    before = {"ogi": "l", "ion": "st"}.get(end) or (end == "li" and "cdeghkmnrt")
    if at < region or (before and w[at - 1 : at] not in set(before)):
        return w
    return w[:at] + table[end]


@functools.lru_cache(maxsize=1 << 16)
def english_stem(word: str) -> str:
    """Stem of a lower-case English word; words of at most two letters stay as they are."""
    if len(word) < 3:
        return word
    if word in OWN:
        return OWN[word] or word
    w = re.sub("^y|(?<=[aeiouy])y", "Y", word.removeprefix("'"))
    r1, r2 = _regions(w)
    w = _plural(re.sub("'(?:s'?)?$", "", w))
    if w in AFTER_PLURAL:
        return w
    w = _past(w, r1)
    if len(w) > 2 and w[-1] in "yY" and re.match(_C, w[-2]):
        w = w[:-1] + "i"
    for step, table in ((2, STEP_2), (3, STEP_3), (4, STEP_4)):
        w = _replaced(w, step, table, r1, r2)
    if w.endswith("e") and (len(w) > r2 or (len(w) > r1 and not _SHORT.search(w[:-1]))):
        w = w[:-1]
    elif w.endswith("ll") and len(w) > r2:
        w = w[:-1]
    return w.replace("Y", "y")
