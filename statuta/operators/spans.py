"""Spans of a text: numeric tokens behind sentinels that can be taken back, and occurrences of a document's own terms."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import count

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.paths import ZEROS

_D = "0-9" + "".join(f"{chr(z)}-{chr(z + 9)}" for z in ZEROS)
_LABEL = r"(?:Article|Section|Paragraph|Chapter)"
_FOLD = {z + i: str(i) for z in ZEROS for i in range(10)}
#: Kinds of numeric tokens; each takes its spans before those after it.
PATTERNS = (
    ("para_of_article_ref", rf"(?i)\bParagraph\s*\(?[{_D}]+\)?\s+of\s+Article\s*\(?[{_D}]+\)?"),
    ("article_para_ref", rf"(?i)\bArticle\s*\(?[{_D}]+\s*/\s*[{_D}]+\)?"),
    ("article_ref", rf"(?i)\b{_LABEL}\s*\(?[{_D}]+\)?"),
    ("statute_ref", rf"(?i)\b(?:Law|Act|Decree|Regulation|Order)\s+(?:No\.?\s*)?[{_D}]+\s+of\s+[{_D}]{{4}}"),
    ("money", rf"(?i)(?<![{_D}])[{_D}]+(?:[.,][{_D}]+)*\s*(?:Dinars?|Dollars?|Euros?|Pounds?)\b"),
    ("date", rf"(?<![{_D}])[{_D}]{{1,2}}[/.-][{_D}]{{1,2}}[/.-][{_D}]{{4}}(?![{_D}])"),
    ("digits", rf"[{_D}]+"),
)
_COMPILED = [(kind, re.compile(p)) for kind, p in PATTERNS]
DELIMITERS = ("⟨⟩", "‹›")
SLICE = 500


#: Words that a kind's tokens need, one of each list; by these most texts are spared most patterns.
_NEEDS = {
    "para_of_article_ref": (("paragraph",), ("article",)), "article_para_ref": (("article",), ("/",)), "article_ref": (("article", "section", "paragraph", "chapter"),),
    "statute_ref": (("law", "act", "decree", "regulation", "order"),), "money": (("dinar", "dollar", "euro", "pound"),), "date": (("/", ".", "-"),),
}
#: Letters that fold to ASCII ones without being lowered to them.
_FOLDING = re.compile("[İıſK]")
_ANY_DIGIT = re.compile(f"[{_D}]")


def _patterns(text: str) -> list[tuple[str, re.Pattern]]:
    """The kinds that the text may have tokens of."""
    if not _ANY_DIGIT.search(text):
        return []
    if _FOLDING.search(text):
        return _COMPILED
    low = text.lower()
    return [(kind, p) for kind, p in _COMPILED if all(any(w in low for w in words) for words in _NEEDS.get(kind, ()))]


def claimed(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the numeric tokens: kinds in order, a match that meets a span already taken is left out."""
    taken: list[tuple[int, int, str]] = []
    for kind, pattern in _patterns(text):
        for m in pattern.finditer(text):
            at = bisect_left(taken, (m.start(),))
            before, after = taken[at - 1 : at] if at else [], taken[at : at + 1]
            if not (before and before[0][1] > m.start()) and not (after and after[0][0] < m.end()):
                insort(taken, (m.start(), m.end(), kind))
    return taken


def delimiters(text: str) -> tuple[str, str]:
    """A pair of characters that the text has neither of."""
    pairs = (tuple(p) for p in DELIMITERS)
    spare = ((chr(0xE000 + 2 * i), chr(0xE001 + 2 * i)) for i in count())
    return next(p for found in (pairs, spare) for p in found if not set(p) & set(text))


def target_surface(surface: str, kind: str) -> str:
    """What a translation should show: folded digits; of references and money the numbers, joined by a slash."""
    plain = surface if surface.isascii() else surface.translate(_FOLD)
    if kind in ("digits", "date"):
        return plain
    groups = re.findall(r"[0-9]+" if kind.endswith("para_ref") or kind == "para_of_article_ref" else r"[0-9]+(?:[.,][0-9]+)*", plain)
    return "/".join(groups) or plain


def encode(text: str) -> tuple[str, str, str, list[tuple[int, int, str]]]:
    """The text with a sentinel in place of each token, the delimiters, and the tokens."""
    opener, closer = delimiters(text)
    tokens, out, at = claimed(text), [], 0
    for i, (start, end, _) in enumerate(tokens):
        out += [text[at:start], f"{opener}N{i:03d}{closer}"]
        at = end
    return "".join([*out, text[at:]]), opener, closer, tokens


def decode(encoded: str, opener: str, closer: str, surfaces: list[str]) -> tuple[str, list[int]]:
    """The text with `surfaces` in place of their sentinels, and the tokens whose sentinel is missing; unknown sentinels stay."""
    seen: set[int] = set()

    def put(m: re.Match) -> str:
        n = int(m[1])
        if n >= len(surfaces):
            return m[0]
        seen.add(n)
        return surfaces[n]

    out = re.sub(rf"{re.escape(opener)}N([0-9]{{3,}}){re.escape(closer)}", put, encoded)
    return out, [i for i in range(len(surfaces)) if i not in seen]


_TOKEN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("surface", pa.string()), ("target", pa.string())])
_ENCODED = pa.struct([("encoded", pa.string()), ("opener", pa.string()), ("closer", pa.string()), ("tokens", pa.list_(_TOKEN))])
ENCODED = "struct<encoded: string, opener: string, closer: string, tokens: array<struct<start: int, end: int, kind: string, surface: string, target: string>>>"


def numeric_tokens(text: Column) -> Column:
    """Struct of the encoded text, its delimiters and its tokens; null text has none."""

    @F.arrow_udf(ENCODED)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # Few texts at a time: their tokens as Python objects take many times the texts' bytes.
            for at in range(0, len(batch), SLICE):
                texts, rows, tokens, ends = batch[at : at + SLICE].to_pylist(), [], [], [0]
                for whole in texts:
                    encoded, opener, closer, own = (None, None, None, []) if whole is None else encode(whole)
                    rows.append((encoded, opener, closer))
                    tokens += [(s, e, k, whole[s:e], target_surface(whole[s:e], k)) for s, e, k in own]
                    ends.append(len(tokens))
                columns = zip(*tokens, strict=True) if tokens else [[]] * len(_TOKEN)
                flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TOKEN, strict=True)], fields=list(_TOKEN))
                plain = [pa.array(c, pa.string()) for c in zip(*rows, strict=True)]
                yield pa.StructArray.from_arrays([*plain, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], fields=list(_ENCODED), mask=pa.array([t is None for t in texts]))

    return found(text)


def numbers_restored(encoded: Column, opener: Column, closer: Column, surfaces: Column) -> Column:
    """Struct of the text with the surfaces put back and the tokens whose sentinels are missing."""
    kind = pa.struct([("text", pa.string()), ("missing", pa.list_(pa.int32()))])

    @F.arrow_udf("struct<text: string, missing: array<int>>")
    def put(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            for at in range(0, len(columns[0]), SLICE):
                rows = []
                for code, a, b, own in zip(*(c[at : at + SLICE].to_pylist() for c in columns), strict=True):
                    rows.append(None if code is None else decode(code, a, b, own))
                yield pa.array(rows, kind)

    return put(encoded, opener, closer, surfaces)


def _lower(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def occurrences(text: str, terms: list[str]) -> list[tuple[int, int, str]]:
    """Start, end and term of the places where a document says its own terms, in any case: whole words,
    the leftmost first and of those the longest, without overlaps."""
    machine = ahocorasick.Automaton()
    for term in {_lower(t): t for t in sorted(terms, reverse=True) if t}.items():
        machine.add_word(term[0], term)
    if not len(machine):
        return []
    machine.make_automaton()
    low, at, out = _lower(text), 0, []
    wordlike = lambda i: 0 <= i < len(low) and (low[i].isalnum() or low[i] == "_")
    found = ((end - len(key) + 1, end + 1, term) for end, (key, term) in machine.iter(low))
    whole = [f for f in found if not (wordlike(f[0] - 1) and wordlike(f[0])) and not (wordlike(f[1]) and wordlike(f[1] - 1))]
    for start, end, term in sorted(whole, key=lambda f: (f[0], -f[1])):
        if start >= at:
            out.append((start, end, term))
            at = end
    return out


def term_occurrences(docs: DataFrame, key: str, text: str, terms: str) -> DataFrame:
    """key, start, end and term for each place where a row's text says one of the row's own terms (array `terms`).

    Null text, null or empty terms give no rows; rows are told apart by nothing but their key.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string())]))

    @F.arrow_udf("array<struct<start: int, end: int, term: string>>")
    def found(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            rows = ((t.as_py() or "", [x for x in (own.as_py() or []) if x]) for t, own in zip(texts, lists, strict=True))
            yield pa.array([[{"start": s, "end": e, "term": x} for s, e, x in occurrences(t, own)] for t, own in rows], kind)

    return docs.select(key, F.explode(found(F.col(text), F.col(terms))).alias("o")).select(key, "o.start", "o.end", "o.term")
