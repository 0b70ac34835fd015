"""Scalar functions on unit paths, URIs, numbers and citations, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First code points of the decimal digits that are folded to ASCII.
ZEROS = (0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50)


def digits_folded(text: Column) -> Column:
    """Digits of other scripts as ASCII digits."""
    return F.translate(text, "".join(chr(z + i) for z in ZEROS for i in range(10)), "0123456789" * len(ZEROS))


def spaces_collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[ \\t\\r\\n]+", " "))


def zeros_stripped(number: Column) -> Column:
    """A number without leading zeros; one of zeros only is 0."""
    return F.regexp_replace(number, "^0+(?=.)", "")


def parent_path(path: Column) -> Column:
    """The path without its last segment; null for a path of one."""
    return F.when(F.instr(path, "__") > 0, F.regexp_extract(path, "^(.*)__", 1))


def ancestors(path: Column) -> Column:
    """Paths from the root's down to the path itself."""
    parts = F.split(path, "__")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "__"))


def last_segment(path: Column) -> Column:
    return F.substring_index(path, "__", -1)


def in_subtree(path: Column, root: str) -> Column:
    """Whether a path is `root` or below it."""
    return (path == root) | path.startswith(root + "__")


def citation(text: Column) -> Column:
    """Struct of number and year of a citation: two digit runs, of which exactly one lies in 1200 to 2200; else null."""
    runs = F.regexp_extract_all(digits_folded(text), F.lit("[0-9]+"), F.lit(0))
    year = lambda i: (F.length(F.get(runs, i)) == 4) & F.get(runs, i).between("1200", "2200")
    first, second = year(F.lit(0)), year(F.lit(1))
    pair = lambda n, y: F.struct(zeros_stripped(F.get(runs, F.lit(n))).alias("number"), F.get(runs, F.lit(y)).cast("int").alias("year"))
    return F.when((F.size(runs) == 2) & first & ~second, pair(1, 0)).when((F.size(runs) == 2) & second & ~first, pair(0, 1))


#: Kinds of containers from the outermost, and the path prefixes of those written shorter.
KINDS = ("book", "part", "title", "chapter", "section", "article", "paragraph", "subparagraph", "point", "item")
PREFIXES = {"tit": "title", "ttl": "title", "chp": "chapter", "sec": "section", "art": "article", "para": "paragraph", "subpara": "subparagraph", "pt": "point"}


def order_key(path: Column) -> Column:
    """A string that sorts as the document does: by kind, prefix and number of each segment, outer units before what is in them.

    Numbers are compared piece by piece (pieces end at . or _): as numbers where both are runs of ASCII
    digits (leading zeros don't count), else as text, numbers before text; unknown prefixes come last.
    Separators sort below all that stands between them. An empty path has an empty key, null has null.
    """
    ranks = {k: i for i, k in enumerate(KINDS)} | {p: KINDS.index(k) for p, k in PREFIXES.items()}
    known = F.create_map(*[F.lit(x) for k, i in ranks.items() for x in (k, f"{i:03d}")])

    def piece(text: Column) -> Column:
        plain = zeros_stripped(text)
        return F.when(text == "", "").when(text.rlike("^[0-9]+$"), F.concat(F.lit("0"), F.lpad(F.length(plain).cast("string"), 6, "0"), plain)).otherwise(F.concat(F.lit("1"), text))

    def segment(text: Column) -> Column:
        shaped = text.rlike("(?i)^[a-z]+(_.*)?$")
        prefix = F.lower(F.when(shaped, F.regexp_extract(text, "(?i)^([a-z]+)", 1)).otherwise(text))
        number = F.when(shaped, F.regexp_extract(text, "(?i)^[a-z]+_(.*)$", 1)).otherwise("")
        pieces = F.transform(F.split(F.regexp_replace(number, "[._]+$", ""), "[._]"), piece)
        return F.concat(F.coalesce(F.get(F.array(known[prefix]), F.lit(0)), F.lit("999")), prefix, F.lit("\x02"), F.array_join(pieces, "\x02"))

    return F.when(path == "", "").otherwise(F.array_join(F.transform(F.split(path, "__"), segment), "\x01"))
