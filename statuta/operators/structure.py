"""From text to structure: lines, quoted spans, markers with rejections, unit paths, unit bodies, number repair.

A document is read line by line. Documents are told apart by `doc_id` and `version` (a hash of the
text): rows equal in both and in their text are one document, one id with several texts is several documents. Null
texts have no lines. Windows go over the lines or marks of one document, which is one row already.

Where whole texts are at hand, `walked` keeps a document's row and tells the same as `lines`,
`markers`, `assign_paths` and `units` without a shuffle of lines; `coverage_of` is its `coverage`.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEYS = ["doc_id", "version"]
#: Directional quotes with what closes each, and quotes that open and close by turns.
PAIRS = (("«", "»"), ("„", "“”"))
TURNS = ('"',)
REASONS = ("partial_decimal_number", "inside_quoted_text", "read_as_prose_reference", "read_as_citation_run")


@dataclass(frozen=True)
class Marker:
    """A kind of unit: its keywords, its rank (lower is outer), the abbreviation in paths, whether it's an item of an outline."""

    kind: str
    words: tuple[str, ...]
    rank: float
    short: str
    outline: bool = False


def documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, version and text of each document."""
    return docs.where(F.col(text).isNotNull()).select("doc_id", F.xxhash64(text).alias("version"), F.col(text).alias("text")).distinct()


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, version, line (from 0), paragraph and body of each line; a blank line ends a paragraph."""
    each = documents(docs, text).select(*KEYS, F.posexplode(F.split("text", "\n", -1)).alias("line", "body"))
    blank = F.sum((F.trim(F.regexp_replace("body", r"\s", "")) == "").cast("int"))
    return each.withColumn("paragraph", blank.over(Window.partitionBy(*KEYS).orderBy("line")))


def quoted(rows: DataFrame, pairs: tuple = PAIRS, turns: tuple = TURNS) -> DataFrame:
    """The lines with `quoted`: whether the line begins inside a quoted span of its paragraph.

    A directional opener matches the next closer of its own kind that no later opener takes; one that
    nothing closes masks nothing, nor does a closer without an opener or the last of an odd number of turns.
    The depth is a running sum, kept from falling below 0 by its running minimum; what stays open to
    the end is the minimum of the depth from there on.
    """
    signs = "".join(o + c for o, c in pairs) + "".join(turns)
    found = F.regexp_extract_all("body", F.lit(f"([{signs}])"), F.lit(1))
    marks = rows.select(*KEYS, "paragraph", "line", F.posexplode(F.concat(F.array(F.lit("")), found)).alias("at", "sign"))
    span = Window.partitionBy(*KEYS, "paragraph").orderBy("line", "at")
    so_far, onward = span.rowsBetween(Window.unboundedPreceding, 0), span.rowsBetween(0, Window.unboundedFollowing)
    inside = F.lit(False)
    for i, (opener, closers) in enumerate(pairs):
        step = F.when(F.col("sign") == opener, 1).when(F.col("sign").isin(*closers), -1).otherwise(0)
        marks = marks.withColumn(f"sum{i}", F.sum(step).over(so_far))
        marks = marks.withColumn(f"depth{i}", F.col(f"sum{i}") - F.least(F.lit(0), F.min(f"sum{i}").over(so_far)))
        marks = marks.withColumn(f"open{i}", F.min(f"depth{i}").over(onward))
        inside = inside | (F.col(f"depth{i}") > F.col(f"open{i}"))
    for i, sign in enumerate(turns):
        is_sign = (F.col("sign") == sign).cast("int")
        marks = marks.withColumn(f"turn{i}", F.sum(is_sign).over(so_far)).withColumn(f"turns{i}", F.sum(is_sign).over(Window.partitionBy(*KEYS, "paragraph")))
        inside = inside | ((F.col(f"turn{i}") % 2 == 1) & (F.col(f"turn{i}") < F.col(f"turns{i}")))
    starts = marks.where("at = 0").select(*KEYS, "line", inside.alias("quoted"))
    return rows.join(starts, [*KEYS, "line"])


def _fields(body: Column, config: list[Marker]) -> list[Column]:
    """Keyword (empty: the line begins with none), number (empty: none) and rest of a line, of the first keyword of `config` that fits."""
    number = r"([0-9]+(?:[ \t]?bis|[a-z])?|[IVXLCDM]+)"
    words = "|".join(w for m in config for w in m.words)
    shape = rf"(?s)^[ \t]*({words})(?:[ \t]+{number})?(?![0-9A-Za-z])(.*)$"
    return [F.regexp_extract(body, shape, group) for group in (1, 2, 3)]


def _kind(keyword: Column, config: list[Marker]) -> Column:
    kind = F.lit(None).cast("string")
    for m in reversed(config):
        kind = F.when(keyword.rlike(f"^(?:{'|'.join(m.words)})$"), m.kind).otherwise(kind)
    return kind


def _reason(number: Column, after: Column, quoted: Column) -> Column:
    run = after.rlike(r"^[ \t]*(?:,|-|[ \t](?:and|to))[ \t]*[0-9]")
    return (
        F.when((number != "") & after.rlike(r"^\.[0-9]"), "partial_decimal_number").when(quoted, "inside_quoted_text")
        .when(~run & after.rlike(r"^(?:[ \t]+\p{Ll}|[ \t]*[,;)])"), "read_as_prose_reference").when(run, "read_as_citation_run")
    )


def _heading(rest: Column) -> Column:
    return F.nullif(F.regexp_replace(rest, "^[ .\\-—:\t\r]+|[ .\\-—:\t\r]+$", ""), F.lit(""))


def markers(rows: DataFrame, config: list[Marker]) -> DataFrame:
    """The lines that a keyword begins: kind, keyword, number, heading, and `reason` where the marker is rejected (null: accepted).

    Reasons, the first that holds: partial_decimal_number (the number goes on after a point),
    inside_quoted_text, read_as_prose_reference (lower-case text follows), read_as_citation_run (more numbers follow).
    Where keywords of several kinds fit, the first of `config` counts. A marker without a number has none.
    """
    keyword, number, rest = _fields(F.col("body"), config)
    found = rows.withColumns({"keyword": keyword, "own": number, "rest": rest}).where("keyword <> ''")
    reason = _reason(F.col("own"), F.col("rest"), F.col("quoted"))
    return found.select(*KEYS, "line", _kind(F.col("keyword"), config).alias("kind"), "keyword", F.nullif("own", F.lit("")).alias("number"), _heading(F.col("rest")).alias("heading"), reason.alias("reason"))


def quoted_lines(text: str, pairs: tuple = PAIRS, turns: tuple = TURNS) -> list[bool]:
    """Whether each line begins inside a quoted span of its paragraph; none listed where no line does.

    The spans of `quoted`, by stacks: a closer takes the last opener that is open. Spans are counted
    where they begin and end, so that nested ones cost nothing more.
    """
    rows = text.split("\n")
    steps = [0] * (len(rows) + 1)
    kinds = {o: (i, True) for i, (o, _) in enumerate(pairs)} | {c: (i, False) for i, (_, closers) in enumerate(pairs) for c in closers}
    sign = re.compile("[" + re.escape("".join([*kinds, *turns])) + "]")
    stacks: list[list[int]] = [[] for _ in pairs]
    open_turn: dict[str, int] = {}
    for at, body in enumerate(rows):
        if not body.strip(" \t\x0b\f\r"):
            stacks, open_turn = [[] for _ in pairs], {}
            continue
        for c in sign.findall(body):
            begun = None
            if c in turns:
                begun = open_turn.pop(c, None)
                if begun is None:
                    open_turn[c] = at
            elif kinds[c][1]:
                stacks[kinds[c][0]].append(at)
            elif stacks[kinds[c][0]]:
                begun = stacks[kinds[c][0]].pop()
            if begun is not None and begun < at:
                steps[begun + 1] += 1
                steps[at + 1] -= 1
    if not any(steps):
        return []
    return [n > 0 for n in itertools.accumulate(steps[:-1])]


def canonical(number: Column) -> Column:
    """A number as it stands in a path: lower case, letters and digits only, without leading zeros; 0 where there is none."""
    plain = F.regexp_replace(F.lower(F.coalesce(number, F.lit(""))), "[^0-9a-z]+", "")
    return F.when(plain == "", "0").otherwise(F.regexp_replace(plain, "^0+(?=.)", ""))


PATHS = "line int, kind string, number string, depth int, parent string, path string, occurrence int, event string"


def assign_paths(anchors: DataFrame, config: list[Marker]) -> DataFrame:
    """Depth, parent and path of each anchor (doc_id, version, line, kind, number), by a fold over each document's anchors in order.

    A stack holds the open units; an anchor closes those whose rank is not below its own, and the
    rest of the stack is where it stands. A second sibling of one number gets a suffix and the event
    duplicate_number; in an outline it is a list that starts again: it gets no path, with what is
    below it, and the event restarted_list. Anchors of unknown kinds are inmost. Only one document's
    state is held.
    """
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string()]
    names = [*KEYS, *(c.split()[0] for c in PATHS.split(", "))]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = object(), None
        for batch in batches:
            out = []
            for doc, version, line, kind, number, own in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "line", "kind", "number", "own")), strict=True):
                if (doc, version) != now:
                    now, place = (doc, version), _placer(config)
                out.append((line, kind, number, *place(kind, own)))
            columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    rows = anchors.select(*KEYS, F.col("line").cast("int"), "kind", "number", canonical(F.col("number")).alias("own"))
    ordered = rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "line")
    id_type = dict(anchors.dtypes)["doc_id"]
    return ordered.mapInArrow(fold, f"doc_id {id_type}, version long, {PATHS}")


def _placer(config: list[Marker]) -> Callable[[str, str], tuple]:
    """A function of a document's next anchor (kind, number in paths): depth, parent, path, occurrence and event."""
    about = {m.kind: (m.rank, m.short, m.outline) for m in config}
    stack: list[tuple[float, str]] = []
    seen: dict[tuple[str | None, str], int] = {}
    gone: float | None = None

    def place(kind: str, own: str) -> tuple:
        nonlocal gone
        rank, short, outline = about.get(kind) or (float("inf"), kind, False)
        if gone is not None and outline and rank > gone:
            return None, None, None, None, "restarted_list"
        gone = None
        # Ranks on the stack ascend.
        while stack and stack[-1][0] >= rank:
            stack.pop()
        parent = stack[-1][1] if stack else None
        name = f"{short}_{own}"
        nth = seen.get((parent, name), 0) + 1
        if nth > 1 and outline:
            gone = rank
            return None, parent, None, nth, "restarted_list"
        seen[parent, name] = nth
        path = "__".join(filter(None, (parent, name if nth == 1 else f"{name}_{nth}")))
        out = len(stack), parent, path, nth, "duplicate_number" if nth > 1 else None
        stack.append((rank, path))
        return out

    return place


def marks(text: str, config: list[Marker]) -> list[tuple]:
    """Line, kind, keyword, number, heading and reason of the lines of a text that `markers` tells."""
    about = {}
    for m in config:
        for w in m.words:
            about.setdefault(w, m.kind)
    shape = _shape("|".join(w for m in config for w in m.words))
    found = list(shape.finditer(text))
    inside = quoted_lines(text) if found and _ANY_SIGN.search(text) else []
    out, line, at = [], 0, 0
    for m in found:
        line, at = line + text.count("\n", at, m.start()), m.start()
        keyword, number, rest = m.groups()
        run, lead = _RUN.match(rest), rest.lstrip(" \t")[:1]
        if number and _DECIMAL.match(rest):
            reason = "partial_decimal_number"
        elif inside and inside[line]:
            reason = "inside_quoted_text"
        elif run:
            reason = "read_as_citation_run"
        elif lead and (lead in ",;)" or rest[0] in " \t" and unicodedata.category(lead) == "Ll"):
            reason = "read_as_prose_reference"
        else:
            reason = None
        out.append((line, about[keyword], keyword, number, rest.strip(" .-—:\t\r") or None, reason))
    return out


_RUN, _DECIMAL = re.compile(r"[ \t]*(?:,|-|[ \t](?:and|to))[ \t]*[0-9]"), re.compile(r"\.[0-9]")
_ANY_SIGN = re.compile("[" + "".join(o + c for o, c in PAIRS) + "".join(TURNS) + "]")


@lru_cache
def _shape(words: str) -> re.Pattern:
    return re.compile(rf"(?m)^[ \t]*({words})(?:[ \t]+([0-9]+(?:[ \t]?bis|[a-z])?|[IVXLCDM]+))?(?![0-9A-Za-z])([^\n]*)")


def _own(number: str | None) -> str:
    """`canonical` of a number."""
    plain = re.sub("[^0-9a-z]+", "", (number or "").lower())
    return re.sub("^0+(?=.)", "", plain) if plain else "0"


def bodies(text: str, starts: list[tuple[int, str]]) -> list[tuple]:
    """Unit, path, line and body of a text cut at its starts (line, path)."""
    rows = text.split("\n")
    own = starts if starts and not starts[0][0] else [(0, None), *starts]
    ends = [*(a for a, _ in own[1:]), len(rows)]
    first = int(own is starts)
    return [(i, path, a, "\n".join(rows[a:b])) for i, ((a, path), b) in enumerate(zip(own, ends, strict=True), first)]


_MARK = [("line", pa.int32()), ("kind", pa.string()), ("keyword", pa.string()), ("number", pa.string()), ("heading", pa.string()), ("reason", pa.string())]
_ANCHOR = [("line", pa.int32()), ("kind", pa.string()), ("number", pa.string()), ("depth", pa.int32()), ("parent", pa.string()), ("path", pa.string()), ("occurrence", pa.int32()), ("event", pa.string())]
_UNIT = [("unit", pa.int64()), ("path", pa.string()), ("line", pa.int32()), ("body", pa.string())]
_NAMES = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string"}


def walked(docs: DataFrame, config: list[Marker], tell: str) -> DataFrame:
    """doc_id, version and an array of structs in order for each of `documents`: as `tell` says, marks (what `markers` tells),
    anchors (what `assign_paths` tells of the accepted ones) or units (what `units` tells).

    As there, a document of a null id has no marks. A row goes through Python once.
    """
    kinds = {"marks": _MARK, "anchors": _ANCHOR, "units": _UNIT}[tell]

    def rows(text: str, known: bool) -> list[tuple]:
        found = marks(text, config) if known else []
        if tell == "marks":
            return found
        place, anchors = _placer(config), [(m[0], m[1], m[3]) for m in found if m[5] is None]
        placed = [(line, kind, number, *place(kind, _own(number))) for line, kind, number in anchors]
        return placed if tell == "anchors" else bodies(text, [(a[0], a[5]) for a in placed if a[5] is not None])

    @F.arrow_udf(f"array<struct<{', '.join(f'{n}: {_NAMES[k]}' for n, k in kinds)}>>")
    def told(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, known in batches:
            out, ends = [], [0]
            for text, is_known in zip(texts.to_pylist(), known.to_pylist(), strict=True):
                out += rows(text, is_known)
                ends.append(len(out))
            columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            flat = pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    # Else a condition on what it tells would be asked of the texts too, and read them twice.
    told = told.asNondeterministic()
    return docs.select(*KEYS, told(F.col("text"), F.col("doc_id").isNotNull()).alias(tell))


def units(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """The document's text cut at its units: unit (0: what is before the first), path, first line, body.

    Nothing is lost: a document's bodies in order, joined by line ends, are its text.
    """
    begun = F.sum(F.col("path").isNotNull().cast("int")).over(Window.partitionBy(*KEYS).orderBy("line"))
    placed = rows.select(*KEYS, "line", "body").join(paths.where("path is not null").select(*KEYS, "line", "path"), [*KEYS, "line"], "left").withColumn("unit", begun)
    held = placed.groupBy(*KEYS, "unit").agg(F.max("path").alias("path"), F.min("line").alias("line"), F.array_sort(F.collect_list(F.struct("line", "body"))).alias("b"))
    return held.select(*KEYS, "unit", "path", "line", F.array_join(F.transform("b", lambda x: x["body"]), "\n").alias("body"))


def coverage(cut: DataFrame, floor: float = 0.5) -> DataFrame:
    """For each document: units, share of characters in units, whether the bodies give the text back, and the gate's verdict.

    The gates, the first that holds: no_anchors, not_lossless, below_floor (the share is below `floor`); else passed.
    """
    size = F.char_length("body")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit", "body"))), lambda x: x["body"]), "\n")
    held = cut.groupBy(*KEYS).agg(F.count("path").alias("n_units"), F.sum(F.when(F.col("path").isNotNull(), size).otherwise(0)).alias("inside"), F.sum(size).alias("all"), (F.xxhash64(whole) == F.first("version")).alias("lossless"))
    return _gated(held, floor)


def coverage_of(docs: DataFrame, floor: float = 0.5) -> DataFrame:
    """`coverage` of `walked` documents with units, each from its own row."""
    added = lambda which: F.aggregate(which, F.lit(0).cast("long"), lambda n, u: n + F.char_length(u["body"]))
    within = F.filter("units", lambda u: u["path"].isNotNull())
    whole = F.array_join(F.transform("units", lambda u: u["body"]), "\n")
    held = docs.select(*KEYS, F.size(within).cast("long").alias("n_units"), added(within).alias("inside"), added(F.col("units")).alias("all"), (F.xxhash64(whole) == F.col("version")).alias("lossless"))
    return _gated(held, floor)


def _gated(held: DataFrame, floor: float) -> DataFrame:
    share = F.when(F.col("all") > 0, F.round(F.col("inside") / F.col("all"), 6)).otherwise(0.0)
    gate = F.when(F.col("n_units") == 0, "no_anchors").when(~F.col("lossless"), "not_lossless").when(share < floor, "below_floor").otherwise("passed")
    return held.select(*KEYS, "n_units", share.alias("share"), "lossless", gate.alias("gate"))


#: Arrays of numbers in Python at a time.
SLICE = 64
#: Digits that are misread for each other, as pairs; scores of a number by its distance from the one before.
CONFUSED = ("16", "05", "89", "23", "34")
AFTER = {1: 10, 2: 6, 3: 3, 4: 3, 5: 3}
STEP, MARGIN, NO_FIT = 20, 6, -100
_DIGITS = {ord(c): str(i) for digits in ("٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹") for i, c in enumerate(digits)}
_MISREAD = {d: sorted({x for p in CONFUSED if d in p for x in p} - {d}) for d in "0123456789"}


def _as_written(number: str, like: str) -> str:
    """Digits in the script that `like` is written in."""
    for digits in ("٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹"):
        if set(like) & set(digits):
            return number.translate({ord(str(i)): c for i, c in enumerate(digits)})
    return number


def _fit(n: int, before: int | None, after: int | None) -> int:
    """How well a number stands between its neighbours."""
    if (before is not None and n <= before) or (after is not None and n >= after):
        return NO_FIT
    near = 0 if after is None else 5 + 5 * (n + 1 == after)
    return near + (0 if before is None else AFTER.get(n - before, 0))


def _odd(n: int, before: int | None) -> bool:
    return before is not None and not before < n <= before + STEP


def _shifted(plain: list[tuple[int, str]]) -> dict[int, tuple[str, str]]:
    """Runs in which one digit is misread throughout: place to new number and reason.

    A run starts at an odd number after a sound one, where exactly one confusable digit keeps it from
    going on; it lasts while numbers ascend with that digit in that place, and it is repaired if it has
    two members at least, ascends when mended, and ends below the next number.
    """
    out, before, sound, at = {}, None, True, 0
    while at < len(plain):
        value = int(plain[at][1])
        if not _odd(value, before):
            before, sound, at = value, True, at + 1
            continue
        found, want = plain[at][1], str(before + 1)
        apart = [i for i, (x, y) in enumerate(zip(found, want, strict=False)) if x != y] if len(found) == len(want) else []
        end = at + 1
        if sound and len(apart) == 1 and want[apart[0]] in _MISREAD[found[apart[0]]]:
            place = apart[0]
            while end < len(plain) and int(plain[end][1]) > int(plain[end - 1][1]) and len(plain[end][1]) == len(found) and plain[end][1][place] == found[place]:
                end += 1
            mended = [int(n[:place] + want[place] + n[place + 1 :]) for _, n in plain[at:end]]
            after = int(plain[end][1]) if end < len(plain) else None
            rising = all(x < y for x, y in itertools.pairwise([before, *mended, *([] if after is None else [after])]))
            if len(mended) > 1 and rising:
                for (i, _), n in zip(plain[at:end], mended, strict=True):
                    out[i] = str(n), f"run shift {found[place]}->{want[place]} at digit {place}"
                before, at = mended[-1], end
                continue
        before, sound, at = value, False, at + 1
    return out


def repaired_numbers(numbers: list[str | None]) -> list[tuple[str | None, str | None]]:
    """Each number, mended where one misread digit explains a break in the ascending sequence, and the reason (null: kept)."""
    folded = [None if n is None else n.translate(_DIGITS).strip() for n in numbers]
    places = [i for i, n in enumerate(folded) if n and n.isascii() and n.isdigit()]
    runs = _shifted([(i, folded[i]) for i in places])
    out: list[tuple[str | None, str | None]] = [(n, None) for n in numbers]
    values = {i: int(runs[i][0] if i in runs else folded[i]) for i in places}
    for i, (n, why) in runs.items():
        out[i] = _as_written(n, numbers[i]), why
    before, sound = None, True
    for at, i in enumerate(places):
        n = values[i]
        if _odd(n, before):
            prior, after = before if sound else None, values[places[at + 1]] if at + 1 < len(places) else None
            text = str(n) if i in runs else folded[i]
            others = [text[:p] + d + text[p + 1 :] for p, c in enumerate(text) for d in _MISREAD[c]]
            best = max(others, key=lambda x: _fit(int(x), prior, after), default=None)  # noqa: B023
            gain = -1 if best is None else _fit(int(best), prior, after) - _fit(n, prior, after)
            sound = prior is not None and gain >= MARGIN and (prior < int(best) <= prior + 5 or int(best) + 1 == after)
            if sound:
                out[i] = _as_written(best, numbers[i]), f"monotonic prior {prior}, next {after}"
                n = int(best)
        else:
            sound = True
        before = n
    return out


def repair_numbers(numbers: Column) -> Column:
    """Array of (number, reason) for an array of numbers in document order."""

    @F.arrow_udf("array<struct<number: string, reason: string>>")
    def mended(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("number", pa.string()), ("reason", pa.string())]))
        for batch in batches:
            # Few arrays at a time: their numbers as Python objects take many times the arrays' bytes.
            for at in range(0, len(batch), SLICE):
                yield pa.array([None if x is None else repaired_numbers(x) for x in batch[at : at + SLICE].to_pylist()], kind)

    return mended(numbers)
