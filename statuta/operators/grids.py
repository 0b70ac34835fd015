"""Tables with spans resolved to rows that can be read alone: an occupancy grid, header labels, group bands, lineage.

Input is a row for each cell: tab, row, cell (places in the tree), text, colspan, rowspan, is_header.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Dashes of an outline, headers of a column of depths, codes that may nest, and how many of these a column needs.
_DASHES = "‐‑‒–—―−-"
_INDENT = re.compile(rf"^\s*((?:[{_DASHES}]\s*)+)")
_DEPTHS = re.compile(r"h\*?|l\*?|level|depth|tier", re.I)
_CODE = re.compile(r"[0-9][0-9.\s]*")
LEAST_CODES = 4
#: Cells in Python at a time, and texts of which it is remembered what they say.
SLICE = 5_000
TEXTS = 1 << 14
ROWS = "row int, labels array<string>, cells array<string>, lineage array<string>, mechanisms array<string>"


def _cells(rows: list[list[dict]]) -> list[list[tuple]]:
    return [[(c["text"], c["colspan"], c["rowspan"], c["is_header"]) for c in row] for row in rows]


def occupancy(rows: list[list[dict]]) -> list[list[str]]:
    """The rows as a rectangle: each cell fills what its spans cover. What is covered from above comes first; gaps are ''."""
    return _occupied(_cells(rows))


def _occupied(rows: list[list[tuple]]) -> list[list[str]]:
    placed: list[dict[int, str]] = [{} for _ in rows]
    for y, row in enumerate(rows):
        here, x = placed[y], 0
        for text, wide, deep, _ in row:
            while x in here:
                x += 1
            wide = wide if wide and wide > 1 else 1
            here[x] = text
            if wide > 1 or deep and deep > 1:
                for line in placed[y : y + max(1, deep or 1)]:
                    for dx in range(wide):
                        line.setdefault(x + dx, text)
            x += wide
    return [[line.get(x, "") for x in range(max(line) + 1)] if line else [] for line in placed]


@lru_cache(TEXTS)
def depth(text: str) -> int:
    m = _INDENT.match(text)
    return sum(c in _DASHES for c in m[1]) if m else 0


@lru_cache(TEXTS)
def leaf(text: str) -> str:
    return _INDENT.sub("", text).strip().rstrip(":").strip()


@lru_cache(TEXTS)
def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


@lru_cache(TEXTS)
def _code(text: str) -> str:
    """The digits of a text that is a code; '' of others."""
    return _digits(text) if _CODE.fullmatch(text.strip()) else ""


@lru_cache(TEXTS)
def _letters(text: str) -> int:
    return sum(map(str.isalpha, text))


def _column(grid: list[list[str]], width: int, skip: set) -> tuple[int | None, int | None]:
    """The column of nesting codes and the column of prose, by what they hold."""
    codes = None
    for x in range(width):
        values = [v for r in grid if x < len(r) and (v := _code(r[x]))]
        if len(values) >= LEAST_CODES and any(b != a and b.startswith(a) for a, b in zip(values, values[1:], strict=False)):
            codes = x
            break
    weight = {x: sum(_letters(r[x]) for r in grid if x < len(r)) for x in range(width) if x != codes and x not in skip}
    prose = max(weight, key=lambda x: (weight[x], -x), default=None)
    return codes, prose if prose is not None and weight[prose] else None


def resolved(rows: list[list[dict]]) -> list[dict]:
    """The rows of a table but its header and bands: labels, cells, lineage (outermost first) and how it was found."""
    return [dict(zip(("row", "labels", "cells", "lineage", "mechanisms"), r, strict=True)) for r in _resolved(_cells(rows))]


def _resolved(rows: list[list[tuple]]) -> list[tuple]:
    grid = _occupied(rows)
    width = max(map(len, grid), default=0)
    band = [width > 1 and len(r) == 1 and (r[0][1] or 1) >= width for r in rows]
    header = next((y for y in range(min(3, len(rows))) if not band[y] and rows[y] and all(c[3] for c in rows[y]) and any(grid[y])), None)
    labels = grid[header] if header is not None else []
    depths = next((x for x, label in enumerate(labels) if _DEPTHS.fullmatch(label.strip())), None)
    codes, prose = _column([g for y, g in enumerate(grid) if y != header], width, {depths} - {None})
    ladder = depths is not None or prose is not None and any(prose < len(g) and depth(g[prose]) for y, g in enumerate(grid) if y != header)
    group: list[str] = []
    by_code: dict[str, str] = {}
    open_at: dict[int, str] = {}
    out = []
    for y, cells in enumerate(grid):
        if y == header:
            continue
        if band[y]:
            label = next((leaf(c) for c in cells if c.strip()), "")
            group, by_code, open_at = [label] if label else [], {}, {}
            continue
        lineage, by_prefix = list(group), False
        said = cells[prose] if prose is not None and prose < len(cells) else next((c for x, c in enumerate(cells) if x not in (codes, depths) and c.strip()), "")
        code = _digits(cells[codes]) if codes is not None and codes < len(cells) else ""
        if code:
            above = [by_code[code[:n]] for n in range(1, len(code)) if code[:n] in by_code]
            lineage += above
            by_prefix = bool(above)
            by_code[code] = leaf(said)
        if depths is not None and depths < len(cells):
            plain = cells[depths].strip()
            level = int(plain) if plain.isascii() and plain.isdigit() else 0
        else:
            level = depth(said)
        if level and (codes is None or ladder):
            lineage, by_prefix = [*group, *(open_at[d] for d in sorted(open_at) if d < level)], False
        if said:
            open_at = {d: t for d, t in open_at.items() if d < level} | {level: leaf(said)}
        how = [name for name, found in (("group", group), ("header", labels), ("indent", level), ("prefix", by_prefix)) if found]
        out.append((y, [*labels[: len(cells)], *[""] * (len(cells) - len(labels))], cells, [x for x in lineage if x], how))
    return out


def table_rows(cells: DataFrame) -> DataFrame:
    """tab, row, labels, cells, lineage and mechanisms of the rows of every table.

    A cell's null text is '', null or non-positive spans are 1. Rows and cells are taken in order of
    row and cell; of repeated cells (equal row and cell) each is one. Null tables are left out.
    """
    kinds = [pa.int32(), *[pa.list_(pa.string())] * 4]
    own = [F.coalesce("row", F.lit(0)).cast("int").alias("row"), F.coalesce("cell", F.lit(0)).cast("int").alias("cell"), F.coalesce("text", F.lit("")).alias("text"), F.col("colspan").cast("int").alias("colspan"), F.col("rowspan").cast("int").alias("rowspan"), F.coalesce("is_header", F.lit(False)).alias("is_header")]
    names = ["row", "cell", "text", "colspan", "rowspan", "is_header"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places, rows, done = None, [], [], []

        def told() -> pa.RecordBatch:
            columns = [*zip(*(r for _, out in done for r in out), strict=True)] or [[]] * len(kinds)
            tabs = pa.array([tab for tab, out in done for _ in out], tab_type)
            done.clear()
            return pa.RecordBatch.from_arrays([tabs, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["tab", *[c.split()[0] for c in ROWS.split(", ")]])

        def ended() -> None:
            if rows:
                done.append((now, [(places[y], *r) for y, *r in _resolved(rows)]))

        for batch in batches:
            tab_type = batch.schema.field("tab").type
            # Cells come in order, so that one table is open at a time; few are in Python at once.
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for tab, y, text, wide, deep, head in zip(*(part.column(n).to_pylist() for n in ("tab", "row", "text", "colspan", "rowspan", "is_header")), strict=True):
                    if tab != now:
                        ended()
                        now, places, rows = tab, [], []
                    if not places or y != places[-1]:
                        places.append(y)
                        rows.append([])
                    rows[-1].append((text, wide, deep, head))
                if done:
                    yield told()
        ended()
        if done:
            yield told()

    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cells.where("tab is not null").select("tab", *own).repartition(parts, "tab").sortWithinPartitions("tab", *names)
    return ordered.mapInArrow(read, f"tab {dict(cells.dtypes)['tab']}, {ROWS}")
