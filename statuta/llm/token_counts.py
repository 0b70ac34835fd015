"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

A state holds, for each start of a token that the characters read so far may still complete, the
vocabulary prefix it is in, the token before it and the tokens emitted up to there, relative to
now. A transition reads one character and is annotated with the change in the number of emitted
tokens. States and transitions are built as they are first met and then shared by all words.
No vocabulary piece has a space mark after another character, so every such place resets the
state: a chunk of text maps any state before it to (characters up to its first reset, tokens
between its resets, characters since its last), and these maps compose associatively.

Null text counts as empty (0 tokens); repeated rows are counted each; other columns pass through
unless a result column has the same name, which then replaces it. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
CHUNK = 1 << 12
MEMO = 150_000
STATES = 250_000
START = -1
_UNIT = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*|[^{MARK}\n]+")
_RESET = re.compile(f"[^{MARK}](?={MARK})|.(?=\n)", re.S)


class State(dict):
    """Transitions by character, each to (state, change in emitted tokens)."""

    __slots__ = ("entries", "machine")

    def __init__(self, machine: Transducer, entries: tuple):
        super().__init__()
        self.machine, self.entries = machine, entries

    def __missing__(self, char: str) -> tuple[State, int]:
        return self.machine.move(self, char)


class Transducer:
    """Deterministic transducer of a sentencepiece BPE model with byte fallback."""

    def __init__(self, pieces: dict[str, float]):
        self.scores = pieces
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.texts = list(pieces)
        self.children: list[dict[str, int]] = [{}]
        self.token = [START]
        for p, i in self.ids.items():
            node = 0
            for c in p:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.token.append(START)
                node = self.children[node][c]
            self.token[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.begin = State(self, ((0, START, 0),))
        self.states = {self.begin.entries: self.begin}

    def _merged(self, text: str) -> list[str]:
        """Merges by score, the leftmost of equal ones first; only for pairs of tokens."""
        parts = list(text)
        while True:
            best = max(((self.scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.scores), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _follows(self, before: int, token: int) -> bool:
        """Whether `token` stays whole and apart after the token `before`."""
        found = self.pairs.get((before, token))
        if found is None:
            want = [self.texts[token]] if before == START else [self.texts[before], self.texts[token]]
            found = self.pairs[before, token] = self._merged("".join(want)) == want
        return found

    def move(self, state: State, char: str) -> tuple[State, int]:
        last, gain, kept = START, None, []
        for node, before, count in state.entries:
            after = self.children[node].get(char)
            if after is None:
                continue
            kept.append((after, before, count))
            token = self.token[after]
            if gain is None and token != START and self._follows(before, token):
                last, gain = token, count + 1
        if gain is None:
            gain, kept = len(char.encode("utf-8", "surrogatepass")), []
        entries = tuple((n, b, c - gain) for n, b, c in kept if self.children[n]) + ((0, last, 0),)
        to = self.states.get(entries)
        if to is None:
            to = self.states[entries] = State(self, entries)
        state[char] = to, gain
        return to, gain

    def run(self, text: str) -> int:
        """Tokens of a text that starts and ends at a reset."""
        if len(self.states) > STATES:
            self._clear()
        state, total = self.begin, 0
        for char in text:
            state, gain = state[char]
            total += gain
        return total

    def count(self, text: str) -> int:
        """Tokens between resets, whole units being memoised."""
        try:
            return sum(map(self.memo.__getitem__, units := _UNIT.findall(text)))
        except KeyError:
            return sum(map(self._unit, units))

    def _unit(self, unit: str) -> int:
        n = self.memo.get(unit)
        if n is None:
            n = self.run(unit)
            if len(unit) <= 64:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[unit] = n
        return n

    def chunk_map(self, text: str) -> ChunkMap:
        first = _RESET.search(text)
        if first is None:
            return ChunkMap(text, None, "")
        end = max(text.rfind(MARK), text.rfind("\n"))
        while text[end - 1] == MARK and text[end] == MARK:
            end -= 1
        end = max(end, first.end())
        return ChunkMap(text[: first.end()], self.count(text[first.end() : end]), text[end:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """The map of the text of `a` followed by that of `b`; associative."""
        if a.count is None and b.count is None:
            return self.chunk_map(a.head + b.head)
        if a.count is None:
            joined = self.chunk_map(a.head + b.head)
            if joined.count is None:
                return ChunkMap(joined.head, b.count, b.tail)
            return ChunkMap(joined.head, joined.count + self.count(joined.tail) + b.count, b.tail)
        if b.count is None:
            joined = self.chunk_map(a.tail + b.head)
            if joined.count is None:
                return ChunkMap(a.head, a.count, joined.head)
            return ChunkMap(a.head, a.count + self.count(joined.head) + joined.count, joined.tail)
        return ChunkMap(a.head, a.count + self.count(a.tail + b.head) + b.count, b.tail)

    def total(self, m: ChunkMap) -> int:
        return self.count(m.head) if m.count is None else self.count(m.head) + m.count + self.count(m.tail)

    def tokens(self, text: str | None) -> int:
        """Tokens of a whole text: its chunks' maps, composed pairwise in a tree."""
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        maps = [self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.total(maps[0])


@dataclass(frozen=True)
class ChunkMap:
    """Text up to the first reset, tokens up to the last, text after it; count None: no reset."""

    head: str
    count: int | None
    tail: str


@functools.lru_cache(maxsize=2)
def transducer(model_path: str) -> Transducer:
    """Compiles the vocabulary of the model file at `model_path` (once in each Python worker)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return Transducer({sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))})


def token_count(text: Column, model_path: str) -> Column:
    """Column of the token count of `text`."""

    @F.pandas_udf(T.LongType())
    def counted(texts: pd.Series) -> pd.Series:
        machine = transducer(model_path)
        return pd.Series([machine.tokens(t) for t in texts], dtype="int64")

    return counted(text)


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """`docs` with n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumn("n_bytes", F.octet_length(whole).cast("long")).withColumn("n_tokens", token_count(whole, model_path))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
