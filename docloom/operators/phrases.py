"""Synonym phrases in token arrays: an automaton over words, walked in each row.

The terms of all groups form an Aho-Corasick automaton over word numbers: one
walk over a row's tokens finds every place where any term stands, however the
terms overlap. It goes to the tasks with the function that walks it, its size
measured before. Rows come in Arrow batches; words no term has are told apart
by one vectorized lookup, and only runs of other words are walked. What groups
add is made in the row, so there is no join and no shuffle, and no token
becomes a row of its own.
"""

from __future__ import annotations

import pickle
import sys
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILLER = "_"


class Automaton:
    """Matches of terms in sequences of words; all of them, longer and shorter ones alike."""

    def __init__(self, terms: Sequence[tuple[str, Sequence[str]]]) -> None:
        """``terms`` are ``(group, words)`` pairs."""
        self.terms = [tuple(words) for _, words in terms]
        members: dict[str, list[int]] = {}
        for number, (group, _) in enumerate(terms):
            members.setdefault(group, []).append(number)
        #: For each term the terms of its group, itself included.
        self.mates = [members[group] for group, _ in terms]
        self.words = {w: i for i, w in enumerate(sorted({w for t in self.terms for w in t}))}
        # States: next state by word, the state of the longest proper suffix, terms that end here.
        self.next: list[dict[int, int]] = [{}]
        self.back, self.ends = [0], [[]]
        for number, term in enumerate(self.terms):
            state = 0
            for word in term:
                code = self.words[word]
                if code not in self.next[state]:
                    self.next[state][code] = len(self.next)
                    self.next.append({}), self.back.append(0), self.ends.append([])
                state = self.next[state][code]
            self.ends[state].append(number)
        queue = deque(self.next[0].values())
        while queue:
            state = queue.popleft()
            for code, child in self.next[state].items():
                back = self.back[state]
                while back and code not in self.next[back]:
                    back = self.back[back]
                self.back[child] = self.next[back].get(code, 0) if self.next[back].get(code, 0) != child else 0
                self.ends[child] = [*self.ends[child], *self.ends[self.back[child]]]
                queue.append(child)

    def walk(self, codes: Sequence[int]) -> Iterator[tuple[int, int]]:
        """``(start, term)`` of every match in a run of word numbers."""
        state = 0
        for at, code in enumerate(codes):
            while state and code not in self.next[state]:
                state = self.back[state]
            state = self.next[state].get(code, 0)
            for term in self.ends[state]:
                yield at + 1 - len(self.terms[term]), term


def _matches(found: Automaton, tokens: pa.ListArray) -> Iterator[tuple[int, int, int, list[tuple[int, int]]]]:
    """``(row, low, high, matches)`` of each row with matches: its tokens are the values from ``low`` to ``high``."""
    values = tokens.values
    codes = pc.fill_null(pc.index_in(values, pa.array(sorted(found.words), values.type)), -1).to_numpy(zero_copy_only=False)
    offsets = tokens.offsets.to_numpy()
    known = np.flatnonzero(codes >= 0)
    known = known[(known >= offsets[0]) & (known < offsets[-1])]
    rows = np.searchsorted(offsets, known, side="right") - 1
    # A run ends where a word is missing or the row changes.
    breaks = np.flatnonzero((np.diff(known) > 1) | (np.diff(rows) > 0)) + 1
    current, matches = -1, []
    for run, owner in zip(np.split(known, breaks), np.split(rows, breaks)):
        if not len(run):
            continue
        row = int(owner[0])
        if row != current and matches:
            yield current, int(offsets[current]), int(offsets[current + 1]), matches
            matches = []
        current, first = row, int(run[0])
        matches += [(first + at - int(offsets[row]), term) for at, term in found.walk(codes[run].tolist())]
    if matches:
        yield current, int(offsets[current]), int(offsets[current + 1]), matches


def _added(found: Automaton, matches: list[tuple[int, int]], words: list[str | None]) -> list[tuple[int, str]]:
    """``(pos, token)`` that groups add, written word by word from where a match starts; each once, and none that stands there."""
    made: dict[tuple[int, str], None] = {}
    for at, term in matches:
        for mate in found.mates[term]:
            for i, word in enumerate(found.terms[mate]):
                if at + i >= len(words) or words[at + i] != word:
                    made[at + i, word] = None
    return list(made)


def _grams(added: list[tuple[int, str]], words: list[str | None]) -> list[tuple[int, str]]:
    """Added words, and their pairs with the text's and with each other."""
    at: dict[int, list[str]] = {}
    for pos, word in added:
        at.setdefault(pos, []).append(word)
    out = list(added)
    for pos, word in added:
        if 0 < pos <= len(words):
            out.append((pos - 1, f"{FILLER if words[pos - 1] is None else words[pos - 1]} {word}"))
        if pos + 1 < len(words):
            out.append((pos, f"{word} {FILLER if words[pos + 1] is None else words[pos + 1]}"))
        out += [(pos, f"{word} {after}") for after in at.get(pos + 1, ())]
    return out


def _paths(found: Automaton, matches: list[tuple[int, int]]) -> list[tuple[int, int, tuple[str, ...]]]:
    """``(pos, length, words)``: the readings that groups add beside ``length`` tokens of the text, each once."""
    made: dict[tuple[int, int, tuple[str, ...]], None] = {}
    for at, term in matches:
        for mate in found.mates[term]:
            if found.terms[mate] != found.terms[term]:
                made[at, len(found.terms[term]), found.terms[mate]] = None
    return list(made)


def _arcs(paths: list[tuple[int, int, tuple[str, ...]]], words: list[str | None]) -> list[tuple]:
    return [(pos, length, " ".join(path), i, len(path), word) for pos, length, path in paths for i, word in enumerate(path)]


def _path_grams(paths: list[tuple[int, int, tuple[str, ...]]], words: list[str | None]) -> list[tuple[int, str]]:
    """Added words, and pairs along the paths: inside a reading, and with what ends at its start or starts at its end."""
    starts: dict[int, list[str]] = {}
    for pos, _, path in paths:
        starts.setdefault(pos, []).append(path[0])

    def own(pos: int) -> str:
        return FILLER if words[pos] is None else words[pos]

    out = []
    for pos, length, path in paths:
        end = pos + length
        out += [(pos, word) for word in path] + [(pos, f"{a} {b}") for a, b in zip(path, path[1:])]
        if pos:
            out.append((pos - 1, f"{own(pos - 1)} {path[0]}"))
        if end < len(words):
            out.append((pos, f"{path[-1]} {own(end)}"))
        out += [(pos, f"{path[-1]} {after}") for after in starts.get(end, ())]
    return out


PAIR = "array<struct<pos: int, token: string>>"
ARC = "array<struct<pos: int, length: int, path: string, step: int, steps: int, token: string>>"


class Phrases:
    """Synonym groups, ready to be looked up in token arrays."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    @property
    def size(self) -> int:
        """Bytes that go to each task."""
        return len(pickle.dumps(vars(self.automaton)))

    def _function(self, kind: str, make):
        automaton = self.automaton
        fields = [part.split(": ") for part in kind[len("array<struct<") : -2].split(", ")]
        struct = pa.struct([(name, pa.int32() if form == "int" else pa.string()) for name, form in fields])

        def run(tokens: pa.Array) -> pa.Array:
            found: list = [None] * len(tokens)
            if automaton.terms:
                for row, low, high, matches in _matches(automaton, tokens):
                    found[row] = [dict(zip(struct.names, made)) for made in make(automaton, matches, tokens.values[low:high].to_pylist())]
            return pa.array(found, pa.list_(struct))

        run.__annotations__ = {"tokens": pa.Array, "return": pa.Array}
        return F.arrow_udf(run, kind)

    def added(self, tokens: Column | str) -> Column:
        """``(pos, token)`` entries that expansion adds to a token array; NULL for none."""
        return self._function(PAIR, _added)(tokens)

    def added_grams(self, tokens: Column | str) -> Column:
        """``(pos, token)``: added words and their pairs with neighbours."""
        return self._function(PAIR, lambda a, m, w: _grams(_added(a, m, w), w))(tokens)

    def arcs(self, tokens: Column | str) -> Column:
        """The arcs of added readings."""
        return self._function(ARC, lambda a, m, w: _arcs(_paths(a, m), w))(tokens)

    def path_grams(self, tokens: Column | str) -> Column:
        """``(pos, token)``: words of added readings and the pairs along their paths."""
        return self._function(PAIR, lambda a, m, w: _path_grams(_paths(a, m), w))(tokens)


def phrases_if_small(terms: DataFrame, max_bytes: int) -> Phrases | None:
    """The automaton of ``terms(group_id, parts)``, or None if it takes more than ``max_bytes``.

    The terms' own size is measured first, so that nothing larger is collected.
    """
    row = terms.agg(F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "parts")) + F.octet_length("group_id")), F.lit(0)).alias("b")).first()
    if row["b"] > max_bytes:
        return None
    found = Phrases(Automaton([(r["group_id"], r["parts"]) for r in terms.orderBy("group_id", "parts").collect()]))
    return found if found.size <= max_bytes else None
