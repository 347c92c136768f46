"""Language spans: script ranges, per-word scores, Viterbi with a switching penalty.

A model is a table of letter-trigram log probabilities per language, of fixed
size, and the share of each script per language. A word's script leaves the
languages that use it; trigrams score the word in each; the best sequence of
languages over the words, with a penalty per switch, labels the spans.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import spread_input

BUCKETS = 1 << 16
#: Languages a model may have; its size is bounded by this and BUCKETS.
MAX_LANGUAGES = 64
PENALTY = 12.0
MIN_SCRIPT_SHARE = 0.01
SMOOTHING = 0.5
#: Characters handled at once in a task; one longer text is handled alone.
CHARS_AT_ONCE = 2_000_000
NEVER = np.float32(-1e6)

# First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_SCRIPTS = len(SCRIPTS) + 2  # 0: no letter, 1: other letters


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """The script number of every code point, 0 for all that are no letters."""
    letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    table = np.ones(0x110000, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 2):
        for low, high in ranges:
            table[low : high + 1] = number
    return np.where(letters, table, 0).astype(np.uint8)


@dataclass
class Words:
    """The words of some texts: maximal runs of letters, lower-cased."""

    grams: np.ndarray  # trigram bucket of each letter
    first: np.ndarray  # first letter of each word in grams
    length: np.ndarray
    script: np.ndarray
    text: np.ndarray  # number of the text of each word


def words_in(texts: list[str | None]) -> Words:
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    scripts = script_table()[points]
    letter = scripts > 0
    padded = np.where(letter, points, 32).astype(np.uint32)
    at = np.flatnonzero(letter)
    grams = padded[at - 1] * np.uint32(2654435761) ^ padded[at] * np.uint32(2246822519) ^ padded[at + 1] * np.uint32(3266489917)
    grams = (grams * np.uint32(668265263)) >> np.uint32(16)
    opens = ~letter[at - 1]
    first = np.flatnonzero(opens)
    length = np.diff(np.append(first, len(at)))
    ends = np.cumsum([len(t) + 1 for t in lowered]) if texts else np.zeros(0, int)
    text = np.searchsorted(ends, at[first] - 1, side="right")
    return Words(grams.astype(np.int64), first, length, scripts[at[first]], text)


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # languages x buckets
    allowed: np.ndarray  # languages x scripts

    def scores(self, words: Words) -> np.ndarray:
        """Words x languages: log probability, NEVER outside the script's languages, 0 if it has none."""
        if not len(words.first):
            return np.zeros((0, len(self.languages)), np.float32)
        out = np.stack([np.add.reduceat(row[words.grams], words.first) for row in self.logs], axis=1)
        fits = self.allowed[:, words.script].T
        out = np.where(fits, out, NEVER)
        out[~fits.any(1)] = 0
        return out


def _batched(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``CHARS_AT_ONCE``."""
    for batch in batches:
        sizes = np.fromiter((len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(text)), np.int64, batch.num_rows)
        low = held = 0
        for k, size in enumerate(sizes.tolist()):
            if k > low and held + size > CHARS_AT_ONCE:
                yield batch.slice(low, k - low)
                low, held = k, 0
            held += size
        if batch.num_rows > low:
            yield batch.slice(low)


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from all labelled rows: each task counts, the counts are summed by Spark.

    What reaches the driver is at most languages x (BUCKETS + scripts) counts.
    Rows without a label are left out.
    """
    languages = sorted(r[0] for r in rows.where(F.col(lang).isNotNull()).select(lang).distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    number = {name: k for k, name in enumerate(languages)}
    cells = BUCKETS + N_SCRIPTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), cells), np.int64)
        for batch in _batched(batches, 0):
            words = words_in(batch.column(0).to_pylist())
            which = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)[words.text]
            letters = np.repeat(which, words.length)
            counts[:, :BUCKETS] += np.bincount(letters * BUCKETS + words.grams, minlength=len(languages) * BUCKETS).reshape(-1, BUCKETS)
            np.add.at(counts[:, BUCKETS:], (which, words.script), words.length)
        found = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(found[0].astype(np.int32)), "cell": pa.array(found[1].astype(np.int32)), "n": pa.array(counts[found]),
        })

    labelled = spread_input(rows.where(F.col(lang).isNotNull()).select(text, lang))
    sums = labelled.mapInArrow(count, "lang int, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), cells), np.float64)
    table = sums.toPandas()
    counts[table["lang"], table["cell"]] = table["n"]
    grams, scripts = counts[:, :BUCKETS] + SMOOTHING, counts[:, BUCKETS:]
    logs = np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32)
    share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
    return Model(languages, logs, share >= MIN_SCRIPT_SHARE)


def best_languages(scores: np.ndarray, text: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The language number of each word on the best path of its text.

    Where no stretch of words gains more than the penalty by leaving the
    text's best language, staying there is the best path; the other texts
    are solved word by word, all of them side by side.
    """
    n, width = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    lengths = np.diff(np.append(starts, n))
    totals = np.add.reduceat(scores.astype(np.float64), starts)
    best = totals.argmax(1)
    label = np.repeat(best, lengths)
    if width == 1:
        return label
    others = scores.astype(np.float64)
    own = others[np.arange(n), label]
    others[np.arange(n), label] = -np.inf
    gain = np.clip(others.max(1) - own, -1e3, 1e3)
    run = np.cumsum(gain) - np.repeat(np.arange(len(starts)) * 1.0, lengths) * (4e3 * lengths.max())
    before = run - gain
    stretch = np.maximum.reduceat(run - np.minimum.accumulate(before), starts)
    hard = np.flatnonzero(stretch > penalty)
    if len(hard):
        _viterbi(scores, starts[hard], lengths[hard], penalty, label)
    return label


def _viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float, label: np.ndarray) -> None:
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than t
    row = np.append(0, np.cumsum(active))  # step t's rows
    switched = np.zeros((row[-1], scores.shape[1]), bool)
    origin = np.zeros(row[-1], np.int16)
    value = scores[starts].astype(np.float64)
    for t in range(1, longest):
        m = active[t]
        now = value[:m]
        top = now.argmax(1)
        leave = now[np.arange(m), top] - penalty
        go = now < leave[:, None]
        switched[row[t] : row[t + 1]], origin[row[t] : row[t + 1]] = go, top
        value[:m] = np.where(go, leave[:, None], now) + scores[starts[:m] + t]
    at = value.argmax(1)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        label[starts[:m] + t] = at[:m]
        if t:
            here = slice(row[t], row[t + 1])
            at[:m] = np.where(switched[here][np.arange(m), at[:m]], origin[here], at[:m])


SPAN_SCHEMA = "array<struct<start: int, words: int, lang: string>>"


def identify(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", penalty: float = PENALTY, spans: bool = False
) -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row, with ``spans`` also the runs of words of one language.

    ``lang_pred`` is the language with the most letters on the best path,
    ``score`` its share of all letters. Texts that are null or without a letter
    are ``und`` with score 0. Ties go to the first language by name. Only the
    text is read for a prediction. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        width = len(model.languages)
        for batch in _batched(batches, 1):
            words = words_in(batch.column(1).to_pylist())
            rows = batch.num_rows
            label = best_languages(model.scores(words), words.text, penalty) if width else np.zeros(0, np.int64)
            if width:
                share = np.bincount(words.text * width + label, weights=words.length, minlength=rows * width).reshape(rows, width)
            else:
                share = np.zeros((rows, 1))
            top, total = share.argmax(1), share.sum(1)
            names = [model.languages[k] if n else "und" for k, n in zip(top, total)]
            score = share[np.arange(rows), top] / np.maximum(total, 1)
            found = [None] * rows
            if spans:
                found = [[] for _ in range(rows)]
                if len(label):
                    edge = np.append(True, (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1]))
                    opens = np.flatnonzero(edge)
                    first = np.searchsorted(words.text, words.text[opens])
                    for o, n, f in zip(opens, np.diff(np.append(opens, len(label))), first):
                        found[words.text[o]].append({"start": o - f, "words": n, "lang": model.languages[label[o]]})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(names), pa.array(score), pa.array(found, schema.field(3).type)], schema=schema
            )

    rows = spread_input(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text))
    out = rows.mapInArrow(run, f"doc_id long, lang_pred string, score double, spans {SPAN_SCHEMA}")
    return out if spans else out.drop("spans")
