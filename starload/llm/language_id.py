"""Language by cross-parsing entropy.

Of each language a bounded sample of labelled text becomes a suffix automaton, which knows
every substring of the sample. A text is parsed into phrases from left to right, each the
longest match that the sample has from there on. The fewer phrases, the better the sample
predicts the text: with n symbols in the sample and m in the text, c phrases estimate
c * log2(n) / m bits for a symbol, and the language that needs least wins.

Texts are compared as lower-case letters with one blank for whatever stands between words.
The automaton is stored as a table of moves that already restarts at the root where a match
ends, so parsing is one look-up a symbol, done for many pieces of text at once. Pieces are
`PIECE` symbols long; a phrase ends with its piece, alike for all languages.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from starload.llm.common import arrow_batches, extended, hash_share
from starload.session import stored

PIECE = 2048
UNKNOWN = "und"
_SYMBOLS_AT_ONCE = 4 << 20
_BLANK, _OTHER, _FIRST_LETTER = 0, 1, 2


class Sample(NamedTuple):
    """Labelled text of one language, pieces joined by newlines."""

    lang: str
    text: str


# -- learning


def learn(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    sample_texts: int = 80,
    sample_chars: int = 400,
    max_languages: int = 1000,
) -> list[Sample]:
    """For each language the text to learn from: `sample_chars` code points of each of at
    most `sample_texts` different texts.

    Which texts and which part of them follows from hashes of the text, so copies of a text
    count once. Rows without language or without a letter in the text are left out; if none
    is left, there is nothing learned. What comes to the driver is bounded by the
    parameters; more languages than `max_languages` are an error.
    """
    digest = F.xxhash64("text")
    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).withColumn("digest", digest)
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("digest", 0.02).alias("texts"))
    counts = stored(counts, "languages")
    if counts.count() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    # Hashes are spread evenly: this bar lets through half as many again as are wanted.
    share = hash_share("text")
    start = F.pmod("digest", F.greatest(F.lit(1), F.length("text") - sample_chars + 1)) + 1
    some = (
        labelled.join(F.broadcast(counts), "lang")
        .filter(share * F.col("texts") < 1.5 * sample_texts + 20)
        .select("lang", "digest", F.substring("text", start.cast("int"), F.lit(sample_chars)).alias("piece"))
        .groupBy("lang", "digest")
        .agg(F.min("piece").alias("piece"))
    )
    order = Window.partitionBy("lang").orderBy("digest")
    chosen = some.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample_texts)
    texts: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "place").collect():
        texts.setdefault(row["lang"], []).append(row["piece"])
    return [Sample(lang, "\n".join(pieces)) for lang, pieces in sorted(texts.items())]


# -- symbols


@functools.cache
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols(text: str, codes: np.ndarray) -> np.ndarray:
    """A text as symbols of a model's alphabet; runs of anything but letters are one blank."""
    found = codes[_code_points(text)]
    keep = found != _BLANK
    keep[1:] |= found[:-1] != _BLANK
    keep[:1] = found[:1] != _BLANK
    return found[keep]


# -- the model


def suffix_automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Moves of every state, the root first; every walk from it spells a substring."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in sequence:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            found = moves[state][symbol]
            if length[found] == length[state] + 1:
                link[new] = found
            else:
                split = len(moves)
                moves.append(dict(moves[found]))
                length.append(length[state] + 1)
                link.append(link[found])
                link[found] = link[new] = split
                while state >= 0 and moves[state].get(symbol) == found:
                    moves[state][symbol] = split
                    state = link[state]
        last = new
    return moves


class Model:
    """For each language a table of moves: the next state's row, doubled, plus one where a
    phrase begins with the symbol. A letter that is not in the sample is a phrase by itself."""

    def __init__(self, samples: tuple[Sample, ...], max_alphabet: int = 256):
        letters = _letters()
        points, many = np.unique(
            np.concatenate([_code_points(s.text) for s in samples]), return_counts=True
        )
        own = letters[points]
        points, many = points[own], many[own]
        points = np.sort(points[np.argsort(-many, kind="stable")][: max_alphabet - _FIRST_LETTER - 1])
        self.codes = np.where(letters, _OTHER, _BLANK).astype(np.uint8)
        self.codes[points] = np.arange(len(points)) + _FIRST_LETTER
        self.langs = [s.lang for s in samples]
        gap = len(points) + _FIRST_LETTER  # stands between pieces and in no text
        self.size = gap + 1
        self.tables, self.bits = [], []
        for sample in samples:
            sequence: list[int] = []
            for piece in sample.text.split("\n"):
                sequence += [*symbols(piece, self.codes).tolist(), gap]
            self.tables.append(self._table(suffix_automaton(sequence)))
            self.bits.append(np.log2(max(2, len(sequence))))

    def _table(self, moves: list[dict[int, int]]) -> np.ndarray:
        restart = np.full(self.size, 1, np.int32)
        for symbol, state in moves[0].items():
            restart[symbol] = state * self.size * 2 + 1
        table = np.tile(restart, len(moves))  # a phrase begins at the root, whatever follows
        for state, own in enumerate(moves[1:], 1):
            for symbol, following in own.items():
                table[state * self.size + symbol] = following * self.size * 2
        return table

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """How many phrases each text takes (rows) in each language (columns)."""
        sizes = np.array([len(t) for t in texts])
        pieces = -(-sizes // PIECE)
        text = np.repeat(np.arange(len(texts)), pieces)
        within = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(np.cumsum(sizes) - sizes, pieces) + within * PIECE
        length = np.minimum(sizes[text] - within * PIECE, PIECE)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        active = len(order) - np.searchsorted(length[::-1], np.arange(length[0]) + 1)
        flat = np.concatenate(texts)
        counts = np.empty((len(texts), len(self.tables)))
        states = [np.zeros(len(order), np.int32) for _ in self.tables]
        begun = [np.zeros(len(order), np.int32) for _ in self.tables]
        for step, lanes in enumerate(active):
            symbol = flat[start[:lanes] + step].astype(np.int32)
            for table, state, count in zip(self.tables, states, begun, strict=True):
                move = table[state[:lanes] + symbol]
                count[:lanes] += move & 1
                np.right_shift(move, 1, out=state[:lanes])
        for column, count in enumerate(begun):
            counts[:, column] = np.bincount(text[order], count, len(texts))
        return counts

    def judge(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        result: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        held: list[np.ndarray] = []
        numbers: list[int] = []
        total = 0

        def settle() -> None:
            if not held:
                return
            sizes = np.array([len(h) for h in held])
            need = self.phrases(held) * np.array(self.bits) / sizes[:, None]
            best = need.argmin(axis=1)
            for row, number in enumerate(numbers):
                others = np.delete(need[row], best[row])
                least = need[row, best[row]]
                score = 1.0 if not len(others) else 1 - least / others.min()
                result[number] = (self.langs[best[row]], float(score))
            held.clear()
            numbers.clear()

        for number, text in enumerate(texts):
            sequence = symbols(text, self.codes)
            if (sequence != _BLANK).any():
                held.append(sequence)
                numbers.append(number)
                total += len(sequence)
                if total >= _SYMBOLS_AT_ONCE:
                    settle()
                    total = 0
        settle()
        return result


@functools.lru_cache(maxsize=1)
def _model(samples: tuple[Sample, ...], max_alphabet: int) -> Model:
    """One model a worker process, whatever number of tasks it runs."""
    return Model(samples, max_alphabet)


# -- predicting


def predict(
    docs: DataFrame,
    samples: list[Sample],
    text_col: str = "text",
    max_alphabet: int = 256,
    into: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """`docs` with `lang_pred` and `score`, in place of columns of those names.

    `lang_pred` is a learned language, `und` for a text that is null or has no letter, and
    for all texts if nothing was learned. The score, 0 to 1, is the share by which the
    runner-up needs more (1 if there is none, 0 for `und`); in a tie the language first in
    the alphabet wins. Every row is judged by its whole text alone, so repeated rows agree;
    other columns pass through. `into` names the two columns otherwise.
    """
    kept = [c for c in docs.columns if c not in into]
    place = kept.index(text_col)
    learned = docs.sparkSession.sparkContext.broadcast(tuple(samples))

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [t.as_py() or "" for t in batch.column(place)]
        if learned.value:
            found = _model(learned.value, max_alphabet).judge(texts)
        else:
            found = [(UNKNOWN, 0.0)] * len(texts)
        columns = [pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *columns], names=[*kept, *into]
        )

    source = docs.select(*kept)
    types = dict(zip(into, (T.StringType(), T.DoubleType()), strict=True))
    schema = extended(source, **types)
    return source.mapInArrow(arrow_batches(judge), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the documents, by their number, that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
