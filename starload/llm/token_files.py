"""Documents as token numbers in flat binary files.

A data set is a folder with three files for each part, and a table of the parts:

* `<file>.bin`  the token numbers of its documents one after the other, as little-endian
                unsigned integers of 16 or 32 bits, the smallest that hold the vocabulary;
* `<file>.idx`  n + 1 little-endian 64-bit offsets into that file, in tokens;
* `<file>.ids`  n little-endian 64-bit document identifiers, those that are null first, as 0;
* `parts`       Parquet: part, file, width in bytes, documents, tokens, how many documents
                are nameless, and the prefix sum `base`: the tokens in all parts before.

A document's place in the whole is its offset plus the base of its part. Parts are ranges of
identifiers in ascending order. Readers map the files into memory.

Files get a name of their own for each attempt at a task, and the table of parts names those
of the attempts that counted: an attempt that dies leaves files nobody reads.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starload.llm.common import Batches, parallelism, text_of

_HELD_WORDS = 500_000  # words whose tokens a worker remembers, twice over
_LONG_WORD = 64  # code points from which on a word is forgotten at once
_MARKS = ".,;:!?"
_NOT_LATIN_1 = 0xC4  # the first byte of the first code point beyond Latin-1 in UTF-8
_NOT_LATIN = "\u0250"  # the first code point after the Latin letters that need no context
_BYTES_AT_ONCE = 4 << 20
_DOCUMENTS_AT_ONCE = 4096

_PART = "part INT, file STRING, width INT, documents BIGINT, tokens BIGINT, nameless BIGINT"


# Names that Spark and Arrow have for one kind of storage.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "file": "file", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss"}


def arrow_uri(uri: str) -> str:
    """A full URI of Spark's, as Arrow writes it. Storage that Arrow cannot open is refused."""
    scheme, rest = uri.split(":", 1)
    if scheme not in _ARROW_SCHEMES:
        raise ValueError(f"token files cannot be written to {scheme}: use one of {', '.join(_ARROW_SCHEMES)}")
    rest = rest if rest.startswith("//") else f"//{rest}"
    return f"{_ARROW_SCHEMES[scheme]}:{rest}"


def shared_folder(spark: SparkSession, path: str) -> str:
    """The folder of that path, made if there is none, as a URI that all machines open alike.

    It is found where Spark finds it: without a scheme on the session's default file system, and
    behind the mounts of a view, which Arrow does not know.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place)
    return arrow_uri(system.resolvePath(place).toString())


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder by its URI, and the path in it; a plain path is local."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


# -- encoding


class Encoder:
    """Encodes texts, with the end token after each.

    `words_apart` says that the tokenizer drops white space and never joins what stands on
    both sides of it. Then a text's tokens are those of its words in a row, and words are
    encoded once and remembered: those met lately for sure, others until there are too many.
    A tokenizer that visibly does otherwise is refused.

    `plain_words` says besides that it lower-cases, keeps a mark apart from the letter or
    digit before it, and ends every run of letters with a token that ends in `WORD_END`:
    "Word," is then remembered as "word" and ",", and many words are encoded as one text,
    whose tokens tell where each of them ends.
    """

    WORD_END = "</w>"

    def __init__(self, file: str, end: int, words_apart: bool, plain_words: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.type = np.dtype("<u2" if max(size, end + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end], self.type).tobytes()
        self.words_apart = words_apart
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # what was remembered before the last clearing
        self.plain_words = plain_words
        if words_apart:
            texts = ["The", "don't", "x1", "(a)", "..."]
            whole = self._encode_whole([f" {a}\n{b}\t {a}\r" for a in texts for b in texts])
            parts = [self._encode_whole([a, b, a]) for a in texts for b in texts]
            if whole != [b"".join(p) for p in parts]:
                raise ValueError(f"{file} does not encode words apart")
        if plain_words:
            texts = ["The", "X1", "It's", "\u00c9T\u00c9"]
            whole = self._encode_whole([a + m for a in texts for m in _MARKS])
            parts = [self._encode_whole([a.lower(), m]) for a in texts for m in _MARKS]
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(size, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(self.WORD_END)]] = True
            if not words_apart or whole != [b"".join(p) for p in parts] or not self.ends.any():
                raise ValueError(f"{file} does not encode words without case and marks")

    def _encode_whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.type).tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The bytes that stand for each text in a file."""
        if not self.words_apart:
            return [ids + self.end for ids in self._encode_whole(texts)]
        found: list[bytes] = []
        unknown: list[tuple[int, list[str], list]] = []
        new: set[str] = set()
        for place, text in enumerate(texts):
            words = words_of(text)
            parts = list(map(self.known.get, words))
            if all(parts):
                found.append(b"".join([*parts, self.end]))
            else:
                found.append(b"")
                unknown.append((place, words, parts))
                new.update([w for w, p in zip(words, parts, strict=True) if p is None])
        long = self._learn(new)
        for place, words, parts in unknown:
            full = [self.known[w] if p is None else p for w, p in zip(words, parts, strict=True)]
            found[place] = b"".join([*full, self.end])
        self._forget(long)
        return found

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts in a row, and how many each has, end tokens included.

        Plain words are cut, counted as distinct words and put back as tokens for all texts
        at once; only distinct words are looked up one by one. Texts with other than Latin-1
        characters, or what may be a special token, are encoded by themselves.
        """
        if not self.plain_words:
            return self._in_a_row([np.frombuffer(t, self.type) for t in self.encode(texts.to_pylist())])
        texts = texts.cast(pa.string())
        _, bounds, content = texts.buffers()
        offsets = np.frombuffer(bounds, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(content or b"", np.uint8)[offsets[0] : offsets[-1]].copy()
        offsets = offsets - offsets[0]
        odd = np.zeros(len(texts), bool)
        for places in (
            np.flatnonzero(data >= _NOT_LATIN_1),
            np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|"))),
        ):
            odd[np.searchsorted(offsets, places, "right") - 1] = True
        others = np.flatnonzero(odd)
        for text in others:
            data[offsets[text] : offsets[text + 1]] = ord(" ")
        starts, words = cut_words(data, offsets)
        distinct = words.dictionary_encode()
        which = distinct.indices.to_numpy()
        listed = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = list(map(self.known.get, listed))
        new = [w for w, part in zip(listed, parts, strict=True) if part is None]
        if new:
            long = self._learn_cut(set(new))
            parts = [self.known[w] if p is None else p for w, p in zip(listed, parts, strict=True)]
            self._forget(long)
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // self.type.itemsize
        flat = np.frombuffer(b"".join(parts), self.type)
        many = size[which]
        own = np.bincount(np.searchsorted(offsets, starts, "right") - 1, many, len(texts)).astype(np.int64)
        before = (np.cumsum(size) - size)[which] - (np.cumsum(many) - many)
        tokens = flat[np.repeat(before, many) + np.arange(many.sum())]
        tokens = np.insert(tokens, np.cumsum(own), np.frombuffer(self.end, self.type))
        if not len(others):
            return tokens, own + 1
        rows = np.split(tokens, np.cumsum(own + 1)[:-1])
        for text, found in zip(others, self.encode(texts.take(others).to_pylist()), strict=True):
            rows[text] = np.frombuffer(found, self.type)
        return self._in_a_row(rows)

    def _in_a_row(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(rows), np.array([len(row) for row in rows], np.int64)

    def _forget(self, long: list[str]) -> None:
        for word in long:
            self.known.pop(word, None)
        if len(self.known) > _HELD_WORDS:
            self.before, self.known = self.known, {}

    def _learn(self, new: set[str]) -> list[str]:
        """Put all these words into `known`; what of it is too long to be kept there."""
        if self.before:
            again = new.intersection(self.before)
            self.known.update(zip(again, map(self.before.__getitem__, again), strict=True))
            new = new - again
        if not self.plain_words:
            return self._learn_whole(list(new))
        parts = {word: plain(word) for word in new}
        bare = {part for both in parts.values() for part in both}.difference(self.known)
        long = self._learn_whole(list(bare))
        for word, (stem, mark) in parts.items():
            self.known[word] = self.known[stem] + self.known[mark]
        return long + [word for word in parts if len(word) > _LONG_WORD]

    def _learn_cut(self, new: set[str]) -> list[str]:
        """The same for words that were cut from Latin-1 texts and lower-cased before."""
        if self.before:
            again = new.intersection(self.before)
            self.known.update(zip(again, map(self.before.__getitem__, again), strict=True))
            new -= again
        return self._learn_whole(list(new))

    def _learn_whole(self, words: list[str]) -> list[str]:
        """Encode unknown words, runs of Latin letters as one text."""
        if self.plain_words:
            runs = [w for w in words if w.isalpha() and max(w) < _NOT_LATIN and "\u0130" not in w]
            self.known.update(zip(runs, self._encode_runs(runs), strict=True))
            words = [w for w in words if w not in self.known]
            long = [w for w in runs if len(w) > _LONG_WORD]
        else:
            long = []
        self.known.update(zip(words, self._encode_whole(words), strict=True))
        return long + [w for w in words if len(w) > _LONG_WORD]

    def _encode_runs(self, words: list[str]) -> list[bytes]:
        """The tokens of words that are one run of letters each."""
        if not words:
            return []
        ids = np.array(
            self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids,
            self.type,
        )
        cuts = (np.flatnonzero(self.ends[ids]) + 1) * self.type.itemsize
        if len(cuts) != len(words):
            raise ValueError("a run of letters does not end with one token")
        data = ids.tobytes()
        cuts = cuts.tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


def plain(word: str) -> tuple[str, str]:
    """A word in lower case and the mark at its end, or the word as it is and nothing.

    Only words of Latin letters are taken apart: there neither normalisation nor lower case
    depends on what stands next to a character. A capital I with dot becomes two characters,
    and a special token's name may change by case; both are left alone.
    """
    if (not word.isascii() and (max(word) >= _NOT_LATIN or "\u0130" in word)) or "<|" in word:
        return word, ""
    word = word.lower()
    if word[-1] in _MARKS and len(word) > 1 and word[-2].isalnum():
        return word[:-1], word[-1]
    return word, ""


@functools.lru_cache(maxsize=1)
def _encoder(file: str, end: int, words_apart: bool, plain_words: bool) -> Encoder:
    """One encoder a worker process: what a task remembers helps the next."""
    return Encoder(file, end, words_apart, plain_words)


def words_of(text: str) -> list[str]:
    """The text cut at blanks, tabs and line ends; other white space stays inside words.

    Nothing that normalisation does reaches over these characters.
    """
    if text.isascii() and not any(c in text for c in "\v\f\x1c\x1d\x1e\x1f"):
        return text.split()
    for other in "\n\t\r":
        text = text.replace(other, " ")
    return [word for word in text.split(" ") if word]


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The words in the UTF-8 bytes of Latin-1 texts, and where each begins.

    A-Z are lower-cased in `data`. Words end at blanks, tabs, line ends and the ends of texts,
    and before a mark at their end that follows a small letter or a digit.
    """
    data[(data >= ord("A")) & (data <= ord("Z"))] += 32
    gap = _GAPS[data]
    edge = np.zeros(len(data) + 1, bool)  # where texts begin, and the end of all
    edge[offsets] = True
    new = ~gap
    new[1:] &= gap[:-1] | edge[1:-1]
    ends = edge[1:].copy()
    ends[:-1] |= gap[1:]
    mark = np.flatnonzero(_MARK_BYTES[data] & ends & ~new)
    before = data[mark - 1]
    accented = (before >= 0xA0) & (before != 0xB7) & (data[mark - 2] == 0xC3)  # but the division sign
    new[mark[_PLAIN_BYTES[before] | accented]] = True
    kept = np.cumsum(~gap, dtype=np.int32)
    starts = np.flatnonzero(new)
    bounds = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[~gap]))
    return starts, words


def _byte_set(members: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in members]] = True
    return table


_GAPS = _byte_set(" \n\t\r")
_MARK_BYTES = _byte_set(_MARKS)
_PLAIN_BYTES = _byte_set("abcdefghijklmnopqrstuvwxyz0123456789")


def _pieces(batches: Batches) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of some megabytes at most, but for longer texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64))
        cuts = np.flatnonzero(np.diff(sizes // _BYTES_AT_ONCE, prepend=0)).tolist()
        for first, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if end > first:
                yield batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_token: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_apart: bool = False,
    plain_words: bool = False,
    parts: int | None = None,
) -> None:
    """Encode every whole text into the files of a new data set at `path`, by ascending id.

    `tokenizer_file` must exist under that name on all machines, `path` be shared by them: see
    `shared_folder` for where it is looked for.
    `words_apart` and `plain_words`, see Encoder, speed up tokenizers of such a kind.
    A null text is empty: its tokens are the end token alone. Documents with a null id come
    first; those that share an id are ordered by text. An empty table gives a data set
    without parts. Other columns are ignored. A part is written front to back in constant
    memory; `parts` (the session's shuffle partitions) sets how large parts get.
    """
    spark = docs.sparkSession
    folder = path.rstrip("/")
    target = shared_folder(spark, f"{folder}/files")

    def write(batches: Batches) -> Batches:
        system, inside = open_folder(target)
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        coder = None
        offsets, ids, total, nameless = [np.zeros(1, np.int64)], [], 0, 0
        out = None
        for own_ids, texts in _pieces(batches):
            if out is None:
                coder = _encoder(tokenizer_file, end_token, words_apart, plain_words)
                out = system.open_output_stream(f"{inside}/{name}.bin")
            tokens, counts = coder.encode_array(texts)
            ends = total + np.cumsum(counts)
            total = int(ends[-1])
            offsets.append(ends)
            nameless += own_ids.null_count
            ids.append(own_ids.fill_null(0).to_numpy())
            out.write(tokens.tobytes())
        if out is None:
            return
        out.close()
        for kind, arrays in (("idx", offsets), ("ids", ids)):
            with system.open_output_stream(f"{inside}/{name}.{kind}") as file:
                file.write(np.concatenate(arrays).astype("<i8").tobytes())
        documents = sum(map(len, ids))
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "part": part, "file": name, "width": coder.type.itemsize,
                    "documents": documents, "tokens": total, "nameless": nameless,
                }
            ],
            schema=pa.schema(
                [
                    ("part", pa.int32()), ("file", pa.string()), ("width", pa.int32()),
                    ("documents", pa.int64()), ("tokens", pa.int64()), ("nameless", pa.int64()),
                ]
            ),
        )

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
        .repartitionByRange(parts or parallelism(spark), "id")
        .sortWithinPartitions("id", "text")
    )
    ordered.mapInArrow(write, _PART).write.parquet(f"{folder}/written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per part: the prefix sums are over thousands of rows at most.
    written = spark.read.schema(_PART).parquet(f"{folder}/written")
    base = F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))
    written.withColumn("base", base).write.parquet(f"{folder}/parts")


# -- reading


class Part(NamedTuple):
    """A part's files, mapped: documents are tokens[offsets[i] : offsets[i + 1]]."""

    tokens: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray
    nameless: int
    base: int


def _mapped(system: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def open_part(folder: str, row: dict) -> Part:
    """Map the files of a row of `parts` of the data set in a folder: the URI that `shared_folder`
    gives for its path, or a local path."""
    system, inside = open_folder(f"{folder.rstrip('/')}/files")
    name = f"{inside}/{row['file']}"
    return Part(
        _mapped(system, f"{name}.bin", f"<u{row['width']}"),
        _mapped(system, f"{name}.idx", "<i8"),
        _mapped(system, f"{name}.ids", "<i8"),
        row["nameless"],
        row["base"],
    )


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{_PART}, base BIGINT"
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/parts")


def _over_documents(spark: SparkSession, path: str, schema: str, values) -> DataFrame:
    """A row per document: id, start, n_tokens and what `values` makes of its tokens."""
    folder = shared_folder(spark, path)

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                part = open_part(folder, row)
                for first in range(0, len(part.ids), _DOCUMENTS_AT_ONCE):
                    offsets = part.offsets[first : first + _DOCUMENTS_AT_ONCE + 1]
                    places = np.arange(first, first + len(offsets) - 1)
                    ids = pa.array(part.ids[places], mask=places < part.nameless)
                    extra = values(part.tokens, offsets)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(offsets[:-1] + part.base), pa.array(np.diff(offsets)), extra],
                        names=["doc_id", "start", "n_tokens", "value"],
                    )

    parts = read_parts(spark, path)
    spread = parts.repartitionById(max(1, parts.count()), F.col("part"))
    return spread.mapInArrow(read, f"doc_id BIGINT, start BIGINT, n_tokens BIGINT, value {schema}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, tokens (array) of every document in the files."""

    def tokens(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
        own = np.asarray(flat[offsets[0] : offsets[-1]]).astype(np.int64)
        return pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int32)), own)

    return _over_documents(spark, path, "ARRAY<BIGINT>", tokens).withColumnRenamed("value", "tokens")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: of the ids as little-endian 32-bit integers."""

    def checksums(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
        wide = np.asarray(flat[offsets[0] : offsets[-1]]).astype("<u4")
        cut = (offsets - offsets[0]).tolist()
        return pa.array(
            [zlib.crc32(wide[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.int64()
        )

    return _over_documents(spark, path, "BIGINT", checksums).withColumnRenamed("value", "ids_crc32")
