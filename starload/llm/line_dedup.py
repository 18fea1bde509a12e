"""Lines that many documents share, kept countable and reversible.

A `LineStore` is a folder of versions. Each version has three tables:

* members: for every document, by the hash of its id and text, how often it is in the store;
* counts: for every line key, the exact number of documents that hold it, sharded by key;
* filters: for every shard, a cuckoo filter of the keys that reach `min_docs`, and the list
  of all other counted keys for which that filter answers yes by mistake.

`insert` and `remove` add a set of documents to the counts or take it away again; keys that
cross the threshold enter or leave their shard's filter. Documents that are not members cannot be
removed, so what was inserted is what can be taken back, no more. As the store grows, its shards
are doubled, so none ever has more keys than a task can hold. Since every counted key that a
filter mistakes is on the list, filter and list together answer exactly for all documents
in the store, and `apply` can judge a line where its document lies: no text is shuffled.
The two are broadcast only up to a size; beyond it the lines' keys travel to the shards.

Shards lie in buckets, a folder each. A change reads and writes the buckets that its keys fall
into; all others stay in the versions that wrote them, which the new version names.

A key is a line without ASCII white space at its ends and with A-Z lower-cased; it is
handled as the 128-bit hash of its UTF-8 bytes.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from starload.llm import cuckoo
from starload.llm.common import (
    arrow_batches,
    extended,
    fresh,
    parallelism,
    power_of_two,
    text_of,
)
from starload.session import delete, folder_ages, read_text, scratch_dir, write_text

_HELD_KEYS = 200_000  # keys that a counting task holds before it hands them on
_SHARD_KEYS = 300_000  # keys of a shard, which one task holds
_COUNTS = "shard INT, hi BIGINT, lo BIGINT, n BIGINT"
_KIND = "member BOOLEAN"  # of an entry: a document, or a line key
_FILTERS = "shard INT, slots BINARY, mistaken BINARY"
# Shards are dealt to so many folders at most, so that they can be written anew one by one.
_BUCKETS = 1024
# Once so many versions hold parts of a store, the next change writes all of it.
_MAX_VERSIONS = 16
_TABLES = {"members": _COUNTS, "counts": _COUNTS, "filters": _FILTERS}
_SETTINGS = "settings.json"
_COMPLETE = "complete"


def line_keys(text: str, min_chars: int) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text as UTF-8, and the 16-byte hash of each key, b"" for one too short."""
    lines = text.encode().split(b"\n")
    keys = [line.strip().lower() for line in lines]
    if min_chars > 1:
        return lines, [
            xxhash.xxh3_128_digest(k) if len(k.decode()) >= min_chars else b"" for k in keys
        ]
    return lines, [xxhash.xxh3_128_digest(k) if len(k) >= min_chars else b"" for k in keys]


def _lines_of(docs: DataFrame, text_col: str) -> int:
    """Lines of all texts: their distinct keys are no more."""
    text = text_of(text_col)
    ends = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return docs.agg(F.sum(ends + 1)).first()[0] or 0


def _words(keys: list[bytes] | Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _count_keys(shards: int, min_chars: int):
    """Documents (id, text) as entries to count: each document, and each of its distinct keys."""

    def flush(held: Counter, member: bool) -> pa.RecordBatch:
        hi, lo = _words(list(held))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(held), member)),
                pa.array(cuckoo.shard_of(hi, shards).astype(np.int32)),
                pa.array(hi.view(np.int64)),
                pa.array(lo.view(np.int64)),
                pa.array(np.fromiter(held.values(), np.int64, len(held))),
            ],
            names=["member", "shard", "hi", "lo", "n"],
        )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            own: Counter = Counter()
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                named = b"-" if not name.is_valid else b"=" + name.as_py().encode()
                own[xxhash.xxh3_128_digest(named + b"\0" + text.encode())] += 1
                held.update(set(line_keys(text, min_chars)[1]) - {b""})
                if len(held) >= _HELD_KEYS:
                    yield flush(held, False)
                    held.clear()
            if own:
                yield flush(own, True)
        if held:
            yield flush(held, False)

    return over


def _update_filter(min_docs: int):
    """One shard: its old filter and all its keys with old and new count -> the new filter."""

    def update(key: tuple, counts: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        hi = counts["hi"].to_numpy().view(np.uint64)
        lo = counts["lo"].to_numpy().view(np.uint64)
        before, now = (counts[c].to_numpy() >= min_docs for c in ("n_before", "n"))
        slots = None
        if len(old):
            slots = np.frombuffer(old["slots"].iloc[0], np.uint16).reshape(-1, cuckoo.SLOTS).copy()
            try:
                cuckoo.delete(slots, hi[before & ~now], lo[before & ~now])
                cuckoo.insert(slots, hi[now & ~before], lo[now & ~before])
            except cuckoo.Full:
                slots = None
        if slots is None:
            slots = cuckoo.build(hi[now], lo[now])
        asked = cuckoo.Shards({0: slots}, 1).contains(hi, lo) & ~now
        rows = np.stack([hi[asked], lo[asked]], axis=1)
        return pd.DataFrame(
            {"shard": [key[0]], "slots": [slots.tobytes()], "mistaken": [rows.tobytes()]}
        )

    return update


class _Judge:
    """Tells the lines to drop, from all shards' filters and mistaken keys."""

    def __init__(self, filters: list, shards: int):
        self.filters = cuckoo.Shards(
            {f["shard"]: np.frombuffer(f["slots"], np.uint16).reshape(-1, cuckoo.SLOTS) for f in filters},
            shards,
        )
        rows = np.frombuffer(b"".join(f["mistaken"] for f in filters), np.uint64).reshape(-1, 2)
        self.mistaken = {(int(a), int(b)) for a, b in rows}

    def dropped(self, keys: list[bytes]) -> np.ndarray:
        """For each key whether it is frequent; empty keys never are."""
        out = np.zeros(len(keys), bool)
        known = np.flatnonzero([bool(k) for k in keys])
        if len(known):
            hi, lo = _words([keys[i] for i in known])
            yes = self.filters.contains(hi, lo)
            if self.mistaken:
                for i in np.flatnonzero(yes):
                    yes[i] = (int(hi[i]), int(lo[i])) not in self.mistaken
            out[known] = yes
        return out


class LineStore:
    """Exact line counts and filters of a changing set of documents, in the folder `path`.

    `min_docs` documents make a line frequent; keys of fewer than `min_chars` code points
    are never counted nor dropped. Every row is a document, also where rows or ids repeat: it is
    told by its id, which may be null, and its text together, and a store may hold it several
    times. What makes a store is fixed; one opened again goes on from its latest version, and
    fails if it was made with other settings.

    Without a number of `shards` there are so many that `_SHARD_KEYS` keys at most go to each, and
    they are doubled as the store grows. A change is published as a new version by a mark
    written behind its filters; a change that dies leaves the version before it. Buckets that
    neither the latest version nor the one before it uses are removed. One change may run
    at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        min_docs: int = 10,
        min_chars: int = 1,
        shards: int | None = None,
        max_broadcast_bytes: int = 128 << 20,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.min_docs, self.min_chars = min_docs, min_chars
        self.max_broadcast_bytes = max_broadcast_bytes
        self._given = shards
        self.shards = shards or power_of_two(parallelism(spark))
        self.version = 0
        self._held = self._nothing_held()
        self._open()

    def _made_with(self) -> dict[str, int]:
        return json.loads(read_text(self.spark, f"{self.path}/{_SETTINGS}"))

    def _open(self) -> None:
        """Go on from the latest version."""
        self.version = self._latest()
        if not self.version:
            return
        made = self._made_with()
        self._given = self._given or made["shards"]
        if made != self._settings():
            raise ValueError(f"{self.path} was made with {made}, not {self._settings()}")
        mark = json.loads(read_text(self.spark, self._folder(_COMPLETE, self.version)))
        self.shards = mark.pop("shards")
        self._held = mark

    def _nothing_held(self) -> dict[str, list[int]]:
        return {name: [0] * min(self.shards, _BUCKETS) for name in _TABLES}

    def _settings(self) -> dict[str, int | None]:
        return {
            "min_docs": self.min_docs, "min_chars": self.min_chars, "shards": self._given,
            "buckets": _BUCKETS,
        }

    def _holds(self, folder: str) -> set[str]:
        return {name for name, _ in folder_ages(self.spark, folder)}

    def _versions(self) -> list[int]:
        found = self._holds(self.path)
        return [int(n.removeprefix("version=")) for n in found if n.startswith("version=")]

    def _latest(self) -> int:
        """The latest complete version, 0 if there is none."""
        numbers = self._versions()
        for version in sorted(numbers, reverse=True):
            if _COMPLETE in self._holds(f"{self.path}/version={version}"):
                return version
        if numbers and _SETTINGS not in self._holds(self.path):
            raise ValueError(f"{self.path} has versions, but does not say what they were made with")
        return 0

    def _folder(self, name: str, version: int) -> str:
        return f"{self.path}/version={version}/{name}"

    def _read(self, name: str, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a table, of some buckets or of all: `_held` has for each bucket the
        version that wrote it, 0 where it is empty."""
        places = [
            f"{self._folder(name, version)}/bucket={bucket}"
            for bucket, version in enumerate(self._held[name])
            if version and (buckets is None or bucket in buckets)
        ]
        if not places:
            return self.spark.createDataFrame([], _TABLES[name])
        return self.spark.read.schema(_TABLES[name]).parquet(*places)

    def _write(self, rows: DataFrame, name: str, version: int, shards: int) -> set[int]:
        """Write the rows to their buckets; which buckets those are."""
        folder = self._folder(name, version)
        bucketed = rows.withColumn("bucket", F.pmod("shard", F.lit(min(shards, _BUCKETS))))
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        found = self._holds(folder)
        return {int(n.removeprefix("bucket=")) for n in found if n.startswith("bucket=")}

    def counts(self) -> DataFrame:
        """shard, hi, lo, n: in how many documents each key is."""
        return self._read("counts")

    def members(self) -> DataFrame:
        """shard, hi, lo, n: how often each document is in the store."""
        return self._read("members")

    def filters(self) -> DataFrame:
        return self._read("filters")

    def insert(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> None:
        """Count the documents' lines; a null text is one empty line. A document that is in the
        store already is in it once more then."""
        self._change(docs, text_col, id_col, 1)

    def remove(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> None:
        """Undo `insert` for these documents. Fails, and changes nothing, if one of them is not in
        the store, with that id and text, as often as it is to be removed."""
        self._change(docs, text_col, id_col, -1)

    def _grown(self, docs: DataFrame, text_col: str, sign: int) -> int:
        """The number of shards that the store needs once the documents are in it."""
        if self._given or sign < 0:
            return self.shards
        keys = self.counts().count() + _lines_of(docs, text_col)
        return max(self.shards, power_of_two(-(-keys // _SHARD_KEYS)))

    def _touched(self, change: DataFrame) -> dict[bool, set[int]]:
        """The buckets that a change's documents (True) and keys (False) fall into; of a store that
        too many versions hold, all."""
        every = set(range(min(self.shards, _BUCKETS)))
        if len({v for held in self._held.values() for v in held if v}) >= _MAX_VERSIONS:
            return {True: every, False: every}
        bucket = F.pmod("shard", F.lit(len(every))).alias("bucket")
        met = change.select("member", bucket).distinct().collect()
        return {kind: {r["bucket"] for r in met if r["member"] == kind} for kind in (True, False)}

    def _change(self, docs: DataFrame, text_col: str, id_col: str, sign: int) -> None:
        self._open()  # another object may have gone on meanwhile
        if not self.version:
            write_text(self.spark, f"{self.path}/{_SETTINGS}", json.dumps(self._settings()))
        shards, new = self._grown(docs, text_col, sign), self.version + 1
        same = shards == self.shards
        every = set(range(min(shards, _BUCKETS)))
        kind = f"{_KIND}, {_COUNTS}"
        change = docs.select(
            F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text")
        ).mapInArrow(_count_keys(shards, self.min_chars), kind)
        touched = {True: every, False: every}
        if self.version and same:
            # Written before anything is read, as it says what has to be.
            change.write.mode("overwrite").parquet(self._folder("entries", new))
            change = self.spark.read.schema(kind).parquet(self._folder("entries", new))
            touched = self._touched(change)
        zero = F.lit(0).cast("long")
        shard = F.pmod(F.col("hi").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(shards)).cast("int")
        both = change.select(
            "member", "shard", "hi", "lo", zero.alias("n_before"), (F.col("n") * sign).alias("n")
        )
        for member, name in ((True, "members"), (False, "counts")):
            old = self._read(name, touched[member] if same else None).select(
                F.lit(member).alias("member"), shard.alias("shard"), "hi", "lo",
                F.col("n").alias("n_before"), "n",
            )
            both = both.unionByName(old)
        # Dealt by shard once, for the sums here; every task has combined its own before.
        summed = (
            both.repartition("shard")
            .groupBy("member", "shard", "hi", "lo")
            .agg(F.sum("n_before").alias("n_before"), F.sum("n").alias("n"))
        )
        unknown = F.raise_error(F.lit("a document to remove is not in the store"))
        summed = summed.withColumn("n", F.when(F.col("n") < 0, unknown).otherwise(F.col("n")))
        summed.write.mode("overwrite").partitionBy("member").parquet(self._folder("changes", new))
        changes = self.spark.read.schema(summed.schema).parquet(self._folder("changes", new))
        # Shards that were cut anew have new filters.
        filters = self._read("filters", touched[False] if same else set())
        of_keys = changes.filter("not member").drop("member").groupBy("shard")
        rows = {
            "filters": of_keys.cogroup(filters.groupBy("shard")).applyInPandas(
                _update_filter(self.min_docs), _FILTERS
            )
        }
        for member, name in ((True, "members"), (False, "counts")):
            left = changes.filter((F.col("member") == member) & (F.col("n") > 0))
            rows[name] = left.select("shard", "hi", "lo", "n")
        held = {}
        for name in _TABLES:
            written = self._write(rows[name], name, new, shards)
            rewritten = touched[name == "members"]
            held[name] = [
                new if b in written else 0 if b in rewritten else self._held[name][b] for b in sorted(every)
            ]
        write_text(self.spark, self._folder(_COMPLETE, new), json.dumps({"shards": shards, **held}))
        before, self._held = self._held, held
        self.version, self.shards = new, shards
        for name in ("changes", "entries"):
            delete(self.spark, self._folder(name, new))
        self._remove_unused(before)

    def _remove_unused(self, before: dict[str, list[int]]) -> None:
        """Remove the buckets of older versions that neither this version uses nor the one before."""
        used = {
            (name, version, bucket)
            for held in (before, self._held) for name in _TABLES
            for bucket, version in enumerate(held[name]) if version
        }
        for version in [v for v in self._versions() if v < self.version - 1]:
            if version not in {v for _, v, _ in used}:
                delete(self.spark, f"{self.path}/version={version}")
                continue
            delete(self.spark, self._folder(_COMPLETE, version))
            for name in _TABLES:
                folder = self._folder(name, version)
                for place in self._holds(folder):
                    _, _, bucket = place.partition("bucket=")
                    if bucket and (name, version, int(bucket)) not in used:
                        delete(self.spark, f"{folder}/{place}")

    def apply(
        self,
        docs: DataFrame,
        text_col: str = "text",
        into: tuple[str, str] = ("n_lines", "n_dropped"),
    ) -> DataFrame:
        """`docs`, which must be in the store, with the frequent lines taken out of the text.

        Two columns, named by `into`, are appended in place of columns of that name: how
        many lines a document had, and how many it lost. A null text becomes empty; the row
        of a document that loses all its lines stays, with an empty text.
        """
        kept = [c for c in docs.columns if c not in into]
        docs = docs.select(*[text_of(c).alias(c) if c == text_col else F.col(c) for c in kept])
        size = F.sum(F.length("slots") + F.length("mistaken"))
        held = self.filters().agg(size).first()[0] or 0
        if held > self.max_broadcast_bytes:
            return self._apply_at_shards(docs, text_col, into)
        judge = self.spark.sparkContext.broadcast(_Judge(self.filters().collect(), self.shards))
        min_chars = self.min_chars
        schema = extended(docs, **dict.fromkeys(into, LongType()))

        def rewrite(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            place = batch.schema.get_field_index(text_col)
            lines, keys = [], []
            for text in batch.column(place):
                of_text = line_keys(text.as_py(), min_chars)
                lines.append(of_text[0])
                keys += of_text[1]
            drop = judge.value.dropped(keys)
            texts, dropped, start = [], [], 0
            for own in lines:
                gone = drop[start : start + len(own)]
                start += len(own)
                dropped.append(int(gone.sum()))
                texts.append(
                    b"\n".join(x for x, g in zip(own, gone, strict=True) if not g).decode()
                )
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            columns += [
                pa.array([len(own) for own in lines], pa.int64()), pa.array(dropped, pa.int64())
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *into])

        return docs.mapInArrow(arrow_batches(rewrite), schema)

    def _apply_at_shards(
        self, docs: DataFrame, text_col: str, into: tuple[str, str]
    ) -> DataFrame:
        """The same for filters that are too large to broadcast: keys go to the exact counts."""
        min_chars = self.min_chars

        def keyed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts, places, keys = [], [], []
            for digest, text in zip(batch.column(0), batch.column(1), strict=True):
                for place, key in enumerate(line_keys(text.as_py(), min_chars)[1]):
                    if key:
                        texts.append(digest.as_py())
                        places.append(place)
                        keys.append(key)
            hi, lo = _words(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, pa.string()), pa.array(places, pa.int32()),
                    pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)),
                ],
                names=["digest", "place", "hi", "lo"],
            )

        names = fresh(docs, "digest", "gone")
        digest = F.sha2(text_col, 256)
        lines = docs.select(digest.alias("digest"), text_col).distinct().mapInArrow(
            arrow_batches(keyed), "digest STRING, place INT, hi BIGINT, lo BIGINT"
        )
        frequent = self.counts().filter(F.col("n") >= self.min_docs).select("hi", "lo")
        gone = (
            lines.join(frequent, ["hi", "lo"], "left_semi")
            .groupBy(F.col("digest").alias(names[0]))
            .agg(F.collect_set("place").alias(names[1]))
        )
        lost = F.coalesce(names[1], F.array().cast("array<int>"))
        lines_of = F.split(text_col, "\n", -1)
        left = F.filter(lines_of, lambda _, place: ~F.array_contains(lost, place))
        text = F.array_join(left, "\n").alias(text_col)
        return (
            docs.withColumn(names[0], digest)
            .join(gone, names[0], "left")
            .select(
                *[text if c == text_col else F.col(c) for c in docs.columns],
                F.size(lines_of).cast("long").alias(into[0]),
                F.size(lost).cast("long").alias(into[1]),
            )
        )


def drop_frequent_lines(
    docs: DataFrame,
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    into: tuple[str, str] = ("n_lines", "n_dropped"),
    id_col: str = "doc_id",
) -> DataFrame:
    """`docs` without the lines that `min_docs` or more of them share; see LineStore. Every row
    counts as a document, also where ids repeat or are null."""
    store = LineStore(docs.sparkSession, scratch_dir(docs.sparkSession, "lines"), min_docs, min_chars)
    store.insert(docs, text_col, id_col)
    return store.apply(docs, text_col, into)
