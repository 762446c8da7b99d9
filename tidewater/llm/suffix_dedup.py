"""Removal of repeated passages by the suffixes at a difference cover."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import folder, keep, shuffles_freed

#: A passage is removed if it is covered by strings of so many bytes that start earlier too.
LENGTH = 100
#: A perfect difference set modulo PERIOD: for any two places i and j there is one d < PERIOD with
#: i + d and j + d both in the cover. An eighth of all places is.
PERIOD = 73
COVER = (1, 2, 4, 8, 16, 32, 37, 55, 64)
#: A sampled suffix is named by so many bytes: if two strings of LENGTH are equal, so are those of a
#: pair of sampled suffixes inside them.
NAMED = LENGTH - PERIOD + 1
#: Bytes of text in a batch, names in a bucket and bytes hashed at once; they bound memory only.
BATCH, BUCKET, BLOCK = 4 << 20, 1 << 20, 1 << 18
#: Bytes of a name that are compared; some pairs that differ pass and are told apart by their windows.
NAME = 6

_random = np.random.Generator(np.random.PCG64(3))
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_random.integers(1, 1 << 62)) * 2 + 1


def _powers(base: int) -> np.ndarray:
    steps = np.full(BLOCK + LENGTH + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))

# What tasks tell each other about a batch.
COPIES, NAMES, WINDOWS = 0, 1, 2
NOTE = "batch long, kind int, bucket long, payload binary"
LIST = "batch long, bucket long, values binary, twice binary"


def hashes(data: np.ndarray, length: int, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the strings of ``length`` bytes that start at the (sorted) places ``at``."""
    found = np.empty(len(at), np.uint64)
    for start in range(0, len(data), BLOCK):
        i, j = np.searchsorted(at, (start, start + BLOCK))
        if i == j:
            continue
        block = data[start : start + BLOCK + length]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_VALUE[block] * _POWER[: len(block)], out=sums[1:])
        local = at[i:j] - start
        found[i:j] = (sums[local + length] - sums[local]) * _INVERSE[local]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0x94D049BB133111EB)
    return found ^ found >> np.uint64(32)


def _slices(values: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The parts of a sorted array by the leading bits of its values."""
    if not len(values):
        return
    buckets = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    for i, j in zip(starts, [*starts[1:], len(values)], strict=True):
        yield int(buckets[i]), slice(int(i), int(j))


class Batch:
    """The documents of a batch side by side. Nothing that is found reaches over a document's end."""

    def __init__(self, table: pa.Table, notes: pa.Table, bits: int):
        table = table.sort_by("place")
        self.table, self.bits = table, bits
        self.notes = notes.to_pydict()
        texts = table["data"].combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        self.bounds = offsets - offsets[0]
        self.sizes = np.diff(self.bounds)
        self.copy = np.zeros(len(self.sizes), bool)
        for payload in self.payloads(COPIES).values():
            self.copy[np.isin(table["place"].to_numpy(), np.frombuffer(payload, np.int64))] = True

    def payloads(self, kind: int) -> dict[int, bytes]:
        notes = self.notes
        return {b: p for k, b, p in zip(notes["kind"], notes["bucket"], notes["payload"], strict=True) if k == kind}

    def documents(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds[1:], at, side="right")

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cover, and the names of the suffixes there: the leading bits of a hash."""
        places = (np.arange(0, len(self.data), PERIOD)[:, None] + np.array(COVER) - 1).ravel()
        places = places[places < len(self.data)]
        of = self.documents(places)
        places = places[(places + NAMED <= self.bounds[of + 1]) & (self.sizes[of] >= LENGTH) & ~self.copy[of]]
        return places, hashes(self.data, NAMED, places) >> np.uint64(64 - 8 * NAME) << np.uint64(64 - 8 * NAME)

    def told(self, values: np.ndarray, kind: int) -> np.ndarray:
        """What the notes say on each of the sorted, distinct values."""
        said = np.zeros(len(values), bool)
        payloads = self.payloads(kind)
        for bucket, part in _slices(values, self.bits):
            if bucket in payloads:
                n = part.stop - part.start
                said[part] = np.unpackbits(np.frombuffer(payloads[bucket], np.uint8), count=n).astype(bool)
        return said

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where a string of LENGTH may occur elsewhere, as it holds a repeated name, and its hash."""
        places, names = self.samples()
        distinct, inverse = np.unique(names, return_inverse=True)
        places = places[self.told(distinct, NAMES)[inverse]]
        of = self.documents(places)
        first = np.maximum(places - (PERIOD - 1), self.bounds[of])
        last = np.minimum(places, self.bounds[of + 1] - LENGTH)
        first, last = first[first <= last], last[first <= last]
        n = len(self.data) + 1
        inside = np.cumsum(np.bincount(first, minlength=n) - np.bincount(last + 1, minlength=n)[:n]) > 0
        at = np.flatnonzero(inside)
        return at, hashes(self.data, LENGTH, at)

    def lists(self, values: np.ndarray, key: int, width: int) -> pa.Table:
        """The distinct values by bucket, and which occur more than once here."""
        distinct, counts = np.unique(values, return_counts=True)
        rows: dict[str, list] = {"batch": [], "bucket": [], "values": [], "twice": []}
        wide = distinct.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]
        for bucket, part in _slices(distinct, self.bits):
            rows["batch"].append(key)
            rows["bucket"].append(bucket)
            rows["values"].append(wide[part].tobytes())
            rows["twice"].append(np.packbits(counts[part] > 1).tobytes())
        schema = pa.schema([("batch", pa.int64()), ("bucket", pa.int64()), ("values", pa.binary()), ("twice", pa.binary())])
        return pa.table(rows, schema)

    def cleaned(self) -> pa.Table:
        """What is left of each document when repeated strings are gone."""
        at, found = self.windows()
        distinct, first, inverse = np.unique(found, return_index=True, return_inverse=True)
        repeated = self.told(distinct, WINDOWS)[inverse] | (first[inverse] != np.arange(len(at)))
        n = len(self.data) + 1
        at = at[repeated]
        steps = np.bincount(at, minlength=n) - np.bincount(at + LENGTH, minlength=n)[:n]
        gone = np.cumsum(steps)[:-1] > 0
        gone |= np.repeat(self.copy & (self.sizes >= LENGTH), self.sizes)
        before = np.concatenate([[False], gone[:-1]]) if len(gone) else gone
        starts = self.bounds[:-1][self.sizes > 0]
        before[starts] = False
        removed = np.concatenate([[0], np.cumsum(gone)])
        spans = np.concatenate([[0], np.cumsum(gone & ~before)])
        counts = np.diff(removed[self.bounds])
        left = np.concatenate([[0], np.cumsum(self.sizes - counts)]).astype(np.int32)
        kept = pa.Array.from_buffers(pa.binary(), len(self.sizes), [None, pa.py_buffer(left.tobytes()), pa.py_buffer(self.data[~gone].tobytes())])
        return pa.table(
            {
                "doc_id": self.table["doc_id"], "n_bytes": pa.array(self.sizes, pa.int64()), "n_removed": pa.array(counts, pa.int64()),
                "n_spans": pa.array(np.diff(spans[self.bounds]), pa.int64()), "kept": kept,
            }
        )


def _values(binary: bytes, width: int) -> np.ndarray:
    """The numbers of ``lists`` again, as the leading bytes of 64 bits."""
    wide = np.zeros((len(binary) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(binary, np.uint8).reshape(-1, width)
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def _noted(kind: int, width: int, earlier: bool):
    """Tells each batch which of its values other batches have: earlier ones only, or any."""

    def note(table: pa.Table) -> pa.Table:
        table = table.sort_by("batch").to_pydict()
        lists = [_values(v, width) for v in table["values"]]
        every = np.concatenate(lists)
        # lists come in the order of batches and hold a value once, so the first one is the earliest
        _, first, inverse, counts = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
        said = first[inverse] != np.arange(len(every)) if earlier else counts[inverse] > 1
        rows: dict[str, list] = {"batch": [], "kind": [], "bucket": [], "payload": []}
        at = 0
        for batch, bucket, twice, values in zip(table["batch"], table["bucket"], table["twice"], lists, strict=True):
            part = said[at : at + len(values)]
            at += len(values)
            if not earlier:
                part = part | np.unpackbits(np.frombuffer(twice, np.uint8), count=len(values)).astype(bool)
            if part.any():
                for name, value in zip(rows, (batch, kind, bucket, np.packbits(part).tobytes()), strict=True):
                    rows[name].append(value)
        schema = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("payload", pa.binary())])
        return pa.table(rows, schema)

    return note


def _batches(docs: DataFrame, id_col: str, text_col: str, batch: int) -> tuple[DataFrame, int]:
    """The documents in order, in batches of some MB, bucketed by batch so that reading them by batch moves nothing.

    ``place`` is a document's place among all: the number of its range, then that of its row.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("data")
    )
    total = read.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    ranges = max(1, ceil(total / batch))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("data"), F.monotonically_increasing_id()]
    placed = (
        read.repartitionByRange(ranges, *order)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("data"))
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("batch", F.spark_partition_id().cast("long"))
    )
    name = f"batches_{uuid.uuid4().hex}"
    writer = placed.write.bucketBy(ranges, "batch").option("path", folder(spark, "batches")).option("compression", "zstd")
    with shuffles_freed(spark):
        writer.saveAsTable(name)
    return spark.table(name), total


def _copies(batches: DataFrame) -> DataFrame:
    """Notes on documents whose whole text an earlier one has."""
    digests = batches.select("place", "batch", F.sha2("data", 256).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("place").alias("first"))
    later = digests.join(firsts, "digest").where("place <> first")
    # at most the documents of a batch
    places = later.groupBy("batch").agg(F.sort_array(F.collect_list("place")).alias("places"))
    payload = F.unhex(F.array_join(F.transform("places", _little_endian), ""))
    return places.select("batch", F.lit(COPIES).alias("kind"), F.lit(0).cast("long").alias("bucket"), payload.alias("payload"))


def _little_endian(number):
    """The hexadecimal digits of a long, last byte first."""
    digits = F.lpad(F.hex(number), 16, "0")
    return F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: int = BATCH, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for each row of ``docs``; ``kept`` are the bytes left.

    1. Sampled suffixes, an eighth of all, are sorted by their names in each batch of documents and,
       by the names' leading bits, over all batches: equal names lie side by side.
    2. Every string of LENGTH bytes that occurs twice holds a repeated name. So the other suffixes
       are compared only near one: their LENGTH first bytes, as 64-bit hashes, again in a batch and
       then over all. Of equal strings the first in order of documents and places stays.
    3. Bytes covered by the others go.

    The full order of suffixes is not made, as no more than LENGTH bytes are compared; names are
    hashes of them, so there is no recursion. Batches and buckets have a fixed size, however often a
    passage occurs: a batch sends a name once. Texts of documents that are copies as wholes are found
    by digest first and are not compared further.

    A null text counts as empty. Documents are ordered by id, nulls last, then by a hash of the text;
    rows that repeat an id are documents of their own. Texts below LENGTH bytes keep all. Other
    columns are not read. An empty table gives an empty one.
    """
    table, total = _batches(docs, id_col, text_col, batch)
    bits = max(0, ceil(log2(max(1, total * len(COVER) / PERIOD / bucket))))
    with shuffles_freed(docs.sparkSession):
        copies = keep(_copies(table), "copies")

    def by_batch(notes: DataFrame, work, schema: str) -> DataFrame:
        return table.groupBy("batch").cogroup(notes.groupBy("batch")).applyInArrow(work, schema)

    def names(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        batch = Batch(left, right, bits)
        return batch.lists(batch.samples()[1], key[0].as_py(), NAME)

    def windows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        batch = Batch(left, right, bits)
        return batch.lists(batch.windows()[1], key[0].as_py(), 8)

    def clean(left: pa.Table, right: pa.Table) -> pa.Table:
        return Batch(left, right, bits).cleaned()

    def told(lists: DataFrame, kind: int, width: int, earlier: bool) -> DataFrame:
        return lists.groupBy("bucket").applyInArrow(_noted(kind, width, earlier), NOTE)

    with shuffles_freed(docs.sparkSession):
        named = keep(told(by_batch(copies, names, LIST), NAMES, NAME, False), "names")
        notes = copies.union(named)
        compared = keep(told(by_batch(notes, windows, LIST), WINDOWS, 8, True), "windows")
    return by_batch(notes.union(compared), clean, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


SQL = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), b AS (
    SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(regexp_extract_all(h, '..')) AS byte FROM d
), w AS (
    SELECT doc_id, i, byte, i + 100 <= n AS fits,
           md5(string_agg(byte, '') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 99 FOLLOWING)) AS s FROM b
), f AS (
    SELECT doc_id, i, byte, fits AND row_number() OVER (PARTITION BY fits, s ORDER BY doc_id, i) > 1 AS again FROM w
), c AS (
    SELECT doc_id, i, byte, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM f
), e AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c
), k AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
           coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS left_over FROM e GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(left_over, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
