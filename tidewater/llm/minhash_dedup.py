"""Near-duplicate documents by a multi-index Hamming join of minhash signatures."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import keep
from tidewater.llm.components import components

SHINGLE = 5
#: Links need 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
#: A signature has CHUNKS * WIDTH minhashes of 32 bits.
CHUNKS, WIDTH = 4, 6
#: Errors allowed in a chunk. Pairs that differ in fewer than CHUNKS * (ERRORS + 1) = 16 of the 24
#: minhashes have, by pigeonhole, a chunk with no more than this. A pair whose similarity is 0.75
#: exactly differs in more with a probability of 2e-5.
ERRORS = 3
POSITIONS = CHUNKS * WIDTH
#: Words whose hashes a task remembers, and shingles hashed at once; they bound memory only.
REMEMBERED, BLOCK = 200_000, 1 << 15

#: Bands of sizes for each power of e.
BANDS = 32
#: Rounds in which components that meet are tried by one pair; what is left is tried in full.
ROUNDS = 2

_RANDOM = np.random.Generator(np.random.PCG64(7))
_PLACE = _RANDOM.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RANDOM.integers(1, 1 << 63, POSITIONS, dtype=np.uint64)
_ODD = _RANDOM.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles.

    ``bytes.lower`` lower-cases A-Z alone and ``bytes.split`` splits at ASCII white space alone.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(words))):
        mixed += hashes[i : i + n] * _PLACE[i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> np.ndarray:
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK]
        np.minimum(least, ((block[:, None] ^ _XOR) * _ODD).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, prints, signatures = [], [], []
        for text in batch.column(1).cast(pa.binary()):
            hashes = shingles(text.as_py())
            sizes.append(len(hashes))
            prints.append(xxhash.xxh128_digest(hashes.tobytes()) if len(hashes) else None)
            signatures.append(signature(hashes) if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.list_(pa.int32()))],
            ["doc_id", "n_shingles", "print", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = [shingles(text.as_py()).view(np.int64) for text in part.column(1).cast(pa.binary())]
            offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            hashes = pa.ListArray.from_arrays(offsets, np.concatenate(sets) if sets else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), hashes], ["id", "hashes"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for left, right in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (x.values.to_numpy().view(np.uint64) for x in (left, right))
            small, large = (a, b) if len(a) < len(b) else (b, a)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int(np.count_nonzero(large[at] == small))
            found.append(100 * both >= SIMILARITY * (len(a) + len(b) - both))
        yield batch.select([0, 1]).filter(pa.array(found, pa.bool_()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough.

    The pairs go to the sets, side by side, so a document with many partners sends its set with
    each of them, and no task gathers them.
    """
    left, right = sets.toDF("a", "left"), sets.toDF("b", "right")
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return keep(joined.mapInArrow(_linked, "a long, b long"), "links")


def _keys(nodes: DataFrame) -> DataFrame:
    """A key for every chunk and every choice of ERRORS positions of it that may differ."""
    keys = [
        F.xxhash64(F.lit(number), *[F.get("signature", F.lit(chunk * WIDTH + i)) for i in alike])
        for number, (chunk, alike) in enumerate((c, a) for c in range(CHUNKS) for a in combinations(range(WIDTH), WIDTH - ERRORS))
    ]
    return nodes.select("id", F.explode(F.array(*keys)).alias("key"))


def _first_shingles(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """``h, id, component, n, left``: the shingles by which links between open components are found.

    Shingles are ordered by the number of open documents that hold them. From the first one that two
    sets of m and n shingles have in common, each must go on long enough for a link, which needs
    0.75 / 1.75 * (m + n) in common; so that first one stands among the first quarter of either, and
    among the first seventh if they are of a size. A passage that very many documents share comes
    last in that order.
    """
    # a document whose id repeats may have several sets
    named = sets.withColumn("set", F.xxhash64("hashes"))
    held = named.join(open_, "id").select("id", "set", "component", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    held = keep(held, "held")
    counts = held.groupBy("h").agg(F.count("*").alias("holders"), F.min("component").alias("x"), F.max("component").alias("y"))
    order = Window.partitionBy("id", "set").orderBy("holders", "h")
    ranked = held.join(counts, "h").withColumn("at", F.row_number().over(order))
    quarter = F.col("at") <= F.col("n") - F.ceil(SIMILARITY * F.col("n") / 100) + 1
    left = (F.col("n") - F.col("at") + 1).alias("left")
    return keep(ranked.where(quarter & (F.col("x") < F.col("y"))).select("h", "id", "component", "n", left), "first-shingles")


def _long_enough(left_a: str, left_b: str, size_a: str, size_b: str) -> Column:
    return (100 + SIMILARITY) * F.least(left_a, left_b) >= SIMILARITY * (F.col(size_a) + F.col(size_b))


def _band(n: Column) -> Column:
    """Sizes that differ by 3 % or less, mostly, share a band; larger sizes have no lower one."""
    return F.floor(F.log(n) * BANDS)


def _furthest(left: str, n: str) -> Column:
    """The size up to which a set may link with one of n shingles of which ``left`` are still to come."""
    return ((100 + SIMILARITY) * F.col(left) - SIMILARITY * F.col(n)) / SIMILARITY


def _meetings(first: DataFrame) -> DataFrame:
    """Pairs of components that a link may join, by shingle and bands of sizes, and the member of either with most to come.

    The bounds on sizes and on what is to come are part of the join key, so a passage that very many
    documents share makes rows only for sizes at which a link is still possible.
    """
    most = F.max(F.struct("left", "id"))
    grouped = first.groupBy("h", "component", _band(F.col("n")).alias("band"))
    meeting = keep(grouped.agg(most.alias("m"), F.min("n").alias("n"), F.max("n").alias("largest")), "meeting")
    several = meeting.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("h")
    meeting = meeting.join(several, "h").select("h", "component", "band", F.col("m.left").alias("left"), F.col("m.id").alias("id"), "n", "largest")
    meeting = keep(meeting.withColumn("limit", _band(_furthest("left", "n"))), "meeting")
    # a link's smaller set knows the bands above its own, its larger set those below
    up = F.least("limit", _band(100 * F.col("largest") / SIMILARITY))
    down = _band(SIMILARITY * F.col("n") / 100)
    small = meeting.where(up >= F.col("band")).select("h", "component", "left", "id", "n", "band", F.explode(F.sequence("band", up)).alias("other"))
    high = F.least("limit", "band")
    large = meeting.where(high >= down).select("h", "component", "left", "id", "n", F.explode(F.sequence(down, high)).alias("other"), "band")
    one = small.toDF("h", "ca", "most_a", "a", "least_a", "band_a", "band_b")
    met = one.join(large.toDF("h", "cb", "most_b", "b", "least_b", "band_a", "band_b"), ["h", "band_a", "band_b"])
    once = (F.col("ca") < F.col("cb")) | ((F.col("band_a") < F.col("band_b")) & (F.col("ca") > F.col("cb")))
    return met.where(once & _long_enough("most_a", "most_b", "least_a", "least_b"))


def _between(first: DataFrame) -> DataFrame:
    """``a, b, ca, cb, shared``: pairs of different components among which all links between them are.

    Components meet first, members of those that do after that, so a large component is not paired
    with itself.
    """
    pairs = _meetings(first).drop("a", "b")
    sized = first.withColumn("band", _band(F.col("n")))
    a, b = (
        sized.select("h", *[F.col(c).alias(n + x) for c, n in (("id", ""), ("component", "c"), ("n", "n"), ("left", "l"), ("band", "band_"))])
        for x in "ab"
    )
    sizes = 100 * F.least("na", "nb") >= SIMILARITY * F.greatest("na", "nb")
    some = pairs.join(a, ["h", "ca", "band_a"]).where(_long_enough("la", "most_b", "na", "least_b")).select("h", "ca", "cb", "band_b", "a", "na", "la")
    met = some.join(b, ["h", "cb", "band_b"]).where(sizes & _long_enough("la", "lb", "na", "nb"))
    return keep(_ordered(met).groupBy("a", "b", "ca", "cb").agg(F.count("*").alias("shared")), "between")


def _ordered(pairs: DataFrame) -> DataFrame:
    """The pairs with the smaller component as ``ca``."""
    turned = F.col("ca") > F.col("cb")
    sides = [F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("ca", "cb"), ("cb", "ca"), ("a", "b"), ("b", "a"))]
    return pairs.select(*sides, *[c for c in pairs.columns if c not in ("ca", "cb", "a", "b")])


def _closest(pairs: DataFrame, by: str) -> DataFrame:
    """One pair for each two components."""
    return pairs.groupBy("ca", "cb").agg(F.max(F.struct(by, "a", "b")).alias("c")).select("c.a", "c.b")


def similar_pairs(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Links between documents of different sets that suffice for the components, and those.

    1. Keys are counted; those of a single document go. A document is as central as its keys have
       members. Every other member of a key points to the most central one, and each document is
       paired with that which most of its keys point to: no more pairs than documents.
    2. Such pairs are confirmed on the full sets, which gives components.
    3. A link can be left only between members of a key in different components. Those documents are
       open. Components that meet by a rare shingle are first tried by one pair of members, so that
       two parts of a large group become one before members meet.
    4. All pairs that may be links between the components left are made; of those between the same
       two, that with most in common is confirmed first, the others only if it was no link.
    """
    shared = _keys(nodes).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = keep(_keys(nodes).join(shared, "key"), "members")
    central = members.groupBy("id").agg(F.sum("n").alias("central"))
    hubs = members.join(central, "id").groupBy("key").agg(F.max(F.struct("central", (-F.col("id")).alias("hub"))).alias("h"))
    pointed = members.join(hubs.select("key", (-F.col("h.hub")).alias("hub")), "key").where("id <> hub")
    pointed = pointed.groupBy("id", "hub").agg(F.count("*").alias("keys"))
    stars = pointed.groupBy(F.col("id").alias("b")).agg(F.max(F.struct("keys", (-F.col("hub")).alias("a"))).alias("m"))
    stars = keep(stars.select((-F.col("m.a")).alias("a"), "b"), "stars")
    involved = members.select("id").distinct()
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sets = keep(texts.join(involved, "id", "left_semi").mapInArrow(_sets, "id long, hashes array<long>").distinct(), "sets")
    links = _links(stars, sets)
    found = components(links)

    placed = members.select("key", "id").join(found.toDF("id", "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = keep(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    open_ = keep(placed.join(mixed, "key").select("id", "component").distinct(), "open")
    first = _first_shingles(open_, sets)
    for _ in range(ROUNDS):
        met = _ordered(_meetings(first)).withColumn("shared", F.least("most_a", "most_b"))
        more = _links(_closest(met, "shared"), sets)
        if more.isEmpty():
            break
        links = links.union(more)
        found = components(links)
        moved = first.drop("component").join(found.toDF("id", "component"), "id", "left")
        first = keep(moved.select("h", "id", F.coalesce("component", "id").alias("component"), "n", "left"), "first-shingles")
    between = _between(first)
    closest = _closest(between, "shared")
    for last in (False, True):
        more = _links(closest, sets)
        if not more.isEmpty():
            links = links.union(more)
            found = components(links)
        if last:
            break
        of_a, of_b = found.toDF("a", "x"), found.toDF("b", "y")
        rest = between.join(closest, ["a", "b"], "left_anti").join(of_a, "a", "left").join(of_b, "b", "left")
        closest = keep(rest.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b"), "rest")
        if closest.isEmpty():
            break
    return links, found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents are linked if 100 * intersection >= 75 * union of their sets of five-word shingles;
    a component's id is its smallest doc_id. Documents with the same set are one node of the graph.
    The index finds all pairs whose signatures differ in at most 15 of 24 minhashes; every link is
    confirmed on full sets of 64-bit shingle hashes.

    A null text is an empty one: no shingles, linked with nothing. A null id is linked with nothing
    either, its component is null and it is kept. Rows that share an id are one document with several
    texts. Other columns are not read. An empty table gives an empty one. Ids are integers.
    """
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    signed = keep(read.mapInArrow(_signed, "doc_id long, n_shingles long, print binary, signature array<int>"), "signatures")
    named = signed.where("doc_id is not null and print is not null")
    # the same set has the same signature, so grouping by all of them is grouping by the set
    nodes = keep(named.groupBy("print", "n_shingles", "signature").agg(F.min("doc_id").alias("id")), "nodes")
    _, found = similar_pairs(docs, nodes, id_col, text_col)
    of = nodes.select("print", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    of = keep(of.select("print", F.coalesce("component", "id").alias("component")), "node-components")
    placed = signed.drop("signature").join(of, "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, all columns as they are."""
    gone = near_duplicates(docs, id_col, text_col).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[f"`{id_col}`"] == gone["__gone"], "left_anti")


SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
        list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), h AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s
), l AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM h a JOIN h b ON a.h = b.h AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), r AS (
    SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(b) AS component_id, s.doc_id = min(b) AS kept
FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, s
"""
