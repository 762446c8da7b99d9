"""Ranked lexical search by a dual-tree traversal of items and documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidewater.llm.common import keep
from tidewater.llm.transducer import DIGITS, Transducer, bytes_of, words_of

BEST = 10
#: Part of a document's length in its weight, in percent.
LENGTH = 75
#: Terms of the items that are searched for in one pass over the documents.
CHUNK = 1 << 20
#: Items under one tree; children of an item node, of a document node; documents in a leaf.
ITEMS, ITEM_FAN, DOC_FAN, LEAF = 64, 4, 8, 32


class Nodes:
    """Sparse rows (documents, or nodes with the largest value of each term) one after the other."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.starts, self.terms, self.values = starts, terms, values

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Nodes:
        sizes = (self.starts[1:] - self.starts[:-1])[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Nodes(starts, self.terms[at], self.values[at])

    def parents(self, fan: int, n_terms: int) -> Nodes:
        """One node for each ``fan`` rows in order, with the largest value of each term."""
        of = np.repeat(np.arange(len(self)) // fan, self.starts[1:] - self.starts[:-1])
        key = of * n_terms + self.terms
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        starts = np.searchsorted(key[first], np.arange(-(-len(self) // fan) + 1) * n_terms)
        largest = np.maximum.reduceat(self.values[order], first) if len(key) else self.values
        return Nodes(starts, key[first] % n_terms, largest)

    def products(self, weights: np.ndarray) -> np.ndarray:
        """The inner product of each row with ``weights``; rows are never empty."""
        return np.add.reduceat(self.values * weights[self.terms], self.starts[:-1]) if len(self) else np.empty(0, np.int64)


class Best:
    """The best documents of an item so far: highest score, then smallest id, a missing id last."""

    def __init__(self, k: int, ids: pa.DataType):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), pa.array([], ids)

    def least(self) -> int:
        """What a document must score to matter."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        if len(scores) > self.k:
            near = np.flatnonzero(scores >= np.partition(scores, -self.k)[-self.k])
            scores, ids = scores[near], ids.take(pa.array(near))
        both = pa.table({"score": np.concatenate([self.scores, scores]), "id": pa.concat_arrays([self.ids, ids])})
        both = both.sort_by([("score", "descending"), ("id", "ascending")]).slice(0, self.k).combine_chunks()
        self.scores = both.column("score").to_numpy()
        self.ids = both.column("id").chunk(0) if both.num_rows else self.ids


def item_levels(weights: np.ndarray) -> list[np.ndarray]:
    """Dense rows of the items, then of their nodes up to one root, each with the largest weights below."""
    levels = [weights]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append(np.stack([below[k : k + ITEM_FAN].max(axis=0) for k in range(0, len(below), ITEM_FAN)]))
    return levels


def doc_levels(docs: Nodes, n_terms: int) -> list[Nodes]:
    """The leaves of LEAF documents, then their nodes up to one root."""
    levels = [docs.parents(LEAF, n_terms)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].parents(DOC_FAN, n_terms))
    return levels


def similar_first(docs: Nodes, weights: np.ndarray) -> np.ndarray:
    """An order of the documents in which those with the same heaviest terms are neighbours."""
    of = np.repeat(np.arange(len(docs)), docs.starts[1:] - docs.starts[:-1])
    order = np.lexsort((-docs.values * weights[docs.terms], of))
    top = docs.terms[order[docs.starts[:-1]]]
    second = docs.terms[order[np.minimum(docs.starts[:-1] + 1, docs.starts[1:] - 1)]]
    return np.lexsort((second, top))


def traverse(items: list[np.ndarray], docs: list[Nodes], documents: Nodes, ids: pa.Array, best: list[Best]) -> int:
    """Adds what ``documents`` hold to the best of the items; returns how many documents were scored.

    Both trees are descended together. A pair of nodes is left out if the inner product of their largest
    values, which no pair below can exceed, is less than the weakest kth score below the item node.
    Leaves are read from the highest bound down, so the kth scores rise early.
    """
    scored = 0
    level, depth = len(items) - 1, len(docs) - 1
    pairs = {0: np.arange(len(docs[depth]))}
    while True:
        left = {}
        for node, nodes in pairs.items():
            below = best[node * ITEM_FAN**level : (node + 1) * ITEM_FAN**level]
            bounds = docs[depth].take(nodes).products(items[level][node])
            near = bounds >= min(b.least() for b in below)
            if near.any():
                left[node] = nodes[near], bounds[near]
        if level == depth == 0:
            break
        pairs = {}
        for node, (nodes, _) in left.items():
            if depth:
                nodes = (nodes[:, None] * DOC_FAN + np.arange(DOC_FAN)).ravel()
                nodes = nodes[nodes < len(docs[depth - 1])]
            children = range(node * ITEM_FAN, min((node + 1) * ITEM_FAN, len(items[level - 1]))) if level else [node]
            pairs |= dict.fromkeys(children, nodes)
        level, depth = max(level - 1, 0), max(depth - 1, 0)
    for item, (nodes, bounds) in left.items():
        order = np.argsort(-bounds, kind="stable")
        at = 0
        while at < len(order):
            some = order[at : at + DOC_FAN]
            some = some[bounds[some] >= best[item].least()]
            if not len(some):
                break
            rows = (nodes[some][:, None] * LEAF + np.arange(LEAF)).ravel()
            rows = rows[rows < len(documents)]
            scores = documents.take(rows).products(items[0][item])
            scored += len(rows)
            hit = np.flatnonzero(scores >= best[item].least())
            if len(hit):
                best[item].add(scores[hit], ids.take(pa.array(rows[hit])))
            at += DOC_FAN
    return scored


def postings(docs: DataFrame, machine: Transducer) -> DataFrame:
    """``doc_id, n, terms, times``: the number of terms of each document that has any, and how often it has those of ``machine``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = T.StructType([docs.schema["doc_id"]]).add("n", T.LongType()).add("terms", T.ArrayType(T.IntegerType())).add("times", T.ArrayType(T.LongType()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            n = np.zeros(batch.num_rows, dtype=np.int64)
            keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for letters, starts, lengths, of in words_of(data, offsets, alphabet=DIGITS):
                n += np.bincount(of, minlength=len(n))
                found = machine.walk(letters, starts, lengths, np.full(len(starts), machine.root), np.zeros(len(starts), dtype=np.int64))
                hit = np.flatnonzero(found >= 0)
                key, t = np.unique(of[hit] << 32 | found[hit], return_counts=True)
                keys.append(key)
                times.append(t)
            # a document's words may lie in several stretches
            key, of = np.unique(np.concatenate(keys), return_inverse=True)
            t = np.zeros(len(key), dtype=np.int64)
            np.add.at(t, of, np.concatenate(times))
            rows = np.flatnonzero(n)
            starts = np.searchsorted(key, np.append(rows, len(n)) << 32).astype(np.int32)
            terms = pa.ListArray.from_arrays(starts, (key & 0xFFFFFFFF).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), pa.array(n[rows]), terms, pa.ListArray.from_arrays(starts, t)], ["doc_id", "n", "terms", "times"]
            )

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, schema)


def _counted(text: str | None) -> Counter:
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    found: Counter = Counter()
    for letters, starts, lengths, _ in words_of(data, np.array([0, len(data)]), alphabet=DIGITS):
        found.update(bytes(letters[s : s + n]) for s, n in zip(starts, lengths))
    return found


def chunks(items: DataFrame, most: int = CHUNK) -> Iterator[list[tuple[Row, Counter]]]:
    """The items with their terms, as many at a time as have ``most`` terms together (one at least)."""
    chunk, size = [], 0
    for row in items.toLocalIterator():
        terms = _counted(row.text)
        if chunk and size + len(terms) > most:
            yield chunk
            chunk, size = [], 0
        if terms:
            chunk.append((row, terms))
            size += len(terms)
    if chunk:
        yield chunk


def _search(docs: DataFrame, chunk: list[tuple[Row, Counter]], first: int, item_id: T.StructField, k: int) -> DataFrame | None:
    """``item, item_id, doc_id, score``: the best documents of each item in each task."""
    names = sorted(set(chain.from_iterable(terms for _, terms in chunk)))
    place = {t: i for i, t in enumerate(names)}
    found = keep(postings(docs, Transducer(names)), "postings")
    n_docs, n_words = found.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    held = dict(found.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(names))]
    # items with the same heaviest term are neighbours in the tree
    vectors = [{place[t]: c * weights[place[t]] for t, c in terms.items() if place[t] in held and weights[place[t]]} for _, terms in chunk]
    order = sorted((i for i, v in enumerate(vectors) if v), key=lambda i: (max(vectors[i], key=lambda t: (vectors[i][t], t)), i))
    rows = [(first + i, chunk[i][0].item_id, np.array(sorted(vectors[i].items()), dtype=np.int64)) for i in order]
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    schema = T.StructType([T.StructField("item", T.LongType()), item_id, found.schema["doc_id"], T.StructField("score", T.LongType())])
    length = F.expr(f"100 - {LENGTH} + cast({LENGTH} as decimal(38,0)) * n * {n_docs} div {n_words}")
    n_terms, to_arrow = len(names), to_arrow_type(item_id.dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        most = np.zeros(n_terms, dtype=np.int64)
        for *_, vector in items:
            most[vector[:, 0]] = np.maximum(most[vector[:, 0]], vector[:, 1])
        best: list[Best] | None = None
        for batch in batches:
            if best is None:
                best = [Best(k, batch.column("doc_id").type) for _ in items]
            terms = batch.column("terms")
            starts = terms.offsets.to_numpy().astype(np.int64)
            times = batch.column("times").flatten().to_numpy()
            m = np.repeat(batch.column("m").to_numpy(), starts[1:] - starts[:-1])
            documents = Nodes(starts - starts[0], terms.flatten().to_numpy().astype(np.int64), (1_000_000_000 * times) // (1000 * times + 8 * m))
            order = similar_first(documents, most)
            documents, ids = documents.take(order), batch.column("doc_id").take(pa.array(order))
            tree = doc_levels(documents, n_terms)
            for k0 in range(0, len(items), ITEMS):
                some = items[k0 : k0 + ITEMS]
                dense = np.zeros((len(some), n_terms), dtype=np.int64)
                for row, (*_, vector) in zip(dense, some):
                    row[vector[:, 0]] = vector[:, 1]
                traverse(item_levels(dense), tree, documents, ids, best[k0 : k0 + ITEMS])
        for (number, name, _), b in zip(items, best or []):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(b.scores), pa.int64()), pa.array([name] * len(b.scores), to_arrow), b.ids, pa.array(b.scores)],
                    ["item", "item_id", "doc_id", "score"],
                )

    return found.where("size(terms) > 0").select("doc_id", "terms", "times", length.alias("m")).mapInArrow(search, schema)


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = BEST,
    chunk: int = CHUNK,
    item_col: str = "item_id",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` for each row of ``items``: ``item_id, rank, doc_id, score``.

    Terms are runs of letters, digits and other characters beyond ASCII, A-Z in lower case. With N
    documents that have a term, L terms in all, n terms in a document, a term in df of them weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))); a document scores the sum, over the item's terms with
    repeats, of weight * (10^9 tf div (1000 tf + 8 m)), m = 100 - 75 + 75 n N div L. Only scores above
    0 count; equal ones are ranked by id.

    Documents are read once for the counts of the items' terms, which are kept; each task then takes
    its documents in batches, builds a tree over a batch and traverses it together with the tree of
    the items. Leaving out a pair of nodes is exact. A task returns ``k`` rows an item at most.
    Items are taken in chunks of ``chunk`` different terms, each of which is broadcast and searched for by itself.

    A null text has no terms; items and documents without terms give nothing. Null ids come last among
    equal scores. Every row is an item or a document of its own, also where ids repeat. Other columns
    are not read. An empty table on either side gives an empty one.
    """
    items = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    item_id = items.schema["item_id"]
    schema = T.StructType([T.StructField("item", T.LongType()), item_id, docs.schema["doc_id"], T.StructField("score", T.LongType())])
    found, first = None, 0
    for some in chunks(items, chunk):
        part = _search(docs, some, first, item_id, k)
        first += len(some)
        if part is not None:
            part = keep(part, "found")
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


SQL = """
WITH t AS (
    SELECT d, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)
), c AS (
    SELECT d, doc_id, term, count(*) AS tf FROM t GROUP BY ALL
), n AS (
    SELECT d, sum(tf)::BIGINT AS n FROM c GROUP BY d
), s AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n
), w AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM c, s GROUP BY term, docs
), m AS (
    SELECT d, 100 - 75 + (75 * n * docs) // terms AS m FROM n, s
), q AS (
    SELECT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), r AS (
    SELECT i, item_id, c.d, c.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN c USING (term) JOIN w USING (term) JOIN m USING (d) GROUP BY ALL
), o AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM r WHERE score > 0
)
SELECT * FROM o WHERE rank <= 10
"""
