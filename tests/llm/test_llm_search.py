"""The dual-tree search against scores of all pairs, on small tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import lexical_search
from tidewater.llm.lexical_search import Best, Nodes, doc_levels, item_levels, similar_first, traverse

ITEM, DOC = "item_id long, text string", "doc_id long, text string"


def brute(items, docs, k=10):
    """[(item_id, rank, doc_id, score)] from the scores of all pairs."""
    terms = lambda text: re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 75 + 75 * c.total() * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def found(spark, items, docs, **options):
    df = lexical_search.search(spark.createDataFrame(items, ITEM), spark.createDataFrame(docs, DOC), **options)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def test_random_texts(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["É", "日本", "x-y", "7"]
    odds = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, " ".join(rng.choices(words, odds, k=rng.randint(0, 40)))) for k in range(700)]
    docs += [(k + 1000, docs[3][1]) for k in range(40)]  # equal scores
    rng.shuffle(docs)
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(90)]
    want = brute(items, docs)
    assert found(spark, items, docs) == want
    assert found(spark, items, docs, chunk=20) == want


def test_odd_rows(spark):
    docs = [(1, "Red red BLUE"), (2, "red blue blue"), (2, "red blue blue"), (None, "red red blue"), (3, None), (4, ""), (5, " .,! "), (6, "green " * 100_000),
            (7, "x" * 2_000_000 + " blue"), (8, "red\u2003blue")]
    items = [(1, "red"), (1, "red"), (None, "blue RED red"), (2, None), (3, ""), (4, "absent"), (5, "red\u2003blue green"), (6, "green")]
    assert found(spark, items, docs) == brute(items, docs)
    assert found(spark, items, docs, k=2) == brute(items, docs, 2)


def test_empty_sides_and_other_columns(spark):
    some = spark.createDataFrame([(1, "red")], DOC)
    none = some.where("false")
    named = some.withColumnRenamed("doc_id", "item_id")
    for items, docs in ((named, none), (named.where("false"), some), (named, spark.createDataFrame([(1, None)], DOC))):
        assert lexical_search.search(items, docs).count() == 0
    clash = {c: F.lit(1) for c in ("item", "rank", "score", "n", "terms", "term", "times", "m")}
    rows = lexical_search.search(named.withColumns(clash), some.withColumns(clash)).collect()
    assert [tuple(r)[:3] for r in rows] == [(1, 1, 1)]


def matrix(rows):
    starts = np.cumsum([0, *[len(r) for r in rows]])
    terms = np.array([t for r in rows for t in sorted(r)], dtype=np.int64)
    return Nodes(starts, terms, np.array([r[t] for r in rows for t in sorted(r)], dtype=np.int64))


@pytest.mark.parametrize("n_items", [1, 5, 64])
def test_bounds_prune_and_lose_nothing(n_items):
    """Documents of many topics: most are never scored, and the best are those of all pairs."""
    rng = random.Random(n_items)
    topics = 80
    rows = []
    for k in range(6000):
        topic = rng.randrange(topics)
        rows.append({topic * 5 + t: rng.randint(1, 9) for t in rng.sample(range(5), 3)} | {400: rng.randint(1, 3)})
    weights = np.zeros((n_items, 401), dtype=np.int64)
    for k in range(n_items):
        weights[k, (k % topics) * 5 : (k % topics) * 5 + 5] = rng.randint(5, 90)
        weights[k, 400] = 1
    docs = matrix(rows)
    order = similar_first(docs, weights.max(axis=0))
    docs, ids = docs.take(order), pa.array(order)
    best = [Best(10, pa.int64()) for _ in range(n_items)]
    scored = traverse(item_levels(weights), doc_levels(docs, 401), docs, ids, best)
    for k in range(n_items):
        scores = docs.products(weights[k])
        want = sorted((-int(s), int(i)) for s, i in zip(scores, order))[:10]
        assert [(-int(s), i) for s, i in zip(best[k].scores, best[k].ids.to_pylist())] == want
    assert scored < 0.1 * n_items * len(rows)
    # a batch without a better document is left at the roots
    assert traverse(item_levels(weights), doc_levels(matrix([{400: 1}] * 500), 401), matrix([{400: 1}] * 500), pa.array(range(500)), best) == 0
