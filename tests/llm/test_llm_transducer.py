"""The transducer against a dictionary, and the audit of sources on small tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import source_divergence
from tidewater.llm.transducer import Transducer, words_of

SCHEMA = "doc_id long, text string, lang string, source string"


def ordinal(machine, key):
    data = np.frombuffer(key, dtype=np.uint8)
    one = np.zeros(1, dtype=np.int64)
    return int(machine.walk(data, one, np.array([len(key)]), np.array([machine.root]), one)[0])


def suffix_languages(keys):
    """The number of different sets of endings: the states of the smallest automaton."""
    prefixes = {k[:i] for k in keys for i in range(len(k) + 1)}
    return len({frozenset(k[len(p) :] for k in keys if k.startswith(p)) for p in prefixes})


@pytest.mark.parametrize("seed", range(6))
def test_ordinals_and_states(seed):
    rng = random.Random(seed)
    letters = [b"ab", b"abc\xc3\xa9", bytes(range(1, 256))][seed % 3]
    keys = sorted({bytes(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(300)})
    machine = Transducer(keys)
    assert [ordinal(machine, k) for k in keys] == list(range(len(keys)))
    others = {bytes(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(300)} - set(keys)
    assert {ordinal(machine, k) for k in others} == {-1}
    assert len(machine.final) == suffix_languages(keys)


def test_keys_must_be_sorted():
    with pytest.raises(ValueError):
        Transducer([b"b", b"a"])
    with pytest.raises(ValueError):
        Transducer([b"a", b"a"])
    assert ordinal(Transducer([]), b"a") == -1


@pytest.mark.parametrize("piece", [1, 3, 7, 64, 1 << 20])
def test_words_in_stretches(piece):
    texts = ["One two", "", "three", "é𝄞x-Y", "", "averylongwordwithoutanybreak" * 9, " ", "end"]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    got = []
    for letters, starts, lengths, of in words_of(np.frombuffer(b"".join(data), dtype=np.uint8), offsets, piece):
        got += [(int(k), bytes(letters[s : s + n])) for s, n, k in zip(starts, lengths, of)]
    want = [(k, w.lower()) for k, d in enumerate(data) for w in re.findall(rb"[A-Za-z\x80-\xff]+", d)]
    assert got == want


def test_rows_without_text_lang_or_source(spark):
    rows = [(1, "red red blue", "en", "a"), (2, "RED blue", "en", "b"), (2, "RED blue", "en", "b"), (3, None, "en", None), (None, "red", "en", "b"),
            (4, "solo", "de", "x"), (5, "", "de", "y"), (6, "über", None, None), (7, "über", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit("clash")).withColumn("n", F.lit(9)).withColumn("ordinal", F.lit(1))
    got = {(r.lang, r.source, r.part, r.item): (r.value, r["rank"]) for r in source_divergence.divergence(docs, least=2, block=1, most=1).collect()}

    def rate(n, total, terms):
        return 1 + 10**9 * (n + 5) // (total + 5 * terms)

    # en keeps red (2, 3, 0 times in a, b and the empty source) and blue (1, 2, 0); de keeps nothing
    red = {s: rate(n, t, 2) for s, n, t in (("a", 2, 3), ("b", 3, 5), ("", 0, 0))}
    blue = {s: rate(n, t, 2) for s, n, t in (("a", 1, 3), ("b", 2, 5), ("", 0, 0))}
    for one in red:
        gaps = sorted((-(abs(red[one] - red[o]) + abs(blue[one] - blue[o])), o) for o in red if o != one)
        for k, (gap, o) in enumerate(gaps):
            assert got.pop(("en", one, "pair", o)) == (-gap, k + 1)
    whole = rate(5, 8, 2), rate(3, 8, 2)
    for s in ("a", "b"):
        for term, here, lang in (("red", red[s], whole[0]), ("blue", blue[s], whole[1])):
            if here > lang:
                assert got.pop(("en", s, "term", term)) == (here - lang, 1)
    assert got.pop(("de", "x", "pair", "y")) == (0, 1) and got.pop(("de", "y", "pair", "x")) == (0, 1)
    # the language without a name has one source: no pairs, and no rate above its own
    assert got == {}


def test_ties_and_tops(spark):
    """Equal values are ranked by term in the order of bytes; ranks end at ``top``, many tiles and blocks change nothing."""
    words = ["zeta", "Alpha", "beta", "ärger", "éclair", "日本", "omega"]
    rows = [(k, " ".join(words), "en", "a") for k in range(3)] + [(9, "filler " * 4, "en", f"s{k:03}") for k in range(130)]
    found = source_divergence.divergence(spark.createDataFrame(rows, SCHEMA), least=2, top=5, block=2, most=1)
    terms = [(r["rank"], r.item) for r in found.where("part = 'term' and source = 'a'").collect()]
    want = sorted((w.lower().encode() for w in words))[:5]
    assert [t.encode() for _, t in sorted(terms)] == want
    pairs = found.where("part = 'pair'")
    assert pairs.count() == 131 * 130
    alike = pairs.where("source = 's000' and item <> 'a'").orderBy("rank").collect()
    assert [r.item for r in alike] == [f"s{k:03}" for k in range(1, 130)] and {r.value for r in alike} == {0}
    assert pairs.where("source = 'a'").select("value").distinct().count() == 1


def test_empty_and_long(spark):
    empty = source_divergence.divergence(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["lang", "source", "part", "item", "value", "rank"] and empty.count() == 0
    long = "x" * 50_000
    rows = [(k, f"{long} y {'w ' * 100_000}", "en", "ab"[k % 2]) for k in range(4)]
    got = source_divergence.divergence(spark.createDataFrame(rows, SCHEMA), least=4).collect()
    assert [r.value for r in got if r.part == "pair"] == [0] * 2
    terms = [(r["rank"], r.item) for r in got if r.part == "term" and r.source == "a"]
    assert sorted(terms) == [(1, long), (2, "y")]
