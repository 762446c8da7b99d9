"""How the sources of a language differ in their words, counted through a minimal acyclic transducer."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import keep, lower_ascii
from tidewater.llm.transducer import Transducer, bytes_of, words_of

#: What parts terms, besides the ends of a text.
PARTS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP = 50
#: Terms of one transducer; bytes of transducers that are broadcast at once.
BLOCK = 1 << 16
BROADCAST = 128 << 20
#: Counts a task holds before it passes them on.
HELD = 1 << 20
#: Sources and terms of one tile of the pairwise differences.
TILE, TERMS = 64, 4096


def kept_terms(texts: DataFrame, least: int) -> DataFrame:
    """``key, lang, term, ordinal``: the terms in at least ``least`` documents of their language, numbered in order.

    The key is the language, a zero byte and the term; a term holds no zero byte, so keys are distinct
    and those of one language sort as its terms do.
    """
    terms = F.explode(F.array_distinct(F.split(lower_ascii(F.col("text")), PARTS)))
    held = texts.select("lang", terms.alias("term")).where("term <> ''").groupBy("lang", "term").agg(F.count("*").alias("n"))
    zero = F.lit(b"\0")
    key = F.concat(F.col("lang").cast("binary"), zero, F.col("term").cast("binary"))
    named = held.where(F.col("n") >= least).select("lang", "term", key.alias("key"))
    # ranges are found by a short beginning of the keys, as Spark samples what it ranges by
    ordered = named.repartitionByRange(F.substring("key", 1, 48)).sortWithinPartitions("key")
    placed = keep(ordered.withColumn("place", F.monotonically_increasing_id()), "terms")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return keep(
        placed.withColumn("part", part).join(starts, "part").select("key", "lang", "term", (F.col("start") + within).alias("ordinal")),
        "vocabulary",
    )


def transducers(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """``block, first, automaton``: a pickled :class:`Transducer` for each run of ``block`` terms."""

    def build(terms: pd.DataFrame) -> pd.DataFrame:
        terms = terms.sort_values("ordinal")
        automaton = pickle.dumps(Transducer(bytes(k) for k in terms["key"]))
        return pd.DataFrame({"block": [terms["block"].iloc[0]], "first": [terms["ordinal"].iloc[0]], "automaton": [automaton]})

    blocks = vocabulary.select("key", "ordinal", F.floor(F.col("ordinal") / block).alias("block"))
    return keep(blocks.groupBy("block").applyInPandas(build, "block long, first long, automaton binary"), "transducers")


class _Counts:
    """Occurrences by (group, ordinal); groups are numbered as they come."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, groups: np.ndarray, ordinals: np.ndarray) -> None:
        keys, counts = np.unique(groups << 40 | ordinals, return_counts=True)
        both = np.concatenate([self.keys, keys])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], np.concatenate([self.counts, counts])[order]
        new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
        self.keys, self.counts = both[new], np.add.reduceat(counts, new) if len(new) else counts

    def rows(self) -> pa.RecordBatch:
        names = list(self.groups)
        group = self.keys >> 40
        columns = [pa.array([n[k] for n in names], pa.string()).take(pa.array(group)) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(self.keys & ((1 << 40) - 1)), pa.array(self.counts)], ["lang", "source", "ordinal", "n"]
        )


def recount(texts: DataFrame, automata: list[tuple[int, bytes]]) -> DataFrame:
    """``lang, source, ordinal, n``: partial counts of the kept terms, from streaming ``texts`` through the automata."""
    shared = texts.sparkSession.sparkContext.broadcast(automata)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = [(first, pickle.loads(automaton)) for first, automaton in shared.value]
        entries: dict[tuple[int, str], tuple[int, int]] = {}
        held = _Counts()
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            group = np.array([held.groups.setdefault(g, len(held.groups)) for g in zip(langs, sources)], dtype=np.int64)
            data, offsets = bytes_of(batch.column("text"))
            names, code = np.unique(np.array(langs, dtype=object), return_inverse=True)
            for letters, starts, lengths, of in words_of(data, offsets):
                for k, (first, machine) in enumerate(machines):
                    begin = [entries.get((k, x)) or entries.setdefault((k, x), machine.step(x.encode() + b"\0")) for x in names]
                    state, ordinal = (np.array(c, dtype=np.int64)[code[of]] for c in zip(*begin))
                    found = machine.walk(letters, starts, lengths, state, ordinal)
                    hit = np.flatnonzero(found >= 0)
                    held.add(group[of[hit]], found[hit] + first)
            if len(held.keys) + len(held.groups) > HELD:
                yield held.rows()
                held = _Counts()
        yield held.rows()

    return texts.select("lang", "source", "text").mapInArrow(stream, "lang string, source string, ordinal long, n long")


def counts(texts: DataFrame, vocabulary: DataFrame, block: int = BLOCK, most: int = BROADCAST) -> DataFrame:
    """``lang, source, ordinal, n`` for every kept term that occurs in a source of its language.

    Transducers are broadcast as long as they take no more than ``most`` bytes and one of them together;
    a larger vocabulary is counted in as many passes over the texts as it has parts of that size.
    """
    built = transducers(vocabulary, block)
    sizes = Window.orderBy("block")
    turns = built.select("block", (F.sum(F.octet_length("automaton")).over(sizes) / most).cast("long").alias("turn"))
    parts = []
    for turn in turns.groupBy("turn").agg(F.min("block").alias("a"), F.max("block").alias("b")).orderBy("turn").collect():
        of_turn = built.where(F.col("block").between(turn.a, turn.b)).orderBy("block").collect()
        found = recount(texts, [(r["first"], bytes(r.automaton)) for r in of_turn])
        parts.append(keep(found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "counts"))
    if not parts:
        return texts.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _rate(n: Column | str, total: str, smoothing: int) -> Column:
    """1 + floor(SCALE * (n + smoothing) / (total + smoothing * terms)), exactly; null where no term is kept."""
    return F.expr(f"if(terms > 0, 1 + cast({SCALE} as decimal(20,0)) * ({n} + {smoothing}) div ({total} + {smoothing} * terms), null)")


def _excess(entries: DataFrame, sources: DataFrame) -> DataFrame:
    """``lang, a, b, excess`` for sources a < b: what the terms that occur add to the difference of two sources.

    Sources are dealt to tiles of TILE, terms to runs of TERMS; a group of the grid is one dense block.
    The excess of a term is the difference of the rates less that of two sources without the term. A
    run has a row of each source, with no term, so sources that hold none of its terms are there too.
    """

    def differ(rows: pd.DataFrame) -> pd.DataFrame:
        names, of = np.unique(rows["place"].to_numpy(), return_inverse=True)
        base = np.zeros(len(names), dtype=np.int64)
        base[of] = rows["base"]
        terms, at = np.unique(rows["ordinal"].to_numpy(), return_inverse=True)
        rates = np.repeat(base[:, None], len(terms), axis=1)
        rates[of, at] = rows["rate"]
        first, second = rows["tile_a"].iloc[0], rows["tile_b"].iloc[0]
        found = []
        for i in np.flatnonzero(names // TILE == first):
            others = np.flatnonzero((names // TILE == second) & (names > names[i]))
            gap = np.abs(rates[others] - rates[i]).sum(axis=1) - len(terms) * np.abs(base[others] - base[i])
            found.append(pd.DataFrame({"a": names[i], "b": names[others], "excess": gap}))
        out = pd.concat(found) if found else pd.DataFrame({"a": [], "b": [], "excess": []})
        out.insert(0, "lang", rows["lang"].iloc[0])
        return out

    own = F.floor(F.col("place") / TILE)
    tiles = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / TILE).cast("int")))
    runs = entries.withColumn("run", F.floor(F.col("ordinal") / TERMS)).select("lang", "run", "place", "sources", "base", "ordinal", "rate")
    each = runs.select("lang", "run").distinct().join(sources.select("lang", "place", "sources", "base"), "lang")
    runs = runs.unionByName(each.withColumn("ordinal", F.lit(-1)).withColumn("rate", F.col("base")))
    dealt = (
        runs.withColumn("tile", own.cast("int")).withColumn("other", tiles)
        .withColumn("tile_a", F.least("tile", "other")).withColumn("tile_b", F.greatest("tile", "other"))
        .select("lang", "tile_a", "tile_b", "run", "place", "ordinal", "rate", "base")
    )
    partial = dealt.groupBy("lang", "tile_a", "tile_b", "run").applyInPandas(differ, "lang string, a int, b int, excess long")
    return partial.groupBy("lang", "a", "b").agg(F.sum("excess").alias("excess"))


def divergence(
    docs: DataFrame,
    least: int = LEAST_DOCS,
    smoothing: int = SMOOTHING,
    top: int = TOP,
    block: int = BLOCK,
    most: int = BROADCAST,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far sources lie apart, and the terms that set one off.

    A language keeps the terms in at least ``least`` of its documents. A source's rate of a term is
    1 + floor(10^9 (n + smoothing) / (N + smoothing * V)) with n its occurrences there, N those of all
    kept terms, V their number. Part ``pair`` has every other source of the language with the sum of
    the differences of rates over all kept terms; part ``term`` the ``top`` terms that occur in the
    source at a higher rate than in the language. Ranks are by value, largest first, then item.

    Kept terms are sorted and numbered, built into minimal acyclic transducers of ``block`` terms, and
    the texts are streamed through them to be counted by ordinal; equal values of terms are ranked by
    ordinal, which is their order. All arithmetic is in integers.

    A null text, language or source counts as empty. A source without kept terms has rates of its
    own (n = 0). A language without kept terms gives pairs of value 0. Repeated rows count as often as
    they come. Other columns are not read. An empty table gives an empty one.
    """
    names = {"lang": lang_col, "source": source_col, "text": text_col}
    texts = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for n, c in names.items()])
    vocabulary = kept_terms(texts, least)
    found = counts(texts, vocabulary, block, most)

    # one row per source of a language, and per language
    terms = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"))
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang")
    sources = keep(
        texts.groupBy("lang", "source").agg(F.count("*").alias("rows")).drop("rows")
        .join(sums, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["total", "terms"])
        .withColumn("place", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("int"))
        .withColumn("sources", F.count("*").over(by_lang).cast("int"))
        .withColumn("lang_total", F.sum("total").over(by_lang))
        .withColumn("base", _rate("0", "total", smoothing)),
        "sources",
    )
    entries = found.join(sources, ["lang", "source"]).withColumn("rate", _rate("n", "total", smoothing))

    of_term = Window.partitionBy("lang", "ordinal")
    higher = (
        entries.withColumn("lang_n", F.sum("n").over(of_term))
        .withColumn("value", F.col("rate") - _rate("lang_n", "lang_total", smoothing))
        .where("value > 0")
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = higher.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    best = best.select("source", "ordinal", "value", "rank").join(vocabulary.select("ordinal", "lang", "term"), "ordinal")
    best = best.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    gaps = keep(_excess(entries, sources), "differences")
    gaps = gaps.unionByName(gaps.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "excess"))
    one = sources.select("lang", "source", F.col("place").alias("a"), "terms", "base")
    other = sources.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("base").alias("other_base"))
    value = F.when(F.col("terms") > 0, F.coalesce("excess", F.lit(0)) + F.col("terms") * F.abs(F.col("base") - F.col("other_base")))
    pairs = one.join(other, "lang").where("a <> b").join(gaps, ["lang", "a", "b"], "left").withColumn("value", F.coalesce(value, F.lit(0)))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))
    return pairs.unionByName(best)


SQL = """
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), w AS (
    SELECT doc, lang, source, unnest(words) AS term FROM d
), k AS (
    SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), v AS (
    SELECT lang, count(*) AS v FROM k GROUP BY lang
), g AS (
    SELECT DISTINCT lang, source FROM d
), c AS (
    SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL
), f AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, v.v,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang) AS lang_total,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, k.term) AS lang_n
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * v)::HUGEINT AS p,
           1 + (1000000000 * (lang_n + 5)::HUGEINT) // (lang_total + 5 * v)::HUGEINT AS q
    FROM f
), s AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
