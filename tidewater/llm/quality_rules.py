"""Quality rules whose cutoffs are chosen by exact binomial tests on labelled documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE, WORD, keep, words

MIN_WORDS = 50
#: Fixed grids: a text fails a rule if its rate is above the cutoff. They do not depend on the data,
#: so every labelled document counts as held out.
GRIDS = {
    "symbol_rate": (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3),
    "repeat_rate": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45),
    "dup_line_rate": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8),
    "mark_rate": (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3),
    "upper_rate": (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8),
}
#: At most this share of a stratum's good documents may be rejected by all rules together ...
FALSE_REJECTION = 0.05
#: ... except with this probability, over all strata, rules and cutoffs that are tried.
ERROR = 0.05
#: A good document that is rejected costs as much as so many bad ones that are kept.
PRICE = 5
#: Terms of a binomial tail that are added one by one; a bound stands for those below.
TERMS = 10_000


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as a struct ``row`` plus the counts of each whole text (null: no words).

    A window of three words is found by sorting (33 bits of its hash, position) as one number; the
    few that share the bits are then compared as texts, so the count is exact.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = docs.select(F.struct("*").alias("row"), text.alias("t")).withColumn("w", words(F.col("t")))
    squeezed = reduce(lambda c, gap: F.replace(c, F.lit(gap), F.lit("")), " \t\n\x0b\x0c\r", F.col("t"))
    df = (
        df.withColumn("n_words", F.size("w").cast("long"))
        .withColumn("word_chars", F.length(squeezed).cast("long"))
        .withColumn("n_symbols", F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("n_marks", F.regexp_count("t", F.lit("!")).cast("long"))
        .withColumn("n_upper", F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long"))
        .withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)))
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .drop("lines", "t")
    )

    def pairs(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))

    high = F.lit(-(1 << 31))  # the bits above a position
    hashed = df.withColumn("h", pairs(F.col("w"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1)))))
    # the second hash is of words i+1 and i+2, so a pair of neighbours stands for the window
    hashed = hashed.withColumn("h", pairs(F.slice("h", 1, F.greatest(F.size("w") - 2, F.lit(0))), F.slice("h", 2, F.greatest(F.size("w") - 2, F.lit(0)))))
    packed = F.transform("h", lambda x, i: F.coalesce(x.bitwiseAND(high), F.lit(0).cast("long")).bitwiseOR(i.cast("long")))
    hashed = hashed.withColumn("s", F.sort_array(packed))
    n = F.size("s")

    def like(x: Column, i: Column, step: int) -> Column:
        inside = (i > 0) if step < 0 else (i < n - 1)
        return inside & (F.get("s", i + step).bitwiseAND(high) == x.bitwiseAND(high))

    alike = F.filter("s", lambda x, i: like(x, i, -1) | like(x, i, 1))
    hashed = hashed.withColumn("p", F.transform(alike, lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")))
    window = F.transform("p", lambda p: F.struct(F.concat_ws(" ", F.get("w", p), F.get("w", p + 1), F.get("w", p + 2)).alias("k"), p.alias("p")))
    hashed = hashed.withColumn("k", F.sort_array(window))
    m = F.size("k")
    same = F.filter(
        "k",
        lambda x, i: ((i > 0) & (F.get("k", i - 1)["k"] == x["k"])) | ((i < m - 1) & (F.get("k", i + 1)["k"] == x["k"])),
    )
    covered = F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))))
    return hashed.withColumn("n_repeat_words", F.size(covered).cast("long")).drop("w", "h", "s", "p", "k")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rates() -> dict[str, Column]:
    def per(count: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(count) / F.col(whole)).otherwise(0.0)

    return {
        "symbol_rate": per("n_symbols", "word_chars"),
        "repeat_rate": per("n_repeat_words", "n_words"),
        "dup_line_rate": per("n_dup_lines", "n_lines"),
        "mark_rate": per("n_marks", "word_chars"),
        "upper_rate": per("n_upper", "word_chars"),
    }


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series above 20."""
    x = n.cast("double") + 1
    series = (x - 0.5) * F.log(x) - x + F.lit(0.9189385332046727) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")))).otherwise(series)


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Bin(n, rate) where k lies below the mean, 1 elsewhere.

    The terms fall from k downwards faster than a geometric series, which bounds those that are not
    added; so the value is never too small.
    """
    odds = rate / (1 - rate)
    top = F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate)))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i + 1) / ((n - k + i) * odds)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), F.least(k, F.lit(TERMS)))).otherwise(F.array().cast("array<bigint>"))
    summed = F.aggregate(steps, start, add)
    left = F.when(k > TERMS, summed["term"] / (1 - k / ((n - k + 1) * odds))).otherwise(0.0)
    return F.when(k < n * rate, F.least(F.lit(1.0), top * (summed["total"] + left))).otherwise(1.0)


def cutoffs(rated: DataFrame, limit: float = FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """A row per stratum: ``stratum`` and a cutoff for each rule, null where none is safe.

    ``rated`` has ``stratum, good`` (the label) and the rates of labelled documents that pass the
    base rules. Each rule gets an equal part of the limit. A cutoff is safe if the exact binomial
    test rejects, at the error divided by the number of all tests made, that it fails more than that
    part of the stratum's good documents. Of the safe ones the rule takes that which fails most bad
    documents, less PRICE for each good one, the highest of those; none if the price is higher than
    the gain. So nothing is rejected without need.
    """
    part = limit / len(GRIDS)
    tried = [(rule, cut) for rule, grid in GRIDS.items() for cut in grid]
    sums = [
        F.count(F.when((F.col("good") == good) & (F.col(rule) > cut), 1)).alias(f"{rule}_{i}_{good}")
        for i, (rule, cut) in enumerate(tried)
        for good in (1, 0)
    ]
    counted = rated.groupBy("stratum").agg(F.count(F.when(F.col("good") == 1, 1)).alias("n"), *sums)
    entries = [
        F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cut"), F.col(f"{rule}_{i}_1").alias("k"), F.col(f"{rule}_{i}_0").alias("caught"))
        for i, (rule, cut) in enumerate(tried)
    ]
    # a row per stratum is left here, so counting them is one short pass
    tests = F.count("*").over(Window.partitionBy()) * len(tried)
    tested = counted.select("stratum", "n", tests.alias("tests"), F.explode(F.array(*entries)).alias("e")).select("stratum", "n", "tests", "e.*")
    tested = tested.withColumn("gain", F.col("caught") - PRICE * F.col("k"))
    safe = tested.where((F.col("gain") > 0) & (binomial_tail(F.col("n"), F.col("k"), part) * F.col("tests") <= error))

    def best(rule: str) -> Column:
        own = F.col("rule") == rule
        return F.max_by(F.when(own, F.col("cut")), F.when(own, F.struct("gain", "cut"))).alias(f"cut_{rule}")

    return safe.groupBy("stratum").agg(*[best(rule) for rule in GRIDS])


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", whole: bool = False
) -> DataFrame:
    """``id, stratum``, the counts, ``base_failed`` and ``kept``; the row itself as a struct ``row`` if ``whole``.

    ``labels`` has ``doc_id, quality``; a document labelled twice is good only if all say so, null
    labels and ids don't count. A null stratum is one of its own; a stratum without enough good
    labelled documents gets no cutoffs and is judged by the base rules alone. Null and empty texts
    fail the base rules. Repeated rows are judged alike. Other columns are read for ``row`` alone. An
    empty table gives an empty one. Counts are taken once and written to the shared folder; labels
    and documents meet by id, with the counts only.
    """
    row_id, stratum = F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{stratum_col}`").alias("stratum")
    counted = features(docs, text_col).withColumn("base_failed", base_failed()).select(row_id, stratum, "*")
    counted = keep(counted if whole else counted.drop("row"), "features")
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    rated = counted.where("not base_failed").select("id", "stratum", *[c.alias(n) for n, c in rates().items()])
    chosen = keep(cutoffs(rated.join(marked, rated["id"] == marked["doc_id"])), "cutoffs").withColumnRenamed("stratum", "of")
    judged = counted.join(chosen, F.col("stratum").eqNullSafe(F.col("of")), "left")
    fails = reduce(lambda a, b: a | b, [F.coalesce(rate > F.col(f"cut_{rule}"), F.lit(False)) for rule, rate in rates().items()])
    return judged.withColumn("kept", ~F.col("base_failed") & ~fails).drop("of", *[f"cut_{rule}" for rule in GRIDS])


def passing(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns as they are."""
    return judge(docs, labels, whole=True, **options).where("kept").select("row.*")


_RATES = {
    "symbol_rate": "n_symbols / word_chars",
    "repeat_rate": "n_repeat_words / n_words",
    "dup_line_rate": "n_dup_lines / n_lines",
    "mark_rate": "n_marks / word_chars",
    "upper_rate": "n_upper / word_chars",
}
_GRID = ", ".join(f"('{rule}', {cut}::DOUBLE)" for rule, grid in GRIDS.items() for cut in grid)
_TESTS = sum(map(len, GRIDS.values()))
_PART = FALSE_REJECTION / len(GRIDS)
SQL = f"""
WITH d AS (
    SELECT doc_id, lang, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS w FROM documents
), l AS (
    SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d
), g AS (
    SELECT doc_id, n, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g, i
    FROM (SELECT row_number() OVER () AS n, doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM l)
), r AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
          FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS same FROM g) WHERE same > 1) GROUP BY doc_id
), c AS (
    SELECT l.doc_id, lang, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
           len(regexp_extract_all(t, '!')) AS n_marks, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper
    FROM l LEFT JOIN r USING (doc_id)
), b AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
), m AS (
    SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), e AS (
    SELECT doc_id, lang, rule, rate FROM (
        {" UNION ALL ".join(f"SELECT doc_id, lang, '{rule}' AS rule, coalesce({rate}, 0) AS rate FROM b WHERE NOT base_failed" for rule, rate in _RATES.items())})
), v AS (
    SELECT lang, rule, cut, count(*) FILTER (good = 1) AS n, count(*) FILTER (good = 1 AND rate > cut) AS k,
           count(*) FILTER (good = 0 AND rate > cut) AS caught
    FROM e JOIN m USING (doc_id) JOIN (VALUES {_GRID}) AS grid(rule, cut) USING (rule) GROUP BY ALL
), q AS (
    SELECT v.*, (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({_PART}::DOUBLE) + (n - j) * ln(1 - {_PART}::DOUBLE)))
                 FROM unnest(range(0, k + 1)) AS z(j)) AS tail
    FROM v WHERE k < n * {_PART}
), s AS (
    SELECT lang, rule, arg_max(cut, (caught - {PRICE} * k, cut)) AS cut FROM q
    WHERE caught > {PRICE} * k AND tail * {_TESTS} * (SELECT count(DISTINCT coalesce(lang, chr(0))) FROM v) <= {ERROR} GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM e JOIN s ON e.rule = s.rule AND e.lang IS NOT DISTINCT FROM s.lang
                                       WHERE e.doc_id = b.doc_id AND rate > cut) AS kept
FROM b
"""
