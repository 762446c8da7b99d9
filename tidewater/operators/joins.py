"""Join shapes: facts rolled up before they meet a dimension, and the filtering joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_to(fact: DataFrame, fact_key: str, measures: dict[str, Column], dim: DataFrame, dim_key: str,
              how: str = "inner") -> DataFrame:
    """Aggregate a fact at its foreign key, then join the dimension.

    The partial aggregation runs before the shuffle, so a hot key reaches the join as
    one row and the joined volume is that of the distinct keys, not of the facts.
    """
    rolled = fact.groupBy(F.col(fact_key).alias("_fk")).agg(*(m.alias(n) for n, m in measures.items()))
    return dim.join(rolled, F.col(dim_key) == F.col("_fk"), how).drop("_fk")


def children_counted(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str, name: str) -> DataFrame:
    """Every parent with the number of its children, 0 where it has none."""
    rolled = rollup_to(child, child_key, {name: F.count("*")}, parent, parent_key, "left")
    return rolled.withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` with no partner (NOT EXISTS); a null key never has one."""
    keys = right.select(F.col(right_key).alias("_k")).distinct()
    return left.join(keys, F.col(left_key) == F.col("_k"), "left_anti")


def with_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` with a partner (EXISTS), none repeated."""
    keys = right.select(F.col(right_key).alias("_k")).distinct()
    return left.join(keys, F.col(left_key) == F.col("_k"), "left_semi")


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """SQL ``NOT IN (subquery)`` with its null rules.

    Any null on the right empties the result, a null on the left passes only an empty
    right side. Written as a plain anti join guarded by one row of counts, since the
    null-aware anti join would broadcast the whole right side.
    """
    state = right.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(right_key).isNull()).alias("nulls"))
    ).scalar()
    passes = (state["n"] == 0) | ((state["nulls"] == 0) & F.col(left_key).isNotNull())
    return without_match(left, right, left_key, right_key).filter(passes)


def rows_covering(df: DataFrame, elements: str, sets: Sequence[Sequence]) -> DataFrame:
    """Rows whose array shares an element with every one of the given (literal) sets."""
    condition = F.lit(True)
    for members in sets:
        condition = condition & F.arrays_overlap(F.col(elements), F.array(*(F.lit(m) for m in members)))
    return df.filter(condition)


def keys_covering(rows: DataFrame, row_id: str, element: str, sets: DataFrame, set_id: str, set_element: str) -> DataFrame:
    """The same for sets held in a table: ids of rows that meet every set.

    Both sides are in long form (id, element). Row elements are made distinct first and
    joined on the element, so the work follows the matches; no pair table is built.
    """
    members = sets.select(F.col(set_id).alias("_set"), F.col(set_element).alias("_e")).distinct()
    wanted = sets.agg(F.count_distinct(F.col(set_id))).scalar()
    hits = rows.select(row_id, F.col(element).alias("_e")).distinct().join(members, "_e")
    return (
        hits.select(row_id, "_set").distinct().groupBy(row_id).agg(F.count("*").alias("_met"))
        .filter(F.col("_met") == wanted).select(row_id)
    )


def direct_product(df: DataFrame, vectors: str, alias: str = "combination") -> DataFrame:
    """All combinations of one element from each vector of an array of arrays, row by row.

    Rows are multiplied vector by vector, so no row ever holds a product; the longest array is
    looked up first. An array without vectors has one combination, the empty one.
    """
    longest = df.agg(F.max(F.size(vectors))).first()[0] or 0
    element = df.schema[vectors].dataType.elementType
    rows = df.filter(F.col(vectors).isNotNull()).withColumn(alias, F.array().cast(element))
    for i in range(longest):
        # one step for a row that has no such vector
        vector = F.when(F.size(vectors) > i, F.get(vectors, F.lit(i))).otherwise(F.array(F.lit(None).cast(element.elementType)))
        longer = F.when(F.size(vectors) > i, F.concat(alias, F.array("_element"))).otherwise(F.col(alias))
        rows = rows.withColumn("_element", F.explode(vector)).withColumn(alias, longer).drop("_element")
    return rows


def distance_matrix(left: DataFrame, left_id: str, left_vec: str, right: DataFrame, right_id: str, right_vec: str,
                    tile_rows: int = 512, grid: int = 16) -> DataFrame:
    """Euclidean distance of every left vector to every right vector as (left, right, distance).

    The result has |left| x |right| rows by definition. It is computed as a blocked matrix
    product on a grid: the right side is cut into tiles of about ``tile_rows`` vectors, each a
    member of one of ``grid`` columns; left vectors belong to one of ``grid`` rows. A left vector
    travels once to each column, a tile once to each row, however many tiles there are; they meet
    by an equi-join on the cell. No more than a tile is held at once.
    """
    tile_count = F.greatest(F.ceil(right.select(F.count("*")).scalar() / F.lit(tile_rows)), F.lit(1)).cast("int")
    columns = F.least(F.lit(grid), tile_count)
    tiles = (
        right.select(
            F.pmod(F.xxhash64(right_id), tile_count).cast("int").alias("_tile"),
            F.struct(F.col(right_id).alias("id"), F.col(right_vec).cast("array<double>").alias("v")).alias("_r"),
        )
        .groupBy("_tile").agg(F.collect_list("_r").alias("_block"))
        .select(F.pmod("_tile", columns).alias("_column"), "_block", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_row"))
    )
    rows = grid_cells(left, left_id, left_vec, columns, grid)
    distances = rows.join(tiles, ["_column", "_row"]).select(F.col(left_id), "_v", F.explode("_block").alias("_r"))
    return distances.select(
        F.col(left_id),
        F.col("_r.id").alias(right_id),
        euclidean(F.col("_v"), F.col("_r.v")).alias("distance"),
    )


def grid_cells(left: DataFrame, left_id: str, left_vec: str, columns: Column, grid: int) -> DataFrame:
    """Each left vector once for every column of the grid, in the row its id says."""
    return left.select(
        F.col(left_id),
        F.col(left_vec).cast("array<double>").alias("_v"),
        F.pmod(F.xxhash64(left_id), F.lit(grid)).cast("int").alias("_row"),
        F.explode(F.sequence(F.lit(0), columns - 1)).alias("_column"),
    )


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
