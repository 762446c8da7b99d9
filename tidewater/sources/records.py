"""Delimited files with quoted line breaks, read by byte ranges.

Spark's reader takes such a file in one task, since a range of it can't tell whether it starts inside
quotes. Here every range is read twice. First it tells what it does to either state: where its end
lies if its start is outside quotes, and where if it is inside. Composed in order, these few facts
give the true state at the start of each range. Then every range is cut at true line ends; the
pieces of records that lie across its edges are put together, two for each range at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.sources.files import LOG_OPTIONS, LOG_SCHEMA, fitting_records

#: Ranges that start inside quotes and are told to all tasks; beyond as many they are joined.
TOLD = 100_000

_CLOSED = re.compile(rb'"(?:[^"]++|"")*+"')
_REST = re.compile(rb'(?:[^"]++|"")*+"')


def inside_after(line: bytes, inside: bool) -> bool:
    """Whether the end of a line lies inside quotes.

    A quote opens a field only as its first byte; doubled quotes stay inside; what follows the closing
    quote up to the next comma is outside, whatever it holds.
    """
    at = 0
    if inside:
        closed = _REST.match(line)
        if closed is None:
            return True
        at = line.find(b",", closed.end()) + 1
        if not at:
            return False
    while True:
        if line.startswith(b'"', at):
            closed = _CLOSED.match(line, at)
            if closed is None:
                return True
            at = closed.end()
        at = line.find(b",", at) + 1
        if not at:
            return False


def text_lines(spark: SparkSession, path: str | None = None, stream: bool = False, **options) -> DataFrame:
    """Lines by byte ranges: ``line`` (bytes, without the line feed), ``file`` and ``range`` (where it starts).

    With ``stream`` new files of a folder arrive as a stream, to be handed to :func:`records` batch by batch.
    """
    reader = (spark.readStream if stream else spark.read).options(lineSep="\n", **options)
    return reader.text(path).select(
        F.col("value").cast("binary").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The lines of each range in a batch; lines of one range follow each other."""
    file, start = batch.column("file"), batch.column("range")
    n = batch.num_rows
    if not n:
        return
    same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(start[1:], start[:-1]))
    cuts = [0, *(pc.indices_nonzero(pc.invert(same)).to_numpy() + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield (file[a].as_py(), start[a].as_py()), batch.column("line")[a:b]


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: whether its end is inside quotes if its start is outside, and if it is inside."""
    now, effect = None, (False, True)

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [now[0]], "range": [now[1]], "outside": [effect[0]], "inside": [effect[1]]})

    for batch in batches:
        for key, lines in _runs(batch):
            if key != now:
                if now is not None:
                    yield told()
                now, effect = key, (False, True)
            for line in lines.filter(pc.match_substring(lines, b'"')).to_pylist():
                first = inside_after(line, effect[0])
                effect = first, first if effect[0] == effect[1] else inside_after(line, effect[1])
    if now is not None:
        yield told()


def ranges_inside(lines: DataFrame) -> DataFrame:
    """``file, range`` of the ranges that start inside quotes.

    A range whose two ends agree settles the state, one whose ends differ from its starts turns it: the
    state at a range is that of the last settled one before it, turned as often as ranges did since.
    """
    effects = lines.mapInArrow(_effects, "file string, range long, outside boolean, inside boolean")
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("outside") == F.col("inside")
    turns = F.col("outside") & ~F.col("inside")
    numbered = effects.withColumn("_since", F.coalesce(F.sum(settles.cast("int")).over(earlier), F.lit(0)))
    numbered = numbered.withColumn("_settled", F.last(F.when(settles, F.col("outside")), ignorenulls=True).over(earlier))
    # turns that count: those after the settled range, which itself is no turn
    since = Window.partitionBy("file", "_since").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(turns.cast("int")).over(since), F.lit(0))
    # a settled range opens the next group; its own row still belongs to the group before
    state = (F.coalesce(F.col("_settled").cast("int"), F.lit(0)) + turned) % 2 == 1
    return numbered.withColumn("_state", state).filter("_state").select("file", "range")


def _cut(told: frozenset | None):
    """Cuts the lines of ranges into records; ``told`` names the ranges that start inside quotes, else a column does."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seq, inside, head, open_lines = None, 0, False, False, []
        out: list[tuple[bytes, str | None, int | None, int, str]] = []

        def piece(kind: str) -> None:
            # the file and range are needed to put pieces together only
            nonlocal seq, open_lines
            file, start = now if kind != "whole" else (None, None)
            out.append((b"\n".join(open_lines), file, start, seq, kind))
            seq, open_lines = seq + 1, []

        def flush() -> pa.RecordBatch:
            nonlocal out
            columns = list(zip(*out)) or [()] * 5
            out = []
            types = (pa.binary(), pa.string(), pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["record", "file", "range", "seq", "kind"])

        def leave() -> None:
            if now is not None and (open_lines or head):
                piece("through" if head else "tail")

        for batch in batches:
            at = 0
            for key, lines in _runs(batch):
                if key != now:
                    leave()
                    now, seq = key, 0
                    inside = key in told if told is not None else batch.column("inside")[at].as_py()
                    head = inside
                at += len(lines)
                quoted = pc.match_substring(lines, b'"').to_pylist()
                for line, has_quote in zip(lines.to_pylist(), quoted):
                    open_lines.append(line.removesuffix(b"\r"))
                    if has_quote:
                        inside = inside_after(line, inside)
                    if not inside:
                        piece("head" if head else "whole")
                        head = False
            yield flush()
        leave()
        yield flush()

    return cut


_PIECES = "record binary, file string, range long, seq int, kind string"


def records(lines: DataFrame, told: int = TOLD) -> DataFrame:
    """``value``: the records of quoted delimited files, from :func:`text_lines`; any range may be read by any task.

    Records end at a line feed outside quotes; those inside quotes stay, also across ranges. A carriage
    return before a line feed goes, in quotes too, as Spark's reader drops it in files with such line
    ends. An open quote at the end of a file takes what is left of it. The ranges that start inside
    quotes are found when this is called.
    """
    spark = lines.sparkSession
    inside = ranges_inside(lines)
    few = inside.limit(told + 1).collect()
    if len(few) <= told:
        cut = lines.mapInArrow(_cut(frozenset((r.file, r.range) for r in few)), _PIECES)
    else:
        # a join by shuffle loses the order of lines; it is written down first
        placed = lines.withColumn("_at", F.monotonically_increasing_id())
        marked = placed.join(inside.withColumn("inside", F.lit(True)), ["file", "range"], "left")
        ordered = marked.repartition("file", "range").sortWithinPartitions("file", "range", "_at")
        cut = ordered.select("line", "file", "range", F.coalesce("inside", F.lit(False)).alias("inside")).mapInArrow(_cut(None), _PIECES)
    whole = cut.filter("kind = 'whole'").select("record")
    before = Window.partitionBy("file").orderBy("range", "seq")
    # a tail opens a record, what follows up to the next tail belongs to it
    parts = cut.filter("kind <> 'whole'").withColumn("_open", F.count_if(F.col("kind") == "tail").over(before))
    in_order = F.sort_array(F.collect_list(F.struct("range", "seq", "record")))
    text = F.transform(in_order, lambda p: p["record"].cast("string"))
    joined = parts.groupBy("file", "_open").agg(F.array_join(text, "\n").alias("value"))
    return whole.select(F.col("record").cast("string").alias("value")).unionByName(joined.select("value"))


def read_log_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``read_log``, in any order, with large files read by many tasks."""
    return parse_records(records(text_lines(spark, path)))


def parse_records(found: DataFrame) -> DataFrame:
    """Log rows from the ``value`` of :func:`records`, by the rules of ``read_log``."""
    written = found.filter(F.trim(F.regexp_replace("value", "[\r\n]", "")) != "")
    return fitting_records(written.select(F.from_csv("value", LOG_SCHEMA, LOG_OPTIONS).alias("_l")).select("_l.*"))
