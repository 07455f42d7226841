"""Line dedup: distributed prefix doubling over line-id sequences.

A suffix is the rest of a document from one of its lines on.  Its name at
level k is the place of the earliest suffix that begins with the same 2^k
lines, so names are exact at any size, equal names are an interval of the
suffix array whose common prefix is at least 2^k lines, and a name other than
the suffix's own place tells where the first copy is.  Level k+1 groups
suffixes by the pair (own name, name of the suffix 2^k lines on); suffixes
that are alone in their group leave.  Deleted are the lines that windows with an
earlier copy cover; two neighbours are in one run if such a window covers both.
Doubled to the end, the widest windows at each line add up to the longest copies.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import col, drop_staged, fresh, join_listed, stage_table, text_hash


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(docs: DataFrame, doc_id: str, text: str, gapless: bool = False) -> DataFrame:
    """``(doc_id, th, line, seq, place, c1, c2)``: the non-blank lines of every distinct row.

    ``line`` is the number of the line, ``seq`` its rank among the document's
    non-blank lines, ``place`` a number that orders all lines by document id,
    text hash and line.  c1 and c2 identify the line's text (120 bits).  A line
    of spaces only is blank; one of tabs is not.  With ``gapless`` the places of
    one document's lines follow each other without gaps.
    """
    lines = docs.select(
        col(doc_id).alias("doc_id"),
        text_hash(col(text)).alias("th"),
        F.posexplode(F.filter(F.transform(split_lines(col(text)), lambda x, i: F.struct(i.alias("line"), x.alias("x"))), lambda s: F.trim(s["x"]) != "")).alias("seq", "s"),
    )
    digest = F.md5(F.col("s.x").cast("binary"))
    half = lambda a: F.conv(F.substring(digest, a, 15), 16, 10).cast("long")  # noqa: E731  60 bits each
    lines = lines.select("doc_id", "th", F.col("s.line").alias("line"), "seq", half(1).alias("c1"), half(17).alias("c2"))
    order = ["doc_id", "th", "seq"]
    ranged = lines.dropDuplicates(order).repartitionByRange(*order[: 2 if gapless else 3]).sortWithinPartitions(*order)
    return stage_table(ranged.withColumn("place", F.monotonically_increasing_id()), "lines")


def _name(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """Names of the suffixes that share ``by`` with another one, staged; the others leave."""
    groups = rows.groupBy(*by).agg(F.min("place").alias("name"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    # Staged, so that the join is not tied to the grouping's partitions: a hot group's rows can be split.
    groups = stage_table(groups, "groups")
    named = stage_table(rows.join(groups, by).drop(*by), label)
    drop_staged(groups)
    return named


def _pairs(named: DataFrame, step: int) -> DataFrame:
    """``named`` with ``head``, the own name, and ``next``, that of the suffix ``step`` lines on, where there is one."""
    ahead = Window.partitionBy("doc_id", "th").orderBy("seq").rangeBetween(step, step)  # one document's lines
    return named.withColumn("next", F.max("name").over(ahead)).where("next is not null").withColumnRenamed("name", "head")


@dataclass
class Repeats:
    """``lines``: all lines; ``levels``: per level k (name, place, doc_id, th, seq) of the suffixes
    whose first 2^k lines begin another suffix too, with the earliest one's place."""

    lines: DataFrame
    levels: list[DataFrame]

    @property
    def intervals(self) -> DataFrame:
        """All levels, with their number in ``level``."""
        out = self.levels[0].withColumn("level", F.lit(0))
        for k, named in enumerate(self.levels[1:], 1):
            out = out.unionByName(named.withColumn("level", F.lit(k)))
        return out

    def drop(self) -> None:
        """Delete the tables; nothing may read them after that."""
        drop_staged(self.lines, *self.levels)


def prefix_doubling(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", levels: int = 40, gapless: bool = False) -> Repeats:
    """Name all suffixes, level by level, until none shares its prefix with another (or ``levels`` are done)."""
    lines = line_table(docs, doc_id, text, gapless)
    tables = [_name(lines.select("doc_id", "th", "seq", "place", "c1", "c2"), ["c1", "c2"], "names-0")]
    while len(tables) <= levels and tables[-1].limit(1).count():
        level = len(tables)
        tables.append(_name(_pairs(tables[-1], 1 << (level - 1)), ["head", "next"], f"names-{level}"))
    return Repeats(lines, tables)


def level_of(min_lines: int) -> int:
    """The highest level whose prefixes are no longer than ``min_lines`` lines."""
    return min_lines.bit_length() - 1


def later_windows(repeats: Repeats, length: int) -> tuple[DataFrame, DataFrame | None]:
    """``(doc_id, th, seq, name)`` where a window of ``length`` lines begins that occurs earlier too, and a table to drop.

    A window is named by two prefixes of 2^k lines, the second ending where the window ends.
    """
    level, made = level_of(length), None
    named = repeats.levels[min(level, len(repeats.levels) - 1)]  # doubling stops at a level without rows
    shift = length - (1 << level)
    if shift:
        named = made = _name(_pairs(named, shift), ["head", "next"], "windows")
    return named.where("name <> place").select("doc_id", "th", "seq", "name"), made


def later_copies(windows: DataFrame, min_lines: int, linking: DataFrame | None = None) -> DataFrame:
    """``(doc_id, th, seq, linked)``: the lines that ``windows`` of ``min_lines`` lines cover.

    ``linked`` tells that one window covers the line before as well; windows of
    one line cover no two, so ``linking`` ones, of two lines, are given beside them.
    """
    offset = F.explode(F.sequence(F.lit(0), F.lit(min_lines - 1))).alias("k")
    covered = windows.select("doc_id", "th", "seq", offset).select("doc_id", "th", (F.col("seq") + F.col("k")).alias("seq"), (F.col("k") > 0).alias("linked"))
    if linking is not None:
        covered = covered.unionByName(linking.select("doc_id", "th", (F.col("seq") + 1).alias("seq"), F.lit(True).alias("linked")))
    return covered.groupBy("doc_id", "th", "seq").agg(F.max("linked").alias("linked"))


def widest_windows(repeats: Repeats, windows: DataFrame, min_lines: int) -> DataFrame:
    """``(doc_id, th, seq, lines, first)``: the lines that ``windows`` of ``min_lines`` lines cover.

    ``lines`` is the length of the widest window known from there on that occurs
    earlier too, of all levels, and ``first`` the place of its first copy; both
    are null where no window of ``min_lines`` lines begins.
    """
    row = ["doc_id", "th", "seq", "lines", F.col("name").alias("first")]
    wide = repeats.intervals.where("name <> place").withColumn("lines", F.expr("shiftleft(1L, level)")).where(F.col("lines") > min_lines).select(row)
    wide = wide.unionByName(windows.withColumn("lines", F.lit(min_lines).cast("long")).select(row))
    if min_lines > 1:
        none = F.lit(None).cast("long")
        wide = wide.unionByName(later_copies(windows, min_lines).select("doc_id", "th", "seq", none.alias("lines"), none.alias("first")))
    return wide.groupBy("doc_id", "th", "seq").agg(F.max("lines").alias("lines"), F.max_by("first", "lines").alias("first"))


def number_copies(gone: DataFrame) -> DataFrame:
    """``gone`` with ``linked``, ``copy``, the number of a line's copy, ``end``, where its window ends, and ``reach``, where those before it end.

    Windows as wide as the one a line before, whose first copies are a line
    apart too, are one copy: all of it occurs there.
    """
    in_order = Window.partitionBy("doc_id", "th").orderBy("seq")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    gone = gone.withColumn("end", F.col("seq") + F.col("lines"))
    reach = F.coalesce(F.max("end").over(before), F.lit(0).cast("long"))
    after = lambda c: F.col(c) - F.lag(c).over(in_order)
    # Two lines at least: places follow each other across documents too, and a wider window lies in one.
    goes_on = F.coalesce((F.col("lines") > 1) & (after("seq") == 1) & (after("lines") == 0) & (after("first") == 1), F.lit(False))
    gone = gone.withColumn("reach", reach).withColumn("linked", F.col("reach") > F.col("seq")).withColumn("_on", goes_on)
    return gone.withColumn("copy", F.sum(F.when(F.col("_on"), 0).otherwise(1)).over(in_order)).drop("_on")


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = 2, found: str = "line_dedup", copies: bool = False
) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``, and a struct ``found``.

    A run of ``min_lines`` or more consecutive non-blank lines that occurs at
    an earlier place (by id, text hash and line) is deleted, line ends
    included; runs are judged on the input.  Every window of ``min_lines`` lines
    of a longer run is itself such a run, so names are doubled up to that length
    only (two lines at least, which tell what belongs together).  Deleted
    neighbours are one run if a window with an earlier copy covers both.  Blank
    lines (spaces only) are in no run and stay.  ``found`` holds n_lines (all
    lines), n_deleted, n_runs and longest_run (deleted runs, in non-blank lines)
    and ``deleted``, the numbers of the deleted lines.

    With ``copies`` names are doubled until nothing repeats, and runs come from
    the widest windows of all levels; deletions and runs are the same.
    ``found`` then also holds ``copies``, the parts of the text that one earlier
    place holds as a whole: ``line``, the number of the first line, and
    ``lines``, their length in non-blank lines.  They are followed along first
    copies and may overlap; those inside another one are left out.

    Null text stays null with zeros, empty text has one (blank) line.  A null
    id is an id like any other and comes first.  Rows that repeat both id and
    text count as one document.  All other columns stay as they are.
    """
    linked_by = max(min_lines, 2)
    if copies:
        repeats = prefix_doubling(docs, doc_id, text, gapless=True)
        windows, made = later_windows(repeats, min_lines)
        gone, own = widest_windows(repeats, windows, min_lines), ["lines", "first"]
    else:
        repeats = prefix_doubling(docs, doc_id, text, level_of(linked_by))  # higher levels tell nothing more
        windows, made = later_windows(repeats, min_lines)
        gone, own = later_copies(windows, min_lines, later_windows(repeats, linked_by)[0] if linked_by > min_lines else None), ["linked"]
    runs = F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(Window.partitionBy("doc_id", "th").orderBy("seq"))
    gone = (
        gone.join(repeats.lines.select("doc_id", "th", "seq", "line"), ["th", "seq"]).where(gone["doc_id"].eqNullSafe(repeats.lines["doc_id"]))
        .select(repeats.lines["doc_id"].alias("doc_id"), "th", "seq", "line", *own)
    )
    parts, per_run, per_text = [F.collect_list("line").alias("part")], [], []
    if copies:
        whole = F.when(F.max("end") > F.min("reach"), F.struct(F.min("line").alias("line"), (F.max("end") - F.min("seq")).alias("lines")))
        gone = number_copies(gone).withColumn("run", runs).groupBy("doc_id", "th", "run", "copy").agg(F.collect_list("line").alias("part"), whole.alias("whole"))
        parts, per_run = [F.flatten(F.collect_list("part")).alias("part")], [F.collect_list("whole").alias("copies")]
        per_text = [F.array_sort(F.flatten(F.collect_list("copies"))).alias("copies")]
    else:
        gone = gone.withColumn("run", runs)
    lists = (
        gone.groupBy("doc_id", "th", "run")
        .agg(*parts, *per_run)
        .groupBy("doc_id", "th")
        .agg(F.flatten(F.collect_list("part")).alias("deleted"), F.count(F.lit(1)).alias("n_runs"), F.max(F.size("part")).alias("longest_run"), *per_text)
    )
    l = fresh(docs, "_l")
    lists = lists.select("doc_id", "th", F.struct(F.array_sort("deleted").alias("deleted"), "n_runs", F.col("longest_run").cast("long").alias("longest_run"), *(["copies"] if copies else [])).alias(l))
    lists = stage_table(lists, "deletions")
    repeats.drop()
    drop_staged(made)
    joined = join_listed(docs, lists, doc_id, text, l)
    lines, gone_lines = split_lines(col(text)), F.col(f"{l}.deleted")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(numbers, gone_lines), lambda k: F.element_at(lines, k + 1))
    zero = F.lit(0).cast("long")
    result = F.struct(
        F.when(col(text).isNull(), zero).otherwise(F.size(lines).cast("long")).alias("n_lines"),
        F.coalesce(F.size(gone_lines).cast("long"), zero).alias("n_deleted"),
        F.coalesce(F.col(f"{l}.n_runs"), zero).alias("n_runs"),
        F.coalesce(F.col(f"{l}.longest_run"), zero).alias("longest_run"),
        F.coalesce(gone_lines, F.array().cast("array<int>")).alias("deleted"),
        *([F.coalesce(F.col(f"{l}.copies"), F.array().cast("array<struct<line:int,lines:long>>")).alias("copies")] if copies else []),
    )
    text_now = F.when(F.col(l).isNull(), col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(found, result).withColumn(text, text_now).drop(l)
