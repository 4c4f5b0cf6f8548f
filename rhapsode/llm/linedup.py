"""Operator 2: line dedup, by a suffix array over line-id sequences, sorted by distributed prefix doubling.

Each document is the sequence of its lines that aren't blank, and all lines have numbers that rise with doc_id and line; a number is left out
between two documents. Suffixes are ranked by their first line, then by their first 2, 4, ... lines: a rank and the rank that many lines on give the next
rank, in one range-partitioned sort of the distinct pairs. Suffixes whose rank nobody shares leave, and the doubling ends when none
is left: then all suffixes are told apart.

The intervals of the suffix array with a common prefix are then walked from the longest to the shortest power of two. An interval of prefix length n is split by
the rank of the 2^j lines that follow the prefix: those that share it go on as an interval of length n + 2^j, and only their first suffix stays
to stand for them in the interval of length n, as all of them continue it alike. Each suffix thus comes to rest in the interval of its longest common prefix with
any earlier suffix, and the interval's first suffix is where that run of lines occurs first. Intervals overlap in their first suffixes only, so that no
step holds more than two rows for each suffix.

Lines that always follow one and the same line can't begin a maximal run and aren't asked. Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize

MIN_LINES = 1
_BLANK = " \t\n\x0b\x0c\r"


def line_ids(text: Column) -> Column:
    """Array of (line_no, h1, h2) of the lines that aren't blank: two 64-bit hashes of each line, trimmed of ASCII white space."""
    each = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line_no"), F.btrim(x, F.lit(_BLANK)).alias("x")))
    return F.transform(F.filter(each, lambda s: s["x"] != ""), lambda s: F.struct(s["line_no"].alias("line_no"), F.xxhash64(s["x"]).alias("h1"), F.xxhash64(F.lit(1), s["x"]).alias("h2")))


def numbered_lines(docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """(pos, row, doc_id, seq, line_no, h1, h2): pos rises with doc_id (nulls last), text hash and line, with a gap after each document."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.where(F.col(text_col).isNotNull()).select(row.alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tie"), line_ids(F.col(text_col)).alias("lines"))
    rows = materialize(rows.where(F.size("lines") > 0), "line_ids")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie"), F.col("row")]
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    each = sorted_.select("row", "doc_id", F.posexplode(F.concat("lines", F.array(F.lit(None).cast(rows.schema["lines"].dataType.elementType)))).alias("seq", "line"))
    out = materialize(each.withColumn("pos", F.monotonically_increasing_id()).where("line is not null").select("pos", "row", "doc_id", "seq", "line.*"), "lines")
    drop(rows)
    return out


def ranked(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """keys and rank of the keys that two rows or more share: ranks follow the order of the keys over all partitions."""
    shared = keyed.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(shared.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def doubled_ranks(lines: DataFrame) -> list[DataFrame]:
    """For each power of two, (pos, rank): the rank of that many lines from pos on, where they occur elsewhere too."""
    levels, keyed, keys = [], lines.select("pos", "h1", "h2"), ["h1", "h2"]
    while True:
        rank = ranked(keyed, keys)
        now = materialize(keyed.join(rank, keys).select("pos", "rank"), "suffixes")
        drop(rank)
        if now.isEmpty():
            return levels
        levels.append(now)
        ahead = now.select((F.col("pos") - (1 << len(levels) - 1)).alias("pos"), F.col("rank").alias("r2"))
        keyed, keys = now.withColumnRenamed("rank", "r1").join(ahead, "pos"), ["r1", "r2"]


def left_diverse(ranks: DataFrame) -> DataFrame:
    """pos of the suffixes whose first line doesn't always follow one and the same line; ranks: of single lines."""
    before = ranks.select((F.col("pos") + 1).alias("pos"), F.col("rank").alias("before"))
    known = materialize(ranks.join(before, "pos", "left"), "line_before")
    one = known.groupBy("rank").agg((F.count("before") == F.count("*")).alias("always"), F.min("before").alias("lo"), F.max("before").alias("hi"))
    out = materialize(known.join(materialize(one.where("not always or lo <> hi").select("rank"), "diverse"), "rank").select("pos"), "asked")
    drop(known)
    return out


def longest_earlier(levels: list[DataFrame]) -> DataFrame:
    """(pos, first, n): the longest run of lines from pos on that occurs earlier, its length, and where it occurs first."""
    now = left_diverse(levels[0]).select("pos", F.lit(-1).cast("long").alias("first"), F.lit(0).alias("n"))
    for j in range(len(levels) - 1, -1, -1):
        ranks = levels[j].select(F.col("pos").alias("at"), "rank")
        told = materialize(now.join(ranks, F.col("pos") + F.col("n") == F.col("at"), "left").select("pos", "first", "n", "rank"), "told")
        inner = told.where("rank is not null").groupBy("first", "n", "rank").agg(F.min("pos").alias("root"), F.count("*").alias("k")).where("k > 1")
        inner = materialize(inner.select("first", "n", "rank", "root"), "intervals")  # so that an interval of very many suffixes can be split in the join
        both = told.join(inner, ["first", "n", "rank"], "left")
        stays = F.struct("pos", "first", "n")
        goes = F.struct("pos", F.col("root").alias("first"), (F.col("n") + (1 << j)).alias("n"))
        steps = F.when(F.col("root").isNull(), F.array(stays)).when(F.col("pos") == F.col("root"), F.array(stays, goes)).otherwise(F.array(goes))
        step = materialize(both.select(F.explode(steps).alias("s")).select("s.*"), "steps")
        drop(now, told, inner)
        now = step
    return now.where("n > 0 and pos <> first")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, row_col: str | None = None) -> DataFrame:
    """(doc_id, line_from, n_lines, first_doc_id, first_line): each maximal run of min_lines lines or more that occurs earlier.

    Earlier: in the order of doc_id (nulls last), then of the text's hash, then of the line. From each line, the longest run that occurs earlier counts; a
    run is maximal if no run that begins before it in the document reaches its end. line_from is its first line, from 0; n_lines how many of its lines aren't blank;
    first_doc_id and first_line where it occurs first, whole. Runs of different origins may overlap. Lines are compared without ASCII white space at their
    ends; blank lines are passed over and break no run. Null and empty texts have no lines. Rows that repeat are copies of each other.
    Extra columns play no part. row_col: a column that numbers the rows; then the result names them too, and the run's first line among those that aren't blank.
    """
    lines = numbered_lines(docs, id_col, text_col, row_col)
    levels = doubled_ranks(lines)
    if not levels:
        runs = lines.select("pos", F.col("pos").alias("first"), F.lit(0).alias("n")).where("n > 0")
    else:
        runs = longest_earlier(levels).where(F.col("n") >= min_lines)
    here, there = lines.drop("h1", "h2"), lines.select(F.col("pos").alias("first"), F.col("doc_id").alias("first_doc_id"), F.col("line_no").alias("first_line"))
    placed = runs.join(here, "pos")
    reach = F.max(F.col("pos") + F.col("n")).over(Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    whole = placed.withColumn("reach", reach).where("reach is null or pos + n > reach")
    out = whole.join(there, "first").select("doc_id", F.col("line_no").alias("line_from"), F.col("n").alias("n_lines"), "first_doc_id", "first_line", "row", "seq")
    return out if row_col else out.drop("row", "seq")


def delete_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """docs with the repeated runs cut out of their texts; columns unchanged, null texts stay null."""
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    table = materialize(whole.where("text is not null").withColumn("n", F.monotonically_increasing_id()), "documents", "zstd")
    runs = repeated_runs(table, "doc_id", "text", min_lines, row_col="n")
    cut = materialize(runs.groupBy("row").agg(F.collect_list(F.struct("seq", "n_lines")).alias("cuts")).withColumnRenamed("row", "n"), "cuts")
    numbered = table.join(cut, "n", "left")
    blank = f"btrim(x, '{_BLANK}') = ''"
    kept = F.expr(f"""aggregate(split(text, '\\n'), struct(0 as seq, cast(array() as array<string>) as kept), (s, x) -> struct(
        s.seq + if({blank}, 0, 1) as seq,
        if(not ({blank}) and exists(cuts, c -> s.seq >= c.seq and s.seq < c.seq + c.n_lines), s.kept, array_append(s.kept, x)) as kept)).kept""")
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    fields = [(text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return numbered.select(*fields).unionByName(docs.where(F.col(text_col).isNull()))
