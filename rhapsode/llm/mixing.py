"""Operator 1: mixing sources to target weights, by Efraimidis-Spirakis sampling.

Every document gets an exponential key -ln(u) / weight, where u is a uniform hash of its id and text and the
weight its quality. Within a source, documents are taken in the order of their keys until the source's word
budget is reached; whole passes over a source (epochs) come before that fractional part. Only built-in
functions run.

A source may hold most rows, so nothing sorts a source in one task: the keys of a source are cut into buckets of
1/64 octave, and those into 1024 smaller ones each; word sums of buckets are prefix-summed, and only the documents of the one
small bucket in which the budget ends are sorted. An exponential variable of any rate, so a source of any weights, has a density of at
most 1/e over the logarithm of the key: no bucket holds more than 0.4 % of a source, no smaller one more than 1 in 240,000, by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, n_words, small

OCTAVE, CELLS = 64, 1024
#: Ranges and widths of the mean word length by which prose is told from junk for the default weight.
PROSE_LENGTH, PROSE_SPREAD, LEAST_WEIGHT = 6.0, 4.0, 0.1


def prose_weight(text: Column, words: Column) -> Column:
    """Quality weight in [0.1, 1]: highest where the mean word length is that of prose."""
    z = (F.length(text) / words - PROSE_LENGTH) / PROSE_SPREAD
    return F.coalesce(F.greatest(F.lit(LEAST_WEIGHT), F.exp(-z * z)), F.lit(LEAST_WEIGHT))


def source_targets(sizes: DataFrame, source: str, size: str, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Targets of the sources: (source, source_size, target).

    Sources in code point order, null last, weigh ``weights`` in turn and divide ``share`` times all words.
    No target exceeds ``cap`` times its source's size; what is cut is divided among the others by weight, until none
    is above. This is water-filling: with the sources sorted by cap / weight, those in front whose cap lies
    below the level of the rest are full. The table has a row for each source, not for each document.
    """
    every = Window.orderBy(F.col(source).isNull(), source)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("w", w).withColumn("top", F.col(size) * F.lit(cap))
    order = Window.orderBy(F.col("top") / F.col("w"), F.col(source).isNull(), source)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    t = t.withColumn("total", F.sum(size).over(whole) * F.lit(share)).withColumn("left", F.col("total") - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
    t = t.withColumn("level", F.col("left") / F.sum("w").over(after)).withColumn("full", F.col("top") <= F.col("w") * F.col("level"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("top") / F.col("w"), F.col("level")))).over(whole)["level"]
    target = F.when(F.col("full"), F.col("top")).otherwise(F.col("w") * level)
    return t.select(source, F.col(size).alias("source_size"), target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 1, quality: Column | None = None, keep_rows: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, copies (and ``row``, all of the document's columns, if keep_rows).

    size: words of the text; taken: copies times size. Each source's taken words end within half a
    document of its target. Null or empty texts have size 0 and never count; a null source is a source of its own;
    rows that repeat are taken one by one; rows with equal keys are equal in id and text, so that any order of
    them is the same result. A source without words gets target 0. An empty table gives an empty table. Other columns
    play no part, whatever their names. quality: a weight above 0 for each row, else prose_weight().
    """
    text, source = F.col(text_col), F.col(source_col)
    kept = [F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if keep_rows else []
    (raw,) = fresh(docs, "raw_words")
    counted = docs.withColumn(raw, n_words(text))
    weight = quality if quality is not None else prose_weight(text, F.nullif(F.col(raw), F.lit(0)))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), text), 11).cast("double") + 0.5) / float(2**53)
    keyed = counted.select(F.col(id_col).alias("doc_id"), source.alias("source"), F.col(raw).alias("size"), (-F.log(u) / weight).alias("key"), *kept)
    p = F.log2("key") * OCTAVE
    b1 = F.floor(p)
    b2 = F.floor((p - b1) * CELLS)
    keyed = keyed.withColumn("b1", b1.cast("int")).withColumn("b2", b2.cast("int"))
    # whole rows are never written aside: what decides on a row follows from the row and the table of targets
    sized = materialize(keyed.drop("row"), "sized")

    sums = sized.groupBy("source").agg(F.sum("size").alias("size"))
    t = source_targets(sums, "source", "size", weights, share, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    t = t.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    t = materialize(t.withColumn("before1", F.lit(0.0)), "targets")

    def ends(rows: DataFrame, targets: DataFrame, cell: str, before: str, found: str, base: str) -> DataFrame:
        """targets with the cell in which each source's budget ends, and the words before it (null: in none)."""
        running = Window.partitionBy("source").orderBy(cell)
        cells = rows.groupBy("source", cell).agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(running))
        x, y = cells.alias("x"), targets.alias("y")
        at = F.col("x.upto") + F.col(f"y.{base}")
        hit = x.join(small(y), F.col("x.source").eqNullSafe(F.col("y.source"))).where((at > F.col("y.rest")) & (at - F.col("x.n") <= F.col("y.rest")))
        hit = hit.select(F.col("x.source").alias("s"), F.col(f"x.{cell}").alias(found), (at - F.col("x.n")).alias(before))
        return targets.join(hit, targets["source"].eqNullSafe(hit["s"]), "left").drop("s")

    t = materialize(ends(sized, t, "b1", "before2", "end1", "before1"), "targets")
    x, y = sized.alias("x"), t.alias("y")
    last = x.join(small(y), F.col("x.source").eqNullSafe(F.col("y.source")) & (F.col("x.b1") == F.col("y.end1"))).select("x.source", "x.b2", "x.size")
    t = materialize(ends(last, t, "b2", "before3", "end2", "before2"), "targets")

    x, y = (keyed if keep_rows else sized).alias("x"), small(t.alias("y"))
    every = x.join(y, F.col("x.source").eqNullSafe(F.col("y.source"))).select("x.*", "y.source_size", "y.target", "y.epochs", "y.rest", "y.end1", "y.end2", "y.before3")
    inside = F.coalesce((F.col("b1") == F.col("end1")) & (F.col("b2") == F.col("end2")), F.lit(False))
    early = F.coalesce((F.col("b1") < F.col("end1")) | ((F.col("b1") == F.col("end1")) & (F.col("b2") < F.col("end2"))), F.lit(False))
    running = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("before3") + F.sum("size").over(running)
    final = every.where(inside).withColumn("more", 2 * upto - F.col("size") <= 2 * F.col("rest"))
    final = every.where(~inside).withColumn("more", early).unionByName(final)
    copies = F.col("epochs") + F.col("more").cast("long")
    out = final.withColumn("copies", copies)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *(["row"] if keep_rows else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs."""
    mixed = mix_sources(docs, keep_rows=True, **options).where("copies > 0 and size > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
