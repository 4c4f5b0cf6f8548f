"""Operator 11: the trie of conversations' common beginnings, by radix partitioning over turn ids.

Turns are dictionary-encoded: equal (role, text) have one id, in their order. Conversations become arrays of ids, and equal conversations one row.
Partitioning is by most significant turn first: a bucket holds the conversations below one node. What all of a bucket share is skipped at once (the common
prefix of its least and greatest row), the next turn deals it into smaller buckets by a distributed grouping, and so on for buckets of more than
``local`` turns. Buckets below that are finished inside tasks by multikey quicksort: rows fall below, into or above the middle one's
next turn; the middle part is a node and goes one turn deeper. The recursion emits the nodes, and sums over their subtrees on
its way back; for the distributed levels, sums go up level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, materialize
from .textscan import groups

#: Turns of a bucket that one task finishes; ids of equal conversations that are joined into one text before they are hashed.
LOCAL, BLOCK = 16_384, 4096
FAMILY, TURNS = 5, 9
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, id, size): each turn with its id in the order of (role, text), and the UTF-8 bytes of its text."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    t = turns.withColumn("digest", digest)
    words = t.select("digest", "role", "text").distinct().repartitionByRange("role", "text").sortWithinPartitions("role", "text")
    words = materialize(words.select("digest", F.monotonically_increasing_id().alias("id")), "turn_ids")
    out = t.select("conv_id", "turn", "digest", F.octet_length("text").cast("long").alias("size")).join(words, "digest")
    return out.select("conv_id", "turn", "id", "size")


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): a conversation's turns in order; an array takes 16 bytes a turn, texts aren't in it."""
    t = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "id", "size")), _turn_order).alias("t"))
    return t.select("conv_id", F.transform("t", lambda x: x["id"]).alias("ids"), F.transform("t", lambda x: x["size"]).alias("sizes"))


def _turn_order(a: Column, b: Column) -> Column:
    by = lambda x, y: F.when(x < y, -1).when(x > y, 1)
    nulls = F.when(a["turn"].isNull() & b["turn"].isNotNull(), -1).when(a["turn"].isNotNull() & b["turn"].isNull(), 1)
    return F.coalesce(nulls, by(a["turn"], b["turn"]), by(a["id"], b["id"]), F.lit(0))


def rebuilt(seq: DataFrame) -> DataFrame:
    """Each conversation c as the first h turns of conversation c - c % 5, then its own after its first h; h is crc32 of its id, modulo 9."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(TURNS)).cast("int")
    heads = seq.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("of"), F.slice("ids", 1, TURNS - 1).alias("h_ids"), F.slice("sizes", 1, TURNS - 1).alias("h_sizes"))
    s = seq.withColumn("h", h).withColumn("of", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "of", "left")
    none = F.array().cast("array<bigint>")

    def both(head: str, own: str) -> Column:
        first = F.when(F.col("h") > 0, F.slice(F.coalesce(head, none), F.lit(1), F.col("h"))).otherwise(none)
        return F.concat(first, F.slice(own, F.col("h") + 1, F.size(own))).alias(own)

    return s.select("conv_id", both("h_ids", "ids"), both("h_sizes", "sizes"))


def classes(seq: DataFrame) -> DataFrame:
    """(conv_id, n, ids, sizes, ends): equal sequences as one row, with their least conversation, number, and the hash of all their ids.

    The ids of a large class are joined into texts of BLOCK ids by range-partitioned tasks; the hash itself reads those in order, as a stream.
    """
    one = materialize(seq.groupBy("ids", "sizes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")), "conv_classes")
    many = seq.join(one.where("n > 1").select("ids", "sizes", F.col("conv_id").alias("class")), ["ids", "sizes"]).select("class", "conv_id")
    many = many.repartitionByRange("class", "conv_id").sortWithinPartitions("class", "conv_id")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, ids, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
            for i, (k, c) in enumerate(zip(kinds, ids, strict=True)):
                if i == 0 or k != kinds[i - 1] or len(out[-1][2]) >= BLOCK:
                    out.append((k, c, []))
                out[-1][2].append(str(c))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out]), pa.array([o[1] for o in out]), pa.array([",".join(o[2]) for o in out])], names=["class", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for b in batches:
            out = []
            for k, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k != now:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], names=["conv_id", "hash"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], names=["conv_id", "hash"])

    texts = many.mapInArrow(joined, "class long, first long, ids string")
    ends = texts.repartition("class").sortWithinPartitions("class", "first").mapInArrow(hashed, "conv_id long, hash string")
    return one.join(ends, "conv_id", "left").select("conv_id", "n", "ids", "sizes", F.coalesce("hash", F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends"))


def quicksort_nodes(rows: list[tuple[int, int, list[int], list[int], str]], depth: int, parent: int | None) -> list[list]:
    """The trie of (conv_id, n, ids, sizes, ends) rows that share their first ``depth`` ids, from the node of that depth on.

    Nodes come as lists in the order of NODE. Multikey quicksort with its own stack: an entry is a range of rows and the node whose next
    turn tells them apart.
    """
    nodes: list[list] = []

    def node(lo: int, hi: int, d: int, up: int | None) -> int:
        part = rows[lo:hi]
        n, conv = sum(r[1] for r in part), min(r[0] for r in part)
        saved = (n - 1) * part[0][3][d - 1] if d else 0
        nodes.append([conv, d, parent if up is None else nodes[up][0], n, 0, 0, saved, EMPTY])
        above.append(up)
        return len(nodes) - 1

    above: list[int | None] = []
    stack = [(0, len(rows), depth, node(0, len(rows), depth, None))]
    while stack:
        lo, hi, d, at = stack.pop()
        if hi - lo == 1 and len(rows[lo][2]) > d:  # a chain
            at = node(lo, hi, d + 1, at)
            stack.append((lo, hi, d + 1, at))
            continue
        ended = [r for r in rows[lo:hi] if len(r[2]) == d]
        if ended:  # one at most, as rows differ
            nodes[at][7] = ended[0][4]
            rows[lo:hi] = ended + [r for r in rows[lo:hi] if len(r[2]) > d]
            lo += 1
        if lo == hi:
            continue
        pivot = rows[(lo + hi) // 2][2][d]
        less, same, more = [], [], []
        for r in rows[lo:hi]:
            (less if r[2][d] < pivot else same if r[2][d] == pivot else more).append(r)
        rows[lo:hi] = less + same + more
        a, b = lo + len(less), lo + len(less) + len(same)
        if less:
            stack.append((lo, a, d, at))
        if more:
            stack.append((b, hi, d, at))
        stack.append((a, b, d + 1, node(a, b, d + 1, at)))
    for i in range(len(nodes) - 1, -1, -1):  # children come after their parent
        x = nodes[i]
        x[5] = x[5] or 1
        if above[i] is not None:
            p = nodes[above[i]]
            p[4], p[5], p[6] = p[4] + 1, p[5] + x[5], p[6] + x[6]
    return nodes


def local_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of small buckets, and whether a node is its bucket's first one (top)."""
    key = ["at_conv", "at_depth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []

        def taken() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[] for _ in range(9)]
            kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[*(x.split()[0] for x in NODE.split(", ")), "top"])

        for g in groups(batches, key):
            c = {x: g.column(x).to_pylist() for x in ("conv_id", "n", "ids", "sizes", "ends")}
            found = quicksort_nodes(list(zip(c["conv_id"], c["n"], c["ids"], c["sizes"], c["ends"], strict=True)), g.column("at_depth")[0].as_py(), g.column("at_parent")[0].as_py())
            out.extend([*x, i == 0] for i, x in enumerate(found))
            if len(out) > 10_000:
                yield taken()
                out = []
        yield taken()

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, NODE + ", top boolean")


def trie_nodes(rows: DataFrame, local: int = LOCAL) -> DataFrame:
    """All nodes over (conv_id, n, ids, sizes, ends) rows of different ids."""
    top = rows.agg(F.min("conv_id")).first()[0]
    here = rows.select("*", F.lit(top).cast("long").alias("at_conv"), F.lit(0).cast("long").alias("at_depth"), F.lit(None).cast("long").alias("at_parent"))
    key, done, uppers, links, sums = ["at_conv", "at_depth"], None, [], [], []
    while True:
        stat = here.groupBy(*key).agg(F.count("*").alias("k"), F.sum(F.size("ids") - F.col("at_depth")).alias("turns"), F.sum("n").alias("n_convs"), F.min("ids").alias("low"), F.max("ids").alias("high"), F.min("at_parent").alias("at_parent"))
        stat = materialize(stat.where((F.col("k") > 1) & (F.col("turns") > local)), "trie_buckets")
        if stat.limit(1).count() == 0:
            part = local_nodes(here)
            done = part if done is None else done.union(part)
            break
        part = local_nodes(here.join(stat.select(*key), key, "left_anti"))
        done = part if done is None else done.union(part)
        differ = F.array_position(F.transform(F.arrays_zip("low", "high"), lambda x: ~x["low"].eqNullSafe(x["high"])), F.lit(True))  # the least and the greatest differ somewhere
        stat = materialize(stat.withColumn("shared", differ - 1).drop("low", "high", "k", "turns"), "trie_shared")
        big = here.drop("at_parent").join(stat.select(*key, "shared"), key)
        ended = big.where(F.size("ids") == F.col("shared")).select(*key, "ends")
        big = materialize(big.where(F.size("ids") > F.col("shared")).withColumn("next", F.element_at("ids", (F.col("shared") + 1).cast("int"))), "trie_rows")
        kids = materialize(big.groupBy(*key, "shared", "next").agg(F.min("conv_id").alias("kid")), "trie_kids")
        sizes = big.groupBy(*key).agg(F.min(F.slice("sizes", F.lit(1), F.col("shared").cast("int"))).alias("sizes"))
        width = kids.groupBy(*key).agg(F.count("*").alias("n_children"))
        up = stat.join(sizes, key).join(width, key).join(ended, key, "left")
        up = up.select("*", F.explode(F.sequence("at_depth", "shared")).alias("depth"))
        own = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.element_at("sizes", F.greatest("depth", F.lit(1)).cast("int"))).otherwise(0)
        last = F.col("depth") == F.col("shared")
        up = up.select(
            *key,
            "depth",
            F.when(F.col("depth") == F.col("at_depth"), F.col("at_parent")).otherwise(F.col("at_conv")).alias("parent_conv_id"),
            "n_convs",
            F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
            own.alias("own"),
            F.when(last, F.coalesce("ends", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256"),
        )
        uppers.append(materialize(up, "trie_upper"))
        links.append(kids.select(*key, F.col("kid").alias("conv_id"), (F.col("shared") + 1).alias("depth")))
        here = big.join(kids, [*key, "shared", "next"]).select("conv_id", "n", "ids", "sizes", "ends", F.col("kid").alias("at_conv"), (F.col("shared") + 1).alias("at_depth"), F.col("at_conv").alias("at_parent"))
        here = materialize(here, "trie_rows")
        drop(big)
    done = materialize(done, "trie_nodes")
    tops = done.where("top").select("conv_id", "depth", "n_leaves", "saved_tokens")
    out = done.drop("top")
    for up, link in reversed(list(zip(uppers, links, strict=True))):
        below = link.join(tops, ["conv_id", "depth"]).groupBy(*key).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        from_here = Window.partitionBy(*key).orderBy(F.desc("depth"))  # a chain of nodes in one bucket
        nodes = up.join(below, key).withColumn("saved_tokens", F.col("below") + F.sum("own").over(from_here))
        nodes = materialize(nodes.select(F.col("at_conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", (F.col("depth") == F.col("at_depth")).alias("top")), "trie_nodes")
        tops = tops.union(nodes.where("top").select("conv_id", "depth", "n_leaves", "saved_tokens"))
        out = out.union(nodes.drop("top"))
    return out


def prefix_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, in the columns of NODE.

    Turns are ordered by turn, null first; turns of equal number by role, then text. A null role or text is empty; rows without a conversation
    are passed over; repeated rows are turns of their own. A conversation that is left without turns is a member of the root. An empty table has no node. Ids are
    integers; other columns play no part, whatever their names.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    seq = materialize(rebuilt(materialize(sequences(turn_ids(turns)), "conversations")), "rebuilt")
    rows = materialize(classes(seq), "conv_rows")
    return trie_nodes(rows, local)
