"""Tables of records, metadata and state: readers with checks, and writers.

Records live in four Parquet tables (videos, frames, detections, posed), partitioned by video for dynamic overwrite, so that deriving one
video again rewrites one partition. Column pruning takes the place of reading single members.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = 1
RECORD_TABLES = ("videos", "frames", "detections", "posed")
#: Fixed value: the header of realigned sentence tables.
SENTENCE_COLUMNS = ("VIDEO_ID", "VIDEO_NAME", "SENTENCE_ID", "SENTENCE_NAME", "START_REALIGNED", "END_REALIGNED", "SENTENCE")


def write_record(tables: dict[str, DataFrame], path: str, by: str = "video_id") -> None:
    """Writes each table, replacing only the partitions of the videos it holds."""
    for name in RECORD_TABLES:
        if name in tables:
            df = tables[name].withColumn("schema_version", F.lit(SCHEMA_VERSION))
            df.repartition(by).sortWithinPartitions(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(f"{path}/{name}")


def read_record(spark: SparkSession, path: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One table of the record; rows of another schema version are an error."""
    df = spark.read.parquet(f"{path}/{name}")
    if "schema_version" not in df.columns:
        raise ValueError(f"{name} has no schema_version")
    same = F.when(F.col("schema_version") == SCHEMA_VERSION, True).otherwise(F.raise_error(F.lit("unknown schema version")).cast("boolean"))
    df = df.where(same)
    return df.select(*columns) if columns else df.drop("schema_version")


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table whose header must be SENTENCE_COLUMNS exactly; all text."""
    df = spark.read.csv(path, sep="\t", header=True, enforceSchema=False, quote="")
    if tuple(df.columns) != SENTENCE_COLUMNS:
        raise ValueError(f"{path}: columns {df.columns}, expected {SENTENCE_COLUMNS}")
    return df


def split_ids(raw: DataFrame, order: tuple[str, ...], text: str = "value") -> DataFrame:
    """(id, split) of {split: [id, ...]} JSON texts; an id listed twice keeps its first split in order, splits not in order come last by name."""
    m = F.from_json(text, "map<string,array<string>>")
    return first_split(raw.select(F.explode(m).alias("split", "ids")).select("split", F.explode("ids").alias("id")), order)


def first_split(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(id, split) of rows (split, id): the first split in order that lists an id, and then by name."""
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("split"))
    rank = F.when(rank > 0, rank).otherwise(len(order) + 1)
    return rows.groupBy("id").agg(F.min_by("split", F.struct(rank, F.col("split"))).alias("split"))


def read_meta_rows(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of a folder of JSON files, one each; a row whose video_id isn't its file's stem is an error."""
    from .archives import _store, listed_files
    from .recordfiles import qualified

    def texts(batches):
        import pyarrow as pa

        for b in batches:
            paths, out = b.column(0).to_pylist(), []
            for path in paths:
                store, at = _store(path)
                with store.open_input_stream(at) as raw:
                    out.append(raw.read().decode())
            yield pa.RecordBatch.from_pydict({"f_": pa.array([p.rpartition("/")[2] for p in paths], pa.string()), "text": pa.array(out, pa.string())})

    got = listed_files(spark, qualified(spark, folder)).mapInArrow(texts, "f_ string, text string").where("trim(text) <> ''")
    df = got.select(F.from_json("text", schema).alias("r"), "f_").select("r.*", "f_")
    same = F.when(F.regexp_replace("f_", r"\.json$", "") == F.col("video_id"), True).otherwise(F.raise_error(F.lit("video_id isn't the file's name")).cast("boolean"))
    return df.where(same).drop("f_")


def write_meta_rows(rows: DataFrame, folder: str) -> None:
    """A JSON file for each row, named by its video_id; a file appears whole or not at all. Tasks write through pyarrow's file systems."""
    spark = rows.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    full = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    root = f"file://{full[5:]}" if full.startswith("file:/") and not full.startswith("file:///") else full

    def write(frames):
        import uuid

        import pandas as pd
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        work = f"{base}/.{uuid.uuid4().hex}"  # readers pass over names that begin with a dot; tasks don't wait for each other in a folder of their own
        store.create_dir(work, recursive=True)
        for f in frames:
            for name, text in zip(f["video_id"], f["text"], strict=True):
                draft = f"{work}/{name}"
                with store.open_output_stream(draft) as out:
                    out.write(text.encode())
                store.move(draft, f"{base}/{name}.json")
            yield pd.DataFrame({"n": [len(f)]})
        store.delete_dir(work)

    from .archives import tasks

    rows.select("video_id", F.to_json(F.struct(*rows.columns)).alias("text")).repartition(tasks(spark)).mapInPandas(write, "n long").agg(F.sum("n")).collect()


#: Columns of the metadata table, those that hold JSON, and those of older versions that are dropped.
META_COLUMNS = ("video_id", "duration_s", "width", "height", "caption_source", "undetected_ratio", "empty_runs", "handless_runs", "switch_runs", "default_signing_runs", "copy_of", "unreliable_spans")
META_JSON = ("empty_runs", "handless_runs", "switch_runs", "default_signing_runs", "copy_of", "unreliable_spans")
META_RETIRED = ("masked_runs",)


def typed_meta(text_rows: DataFrame) -> DataFrame:
    """Typed known columns, retired ones dropped, others kept as text; empty cells are null; rows without an id are dropped."""
    kinds = {"duration_s": "double", "width": "int", "height": "int", "undetected_ratio": "double"}
    cols = []
    for c in text_rows.columns:
        if c in META_RETIRED:
            continue
        v = F.nullif(F.col(c), F.lit(""))
        cols.append((v.cast(kinds[c]) if c in kinds else v).alias(c))
    return text_rows.select(*cols).where(F.col("video_id").isNotNull())


def read_meta_table(spark: SparkSession, path: str) -> DataFrame:
    """A metadata table of any version."""
    return typed_meta(spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False, nullValue="\0", emptyValue="", quote='"', escape='"', multiLine=True))


def meta_cells(rows: DataFrame) -> DataFrame:
    """The cells of META_COLUMNS and then the unknown columns, as text, in the fixed format."""
    def cell(c: str):
        if c not in rows.columns:
            return F.lit("")
        if c == "undetected_ratio":
            return F.when(F.col(c).isNull(), "").otherwise(F.format_string("%.4f", F.col(c).cast("double")))
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    extra = [c for c in rows.columns if c not in META_COLUMNS and c not in META_RETIRED]
    return rows.select(*[cell(c).alias(c) for c in (*META_COLUMNS, *extra)])


def write_meta_table(rows: DataFrame, path: str) -> None:
    """One sorted CSV file with CRLF line ends: a table of one row per video, small next to the records."""
    cells = meta_cells(rows)
    quoted = [F.when(F.col(c).rlike('[",\r\n]'), F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))).otherwise(F.col(c)) for c in cells.columns]
    header = cells.sparkSession.createDataFrame([("", ",".join(cells.columns))], "k string, line string")
    lines = header.select(F.lit(0).alias("o"), "k", "line").union(cells.select(F.lit(1), "video_id", F.concat_ws(",", *quoted)))
    lines.orderBy("o", "k").coalesce(1).select("line").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def write_splits(rows: DataFrame, path: str) -> None:
    """Split files from rows (name, video_id, split): a folder of CSV for each name ("" is the main one); names that rows lack are removed."""
    name = F.when(F.col("name").rlike("^[A-Za-z0-9-]*$"), F.concat(F.lit("splits"), F.when(F.col("name") != "", F.concat(F.lit("_"), "name")).otherwise("")))
    file = F.coalesce(name, F.raise_error(F.concat(F.lit("not a split name: "), F.coalesce("name", F.lit("null")))).cast("string"))
    rows.select("video_id", "split", file.alias("file")).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("file").csv(path, header=True)


def csv_row(rows: DataFrame) -> DataFrame:
    """What a video's own row gives to the metadata table, with the two run lists that are always empty there; other columns keep their values elsewhere."""
    own = [c for c in ("video_id", "duration_s", "width", "height", "caption_source", "undetected_ratio", "empty_runs", "handless_runs") if c in rows.columns]
    return rows.select(*own, F.lit("[]").alias("switch_runs"), F.lit("[]").alias("default_signing_runs"))


def probed(texts: DataFrame, strict: bool = True) -> DataFrame:
    """(video_id, width, height, fps_num, fps_den, nb_frames, problem) of probe texts (video_id, value): JSON with the first stream's size, rates and number of frames.

    No stream, a rate or number that is missing or zero, and a rate that varies (r_frame_rate isn't avg_frame_rate) are problems: errors if strict. Rates are in lowest terms."""
    kind = "streams array<struct<width:long,height:long,r_frame_rate:string,avg_frame_rate:string,nb_frames:string>>"
    s = texts.select("video_id", F.get(F.from_json("value", kind)["streams"], 0).alias("s"))
    part = lambda c, i: F.regexp_extract(F.col(f"s.{c}"), r"^(\d+)/(\d+)$", i).try_cast("long")
    p = s.select("video_id", "s", *[part(c, i).alias(f"{c[0]}{i}") for c in ("r_frame_rate", "avg_frame_rate") for i in (1, 2)], F.col("s.nb_frames").try_cast("long").alias("nb_frames"))
    bad = ~F.coalesce((F.col("r2") > 0) & (F.col("a2") > 0) & F.col("nb_frames").isNotNull(), F.lit(False))
    varies = (F.col("r1") <= 0) | (F.col("r1") * F.col("a2") != F.col("a1") * F.col("r2"))
    problem = F.when(F.col("s").isNull(), "no video stream").when(bad, "missing frame rate or nb_frames").when(varies, "variable frame rate")
    if strict:
        problem = F.when(problem.isNotNull(), F.raise_error(F.concat_ws(": ", F.col("video_id").cast("string"), problem)).cast("string"))
    # the greatest common divisor by Euclid, which takes at most 92 steps on longs; rates need few
    pair = F.aggregate(F.sequence(F.lit(1), F.lit(92)), F.struct(F.col("r1").alias("a"), F.col("r2").alias("b")), lambda x, _: F.when(x["b"] == 0, x).otherwise(F.struct(x["b"].alias("a"), (x["a"] % F.when(x["b"] != 0, x["b"])).alias("b"))))
    p = p.withColumn("g", pair["a"]).withColumn("problem", problem)
    return p.select("video_id", F.col("s.width").alias("width"), F.col("s.height").alias("height"), F.expr("r1 div nullif(g, 0)").alias("fps_num"), F.expr("r2 div nullif(g, 0)").alias("fps_den"), "nb_frames", "problem")


def decoded_counts(expected: DataFrame, frames: DataFrame, strict: bool = True) -> DataFrame:
    """(video_id, expected, decoded) of videos whose frames (video_id, frame) aren't exactly as many as expected (video_id, expected); any is an error if strict."""
    n = frames.groupBy("video_id").agg(F.count("*").alias("decoded"))
    off = expected.select("video_id", "expected").join(n, "video_id", "left").select("video_id", "expected", F.coalesce("decoded", F.lit(0)).alias("decoded")).where("expected <> decoded or expected is null")
    return off.where(F.raise_error(F.format_string("video %s: %s frames decoded, %s expected", F.col("video_id").cast("string"), "decoded", "expected")).cast("boolean")) if strict else off


def changed_only(new: DataFrame, old: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, action): write (new or changed), keep, or delete (old keys that new lacks)."""
    j = new.select(F.col(key), F.col(value).alias("n")).join(old.select(F.col(key), F.col(value).alias("o")), key, "full")
    action = F.when(F.col("n").isNull(), "delete").when(F.col("o").eqNullSafe(F.col("n")), "keep").otherwise("write")
    return j.select(key, F.col("n").alias(value), action.alias("action"))


def append_failure(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Appends failures as JSON lines."""
    rows.write.mode("append").json(path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, crc32, sha256) of files; a failed read is retried as a task."""
    f = spark.read.format("binaryFile").load(path)
    return f.select("path", "length", F.crc32("content").alias("crc32"), F.sha2("content", 256).alias("sha256"))
