"""Queries of growing sinks, files that need parsing, cadences and rules as objects."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental as I
from ..operators import select as S
from ..operators import tracks as K
from .fixtures import Tables
from .frames import KEYS, RANKS
from .registry import query
from .tables import scratch
from .tracking import SHORT, _boxes, _lengths, log_lines


@query("sink_npy_stream", "select cast(video_id as varchar) as video_id, count(*) as length, 128 + 4 * count(*) as bytes, round(sum(value::float::double), 3) as total from series group by video_id", "series")
def sink_npy_stream(t: Tables) -> DataFrame:
    """A stream of rows of unknown number into one growing array for each video, whose header is settled at the end; the files are read back."""
    from ..sources import growing

    path = scratch(t, "growing")
    rows = t.series.select(F.col("video_id").cast("string").alias("array"), F.col("t").alias("position"), F.array(F.col("value").cast("float")).alias("value"))
    rows.repartitionByRange(3, "position").sortWithinPartitions("array", "position").write.parquet(f"{path}/in")
    growing.register(t.spark)
    source = t.spark.readStream.schema("array string, position long, value array<float>").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    source.writeStream.format("growing_arrays").option("path", growing.qualified(t.spark, f"{path}/sink")).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    done = growing.settle(t.spark, f"{path}/sink", f"{path}/out")
    totals = growing.read_arrays(t.spark, f"{path}/out").groupBy("array").agg(F.round(F.sum(F.col("value")[0].cast("double")), 3).alias("total"))
    return done.join(totals, "array").select(F.col("array").alias("video_id"), F.col("rows").alias("length"), "bytes", "total")


@query("src_xlsx", "select cast(range + 2 as int) as row, 'n' || cast(range % 7 as varchar) as name, cast(range * 3 as bigint) as begin from range(0, 500) where range % 7 <> 3")
def src_xlsx(t: Tables) -> DataFrame:
    from pyarrow import fs

    from ..sources.workbook import FirstSheet, frame_cues

    cells = lambda i, row: f'<row r="{i}">' + "".join(f'<c r="{c}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for c, v in zip("ABCD", row, strict=True)) + "</row>"
    rows = [("Video_Name", "Begin_Frame", "End_Frame", "Subtitle"), *((f"{'EA' if i % 7 == 3 else 'n'}{i % 7}", i * 3, i * 3 + 5, "x") for i in range(500))]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + "".join(cells(i, r) for i, r in enumerate(rows, 1)) + "</sheetData></worksheet>")
    path = scratch(t, "book") + "/a.xlsx"
    where, base = fs.FileSystem.from_uri(path)
    where.create_dir(base.rpartition("/")[0], recursive=True)
    with where.open_output_stream(base) as f:
        f.write(raw.getvalue())
    t.spark.dataSource.register(FirstSheet)
    return frame_cues(t.spark.read.format("first_sheet").option("path", path).load()).select("row", "name", "begin")


@query("src_decode_log")
def src_decode_log(t: Tables) -> DataFrame:
    """Log files, one each, whose lines are read in splits and numbered by their places, then the marker machine."""
    from pyspark.sql import Window

    path = scratch(t, "logs")
    log_lines(t).repartition("log").sortWithinPartitions("log", "n").select("line", "log").write.partitionBy("log").text(path)
    files = t.spark.read.option("lineSep", "\n").text(path)
    place = files.select("log", F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    each = place.select("log", (F.row_number().over(Window.partitionBy("log").orderBy("start", "id")) - 1).cast("long").alias("n"), "line")
    return I.log_sessions(each).select("video_id", F.size("lines").alias("n_lines"), F.col("lines")[0].alias("first_line"))


@query("heartbeat", "select user_id, cast(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000) + 1 as bigint) as beats from events group by user_id")
def heartbeat(t: Tables) -> DataFrame:
    return I.heartbeats(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", 3600)


@query("merge_cadence", """with recursive e as (select user_id, epoch_us(ts) as us, row_number() over (partition by user_id order by ts) as k from events),
    s as (select user_id, us as last, 0::bigint as n, 0::bigint as merges, 0::bigint as k from e where k = 1
      union all select s.user_id, case when s.n + 1 >= 5 or e.us - s.last >= 86400000000 then e.us else s.last end, case when s.n + 1 >= 5 or e.us - s.last >= 86400000000 then 0 else s.n + 1 end, s.merges + case when s.n + 1 >= 5 or e.us - s.last >= 86400000000 then 1 else 0 end, e.k from s join e on e.user_id = s.user_id and e.k = s.k + 1)
    select user_id, arg_max(merges, k) as merges, arg_max(n, k) as "left" from s group by user_id""")
def merge_cadence(t: Tables) -> DataFrame:
    return I.merge_points(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", 5, 86400)


@query("bounded_prefetch", "select event_type, count(*) as n from events group by event_type")
def bounded_prefetch(t: Tables) -> DataFrame:
    """At most so many files a trigger: what is read ahead stays bounded."""
    from ..streaming import streams as X
    from .tracking import _event_stream

    path = scratch(t, "bounded")
    X.run_to_table(_event_stream(t).select("event_type", "event_id"), path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("video_rule")
def video_rule(t: Tables) -> DataFrame:
    """A rule object that looks at whole videos."""
    p = K.TrackParams(**SHORT)
    rule = S.VideoRule("signer_track", lambda rows, n: K.signer_choice(rows, n, p), dict(SHORT))
    return rule.choose(_boxes(t), _lengths(t)).select("video_id", "t", "det")


@query("pipeline_factory", f"with {RANKS} select video_id, frame, max(case when ra = 1 then pos end) as primary_pos from k group by video_id, frame", "det")
def pipeline_factory(t: Tables) -> DataFrame:
    return S.processor("largest_bbox")(t.det.where("score > 0.3")).select(*KEYS, F.col("primary").alias("primary_pos"))
