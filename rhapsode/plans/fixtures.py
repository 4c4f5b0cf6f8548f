"""Views that reshape the test tables into frames, detections, series, cues and keypoints.

Each view is SQL that Spark and DuckDB both read; ``{name}`` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "frames": "select cast(o_orderkey % 10 as bigint) video_id, cast(floor(o_orderkey / 10) as bigint) frame from {orders}",
    "det": """select cast(l_orderkey % 10 as bigint) video_id, cast(floor(l_orderkey / 10) as bigint) frame,
        cast(row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey, l_suppkey, l_linenumber, l_quantity) - 1 as bigint) det,
        cast((l_partkey % 6) * 40 as double) x1, cast((l_suppkey % 4) * 60 as double) y1,
        cast((l_partkey % 6) * 40 + 60 + l_quantity * 2 as double) x2, cast((l_suppkey % 4) * 60 + 80 + l_quantity * 2 as double) y2,
        cast(l_extendedprice / 100000 as double) score from {lineitem}""",
    "series": """select user_id video_id, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as bigint) t,
        event_type = 'error' mask, value, event_type from {events}""",
    "videos": """select distinct user_id video_id, cast(case cast(user_id % 3 as int) when 0 then 25 when 1 then 30000 else 24 end as bigint) fps_num,
        cast(case cast(user_id % 3 as int) when 1 then 1001 else 1 end as bigint) fps_den from {events}""",
    "cues": """select conv_id video_id, role track, turn seq, cast(turn * 4000 + length(text) % 700 as bigint) start_ms,
        cast(turn * 4000 + length(text) % 700 + (length(text) % 9 - 1) * 500 as bigint) end_ms, text from {conversations}""",
    "spans": """select o_custkey video_id, cast(o_orderkey % 500 as double) a, cast(o_orderkey % 500 + o_orderkey % 37 - 3 as double) b, o_orderkey k from {orders}""",
    "splits": "select c_custkey video_id, c_mktsegment split from {customer}",
    # widths, heights and frame rates of many sizes
    "clips": """select c_custkey video_id, cast(320 + (c_custkey * 37) % 1700 as bigint) width, cast(240 + (c_custkey * 53) % 900 as bigint) height,
        cast(case cast(c_custkey % 3 as int) when 0 then 25 when 1 then 30000 else 24 end as bigint) fps_num,
        cast(case cast(c_custkey % 3 as int) when 1 then 1001 else 1 end as bigint) fps_den, cast(100 + (c_custkey * 97) % 90000 as bigint) nb_frames,
        cast(case when c_custkey % 4 = 0 then 90 + (c_custkey * 97) % 90000 end as bigint) expected_frames, c_name name, c_mktsegment split, c_acctbal balance from {customer}""",
}
KPTS_SPARK = """select vec_id, label, k, cast(element_at(embedding, cast(3*k+1 as int)) as double) x, cast(element_at(embedding, cast(3*k+2 as int)) as double) y,
    cast(abs(element_at(embedding, cast(3*k+3 as int))) as double) * 3 score from (select *, explode(sequence(0L, 20L)) k from {embeddings})"""
KPTS_DUCK = """select vec_id, label, k, cast(embedding[3*k+1] as double) x, cast(embedding[3*k+2] as double) y, cast(abs(embedding[3*k+3]) as double) * 3 score
    from (select *, unnest(range(0, 21)) k from embeddings)"""
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Tables and views of one folder, as attributes: t.orders, t.det."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        text = KPTS_SPARK if name == "kpts" else VIEWS[name]
        return self.spark.sql(text, **{x: getattr(self, x) for x in TABLES if f"{{{x}}}" in text})


def with_views(sql: str, views: list[str]) -> str:
    parts = []
    for v in views:
        text = KPTS_DUCK if v == "kpts" else VIEWS[v]
        for x in TABLES:
            text = text.replace(f"{{{x}}}", x)
        parts.append(f"{v} as ({text})")
    sql = sql.strip()
    if not parts:
        return sql
    if sql[:5].lower() == "with ":
        recursive = sql[5:].lstrip().lower().startswith("recursive ")
        rest = sql[5:].lstrip()[10:] if recursive else sql[5:]
        return f"with {'recursive ' if recursive else ''}{', '.join(parts)}, {rest}"
    return f"with {', '.join(parts)} {sql}"
