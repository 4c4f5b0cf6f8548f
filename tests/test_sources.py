"""Readers and writers on hand-made files."""

import zipfile

import numpy as np
import pytest

from rhapsode.sources import archives as A
from rhapsode.sources import captions as C
from rhapsode.sources import records as P
from rhapsode.sources.workbook import FirstSheet, frame_cues


def cues(spark, text):
    df = spark.createDataFrame([(1, text)], "video_id long, text string")
    return [(r["start_ms"], r["end_ms"], r["text"]) for r in C.in_millis(C.cues_of(df, "video_id")).orderBy("seq").collect()]


def test_lenient_vtt(spark):
    text = "﻿WEBVTT - x\r\n00:01.5 --> 00:02,0625 align:start\r\nfirst, in the header\r\n\r\nNOTE a --> b\r\n\r\nSTYLE\r\n\r\nid 7\r\n01:00:00.000 --> 01:00:01.0005\r\ntwo\r\nlines\r\n \t\r\n00:26:59.09 --> 00:27:00\r\na\r\n"
    assert cues(spark, text) == [(1500, 2063, "first, in the header"), (3_600_000, 3_601_001, "two lines"), (1_619_090, 1_620_000, "a")]


@pytest.mark.parametrize("text", ["no header", "WEBVTT\n\nonly text", "WEBVTT\n\na\nb\n00:01.0 --> 00:02.0\nx"])
def test_bad_vtt(spark, text):
    with pytest.raises(Exception, match="WebVTT|timing line"):
        cues(spark, text)


def test_cleaning(spark):
    rows = [(1, 0, 0, 1000, " a \t b\n"), (1, 1, 0, 0, "x"), (1, 2, 0, 5, "  "), (1, 3, 0, 5, "a --> b"), (1, 4, 9, 5, "late")]
    df = spark.createDataFrame(rows, "video_id long, seq long, start_ms long, end_ms long, text string")
    assert [(r["seq"], r["text"]) for r in C.cleaned(df).orderBy("seq").collect()] == [(0, "a b"), (3, "a -> b")]
    assert C.vtt_texts(C.cleaned(df), ["video_id"]).first()["vtt"] == "WEBVTT\n\n00:00:00.000 --> 00:00:01.000\na b\n\n00:00:00.000 --> 00:00:00.005\na -> b\n"


def workbook(path, rows):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    shared = sorted({c for r in rows for c in r if isinstance(c, str)})

    def cell(at, c):
        if c is None:
            return ""
        if isinstance(c, str):
            return f'<c r="{at}" t="s"><v>{shared.index(c)}</v></c>'
        return f'<c r="{at}"><v>{c}</v></c>'

    sheet = "".join(f'<row r="{i}">' + "".join(cell(f"{chr(65 + k)}{i}", c) for k, c in enumerate(r)) + "</row>" for i, r in enumerate(rows, 1))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{sheet}</sheetData></worksheet>")


def test_workbook(spark, tmp_path):
    head = ["Video_Name", "Begin_Frame", "End_Frame", "Subtitle"]
    workbook(tmp_path / "a.xlsx", [head, ["1_2_2020", 10, 20.0, "hi"], ["EA3", 1, 2, "web"], [None, None, None, None], ["1_2_2020", 30, 40, None]])
    spark.dataSource.register(FirstSheet)
    rows = spark.read.format("first_sheet").option("path", str(tmp_path / "a.xlsx")).load()
    got = [(r["name"], r["row"], r["begin"], r["end"], r["text"]) for r in frame_cues(rows).orderBy("row").collect()]
    assert got == [("1_2_2020", 2, 10, 20, "hi"), ("1_2_2020", 5, 30, 40, "")]
    workbook(tmp_path / "b.xlsx", [head, ["x", 1.5, 2, "hi"]])
    with pytest.raises(Exception, match="not a frame number"):
        frame_cues(spark.read.format("first_sheet").option("path", str(tmp_path / "b.xlsx")).load()).collect()


def test_metadata_table_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1.5, 7, 8, None, 0.25, "[]", None, 'a "note", x'), ("a", None, None, 1, "human", None, None, "[[1, 2]]", "")], "video_id string, duration_s double, width int, height int, caption_source string, undetected_ratio double, empty_runs string, copy_of string, note string")
    path = str(tmp_path / "meta")
    P.write_meta_table(rows, path)
    raw = next((tmp_path / "meta").glob("part-*")).read_bytes().decode()
    assert raw.startswith(",".join(P.META_COLUMNS) + ",note\r\na,,,1,human,,,")
    got = {r["video_id"]: r for r in P.read_meta_table(spark, path).collect()}
    assert got["b"]["duration_s"] == 1.5 and got["b"]["note"] == 'a "note", x' and got["b"]["undetected_ratio"] == 0.25 and got["a"]["width"] is None and got["a"]["copy_of"] == "[[1, 2]]"


def test_record_partitions_are_replaced(spark, tmp_path):
    path = f"file://{tmp_path}/record"
    make = lambda v: spark.createDataFrame([(v, 0), (v, 1)], "video_id long, frame long")
    for v in (1, 2, 1):
        P.write_record({"frames": make(v)}, path)
    assert P.read_record(spark, path, "frames").count() == 4
    assert P.checksums(spark, f"{tmp_path}/record/frames/video_id=1/*.parquet").count() >= 1


def test_sentences_need_their_header(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("\t".join(P.SENTENCE_COLUMNS) + "\n" + "\t".join(["1", "v", "v_3", "n", "0.5", "1", 'a "b'])  + "\n")
    assert P.read_sentences(spark, str(tmp_path / "s.tsv")).first()["SENTENCE"] == 'a "b'
    (tmp_path / "t.tsv").write_text("A\tB\n1\t2\n")
    with pytest.raises(ValueError):
        P.read_sentences(spark, str(tmp_path / "t.tsv"))


def test_meta_rows_must_be_named_by_their_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"video_id": "a", "width": 3}')
    assert P.read_meta_rows(spark, str(tmp_path), "video_id string, width int").first()["width"] == 3
    (tmp_path / "b.json").write_text('{"video_id": "c", "width": 3}')
    with pytest.raises(Exception, match="file's name"):
        P.read_meta_rows(spark, str(tmp_path), "video_id string, width int").collect()


def archive(spark, folder, n=("a", "b")):
    videos = spark.createDataFrame([(v, 640, 480, 30000, 1001, 4, "first", "{}", "{}") for v in n], "video_id string, width long, height long, fps_num long, fps_den long, n_frames long, primary_rule string, meta string, provenance string")
    points = [float(i) for i in range(399)]
    rows = [(v, f, d, 0.0, 1.0, 2.0, 3.0, 0.9 - d / 10, 7 if d else 1, d == 1, points if d else None) for v in n for f, k in ((0, 2), (2, 3)) for d in range(k)]
    dets = spark.createDataFrame(rows, "video_id string, frame long, det long, x1 double, y1 double, x2 double, y2 double, score double, flags int, is_primary boolean, kpts array<float>")
    return A.write_archives(videos, dets, folder)


def test_archives_round_trip(spark, tmp_path):
    markers = archive(spark, str(tmp_path))
    assert {(r["video_id"], r["bytes"]) for r in markers.collect()} == {(p.stem, p.stat().st_size) for p in tmp_path.glob("*.npz")}
    with np.load(tmp_path / "a.npz") as z:
        assert set(z.files) == set(A.MEMBERS) and z["det_offsets"].tolist() == [0, 2, 2, 5, 5] and z["kpt_det"].tolist() == [1, 3, 4] and z["kpts"].shape == (3, 133, 3)
    read = lambda table: A.read_archives(spark, str(tmp_path), table).where("video_id = 'a'")
    assert [(r["frame"], r["num_persons"], r["primary"]) for r in read("frames").orderBy("frame").collect()] == [(0, 1, 0), (1, 0, -1), (2, 2, 0), (3, 0, -1)]
    assert [(r["frame"], r["det"], r["flags"]) for r in read("detections").orderBy("frame", "det").collect()] == [(0, 0, 1), (0, 1, 7), (2, 0, 1), (2, 1, 7), (2, 2, 7)]
    assert [(r["frame"], r["pos"], r["det"], r["kpts"][398]) for r in read("posed").orderBy("frame", "pos").collect()] == [(0, 0, 1, 398.0), (2, 0, 3, 398.0), (2, 1, 4, 398.0)]
    assert read("videos").first()["width"] == 640 and read("rates").first()["fps_den"] == 1001
    assert A.file_problems(markers, str(tmp_path)).count() == 0


@pytest.mark.parametrize("change, table, message", [
    ({"kpts": None}, "videos", "missing members"), ({"schema_version": np.array(2)}, "detections", "schema_version"), ({"video_id": np.array("z")}, "videos", "holds video"),
    ({"det_boxes": np.zeros((5, 4))}, "detections", "det_boxes holds float64"), ({"det_scores": np.zeros(4, "f4")}, "detections", "differ in length"), ({"num_frames": np.array(5)}, "frames", "differ in length"), ({"det_offsets": np.array([1, 2])}, "detections", "offsets"),
])
def test_bad_archives(spark, tmp_path, change, table, message):
    archive(spark, str(tmp_path), ("a",))
    with np.load(tmp_path / "a.npz") as z:
        members = {**{k: z[k] for k in z.files}, **change}
    np.savez(tmp_path / "a.npz", **{k: v for k, v in members.items() if v is not None})
    with pytest.raises(Exception, match=message):
        A.read_archives(spark, str(tmp_path), table).collect()


def test_probe_texts(spark):
    one = '{"streams": [{"width": 4, "height": 3, "r_frame_rate": "%s", "avg_frame_rate": "%s", "nb_frames": %s}]}'
    rows = [("ok", one % ("60000/2002", "30000/1001", '"9"')), ("varies", one % ("25/1", "24/1", '"9"')), ("zero", one % ("0/0", "25/1", '"9"')), ("none", '{"streams": []}'), ("count", one % ("25/1", "25/1", "null")), ("text", "x")]
    df = spark.createDataFrame(rows, "video_id string, value string")
    got = {r["video_id"]: (r["fps_num"], r["fps_den"], r["problem"]) for r in P.probed(df, strict=False).collect()}
    assert got["ok"] == (30000, 1001, None) and {k: v[2] for k, v in got.items() if k != "ok"} == {"varies": "variable frame rate", "zero": "missing frame rate or nb_frames", "none": "no video stream", "count": "missing frame rate or nb_frames", "text": "no video stream"}
    assert P.probed(df.where("video_id = 'ok'")).first()["nb_frames"] == 9
    with pytest.raises(Exception, match="varies: variable frame rate"):
        P.probed(df.where("video_id = 'varies'")).collect()


def test_frames_must_be_as_many_as_expected(spark):
    want = spark.createDataFrame([("a", 2), ("b", 1), ("c", 0)], "video_id string, expected long")
    have = spark.createDataFrame([("a", 0), ("a", 1)], "video_id string, frame long")
    assert [tuple(r) for r in P.decoded_counts(want, have, strict=False).collect()] == [("b", 1, 0)]
    assert P.decoded_counts(want.where("video_id <> 'b'"), have).count() == 0
    with pytest.raises(Exception, match="video b: 0 frames decoded, 1 expected"):
        P.decoded_counts(want, have).collect()


def test_split_files_replace_older_ones(spark, tmp_path):
    path = str(tmp_path / "s")
    make = lambda *n: spark.createDataFrame([(x, 1, "train") for x in n], "name string, video_id long, split string")
    for names in (("", "old"), ("", "new")):
        P.write_splits(make(*names), path)
    assert {p.name for p in (tmp_path / "s").glob("file=*")} == {"file=splits", "file=splits_new"}
    with pytest.raises(Exception, match="not a split name: a b"):
        P.write_splits(make("a b"), path)
