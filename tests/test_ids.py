"""Identity rules: frame ids, stems, suffixes (SCL-1..SCL-6)."""

from framelake.functions import ids


def test_frame_id_pads_but_never_cuts(spark):
    df = spark.createDataFrame([("v", 0), ("v", 42), ("v", 1234567)], "video_id string, n long")
    got = [r["f"] for r in df.select(ids.frame_id("video_id", "n").alias("f")).collect()]
    assert got == ["v__000000", "v__000042", "v__1234567"]


def test_stem_rules(spark):
    names = ["a.b.mp4", ".mp4", "..mp4", "a.", "clip", "x.MOV", "dir.d/file"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["s"] for r in df.select(ids.stem("n").alias("s")).collect()]
    assert got == ["a.b", ".mp4", "..mp4", "a", "clip", "x", "dir"]


def test_video_id_and_frame_id_from_path(spark):
    df = spark.createDataFrame([("/raw/x/game.1.mp4", None), ("/f/v__000030.jpg", "given")], "p string, fid string")
    got = df.select(ids.video_id_from_path("p").alias("v"), ids.frame_id_from_path("fid", "p").alias("f")).collect()
    assert [tuple(r) for r in got] == [("game.1", "game.1"), ("v__000030", "given")]


def test_suffix_case_insensitive(spark):
    names = ["a.mp4", "b.MP4", "c.Mov", "d.avi", "e.mkv", "f.mp4.txt", "mp4"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["n"] for r in df.filter(ids.has_video_suffix("n")).collect()]
    assert got == ["a.mp4", "b.MP4", "c.Mov", "d.avi"]


def test_truncate_ms_toward_zero(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (33.3333,)], "ms double")
    assert [r[0] for r in df.select(ids.truncate_ms("ms")).collect()] == [1, -1, 33]


def test_fmt_decimal_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.123455,), (0.00025 * 1.02,), (0.5,)], "x double")
    assert [r[0] for r in df.select(ids.fmt_decimal("x")).collect()] == ["0.12346", "0.00026", "0.50000"]


def test_frame_id_negative_keeps_printf_sign(spark):
    df = spark.createDataFrame([("v", -5)], "video_id string, n long")
    assert df.select(ids.frame_id("video_id", "n")).first()[0] == f"v__{-5:06d}"
