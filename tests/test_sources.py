import json

import pytest
from pyspark.sql import functions as F

from tidelane.functions.imagebytes import compressed_format, decode_raw, jpeg_fault, mean_brightness, unit_tensor
from tidelane.operators.coverage import message_stamp
from tidelane.sources import files
from tidelane.sources.mcap import array_payload, compressed_payload, find_recordings, image_payload, joint_payload, read_recordings, read_summary, write_recording

CHANNELS = [("/joint_states", "sensor_msgs/msg/JointState"), ("/cam_waist/image_raw/compressed", "sensor_msgs/msg/CompressedImage"), ("/follower_r_x_controller/commands", "std_msgs/msg/Float64MultiArray"), ("/raw", "sensor_msgs/msg/Image"), ("/silent", "std_msgs/msg/String")]


def recording(path, compression=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    messages = [
        (0, 100, 90, joint_payload(1_500_000_007, ["b", "a"], [1.0, 2.0], [0.5, float("nan")])),
        (1, 110, 0, compressed_payload(2_000_000_000, "jpeg", b"\xff\xd8x\xff\xd9")),
        (2, 120, 120, array_payload([0.25, -1.0, 3.5])),
        (3, 130, 130, image_payload(3, "mono8", 2, 3, bytes(range(6)))),
        (0, 140, 140, b"\x00\x01"),
        (4, 150, 150, b"\x00\x01\x00\x00\x02\x00\x00\x00a\x00"),
    ]
    write_recording(str(path), CHANNELS, messages, compression=compression)


@pytest.mark.parametrize("compression", ["", "zstd", "lz4"])
def test_round_trip(spark, tmp_path, compression):
    recording(tmp_path / "s" / "0002" / "0002_0.mcap", compression)
    recording(tmp_path / "s" / "0001" / "0001_0.mcap", compression)
    (tmp_path / "s" / "0003").mkdir()
    (tmp_path / "s" / "0003" / "broken.mcap").write_bytes(b"no recording at all, but long enough to look at" * 3)
    assert [p.rsplit("/", 1)[1] for p in find_recordings(str(tmp_path / "s"))] == ["0001_0.mcap", "0002_0.mcap", "broken.mcap"]
    rows = read_recordings(spark, str(tmp_path / "s"))
    good = {r.topic: r for r in rows.where("episode = '0001' AND error IS NULL").collect()}
    assert set(good) == {t for t, _ in CHANNELS}
    joint = good["/joint_states"]
    assert (joint.header_stamp_ns, joint.joint.name, joint.joint.position, joint.joint.effort) == (1_500_000_007, ["b", "a"], [1.0, 2.0], [])
    assert good["/follower_r_x_controller/commands"].multiarray == [0.25, -1.0, 3.5]
    assert bytes(good["/cam_waist/image_raw/compressed"].image.data) == b"\xff\xd8x\xff\xd9"
    assert (good["/raw"].image.height, good["/raw"].image.width, good["/raw"].image.encoding) == (2, 3, "mono8")
    errors = {(r.episode, r.topic) for r in rows.where("error IS NOT NULL").collect()}
    assert errors == {("0001", "/joint_states"), ("0002", "/joint_states"), ("0003", None)}
    stamps = rows.where("episode = '0001' AND error IS NULL").select("topic", message_stamp(F.col("header_stamp_ns"), F.col("log_time_ns")).alias("ts")).collect()
    assert {r.topic: r.ts for r in stamps}["/follower_r_x_controller/commands"] == 120


def test_topics_are_pushed_down_and_channels_need_no_messages(spark, tmp_path):
    recording(tmp_path / "0001" / "a.mcap", "zstd")
    rows = read_recordings(spark, str(tmp_path)).where("topic = '/raw'")
    assert rows.count() == 1
    assert read_recordings(spark, str(tmp_path), topics=["/raw", "/silent"]).count() == 2
    channels = {r.topic: (r.messages, r.schema_name) for r in read_recordings(spark, str(tmp_path), mode="channels").collect()}
    assert channels["/joint_states"] == (2, "sensor_msgs/msg/JointState") and channels["/silent"][0] == 1
    assert read_summary(str(tmp_path / "0001" / "a.mcap")).end_ns == 150
    recording(tmp_path / "0002" / "b.mcap")
    cut = tmp_path / "0002" / "b.mcap"
    cut.write_bytes(cut.read_bytes()[:-20])
    broken = [r for r in read_recordings(spark, str(tmp_path), mode="channels").collect() if r.error]
    assert [r.episode for r in broken] == ["0002"]


def test_raw_images(spark):
    rows = [(bytes([0, 255]), "mono8", 1, 2), (bytes([10, 20, 30]), "bgr8", 1, 1), (b"\x01\x02", "mono16", 1, 1), (bytes([16, 128, 235, 128]), "yuyv", 1, 2), (b"x", "mono8", 5, 5), (b"", "odd", 1, 1)]
    df = spark.createDataFrame(rows, "d binary, e string, h int, w int")
    got = [r[0] for r in df.select(mean_brightness("d", "e", "h", "w")).collect()]
    assert got[0] == 127.5 and got[1] == 20 and got[2] == 513 and abs(got[3] - 127.5) < 1 and got[4:] == [None, None]
    assert list(decode_raw(bytes([10, 20, 30]), "bgr8", 1, 1)[0, 0]) == [30, 20, 10]
    tensor = df.limit(2).select(unit_tensor("d", "e", "h", "w").alias("t")).collect()
    assert [round(x, 3) for x in tensor[1].t] == [0.118, 0.078, 0.039]


def test_jpeg_envelope(spark):
    rows = [(b"\xff\xd8ab\xff\xd9", None), (b"\xff\xd8a", "invalid_jpeg_markers"), (b"abcdef", "invalid_jpeg_markers"), (b"ab\xff\xd9", "missing_soi"), (b"\xff\xd8abc", "missing_eoi"), (b"", "invalid_jpeg_markers"), (None, None)]
    assert [r[0] for r in spark.createDataFrame([(d,) for d, _ in rows], "d binary").select(jpeg_fault(F.col("d"))).collect()] == [w for _, w in rows]
    kinds = spark.createDataFrame([("rgb8; JPEG compressed",), ("png",), ("h264",), (None,)], "f string").select(compressed_format(F.col("f"))).collect()
    assert [r[0] for r in kinds] == ["jpeg", "png", None, None]


def test_configuration(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("joint_state_topic: /joint_states\ncameras: {waist: /cam_waist/image_raw}\nfps: 15\njoint_names: {role_prefix: {leader: action}, separator: '-'}\n")
    config = files.load_config(str(path))
    assert (config.joint_topics, config.fps, config.roles, config.separator, config.arms["r"]) == (["/joint_states"], 15, {"leader": "action"}, "-", "right")
    with pytest.raises(ValueError, match="unknown field 'x'.*fps.*no topic"):
        files.config_from({"x": 1, "fps": 0, "camera_topics": {"a": "cam"}})
    assert files.first_existing([str(tmp_path / "no"), str(path)]) == str(path)
    assert [files.merge_note("a", "b", m) for m in ("replace", "append", "preserve")] == ["b", "a\nb", "a"]
    assert files.inspect_fields([{"a": {"b": 1}, "c": [1.0]}, {"a": {"b": "x"}, "c": []}]) == {"a.b": "int | str", "c[]": "float"}


def test_monitor_table_and_structure(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("# action_type: absolute\n# joint_names: a,b\ntimestamp,obs_state_0,control_cmd_0\n0.1,1.0,2.0\n0.2,1.5,2.5\n")
    rows, notes = files.read_monitor(spark, str(path))
    assert rows.count() == 2 and dict(rows.dtypes)["timestamp"] == "double"
    assert {r.key: r.value for r in notes.collect()} == {"action_type": "absolute", "joint_names": "a,b"}
    lines = spark.createDataFrame([("t", i, json.dumps({"x": i if i else "s"})) for i in range(9)], "topic string, n long, p string")
    assert [tuple(r) for r in files.structure(lines, "topic", "n", "p", 3).collect()] == [("t", "x", "number | string")]
