"""Recordings in the MCAP container format: a reader for Spark, a CDR decoder for the message types in use, and a small writer.

The format is public (magic, then records of opcode, length and content; chunks hold records, compressed or not).  The
reader plans one partition per file, decodes only wanted topics, and answers channel counts from a file's
statistics without reading messages.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

#: Fixed values of the format: file magic and record opcodes.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, STATISTICS, DATA_END = 1, 2, 3, 4, 5, 6, 11, 15

JOINT = "struct<name:array<string>,position:array<double>,velocity:array<double>,effort:array<double>>"
IMAGE = "struct<format:string,encoding:string,height:int,width:int,data:binary>"
SCHEMA_DDL = f"source_path string, episode string, topic string, schema_name string, seq long, log_time_ns long, publish_time_ns long, header_stamp_ns long, joint {JOINT}, multiarray array<double>, image {IMAGE}, error string"


class Broken(ValueError):
    """A file that isn't a readable recording."""


@dataclass
class Summary:
    """Channels of a file with their message counts."""

    channels: dict[int, tuple[str, str]] = field(default_factory=dict)
    counts: dict[int, int] = field(default_factory=dict)
    start_ns: int = 0
    end_ns: int = 0


def _text(data: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return data[at + 4 : at + 4 + n].decode("utf-8", "replace"), at + 4 + n


def _records(data: memoryview | bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(opcode, start, end) of the records in a range; a record that is cut off raises."""
    while at + 9 <= end:
        op, n = struct.unpack_from("<BQ", data, at)
        at += 9
        if at + n > end:
            raise Broken("a record is cut off")
        yield op, at, at + n
        at += n


def _chunk(data: bytes, at: int) -> bytes:
    """The records of a chunk, decompressed."""
    _, _, size, _ = struct.unpack_from("<QQQI", data, at)
    kind, at = _text(data, at + 28)
    (n,) = struct.unpack_from("<Q", data, at)
    body = data[at + 8 : at + 8 + n]
    if not kind:
        return body
    if kind == "lz4":
        return pa.decompress(body, decompressed_size=size, codec="lz4", asbytes=True)
    if kind == "zstd":
        return pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)
    raise Broken(f"unknown compression {kind!r}")


def read_messages(data: bytes, topics: set[str] | None = None) -> Iterator[tuple[str, str, int, int, int, bytes]]:
    """(topic, schema name, sequence, log time, publish time, payload) in file order, of the wanted topics."""
    if data[:8] != MAGIC:
        raise Broken("no recording")
    schemas: dict[int, str] = {}
    channels: dict[int, tuple[str, str]] = {}

    def walk(block: bytes, at: int, end: int) -> Iterator[tuple[str, str, int, int, int, bytes]]:
        for op, a, b in _records(block, at, end):
            if op == SCHEMA:
                (number,) = struct.unpack_from("<H", block, a)
                schemas[number] = _text(block, a + 2)[0]
            elif op == CHANNEL:
                number, schema = struct.unpack_from("<HH", block, a)
                channels[number] = (_text(block, a + 4)[0], schemas.get(schema, ""))
            elif op == MESSAGE:
                number, seq, log, publish = struct.unpack_from("<HIQQ", block, a)
                topic, name = channels.get(number, ("", ""))
                if topics is None or topic in topics:
                    yield topic, name, seq, log, publish, block[a + 22 : b]
            elif op == CHUNK:
                inner = _chunk(block, a)
                yield from walk(inner, 0, len(inner))
            elif op in (DATA_END, FOOTER):
                return

    yield from walk(data, 8, len(data))


def read_summary(path: str) -> Summary:
    """Channel counts from the end of the file alone; counts of 0 for channels without messages.  Raises if there is no summary."""
    with open(path, "rb") as f:
        f.seek(0, 2)
        size = f.tell()
        if size < 8 + 37:
            raise Broken("too short")
        f.seek(size - 37)
        tail = f.read()
        if tail[-8:] != MAGIC or tail[0] != FOOTER:
            raise Broken("no footer")
        (start,) = struct.unpack_from("<Q", tail, 9)
        if not start:
            raise Broken("no summary")
        f.seek(start)
        block = f.read(size - 37 - start)
    out, schemas = Summary(), {}
    for op, a, _ in _records(block, 0, len(block)):
        if op == SCHEMA:
            schemas[struct.unpack_from("<H", block, a)[0]] = _text(block, a + 2)[0]
        elif op == CHANNEL:
            number, schema = struct.unpack_from("<HH", block, a)
            out.channels[number] = (_text(block, a + 4)[0], schemas.get(schema, ""))
        elif op == STATISTICS:
            out.start_ns, out.end_ns, n = struct.unpack_from("<QQI", block, a + 26)
            for i in range(n // 10):
                number, count = struct.unpack_from("<HQ", block, a + 46 + 10 * i)
                out.counts[number] = count
    return out


class Cdr:
    """Little- or big-endian CDR payloads; alignment counts from after the 4 header bytes."""

    def __init__(self, data: bytes) -> None:
        if len(data) < 4:
            raise Broken("no payload")
        self.order = "<" if data[1] & 1 else ">"
        self.data, self.at = data, 4

    def _take(self, code: str, size: int) -> object:
        self.at += -(self.at - 4) % size
        (value,) = struct.unpack_from(self.order + code, self.data, self.at)
        self.at += size
        return value

    def u32(self) -> int:
        return self._take("I", 4)

    def i32(self) -> int:
        return self._take("i", 4)

    def u8(self) -> int:
        return self._take("B", 1)

    def text(self) -> str:
        n = self.u32()
        out = self.data[self.at : self.at + n - 1].decode("utf-8", "replace") if n else ""
        self.at += n
        return out

    def doubles(self) -> list[float]:
        n = self.u32()
        if not n:
            return []
        self.at += -(self.at - 4) % 8
        out = np.frombuffer(self.data, self.order + "f8", n, self.at).tolist()
        self.at += 8 * n
        return out

    def raw(self) -> bytes:
        n = self.u32()
        out = self.data[self.at : self.at + n]
        if len(out) < n:
            raise Broken("payload is cut off")
        self.at += n
        return out

    def stamp(self) -> int:
        seconds, nanos = self.i32(), self.u32()
        self.text()
        return seconds * 1_000_000_000 + nanos


def decode(schema: str, payload: bytes) -> tuple[int | None, dict | None, list[float] | None, dict | None]:
    """(header stamp, joint, multiarray, image) of a payload; all NULL for other types."""
    name = schema.replace("ros2msg://", "").replace("/msg/", "/")
    cdr = Cdr(payload)
    if name == "sensor_msgs/JointState":
        stamp = cdr.stamp()
        names = [cdr.text() for _ in range(cdr.u32())]
        return stamp, {"name": names, "position": cdr.doubles(), "velocity": cdr.doubles(), "effort": cdr.doubles()}, None, None
    if name == "std_msgs/Float64MultiArray":
        for _ in range(cdr.u32()):
            cdr.text()
            cdr.u32(), cdr.u32()
        cdr.u32()
        return None, None, cdr.doubles(), None
    if name == "sensor_msgs/CompressedImage":
        stamp, kind = cdr.stamp(), cdr.text()
        return stamp, None, None, {"format": kind, "encoding": None, "height": None, "width": None, "data": cdr.raw()}
    if name == "sensor_msgs/Image":
        stamp, height, width, encoding = cdr.stamp(), cdr.u32(), cdr.u32(), cdr.text()
        cdr.u8(), cdr.u32()
        return stamp, None, None, {"format": None, "encoding": encoding, "height": height, "width": width, "data": cdr.raw()}
    return None, None, None, None


@dataclass
class FilePartition(InputPartition):
    path: str


class McapReader(DataSourceReader):
    """One partition per file; filters on ``topic`` decide which messages are decoded."""

    def __init__(self, options: dict) -> None:
        self.root, self.mode = options["path"], options.get("mode", "messages")
        listed = options.get("topics")
        self.topics = set(listed.split(",")) if listed else None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) and f.attribute == ("topic",) else set(f.value) if isinstance(f, In) and f.attribute == ("topic",) else None
            if wanted is None:
                yield f
            else:
                self.topics = wanted if self.topics is None else self.topics & wanted

    def partitions(self) -> list[FilePartition]:
        return [FilePartition(p) for p in find_recordings(self.root)]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        path, episode = partition.path, Path(partition.path).parent.name
        if self.mode == "channels":
            try:
                s = read_summary(path)
            except (Broken, OSError, struct.error) as e:
                yield (path, episode, None, None, None, None, None, str(e))
                return
            for number, (topic, schema) in sorted(s.channels.items()):
                yield (path, episode, topic, schema, s.counts.get(number, 0), s.start_ns, s.end_ns, None)
            return
        try:
            for topic, schema, seq, log, publish, payload in read_messages(Path(path).read_bytes(), self.topics):
                try:
                    stamp, joint, array, image = decode(schema, payload)
                    error = None
                except (Broken, struct.error, ValueError) as e:
                    stamp = joint = array = image = None
                    error = f"payload: {e}"
                pack = lambda d, keys: None if d is None else tuple(d[k] for k in keys)
                yield (path, episode, topic, schema, seq, log, publish, stamp, pack(joint, ("name", "position", "velocity", "effort")), array, pack(image, ("format", "encoding", "height", "width", "data")), error)
        except (Broken, OSError, struct.error, pa.ArrowException) as e:
            yield (path, episode, None, None, None, None, None, None, None, None, None, f"file: {e}")


class McapSource(DataSource):
    """``spark.read.format("mcap").load(folder)``; option ``mode``: messages (default) or channels; ``topics``: comma-separated."""

    @classmethod
    def name(cls) -> str:
        return "mcap"

    def schema(self) -> str:
        if self.options.get("mode") == "channels":
            return "source_path string, episode string, topic string, schema_name string, messages long, start_ns long, end_ns long, error string"
        return SCHEMA_DDL

    def reader(self, schema: StructType) -> McapReader:
        return McapReader(dict(self.options))


def find_recordings(root: str) -> list[str]:
    """All ``*.mcap`` files below a folder (or the file itself), in path order."""
    p = Path(root)
    return [str(p)] if p.is_file() else sorted(str(x) for x in p.rglob("*.mcap"))


def read_recordings(spark: SparkSession, path: str, *, topics: list[str] | None = None, mode: str = "messages") -> DataFrame:
    """Messages (or channels) of all recordings below a path; a broken file or payload gives a row with ``error``."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(McapSource)
    reader = spark.read.format("mcap").option("mode", mode)
    if topics is not None:
        reader = reader.option("topics", ",".join(topics))
    return reader.load(path)


# Writing, for fixtures and exports ---------------------------------------------------------------------------------
def _string(text: str) -> bytes:
    raw = text.encode()
    return struct.pack("<I", len(raw)) + raw


def _record(op: int, body: bytes) -> bytes:
    return struct.pack("<BQ", op, len(body)) + body


class CdrWriter:
    """Little-endian CDR."""

    def __init__(self) -> None:
        self.out = bytearray(b"\x00\x01\x00\x00")

    def put(self, code: str, size: int, value: float) -> CdrWriter:
        self.out += b"\0" * (-(len(self.out) - 4) % size) + struct.pack("<" + code, value)
        return self

    def text(self, value: str) -> CdrWriter:
        raw = value.encode() + b"\0"
        self.put("I", 4, len(raw))
        self.out += raw
        return self

    def doubles(self, values: list[float]) -> CdrWriter:
        self.put("I", 4, len(values))
        for v in values:
            self.put("d", 8, v)
        return self

    def stamp(self, ns: int) -> CdrWriter:
        return self.put("i", 4, ns // 1_000_000_000).put("I", 4, ns % 1_000_000_000).text("")


def joint_payload(stamp_ns: int, names: list[str], position: list[float], velocity: list[float] | None = None, effort: list[float] | None = None) -> bytes:
    w = CdrWriter().stamp(stamp_ns).put("I", 4, len(names))
    for n in names:
        w.text(n)
    return bytes(w.doubles(position).doubles(velocity or []).doubles(effort or []).out)


def array_payload(values: list[float]) -> bytes:
    return bytes(CdrWriter().put("I", 4, 0).put("I", 4, 0).doubles(values).out)


def image_payload(stamp_ns: int, encoding: str, height: int, width: int, data: bytes) -> bytes:
    w = CdrWriter().stamp(stamp_ns).put("I", 4, height).put("I", 4, width).text(encoding).put("B", 1, 0).put("I", 4, width).put("I", 4, len(data))
    return bytes(w.out) + data


def compressed_payload(stamp_ns: int, kind: str, data: bytes) -> bytes:
    w = CdrWriter().stamp(stamp_ns).text(kind).put("I", 4, len(data))
    return bytes(w.out) + data


def write_recording(path: str, channels: list[tuple[str, str]], messages: list[tuple[int, int, int, bytes]], *, compression: str = "") -> None:
    """A recording with ``channels`` (topic, schema) and ``messages`` (channel place, log time, publish time, payload) in one chunk, with a summary."""
    head = b"".join(_record(SCHEMA, struct.pack("<H", i + 1) + _string(s) + _string("ros2msg") + struct.pack("<I", 0)) + _record(CHANNEL, struct.pack("<HH", i, i + 1) + _string(t) + _string("cdr") + struct.pack("<I", 0)) for i, (t, s) in enumerate(channels))
    body = head + b"".join(_record(MESSAGE, struct.pack("<HIQQ", c, n, log, pub) + payload) for n, (c, log, pub, payload) in enumerate(messages))
    times = [m[1] for m in messages] or [0]
    packed = pa.compress(body, codec=compression, asbytes=True) if compression else body
    chunk = struct.pack("<QQQI", min(times), max(times), len(body), 0) + _string(compression) + struct.pack("<Q", len(packed)) + packed
    out = MAGIC + _record(HEADER, _string("") + _string("tidelane")) + _record(CHUNK, chunk) + _record(DATA_END, struct.pack("<I", 0))
    counts = [sum(m[0] == i for m in messages) for i in range(len(channels))]
    stats = struct.pack("<QHIIIIQQI", len(messages), len(channels), len(channels), 0, 0, 1, min(times), max(times), 10 * len(channels)) + b"".join(struct.pack("<HQ", i, n) for i, n in enumerate(counts))
    summary = head + _record(STATISTICS, stats)
    Path(path).write_bytes(out + summary + _record(FOOTER, struct.pack("<QQI", len(out), 0, 0)) + MAGIC)
