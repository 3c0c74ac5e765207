"""TFRecord files of detection examples as a Spark data source.

Registered as ``spark.read.format("tfrecord")``.  One input partition per file;
each record is a length-delimited frame holding an ``Example`` message whose
int64 features ``index, shape, image, boxes, labels`` describe one image.
Rows: ``img_id, shape, pixels, boxes`` (boxes carry label and weight 1), plus
``_corrupt`` (NULL unless the frame is bad in PERMISSIVE mode).

The Example message is read from its wire format directly (no TensorFlow):
Features = map<string, Feature>; Feature = bytes_list | float_list | int64_list.
"""

from __future__ import annotations

import glob
import os
import struct
from typing import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = ("img_id bigint, shape array<int>, pixels binary, "
          "boxes array<struct<box_id:int,label:int,x_min:double,y_min:double,x_max:double,y_max:double,weight:double>>, "
          "_corrupt string")


# --- protobuf wire format -------------------------------------------------------------------------

def _varint(buf: bytes, pos: int) -> tuple[int, int]:
    out, shift = 0, 0
    while True:
        b = buf[pos]
        pos += 1
        out |= (b & 0x7F) << shift
        if b < 0x80:
            return out, pos
        shift += 7


def _fields(buf: bytes) -> Iterator[tuple[int, int, object]]:
    pos = 0
    while pos < len(buf):
        key, pos = _varint(buf, pos)
        num, wt = key >> 3, key & 7
        if wt == 0:
            v, pos = _varint(buf, pos)
        elif wt == 2:
            n, pos = _varint(buf, pos)
            v, pos = buf[pos:pos + n], pos + n
        elif wt == 5:
            v, pos = buf[pos:pos + 4], pos + 4
        elif wt == 1:
            v, pos = buf[pos:pos + 8], pos + 8
        else:
            raise ValueError(f"unsupported wire type {wt}")
        yield num, wt, v


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _int64_list(buf: bytes) -> list[int]:
    out = []
    for num, wt, v in _fields(buf):
        if num != 1:
            continue
        if wt == 2:  # packed
            p = 0
            while p < len(v):
                x, p = _varint(v, p)
                out.append(_signed(x))
        else:
            out.append(_signed(v))
    return out


def parse_example(buf: bytes) -> dict[str, list]:
    """Example bytes -> {feature name: values} (int64 and float lists; bytes as bytes)."""
    feats: dict[str, list] = {}
    for num, _, features in _fields(buf):
        if num != 1:
            continue
        for fnum, _, entry in _fields(features):
            if fnum != 1:
                continue
            name, value = None, b""
            for enum, _, ev in _fields(entry):
                if enum == 1:
                    name = ev.decode()
                elif enum == 2:
                    value = ev
            vals: list = []
            for knd, _, lst in _fields(value):
                if knd == 3:
                    vals = _int64_list(lst)
                elif knd == 2:
                    raw = _packed_floats(lst)
                    vals = list(struct.unpack(f"<{len(raw) // 4}f", raw))
                elif knd == 1:
                    vals = [x for (n, _, x) in _fields(lst) if n == 1]
            feats[name] = vals
    return feats


def _packed_floats(lst: bytes) -> bytes:
    """FloatList.value: packed (one length-delimited field) or one fixed32 field per value."""
    return b"".join(v for num, _, v in _fields(lst) if num == 1)


def _enc_varint(v: int) -> bytes:
    v &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = v & 0x7F
        v >>= 7
        if v:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _len_field(num: int, payload: bytes) -> bytes:
    return _enc_varint((num << 3) | 2) + _enc_varint(len(payload)) + payload


def build_example(features: dict[str, list[int]]) -> bytes:
    """Encode int64 features as an Example message (used by tests and writers)."""
    entries = b""
    for name, vals in features.items():
        packed = b"".join(_enc_varint(int(v)) for v in vals)
        feature = _len_field(3, _len_field(1, packed))
        entries += _len_field(1, _len_field(1, name.encode()) + _len_field(2, feature))
    return _len_field(1, entries)


# --- record framing --------------------------------------------------------------------------------

def iter_records(path: str) -> Iterator[tuple[bytes | None, str | None]]:
    """Frames: uint64 length, uint32 length CRC, data, uint32 data CRC (CRCs not verified)."""
    with open(path, "rb") as fh:
        while True:
            head = fh.read(12)
            if not head:
                return
            if len(head) < 12:
                yield None, "truncated header"
                return
            (n,) = struct.unpack("<Q", head[:8])
            data = fh.read(n)
            tail = fh.read(4)
            if len(data) < n or len(tail) < 4:
                yield None, "truncated record"
                return
            yield data, None


def write_records(path: str, payloads: list[bytes]) -> None:
    with open(path, "wb") as fh:
        for p in payloads:
            fh.write(struct.pack("<Q", len(p)) + b"\0\0\0\0" + p + b"\0\0\0\0")


def example_row(feats: dict[str, list]) -> tuple:
    labels = feats.get("labels", [])
    coords = feats.get("boxes", [])
    boxes = [(i + 1, int(labels[i]) if i < len(labels) else None, float(coords[4 * i]), float(coords[4 * i + 1]),
              float(coords[4 * i + 2]), float(coords[4 * i + 3]), 1.0) for i in range(len(coords) // 4)]
    img = feats.get("image", [])
    idx = feats.get("index", [None])
    return (idx[0], [int(x) for x in feats.get("shape", [])], bytes(bytearray(int(x) & 0xFF for x in img)), boxes, None)


class _FilePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class TFRecordReader(DataSourceReader):
    def __init__(self, paths: list[str], mode: str):
        self.paths = paths
        self.mode = mode

    def partitions(self):
        return [_FilePartition(p) for p in self.paths]

    def read(self, partition):
        for data, err in iter_records(partition.path):
            if err is not None:
                if self.mode == "FAILFAST":
                    raise ValueError(f"{partition.path}: {err}")
                yield (None, None, None, None, f"{partition.path}: {err}")
                continue
            try:
                yield example_row(parse_example(data))
            except Exception as e:  # noqa: BLE001
                if self.mode == "FAILFAST":
                    raise
                yield (None, None, None, None, f"{partition.path}: {e!r}")


class TFRecordDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        path = self.options.get("path")
        mode = self.options.get("mode", "FAILFAST").upper()
        if os.path.isdir(path):
            paths = sorted(p for p in glob.glob(os.path.join(path, "*")) if os.path.isfile(p))
        else:
            paths = sorted(glob.glob(path))
        if not paths:
            raise FileNotFoundError(f"no record file at {path}")
        return TFRecordReader(paths, mode)


def register(spark) -> None:
    spark.dataSource.register(TFRecordDataSource)


def scan_tfrecords(spark, path: str, mode: str = "FAILFAST"):
    """TFRecord files -> typed image/box rows."""
    register(spark)
    return spark.read.format("tfrecord").option("mode", mode).load(path)
