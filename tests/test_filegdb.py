import datetime
import json
import struct

import numpy as np
import pytest

from sitespark.sources import filegdb


def unsigned(v):
    out = b""
    while v > 127:
        out, v = out + bytes([v & 127 | 128]), v >> 7
    return out + bytes([v])


def signed(v):
    first, rest = abs(v) & 63 | (64 if v < 0 else 0), abs(v) >> 6
    return bytes([first | (128 if rest else 0)]) + (unsigned(rest) if rest else b"")


def text(s):
    return bytes([len(s)]) + s.encode("utf-16-le")


SCALE, ORIGIN = 1000.0, (-5000.0, -7000.0)


def shape_bytes(rings, kind=5):
    if kind == 1:
        (x, y), = rings
        return unsigned(1) + unsigned(round((x - ORIGIN[0]) * SCALE) + 1) + unsigned(round((y - ORIGIN[1]) * SCALE) + 1)
    points = [np.round((np.array(r) - np.array(ORIGIN)) * SCALE).astype(int) for r in rings]
    every = np.concatenate(points)
    low, high = every.min(0), every.max(0)
    out = unsigned(kind) + unsigned(len(every)) + unsigned(len(rings)) + b"".join(map(unsigned, map(int, (*low, *(high - low))))) + b"".join(unsigned(len(p)) for p in points[:-1])
    return out + b"".join(signed(int(v)) for v in np.diff(every, axis=0, prepend=[[0, 0]]).ravel())


def write_table(folder, number, fields, rows, holes=()):
    """A table's two files, byte by byte. fields: (name, kind, nullable); rows: values in that order, None is null."""
    desc = struct.pack("<iIh", 4, 5 | 256, len(fields))
    for name, kind, nullable in fields:
        desc += text(name) + text("") + bytes([kind])
        if kind == 6:
            desc += bytes([4, 2])
        elif kind == 7:
            wkt = "PROJCS".encode("utf-16-le")
            desc += bytes([0, 6 | nullable]) + struct.pack("<h", len(wkt)) + wkt + bytes([0]) + struct.pack("<8d", *ORIGIN, SCALE, 0.001, 0, 0, 9, 9) + b"\0" + struct.pack("<id", 1, 0.0)
        elif kind == 4:
            desc += struct.pack("<i", 255) + bytes([4 | nullable]) + unsigned(2) + b"ab" if name == "Named" else struct.pack("<i", 255) + bytes([nullable, 0])
        elif kind in (8, 10, 11):
            desc += bytes([16, nullable])
        else:
            desc += bytes([4, nullable, 0])
    body, offsets = struct.pack("<i", len(desc)) + desc, []
    stored = [(k, nullable) for _, k, nullable in fields if k != 6]
    for i, row in enumerate(rows):
        if i in holes:
            offsets.append(0)
            continue
        bits = [v is None for v, (_, nullable) in zip(row, stored) if nullable]
        raw = sum(b << k for k, b in enumerate(bits)).to_bytes(-(-len(bits) // 8), "little")
        for v, (k, _) in zip(row, stored):
            if v is not None:
                raw += struct.pack(filegdb.FIXED[k], v) if k in filegdb.FIXED else v if k in (10, 11) else unsigned(len(v)) + v
        offsets.append(40 + len(body))
        body += struct.pack("<i", len(raw)) + raw
    (folder / f"a{number:08x}.gdbtable").write_bytes(struct.pack("<iiiiiiqq", 3, len(rows), 999, 5, 0, 0, 40 + len(body), 40) + body)
    blocks = -(-len(rows) // 1024)
    table = b"".join(o.to_bytes(5, "little") for o in offsets).ljust(blocks * 1024 * 5, b"\0")
    (folder / f"a{number:08x}.gdbtablx").write_bytes(struct.pack("<iiii", 3, blocks, len(rows), 5) + table + bytes(16))


FIELDS = [("OBJECTID", 6, 0), ("Shape", 7, 1), ("Named", 4, 1), ("Size", 3, 1), ("Code", 0, 0), ("Since", 5, 1), ("Guid", 10, 1)]


@pytest.fixture(scope="module")
def gdb(tmp_path_factory):
    folder = tmp_path_factory.mktemp("x.gdb")
    rows = []
    for k in range(5000):
        x, y = k * 1.5, (k // 1024) * 2000.0
        ring = [(x, y), (x + 2, y), (x + 2, y + 2), (x, y + 2), (x, y)]
        hole = [(x + 0.5, y + 0.5), (x + 0.5, y + 1), (x + 1, y + 1), (x + 0.5, y + 0.5)]
        rows.append((None if k % 11 == 3 else shape_bytes([ring, hole] if k % 2 else [ring]), None if k % 5 == 0 else f"é{k}".encode(), k / 8 if k % 3 else None, k % 300, 36526.5 if k % 7 else None, bytes(range(16)) if k % 4 else None))
    write_table(folder, 1, [("ID", 6, 0), ("Name", 4, 0), ("FileFormat", 1, 0)], [(b"GDB_SystemCatalog", 0), (b"GDB_DBTune", 0), (b"Wetlands", 0)])
    write_table(folder, 3, FIELDS, rows, holes={7, 1023, 1024, 4999})
    return str(folder)


def test_rows_of_a_layer(spark, gdb):
    assert filegdb.layers(gdb) == {"GDB_SystemCatalog": 1, "GDB_DBTune": 2, "Wetlands": 3}
    rows = {r["OBJECTID"]: r for r in filegdb.read_layer(spark, gdb, "Wetlands", blocks=2).collect()}
    assert set(rows) == {k + 1 for k in range(5000)} - {8, 1024, 1025, 5000}
    a, b = rows[2], rows[4]
    assert a["Named"] == "é1" and a["Size"] == 0.125 and a["Code"] == 1 and a["Guid"] == "{03020100-0504-0706-0809-0A0B0C0D0E0F}"
    assert a["Since"].replace(tzinfo=datetime.UTC) == datetime.datetime(2000, 1, 1, 12, tzinfo=datetime.UTC)
    assert [[(p["x"], p["y"]) for p in r] for r in a["rings"]] == [[(1.5, 0.0), (3.5, 0.0), (3.5, 2.0), (1.5, 2.0), (1.5, 0.0)], [(2.0, 0.5), (2.0, 1.0), (2.5, 1.0), (2.0, 0.5)]]
    assert (a["xmin"], a["ymin"], a["xmax"], a["ymax"]) == (1.5, 0.0, 3.5, 2.0) and b["xmin"] is None and b["rings"] == []
    assert rows[1]["Named"] is None and rows[1]["Since"] is None and rows[1]["Size"] is None


def test_a_box_plans_and_reads_its_blocks_only(spark, gdb, tmp_path):
    index = str(tmp_path / "blocks.json")
    filegdb.index_blocks(spark, gdb, "Wetlands", index)
    known = json.load(open(index))
    assert set(known) == {"0", "1", "2", "3", "4"} and known["1"][1] == 2000.0
    box = (3200.0, 3990.0, 3300.0, 4100.0)
    every = filegdb.read_layer(spark, gdb, "Wetlands")
    plain = lambda df: {(r["OBJECTID"], r["Named"], r["Size"]) for r in df.collect()}
    want = plain(every.filter(f"xmin + 0 <= {box[2]} and ymin + 0 <= {box[3]} and xmax + 0 >= {box[0]} and ymax + 0 >= {box[1]}"))
    assert 50 < len(want) < 80
    assert plain(filegdb.read_layer(spark, gdb, "Wetlands", box, index)) == want == plain(filegdb.read_layer(spark, gdb, "Wetlands", box))
    pushed = filegdb.read_layer(spark, gdb, "Wetlands", index=index, blocks=1).filter(f"xmin <= {box[2]} and ymin <= {box[3]} and xmax >= {box[0]} and ymax >= {box[1]}")
    assert plain(pushed) == want and pushed.rdd.getNumPartitions() == 1 and filegdb.read_layer(spark, gdb, "Wetlands", blocks=1).rdd.getNumPartitions() == 5
    assert filegdb.read_layer(spark, gdb, "Wetlands", (-99.0, -99.0, -90.0, -90.0), index).count() == 0


def test_points_and_numbers(spark, tmp_path):
    write_table(tmp_path, 1, [("ID", 6, 0), ("Name", 4, 0)], [(b"Cat",), (b"Places",)])
    write_table(tmp_path, 2, [("FID", 6, 0), ("Shape", 7, 1), ("N", 1, 0), ("S", 2, 1)], [(shape_bytes([(3.25, -4.5)], 1), -7, 0.5), (None, 8, None)])
    got = [tuple(r) for r in filegdb.read_layer(spark, str(tmp_path), "Places").orderBy("FID").collect()]
    assert got[0][:7] == (1, -7, 0.5, 3.25, -4.5, 3.25, -4.5) and got[0][7][0][0]["y"] == -4.5 and got[1][:3] == (2, 8, None)
    for v in (0, 1, -1, 63, 64, -64, 8191, -8192, 123456789):
        assert filegdb.Bytes(signed(v)).signed() == v and filegdb.Bytes(unsigned(abs(v))).unsigned() == abs(v)
