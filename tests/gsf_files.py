"""Synthetic survey logs for tests."""

import struct

_PING = struct.Struct(">iiiihhhhhiHhhhHHiii")


def record(kind, payload, summed=False):
    payload = (b"\0\0\0\0" if summed else b"") + payload
    return struct.pack(">II", len(payload), kind | (0x80000000 if summed else 0)) + payload + bytes(-len(payload) % 4)


def ping(seconds, lon, lat, arrays, flags=0, heading=0.0, scales=None):
    """arrays: id -> (width, signed, raw values); scales: id -> (multiplier, offset)."""
    n = len(next(iter(arrays.values()))[2]) if arrays else 0
    out = _PING.pack(seconds, 500_000_000, round(lon * 1e7), round(lat * 1e7), n, 0, flags, 0, 0, 0, round(heading * 100), 100, -200, 5, 0, 300, 1500, 0, 0) + b"\0\0"
    if scales:
        body = struct.pack(">i", len(scales)) + b"".join(struct.pack(">Iii", k << 24, *v) for k, v in scales.items())
        out += struct.pack(">I", 100 << 24 | len(body)) + body
    for k, (width, signed, raw) in arrays.items():
        body = b"".join(int(v).to_bytes(width, "big", signed=signed) for v in raw)
        out += struct.pack(">I", k << 24 | len(body)) + body
    return out


def text(s):
    return struct.pack(">h", len(s)) + s.encode()


SCALES = {1: (100, 0), 2: (10, 5), 3: (10, 0), 16: (1, 0), 6: (1, 0)}


def beams(n, flags=None, k=0):
    return {1: (2, False, [1000 + 10 * i + k for i in range(n)]), 2: (2, True, [100 * (i - 1) for i in range(n)]), 3: (2, True, [0] * n), **({16: (1, False, flags)} if flags else {})}


def whole_file():
    out = record(1, b"GSF-v03.09\0\0")
    out += record(2, ping(1000, 147.0, -43.0, beams(3, [0, 0, 1]), scales=SCALES), summed=True)
    out += record(2, ping(1001, 147.1, -43.0, beams(2, [0, 0], 1)))
    out += record(2, ping(1002, 147.2, -43.0, beams(1, [0], 2), flags=1))
    out += record(2, ping(1003, 147.3, -43.0, {**beams(4, [1, 0, 0, 0], 3), 6: (1, True, [1, 2, 3, 4])}, scales={**SCALES, 1: (10, 0)}))
    out += record(2, ping(1004, 147.4, -43.0, beams(2, None, 4)))
    out += record(12, struct.pack(">iih", 50, 0, 2) + struct.pack(">hhhhh", 250, 100, -100, 3, 9000) + struct.pack(">hhhhh", 500, 0, 0, 0, 0))
    out += record(3, struct.pack(">IIIIiiI", 10, 0, 20, 0, 1470000000, -430000000, 2) + struct.pack(">IIII", 100, 150000, 200, 149900))
    out += record(4, struct.pack(">iih", 5, 0, 3) + text("REFERENCE TIME=1970/001 00:00:10") + text("DRAFT TO APPLY=1.5,2.5") + text("ROLL COMPENSATED=YES"))
    out += record(6, struct.pack(">iii", 7, 0, 5) + b"hello\0")
    out += record(7, struct.pack(">ii", 8, 0) + text("box") + text("me") + text("run -x") + text("done"))
    out += record(9, struct.pack(">10i", 1000, 0, 1004, 0, -430000000, 1470000000, -420000000, 1480000000, 1000, 5000))
    return out
