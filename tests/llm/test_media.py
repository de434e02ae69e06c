from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np

from geogrid.llm import media
from geogrid.llm.queries import op1_mjpeg
from tests.llm.cases import SCHEMA, clashing, rows


def padded(text):
    b = (text or "").encode()
    return b, b + b"\0" * (-len(b) % 64 if b else 64)


def test_payloads_come_back(spark):
    df = clashing(spark.createDataFrame(rows(), SCHEMA))
    got = media.read_avi(media.to_avi(df), carry=("n_bytes", "media")).collect()
    want = {r[0]: padded(r[1]) for r in rows()}
    assert len(got) == len(want)
    for r in got:
        raw, p = want[r["doc_id"]]
        assert (r["n_bytes"], bytes(r["payload"])) == (len(raw), p)
        assert r["payload_sha256"] == hashlib.sha256(p).hexdigest() and r["tail_crc32"] == zlib.crc32(p[-64:])
        assert r["media_sha256"] == hashlib.sha256(bytes(r["media"])).hexdigest()
        assert r["clips"][0]["first_frame"] == 0 and r["clips"][-1]["last_frame"] == r["n_frames"] - 1


def test_query_and_empty_table(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_mjpeg(spark, str(tmp_path)).collect()
    same = {}
    for r in got:
        same.setdefault(r["payload_sha256"], set()).add((r["media_sha256"], r["feature"]))
    assert all(len(v) == 1 for v in same.values())
    empty = spark.createDataFrame([], SCHEMA)
    assert media.read_avi(media.to_avi(empty)).count() == 0


def test_binary_payload_and_null_media(spark):
    df = spark.createDataFrame([(1, bytearray(range(256)))], "doc_id long, text binary")
    assert bytes(media.read_avi(media.to_avi(df)).first()["payload"]) == bytes(range(256))
    assert media.read_avi(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first()["payload"] is None


def test_every_byte_value_and_marker(spark):
    for payload in (b"\xff" * 640, bytes(range(256)) * 20, b"\0" * 64, np.random.default_rng(1).bytes(64 * 131)):
        frames, _, size = media.parse_avi(media.write_avis([payload])[0])
        assert b"".join(x.tobytes() for x in media.decode_frames(frames))[:size] == payload


def test_index_order_and_files_without_index():
    avi = media.write_avis([bytes(range(64)) * 64 * 3])[0]
    frames, rate, _ = media.parse_avi(avi)
    assert (len(frames), rate) == (3, 25.0)
    cut = avi[: avi.index(b"idx1", avi.index(b"movi"))]
    assert media.parse_avi(cut)[0] == frames


def test_shots_find_the_change():
    dark, light = np.full((8, 8), 20, np.uint8), np.full((8, 8), 220, np.uint8)
    clips = media.shots([dark] * 10 + [light] * 6, 25.0)
    assert [(c["first_frame"], c["last_frame"], c["start_s"], c["end_s"]) for c in clips] == [(0, 9, 0.0, 0.4), (10, 15, 0.4, 0.64)]
    assert media.shots([], 25.0) == [] and len(media.shots([dark] * 30, 25.0)) == 1


def _baseline_jpeg(blocks: np.ndarray, restart: int, standard: bool = False) -> bytes:
    """A grey baseline JPEG of quantized coefficients in zigzag order, written bit by bit; with ``standard`` by the
    standard tables and without a DHT."""
    bits_dc, values_dc = [0, 0, 0, 12] + [0] * 12, list(range(12))
    bits_ac = [0] * 7 + [200] + [0] * 8
    values_ac = [r << 4 | s for r in range(16) for s in range(1, 11)] + [0, 0xF0]
    values_ac += [v for v in range(256) if v not in values_ac][: 200 - len(values_ac)]
    dc, ac = (media._canonical(np.array(b), np.array(v)) for b, v in ((bits_dc, values_dc), (bits_ac, values_ac)))
    if standard:
        dc, ac = (media._canonical(*media._STANDARD[k]) for k in (0x00, 0x10))

    def put(out, code, n):
        out += format(code, f"0{n}b") if n else ""
        return out

    def value(v):
        n = int(abs(v)).bit_length()
        return n, (v if v > 0 else v + (1 << n) - 1)

    data, previous, out = b"", 0, ""

    def flush(out):
        out += "1" * (-len(out) % 8)
        raw = int(out, 2).to_bytes(len(out) // 8, "big") if out else b""
        return raw.replace(b"\xff", b"\xff\0")

    for k, block in enumerate(blocks.tolist()):
        if restart and k and k % restart == 0:
            data += flush(out) + bytes([0xFF, 0xD0 + (k // restart - 1) % 8])
            out, previous = "", 0
        n, x = value(block[0] - previous)
        previous = block[0]
        out = put(put(out, int(dc[0][n]), int(dc[1][n])), x, n)
        run = 0
        last = max([i for i in range(1, 64) if block[i]], default=0)
        for i in range(1, last + 1):
            if block[i] == 0:
                run += 1
                continue
            while run > 15:
                out, run = put(out, int(ac[0][0xF0]), int(ac[1][0xF0])), run - 16
            n, x = value(block[i])
            out = put(put(out, int(ac[0][run << 4 | n]), int(ac[1][run << 4 | n])), x, n)
            run = 0
        if last < 63:
            out = put(out, int(ac[0][0]), int(ac[1][0]))
    data += flush(out)
    head = b"\xff\xd8" + media._marker(0xDB, bytes([0] + [2] * 64)) + media._marker(0xC0, struct.pack(">BHHB3B", 8, 16, 24, 1, 1, 0x11, 0))
    if not standard:
        head += media._marker(0xC4, bytes([0, *bits_dc, *values_dc])) + media._marker(0xC4, bytes([0x10, *bits_ac, *values_ac]))
    if restart:
        head += media._marker(0xDD, struct.pack(">H", restart))
    return head + media._marker(0xDA, bytes([1, 1, 0, 0, 63, 0])) + data + b"\xff\xd9"


def test_baseline_frames_decode_as_the_transform_says():
    rng = np.random.default_rng(4)
    blocks = np.zeros((6, 64), int)
    blocks[:, 0] = rng.integers(-200, 200, 6)
    for b in blocks:
        b[rng.integers(1, 64, 5)] = rng.integers(-40, 40, 5)
    x = np.arange(8)
    basis = np.array([[np.sqrt((1 if u else 0.5) / 4) * np.cos((2 * i + 1) * u * np.pi / 16) for u in range(8)] for i in x])
    want = np.zeros((16, 24), np.uint8)
    for k, b in enumerate(blocks):
        coefficients = np.zeros(64)
        coefficients[media.ZIGZAG] = b * 2
        tile = np.clip(np.rint(basis @ coefficients.reshape(8, 8) @ basis.T + 128), 0, 255)
        want[8 * (k // 3) : 8 * (k // 3) + 8, 8 * (k % 3) : 8 * (k % 3) + 8] = tile
    for restart in (0, 1, 2, 4):
        for standard in (False, True):
            got = media.decode_frames([_baseline_jpeg(blocks, restart, standard)] * 2)
            assert all((g == want).all() for g in got)


def test_standard_tables_are_whole():
    for number, (bits, values) in media._STANDARD.items():
        assert bits.sum() == len(values) == len(set(values.tolist())) == (162 if number & 0x10 else 12)
        assert sum(int(n) / 2 ** (k + 1) for k, n in enumerate(bits)) < 1


def _parts(frames: list[bytes], with_index: bool) -> bytes:
    """An AVI of two RIFF parts, the second an AVIX, with a ``rec `` list; frames of the first part are indexed by idx1."""
    avi = media._avi(frames[:2], 16, 0)
    own = avi if with_index else media._riff(b"RIFF", avi[8 : avi.index(b"idx1", avi.index(b"movi"))])
    rec = media._riff(b"LIST", b"rec " + media._riff(b"00dc", frames[2]) + media._riff(b"01wb", b"sound"))
    return own + media._riff(b"RIFF", b"AVIX" + media._riff(b"LIST", b"movi" + rec + media._riff(b"00dc", frames[3])))


def test_all_riff_parts_and_standard_indexes():
    frames = [bytes([k]) * (20 + k) for k in range(4)]
    for with_index in (True, False):
        assert media.parse_avi(_parts(frames, with_index))[0] == frames
    # indx: an index of ix00 chunks, which list frames in another order than they stand in.
    body, at, places = b"movi", 0, []
    strl = lambda indx: media._riff(b"LIST", b"strl" + media._riff(b"strh", struct.pack("<4s4sIHHIII", b"vids", b"MJPG", 0, 0, 0, 0, 1, 30) + b"\0" * 24) + media._riff(b"indx", indx))
    indx = lambda at, n: struct.pack("<HBBI4sQI", 4, 0, 0, 1, b"00dc", 0, 0) + struct.pack("<QII", at, n, 4)
    head = media._riff(b"LIST", b"hdrl" + strl(indx(0, 0)))
    start = 12 + len(head) + 8
    for f in frames:
        places.append((start + len(body) + 8, len(f)))
        body += media._riff(b"00dc", f)
    entries = b"".join(struct.pack("<II", *places[k]) for k in (2, 0, 3, 1))
    ix_at = start + len(body)
    ix = media._riff(b"ix00", struct.pack("<HBBI4sQI", 2, 0, 1, 4, b"00dc", 0, 0) + entries)
    head = media._riff(b"LIST", b"hdrl" + strl(indx(ix_at, len(ix))))
    data = media._riff(b"RIFF", b"AVI " + head + media._riff(b"LIST", body + ix))
    assert media.parse_avi(data) == ([frames[k] for k in (2, 0, 3, 1)], 30.0, None)


def test_bad_files_do_not_fail_the_others(spark):
    good = media.write_avis([b"some text " * 64])[0]
    grey = media._avi([_baseline_jpeg(np.ones((6, 64), int), 0, True)], 16, 384)
    at = good.index(b"\xff\xda")
    bad = [b"", b"RIFF", b"not an avi at all", good[:at], good[: at + 40], good.replace(b"\xff\xc3", b"\xff\xc2"), good.replace(b"\xff\xd8\xff", b"\xff\xd8\0"), media._avi([b"\xff\xd8\xff"], 1, 0)]
    df = spark.createDataFrame([(i, bytearray(m)) for i, m in enumerate([good, *bad, grey, good])] + [(99, None)], "doc_id long, media binary")
    got = {r["doc_id"]: r for r in media.read_avi(clashing(df)).collect()}
    for i in (0, len(bad) + 2):
        assert bytes(got[i]["payload"]) == b"some text " * 64 and got[i]["error"] is None
    assert got[len(bad) + 1]["n_frames"] == 1 and got[len(bad) + 1]["error"] is None
    failed = [i for i in range(1, len(bad) + 1) if got[i]["error"]]
    # Cut before or in its frames, a file without an index still parses; then a frame ends early.
    assert failed == list(range(1, len(bad) + 1))
    assert all(got[i]["payload"] is None and len(got[i]["media_sha256"]) == 64 for i in failed)
    assert got[99]["payload"] is None and got[99]["error"] is None


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "doc_id long, text string")
    assert media.read_avi(media.to_avi(df)).select("payload_sha256").distinct().count() == 2 and media.read_avi(media.to_avi(df)).count() == 3


def test_clip_rows(spark):
    df = spark.createDataFrame([(1, "ab" * 6000)], "doc_id long, text string")
    got = media.clip_rows(media.read_avi(media.to_avi(df))).collect()
    assert got[0]["clip"] == 0 and got[-1]["end_s"] == 0.12
