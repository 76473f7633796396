"""MPEG audio columns: write bytes into Layer III frames, and parse frames, tags and seek tables.

``encode`` stores any payload losslessly: an ID3v2 tag with the payload's length and CRC-32, a frame with
a variable-bitrate table, then mono 32 kHz frames with CRC-16 protection whose side information declares no
audio bits, so all main-data bytes are ancillary bytes and carry the payload. ``parse`` reads any such
stream back frame by frame, resynchronising after foreign bytes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

# Fixed values of the format (ISO/IEC 11172-3, 13818-3), kbit/s by index, Hz by index.
BITRATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
UNIT = 64


def _crc_table() -> tuple[int, ...]:
    out = []
    for byte in range(256):
        r = byte << 8
        for _ in range(8):
            r = (r << 1 ^ 0x8005 if r & 0x8000 else r << 1) & 0xFFFF
        out.append(r)
    return tuple(out)


_CRC = _crc_table()


@lru_cache(4096)
def crc16(data: bytes) -> int:
    r = 0xFFFF
    for x in data:
        r = (r << 8 & 0xFFFF) ^ _CRC[r >> 8 ^ x]
    return r


@lru_cache(4096)
def header(word: bytes) -> tuple | None:
    """(length, samples, rate, side bytes, protected, version, layer, kbit/s) of a 4-byte frame header; None if it is none."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer, protected = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3), not word[1] & 1
    rate_at, kbit_at, pad = word[2] >> 2 & 3, word[2] >> 4, word[2] >> 1 & 1
    if version == 1 or layer == 4 or rate_at == 3 or kbit_at in (0, 15) or word[3] & 3 == 2:
        return None
    low, mono = version != 3, word[3] >> 6 == 3
    rate, kbit = RATES[version][rate_at], BITRATES[2 if low else 1, layer][kbit_at]
    if layer == 1:
        return (12000 * kbit // rate + pad) * 4, 384, rate, 0, protected, version, layer, kbit
    samples = 576 if layer == 3 and low else 1152
    side = ((9 if mono else 17) if low else (17 if mono else 32)) if layer == 3 else 0
    return samples // 8 * 1000 * kbit // rate + pad, samples, rate, side, protected, version, layer, kbit


@lru_cache(64)
def _prefix(kbit_at: int) -> tuple[bytes, int]:
    """Header, CRC and empty side information of a protected mono 32 kHz frame; the bytes left in it."""
    head, side = bytes((0xFF, 0xFA, kbit_at << 4 | 8, 0xC0)), bytes(17)
    return head + struct.pack(">H", crc16(head[2:] + side)) + side, header(head)[0] - 23


def _safe(n: int) -> bytes:
    return bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127))


def _text_frame(name: bytes, text: str) -> bytes:
    body = b"\x03" + text.encode()
    return name + _safe(len(body)) + b"\0\0" + body


def encode(payload: bytes) -> bytes:
    """The payload as one variable-bitrate MPEG-1 Layer III stream. Equal payloads give equal streams."""
    widest, room = _prefix(14)
    frames = [widest + payload[at : at + room] for at in range(0, len(payload) - len(payload) % room, room)]
    rest = payload[len(frames) * room :]
    if rest:
        prefix, n = next(x for x in map(_prefix, range(1, 15)) if x[1] >= len(rest))
        frames.append(prefix + rest + bytes(n - len(rest)))
    size = 1440
    total = size + sum(map(len, frames))
    starts, at = [], size
    for f in frames:
        starts.append(at)
        at += len(f)
    toc = bytes(min(255, (starts[len(starts) * k // 100] if starts else 0) * 256 // total) for k in range(100))
    xing = b"Xing" + struct.pack(">III", 15, len(frames), total) + toc + struct.pack(">I", 0)
    prefix, n = _prefix(14)
    tag = _text_frame(b"TXXX", f"payload_bytes\0{len(payload)}") + _text_frame(b"TXXX", f"payload_crc32\0{zlib.crc32(payload)}") + _text_frame(b"TLEN", str(len(frames) * 36))
    return b"ID3\x04\0\0" + _safe(len(tag)) + tag + prefix + xing + bytes(n - len(xing)) + b"".join(frames)


def _tags(data: bytes) -> tuple[int, dict[str, str]]:
    """Bytes of leading ID3v2 tags, and their text fields."""
    at, found = 0, {}
    while data[at : at + 3] == b"ID3" and len(data) >= at + 10:
        n = data[at + 6] << 21 | data[at + 7] << 14 | data[at + 8] << 7 | data[at + 9]
        p, end, v4 = at + 10, min(len(data), at + 10 + n), data[at + 3] >= 4
        while p + 10 <= end and data[p]:
            raw = data[p + 4 : p + 8]
            k = raw[0] << 21 | raw[1] << 14 | raw[2] << 7 | raw[3] if v4 else int.from_bytes(raw, "big")
            name, body = data[p : p + 4].decode("latin-1"), data[p + 10 : min(end, p + 10 + k)]
            if name[0] == "T" and body:
                text = body[1:].decode(("latin-1", "utf-16", "utf-16-be", "utf-8")[min(3, body[0])], "replace").rstrip("\0")
                key, _, value = text.partition("\0") if name == "TXXX" else (name, "", text)
                found[key] = value
            p += 10 + k
        at += 10 + n + (10 if data[at + 5] & 16 else 0)
    return min(at, len(data)), found


def vbri_table(frame: bytes, at: int) -> list[tuple[int, int]]:
    """(audio frame, byte offset in the stream) of every entry of the VBRI table in the frame that begins at ``at``; sizes there are
    scaled steps from the first audio frame on."""
    if len(frame) < 62:
        return []
    entries, scale, width, step = struct.unpack(">HHHH", frame[54:62])
    if not 1 <= width <= 4 or len(frame) < 62 + entries * width:
        return []
    out, offset = [(0, at + len(frame))], at + len(frame)
    for k in range(entries):
        offset += scale * int.from_bytes(frame[62 + k * width : 62 + (k + 1) * width], "big")
        out.append(((k + 1) * step, offset))
    return out


def parse(data: bytes, seeks: bool = False) -> dict:
    """Tags, frames and payload of a stream.

    A position is a frame if its header is sound and another frame, a trailing tag or the end follows; other
    bytes are skipped and counted (``skipped``). ``samples``/``rate`` give the exact duration of the audio
    frames; the table frame is not audio. ``seeks`` lists the byte offset of every audio frame, ``table`` the (frame, byte offset)
    entries of a VBRI seek table. ``bad_crc`` counts protected frames whose checksum is wrong; their payload is still returned.
    """
    at, tags = _tags(data)
    end = len(data) - (128 if data[-128:-125] == b"TAG" else 0)
    out = {"tags": tags, "frames": 0, "samples": 0, "rate": 0, "skipped": 0, "bad_crc": 0, "protected": 0, "vbr_frames": None, "vbr_bytes": None, "toc": None, "table": [], "kbits": {}, "seeks": []}
    parts, synced, first, audio = [], False, True, at
    while at + 4 <= end:
        h = header(data[at : at + 4])
        nxt = at + h[0] if h else 0
        if not h or nxt > end or (not synced and nxt != end and not header(data[nxt : nxt + 4])):
            step = data.find(b"\xff", at + 1, end)
            step = end if step < 0 else step
            out["skipped"] += step - at
            at, synced = step, False
            continue
        body = at + 4 + (2 if h[4] else 0)
        if h[4] and h[6] == 3:
            out["protected"] += 1
            out["bad_crc"] += crc16(data[at + 2 : at + 4] + data[body : body + h[3]]) != data[at + 4] << 8 | data[at + 5]
        main = body + h[3]
        if first and data[main : main + 4] in (b"Xing", b"Info"):
            flags, p = struct.unpack(">I", data[main + 4 : main + 8])[0], main + 8
            for bit, key in ((1, "vbr_frames"), (2, "vbr_bytes")):
                if flags & bit:
                    out[key] = struct.unpack(">I", data[p : p + 4])[0]
                    p += 4
            if flags & 4:
                out["toc"] = data[p : p + 100]
        elif first and data[at + 36 : at + 40] == b"VBRI":
            out["vbr_bytes"], out["vbr_frames"] = struct.unpack(">II", data[at + 46 : at + 54])
            out["table"] = vbri_table(data[at:nxt], at)
        else:
            out["frames"] += 1
            out["samples"] += h[1]
            out["rate"] = out["rate"] or h[2]
            out["kbits"][h[7]] = out["kbits"].get(h[7], 0) + 1
            parts.append(data[main:nxt])
            if seeks:
                out["seeks"].append(at)
        first, synced, at = False, True, nxt
    out["skipped"] += max(0, end - at)
    raw = b"".join(parts)
    n = tags.get("payload_bytes", "")
    out["payload"] = raw[: int(n)] if n.isdigit() else raw
    crc = tags.get("payload_crc32", "")
    out["sound"] = not out["bad_crc"] and (not crc.isdigit() or zlib.crc32(out["payload"]) == int(crc)) and out["vbr_frames"] in (None, out["frames"]) and out["vbr_bytes"] in (None, end - audio - out["skipped"])
    out["duration_ms"] = out["samples"] * 1000 / out["rate"] if out["rate"] else 0.0
    return out


def features(p: dict) -> str:
    """The features of a parsed stream as one text."""
    offsets = struct.pack(f"<{len(p['seeks'])}Q", *p["seeks"])
    return f"mpeg1-l3;rate={p['rate']};frames={p['frames']};samples={p['samples']};ms={p['duration_ms']:.3f};crc_ok={p['protected'] - p['bad_crc']};vbr={p['vbr_frames']};skipped={p['skipped']};seek_crc={zlib.crc32(offsets)};toc_crc={zlib.crc32(p['toc'] or b'')};sound={int(p['sound'])}"


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw)), len(raw)


def digest(docs: DataFrame) -> DataFrame:
    """Each text stored as an MPEG stream and read back: sizes, checksums, features, exact duration and the byte offset of every frame.

    Null and empty texts give one unit of zero bytes; repeated rows give equal rows; an empty table an empty
    result; only doc_id and text are read. Memory is bounded by the longest text of an Arrow batch.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                payload, n = padded(text if isinstance(text, str) else None)
                stored = encode(payload)
                parsed = parse(stored, seeks=True)
                back = parsed["payload"]
                if back != payload:
                    raise ValueError("the stored payload differs")
                rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), features(parsed), parsed["duration_ms"], parsed["seeks"]))
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "duration_ms", "seek_offsets"])], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, duration_ms double, seek_offsets array<long>")
