"""Media columns held as MPEG transport streams.

``mux`` stores a byte payload losslessly as the access units of one private-data elementary stream;
``demux`` parses program tables, checks continuity counters, reassembles the elementary packets and
reports timestamps with random-access points. Both work on one stream in memory and keep no state.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textkit import slices
from lodestrata.llm.work import short_batches

PACKET, SYNC, PAT_PID, PMT_PID, ES_PID, PROGRAM = 188, 0x47, 0x0000, 0x1000, 0x0100, 1
STREAM_TYPE, STREAM_ID = 0x06, 0xBD  # private data in PES packets, private_stream_1
UNIT = 576  # bytes that the payload is a multiple of
AU_BYTES, AU_TICKS, RAP_EVERY = 4 * UNIT, 3600, 8  # an access unit, its 90 kHz ticks, and random-access points
PAD = 0xFF


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    """The sections' CRC: polynomial 04C11DB7, most significant bit first, no final inversion."""
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table: int, ident: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | (len(body) + 9)).to_bytes(2, "big") + ident.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


_PAT = _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
_PMT = _section(2, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")


def _table_packet(pid: int, section: bytes, counter: int) -> bytes:
    head = bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10 | counter & 15, 0])
    return (head + section).ljust(PACKET, b"\xff")


def _stamp(pts: int) -> bytes:
    return bytes([0x21 | (pts >> 29) & 14, (pts >> 22) & 255, (pts >> 14) & 254 | 1, (pts >> 7) & 255, (pts << 1) & 254 | 1])


def mux(payload: bytes) -> bytes:
    """The payload as a transport stream; the program tables come before every random-access point."""
    out, cc, tables = [], 0, 0
    for k, at in enumerate(range(0, len(payload), AU_BYTES)):
        unit = payload[at : at + AU_BYTES]
        rap, pts = k % RAP_EVERY == 0, (k * AU_TICKS) & (1 << 33) - 1
        if rap:
            out += (_table_packet(PAT_PID, _PAT, tables), _table_packet(PMT_PID, _PMT, tables))
            tables += 1
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (len(unit) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(pts) + unit
        first, pos, n = True, 0, len(pes)
        while pos < n:
            field = b""
            if first and rap:
                field = b"\x50" + (pts << 15 | 0x7E00).to_bytes(6, "big")
            room = PACKET - 4 - (len(field) + 1 if field else 0)
            part = pes[pos : pos + room]
            if len(part) < room or field:
                spare = PACKET - 4 - len(part) - 1
                field = (field or (b"\x00" if spare else b"")).ljust(spare, b"\xff")
                out.append(bytes([SYNC, (0x40 if first else 0) | ES_PID >> 8, ES_PID & 255, 0x30 | cc, spare]) + field + part)
            else:
                out.append(bytes([SYNC, (0x40 if first else 0) | ES_PID >> 8, ES_PID & 255, 0x10 | cc]) + part)
            cc, first, pos = (cc + 1) & 15, False, pos + len(part)
    return b"".join(out)


def _sections(buffer: bytearray) -> Iterator[bytes]:
    """Takes the complete sections from the front of a PID's section bytes; stuffing ends them."""
    while len(buffer) >= 3 and buffer[0] != 0xFF:
        size = 3 + ((buffer[1] & 15) << 8 | buffer[2])
        if len(buffer) < size:
            return
        yield bytes(buffer[:size])
        del buffer[:size]
    if buffer and buffer[0] == 0xFF:
        buffer.clear()


def demux(media: bytes) -> dict:
    """Parses a stream: payload, pts and rap by access unit, program tables and error counts.

    Packets without the sync byte count as sync errors, packets marked as damaged in transport as
    transport errors; both are passed over. Sections may span packets and share them; those whose
    CRC fails count as CRC errors. One repeat of a packet is dropped, as the format allows; any other
    jump of a counter counts as a continuity error, unless the packet announces a discontinuity, and
    a section that it cuts is given up.
    """
    out = {"packets": len(media) // PACKET, "sync_errors": int(len(media) % PACKET > 0), "crc_errors": 0, "cc_errors": 0, "transport_errors": 0, "programs": {}, "streams": {}}
    pmts, last, repeats, open_units, units, tables = set(), {}, {}, {}, [], {}

    def close(pid: int) -> None:
        parts, rap = open_units.pop(pid, (None, False))
        if parts is None:
            return
        pes = b"".join(parts)
        if pes[:3] != b"\x00\x00\x01" or len(pes) < 9:
            out["sync_errors"] += 1
            return
        size, head, pts = int.from_bytes(pes[4:6], "big"), 9 + pes[8], None
        if pes[7] & 0x80 and len(pes) >= 14:
            s = pes[9:14]
            pts = (s[0] >> 1 & 7) << 30 | s[1] << 22 | s[2] >> 1 << 15 | s[3] << 7 | s[4] >> 1
        units.append((pes[head : 6 + size if size else len(pes)], pts, rap))

    def table(pid: int, section: bytes) -> None:
        size = len(section)
        if section not in (_PAT, _PMT) and (size < 12 or crc32_mpeg(section)):
            out["crc_errors"] += 1
        elif pid == PAT_PID:
            for p in range(8, size - 4, 4):
                if number := section[p] << 8 | section[p + 1]:
                    pmts.add(own := (section[p + 2] & 31) << 8 | section[p + 3])
                    out["programs"][number] = own
        elif section[0] == 2:
            p = 12 + ((section[10] & 15) << 8 | section[11])
            while p + 5 <= size - 4:
                out["streams"][(section[p + 1] & 31) << 8 | section[p + 2]] = section[p]
                p += 5 + ((section[p + 3] & 15) << 8 | section[p + 4])

    for at in range(0, len(media) - PACKET + 1, PACKET):
        b1, flags = media[at + 1], media[at + 3]
        if media[at] != SYNC:
            out["sync_errors"] += 1
            continue
        if b1 & 0x80:
            out["transport_errors"] += 1
            continue
        pid, start, skip, rap, announced = (b1 & 31) << 8 | media[at + 2], b1 & 0x40, 4, False, False
        if flags & 0x20:
            size = media[at + 4]
            rap, announced = size > 0 and bool(media[at + 5] & 0x40), size > 0 and bool(media[at + 5] & 0x80)
            skip = 5 + size
        if not flags & 0x10 or skip >= PACKET:
            continue
        cc = flags & 15
        whole = True
        if pid in last and not announced:
            if cc == last[pid] and not repeats.get(pid):
                repeats[pid] = True
                continue
            if cc != (last[pid] + 1) & 15:
                out["cc_errors"] += 1
                whole = False
        last[pid], repeats[pid] = cc, False
        if pid == PAT_PID or pid in pmts:
            body = media[at + skip : at + PACKET]
            own = tables.setdefault(pid, bytearray())
            if not whole:
                own.clear()
            if start:
                first = 1 + body[0]
                if own:
                    own += body[1:first]
                    for section in _sections(own):
                        table(pid, section)
                    own.clear()
                own += body[first:]
            elif own:
                own += body
            else:
                continue
            for section in _sections(own):
                table(pid, section)
        elif pid in out["streams"]:
            if start:
                close(pid)
                open_units[pid] = ([], rap)
            if pid in open_units:
                open_units[pid][0].append(media[at + skip : at + PACKET])
    for pid in list(open_units):
        close(pid)
    return out | {"payload": b"".join(u[0] for u in units), "pts": [u[1] for u in units], "rap": [u[2] for u in units]}


def padded(data: bytes) -> bytes:
    """With bytes 255 up to a positive multiple of UNIT."""
    return data.ljust(max(1, -(-len(data) // UNIT)) * UNIT, bytes([PAD]))


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stream per row: id, n_bytes, media. A null text counts as empty and holds one unit of padding.

    Rows keep their number and order; other columns are not read, so their names cannot clash.
    """
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_bytes long, media binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                texts = [(t.as_py() or "").encode("utf-8") for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([mux(padded(t)) for t in texts], pa.binary())], [id_col, "n_bytes", "media"])

    short_batches(docs.sparkSession)
    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def read_media(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Parses column ``media``: payload facts, timestamps, random-access points and a feature string.

    A null or empty stream gives an empty payload and no units.
    """
    schema = (
        f"{id_col} {stored.schema[id_col].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
        "feature string, pts array<long>, random_access array<int>"
    )
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def one(media: bytes | None) -> tuple:
        media = media or b""
        x = demux(media)
        p, raps = x["payload"], [k for k, r in enumerate(x["rap"]) if r]
        stamps = [t for t in x["pts"] if t is not None]
        steps = {b - a for a, b in zip(stamps, stamps[1:], strict=False)}
        feature = (
            f"packets={x['packets']};programs={','.join(f'{k}:{v:#06x}' for k, v in sorted(x['programs'].items()))};streams={','.join(f'{k:#06x}:{v:#04x}' for k, v in sorted(x['streams'].items()))};"
            f"units={len(x['pts'])};random_access={len(raps)};pts={stamps[0] if stamps else ''}..{stamps[-1] if stamps else ''};step={','.join(map(str, sorted(steps)))};"
            f"errors={x['sync_errors']},{x['crc_errors']},{x['cc_errors']},{x['transport_errors']}"
        )
        return len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, x["pts"], raps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        for batch in batches:
            rows = [one(m.as_py()) for m in batch.column(2)]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names)

    return stored.select(id_col, "n_bytes", "media").mapInArrow(run, schema)
