"""Sources that read sequence files by byte ranges: FASTQ text and BAM.

A file is cut into ranges of ``split`` bytes. A task reads the records that begin
in its range, so every record is read once, whatever the range; the first one is
found by the shape of a record, never by a single character (qualities may hold
any). Files that cannot be cut (gzip) are one task each. Files are opened through
Arrow's file systems, so any store that Arrow reaches will do.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from strandframe.sources.package import ship

FASTQ = "read_id string, description string, seq string, quals array<int>"
ALIGNED = "read_id string, reference_name string, ref_start int, flag int, cigar string, query_seq string, quals array<int>, bc string, nm int"
SPLIT, CHUNK, ROWS = 128 << 20, 4 << 20, 8192
_BGZF = b"\x1f\x8b\x08\x04"
# Letters of the 4-bit bases and of the operations of a binary alignment, and the empty block that ends a file.
BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
# Fixed values too: the bin number that holds statistics, and that of reads without a place. BLOCK is how much a written block takes.
STATISTICS, UNPLACED, BLOCK = 37450, 4680, 60_000
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Range(InputPartition):
    """Bytes of a file; the first record is at exact, a virtual offset, where that is known."""

    def __init__(self, path: str, lo: int, hi: int, exact: int | None = None):
        self.path, self.lo, self.hi, self.exact = path, lo, hi, exact


class Ranges(DataSourceReader):
    """Byte ranges of all files; subclasses read one."""

    endings: tuple[str, ...] = ()

    def __init__(self, options: dict):
        self.paths, self.split = json.loads(options["paths"]), int(options.get("split", SPLIT))

    def files(self) -> Iterator[tuple[str, int]]:
        for path in self.paths:
            store, inner = opened(path)
            info = store.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            if info.is_file:
                yield path, info.size
                continue
            for found in sorted(store.get_file_info(fs.FileSelector(inner)), key=lambda i: i.path):
                if found.is_file and found.path.endswith(self.endings):
                    yield path.rstrip("/") + "/" + found.base_name, found.size

    def partitions(self) -> list[Range]:
        return [Range(p, lo, min(n, lo + step)) for p, n in self.files() if n for step in [n if p.endswith(".gz") else self.split] for lo in range(0, n, step)]


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values.astype(np.int32)))


class FastqReader(Ranges):
    endings = (".fastq", ".fq", ".fastq.gz", ".fq.gz", ".txt", ".txt.gz")

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, path = opened(partition.path)
        with store.open_input_stream(path) if path.endswith(".gz") else store.open_input_file(path) as file:
            lo = 0 if path.endswith(".gz") else partition.lo
            limit = None if path.endswith(".gz") else partition.hi
            if lo:
                file.seek(lo - 1)
            data, at = file.read(CHUNK), max(lo - 1, 0)
            if lo:
                # The range owns the records whose first byte is in it.
                skip, data = self.first(file, data)
                data, at = data[skip:], at + skip
            while data and (limit is None or at < limit):
                more = file.read(CHUNK)
                lines = data.split(b"\n")
                if more:
                    whole = (len(lines) - 1) // 4 * 4
                else:
                    whole = len(lines) - (lines[-1] == b"")
                    whole -= whole % 4
                if whole:
                    sizes = np.array([len(x) + 1 for x in lines[:whole]], np.int64).reshape(-1, 4).sum(axis=1)
                    begins = at + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                    count = len(begins) if limit is None else int(np.searchsorted(begins, limit, "left"))
                    if count:
                        yield self.batch(lines[: count * 4])
                    if count < len(begins):
                        return
                    at += int(sizes.sum())
                data = b"\n".join(lines[whole:]) + more
                if not more:
                    return

    @staticmethod
    def first(file, data: bytes) -> tuple[int, bytes]:
        """Place of the first record behind the first line break, and the data read so far.

        A record is a line with @, one of bases, one with +, and one as long as the bases.
        """
        while True:
            at, done = data.find(b"\n") + 1, False
            while at:
                four = data[at : at + (1 << 16)].split(b"\n", 4)
                if len(four) < 4 or (len(four) == 4 and len(data) - at > 1 << 16):
                    four = data[at:].split(b"\n", 4)
                ends = len(four) > 4 or (len(four) == 4 and done)
                if ends and four[0][:1] == b"@" and four[2][:1] == b"+" and len(four[1].rstrip(b"\r")) == len(four[3].rstrip(b"\r")):
                    return at, data
                if not ends:
                    break
                at = data.find(b"\n", at) + 1
            more = file.read(CHUNK)
            if not more:
                return FastqReader.last(data)
            data += more

    @staticmethod
    def last(data: bytes) -> tuple[int, bytes]:
        """The same at the end of a file whose last line may lack its break."""
        at = data.find(b"\n") + 1
        while at:
            four = data[at:].split(b"\n")
            if len(four) >= 4 and four[0][:1] == b"@" and four[2][:1] == b"+" and len(four[1].rstrip(b"\r")) == len(four[3].rstrip(b"\r")):
                return at, data
            at = data.find(b"\n", at) + 1
        return len(data), data

    @staticmethod
    def batch(lines: list[bytes]) -> pa.RecordBatch:
        clean = [x.rstrip(b"\r") for x in lines]
        heads = [h[1:].decode().split(" ", 1) for h in clean[0::4]]
        quals = np.frombuffer(b"".join(clean[3::4]), np.uint8).astype(np.int32) - 33
        columns = [
            pa.array([h[0] for h in heads], pa.string()), pa.array([h[1] if len(h) > 1 else None for h in heads], pa.string()),
            pa.array([s.decode() for s in clean[1::4]], pa.string()), lists(quals, np.cumsum([len(q) for q in clean[3::4]])),
        ]
        return pa.RecordBatch.from_arrays(columns, ["read_id", "description", "seq", "quals"])


class Blocks:
    """The decompressed stream of a BGZF file from a block on, with the block that every byte comes from."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.at = file, size, at
        self.data, self.gone, self.marks = bytearray(), 0, []  # marks: (place in the stream, block)

    def more(self) -> bool:
        while self.at < self.size:
            length = block_size(self.file, self.at, self.size)
            if length is None:
                raise ValueError(f"no BGZF block at {self.at}")
            self.file.seek(self.at)
            raw = self.file.read(length)
            extra = struct.unpack_from("<H", raw, 10)[0]
            payload = zlib.decompress(raw[12 + extra : -8], -15)
            mark, self.at = (self.gone + len(self.data), self.at), self.at + length
            if payload:
                self.marks.append(mark)
                self.data += payload
                return True
        return False

    def fill(self, at: int, n: int) -> bool:
        while self.gone + len(self.data) < at + n:
            if not self.more():
                return False
        return True

    def get(self, at: int, n: int) -> memoryview:
        return memoryview(self.data)[at - self.gone : at - self.gone + n]

    def block_of(self, at: int) -> int:
        return next(b for place, b in reversed(self.marks) if place <= at)

    def forget(self, at: int) -> None:
        if at - self.gone > CHUNK:
            self.data, self.gone = self.data[at - self.gone :], at
            keep = max(k for k, (place, _) in enumerate(self.marks) if place <= at)
            self.marks = self.marks[keep:]


def block_size(file, at: int, size: int) -> int | None:
    """Bytes of the BGZF block at a place, null if there is none."""
    file.seek(at)
    head = file.read(min(512, size - at))
    if len(head) < 18 or head[:4] != _BGZF:
        return None
    extra, k = struct.unpack_from("<H", head, 10)[0], 12
    while k + 4 <= min(len(head), 12 + extra):
        name, length = head[k : k + 2], struct.unpack_from("<H", head, k + 2)[0]
        if name == b"BC" and length == 2:
            total = struct.unpack_from("<H", head, k + 4)[0] + 1
            return total if at + total <= size else None
        k += 4 + length
    return None


def first_block(file, lo: int, size: int) -> int:
    """The first BGZF block from a place on: one that another follows, or the end of the file."""
    at = lo
    while at < size:
        file.seek(at)
        window = file.read(CHUNK)
        k = window.find(_BGZF)
        while k >= 0:
            length = block_size(file, at + k, size)
            if length and (at + k + length == size or block_size(file, at + k + length, size)):
                return at + k
            k = window.find(_BGZF, k + 1)
        at += max(1, len(window) - len(_BGZF) + 1)
    return size


class BamReader(Ranges):
    """Files with an index beside them (``.bai``) are read only where the wanted references are; records of others are not decoded."""

    endings = (".bam",)

    def __init__(self, options: dict):
        super().__init__(options)
        self.wanted: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("reference_name",):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = names if self.wanted is None else self.wanted & names
            else:
                yield f

    def partitions(self) -> list[Range]:
        if self.wanted is None:
            return super().partitions()
        out = []
        for path, size in self.files():
            places = self.places(path)
            for beg, end in [(0, size << 16)] if places is None else places:
                lo, hi = beg >> 16, (end >> 16) + (end & 0xFFFF > 0)
                out += [Range(path, at, min(hi, at + self.split), beg if at == lo and beg else None) for at in range(lo, hi, self.split)]
        return out

    def places(self, path: str) -> list[tuple[int, int]] | None:
        """Virtual offsets of the wanted references in a file that has an index; reads without a place are in no index."""
        store, inner = opened(path)
        if "*" in self.wanted or store.get_file_info(inner + ".bai").type == fs.FileType.NotFound:
            return None
        with store.open_input_file(inner + ".bai") as file, store.open_input_file(inner) as bam:
            spans = index_spans(file.read())
            names, _ = self.header(Blocks(bam, bam.size(), 0))
        out: list[tuple[int, int]] = []
        for beg, end in sorted(span for name, span in zip(names, spans, strict=False) if name in self.wanted and span):
            # References that share a block are one range: its records are read once.
            if out and beg >> 16 <= out[-1][1] >> 16:
                out[-1] = (out[-1][0], max(end, out[-1][1]))
            else:
                out.append((beg, end))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes where there are no ranges
            return
        store, path = opened(partition.path)
        with store.open_input_file(path) as file:
            size = file.size()
            stream = Blocks(file, size, 0)
            references, at = self.header(stream)
            ids = None if self.wanted is None else {k for k, name in enumerate(references) if name in self.wanted} | ({-1} if "*" in self.wanted else set())
            if partition.exact is not None:
                stream, at = Blocks(file, size, partition.exact >> 16), partition.exact & 0xFFFF
            elif partition.lo:
                stream = Blocks(file, size, first_block(file, partition.lo, size))
                at = self.first(stream, len(references))
            rows = []
            while at is not None and stream.fill(at, 4) and stream.block_of(at) < partition.hi:
                length = struct.unpack("<i", stream.get(at, 4))[0]
                if not stream.fill(at + 4, length):
                    raise ValueError(f"{path} ends inside a record")
                if ids is None or struct.unpack("<i", stream.get(at + 4, 4))[0] in ids:
                    rows.append(record(bytes(stream.get(at + 4, length)), references))
                at += 4 + length
                stream.forget(at)
                if len(rows) == ROWS:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)

    @staticmethod
    def header(stream: Blocks) -> tuple[list[str], int]:
        number = lambda at: struct.unpack("<i", stream.get(at, 4))[0] if stream.fill(at, 4) else 0
        if not stream.fill(0, 8) or bytes(stream.get(0, 4)) != b"BAM\x01":
            raise ValueError("not a BAM file")
        at, names = 8 + number(4), []
        count, at = number(at), at + 4
        for _ in range(count):
            length = number(at)
            stream.fill(at + 4, length + 4)
            names.append(bytes(stream.get(at + 4, length - 1)).decode())
            at += 8 + length
        return names, at

    @staticmethod
    def first(stream: Blocks, references: int) -> int | None:
        """The first place from which a chain of four plausible records, or of all to the end of the file, starts."""
        at = 0
        while stream.fill(at, 4):
            place = at
            for _ in range(4):
                if not stream.fill(place, 4):
                    break
                length = plausible(stream, place, references)
                if length is None:
                    break
                place += 4 + length
            else:
                return at
            if place > at and not stream.fill(place, 1):
                return at
            at += 1
        return None


def plausible(stream: Blocks, at: int, references: int) -> int | None:
    """The length of the record at a place if its fixed fields agree with each other."""
    if not stream.fill(at, 36):
        return None
    length, ref, pos, name, _, _, ops, _, bases, other, other_pos, _ = struct.unpack("<iiiBBHHHiiii", stream.get(at, 36))
    known = -1 <= ref < references and -1 <= other < references and pos >= -1 and other_pos >= -1 and name >= 1 and bases >= 0
    if not known or not 32 + name + 4 * ops + (bases + 1) // 2 + bases <= length <= 1 << 28 or not stream.fill(at + 36, name + 4 * ops):
        return None
    text = bytes(stream.get(at + 36, name))
    if text[-1] or not all(33 <= c <= 126 for c in text[:-1]):
        return None
    codes = np.frombuffer(bytes(stream.get(at + 36 + name, 4 * ops)), "<u4") & 15
    return length if (codes < len(OPS)).all() and stream.fill(at + 4, length) else None


_PAIRS = [a + b for a in BASES for b in BASES]
_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_INTS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}


def record(raw: bytes, references: list[str]) -> tuple:
    ref, pos, name, _, _, ops, flag, bases = struct.unpack_from("<iiBBHHHi", raw)
    at = 32 + name
    cigar = "".join(f"{c >> 4}{OPS[c & 15]}" for c in struct.unpack_from(f"<{ops}I", raw, at)) or "*"
    at += 4 * ops
    half = (bases + 1) // 2
    seq = "".join([_PAIRS[b] for b in raw[at : at + half]])[:bases] or "*"
    quals = raw[at + half : at + half + bases]
    at += half + bases
    tags = {}
    while at + 3 <= len(raw):
        key, kind, at = raw[at : at + 2], chr(raw[at + 2]), at + 3
        if kind in "ZH":
            end = raw.index(0, at)
            tags[key], at = raw[at:end].decode(), end + 1
        elif kind == "B":
            at += 5 + _SIZES[chr(raw[at])] * struct.unpack_from("<i", raw, at + 1)[0]
        else:
            if kind in _INTS:
                tags[key] = struct.unpack_from(_INTS[kind], raw, at)[0]
            at += _SIZES[kind]
    missing = not bases or quals[:1] == b"\xff"
    return raw[32 : 32 + name - 1].decode(), references[ref] if ref >= 0 else "*", pos, flag, cigar, seq, None if missing else quals, tags.get(b"BC"), tags.get(b"NM")


def batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    quals = [None if q is None else np.frombuffer(q, np.uint8).astype(np.int32) for q in columns[6]]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.int32()]
    arrays = [pa.array(quals if k == 6 else c, t) for k, (c, t) in enumerate(zip(columns, types, strict=True))]
    return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in ALIGNED.split(", ")])


def index_spans(raw: bytes) -> list[tuple[int, int] | None]:
    """First and last virtual offset of each reference in a BAM index."""
    if raw[:4] != b"BAI\1":
        raise ValueError("not a BAM index")
    count, at, out = struct.unpack_from("<i", raw, 4)[0], 8, []
    for _ in range(count):
        bins, at, chunks = struct.unpack_from("<i", raw, at)[0], at + 4, []
        for _ in range(bins):
            number, some = struct.unpack_from("<Ii", raw, at)
            if number != STATISTICS:
                chunks += [struct.unpack_from("<QQ", raw, at + 8 + 16 * k) for k in range(some)]
            at += 8 + 16 * some
        at += 4 + 8 * struct.unpack_from("<i", raw, at)[0]
        out.append((min(c[0] for c in chunks), max(c[1] for c in chunks)) if chunks else None)
    return out


class BamSink(DataSourceArrowWriter):
    """BAM files with their indexes: rows come sorted by file, then place. Columns: file, then those of ALIGNED.

    Tasks write into a folder of the job's own; commit moves what the tasks that count have
    named to its place, and abort or commit delete the folder with all that is left.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.references, self.overwrite = options["path"].rstrip("/"), json.loads(options["references"]), overwrite
        self.job = f"_temporary-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = opened(self.path)
        mine = f"{folder}/{self.job}/{uuid.uuid4().hex}"
        store.create_dir(mine, recursive=True)
        done, now = [], None
        place = {name: k for k, name in enumerate(self.references)}
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["file"] != done[-1]:
                    if now is not None:
                        now.close()
                    done.append(row["file"])
                    now = BamFile(store, f"{mine}/{row['file']}.bam", self.references)
                now.add(row, place)
        if now is not None:
            now.close()
        return Written(mine, done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = opened(self.path)
        old = {i.path for i in store.get_file_info(fs.FileSelector(folder)) if i.is_file}
        new = [(f"{m.folder}/{name}{end}", f"{folder}/{name}{end}") for m in messages if m for name in m.names for end in (".bam", ".bam.bai")]
        if len({b for _, b in new}) < len(new) or (not self.overwrite and any(b in old for _, b in new)):
            self.abort(messages)
            raise ValueError("two tasks or writes have a file of one name")
        if self.overwrite:
            for path in old:
                if path.endswith((".bam", ".bam.bai")):
                    store.delete_file(path)
        for a, b in new:
            store.move(a, b)
        store.delete_dir(f"{folder}/{self.job}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = opened(self.path)
        if store.get_file_info(f"{folder}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{folder}/{self.job}")


class Written(WriterCommitMessage):
    def __init__(self, folder: str, names: list[str]):
        self.folder, self.names = folder, names


def spanned(cigar: str) -> int:
    """Reference bases under an alignment."""
    total, number = 0, 0
    for c in "" if cigar == "*" else cigar:
        if c.isdigit():
            number = 10 * number + int(c)
        else:
            total, number = total + (number if c in "MDN=X" else 0), 0
    return total


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds a range of bases: each level has eight times the bins of the one above."""
    for level in range(5, 0, -1):
        shift = 29 - 3 * level
        if start >> shift == (end - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (start >> shift)
    return 0


class BamFile:
    """A sorted BAM file and its index, as they are written."""

    def __init__(self, store: fs.FileSystem, path: str, references: dict[str, int]):
        self.store, self.path, self.out = store, path, store.open_output_stream(path)
        text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{size}\n" for n, size in references.items())
        head = b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(references))
        head += b"".join(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", size) for n, size in references.items())
        self.at, self.data = 0, bytearray()
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in references]
        self.windows: list[dict[int, int]] = [{} for _ in references]
        self.last, self.unplaced = (-1, -1), 0
        self.put(head)

    def put(self, raw: bytes) -> None:
        """Append bytes; a block is closed before a record that it has no room for."""
        if self.data and len(self.data) + len(raw) > BLOCK:
            self.flush()
        self.data += raw
        while len(self.data) > BLOCK:
            self.flush(BLOCK)

    def flush(self, n: int | None = None) -> None:
        part = bytes(self.data if n is None else self.data[:n])
        packed = block(part)
        self.out.write(packed)
        self.at += len(packed)
        del self.data[: len(part)]

    def spot(self) -> int:
        return self.at << 16 | len(self.data)

    def add(self, row: dict, place: dict[str, int]) -> None:
        raw = packed(row, place)
        ref, start = struct.unpack_from("<ii", raw, 4)
        key = (ref if ref >= 0 else len(self.bins), start)
        if key < self.last:
            raise ValueError("alignments are not sorted by reference and place")
        self.last = key
        if self.data and len(self.data) + len(raw) > BLOCK:
            self.flush()
        begin = self.spot()
        self.put(raw)
        if ref < 0:
            self.unplaced += 1
            return
        end = start + max(1, spanned(row["cigar"]))
        chunks = self.bins[ref].setdefault(bin_of(start, end), [])
        if chunks and chunks[-1][1] == begin:
            chunks[-1][1] = self.spot()
        else:
            chunks.append([begin, self.spot()])
        for w in range(start >> 14, (end - 1 >> 14) + 1):
            self.windows[ref].setdefault(w, begin)

    def close(self) -> None:
        if self.data:
            self.flush()
        self.out.write(END_BLOCK)
        self.out.close()
        raw = [b"BAI\1", struct.pack("<i", len(self.bins))]
        for bins, windows in zip(self.bins, self.windows, strict=True):
            raw.append(struct.pack("<i", len(bins)))
            for number, chunks in sorted(bins.items()):
                raw.append(struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
            raw.append(struct.pack("<i", max(windows, default=-1) + 1))
            before = 0
            for w in range(max(windows, default=-1) + 1):
                before = windows.get(w, before)
                raw.append(struct.pack("<Q", before))
        raw.append(struct.pack("<Q", self.unplaced))
        with self.store.open_output_stream(self.path + ".bai") as out:
            out.write(b"".join(raw))


def block(data: bytes) -> bytes:
    """One BGZF block."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = struct.pack("<4BIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def packed(r: dict, place: dict[str, int]) -> bytes:
    """One record."""
    name, seq, quals = r["read_id"].encode() + b"\0", r["query_seq"], r["quals"]
    seq = "" if seq == "*" else seq
    ops, number = [], ""
    for c in "" if r["cigar"] == "*" else r["cigar"]:
        if c.isdigit():
            number += c
        else:
            ops.append(int(number) << 4 | OPS.index(c))
            number = ""
    letters = [max(0, BASES.find(c)) for c in seq] + [0] * (len(seq) % 2)
    start = r["ref_start"]
    where = bin_of(start, start + max(1, spanned(r["cigar"]))) if start >= 0 else UNPLACED
    body = struct.pack("<iiBBHHHiiii", place.get(r["reference_name"], -1), start, len(name), 255, where, len(ops), r["flag"] or 0, len(seq), -1, -1, 0)
    body += name + struct.pack(f"<{len(ops)}I", *ops) + bytes(a << 4 | b for a, b in zip(letters[::2], letters[1::2], strict=True))
    body += bytes(quals) if quals is not None else b"\xff" * len(seq)
    if r["nm"] is not None:
        body += b"NMi" + struct.pack("<i", r["nm"])
    if r["bc"] is not None:
        body += b"BCZ" + r["bc"].encode() + b"\0"
    return struct.pack("<i", len(body)) + body


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sequence_fastq"

    def schema(self) -> str:
        return FASTQ

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sequence_bam"

    def schema(self) -> str:
        return ALIGNED

    def reader(self, schema) -> DataSourceReader:
        return BamReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return BamSink(self.options, overwrite)


def register(spark: SparkSession, source: type[DataSource]) -> None:
    """Make a source known to the session, and let it take filters."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)


def load(spark: SparkSession, source: type[DataSource], paths: str | list[str], split: int) -> DataFrame:
    register(spark, source)
    every = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format(source.name()).option("paths", json.dumps(every)).option("split", str(split)).load()
