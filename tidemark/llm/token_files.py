"""Token ids in binary files: one independent zstandard frame or more per document, with a seek table behind them."""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored, text_or_empty
from tidemark.operators.ordered import running_total
from tidemark.session import new_folder

#: Fixed values of the zstandard seekable format: the skippable frame of the seek table, its footer, and the flag for checksums.
SEEK_FRAME, SEEK_FOOTER, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: A further skippable frame, which holds the directory of documents.
DIRECTORY_FRAME = 0x184D2A51
#: Ids in one frame at most; a longer document takes several.
FRAME_IDS = 1 << 20
#: Compressed bytes that a file should have, and the level of compression.
FILE_BYTES, LEVEL = 64_000_000, 3
#: A tokenizer file larger than this is not sent to the workers.
MAX_TOKENIZER_BYTES = 64_000_000
#: Pieces of text kept with their ids by one Python worker (and as many older ones), and the longest piece kept.
KEPT_PIECES, KEPT_LENGTH = 600_000, 32
#: Characters of a text that are cut into pieces at once, and bytes of short texts that are taken together.
CUT_AT_ONCE, TEXT_AT_ONCE = 1_000_000, 16_000_000
#: Between something that is no white space and ASCII white space: words of byte-level tokenizers never reach across.
_BORDER = re.compile(r"(?<=\S)(?=[\t-\r ])")
#: White space side by side, or a character that borders are marked with: such a text is cut on its own.
_CROWDED = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}][\t-\r ]|[\t\x0b-\r\x00]"
#: A word of Latin letters, with the space before it, and what begins with a sign of ASCII behind it.
_WORD = re.compile(r"""( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~].*)?""", re.S)


def _printable() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class Encoder(dict):
    """Ids of whole texts as the tokenizer gives them, as little-endian 32-bit integers.

    Where the tokenizer cuts words at the borders of white space, it gets the
    pieces between borders one by one, and those met before are looked up;
    otherwise it gets whole texts. A word of letters needs no more cutting and
    goes to the tokenizer's merging model at once.
    """

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        super().__init__()
        data = json.loads(content)
        self.tokenizer = Tokenizer.from_str(content.decode("utf-8"))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge, self.printable = self.tokenizer.model.tokenize, _printable()
        split, model = data.get("pre_tokenizer") or {}, data["model"]
        added = data.get("added_tokens", [])
        self.by_pieces = (
            split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not data.get("normalizer")
            and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            and not any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"]) or t["content"].isalpha() for t in added))
        self.space = self.printable[32]
        self.added = [t["content"] for t in added]
        self.older: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            found = _WORD.fullmatch(piece)
            if found is None:
                out = self._ids(piece)
            elif found[2]:  # between a letter and a sign words end
                return self._ids(piece) if any(t in piece for t in self.added) else self[found[1]] + self[found[2]]
            else:
                word = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.printable)
                ids = [t.id for t in self.merge(self.space + word[1:] if word[0] == " " else word)]
                out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:  # what is asked for again is taken over from the older ones
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out

    def ids(self, text: str) -> Iterator[bytes]:
        """The ids of a text in order, in parts."""
        if not self.by_pieces:
            yield self._ids(text)
            return
        at = 0
        while at < len(text):
            border = _BORDER.search(text, at + CUT_AT_ONCE) if len(text) - at > CUT_AT_ONCE else None
            end = border.start() if border else len(text)
            yield b"".join(map(self.__getitem__, _BORDER.split(text[at:end])))
            at = end

    def _together(self, texts: pa.StringArray) -> Iterator[bytes]:
        """The ids of each of some texts in which every blank and line feed is a border; equal pieces are looked up once."""
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
        pieces = pc.split_pattern(marked, "\0")
        coded = pieces.flatten().dictionary_encode()
        parts = list(map(self.__getitem__, coded.dictionary.to_pylist()))
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<u4")))
        ids = held.take(coded.indices).flatten().to_numpy().astype("<u4", copy=False)
        before = np.concatenate([[0], np.cumsum(size[coded.indices.to_numpy()])])[pieces.offsets.to_numpy()]
        for a, b in zip(before[:-1], before[1:]):
            yield ids[a:b].tobytes()

    def all_ids(self, texts: pa.StringArray) -> Iterator[Iterable[bytes]]:
        """The ids of each text, in parts."""
        if not self.by_pieces:
            yield from map(self.ids, texts.to_pylist())
            return
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        alone = pc.match_substring_regex(texts, _CROWDED).to_numpy(zero_copy_only=False) | (size > CUT_AT_ONCE)
        a = 0
        while a < len(texts):
            b = a + max(1, int(np.searchsorted(np.cumsum(size[a:]), TEXT_AT_ONCE, "right")))
            easy = self._together(texts.slice(a, b - a).filter(pa.array(~alone[a:b])))
            for k in range(a, b):
                yield self.ids(texts[k].as_py()) if alone[k] else [next(easy)]
            a = b


_LOADED: dict[int, Encoder] = {}


def _checksum(data: bytes) -> int:
    """The checksum of a frame: the low half of XXH64 of what it holds."""
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def frames(parts: Iterable[bytes], compress, width: int = 4) -> list[tuple[bytes, int, int]]:
    """(frame, bytes it holds, checksum) for the ids of one document, in integers of two or four bytes; at least one frame."""
    out, rest, size = [], b"", FRAME_IDS * width
    for part in parts:
        rest += part if width == 4 else np.frombuffer(part, "<u4").astype("<u2").tobytes()
        while len(rest) > size:
            out.append(rest[:size])
            rest = rest[size:]
    return [(compress(x), len(x), _checksum(x)) for x in [*out, rest]]


def _skippable(magic: int, content: bytes) -> bytes:
    if len(content) >= 1 << 32:
        raise ValueError("too many frames for one file")
    return struct.pack("<II", magic, len(content)) + content


class FrameFile:
    """Writes documents to one file: frames, the directory of documents, and the seek table. Ids have ``width`` bytes."""

    def __init__(self, sink, width: int = 4):
        self.sink, self.width, self.table, self.ids, self.first_frame = sink, width, [], [], []

    def add(self, doc_id: int | None, pieces: Iterable[tuple[bytes, int, int]]) -> None:
        self.ids.append(doc_id)
        self.first_frame.append(len(self.table))
        for frame, size, checksum in pieces:
            self.sink.write(frame)
            self.table.append((len(frame), size, checksum))

    def finish(self) -> None:
        known = np.array([i is not None for i in self.ids], "u1")
        ids = np.array([i or 0 for i in self.ids], "<i8")
        directory = struct.pack("<QQ", len(self.ids), self.width) + ids.tobytes() + np.array(self.first_frame, "<u4").tobytes() + known.tobytes()
        block = _skippable(DIRECTORY_FRAME, directory)
        self.sink.write(block)
        table = np.array([*self.table, (len(block), 0, _checksum(b""))], "<u4")
        self.sink.write(_skippable(SEEK_FRAME, table.tobytes() + struct.pack("<IBI", len(table), WITH_CHECKSUMS, SEEK_FOOTER)))


class FrameReader:
    """Reads single documents of a file; ``source`` can seek. Frames that nobody asks for are not read."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, io.SEEK_END)
        if end < 17:
            raise ValueError("no seek table")
        source.seek(end - 9)
        number, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_FOOTER or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums")
        length = 12 * number + 9
        source.seek(end - length - 8)
        if struct.unpack("<II", source.read(8)) != (SEEK_FRAME, length):
            raise ValueError("the seek table is damaged")
        table = np.frombuffer(source.read(12 * number), "<u4").reshape(number, 3)
        self.sizes, self.checksums = table[:, 1].astype(np.int64), table[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(table[:, 0].astype(np.int64))])
        source.seek(int(self.starts[-2]))
        block = source.read(int(self.starts[-1] - self.starts[-2]))
        if struct.unpack("<II", block[:8]) != (DIRECTORY_FRAME, len(block) - 8):
            raise ValueError("the directory is damaged")
        n, self.width = struct.unpack("<QQ", block[8:24])
        known = np.frombuffer(block, "u1", n, 24 + 12 * n)
        self.ids = [int(i) if k else None for i, k in zip(np.frombuffer(block, "<i8", n, 24), known)]
        self.first_frame = np.append(np.frombuffer(block, "<u4", n, 24 + 8 * n).astype(np.int64), number - 1)
        self.expand = zstandard.ZstdDecompressor()

    def tokens(self, k: int) -> int:
        """How many ids document number ``k`` of the file has, from the seek table alone."""
        return int(self.sizes[self.first_frame[k] : self.first_frame[k + 1]].sum()) // self.width

    def parts(self, k: int) -> Iterator[bytes]:
        """The ids of document number ``k`` in four bytes each, frame by frame; each frame is held against its checksum."""
        for frame in range(self.first_frame[k], self.first_frame[k + 1]):
            self.source.seek(int(self.starts[frame]))
            data = self.source.read(int(self.starts[frame + 1] - self.starts[frame]))
            held = self.expand.decompress(data, max_output_size=int(self.sizes[frame]) or 1)
            if len(held) != self.sizes[frame] or _checksum(held) != self.checksums[frame]:
                raise ValueError(f"frame {frame} does not match its checksum")
            yield held if self.width == 4 else np.frombuffer(held, "<u2").astype("<u4").tobytes()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


_FRAME = "struct<frame: binary, size: bigint, checksum: bigint>"


def encoded_documents(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, width, n_bytes, frames`` for every row, where the row lies.

    ``digest`` is one of the text; ``width`` is the bytes of an id, two where the
    tokenizer has at most 65,536.
    """
    with open(tokenizer, "rb") as file:
        content = file.read(MAX_TOKENIZER_BYTES + 1)
    if len(content) > MAX_TOKENIZER_BYTES:
        raise ValueError("the tokenizer file is too large to be sent to every worker")
    largest = max(Encoder(content).tokenizer.get_vocab().values(), default=0)  # an unreadable tokenizer fails here
    width = 2 if max(largest, end_id or 0) < 1 << 16 else 4
    shared, key = docs.sparkSession.sparkContext.broadcast(content), hash(content)
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = Encoder(shared.value)
        encoder, compress = _LOADED[key], zstandard.ZstdCompressor(level=LEVEL).compress
        held = [frames([*ids, end], compress, width) for ids in encoder.all_ids(batch.column("text"))]
        columns = [pa.array([width] * len(held), pa.int32()), pa.array([sum(len(f[0]) for f in x) for x in held], pa.int64()),
                   pa.array([[{"frame": f, "size": n, "checksum": c} for f, n, c in x] for x in held], pa.list_(pa.struct([("frame", pa.binary()), ("size", pa.int64()), ("checksum", pa.int64())])))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), *columns], ["doc_id", "digest", "width", "n_bytes", "frames"])

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    return map_batches(rows, encode, f"doc_id bigint, digest bigint, width int, n_bytes bigint, frames array<{_FRAME}>")


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the ids of all texts below ``folder`` in ascending order of ids and returns the list of its files.

    The list has ``part, file, n_docs, n_ids, start``: files in order and the ids in
    those before each. Null ids come last, rows with equal ids are ordered by a
    digest of their text, a null text is an empty one, and each row has
    ``end_id`` behind its ids (None: nothing). An empty table gives an empty list.
    Other columns are not read. ``folder`` is one that all executors reach, by a
    path or address that pyarrow's file systems open.

    Texts are encoded and compressed where they lie, frames are range-partitioned
    by id (rows of one id by text and row, so that a hot one spreads), and
    every task appends its frames to one file. A file gets a name of its own in
    every attempt and counts only once the list, which is stored, names it; a
    lost attempt leaves a file that is never read.
    """
    spark = docs.sparkSession
    rows = stored(encoded_documents(docs, tokenizer, end_id, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "token-frames")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    files = max(-(-total // file_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("digest"), F.col("row")]
    kind = "part int, file string, n_docs bigint, n_ids bigint"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, sink, n_ids = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            for doc_id, width, held in zip(*map(batch.column, ("doc_id", "width", "frames"))):
                if file is None:
                    path = f"{folder}/ids-{part:06d}-{uuid.uuid4().hex}.zst"
                    system, place = _opened(path)
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    sink = system.open_output_stream(place, compression=None)
                    file = FrameFile(sink, width.as_py())
                pieces = [(x["frame"], x["size"], x["checksum"]) for x in held.as_py()]
                n_ids += sum(x[1] for x in pieces) // file.width
                file.add(doc_id.as_py(), pieces)
        if file is not None:
            file.finish()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [path], "n_docs": [len(file.ids)], "n_ids": [n_ids]})

    sorted_rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "width", "frames")
    listed = stored(sorted_rows.mapInArrow(write, kind), "token-files")
    upto = running_total(listed, [], ["part"], F.col("n_ids"), "upto")
    return upto.select("part", "file", "n_docs", "n_ids", (F.col("upto") - F.col("n_ids")).alias("start"))


def _each_file(files: DataFrame, read, schema: str) -> DataFrame:
    """``read(row, reader)`` for every listed file; files are dealt over the tasks one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _opened(row["file"])
                with system.open_input_file(place) as source:
                    yield from read(row, FrameReader(source))

    spread = max(files.count(), 1)
    return files.repartition(spread).mapInArrow(run, schema)


def read_index(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in listed files, read frame by frame and checked."""

    def read(row: dict, reader: FrameReader) -> Iterator[pa.RecordBatch]:
        start, counts, sums = row["start"], [], []
        for k in range(len(reader.ids)):
            crc = 0
            for part in reader.parts(k):
                crc = zlib.crc32(part, crc)
            counts.append(reader.tokens(k))
            sums.append(crc)
        starts = start + np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(reader.ids, pa.int64()), pa.array(starts), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _each_file(files, read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(files: DataFrame, wanted: list[int]) -> DataFrame:
    """``doc_id, ids`` of the asked documents; ``wanted`` is a list that the driver holds, and no other frame is decompressed."""
    asked = frozenset(wanted)

    def read(row: dict, reader: FrameReader) -> Iterator[pa.RecordBatch]:
        for k, doc_id in enumerate(reader.ids):
            if doc_id in asked:
                ids = np.frombuffer(b"".join(reader.parts(k)), "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return _each_file(files, read, "doc_id bigint, ids array<bigint>")


def token_file_index(docs: DataFrame, tokenizer: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents written to files below the shared folder, as they are read back."""
    files = write_token_files(docs, tokenizer, new_folder(docs.sparkSession, "token-ids"), end_id, id_col, text_col)
    return read_index(files)
