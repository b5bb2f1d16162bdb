"""SentencePiece encoding with offsets, and decoding.

A text is normalised by longest-prefix matching against the model's compiled character map (a double-array
trie over UTF-8 bytes followed by a pool of replacement strings).  Every byte of the normalised text remembers
the byte of the source it came from, so the pieces found on the normalised text project to byte spans of the
source.  The normalised text is cut where a word-start mark follows another character, provided that no piece
of the vocabulary crosses such a place: merges then never cross it either, and the ids of equal segments are
remembered in each Python worker.  A model with crossing pieces is encoded whole.

Edge cases: a null text is an empty text, which has no ids and decodes to ''.  Very long texts are handled as
one row; memory per row is a small multiple of the text.  Repeated rows and ties need no rule: each row is
encoded by itself.  An empty table gives an empty result.  Extra columns are left out before encoding.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2 as proto

from ecospark.llm.common import arrow_map, documents_of, slices, worker_cache

MARK = "▁"
_MARK = MARK.encode()
#: Segments remembered in one Python worker; beyond it the memory is started anew.
CACHE_SEGMENTS = 250_000


class CharMap:
    """The compiled character map of a normalizer: longest-prefix lookups over UTF-8 bytes."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.pool = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that starts at ``at``; None if no key does."""
        units, found = self.units, None
        if not units:
            return None
        node = _child(0, units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or (unit := units[node]) & 0x800000FF != data[i]:
                break
            node = _child(node, unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        end = self.pool.index(b"\0", found[1])
        return found[0], self.pool[found[1]:end]


def _child(node: int, unit: int) -> int:
    return node ^ (unit >> 10 << ((unit & 512) >> 6))


class Normalizer:
    """Normalised bytes of a text and, for each of them and for the end, the source byte it came from."""

    def __init__(self, spec, suffix_marks: bool = False):
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = suffix_marks
        self.plain = not (self.map.units or self.squeeze or suffix_marks) and self.dummy and self.escape

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return b"", np.zeros(1, np.int32)
        if self.plain:
            source = np.frombuffer(data, np.uint8)
            align = np.repeat(np.arange(len(data), dtype=np.int32), np.where(source == 32, 3, 1))
            return _MARK + data.replace(b" ", _MARK), np.concatenate([np.zeros(3, np.int32), align, np.array([len(data)], np.int32)])
        return self._mapped(data)

    def _units(self, data: bytes):
        """(start, end, replacement) of each longest-prefix match, or of one character where none matches."""
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit is None:
                n = _width(data, at)
                part = data[at:at + n] if n else "�".encode()
                hit = n or 1, part
            yield at, at + hit[0], hit[1]
            at += hit[0]

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        space = _MARK if self.escape else b" "
        out, align = [], []
        blank, started, end = self.squeeze, False, 0
        for start, end, part in self._units(data):
            if not started:
                if self.squeeze and part == b" ":
                    continue
                started = True
                if self.dummy and not self.suffix:
                    out.append(space)
                    align += [start] * len(space)
            if blank:
                part = part.lstrip(b" ")
            if part:
                blank = self.squeeze and part.endswith(b" ")
                part = part.replace(b" ", space)
                out.append(part)
                align += [start] * len(part)
            elif not self.squeeze:
                blank = False
        if not started:
            return b"", np.array([end], np.int32)
        text = b"".join(out)
        if self.squeeze:
            while text.endswith(space):
                text = text[:-len(space)]
                end = align[len(text)]
                del align[len(text):]
        if self.dummy and self.suffix:
            text += space
            align += [end] * len(space)
        return text, np.array([*align, end], np.int32)


def _width(data: bytes, at: int) -> int:
    """Bytes of the character at ``at``; 0 if it is malformed."""
    first = data[at]
    n = 1 if first < 0x80 else 2 if 0xC2 <= first < 0xE0 else 3 if 0xE0 <= first < 0xF0 else 4 if 0xF0 <= first < 0xF5 else 0
    try:
        data[at:at + n].decode()
    except UnicodeDecodeError:
        return 0
    return n


class Codec:
    """Encodes and decodes texts with one model file."""

    def __init__(self, model: bytes):
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.normalize = Normalizer(spec.normalizer_spec, spec.trainer_spec.treat_whitespace_as_suffix)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = proto.ModelProto()
        plain.CopyFrom(spec)
        plain.normalizer_spec.Clear()
        plain.normalizer_spec.name = "identity"
        plain.normalizer_spec.add_dummy_prefix = False
        plain.normalizer_spec.remove_extra_whitespaces = False
        plain.normalizer_spec.escape_whitespaces = False
        plain.trainer_spec.treat_whitespace_as_suffix = False
        #: The same vocabulary for texts that are already normalised.
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=plain.SerializeToString())
        names = [p.piece for p in spec.pieces]
        self.cuts = not any(MARK in p.lstrip(MARK) for p in names)
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == proto.ModelProto.SentencePiece.UNKNOWN)
        self.bytes_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(spec.pieces)
                         if p.type == proto.ModelProto.SentencePiece.BYTE}
        self.width = [len(p.encode()) for p in names]
        #: A line break that is part of no longer piece never merges and is a segment of its own.
        self.breaks = self.cuts and not any("\n" in p and len(p) > 1 for p in names)
        self.seen: dict[str, tuple[bytes, str]] = {}

    def _segments(self, text: str) -> list[str]:
        """Parts of a normalised text whose ids do not depend on each other."""
        if not self.cuts:
            return [text]
        if MARK + MARK in text or "\x01" in text:
            return _SEGMENT.findall(text)
        text = text.replace(MARK, "\x01" + MARK)
        return (text.replace("\n", "\x01\n\x01") if self.breaks else text).split("\x01")

    def _remember(self, segments: list[str]) -> dict[str, tuple[bytes, str]]:
        """Ids and normalised byte widths (pairs of int32) and the ids as decimals, each followed by a comma."""
        width, bytes_of, new = self.width, self.bytes_of, {}
        for segment, ids in zip(segments, self.pieces.encode(segments, num_threads=1)):
            if self.unknown in ids:
                wide = [len(p.encode()) for p in self.pieces.encode(segment, out_type=str)]
            else:
                wide = [width[i] for i in ids]
                if not bytes_of.keys().isdisjoint(ids):
                    at = 0
                    while at < len(ids):  # the last of a character's byte pieces holds the character
                        first = bytes_of.get(ids[at])
                        n = 1 if first is None or first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                        if first is not None:
                            wide[at:at + n] = [0] * (n - 1) + [n]
                        at += n
            pairs = array("i", ids + wide)
            pairs[::2], pairs[1::2] = array("i", ids), array("i", wide)
            new[segment] = pairs.tobytes(), "".join([f"{i}," for i in ids])
        if len(self.seen) + len(new) > CACHE_SEGMENTS:
            self.seen.clear()
        self.seen.update(new)
        return new

    def encode_many(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, str]]:
        """For each text: ids, first and past-the-end source byte of each piece, the ids as comma-joined decimals."""
        normal = [self.normalize(t) for t in texts]
        cut = [self._segments(n.decode("utf-8", "replace")) for n, _ in normal]
        seen, found = self.seen, []
        missing: set[str] = set()
        for segments in cut:
            found.append(parts := [seen.get(s) for s in segments])
            if None in parts:
                missing.update([s for s, p in zip(segments, parts) if p is None])
        new = self._remember(list(missing)) if missing else {}
        rows = []
        for (_, align), segments, parts in zip(normal, cut, found):
            if None in parts:
                parts = [p or new[s] for s, p in zip(segments, parts)]
            pairs, joined = zip(*parts)
            pairs = np.frombuffer(b"".join(pairs), np.int32)
            stop = pairs[1::2].cumsum()
            edges = align[np.concatenate([[0], stop])]
            rows.append((pairs[::2], edges[:-1], edges[1:], "".join(joined)[:-1]))
        return rows

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
        return self.encode_many([text])[0]

    def decode_many(self, ids: list[np.ndarray]) -> list[str]:
        return self.whole.decode([x.tolist() for x in ids], num_threads=1) if ids else []

    def decode(self, ids) -> str:
        return self.whole.decode([int(i) for i in ids])


#: Marks followed by other characters; a text may begin without a mark.
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def codec(path: str) -> Codec:
    """The codec of a model file, made once in each Python worker."""
    def made() -> Codec:
        with open(path, "rb") as f:
            return Codec(f.read())
    return worker_cache(f"codec {path}", made)


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, starts, ends: the pieces of every text with their byte spans in the source text."""
    def per_batch(batch):
        c = codec(model_path)
        for part in slices(batch, "text"):
            rows = c.encode_many(part.column("text").to_pylist())
            offsets = pa.array(np.cumsum([0, *(len(r[0]) for r in rows)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[k] for r in rows]).astype(np.int32)))
                     for k in range(3)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], ["doc_id", "ids", "starts", "ends"])
    return arrow_map(documents_of(docs, id_col, text_col), per_batch,
                     "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text decoded from ``ids`` (null ids: the empty text)."""
    def per_batch(batch):
        c = codec(model_path)
        texts = [c.decode(x or []) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return arrow_map(encoded.select("doc_id", "ids"), per_batch, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the encoding, of the byte spans and of the decoded text of every document, in one pass: the ids
    stay in the task that made them."""
    def per_batch(batch):
        c = codec(model_path)
        for part in slices(batch, "text"):
            n, digest, spans, decoded, size = [], [], [], [], []
            rows = c.encode_many(part.column("text").to_pylist())
            for (ids, start, end, joined), back in zip(rows, c.decode_many([r[0] for r in rows])):
                back = back.encode()
                n.append(len(ids))
                digest.append(hashlib.sha256(joined.encode()).hexdigest())
                spans.append(zlib.crc32(np.stack([start, end], 1).astype("<i4").tobytes()))
                decoded.append(hashlib.sha256(back).hexdigest())
                size.append(len(back))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest), pa.array(decoded),
                 pa.array(spans, pa.int64()), pa.array(size, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "decoded_bytes"])
    return arrow_map(documents_of(docs, id_col, text_col), per_batch,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long, decoded_bytes long")


def with_ids(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """All columns of the rows, then n_tokens, ids and lossless: whether decoding the ids gives the text back.  A
    column of the rows that has one of these names is replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c == text_col or c.lower() not in ("n_tokens", "ids", "lossless")])
    place = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType())),
                         StructField("lossless", BooleanType())])

    def per_batch(batch):
        c = codec(model_path)
        for part in slices(batch, place):
            texts = [t or "" for t in part.column(place).to_pylist()]
            ids = [r[0] for r in c.encode_many(texts)]
            offsets = pa.array(np.cumsum([0, *(len(x) for x in ids)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([len(x) for x in ids], pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32))),
                 pa.array([a == b for a, b in zip(c.decode_many(ids), texts)])], schema.names)
    return arrow_map(docs, per_batch, schema)
