"""Token ids in ORC files: integer run-length encoding, row indexes and a Bloom filter on the document id.

Texts are encoded, the ids are dealt by ranges of the document id, and each range is written as one ORC file in
ascending id order.  ORC keeps the ids of a document as a list of integers under its run-length encoding; the footer has the
statistics of every stripe, and row indexes and Bloom filters on ``doc_id`` let a reader skip stripes and row
groups without reading them.  Stripes are read in parallel.  The number of tokens before a document follows from
per-file sums, so no task sees more than one range.

Words between ASCII white space are encoded apart, which the tokenizer allows (its normalizer and pre-tokenizer never
look across white space), and the ids of equal words are remembered in each Python worker.  Words are found and numbered
in the bytes of a batch; those of ASCII are lowered and cut there as the tokenizer's pattern cuts them.  A text with a
special token or a NUL, or without that guarantee, is encoded by the library as it stands.

Edge cases: a null or empty text has no ids of its own, only the end id.  Equal document ids keep all their rows,
ordered by the checksum and number of their ids, in the files as in ``start``; they may lie in several ranges.  A row
without an id comes first.  An empty table gives files without rows and an empty result.
Extra columns are left out before writing.  Very long texts are one row each.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecospark.llm.common import arrow_map, documents_of, drop_scratch, materialize, partitions_for, scratch_path, slices, worker_cache

#: Words remembered in one Python worker; beyond it, those that were met once are forgotten.
CACHE_WORDS = 500_000
#: Bytes of a word that are compared; longer words are encoded wherever they stand.
COMPARED = 64
#: ORC settings: index rows, Bloom filter on the id, stripes for parallel reads.
ORC_OPTIONS = {"orc.create.index": "true", "orc.row.index.stride": "10000", "orc.bloom.filter.columns": "doc_id",
               "orc.bloom.filter.fpp": "0.01", "orc.stripe.size": str(32 << 20), "compression": "zstd"}


class IdTable(dict):
    """Row numbers of words, which get one when they are looked up, with the ids of all rows."""

    def __init__(self):
        super().__init__()
        self.words: list[str] = []
        self.first, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n

    def fresh(self) -> list[str]:
        """The words that were looked up and have no ids yet."""
        return self.words[len(self.first):]

    def rows(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64)

    def put(self, words: list[str], flat: np.ndarray, size: np.ndarray) -> None:
        """The ids of fresh words end to end, and the number of each."""
        rows, more = self.rows(words), len(self.words) - len(self.first)
        if more:
            self.first, self.size = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.first, self.size))
        self.first[rows], self.size[rows] = len(self.flat) + np.cumsum(size) - size, size
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows end to end, and the number of each."""
        size = self.size[rows]
        return self.flat[_ranges(self.first[rows], size)], size


class WordTable:
    """Numbers of words, found by their bytes, with the ids of all words.  Eight bytes at a time are looked up as one
    integer in sorted arrays: a word of eight bytes or fewer has the number of its block, a longer one that of the pair
    of what came before and the next block.  Words have no NUL, which fills up the last block."""

    def __init__(self):
        self.blocks, self.pairs = ((np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2))
        self.again, self.size, self.first = np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _grown(self, more: int) -> np.ndarray:
        """New numbers; a word without ids has the size -1."""
        n = len(self.size)
        self.again, self.first = (np.concatenate([x, np.zeros(more, x.dtype)]) for x in (self.again, self.first))
        self.size = np.concatenate([self.size, np.full(more, -1)])
        return np.arange(n, n + more)

    def _found(self, name: str, keys: np.ndarray) -> np.ndarray:
        """The numbers of keys; unknown keys get new ones."""
        known, numbers = getattr(self, name)
        coded = pa.array(keys).dictionary_encode()
        keys = coded.dictionary.to_numpy()
        at = np.searchsorted(known, keys)
        new = np.ones(len(keys), bool)
        inner = np.flatnonzero(at < len(known))
        new[inner] = known[at[inner]] != keys[inner]
        out = np.zeros(len(keys), np.int64)
        out[~new] = numbers[at[~new]]
        if new.any():
            order = np.flatnonzero(new)[np.argsort(keys[new])]
            out[order] = self._grown(len(order))
            setattr(self, name, (np.insert(known, at[order], keys[order]), np.insert(numbers, at[order], out[order])))
        return out[coded.indices.to_numpy()]

    def numbers(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of each word of a text in bytes; words of more than ``COMPARED`` bytes have one of their own."""
        before = len(self.size)
        eights = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
        short = np.flatnonzero(size <= COMPARED)
        steps = [short] + [short[size[short] > at] for at in range(8, COMPARED, 8)]
        found = self._found("blocks", np.concatenate([eights[starts[w] + 8 * k] & _FIRST[np.minimum(size[w] - 8 * k, 8)]
                                                      for k, w in enumerate(steps)]))
        found = np.split(found, np.cumsum([len(w) for w in steps])[:-1])
        out = np.zeros(len(starts), np.int64)
        out[short] = found[0]
        for w, block in zip(steps[1:], found[1:]):
            if len(w):
                out[w] = self._found("pairs", (out[w] << 32 | block).astype(np.uint64))
        rest = np.flatnonzero(size > COMPARED)
        out[rest] = self._grown(len(rest))
        self.again[out[out < before]] = True
        return out

    def put(self, numbers: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        """The ids of words end to end, and the number of each."""
        self.first[numbers], self.size[numbers] = len(self.flat) + np.cumsum(size) - size, size
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words end to end, and the number of each."""
        size = self.size[numbers]
        return self.flat[_ranges(self.first[numbers], size)], size

    def forget(self, most: int) -> None:
        """Keep the words that were met in more than one call, and what they begin with; nothing if those are many."""
        keep, (pairs, numbers) = self.again & (self.size >= 0), self.pairs
        for _ in range(COMPARED // 8):
            ours = pairs[keep[numbers]].astype(np.int64)
            keep[ours >> 32] = keep[ours & 0xFFFFFFFF] = True
        if keep.sum() >= most:
            return self.__init__()
        rows, place = np.flatnonzero(keep), np.cumsum(keep) - 1
        size = self.size[rows]
        flat = self.flat[_ranges(self.first[rows], np.maximum(size, 0))]
        key = pairs[keep[numbers]].astype(np.int64)
        self.pairs = (place[key >> 32] << 32 | place[key & 0xFFFFFFFF]).astype(np.uint64), place[numbers[keep[numbers]]]
        known, numbers = self.blocks
        self.blocks = known[keep[numbers]], place[numbers[keep[numbers]]]
        self.again, self.size, self.flat = np.zeros(len(rows), bool), size, flat
        self.first = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places from each first on, as many as its size."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


class WordEncoder:
    """Encodes texts with a tokenizer file; equal words are encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.apart = self._splits_at_space()
        #: The library's model behind a plainer pre-tokenizer, for parts that are lowered and cut.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.latin = self.apart and self._cuts_like_pattern()
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for t, i in names.items() if t.endswith(_END)]] = True
        #: Words, those of ASCII in their parts; parts of other Latin words.
        self.seen, self.parts = WordTable(), IdTable()

    def _splits_at_space(self) -> bool:
        """Whether white space always parts words: it is dropped by the pre-tokenizer and starts no token."""
        probe = [t for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str("a b\n c")] if self.tokenizer.pre_tokenizer else []
        return probe == ["a", "b", "c"] and not any(re.search(r"\s", t) for t in self.special)

    def _cuts_like_pattern(self) -> bool:
        """Whether the pre-tokenizer cuts lower-case Latin words as ``_PARTS`` does, the normalizer only lowers their
        letters and ``bare`` has the same ids for the parts, tried on every character of the range, and the model ends
        words with ``_END``."""
        if getattr(self.tokenizer.model, "end_of_word_suffix", None) != _END or not self.tokenizer.normalizer:
            return False
        chars = [chr(c) for c in range(0x21, 0x180) if not chr(c).isspace()]
        words = [f"{a}{c}{b}" for c in chars for a, b in (("", ""), ("a", "'s"), ("'d", "1"), ("!", "x"))] + ["don't", "'rex", "a'll2"]
        lower, pieces = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        cuts = [_PARTS.findall(w.lower()) for w in words]
        return all(lower(w) == w.lower() and [w.lower()[a:b] for _, (a, b) in pieces(w.lower())] == c for w, c in zip(words, cuts)) and (
            [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            == [e.ids for e in self.bare.encode_batch([" ".join(c) for c in cuts], add_special_tokens=False)])

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words without white space, many in a call, end to end, and the number of each; the library tells
        the word of each id."""
        flat, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        lines = [words[i:i + 256] for i in range(0, len(words), 256)]
        for line, e in zip(lines, self.tokenizer.encode_batch(lines, is_pretokenized=True, add_special_tokens=False)):
            flat.append(np.array(e.ids, np.uint32))
            size.append(np.diff(np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(line) + 1))))
        return np.concatenate(flat), np.concatenate(size)

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts that the pre-tokenizer does not cut: the last id of each carries the end mark of a word."""
        lines = [" ".join(parts[i:i + 256]) for i in range(0, len(parts), 256)]
        flat = np.concatenate([np.array(e.ids, np.uint32) for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)])
        size = np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)
        return (flat, size) if len(size) == len(parts) and size.sum() == len(flat) else self._encode_words(parts)

    def _encode_others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that were not cut.  Those of Latin letters are cut here, and their parts are remembered:
        'Été,' and 'ÉTÉ' share the part 'été'."""
        plain = np.array([self.latin and (w.isascii() and w.isprintable() or not _OTHER.search(w)) for w in words], bool)
        each, size = [], np.zeros(len(words), np.int64)
        if plain.any():
            if len(self.parts) > CACHE_WORDS // 2:
                self.parts = IdTable()
            cut = _PARTS.findall("\n".join([w for w, p in zip(words, plain) if p]).lower() + "\n")
            rows = self.parts.rows(cut)
            if fresh := self.parts.fresh():
                fresh = [p for p in fresh if p != "\n"]  # which parts words and has no ids
                self.parts.put(fresh, *self._encode_parts(fresh))
            flat, number = self.parts.ids(rows)
            ends = np.flatnonzero(rows == self.parts["\n"])
            size[plain] = np.diff(np.cumsum(number)[ends], prepend=0)
            each = np.split(flat, np.cumsum(size[plain])[:-1])
        if not plain.all():
            flat, size[~plain] = self._encode_words([w for w, p in zip(words, plain) if not p])
            rest, each = iter(np.split(flat, np.cumsum(size[~plain])[:-1])), iter(each)
            flat = np.concatenate([next(each if p else rest) for p in plain])
        return flat, size

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of each."""
        texts = texts.cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes() if ends[-1] > ends[0] else b""
        ends = ends - ends[0]
        whole = np.full(len(texts), not self.apart)
        for mark in (*self.special, "\0"):
            if mark.encode() in data:
                whole |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        lowered, starts, stops, others = _words(data, ends, whole, self.latin)
        if len(self.seen.size) > CACHE_WORDS:
            self.seen.forget(CACHE_WORDS // 2)
        numbers = self.seen.numbers(lowered, starts, stops - starts)
        fresh, k = np.unique(numbers[at := np.flatnonzero(self.seen.size[numbers] < 0)], return_index=True)
        if len(fresh):
            k, other = at[k], others[at[k]]
            if not other.all():
                a, n = starts[k[~other]], (stops - starts)[k[~other]]
                parts = np.full(n.sum() + len(n), ord(" "), np.uint8)
                parts[_ranges(np.cumsum(n + 1) - n - 1, n)] = lowered[_ranges(a, n)]
                self.seen.put(fresh[~other], *self._encode_parts(parts.tobytes().decode().split()))
            if other.any():
                words = [data[a:b].decode() for a, b in zip(starts[k[other]].tolist(), stops[k[other]].tolist())]
                self.seen.put(fresh[other], *self._encode_others(words))
        flat, size = self.seen.ids(numbers)
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, ends)]
        if not whole.any():
            return flat, np.diff(ends)
        odd = iter(self.tokenizer.encode_batch_fast(texts.filter(pa.array(whole)).to_pylist(), add_special_tokens=False))
        each = [np.array(next(odd).ids, np.uint32) if w else flat[a:b] for w, a, b in zip(whole, ends, ends[1:])]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        flat, size = self.encode_column(pa.array(texts, pa.large_string()))
        return [flat[b - n:b] for n, b in zip(size, np.cumsum(size))]


def _words(data: bytes, ends: np.ndarray, whole: np.ndarray, cut: bool) -> tuple[np.ndarray, ...]:
    """Words of the texts that lie end to end, without those of ``whole`` texts: the bytes, where words start and stop
    in them, and which are as they stood.  The rest, if ``cut``, are of plain ASCII: lowered, and cut into runs of
    letters, single digits and runs of other characters as ``_PARTS`` does."""
    text, kind = (np.frombuffer(bytearray(x), np.uint8) for x in (data.lower() if cut else data, data.translate(_KINDS)))
    for k in np.flatnonzero(whole):
        kind[ends[k]:ends[k + 1]] = _BLANK
    edges = ends[(ends > 0) & (ends < len(data))]  # a word ends with its text
    starts, stops = _runs(kind > _BLANK, edges)
    other = np.ones(len(starts), bool)
    if cut:
        other[:] = False
        other[np.searchsorted(starts, np.flatnonzero(kind == _ODD), "right") - 1] = True
        stay = _ranges(starts[other], (stops - starts)[other])
        kind[stay], text[stay] = _ODD, np.frombuffer(data, np.uint8)[stay]
        starts, stops = _runs(kind, edges)
        other = kind[starts] == _ODD
    return text, starts, stops, other


def _runs(kind: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of one kind that is not blank start and stop; digits and what lies on both sides of an edge stay apart."""
    parted = np.ones(len(kind) + 1, bool)
    parted[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    parted[edges] = True
    inside = kind > _BLANK
    return np.flatnonzero(parted[:-1] & inside), np.flatnonzero(parted[1:] & inside) + 1


#: The end mark of a word in the vocabularies of this family.
_END = "</w>"
_LETTERS = "".join(chr(c) for c in range(0x180) if unicodedata.category(chr(c))[0] == "L")
_DIGITS = "".join(chr(c) for c in range(0x180) if unicodedata.category(chr(c))[0] == "N")
#: How such tokenizers cut lower-case words, here in lines; and characters outside the range on which that was tried.
_PARTS = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}\n]+")
_OTHER = re.compile("[^\x21-\x84\x86-\x9f\xa1-\u017f]")
#: Kinds of bytes: white space that parts words, then what ``_PARTS`` tells apart in ASCII, and what is left to it or to the
#: library: apostrophes, controls, other white space and all beyond ASCII.
_BLANK, _LETTER, _SIGN, _ODD, _DIGIT = range(5)
_KINDS = bytes([_BLANK if c in b"\t\n\v\f\r " else _ODD if c < 0x21 or c > 0x7e or c == ord("'") else _LETTER if chr(c).isalpha()
                   else _DIGIT if chr(c).isdigit() else _SIGN for c in range(256)])
#: The first n of eight bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def encoder(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, made once in each Python worker.  A task has one core: the library's own threads
    would share it and cost more than they do."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return worker_cache(f"encoder {path}", lambda: WordEncoder(path))


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and ids (little-endian, two bytes each where the vocabulary allows)."""
    def per_batch(batch):
        enc = encoder(tokenizer_path)
        kind = "<u2" if len(enc.ends) <= 1 << 16 and (end_id or 0) < 1 << 16 else "<u4"
        for part in slices(batch, "text"):
            flat, size = enc.encode_column(part.column("text"))
            if end_id is not None:
                flat, size = np.insert(flat, np.cumsum(size), end_id), size + 1
            ends = np.concatenate([[0], np.cumsum(size)])
            wide, ids = flat.astype("<u4").data, flat.astype(kind)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size, pa.int64()), pa.array([zlib.crc32(wide[a:b]) for a, b in zip(ends, ends[1:])], pa.int64()),
                 pa.Array.from_buffers(pa.binary(), len(size), [None, pa.array(ends * ids.itemsize, pa.int32()).buffers()[1], pa.py_buffer(ids)])],
                ["doc_id", "n_tokens", "ids_crc32", "ids"])

    return arrow_map(documents_of(docs, id_col, text_col), per_batch, "doc_id long, n_tokens long, ids_crc32 long, ids binary")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 2, files: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``doc_id, ids`` of every document as ORC files in ascending id order; ``files`` is the number of
    ranges (by the bytes of the ids by default).  Texts are encoded where they are read; ids are dealt."""
    def per_batch(batch):
        for part in slices(batch, "ids"):
            size = part.column("n_tokens").to_numpy()
            data = [b.as_buffer() for b in part.column("ids")]
            flat = [np.frombuffer(d, f"<u{len(d) // n}" if n else "<u2") for d, n in zip(data, size.tolist())]
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *size]), pa.int32()), pa.array(np.concatenate(flat).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    rows = materialize(encoded(docs, tokenizer_path, end_id, id_col, text_col), "token-rows")
    dealt = rows.repartitionByRange(files or partitions_for(rows, 2), "doc_id", "ids_crc32").sortWithinPartitions("doc_id", "ids_crc32", "n_tokens")
    arrow_map(dealt, per_batch, "doc_id long, ids array<int>").write.options(**ORC_OPTIONS).orc(path)
    drop_scratch(rows)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids``; filters on doc_id reach the stripe statistics and Bloom filters."""
    return spark.read.schema("doc_id long, ids array<int>").orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, file, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers)."""
    def per_batch(batch):
        ids = batch.column("ids")
        at = ids.offsets.to_numpy()
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("file"), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "file", "n_tokens", "ids_crc32"])

    return arrow_map(read_tokens(spark, path).withColumn("file", F.input_file_name()), per_batch,
                     "doc_id long, file string, n_tokens long, ids_crc32 long")


def encode_and_index(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, path: str | None = None) -> DataFrame:
    """Write the ids of every document and return the index read back from the files, with each document's start.

    The index rows (a few numbers a document) are written once.  A file holds one range of ids, so a start is a
    running sum within the file plus the tokens of the files before: neither a task nor the driver sees more than the
    rows of a file or one number a file.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-ids")
    write_tokens(docs, path, tokenizer_path, end_id)
    return with_starts(materialize(token_index(spark, path), "token-index"))


def with_starts(index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of an index whose files hold disjoint ranges of doc_id and ids_crc32, in the
    order in which the files have their rows."""
    files = index.groupBy("file").agg(F.min(F.struct("doc_id", "ids_crc32")).alias("first"), F.sum("n_tokens").alias("tokens"))
    before = files.selectExpr("file", "sum(tokens) OVER (ORDER BY first, file ROWS BETWEEN UNBOUNDED PRECEDING "
                              "AND 1 PRECEDING) AS before")
    run = index.selectExpr("*", "sum(n_tokens) OVER (PARTITION BY file ORDER BY doc_id, ids_crc32, n_tokens "
                           "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS within")
    return run.join(before, "file").selectExpr("doc_id", "coalesce(before, 0) + coalesce(within, 0) AS start",
                                               "n_tokens", "ids_crc32")
