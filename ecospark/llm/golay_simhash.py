"""SimHash near-duplicate components by Golay-code fuzzy hashing.

A document's fingerprint has 64 bits: a bit is set if it is set in more than half of the hashes of the document's
three-word shingles, repeats included.  Fingerprints link at ``FAR`` (two) or fewer differing bits.

The fingerprint is cut into three segments of at most 23 bits.  The binary Golay code of length 23 is perfect: every
23-bit word is within three bits of exactly one of its 4,096 codewords, whose index is the word's decoding.  A
segment's fuzzy keys are the decodings of the segment and of its 23 neighbours at one bit: one key where the segment
is within two bits of a codeword, six else.  Two segments that differ in two bits or fewer have a neighbour in common,
hence a key.  Pigeonhole: two errors leave one of three segments whole, so a key is a whole segment together with a
fuzzy key of the segment after it, and every pair to link shares one of a fingerprint's 3 to 18 keys.

Keys are dealt by ranges over (key, fingerprint) and read in order; rows that share a key are compared by distance.
A run of rows reports a link from each row to the smallest row that it is joined with, not its pairs.  Runs of more
than ``RUN`` rows, and the first and last run of a task, which may go on in another one, are left to a second join
that needs no bound: two fingerprints differ in two bits or fewer exactly if some 64-bit word is within one bit of
both, and at most 65 fingerprints are within one bit of a word, all of which link with each other.

Edge cases: a null or empty text, or one without words, has fingerprint zero, which links like any other.  A text of
fewer than three words has one shingle, the whole sequence.  Very long texts are one row each, hashed in parts.
Equal fingerprints are one node, so copies cost one row.  A row without an id does not count for the smallest id of
its component; a component without any id has none.  An empty table gives an empty result.  Extra columns are left out.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import arrow_map, documents_of, materialize, partitions_for, slices
from ecospark.llm.near_duplicates import connected

SHINGLE, SEED, FAR = 3, 42, 2
#: Bits of the three segments, from the lowest bit of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Rows of a run that are compared with each other; longer ones go to the second join.
RUN = 1024
#: Generator polynomial of the Golay code of length 23: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Hashes whose bits are counted at once.
PART = 1 << 16


def shingle_hashes(text: str) -> list[int]:
    """Hashes of the shingles of a text in order, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return []
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return [h(line, SEED)]
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-SHINGLE])]
    return [h(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:])]


def fingerprint(hashes: list[int]) -> int:
    """The 64 majority bits."""
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), PART):
        part = np.array(hashes[at:at + PART], ">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; ``docs`` has doc_id and text."""
    def per_batch(batch):
        for part in slices(batch, "text"):
            fp = np.array([fingerprint(shingle_hashes(t)) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
    return arrow_map(docs, per_batch, "doc_id long, fp long")


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words on division by the generator polynomial; it is linear in the words' bits."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


#: No change, and a change of each bit.
FLIPS = np.concatenate([[0], 1 << np.arange(23, dtype=np.int64)])


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """The error word of at most three bits of each of the 2,048 syndromes."""
    words = np.unique(FLIPS[:, None, None] | FLIPS[None, :, None] | FLIPS[None, None, :])
    table = np.full(2048, -1, np.int64)
    table[_syndrome(words)] = words
    return table


def decode(words: np.ndarray) -> np.ndarray:
    """Index (the upper twelve bits) of the codeword nearest to each 23-bit word."""
    return (words ^ _errors()[_syndrome(words)]) >> 11


def fuzzy_keys(words: np.ndarray) -> np.ndarray:
    """Decodings of the words and of their neighbours at one bit, a row each; those that repeat are -1."""
    near = words[:, None] ^ FLIPS
    keys = np.sort((near ^ _errors()[_syndrome(words)[:, None] ^ _syndrome(FLIPS)]) >> 11, axis=1)
    repeated = keys[:, 1:] == keys[:, :-1]
    keys[:, 1:][repeated] = -1
    return keys


def key_rows(nodes: DataFrame) -> DataFrame:
    """key, fp: number of the whole segment, that segment, and a fuzzy key of the next one, packed in a long."""
    def per_batch(batch):
        fp = batch.column("fp").to_numpy()
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            segment = [(part.view(np.uint64) >> np.uint64(low)).astype(np.int64) & ((1 << bits) - 1) for low, bits in SEGMENTS]
            for k in range(3):
                fuzzy = fuzzy_keys(segment[(k + 1) % 3])
                row, place = np.nonzero(fuzzy >= 0)
                key = k << 40 | segment[k][row] << 12 | fuzzy[row, place]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], ["key", "fp"])
    return arrow_map(nodes, per_batch, "key long, fp long")


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest of n places that each place is joined with by the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= FAR  # of a signed number it would count the magnitude's bits


def _run_links(fp: np.ndarray, run: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, label of i) of the rows that are joined with a smaller one of their run.  ``run`` numbers the runs
    of the rows from 0 and ``size`` has their rows; all are ``RUN`` rows at most."""
    mine, small, found = size[run], 16, []
    for step in range(1, min(small, len(fp))):
        i = np.flatnonzero((run[step:] == run[:-step]) & (mine[step:] <= small))
        if not len(i):
            break
        i = i[_near(fp[i], fp[i + step])]
        found.append((i, i + step))
    start = np.cumsum(size) - size
    for k in np.flatnonzero(size > small):
        part = fp[start[k]:start[k] + size[k]]
        i, j = np.nonzero(np.triu(_near(part[:, None], part[None, :]), 1))
        label = _labels(len(part), i, j)  # a star at once, so that pairs of one run only are held
        i = np.flatnonzero(label != np.arange(len(part)))
        found.append((start[k] + label[i], start[k] + i))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    label = _labels(len(fp), *(np.concatenate([f[c] for f in found]) for c in (0, 1)))
    i = np.flatnonzero(label != np.arange(len(fp)))
    return i, label[i]


def _key_links(keys: DataFrame, parts: int, run_limit: int) -> DataFrame:
    """a, b: a link between two fingerprints, or a alone: a fingerprint whose run is left to the second join."""
    def out(a, b=None):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)], ["a", "b"])

    def solve(fp, size):
        """Links of the runs that follow each other in ``fp``."""
        long = np.repeat(size > run_limit, size)
        if long.any():
            yield out(fp[long])
        fp, size = fp[~long], size[size <= run_limit]
        i, label = _run_links(fp, np.repeat(np.arange(len(size)), size), size)
        if len(i):
            yield out(fp[i], fp[label])

    def run(batches):
        key_before, held, left = None, [], True  # the open run, and whether it goes to the second join
        for batch in batches:
            key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            if not len(key):
                continue
            edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            ends = [key_before is not None and key[0] != key_before, len(edges) > 2]
            for ended, more in zip(ends, (fp[:edges[1]], fp[:0])):  # before the batch, and with its first run
                if ended:
                    fps = np.concatenate([*held, fp[:0]])
                    yield from [out(fps)] if left else solve(fps, np.array([len(fps)]))
                    held, left = [], False
                held.append(more)
            if ends[1]:
                yield from solve(fp[edges[1]:edges[-2]], np.diff(edges)[1:-1])
                held = [fp[edges[-2]:]]
            key_before = key[-1]
            if sum(map(len, held)) > run_limit:  # no task holds a long run
                yield out(np.concatenate(held))
                held, left = [], True
        if held:
            yield out(np.concatenate(held))

    dealt = keys.repartitionByRange(parts, "key", "fp").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def _ball_links(nodes: DataFrame) -> DataFrame:
    """a, b: links of all pairs of ``nodes`` (a) within two bits, by the words within one bit of both.  A word has at
    most 65 fingerprints, so a link to the smallest of them is a plain aggregate."""
    def per_batch(batch):
        fp = batch.column("a").to_numpy().view(np.uint64)
        flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            word = (part[:, None] ^ flips[None, :]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(np.repeat(part, 65).view(np.int64))], ["word", "fp"])
    words = arrow_map(nodes, per_batch, "word long, fp long")
    groups = words.groupBy("word").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return groups.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b").distinct()


def links(nodes: DataFrame, run_limit: int = RUN) -> DataFrame:
    """a, b: links whose components are those of all pairs of ``nodes`` (distinct fp) within two bits."""
    parts = partitions_for(nodes, 18)
    found = materialize(_key_links(key_rows(nodes), parts, run_limit), "golay-links")
    rest = materialize(found.where("b IS NULL").select("a").distinct(), "golay-rest")
    return found.where("b IS NOT NULL").unionByName(_ball_links(rest))


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_limit: int = RUN) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    rows = materialize(fingerprints(documents_of(docs, id_col, text_col)), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    settled = connected(links(nodes.select("fp"), run_limit))
    # the smallest id of a component belongs to its nodes; most nodes have no link and keep their own
    named = settled.join(nodes, settled["node"] == nodes["fp"])
    lowest = named.groupBy("comp").agg(F.min("first").alias("lowest"))
    joined = named.join(lowest, "comp").select("fp", "lowest")
    nodes = nodes.join(joined, "fp", "left").selectExpr("fp", "coalesce(lowest, first) AS component_id")
    return rows.join(nodes, "fp").selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")
