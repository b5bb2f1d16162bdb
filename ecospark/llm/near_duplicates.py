"""Near-duplicate components by a multi-index Hamming join over b-bit MinHash signatures.

A document's set holds its distinct five-word shingles (as 64-bit hashes).  Equal sets are one class, represented
by their smallest document id; only representatives go on.  A signature is ``CODES`` MinHash values of ``BITS`` bits
each, and the distance of two signatures is the number of codes that differ.  All pairs within the distance ``FAR``
are found by pigeonhole: the codes are split into ``CHUNKS`` chunks, and since ``FAR`` is less than twice their
number, one chunk differs in at most one code.  Enumerating that error - each chunk with each one code left out -
gives the keys of a document, and every pair within the distance shares a key.  Two documents that link (similarity
0.75) differ in more than ``FAR`` of 64 codes with a chance of about 15 in a million.

Rows that share a key are compared by distance in tiles of bounded size, in numpy.  Of the pairs within the distance
only the nearest of each row is reported, and reported pairs are merged into clusters; rounds of this go on between
clusters until no key holds a pair within the distance whose ends lie in different clusters.  So every such pair lies
inside a cluster, and a large group of copies costs a row a copy instead of all its pairs.  Tiles of a crowded key hold
the rows of its largest cluster on one side only: the work grows with the rows outside of it.

Within a cluster the full sets decide.  Clusters are cut into blocks, every two blocks meet in a tile, and a tile
confirms its pairs on the full sets, skipping those whose ends are joined already by confirmed
links; it reports a link for every two parts that it joined.  The links of all tiles have the components of all links.

Edge cases: a null text, an empty one or one without words has an empty set, links with nothing and is its own
component.  A text of fewer than five words has one shingle, the whole sequence.  Very long texts are one row each.
Equal rows are one class; rows that share an id but not a text are one node, which links if any of them does.
A null id is its own class without links: component_id is null and kept true.  An empty table gives an empty
result.  Extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ecospark.llm.common import arrow_map, documents_of, materialize, slices, spare_names, worker_cache

SHINGLE, CODES, CHUNKS, BITS = 5, 64, 16, 16
WIDTH = CODES // CHUNKS
#: Greatest distance that the keys guarantee: below two errors in every chunk.
FAR = 2 * CHUNKS - 1
#: Rows of one side of a tile of a key.
SIDE = 512
#: Rows of a block of a cluster: a share of the cluster within bounds, so that its rows are sent a few times only.
BLOCK_LEAST, BLOCK_SHARE, BLOCK_MOST = 128, 24, 4096
#: Words remembered in one Python worker.
CACHE_WORDS = 300_000

_MUL = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(1, 1 << 63, CODES, dtype=np.uint64) | np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII spaces only
    known = worker_cache("words of shingles", _Words)
    h = np.array([known[w] for w in words], np.uint64)
    if not len(h):
        return h
    n = max(1, len(h) - SHINGLE + 1)
    width = min(SHINGLE, len(h))
    with np.errstate(over="ignore"):
        v = np.full(n, width, np.uint64)
        for k in range(width):
            v = (v ^ (v >> np.uint64(29))) * _MUL + h[k:k + n]
        v = (v ^ (v >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return np.unique(v ^ (v >> np.uint64(32)))


def signature(shingles: np.ndarray) -> bytes:
    """``CODES`` codes of ``BITS`` bits (little-endian) of a set that is not empty."""
    low = np.full(CODES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):
            x = shingles[at:at + 4096, None] * _FACTORS[None, :]
            x ^= x >> np.uint64(31)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            low = np.minimum(low, x.min(0))
    return ((low >> np.uint64(24)) & np.uint64((1 << BITS) - 1)).astype("<u2").tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), digest of the set, sig; digest and sig are null for empty sets."""
    def per_batch(batch):
        for part in slices(batch, "text"):
            sets = [shingle_set(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array([signature(s) if len(s) else None for s in sets], pa.binary())], ["doc_id", "n", "digest", "sig"])
    return arrow_map(docs, per_batch, "doc_id long, n long, digest binary, sig binary")


def key_rows(reps: DataFrame) -> DataFrame:
    """key, rep, n: the keys of every signature - a chunk without one of its codes, packed with its number."""
    def per_batch(batch):
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(batch.num_rows, CHUNKS, WIDTH).astype(np.int64)
        keys = np.zeros((batch.num_rows, CHUNKS, WIDTH), np.int64)
        for left_out in range(WIDTH):
            k = np.arange(CHUNKS, dtype=np.int64) * WIDTH + left_out
            k = np.broadcast_to(k, (batch.num_rows, CHUNKS))
            for c in range(WIDTH):
                if c != left_out:
                    k = k << BITS | sig[:, :, c]
            keys[:, :, left_out] = k
        for at in range(0, batch.num_rows, 1000):
            part = keys[at:at + 1000].reshape(-1, CODES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.ravel()), *(pa.array(np.repeat(batch.column(c).to_numpy()[at:at + 1000], CODES)) for c in ("rep", "n"))],
                ["key", "rep", "n"])
    return arrow_map(reps.select("rep", "n", "sig"), per_batch, "key long, rep long, n long")


def crowded_rows(keys: DataFrame) -> DataFrame:
    """The rows whose key another row has too.  Ranges over (key, rep) split a hot key among tasks; the first and
    the last key of a batch of rows are kept, since their other rows may lie in another batch or task."""
    def per_batch(batch):
        key = batch.column("key").to_numpy()
        same = key[1:] == key[:-1]
        keep = np.zeros(len(key), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep |= (key == key[0]) | (key == key[-1])
        yield batch.filter(pa.array(keep))
    dealt = keys.repartitionByRange(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "rep")
    return arrow_map(dealt.sortWithinPartitions("key", "rep"), per_batch, "key long, rep long, n long")


def _tiles(crowded: DataFrame, components: DataFrame, reps: DataFrame) -> DataFrame:
    """Rows of the keys with several components, once for each tile they belong to.

    side is -1 in the largest component of the key and the row's block among the others else; a tile is (block of
    the others, block of the largest component) or (block, block) of the others."""
    rows = crowded.join(components, "rep")
    by_key = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(
        F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rows = rows.join(by_key.selectExpr("key", "top.comp AS top", f"CAST(ceil(top.m / {SIDE}) AS INT) AS tops",
                                       f"CAST(ceil((m - top.m) / {SIDE}) AS INT) AS others"), "key")
    rows = rows.selectExpr("key", "rep", "n", "comp", "tops", "others", "comp = top AS inner",
                           "CAST(pmod(xxhash64(rep, key), CASE WHEN comp = top THEN tops ELSE others END) AS INT) AS block")
    top = rows.where("inner").selectExpr("key", "rep", "n", "comp", "-1 AS side", "block AS right",
                                         "explode(sequence(0, others - 1)) AS left")
    other = rows.where("NOT inner").selectExpr(
        "key", "rep", "n", "comp", "block AS side",
        "explode(concat(transform(sequence(0, tops - 1), b -> struct(block AS left, b AS right)), "
        "transform(sequence(0, others - 1), b -> struct(least(b, block) AS left, -1 - greatest(b, block) AS right)))) AS tile") \
        .selectExpr("key", "rep", "n", "comp", "side", "tile.right AS right", "tile.left AS left")
    return top.unionByName(other).join(reps.select("rep", "sig"), "rep")


def _runs(batches, columns: list[str]):
    """Consecutive rows with equal values of ``columns``, as record batches; a run may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in columns])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        if held:
            before = [held[-1].column(c)[held[-1].num_rows - 1].as_py() for c in columns]
            if before != keys[:, 0].tolist():
                yield held
                held = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b == batch.num_rows:
                held.append(batch.slice(a, b - a))
            else:
                yield [*held, batch.slice(a, b - a)]
                held = []
    if held:
        yield held


#: Runs of rows up to this size are compared all at once, by the distance of their rows in the run.
SMALL = 16


def _whole_runs(batches, columns: list[str]):
    """The columns of the rows as arrays, in parts that never cut a run of equal ``columns``."""
    names = [*columns, "rep", "n", "comp", "side"]
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        col = {c: batch.column(c).to_numpy() for c in names}
        col["sig"] = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(-1, CODES)
        if held:
            col = {c: np.concatenate([held[c], v]) for c, v in col.items()}
        last = np.ones(len(col["rep"]), bool)
        for c in columns:
            last &= col[c] == col[c][-1]
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        held = {c: v[cut:] for c, v in col.items()}
        if cut:
            yield {c: v[:cut] for c, v in col.items()}
    if held:
        yield held


def _fit(col: dict, i, j) -> np.ndarray:
    """Whether the rows i and j of a tile are to be compared: in different components, of sizes that can link, and on
    the sides that the tile is for."""
    a, b, s, t = col["n"][i], col["n"][j], col["side"][i], col["side"][j]
    right, left = col["right"][i], col["left"][i]
    sides = np.where(right >= 0, (s < 0) != (t < 0), (-1 - right == left) | (s != t))
    return sides & (col["comp"][i] != col["comp"][j]) & (4 * np.minimum(a, b) >= 3 * np.maximum(a, b))


def _small_runs(col: dict, run: np.ndarray, small: np.ndarray, both_sides: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a small run, the distance and the place of its nearest row."""
    nearest, to = np.full(len(run), CODES + 1, np.int16), np.zeros(len(run), np.int64)
    speaks = both_sides | (col["side"] >= 0)
    for step in range(1, SMALL):
        i = np.flatnonzero((run[step:] == run[:-step]) & small[step:]) if step < len(run) else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[_fit(col, i, i + step)]
        for at in range(0, len(i), 20_000):
            x = i[at:at + 20_000]
            far = (col["sig"][x] != col["sig"][x + step]).sum(1, dtype=np.int16)
            for one, other in ((x, x + step), (x + step, x)):
                better = (far < nearest[one]) & speaks[one]
                nearest[one[better]], to[one[better]] = far[better], other[better]
    return nearest, to


def _large_run(col: dict, both_sides: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rep, rep of its nearest row, distance: for the rows of one tile that have a row within the distance."""
    sig, out = col["sig"], [[], [], []]
    mine = np.flatnonzero(col["side"] >= 0)
    theirs = np.flatnonzero(col["side"] < 0) if col["right"][0] >= 0 else mine
    closest, to = np.full(len(theirs), CODES + 1, np.int64), np.zeros(len(theirs), np.int64)
    if not len(mine) or not len(theirs):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    step = max(1, 1_000_000 // (CODES * len(theirs)))
    for at in range(0, len(mine), step):
        i = mine[at:at + step]
        far = (sig[i][:, None, :] != sig[theirs][None, :, :]).sum(2, dtype=np.int16)
        far[~_fit(col, i[:, None], theirs[None, :]) | (far > FAR)] = CODES + 1
        if both_sides and col["right"][0] >= 0:
            best, low = far.argmin(0), far.min(0)
            to = np.where(low < closest, i[best], to)
            closest = np.minimum(closest, low)
        best = far.argmin(1)
        x = np.flatnonzero(far[np.arange(len(i)), best] <= FAR)
        out[0].append(col["rep"][i[x]])
        out[1].append(col["rep"][theirs[best[x]]])
        out[2].append(far[x, best[x]].astype(np.int64))
    x = np.flatnonzero(closest <= FAR)
    for c, values in enumerate((col["rep"][theirs[x]], col["rep"][to[x]], closest[x])):
        out[c].append(values)
    return tuple(np.concatenate(c) for c in out)


def _nearest(tiles: DataFrame, both_sides: bool) -> DataFrame:
    """a, b: the nearest row within the distance in another component, of each row outside the key's largest
    component, and of each row inside it too with ``both_sides``."""
    def run(batches):
        for col in _whole_runs(batches, ["key", "left", "right"]):
            edge = np.flatnonzero(np.concatenate([[True], (col["key"][1:] != col["key"][:-1]) | (col["left"][1:] != col["left"][:-1])
                                                  | (col["right"][1:] != col["right"][:-1])]))
            size = np.diff(np.append(edge, len(col["rep"])))
            far, to = _small_runs(col, np.repeat(np.arange(len(edge)), size), np.repeat(size <= SMALL, size), both_sides)
            x = np.flatnonzero(far <= FAR)
            found = [[col["rep"][x]], [col["rep"][to[x]]], [far[x].astype(np.int64)]]
            for k in np.flatnonzero(size > SMALL):
                for c, values in enumerate(_large_run({n: v[edge[k]:edge[k] + size[k]] for n, v in col.items()}, both_sides)):
                    found[c].append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["a", "b", "far"])
    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.repartition(parts, "key", "left", "right").sortWithinPartitions("key", "left", "right")
    found = dealt.select("key", "left", "right", "rep", "n", "comp", "side", "sig").mapInArrow(run, "a long, b long, far long")
    found = found.groupBy("a").agg(F.min(F.struct("far", "b")).alias("to")).selectExpr("a", "to.b AS b")
    return found.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """rep and its whole set, for the representatives that take part in a pair."""
    def per_batch(batch):
        for part in slices(batch, "text"):
            sets = [shingle_set(t) for t in part.column("text").to_pylist()]
            keep = [k for k, s in enumerate(sets) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(keep, pa.int32())), pa.array([sets[k].tobytes() for k in keep], pa.binary())], ["rep", "shingles"])
    return arrow_map(docs.join(nodes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), per_batch, "rep long, shingles binary")


class _Common:
    """Counts of common shingles among the rows of a tile: bit rows over the shingles that two rows or more have."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        place = np.cumsum(shared) - 1
        self.bits = None
        if len(sets) * int(shared.sum()) <= 64_000_000:
            bits = np.zeros((len(sets), -(-int(shared.sum()) // 64) * 64), np.uint8)
            row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            keep = shared[column]
            bits[row[keep], place[column[keep]]] = 1
            self.bits = np.packbits(bits, axis=1).view(np.uint64)

    def __call__(self, one: int, others: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            return np.bitwise_count(self.bits[one] & self.bits[others]).sum(1, dtype=np.int64)
        mine = self.sets[one]  # very long sets: one merge at a time
        out = []
        for k in others:
            both = np.concatenate([mine, self.sets[k]])
            both.sort(kind="stable")
            out.append(int((both[1:] == both[:-1]).sum()))
        return np.array(out, np.int64)


def _confirmed(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links whose components are those of all links inside the clusters (rep, comp)."""
    def run(batches):
        for parts in _runs(batches, ["comp", "left", "right"]):
            col = {c: np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("rep", "block")}
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for p in parts for x in p.column("shingles")]
            if len(sets) < 2:
                continue
            n, common, part, out = np.array([len(s) for s in sets]), _Common(sets), np.arange(len(sets)), []
            two = parts[0].column("left")[0].as_py() != parts[0].column("right")[0].as_py()
            for x in range(len(sets) - 1):
                y = np.arange(x + 1, len(sets))
                y = y[(part[y] != part[x]) & (4 * np.minimum(n[y], n[x]) >= 3 * np.maximum(n[y], n[x]))]
                if two:
                    y = y[col["block"][y] != col["block"][x]]
                if len(y):
                    both = common(x, y)
                    y = y[100 * both >= 75 * (n[x] + n[y] - both)]
                    joined, first = np.unique(part[y], return_index=True)
                    out += [(int(col["rep"][x]), int(col["rep"][y[k]])) for k in first]
                    part[np.isin(part, joined)] = part[x]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(2)], ["a", "b"])
    sizes = clusters.groupBy("comp").agg(F.count(F.lit(1)).alias("m")).where("m > 1").selectExpr(
        "comp", f"CAST(ceil(m / least(greatest(ceil(m / {BLOCK_SHARE}), {BLOCK_LEAST}), {BLOCK_MOST})) AS INT) AS blocks")
    rows = clusters.join(sizes, "comp").selectExpr("comp", "rep", "blocks", "CAST(pmod(xxhash64(rep), blocks) AS INT) AS block")
    rows = rows.selectExpr("comp", "rep", "block", "explode(sequence(0, blocks - 1)) AS other").selectExpr(
        "comp", "rep", "block", "least(block, other) AS left", "greatest(block, other) AS right").join(sets, "rep")
    parts = int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "comp", "left", "right").sortWithinPartitions("comp", "left", "right")
    return dealt.select("comp", "left", "right", "rep", "block", "shingles").mapInArrow(run, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """node and comp, the smallest node reachable, for the ends of ``edges`` (a, b).

    Every round each node takes the smallest neighbour of its neighbours and edges move to it (large and small stars);
    rounds are written to the shared folder, and end when every edge points at a smallest node."""
    edges = materialize(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct(), "cc")
    while True:
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).selectExpr("a", "least(a, low) AS low")
        large = both.where("b > a").join(low, "a").selectExpr("b AS a", "low AS b").where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").selectExpr("CASE WHEN b = low THEN a ELSE b END AS a", "low AS b").where("a <> b").distinct()
        after = materialize(small, "cc")
        ends = after.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        # stars: each node has one edge, and no centre is a node with an edge
        loose = ends.where("n > 1").limit(1).unionByName(
            after.select(F.col("b").alias("a")).distinct().join(ends, "a").select("a", "n").limit(1)).count()
        edges = after
        if not loose:
            return edges.selectExpr("a AS node", "b AS comp").unionByName(
                edges.selectExpr("b AS node", "b AS comp").distinct())


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    plain = documents_of(docs, id_col, text_col)
    rows = materialize(signatures(plain), "signatures")
    classes = materialize(rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest", "sig", "n")
                          .agg(F.min("doc_id").alias("rep")), "classes")
    crowded = materialize(crowded_rows(key_rows(classes)), "crowded")
    reps = crowded.select("rep").distinct()
    sigs = classes.select("rep", "sig").join(reps, "rep", "left_semi")
    clusters = reps.withColumn("comp", F.col("rep"))
    pairs = None
    while True:
        more = materialize(_nearest(_tiles(crowded, clusters, sigs), both_sides=pairs is None), "pairs")
        if pairs is not None and more.isEmpty():
            break
        pairs = more if pairs is None else pairs.unionByName(more)
        paired = materialize(connected(pairs), "clusters").withColumnRenamed("node", "rep")
        clusters = reps.join(paired, "rep", "left").selectExpr("rep", "coalesce(comp, rep) AS comp")
    sets = materialize(_sets_of(plain, paired), "sets")  # only rows that have another within the distance
    links = materialize(_confirmed(paired, sets), "links")
    settled = connected(links)
    classes = classes.join(settled.withColumnRenamed("node", "rep"), "rep", "left") \
        .selectExpr("digest", "coalesce(comp, rep) AS component_id")
    out = rows.select("doc_id", "n", "digest").join(classes, "digest", "left")
    return out.selectExpr("doc_id", "n AS n_shingles", "coalesce(component_id, doc_id) AS component_id",
                          "coalesce(doc_id = coalesce(component_id, doc_id), true) AS kept")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the one with its smallest id, with all columns.  Rows without words or without
    an id stay.  Of rows that share an id the one with the smallest text stays."""
    of, stays, nth = spare_names(docs, 3)
    found = materialize(components_of(docs, id_col, text_col).where("doc_id IS NOT NULL")
                        .groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
                        .where("NOT kept OR n > 1").select(F.col("doc_id").alias(of), F.col("kept").alias(stays)), "dropped")
    same = F.col(f"`{id_col}`") == F.col(of)
    rows = docs.join(found, same, "left_anti")
    again = docs.join(found.where(F.col(stays)), same, "left_semi")
    first = Window.partitionBy(f"`{id_col}`").orderBy(F.col(f"`{text_col}`").asc_nulls_first())
    again = again.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).drop(nth)
    return rows.unionByName(again)
