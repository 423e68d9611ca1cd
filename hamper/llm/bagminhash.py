"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, banding, exact verification.

A document is the multiset of its five-word shingles (words: runs without ASCII white space,
A-Z lower-cased; a text of one to four words is one shingle). The similarity of two
documents is the sum of the smaller multiplicities over the sum of the larger ones.

Signatures (``signatures``): a shingle of multiplicity w stands for the weight interval
[0, w), cut at the powers of two into blocks [0,1), [1,2), [2,4), [4,8)... Every block of
every shingle carries a Poisson process, seeded by the shingle's hash, whose points name a
signature component; a component keeps the smallest point it sees. A block wider than one
unit is split hierarchically: its first point falls into one half, the other half's first
point follows by an exponential gap, so halves beyond w are dropped and halves whose first
point lies above all components so far are never opened. Two documents agree in a component
with probability equal to their weighted Jaccard similarity; the work is about one point per
shingle plus m log m, not m per shingle.

Job (``near_duplicates``): equal multisets collapse to one node; signatures are banded, and of the
bands only those that pass a Bloom filter of the shared buckets are moved to them; each
node is verified against the most central node it shares a bucket with, which gives a forest
whose trees are joined by pointer jumping; buckets that still hold several trees are
compared in bounded tiles, tree against tree, and what those links join is merged. So every
pair that shares a bucket ends up in one class or has been verified not to be similar, and
no bucket is expanded into all its pairs if its members are already one class. Bands are cut
from the stored signatures when they are needed, multisets are made from the texts where they
are compared, and stored rows that all readers have read are deleted while the job runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hamper.llm.common import drop_rows, stage, trim
from hamper.llm.url_filter import build_bloom, possible_hits
from hamper.session import drop_folders, materialize_bucketed, recorded_scratch

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
M = BANDS * ROWS
BAND_BITS = (BANDS - 1).bit_length()   # the low bits of a bucket name its band
#: A pair at the threshold agrees in 0.8 * M components, with a standard deviation of 0.032;
#: pairs whose signatures agree in fewer than this share are five deviations below.
LEAST_AGREEMENT = 0.64
TILE = 256              # members of a bucket compared at a time, on either side
BROADCAST_ROWS = 1_000_000
BLOOM_KEYS = 25_000_000  # at 16 bits a key, a filter of 56 MB at most: one that is overfull lets more pass
BATCH_BYTES = 1 << 20   # text handled at a time: a Python worker's arrays hold some 60 bytes per byte
U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


# ---------------------------------------------------------------- shingles
def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, multiplicity) of a batch, ordered by document and hash."""
    lengths = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    doc_start = np.cumsum(lengths + 1) - (lengths + 1)
    solid = ~_SPACE[raw]
    starts = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
    empty = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not len(starts):
        return empty
    # hash of each word: a polynomial in its bytes
    at = np.flatnonzero(solid).astype(np.int32)
    first_at = np.searchsorted(at, starts)                     # of each word, among the solid bytes
    lengths = np.diff(np.r_[first_at, len(at)])
    place = np.arange(len(at), dtype=np.int32) - np.repeat(first_at.astype(np.int32), lengths)
    powers = np.multiply.accumulate(np.r_[U(1), np.full(int(place.max()), 0x100000001B3, np.uint64)])
    word = mix(np.add.reduceat((_LOWER[raw[at]].astype(np.uint64) + U(1)) * powers[place], first_at))
    doc = np.searchsorted(doc_start, starts, side="right") - 1
    n = len(word)
    first_word = np.r_[True, doc[1:] != doc[:-1]]
    full = np.zeros(n, bool)
    if n >= SHINGLE:
        full[: n - SHINGLE + 1] = doc[: n - SHINGLE + 1] == doc[SHINGLE - 1:]
    begin = full | first_word       # the first word of a short text begins its only shingle
    h = np.zeros(n, np.uint64)
    for j in range(min(SHINGLE, n)):
        same = np.zeros(n, bool)
        same[: n - j] = doc[: n - j] == doc[j:]
        w = np.zeros(n, np.uint64)
        w[: n - j] = word[j:]
        h = np.where(same, mix(h * U(0x9E3779B97F4A7C15) + w + U(j)), h)
    doc, h = doc[begin], h[begin]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])
    return doc[new], h[new], np.diff(np.r_[new, len(h)])


# ---------------------------------------------------------------- signatures
def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int = M) -> np.ndarray:
    """BagMinHash signatures (n_docs x m points, inf where a document has no element)."""
    least = np.full(n_docs * m, np.inf)
    # one node per element and block: node = (document, seed, low end, width, weight, point)
    parts = []
    j, remaining = 0, np.arange(len(doc))
    while len(remaining):
        low, width = (0, 1) if j == 0 else (1 << (j - 1), 1 << (j - 1))
        seed = mix(element[remaining] ^ U(j * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        x = -np.log(uniform(mix(seed + U(1)))) / width
        k = len(remaining)
        parts.append((doc[remaining], seed, np.full(k, low, np.int64), np.full(k, width, np.int64), weight[remaining], x))
        j += 1
        remaining = remaining[weight[remaining] > (1 << (j - 1))]
    if not parts:
        return least.reshape(n_docs, m)
    d, seed, low, width, top, x = (np.concatenate(c) for c in zip(*parts))
    while len(d):
        leaf = width == 1
        # points of single units reach their component, then the unit's next point follows
        ld, ls, lx = d[leaf], seed[leaf], x[leaf]
        draw = mix(ls + U(2))
        np.minimum.at(least, ld * m + (draw % U(m)).astype(np.int64), lx)
        ls = mix(ls + U(3))
        lx = lx - np.log(uniform(mix(ls + U(1))))
        nodes = [(ld, ls, low[leaf], width[leaf], top[leaf], lx)]
        if not leaf.all():
            # wider nodes split: one half holds the point, the other's first point comes later
            wide = ~leaf
            wd, ws, wl, half, wt, wx = d[wide], seed[wide], low[wide], width[wide] >> 1, top[wide], x[wide]
            right = (mix(ws + U(4)) >> U(63)).astype(bool)
            later = wx - np.log(uniform(mix(ws + U(5)))) / half
            nodes.append((wd, mix(ws + U(6)), wl, half, wt, np.where(right, later, wx)))
            inside = wl + half < wt
            nodes.append((wd[inside], mix(ws + U(7))[inside], (wl + half)[inside], half[inside], wt[inside],
                          np.where(right, wx, later)[inside]))
        d, seed, low, width, top, x = (np.concatenate(c) for c in zip(*nodes))
        going = x <= least.reshape(n_docs, m).max(1)[d]
        d, seed, low, width, top, x = (a[going] for a in (d, seed, low, width, top, x))
    return least.reshape(n_docs, m)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two multisets given as (sorted distinct hashes, multiplicities)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    every = int(a[1].sum()) + int(b[1].sum()) - both
    return both / every if every else 0.0


def _batches(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a column of texts, in slices of about BATCH_BYTES."""
    start, held, texts = 0, 0, []
    for i, t in enumerate(column):
        texts.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
        held += len(texts[-1])
        if held >= BATCH_BYTES:
            yield start, texts
            start, held, texts = i + 1, 0, []
    if texts:
        yield start, texts


def _multisets(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted distinct hashes, multiplicities) of each text."""
    for _, texts in _batches(column):
        doc, h, c = shingles(texts)
        at = _split(doc, len(texts))
        for a, b in zip(at[:-1], at[1:]):
            yield h[a:b], c[a:b]


def _split(doc: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(doc, np.arange(n + 1))


def _key(h: np.ndarray, c: np.ndarray) -> bytes:
    """Name of a multiset: a 128-bit digest of its hashes and multiplicities."""
    return hashlib.blake2b(h.tobytes() + c.astype("<i8").tobytes(), digest_size=16).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in _batches(batch.column(1)):
            n = len(texts)
            doc, h, c = shingles(texts)
            at = _split(doc, n)
            points = signatures(doc, h, c, n)
            full = at[1:] > at[:-1]
            keys = [_key(h[a:b], c[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:])]
            sig = mix(points.view(np.uint64)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, n), pa.array(keys, pa.binary()),
                 pa.array([sig[i].tobytes() if full[i] else None for i in range(n)], pa.binary())],
                names=["doc_id", "key", "sig"])
    trim()


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the name of their multiset; those without shingles have none."""
    for batch in batches:
        keys = [_key(h, c) if len(h) else None for h, c in _multisets(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(0)], names=["key", "text"])
    trim()


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = [weighted_jaccard(a, b) for a, b in zip(_multisets(batch.column(2)), _multisets(batch.column(3)))]
            good = pa.array(np.array(sims) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())],
                                             names=["a", "b", "similarity"]).filter(good)
        trim()
    return run


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, signature of a, signature of b): the pairs that agree often enough."""
    for batch in batches:
        sa = np.array([np.frombuffer(s.as_buffer(), np.uint16) for s in batch.column(2)]).reshape(-1, M)
        sb = np.array([np.frombuffer(s.as_buffer(), np.uint16) for s in batch.column(3)]).reshape(-1, M)
        good = (sa == sb).mean(1) >= LEAST_AGREEMENT
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good))


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each tile (first column), of batches sorted by it."""
    held, tile = [], None
    for batch in batches:
        tiles = batch.column(0).to_numpy()
        cuts = np.flatnonzero(tiles[1:] != tiles[:-1]) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(tiles)]):
            if b > a:
                if tile is not None and tiles[a] != tile:
                    yield pa.Table.from_batches(held)
                    held = []
                tile = tiles[a]
                held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield pa.Table.from_batches(held)


def _tile_matches(t: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(left row, right rows) of a tile that may be links: in other trees, with agreeing
    signatures, and with this bucket the first that the two share (so one tile has the pair)."""
    names, root = np.unique(np.array(t["root"].to_pylist(), object), return_inverse=True)
    left = t["left"].to_numpy().astype(bool)
    sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, M)
    bucket = t["bucket"].to_numpy()
    bands, band = sig.reshape(-1, BANDS, ROWS), bucket & ((1 << BAND_BITS) - 1)
    right = np.flatnonzero(~left)
    for i in np.flatnonzero(left):
        near = right[((sig[right] == sig[i]).mean(1) >= LEAST_AGREEMENT) & (root[right] != root[i]) & (bucket[right] == bucket[i])]
        if len(near):
            shared = (bands[near] == bands[i]).all(2)
            near = near[shared.argmax(1) == band[i]]
            if len(near):
                yield i, near


MEMBER = "tile long, bucket long, key binary, root binary, left boolean"


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each tile that have a possible partner in it."""
    for t in _by_tile(batches):
        keep = np.zeros(t.num_rows, bool)
        for i, near in _tile_matches(t):
            keep[i] = True
            keep[near] = True
        if keep.any():
            yield from t.select(["tile", "bucket", "key", "root", "left"]).filter(pa.array(keep)).combine_chunks().to_batches()


def _tile_links(similarity: float):
    """Links of each tile: its possible pairs, verified by their exact multisets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_tile(batches):
            keys = t["key"].to_pylist()
            bags = list(_multisets(t["text"]))
            found = [(keys[i], keys[j]) for i, near in _tile_matches(t) for j in near
                     if weighted_jaccard(bags[i], bags[j]) >= similarity]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()),
                                                  pa.array([b for _, b in found], pa.binary())], names=["a", "b"])
        trim()
    return run


PAIR = "a binary, b binary"


def _possible(rows: DataFrame, column: str, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """The rows whose ``column`` may be in ``wanted`` (one column): a broadcast Bloom filter rules out
    most others where they are, so that they are not moved to a join."""
    bloom, n_blocks = build_bloom(wanted.toDF("key"), min(n_wanted, BLOOM_KEYS))
    return possible_hits(rows.withColumnRenamed("key", "_key").withColumnRenamed(column, "key"), bloom, n_blocks) \
        .withColumnRenamed("key", column).withColumnRenamed("_key", "key")


def _buckets() -> list[Column]:
    """The buckets of column ``sig``: a hash of each band's components, whose low bits name the band."""
    width = 2 * ROWS
    return [F.shiftleft(F.xxhash64(F.substring("sig", b * width + 1, width)), BAND_BITS).bitwiseOR(F.lit(b).cast("long"))
            for b in range(BANDS)]


def _shared_bands(nodes: DataFrame) -> DataFrame:
    """(bucket, key, n): the bands of nodes that fall into a bucket of n > 1 nodes."""
    banded = nodes.select("key", F.explode(F.array(*_buckets())).alias("bucket"))
    shared = stage(banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "near-buckets")
    hits = _possible(banded, "bucket", shared.select("bucket"), shared.count())
    return stage(hits.join(shared, "bucket").select("bucket", "key", "n"), "near-held")


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, text): a text of each node in ``wanted`` (distinct keys). Their words take less room than
    the hashes of their shingles, so multisets are made of them where they are compared."""
    wanted = stage(wanted.join(nodes.select("key", "rep"), "key"), "near-wanted")
    ids = wanted.select(F.col("rep").alias("doc_id")).distinct()
    n = wanted.count()
    if n <= BROADCAST_ROWS:   # 8 bytes a row; else a shuffled join of the texts that a filter lets pass
        ids = F.broadcast(ids)
    else:
        docs = _possible(docs, "doc_id", ids, n)
    texts = (docs.join(ids, "doc_id", "left_semi").select(F.col("text").cast("binary").alias("text"))
             .mapInArrow(_keyed, "key binary, text binary"))
    # an id that repeats brings texts nobody asked for, copies bring the same multiset again
    return materialize_bucketed(texts.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "key")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b, similarity) among candidate pairs, by the exact multisets of their texts."""
    with recorded_scratch() as read:
        texts = _texts(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), nodes, docs)
        # many pairs may share their first member: its text is no bucketed side, so that a hot one is split
        firsts = stage(texts.join(pairs.select(F.col("a").alias("key")).distinct(), "key", "left_semi"), "near-firsts")
    side = lambda df, k: df.select(F.col("key").alias(k), F.col("text").alias(f"t{k}"))
    links = stage(pairs.join(side(firsts, "a"), "a").join(side(texts, "b"), "b").select("a", "b", "ta", "tb")
                  .mapInArrow(_verify(similarity), PAIR + ", similarity double"), "near-links")
    drop_folders(docs.sparkSession, read)
    return links


def _roots(parents: DataFrame) -> DataFrame:
    """(key, root) of a forest given as (key, parent), by pointer jumping."""
    while True:
        step = parents.select("key", F.col("parent").alias("p")).join(
            parents.select(F.col("key").alias("p"), F.col("parent").alias("up")), "p", "left")
        parents = stage(step.select("key", F.coalesce("up", "p").alias("parent"), F.col("up").isNotNull().alias("moved")),
                        "near-jump")
        if parents.where("moved").isEmpty():
            return parents.select("key", F.col("parent").alias("root"))
        parents = parents.select("key", "parent")


def components(links: DataFrame) -> DataFrame:
    """(key, root): smallest key of each connected component, over links (a, b).

    Each round every node takes the smallest label around it and then its label's label;
    rounds go with the logarithm of the longest shortest path in practice.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                 "near-both")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("b"))
                   .select(F.col("a").alias("key"), F.least("a", "b").alias("root")), "near-labels")
    while True:
        around = (both.join(labels.select(F.col("key").alias("b"), "root"), "b").groupBy(F.col("a").alias("key"))
                  .agg(F.min("root").alias("near")))
        better = labels.join(around, "key").select("key", F.col("root").alias("old"),
                                                   F.least("root", "near").alias("root"))
        jump = better.alias("x").join(labels.alias("y"), F.col("x.root") == F.col("y.key"), "left").select(
            "x.key", "x.old", F.least("x.root", F.coalesce("y.root", "x.root")).alias("root"))
        jump = stage(jump, "near-labels")
        labels = jump.select("key", "root")
        if jump.where("old <> root").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest id of the class), kept (the row that names its class).

    Classes are the connected components of the links of at least ``similarity``; one row per
    document. Every document of a class but the one with the smallest id can go.

    Defined cases: a null or empty text (or one of white space) has no shingles, resembles
    nothing and is a class of its own; equal multisets are one class whatever their number; a
    null id takes no part (class null, kept); rows that repeat an id share the id's smallest
    class if their texts differ; a text of any length counts whole, one above ``BATCH_BYTES`` is
    handled by itself; other columns take no part, whatever their names; an empty table gives an
    empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = rows.where("doc_id is not null")
    with recorded_scratch() as read:
        signed = stage(named.mapInArrow(_sign, "doc_id long, key binary, sig binary"), "near-signed")
    # bucketed by key: what joins the signatures below brings its own few rows to them
    nodes = materialize_bucketed(
        signed.where("key is not null").groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "key")
    keys = stage(signed.select("doc_id", "key"), "near-keys")
    drop_folders(docs.sparkSession, read)
    held = _shared_bands(nodes)

    # first pass: each node against the most central node it shares a bucket with. The text that
    # a family of near copies was made from shares more buckets with them than they do with
    # each other, so the sum of its buckets' sizes is the family's largest.
    central = stage(held.groupBy("key").agg(F.sum("n").alias("weight")), "near-central")
    centers = stage(held.join(central, "key").groupBy("bucket").agg(F.max(F.struct("weight", "key")).alias("center")),
                    "near-centers")
    first = (held.join(centers, "bucket").groupBy("key").agg(F.max("center").alias("c")).join(central, "key")
             .where("c > struct(weight, key)").select(F.col("c.key").alias("a"), F.col("key").alias("b")))
    first = stage(first, "near-first-pairs")
    sig = lambda df, k: df.select(F.col("key").alias(k), F.col("sig").alias(f"s{k}"))
    hubs = stage(nodes.join(first.select(F.col("a").alias("key")).distinct(), "key", "left_semi").select("key", "sig"), "near-hubs")
    likely = stage(first.join(sig(hubs, "a"), "a").join(sig(nodes, "b"), "b").select("a", "b", "sa", "sb")
                   .mapInArrow(_agreeing, PAIR), "near-first")
    links = _verified(likely, nodes, named, similarity)
    trees = _roots(links.select(F.col("b").alias("key"), F.col("a").alias("parent")))
    trees = stage(trees.where("key <> root"), "near-trees")

    # second pass: buckets that hold several trees, all members outside the largest tree
    # against all members of other trees, in tiles
    placed = stage(held.select("bucket", "key", "n").join(trees, "key", "left")
                   .select("bucket", "key", "n", F.coalesce("root", "key").alias("root")), "near-placed")
    per_tree = placed.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    mixed = stage(per_tree.groupBy("bucket").agg(
        F.count("*").alias("trees"), F.max(F.struct("size", "root")).alias("most"), F.sum("size").alias("n"))
        .where("trees > 1").select("bucket", F.col("most.root").alias("largest"),
                                   F.ceil(F.col("n") / TILE).cast("int").alias("right_groups"),
                                   F.ceil((F.col("n") - F.col("most.size")) / TILE).cast("int").alias("left_groups")),
        "near-mixed")
    member = placed.drop("n").join(mixed, "bucket").withColumn("h", F.xxhash64("key"))
    lefts = member.where("root <> largest").select(
        "bucket", "key", "root", F.lit(True).alias("left"), F.pmod("h", "left_groups").alias("i"),
        F.explode(F.expr("sequence(0L, right_groups - 1L)")).alias("j"))
    rights = member.select(
        "bucket", "key", "root", F.lit(False).alias("left"),
        F.explode(F.expr("sequence(0L, left_groups - 1L)")).alias("i"), F.pmod("h", "right_groups").alias("j"))
    tiles = lefts.unionByName(rights).select(F.xxhash64("bucket", "i", "j").alias("tile"), "bucket", "key", "root", "left")

    def in_tiles(df: DataFrame) -> DataFrame:
        return df.repartition("tile").sortWithinPartitions("tile")
    signed_rows = tiles.join(nodes.select("key", "sig"), "key").select(*tiles.columns, "sig")
    survivors = stage(in_tiles(signed_rows).mapInArrow(_survivors, MEMBER), "near-survivors")
    with recorded_scratch() as read:
        texts = _texts(survivors.select("key").distinct(), nodes, named)
    full_rows = survivors.join(nodes.select("key", "sig"), "key").join(texts, "key").select(*tiles.columns, "sig", "text")
    more = stage(in_tiles(full_rows).mapInArrow(_tile_links(similarity), PAIR).distinct(), "near-second")
    drop_folders(docs.sparkSession, read)

    # trees joined by the second pass's links
    root_of = lambda k: trees.select(F.col("key").alias(k), F.col("root").alias(f"r{k}"))
    joined = (more.select("a", "b").join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
              .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct())
    merged = components(joined)

    in_class = stage(nodes.select("key", "rep").join(trees, "key", "left").select("key", "rep", F.coalesce("root", "key").alias("r"))
                     .join(merged.select(F.col("key").alias("r"), F.col("root").alias("top")), "r", "left")
                     .select("key", "rep", F.coalesce("top", "r").alias("top")), "near-in-class")
    # stored, so that the members of a large class meet its name in a join that can be split
    named_class = stage(in_class.groupBy("top").agg(F.min("rep").alias("class_id")), "near-names")
    classes = stage(in_class.join(named_class, "top").select("key", "class_id"), "near-classes")
    done = keys.join(classes, "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    nameless = rows.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return done.unionByName(nameless).select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each class, and rows without an id."""
    found = near_duplicates(docs, id_col, text_col)
    # an id that several rows carry goes only if all of them do
    gone = (found.where("doc_id is not null").groupBy("doc_id").agg(F.bool_or("kept").alias("any"))
            .where("not any").select("doc_id"))
    return drop_rows(docs, gone, doc_id=F.col(id_col))
