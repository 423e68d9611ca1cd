"""Prefix trie of conversations over a minimal-perfect-hash node table.

A node stands for each distinct sequence of first d turns; conversations that begin with it
are its members. Trie figures (members, children, leaves, tokens that sharing saves) come from
node tables that are sharded by conversation and so never hold a whole subtree:

1. ``prefixes``: every turn's prefix gets a 128-bit digest, the chain of its turns' digests.
   Chains are cut into bands of ``BAND`` turns: a band's own digest needs its turns alone and
   the bands' digests chain on, so a conversation of any length is worked on in parallel.
2. ``_local``: a shard (some conversations' rows of one band) enumerates its distinct prefix
   digests, gives them slots by a minimal perfect hash, verifies that all rows of a slot agree
   in parent, depth and last turn, and scatters member counts into flat arrays.
3. The shards' counts are added up by digest (verified once more): the node table.
4. ``_accumulate``: each shard gets its nodes' totals back. A node's own value counts in one
   shard, that of its smallest member. In depth order, from the deepest, every slot adds its
   sums to its parent's slot; all of a node's ancestors are in the shard, because they are
   prefixes of its member. What a long conversation's later bands hold comes in as one row at
   the end of the band before. The shards' partial sums are added up by digest.

So a first turn that a third of all conversations share costs one row a shard, and nothing
runs level by level over the whole trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hamper.llm.common import stage
from hamper.operators.ordering import ordered_rank

BAND = 4096             # turns of a conversation that one task chains
SHARD_ROWS = 250_000    # rows of a shard: about 200 bytes each in a worker
ROOT = bytes(16)
U = np.uint64


# ---------------------------------------------------------------- minimal perfect hash
def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ U(salt * 0x9E3779B97F4A7C15 % 2**64)) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class SlotTable:
    """Slots 0..n-1 for n distinct digests (n x 2 unsigned 64-bit): on each level a key alone in its
    cell takes it, the others go on to the next, smaller level; a slot is the cell's rank."""

    def __init__(self, keys: np.ndarray):
        self.levels, left = [], keys
        while len(left):
            cell = self._cell(left, len(self.levels), 2 * len(left))
            alone = np.bincount(cell, minlength=2 * len(left)) == 1
            self.levels.append(alone)
            left = left[~alone[cell]]
        taken = [int(a.sum()) for a in self.levels]
        self.first = np.r_[0, np.cumsum(taken)].astype(np.int64)
        self.rank = [np.cumsum(a) - a for a in self.levels]
        self.keys = np.empty((len(keys), 2), np.uint64)
        self.keys[self._find(keys)] = keys

    @staticmethod
    def _cell(keys: np.ndarray, level: int, cells: int) -> np.ndarray:
        return (_mix(keys[:, 0] ^ _mix(keys[:, 1], level + 1), level + 7) % U(cells)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, alone in enumerate(self.levels):
            cell = self._cell(keys[left], level, len(alone))
            hit = alone[cell]
            slot[left[hit]] = self.first[level] + self.rank[level][cell[hit]]
            left = left[~hit]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, verified against the key stored there; -1 for a key not held."""
        slot = self._find(keys)
        return np.where((slot >= 0) & (self.keys[slot] == keys).all(1), slot, -1) if len(self.keys) else slot


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _distinct(keys: np.ndarray) -> np.ndarray:
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    rows = keys[order]
    return rows[np.r_[True, (rows[1:] != rows[:-1]).any(1)]] if len(rows) else rows


def _binary(keys: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() for k in np.ascontiguousarray(keys)], pa.binary())


# ---------------------------------------------------------------- prefix digests
def _chain(start: bytes, steps: list[bytes]) -> list[bytes]:
    out, blake = [], hashlib.blake2b
    for step in steps:
        start = blake(start + step, digest_size=16).digest()
        out.append(start)
    return out


def band_digests(seed: bytes, steps: list[bytes], band: int) -> list[bytes]:
    """Prefix digests of a band's turns. A full band ends on the digest that chains the bands."""
    out = _chain(seed, steps)
    if len(steps) == band:
        out[-1] = _chain(seed, [_chain(b"", steps)[-1]])[0]
    return out


def _band_digest(rows: pa.Table) -> pa.Table:
    """One full band of a conversation: conv, band, its own digest."""
    rows = rows.sort_by("depth")
    return pa.table({"conv": rows["conv"][:1], "band": rows["band"][:1],
                     "own": pa.array([_chain(b"", rows["step"].to_pylist())[-1]], pa.binary())})


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, band, own) in order of conv and band -> (conv, band + 1, the prefix digest there)."""
    last, seed = None, ROOT
    for batch in batches:
        out = []
        for conv, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if conv != last:
                last, seed = conv, ROOT
            seed = _chain(seed, [own])[0]
            out.append(seed)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(batch.column(1).to_numpy() + 1),
                                          pa.array(out, pa.binary())], names=["conv", "band", "seed"])


def turn_steps(turns: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """conv, pos (1-based, by turn, null first, tied turns by their digest), step (digest of
    role and text), size (bytes of the text); rows without a conversation are left out."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    step = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = turns.select(conv.cast("long").alias("conv"), turn.alias("turn"), step.alias("step"),
                        F.octet_length(text).cast("long").alias("size")).where("conv is not null")
    return ordered_rank(rows, ["conv"], [F.col("turn").asc_nulls_first(), "step"], "pos").drop("turn")


def share_beginnings(steps: DataFrame, base: Column, head: Column) -> DataFrame:
    """Conversations rebuilt from another's beginning: the first ``head`` turns of conversation
    ``base`` (both given in terms of conv; 8 at most), then the own turns after the first ``head``.
    The rows of ``turn_steps`` without numbers; pos orders them. A conversation that is its own
    base stays as it is."""
    convs = steps.where("pos = 1").select("conv", base.alias("base"), head.alias("head")).where("conv <> base")
    first = steps.where("pos <= 8").select(F.col("conv").alias("base"), "pos", "step", "size")
    heads = (convs.join(first, "base").where("pos <= head")
             .select("conv", (F.col("pos") - 8).alias("pos"), "step", "size"))    # before the own turns
    own = steps.where((F.col("conv") == base) | (F.col("pos") > head)).select("conv", "pos", "step", "size")
    return heads.unionByName(own)


# ---------------------------------------------------------------- shards
LOCAL = ("shard int, digest binary, parent binary, step binary, depth long, size long, members long, least long, "
         "ends long, conv long")
_LOCAL = [f.split()[0] for f in LOCAL.split(", ")]


def _local(band: int):
    """One shard's trie: a row per slot, and a row (digest, conv) for every conversation that ends."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("conv", "ascending"), ("depth", "ascending")])
        conv, depth, at_band, length, size = (rows[c].to_numpy() for c in ("conv", "depth", "band", "length", "size"))
        steps, seeds = rows["step"].to_pylist(), rows["seed"].to_pylist()
        new = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (at_band[1:] != at_band[:-1])])
        digest, parent = [], []
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(conv)]):
            digest += band_digests(seeds[a] or ROOT, steps[a:b], band)
            parent += [seeds[a] or ROOT, *digest[a:b - 1]]
        key, up, last = (np.frombuffer(b"".join(x), np.uint64).reshape(-1, 2) for x in (digest, parent, steps))
        table = SlotTable(_distinct(key))
        slot, n = table.slots(key), len(table.keys)
        flat = [np.empty((n, *x.shape[1:]), x.dtype) for x in (up, last, depth, size)]
        for held, x in zip(flat, (up, last, depth, size)):
            held[slot] = x
            if not (held[slot] == x).all():
                raise ValueError("two prefixes share a digest")
        members, ends = np.bincount(slot, minlength=n), np.bincount(slot[depth == length], minlength=n)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, slot, conv)
        done = np.flatnonzero(depth == length)
        m, shard = len(done), rows["shard"][0].as_py()
        none = [pa.nulls(m, pa.binary())] * 2 + [pa.nulls(m, pa.int64())] * 5
        nodes = [pa.array([shard] * n, pa.int32()), *map(_binary, (table.keys, *flat[:2])),
                 *map(pa.array, (*flat[2:], members, least, ends)), pa.nulls(n, pa.int64())]
        over = [pa.array([shard] * m, pa.int32()), _binary(key[done]), *none, pa.array(conv[done])]
        return pa.table([pa.chunked_array([x, y.cast(x.type)]) for x, y in zip(nodes, over)], names=_LOCAL)
    return run


PARTIAL = ("digest binary, n_leaves long, saved_tokens long, n_children long, conv_id long, depth long, "
           "parent_conv_id long, n_convs long")
_PARTIAL = [f.split()[0] for f in PARTIAL.split(", ")]


def _accumulate(band: int):
    """Sums over one shard's trie. Rows: its nodes (kind 0), nodes its bands hang from (1), sums
    that come in at a node (2)."""
    return lambda rows: _sums(rows, band)


def _sums(rows: pa.Table, band: int) -> pa.Table:
    kind, depth = rows["kind"].to_numpy(), rows["depth"].to_numpy()
    key, up = _keys(rows["digest"]), _keys(rows["parent"])
    held = np.flatnonzero(kind < 2)
    table = SlotTable(_distinct(key[held]))
    slot, n = table.slots(key), len(table.keys)
    node = np.full(n, -1, np.int64)                  # row of each slot, the shard's own before a border's
    node[slot[kind == 1]], node[slot[kind == 0]] = np.flatnonzero(kind == 1), np.flatnonzero(kind == 0)
    border = kind[node] == 1
    parent = table.slots(up[node])                   # -1 above a border
    owner = rows["owner"].to_numpy(zero_copy_only=False).astype(bool)
    sums = np.zeros((n, 2), np.int64)
    values = np.stack([rows["leaves"].to_numpy(), rows["saved"].to_numpy()], 1)
    np.add.at(sums, slot[owner | (kind == 2)], values[owner | (kind == 2)])
    children = np.zeros(n, np.int64)
    mine = np.flatnonzero(owner[node] & ~border)
    np.add.at(children, parent[mine], 1)
    at = depth[node]
    order = np.argsort(-at, kind="stable")
    # not across a border below the root: what lies beyond comes in as sums of its own
    order = order[~border[order] & ((at[order] == 1) | ((at[order] - 1) % band > 0))]
    for level in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
        np.add.at(sums, parent[level], sums[level])
    least, convs = rows["least"].to_numpy()[node], rows["convs"].to_numpy()[node]
    known = owner[node] & ~border
    static = lambda x: pa.array(x, pa.int64(), mask=~known)
    return pa.table([_binary(table.keys), pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array(children), static(least),
                     static(at), static(least[parent]), static(convs)], names=_PARTIAL)


# ---------------------------------------------------------------- members that end at a node
def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, conv) in order -> (digest, first conv, the run's ids joined by commas)."""
    for batch in batches:
        digest, conv = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        cuts = [0, *(k for k in range(1, len(digest)) if digest[k] != digest[k - 1]), len(digest)]
        spans = [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
        yield pa.RecordBatch.from_arrays(
            [pa.array([digest[a] for a, _ in spans], pa.binary()), pa.array([conv[a] for a, _ in spans], pa.int64()),
             pa.array([",".join(map(str, conv[a:b].tolist())) for a, b in spans])], names=["digest", "first", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids in order -> (digest, SHA-256 of its ids joined by commas), a run at a time."""
    last, sha = None, None
    for batch in batches:
        out = []
        for digest, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if digest == last:
                sha.update(b"," + ids.encode())
                continue
            if last is not None:
                out.append((last, sha.hexdigest()))
            last, sha = digest, hashlib.sha256(ids.encode())
        yield _hashed(out)
    if last is not None:
        yield _hashed([(last, sha.hexdigest())])


def _hashed(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.binary()), pa.array([h for _, h in rows], pa.string())],
                                      names=["digest", "ends_sha256"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """digest, ends_sha256 of (digest, conv) rows. A hot node's ids are put in order and joined by many
    tasks; the last step reads one row a run."""
    runs = (ends.repartitionByRange("digest", "conv").sortWithinPartitions("digest", "conv")
            .mapInArrow(_join_ids, "digest binary, first long, ids string"))
    return (runs.repartition("digest").sortWithinPartitions("digest", "first")
            .mapInArrow(_hash_ids, "digest binary, ends_sha256 string"))


# ---------------------------------------------------------------- the trie
def trie(rebuilt: DataFrame, convs: DataFrame, band: int = BAND, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Nodes of the trie over conversations given as rows (conv, pos, step, size), pos in any
    numbers that order a conversation's turns, and the list of all conversations (conv; one
    without rows is a member of the root alone).

    Returns node (digest, hex), conv_id (smallest member), depth, parent_conv_id (the parent's
    conv_id; null for the root), n_convs, n_children, n_leaves (childless nodes of the subtree),
    saved_tokens (over the subtree, (n_convs - 1) * size), ends_sha256 (SHA-256 of the members that
    end here, ascending, joined by commas). No conversation: no node, not even the root.
    """
    spark = rebuilt.sparkSession
    rows = ordered_rank(rebuilt, ["conv"], ["pos"], "depth", "length")
    in_band = F.floor((F.col("depth") - 1) / band).cast("long")
    rows = stage(rows.select("conv", "depth", "length", in_band.alias("band"), "step", "size"), "trie-rows")
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")), rows.count() // shard_rows)
    # five neighbours share beginnings: in one shard they share rows
    shard = lambda conv, at: F.pmod(F.xxhash64(F.floor(conv / 5), at), F.lit(shards)).cast("int")

    full = rows.where((F.col("band") + 1) * band < F.col("length"))
    bands = full.groupBy("conv", "band").applyInArrow(_band_digest, "conv long, band long, own binary")
    seeds = stage(bands.repartition("conv").sortWithinPartitions("conv", "band")
                  .mapInArrow(_seeds, "conv long, band long, seed binary"), "trie-seeds")
    local = stage(rows.join(seeds, ["conv", "band"], "left").withColumn("shard", shard(F.col("conv"), F.col("band")))
                  .groupBy("shard").applyInArrow(_local(band), LOCAL), "trie-local", "zstd")

    slots = local.where("conv is null").drop("conv")
    same = F.lit(True)
    for c in ("parent", "step", "depth", "size"):
        same = same & (F.min(c) == F.max(c))
    nodes = slots.groupBy("digest").agg(
        F.sum("members").alias("convs"), F.min("least").alias("first"), F.sum("ends").alias("over"),
        F.when(~same, F.raise_error(F.lit("two prefixes share a digest")).cast("boolean")).alias("verified"))
    total = stage(slots.join(nodes.where("verified is null").drop("verified"), "digest").select(
        "shard", "digest", "parent", "depth", F.col("first").alias("least"), "convs",
        (F.col("least") == F.col("first")).alias("owner"), (F.col("over") == F.col("convs")).cast("long").alias("leaves"),
        ((F.col("convs") - 1) * F.col("size")).alias("saved")), "trie-nodes", "zstd")

    # long conversations: what their later bands own comes in at the end of each band before, and
    # a band's first nodes find their parent at the band's border
    later = (total.where(F.col("owner") & (F.col("depth") > band))
             .groupBy(F.col("least").alias("conv"), in_band.alias("band"))
             .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    down = Window.partitionBy("conv").orderBy(F.desc("band"))    # one row a band
    carried = seeds.join(later, ["conv", "band"], "left").select(
        "conv", "band", "seed", *(F.coalesce(F.sum(c).over(down), F.lit(0)).alias(c) for c in ("leaves", "saved")))
    none = F.lit(0).cast("long")
    carried = carried.select(
        shard(F.col("conv"), F.col("band") - 1).alias("shard"), F.col("seed").alias("digest"), F.lit(ROOT).alias("parent"),
        none.alias("depth"), none.alias("least"), none.alias("convs"), F.lit(False).alias("owner"), "leaves", "saved",
        F.lit(2).alias("kind"))
    borders = (seeds.join(total.where("owner").select(F.col("digest").alias("seed"), "depth", "least", "convs"), "seed")
               .select(shard(F.col("conv"), F.col("band")).alias("shard"), F.col("seed").alias("digest"),
                       F.lit(ROOT).alias("parent"), "depth", "least", "convs", F.lit(False).alias("owner"),
                       none.alias("leaves"), none.alias("saved"), F.lit(1).alias("kind")))
    members = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    roots = (total.where("depth = 1").select("shard").distinct().select("shard", F.lit(ROOT).alias("digest"), F.lit(ROOT).alias("parent"),
             none.alias("depth"), members.select("conv").scalar().alias("least"), none.alias("convs"), F.lit(False).alias("owner"),
             none.alias("leaves"), none.alias("saved"), F.lit(1).alias("kind")))
    shard_sums = (total.withColumn("kind", F.lit(0)).unionByName(borders).unionByName(roots).unionByName(carried)
                  .groupBy("shard").applyInArrow(_accumulate(band), PARTIAL))
    alone = rows.agg((F.count("*") == 0).cast("long")).scalar()
    root = members.select(F.lit(ROOT).alias("digest"), alone.alias("n_leaves"), none.alias("saved_tokens"), none.alias("n_children"),
                          F.col("conv").alias("conv_id"), none.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
                          F.col("n").alias("n_convs"))
    sums = shard_sums.unionByName(root).groupBy("digest").agg(
        *(F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")),
        *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    over = local.where("conv is not null").select("digest", "conv").unionByName(
        convs.join(rows.select("conv"), "conv", "left_anti").select(F.lit(ROOT).alias("digest"), "conv"))
    return (sums.join(end_hashes(over), "digest", "left")
            .select(F.lower(F.hex("digest")).alias("node"), "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def conversation_trie(turns: DataFrame, base: Column | None = None, head: Column | None = None, conv_col: str = "conv_id",
                      turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **sizes: int) -> DataFrame:
    """The trie of a table of turns, rebuilt first from shared beginnings if ``base`` and ``head``
    (in terms of conv; ``head`` 8 at most) are given. Columns as of ``trie``.

    Defined cases: turns go by number, null first, tied ones by their digest; a null role or text
    is the empty string; rows without a conversation id take no part; rows that repeat are turns of
    their own; a conversation may have any number of turns and texts any length (only digests
    travel); other columns take no part, whatever their names; an empty table gives no nodes.
    """
    steps = stage(turn_steps(turns, F.col(conv_col), F.col(turn_col), F.col(role_col), F.col(text_col)), "trie-steps")
    rebuilt = steps if base is None else share_beginnings(steps, base, head)
    return trie(rebuilt, steps.where("pos = 1").select("conv"), **sizes)
