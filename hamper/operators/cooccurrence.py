"""Item co-occurrence counts within baskets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hamper.operators.features import basket_sizes
from hamper.operators.sampling import SEED, hash_sample
from hamper.session import drop_folders, materialize, recorded_scratch

# Fixed values (reference semantics): basket-size window, pair threshold, row sample.
MIN_SIZE, MAX_SIZE, MIN_COUNT, ROW_FRACTION = 5, 200, 3, 0.3
# Rows (basket, item) that a task holds.
BLOCK_ITEMS = 7_000_000
MAX_CLASSES = 64         # item classes of a line: every row is copied once per line, one more than these
EVEN_CLASSES = 7         # so many at most for the sake of more tasks
SLICE_PAIRS = 8_000_000  # pairs counted in one slice of baskets, or added up in one task
PACK_ROWS = 262_144      # rows that travel as one packed row
_CHUNK = 1 << 20         # pairs held at a time while counting


def excluded_baskets(df: DataFrame, basket: str = "basket", item: str = "item", min_size: int = MIN_SIZE,
                     max_size: int | None = MAX_SIZE) -> DataFrame:
    """One row: how many baskets, and how many of their rows, the size window leaves out."""
    size = F.col("_size")
    small = size < F.lit(min_size)
    large = F.lit(False) if max_size is None else size > F.lit(max_size)
    rows = lambda c: F.coalesce(F.sum(F.when(c, size)), F.lit(0)).cast("bigint")
    return basket_sizes(df, basket, item, "_size").agg(
        F.count_if(small).alias("small_baskets"), rows(small).alias("small_rows"),
        F.count_if(large).alias("large_baskets"), rows(large).alias("large_rows"))


def possible_partners(folded: DataFrame, min_count: int, basket: str = "basket", item: str = "item") -> DataFrame:
    """Items (of rows basket, item, _copies) that can be in a pair of ``min_count``: a pair's count is at
    most the sum of one item's copies times the largest multiplicity in each of its baskets. In
    baskets of single copies that is the number of baskets an item stands in."""
    most = folded.groupBy(basket).agg(F.max("_copies").alias("_most"))
    return (folded.join(most, basket).groupBy(item).agg(F.sum(F.col("_copies") * F.col("_most")).alias("_bound"))
            .where(F.col("_bound") >= F.lit(min_count)).select(item))


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs, like bytes together, compressed."""
    most = int(values.max())
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unsqueeze(data: bytes, n: int) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(pa.decompress(data[1:], width * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").ravel()


def _packer(basket: str, item: str, whole: bool):
    """Some rows of a class and slice as one row: items in order, then of every row, by basket and item, the step from
    the basket before, the item's place and the further copies. Baskets that are no ``whole`` numbers go by
    their place among ``_names``."""
    def run(rows: pa.Table) -> pa.Table:
        items, code = _places(rows[item])
        if whole:
            names, at = rows[basket].combine_chunks().slice(0, 0), rows[basket].cast(pa.int64()).combine_chunks().to_numpy()
        else:
            names, at = _places(rows[basket])
        order = np.lexsort((code, at))
        at = at[order]
        steps = np.diff(at.astype(np.uint64), prepend=at[:1].astype(np.uint64))   # modulo 2**64, if whole
        one = lambda v, kind: pa.array([v], kind)
        own, part = (rows[c][0].as_py() for c in ("_own", "_slice"))
        listed = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        return pa.table({
            "_own": one(own, pa.int32()), "_slice": one(part, pa.int32()), "_n": one(len(order), pa.int64()),
            "_first": one(int(at[0]), pa.int64()), "_names": listed(names), "_items": listed(items),
            "_steps": one(_squeeze(steps), pa.binary()), "_places": one(_squeeze(code[order]), pa.binary()),
            "_more": one(_squeeze(rows["_copies"].combine_chunks().to_numpy()[order] - 1), pa.binary())})
    return run


def _places(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Distinct values in order, and the place of each row's among them."""
    coded = column.combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def _unpacked(packs: pa.Table, whole: bool) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of packed rows: all items in order, the class of each, and the rows as sorted numbers (basket times the
    number of items, plus the item's place) with their copies."""
    items, codes = _places(pa.chunked_array([packs["_items"].combine_chunks().flatten()]))
    ends = np.cumsum(packs["_items"].combine_chunks().value_lengths().to_numpy())
    own = np.empty(len(items), np.int64)
    own[codes] = np.repeat(packs["_own"].to_numpy(), np.diff(ends, prepend=0))
    if not whole:
        _, names = _places(pa.chunked_array([packs["_names"].combine_chunks().flatten()]))
        named = np.cumsum(packs["_names"].combine_chunks().value_lengths().to_numpy())
    baskets, place, more = [], [], []
    sizes = packs["_n"].to_numpy()
    for r, n in enumerate(sizes.tolist()):
        get = lambda c: _unsqueeze(packs[c][r].as_py(), n)  # noqa: B023, E731
        at = np.cumsum(get("_steps").astype(np.uint64)).view(np.int64) + packs["_first"][r].as_py()
        baskets.append(at if whole else names[at + (named[r - 1] if r else 0)])
        place.append(codes[get("_places").astype(np.int64) + (ends[r - 1] if r else 0)].astype(np.int32 if len(items) < 1 << 31 else np.int64))
        more.append(get("_more"))
    key = np.concatenate(baskets)
    del baskets
    low, high = int(key.min()), int(key.max())
    if (high - low + 1) * len(items) < 1 << 62:
        key -= low
    else:
        key = np.unique(key, return_inverse=True)[1]
    key *= len(items)
    key += np.concatenate(place)
    more = np.concatenate(more)
    del place
    odd = np.flatnonzero(more)
    odd, copies = key[odd], more[odd].astype(np.int64) + 1
    key.sort()
    # empty: all are single
    times = np.ones(len(key) if len(odd) else 0, np.int32 if copies.max(initial=0) < 1 << 31 else np.int64)
    times[np.searchsorted(key, odd)] = copies
    return items, own, key, times


def _count_pairs(batches: Iterator[pa.RecordBatch], least: int, lines: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Pairs within the baskets of a line's classes with their counts, from ``least`` on; pairs of one class in the
    lines from number ``lines`` on only. It goes item by item: a chunk holds all pairs of its items
    with later ones, so every pair is counted in one place."""
    packs = pa.Table.from_batches(batches)
    same = packs["_line"][0].as_py() >= lines
    names, own, key, times = _unpacked(packs, whole)
    del packs
    n, rows = len(names), len(key)
    small = np.int32 if max(n, rows) < 1 << 31 else np.int64
    item = key % n
    key //= n
    ends = np.flatnonzero(np.r_[key[1:] != key[:-1], True]) + 1
    follow = np.repeat(ends.astype(small), np.diff(ends, prepend=0))   # later items of the row's basket
    follow -= np.arange(1, rows + 1, dtype=small)
    if small is np.int32:
        np.left_shift(item, 32, out=key)
        key |= np.arange(rows)
        key.sort()
        key &= 0xFFFFFFFF
        by_item = key.astype(small)
    else:
        by_item = np.argsort(item, kind="stable")
    del key
    item = item.astype(small)
    i1, wide = item[by_item], follow[by_item]
    del follow
    last = np.flatnonzero(np.r_[i1[1:] != i1[:-1], True]) + 1   # where items end
    done = np.zeros(rows + 1, np.int64)
    np.cumsum(wide, out=done[1:])

    def between(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """All pairs of the rows a to b in the order of items: first item, second, copies."""
        k = wide[a:b]
        to = np.repeat(by_item[a:b] + 1 - (done[a:b] - done[a]), k) + np.arange(done[b] - done[a])
        x, y = np.repeat(i1[a:b].astype(np.int64), k), item[to]
        both = np.repeat(times[by_item[a:b]].astype(np.int64), k) * times[to] if len(times) else None
        if not same:
            keep = own[x] != own[y]
            x, y, both = x[keep], y[keep], None if both is None else both[keep]
        return x, y, both

    a = 0
    while a < len(i1):
        at = np.searchsorted(last, a, side="right")
        k = np.searchsorted(done[last], done[a] + _CHUNK, side="right") - 1
        b = int(last[max(at, k)])
        if done[b] - done[a] <= max(_CHUNK, n):
            x, y, both = between(a, b)
            key = x * n + y
            if both is not None:
                extra = np.flatnonzero(both > 1)
                extra, both = key[extra], both[extra] - 1
            key.sort()
            first = np.flatnonzero(np.r_[[True] * (len(key) > 0), key[1:] != key[:-1]])
            pairs, counts = key[first], np.diff(np.r_[first, len(key)])
            if both is not None:
                np.add.at(counts, np.searchsorted(pairs, extra), both)
        else:   # one item of many rows: its partners are added up some rows at a time
            counts = np.zeros(n, np.int64)
            while a < b:
                z = min(b, max(a + 1, int(np.searchsorted(done, done[a] + _CHUNK, side="right")) - 1))
                x, y, both = between(a, z)
                np.add.at(counts, y, 1 if both is None else both)
                a, start = z, int(i1[z - 1]) * n
            pairs = np.flatnonzero(counts)
            counts, pairs = counts[pairs], pairs + start
        a = b
        pairs, counts = pairs[counts >= least], counts[counts >= least]
        if len(pairs):
            x, y = np.divmod(pairs, n)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(x)), names.take(pa.array(y)), pa.array(counts)],
                                             names=["item1", "item2", "cooccur_count"])


def _prime(n: int) -> int:
    """The smallest prime from ``n`` on, not beyond the largest up to ``MAX_CLASSES``; 1 for 1."""
    primes = [q for q in range(2, MAX_CLASSES + 1) if all(q % d for d in range(2, int(q ** 0.5) + 1))]
    return 1 if n <= 1 else next((q for q in primes if q >= n), primes[-1])


def _layout(folded: DataFrame, basket: str, item: str) -> tuple[int, int, int, int]:
    """Rows, pairs, how many classes of items a line has, and into how many slices of baskets the rows are dealt.

    With ``q`` classes a line, there are ``q * q`` classes and ``q * (q + 1)`` lines, those of an affine plane: any two
    classes share one line. A pair is then counted in one place and never shuffled, but each row is copied
    ``q + 1`` times; with slices alone rows are not copied, but the counts of every slice are. The
    cheaper of the two goes; slices also divide classes that hold too much (a hot item)."""
    rows, pairs = folded.groupBy(basket).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.floor(F.col("_n") * (F.col("_n") - 1) / 2)), F.lit(0))).first()
    rows, pairs = int(rows), int(pairs)
    ceil = lambda a, b: max(1, int(-(-a // b)))
    classes = _prime(max(ceil(rows, BLOCK_ITEMS), min(ceil((pairs / (4 * SLICE_PAIRS)) ** 0.5, 1), EVEN_CLASSES)))
    if rows * (classes + 1) >= pairs:
        return rows, pairs, 1, max(ceil(rows, BLOCK_ITEMS), ceil(pairs, SLICE_PAIRS))
    hot = folded.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return rows, pairs, classes, ceil(max(rows // classes, hot), BLOCK_ITEMS)


def cooccurrence(df: DataFrame, basket: str = "basket", item: str = "item", min_size: int = MIN_SIZE,
                 max_size: int | None = MAX_SIZE, min_count: int = MIN_COUNT, fraction: float | None = None,
                 seed: int = SEED, sample_keys: Sequence[str] = ("basket", "position"),
                 dedupe: bool = False) -> DataFrame:
    """Unordered item pairs ``item1 < item2`` seen together in a basket, with counts.

    Baskets are kept when their size (all rows, before any row sample) lies in
    ``[min_size, max_size]`` (``max_size=None``: no upper bound); ``excluded_baskets`` counts
    the others. Then an optional deterministic row sample is taken. A repeated item counts
    once per copy (A,A,B gives (A,B) twice, never (A,A)), so rows are first folded to
    ``(basket, item, copies)`` and pairs carry ``copies1*copies2``.

    Items are dealt to classes and baskets to slices by hash, classes to lines (``_layout``); a group pairs the
    classes of a line within a slice. So neither a hot basket nor a hot item is held by one task, and pairs in
    large baskets, which are many more than the rows, are counted where they are made. Rows travel packed, about
    two or three bytes each, and what was stored on the way to the packed rows is deleted before they do.
    """
    size = F.col("_size")
    inside = size >= F.lit(min_size) if max_size is None else size.between(min_size, max_size)
    sizes = basket_sizes(df, basket, item, "_size").where(inside)
    rows = df.join(sizes.select(basket), basket)
    if fraction is not None:
        rows = hash_sample(rows, list(sample_keys), fraction, seed)
    folded = (rows.where(F.col(item).isNotNull())
              .groupBy(basket, item)
              .agg((F.lit(1).cast("bigint") if dedupe else F.count(F.lit(1))).alias("_copies")))
    with recorded_scratch() as before:
        folded = materialize(folded)   # read by the bound, the layout and the pairing
        if min_count > 1:
            folded = materialize(folded.join(possible_partners(folded, min_count, basket, item), item, "left_semi"))
    n_rows, n_pairs, classes, slices = _layout(folded, basket, item)
    if n_pairs <= SLICE_PAIRS:   # a task could hold them all: one join, no Python workers
        side = lambda n: folded.select(basket, F.col(item).alias(f"item{n}"), F.col("_copies").alias(f"_c{n}"))
        return (side(1).join(side(2), basket).where("item1 < item2").groupBy("item1", "item2")
                .agg(F.sum(F.col("_c1") * F.col("_c2")).alias("cooccur_count")).where(F.col("cooccur_count") >= F.lit(min_count)))
    part = lambda n, salt, c: F.pmod(F.xxhash64(F.col(c), F.lit(salt)), F.lit(n).cast("long")).cast("int")
    kind, named = (folded.schema[c].dataType for c in (item, basket))
    whole = isinstance(named, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    packs = materialize(
        folded.select(part(classes * classes, 1, item).alias("_own"), part(slices, 2, basket).alias("_slice"),
                      part(-(-n_rows // (classes * classes * slices * PACK_ROWS)) or 1, 3, basket).alias("_pack"),
                      F.col(basket).alias("_basket"), F.col(item).alias("_item"), "_copies")
        .groupBy("_own", "_slice", "_pack").applyInArrow(
            _packer("_basket", "_item", whole),
            f"_own int, _slice int, _n long, _first long, _names array<{named.simpleString()}>, "
            f"_items array<{kind.simpleString()}>, _steps binary, _places binary, _more binary"))
    del folded, rows
    drop_folders(df.sparkSession, before)
    across, along, step = F.floor(F.col("_own") / classes).cast("int"), F.col("_own") % classes, F.sequence(F.lit(0), F.lit(classes - 1))
    through = F.array(F.lit(classes * classes) + across)   # the line on which pairs within a class are counted, too
    if classes > 1:
        through = F.concat(F.transform(step, lambda m: m * classes + F.pmod(along - m * across, F.lit(classes))), through)
    lines = classes * (classes + 1) if classes > 1 else 1
    groups = ["_line", "_slice"]
    cells = packs.withColumn("_line", F.explode(through)).repartition(min(lines * slices, 1024), *groups)
    least = min_count if slices == 1 else 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _count_pairs(batches, least, classes * classes, whole)

    found = kind.simpleString()
    counted = cells.groupBy(*groups).applyInArrow(count, f"item1 {found}, item2 {found}, cooccur_count long")
    if slices > 1:
        tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-n_pairs // SLICE_PAIRS))
        counted = (counted.repartition(tasks, "item1", "item2").groupBy("item1", "item2")
                   .agg(F.sum("cooccur_count").alias("cooccur_count")).where(F.col("cooccur_count") >= F.lit(min_count)))
    return counted
