"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights: a term is a component with a weight other than
zero. Candidates are packed, partition by partition, into blocks of postings (term ->
rows of the block, weights); queries into blocks of sparse rows. Up to ``CELL`` candidate blocks form a
cell; each block is moved once, and the query blocks are shuffled to every cell (never
broadcast: the driver holds the block numbers only). In a meeting the query terms are taken one at a time: the term's
weighted postings are scattered into a dense score array (queries x candidates of the
block), then each query keeps its k best by partition selection. Terms that many rows of the
block hold are taken ``TERMS`` at a time: their postings, zeros between them, are a matrix. The k best of all blocks
are merged by rank, so at most k rows per query and candidate block are shuffled.

Scores are exact whatever the weights: doubles add up whole numbers below 2**53 only, and a meeting whose
sums could leave a long's range adds up unbounded integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hamper.llm.common import stage

CANDIDATES = 8192   # rows of a candidate block
QUERIES = 256       # rows of a query block: the score array holds 256 x 8192 longs, 16 MB
CELL = 4            # candidate blocks that one copy of the queries meets
TERMS = 128         # common terms accumulated in one go
COMMON = 16         # a term is common if one of so many rows of the block holds it
LONG = 1 << 63
WHOLE = 1 << 53     # up to here doubles hold every whole number


def quantize(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold neither nulls nor non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _pack(rows: int):
    """Blocks of up to ``rows`` vectors as postings: terms (sorted), and for each of their
    entries the block row and weight; ``ends`` closes each term's run."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("null_id", pa.binary()), ("terms", pa.binary()),
                        ("ends", pa.binary()), ("at", pa.binary()), ("weight", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held = TaskContext.get().partitionId(), 0, []

        def flush(batch: pa.Table):
            lists = batch.column(1).combine_chunks()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = flat != 0
            row, term, flat = row[keep], term[keep], flat[keep]
            order = np.argsort(term, kind="stable")
            terms, counts = np.unique(term, return_counts=True)
            ids = batch.column(0).combine_chunks()
            return pa.RecordBatch.from_pydict({
                "block": [part << 32 | number], "ids": [ids.fill_null(0).to_numpy().astype("<i8").tobytes()],
                "null_id": [ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()],
                "terms": [terms.astype("<i4").tobytes()], "ends": [np.cumsum(counts).astype("<i8").tobytes()],
                "at": [row[order].astype("<i4").tobytes()], "weight": [flat[order].astype("<i8").tobytes()]}, schema=schema)
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= rows:
                full = pa.Table.from_batches(held)
                yield flush(full.slice(0, rows))
                number += 1
                held = full.slice(rows).to_batches()
        if sum(b.num_rows for b in held):
            yield flush(pa.Table.from_batches(held))
    return run


PACKED = "block long, ids binary, null_id binary, terms binary, ends binary, at binary, weight binary"


def _unpack(r: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    get = lambda name, kind: np.frombuffer(r[f"{prefix}_{name}"], kind)
    ends, at, weight = get("ends", "<i8"), get("at", "<i4"), get("weight", "<i8")
    postings, start = {}, 0
    for term, end in zip(get("terms", "<i4").tolist(), ends.tolist()):
        postings[term] = at[start:end], weight[start:end]
        start = end
    return get("ids", "<i8"), get("null_id", "u1").astype(bool), postings


def _largest(postings: dict[int, tuple[np.ndarray, np.ndarray]]) -> int:
    return max((max(-int(w.min()), int(w.max())) for _, w in postings.values()), default=0)


def _best(s: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of ``s``, the first ones where equal."""
    if len(s) <= k:
        return np.arange(len(s))
    if s.dtype == object:
        return np.array(sorted(range(len(s)), key=lambda i: -s[i])[:k], np.int64)
    least = s[np.argpartition(s, len(s) - k)[len(s) - k:]].min()
    above, equal = np.flatnonzero(s > least), np.flatnonzero(s == least)
    return np.r_[above, equal[: k - len(above)]]


def _common_scores(terms: list[int], q_post: dict, c_post: dict, n_q: int, n_c: int) -> np.ndarray:
    """Scores (queries x candidates) from these terms alone: whole numbers, added up as doubles."""
    scores = np.zeros((n_q, n_c))
    for k in range(0, len(terms), TERMS):
        some = terms[k:k + TERMS]
        q, c = np.zeros((n_q, len(some))), np.zeros((len(some), n_c))
        for n, term in enumerate(some):
            q[q_post[term][0], n] = q_post[term][1]
            c[n, c_post[term][0]] = c_post[term][1]
        scores += q @ c
    return scores.astype(np.int64)


MEETING = "query_id long, vec_id long, high long, low long"   # score = high * 2**63 + low


def _meet(k: int):
    """Top k of each query block against each candidate block, one meeting per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                q_ids, _, q_post = _unpack(r, "q")
                c_ids, c_null, c_post = _unpack(r, "c")
                most = _largest(q_post) * _largest(c_post) * max(1, len(q_post))
                wide = most >= LONG
                shared = [t for t in q_post if t in c_post]
                if most < WHOLE:
                    common = [t for t in shared if len(c_post[t][0]) * COMMON >= len(c_ids)]
                    scores = _common_scores(common, q_post, c_post, len(q_ids), len(c_ids))
                    shared = [t for t in shared if len(c_post[t][0]) * COMMON < len(c_ids)]
                else:
                    scores = np.zeros((len(q_ids), len(c_ids)), object if wide else np.int64)
                for term in shared:
                    (q_at, q_weight), (c_at, c_weight) = q_post[term], c_post[term]
                    if wide:
                        q_weight, c_weight = q_weight.astype(object), c_weight.astype(object)
                    if len(c_at) == len(c_ids):  # the term occurs in every row of the block, in order
                        scores[q_at] += q_weight[:, None] * c_weight
                    else:
                        scores[np.ix_(q_at, c_at)] += q_weight[:, None] * c_weight
                by_id = np.lexsort((c_ids, c_null))  # ties go to the smaller id, null last
                scores, c_ids, c_null = scores[:, by_id], c_ids[by_id], c_null[by_id]
                out_q, out_c, out_null, out_s = [], [], [], []
                for n, q in enumerate(q_ids):
                    other = np.flatnonzero((c_ids != q) | c_null)
                    best = _best(scores[n, other], k)
                    out_q.append(np.full(len(best), q))
                    out_c.append(c_ids[other[best]])
                    out_null.append(c_null[other[best]])
                    out_s.append(scores[n, other[best]])
                s = np.concatenate(out_s)
                high, low = (s >> 63, s & (LONG - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_c), mask=np.concatenate(out_null)),
                     pa.array(high.astype(np.int64)), pa.array(low.astype(np.int64))],
                    names=["query_id", "vec_id", "high", "low"])
    return run


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
               vector_col: str = "vector") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best by integer inner product.

    Both sides hold an id and an array of long weights (a missing component counts as 0).
    A query never meets rows with its own id. Ties go to the smaller id, a null id last.

    Defined cases: rows with a null vector or a null weight take no part; null query ids take
    no part as queries; of repeated query ids the smallest vector (component by component)
    asks, and each candidate row of a repeated id can be found; an all-zero vector scores 0
    against everything; vectors may have any length (a missing component counts as 0); fewer than k
    candidates give fewer rows; no queries give no rows; other columns take no part, whatever
    their names. A score beyond a long's range ranks as what it is and is shown as the range's end.
    """
    whole = F.col(vector_col).isNotNull() & ~F.coalesce(F.exists(vector_col, lambda x: x.isNull()), F.lit(True))
    rows = lambda df: df.where(whole).select(F.col(id_col).cast("long").alias("id"),
                                             F.col(vector_col).cast("array<bigint>").alias("vector"))
    cand = stage(rows(candidates).mapInArrow(_pack(CANDIDATES), PACKED), "topk-candidates")
    asked = stage(rows(queries).where("id is not null").groupBy("id").agg(F.min("vector").alias("vector")),
                  "topk-queries")
    blocks = max(1, -(-asked.count() // QUERIES))
    asking = stage(asked.repartition(blocks).mapInArrow(_pack(QUERIES), PACKED), "topk-asking")
    # the stated query set meets all candidates in blocks: a copy of it goes to every cell of candidate
    # blocks, which stay whole; the list of blocks has one number for thousands of candidates
    every = cand.agg(F.sort_array(F.collect_list("block"))).scalar()
    n_blocks = cand.count()
    tasks = int(cand.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    cells = max(1, -(-n_blocks // CELL), min(n_blocks, tasks))
    sent = asking.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"),
                         *(F.col(c).alias(f"q_{c}") for c in asking.columns if c != "block"))
    held = cand.select(((F.array_position(every, F.col("block")) - 1) % cells).cast("int").alias("cell"),
                       *(F.col(c).alias(f"c_{c}") for c in cand.columns if c != "block"))
    # merged, so that no side is collected on the driver: the copies grow with both sides
    found = sent.hint("merge").join(held, "cell").mapInArrow(_meet(k), MEETING)
    best = Window.partitionBy("query_id").orderBy(F.col("high").desc(), F.col("low").desc(), F.col("vec_id").asc_nulls_last())
    score = (F.when(F.col("high") == 0, F.col("low")).when(F.col("high") == -1, F.col("low") + F.lit(-LONG))
             .when(F.col("high") > 0, F.lit(LONG - 1)).otherwise(F.lit(-LONG)))
    return (found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", score.cast("long").alias("score")))
