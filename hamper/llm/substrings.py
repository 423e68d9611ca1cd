"""Removal of passages that stand in several documents: a count-min prefilter, then exact groups.

A window is ``window`` consecutive words of one document. Every word covered by a window
whose word sequence also starts in a document with a smaller id is removed; windows are
judged on the input, so what one document loses never changes what another one keeps.

1. ``_store``: documents are stored in blocks of about ``BLOCK_BYTES`` of text, in a table
   bucketed by block. Beside its texts a block leaves its partition sketch: the sorted hashes
   of its windows, shortened to a few bits more than the corpus has bytes, gap-coded, cut
   into segments by leading bits, each with a counter that stops at two.
2. ``_merge_sketches``: the sketches of a segment are added up in ``DEPTH`` rows of counters
   with a hash function each. A window's estimate is the smallest of its counters, so it is
   never below the true count. The segment answers every block with one bit a window: whether
   the estimate is two or more. The answers travel back to the blocks, not the windows.
3. ``_suspects``: only windows estimated repeated are digested (128 bits over the words
   themselves, whatever white space stood between them) and grouped exactly; a block sends one
   row per segment of digests, each digest once with the block's smallest document, so a
   passage of a third of all documents costs one entry a block. The segment answers with one
   bit a digest: whether a document elsewhere is smaller.
4. ``_remove``: each block knows its windows' first documents now and cuts its texts.

Texts are moved once, by the bucketed write, and are joined with the answers in place. No
step holds more than one block, or one segment's share of all sketches, in a task: segments
follow the shuffle partitions. Nothing passes through the driver but the corpus size in bytes.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hamper.llm.common import pack_gaps, stage, trim, unpack_gaps
from hamper.session import materialize_bucketed

WINDOW = 13
DEPTH = 3                  # rows of counters of a merged sketch
BLOCK_BYTES = 16 << 20     # text of a block: a worker holds about ten times as much for it
SLICE_BYTES = 2 << 20      # text whose words are hashed at a time
U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


# ---------------------------------------------------------------- words and windows
class Words:
    """Words of some texts: ``chars`` holds each word with one space after it."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        solid = ~_SPACE[raw]
        after = np.r_[False, solid[:-1]] & ~solid         # the first white space after each word
        self.chars = raw[solid | after].copy()
        blank = np.flatnonzero(_SPACE[self.chars])
        self.chars[blank] = 32
        self.end = blank                                   # of each word, in chars
        self.start = np.r_[0, blank[:-1] + 1] if len(blank) else blank
        # words up to the end of each text; its separator may be the white space after its last word
        stops = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.r_[0, np.searchsorted(np.flatnonzero(after), stops)]

    def window_starts(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, first word) of every window."""
        counts = np.maximum(np.diff(self.first) - window + 1, 0)
        doc = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        return doc, self.first[doc] + place

    def hashes(self, starts: np.ndarray, window: int) -> np.ndarray:
        """64-bit hash of each window's words."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        length = self.end - self.start + 1
        place = np.arange(len(self.chars), dtype=np.int64) - np.repeat(self.start, length)
        power = np.multiply.accumulate(np.r_[U(1), np.full(int(length.max()) - 1, 0x9E3779B97F4A7C15, np.uint64)])
        word = _mix(np.add.reduceat((self.chars.astype(np.uint64) + U(1)) * power[place], self.start))
        # sums of word * base^-i: the difference over a window, times base^start, is its polynomial
        n, base = len(word), 0xD1342543DE82EF95
        down = np.multiply.accumulate(np.r_[U(1), np.full(n - 1, pow(base, -1, 1 << 64), np.uint64)])
        up = np.multiply.accumulate(np.r_[U(1), np.full(n - 1, base, np.uint64)])
        total = np.r_[U(0), np.add.accumulate(word * down)]
        return _mix((total[starts + window] - total[starts]) * up[starts])


def _slices(ids: list, texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(first text, texts) in slices of about SLICE_BYTES."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= SLICE_BYTES:
            yield start, texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def _block_hashes(ids: list, texts: list[bytes], window: int) -> np.ndarray:
    """Hashes of all windows of a block, in order of text and place; texts without id have none."""
    parts = []
    for start, some in _slices(ids, texts):
        words = Words([t if ids[start + k] is not None else b"" for k, t in enumerate(some)])
        parts.append(words.hashes(words.window_starts(window)[1], window))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


# ---------------------------------------------------------------- sketches
def estimates(cells: np.ndarray, counts: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Count-min estimate of each entry of the added sketches: at least the sum of the counts
    given for its cell."""
    width = 1 << max(4, math.ceil(math.log2(4 * len(cells) + 1)))
    least = None
    for row in range(depth):
        at = (_mix(cells + U(row * 0x632BE59BD9B4E019 & (1 << 64) - 1)) & U(width - 1)).astype(np.int64)
        counter = np.bincount(at, minlength=width) + np.bincount(at[counts > 1], minlength=width)
        least = counter[at] if least is None else np.minimum(least, counter[at])
    return least


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct cells, cell of each window, count of each cell) of a block."""
    return np.unique(hashes >> U(64 - bits), return_inverse=True, return_counts=True)


def _cuts(values: np.ndarray, shift: int) -> list[tuple[int, int, int]]:
    """(segment, first, end) of sorted values by their leading bits."""
    segment = (values >> U(shift)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if len(segment) else np.zeros(0, np.int64)
    return [(int(segment[a]), int(a), int(b)) for a, b in zip(first, np.r_[first[1:], len(segment)])]


STORED = "block long, doc_id long, text string, segment int, cells binary, twice binary"


def _store(window: int, bits: int, segment_bits: int, block_bytes: int):
    """Documents with their block, and the blocks' sketches (rows with a segment)."""
    names = [f.split()[0] for f in STORED.split(", ")]

    def block_rows(ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        # two blocks of one name would only be a larger block
        name = uuid.uuid4().int >> 65
        n, empty = len(ids), lambda n, kind: pa.nulls(n, kind)
        for start, some in _slices(ids, texts):
            k = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * k, pa.int64()), pa.array(ids[start:start + k], pa.int64()),
                 pa.array(some, pa.binary()).cast(pa.string()), empty(k, pa.int32()), empty(k, pa.binary()),
                 empty(k, pa.binary())], names=names)
        cells, _, counts = _cells(_block_hashes(ids, texts, window), bits)
        cuts = _cuts(cells, bits - segment_bits)
        n = len(cuts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.int64()), empty(n, pa.int64()), empty(n, pa.string()),
             pa.array([s for s, _, _ in cuts], pa.int32()),
             pa.array([pack_gaps(cells[a:b]) for _, a, b in cuts], pa.binary()),
             pa.array([np.packbits(counts[a:b] > 1).tobytes() for _, a, b in cuts], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(i)
                texts.append(t.as_buffer().to_pybytes() if t.is_valid else b"")
                held += len(texts[-1])
                if held >= block_bytes:
                    yield from block_rows(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield from block_rows(ids, texts)
        trim()
    return run


ANSWER = "block long, step int, segment int, bits binary"


def _answers(blocks: list[int], step: int, segment: int, sizes: np.ndarray, bits: np.ndarray) -> pa.Table:
    cuts = np.cumsum(sizes)[:-1]
    n = len(blocks)
    return pa.table({"block": pa.array(blocks, pa.int64()), "step": pa.array([step] * n, pa.int32()),
                     "segment": pa.array([segment] * n, pa.int32()),
                     "bits": pa.array([np.packbits(b).tobytes() for b in np.split(bits, cuts)], pa.binary())})


def _merge_sketches(sketches: pa.Table) -> pa.Table:
    """One segment: for each block, whether each of its cells is estimated at two or more."""
    cells = [unpack_gaps(c.as_buffer()) for c in sketches["cells"]]
    sizes = np.array([len(c) for c in cells])
    counts = np.concatenate([1 + np.unpackbits(np.frombuffer(t.as_buffer(), np.uint8), count=n)
                             for t, n in zip(sketches["twice"], sizes)])
    return _answers(sketches["block"].to_pylist(), 1, sketches["segment"][0].as_py(), sizes,
                    estimates(np.concatenate(cells), counts) >= 2)


# ---------------------------------------------------------------- exact groups
def _answer_bits(answers: pa.Table, step: int, cuts: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """A step's answers to one block, put together in the order of the block's entries."""
    mine = answers.filter(pc.equal(answers["step"], step))
    sent = {s.as_py(): b.as_buffer() for s, b in zip(mine["segment"], mine["bits"])}
    out = np.zeros(n, bool)
    for s, a, b in cuts:
        out[a:b] = np.unpackbits(np.frombuffer(sent[s], np.uint8), count=b - a)
    return out


def _digests(ids: list, texts: list[bytes], suspect: np.ndarray, window: int):
    """(text, first word, digest) of the suspect windows, and the Words of each slice."""
    at, slices, doc, first, digest = 0, [], [], [], []
    blake = hashlib.blake2b
    for start, some in _slices(ids, texts):
        words = Words([t if ids[start + k] is not None else b"" for k, t in enumerate(some)])
        d, w = words.window_starts(window)
        mine = np.flatnonzero(suspect[at:at + len(w)])
        at += len(w)
        view = memoryview(words.chars.tobytes())
        begin, end = words.start[w[mine]], words.end[w[mine] + window - 1]
        digest += [blake(view[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), end.tolist())]
        doc.append(d[mine] + start)
        first.append(w[mine] - words.first[d[mine]])
        slices.append(words)
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return cat(doc), cat(first), np.frombuffer(b"".join(digest), ">u8").reshape(-1, 2).astype(np.uint64)


def _group(digests: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct digests in order, group of each row, smallest ``least`` of each group)."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    rows = digests[order]
    new = np.r_[True, (rows[1:] != rows[:-1]).any(1)] if len(rows) else np.zeros(0, bool)
    group = np.empty(len(rows), np.int64)
    group[order] = np.cumsum(new) - 1
    low = np.minimum.reduceat(least[order], np.flatnonzero(new)) if len(rows) else least
    return rows[new], group, low


def _block(docs: pa.Table) -> tuple[list, list[bytes]]:
    """A block's documents in an order that doesn't depend on how the rows arrived."""
    ids = docs["doc_id"].to_pylist()
    texts = [t.as_buffer().to_pybytes() for t in docs["text"]]
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return [ids[i] for i in order], [texts[i] for i in order]


def _block_groups(docs: pa.Table, answers: pa.Table, window: int, bits: int, segment_bits: int):
    """ids, texts, (text, first word, group) of the suspects, distinct digests, smallest ids."""
    ids, texts = _block(docs)
    cells, cell_of, _ = _cells(_block_hashes(ids, texts, window), bits)
    suspect = _answer_bits(answers, 1, _cuts(cells, bits - segment_bits), len(cells))[cell_of]
    doc, first, digests = _digests(ids, texts, suspect, window)
    numbers = np.array([0 if i is None else i for i in ids], np.int64)
    distinct, group, least = _group(digests, numbers[doc])
    return ids, texts, numbers, doc, first, group, distinct, least


DIGESTS = "segment int, block long, digests binary, least binary"


def _suspects(window: int, bits: int, segment_bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        distinct, least = np.zeros((0, 2), np.uint64), np.zeros(0, np.int64)
        if docs.num_rows:
            *_, distinct, least = _block_groups(docs, answers, window, bits, segment_bits)
        cuts = _cuts(distinct[:, 0], 64 - segment_bits)
        return pa.table({
            "segment": pa.array([s for s, _, _ in cuts], pa.int32()),
            "block": pa.array([docs["block"][0].as_py()] * len(cuts), pa.int64()),
            "digests": pa.array([distinct[a:b].tobytes() for _, a, b in cuts], pa.binary()),
            "least": pa.array([least[a:b].tobytes() for _, a, b in cuts], pa.binary())})
    return run


def _merge_digests(rows: pa.Table) -> pa.Table:
    """One segment: for each block, whether each of its digests starts in a smaller document elsewhere."""
    least = [np.frombuffer(x.as_buffer(), np.int64) for x in rows["least"]]
    digests = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64).reshape(-1, 2) for x in rows["digests"]])
    own = np.concatenate(least)
    _, group, low = _group(digests, own)
    return _answers(rows["block"].to_pylist(), 2, rows["segment"][0].as_py(), np.array([len(x) for x in least]),
                    low[group] < own)


CUT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>"
_CUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _remove(window: int, bits: int, segment_bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _CUT.empty_table()
        ids, texts, numbers, doc, first, group, distinct, least = _block_groups(
            docs, answers, window, bits, segment_bits)
        smaller = _answer_bits(answers, 2, _cuts(distinct[:, 0], 64 - segment_bits), len(distinct))
        gone = smaller[group] | (least[group] < numbers[doc])
        doc, first = doc[gone], first[gone]          # ordered by text, then place
        bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
        out = []
        for start, some in _slices(ids, texts):
            words = Words(some)
            for k in range(len(some)):
                i, lo, hi = start + k, words.first[k], words.first[k + 1]
                a = words.start[lo] if hi > lo else 0
                chars = words.chars[a:words.end[hi - 1] + 1] if hi > lo else words.chars[:0]
                spans, removed, mine = [], 0, first[bounds[i]:bounds[i + 1]]
                if len(mine):
                    new = np.flatnonzero(np.r_[True, mine[1:] > mine[:-1] + window])
                    begin, end = mine[new], mine[np.r_[new[1:] - 1, len(mine) - 1]] + window
                    spans = [{"start": int(x), "end": int(y)} for x, y in zip(begin, end)]
                    removed = int((end - begin).sum())
                    keep = np.ones(len(chars), bool)
                    for x, y in zip(begin, end):
                        keep[words.start[lo + x] - a:words.end[lo + y - 1] + 1 - a] = False
                    chars = chars[keep]
                out.append((ids[i], int(hi - lo), removed, chars[:-1].tobytes().decode("utf-8"), spans))
        return pa.table([pa.array(c, t.type) for c, t in zip(zip(*out), _CUT)], schema=_CUT)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the words left, joined by one space) and
    spans (start and end of the removed word ranges, ascending, end exclusive).

    Defined cases: a null or empty text, or one of white space, has no words; texts of fewer
    words than the window lose nothing, nor does the document with the smallest id that holds
    a window; a passage repeated inside one document alone stays; rows that repeat an id are one
    document as far as windows go (they take nothing from each other) and give a row each; a row
    with a null id loses nothing and takes nothing; a text of any length is read whole, one longer
    than ``block_bytes`` is a block of its own; other columns of ``docs`` take no part,
    whatever their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    segment_bits = max(2, math.ceil(math.log2(4 * parts)))
    # eight cells a byte: some fifty a window, so that shortened hashes rarely meet
    bits = min(60, max(segment_bits + 8, math.ceil(math.log2(8 * size + 1))))
    stored = materialize_bucketed(rows.mapInArrow(_store(window, bits, segment_bits, block_bytes), STORED), "block",
                                  parts, "zstd")
    texts = stored.where("segment is null").select("block", "doc_id", "text")
    sketches = stored.where("segment is not null").select("segment", "block", "cells", "twice")
    estimated = stage(sketches.groupBy("segment").applyInArrow(_merge_sketches, ANSWER), "substring-estimates")
    digests = (texts.groupBy("block").cogroup(estimated.groupBy("block"))
               .applyInArrow(_suspects(window, bits, segment_bits), DIGESTS))
    exact = stage(digests.groupBy("segment").applyInArrow(_merge_digests, ANSWER), "substring-groups")
    return (texts.groupBy("block").cogroup(estimated.unionByName(exact).groupBy("block"))
            .applyInArrow(_remove(window, bits, segment_bits), CUT))
