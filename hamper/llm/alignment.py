"""Alignment of two tokenizers' tokens by merge-path partitioning.

Tokenizer A is a byte-level BPE (a ``tokenizers`` JSON file), tokenizer B a SentencePiece
model; both spell a space and the text. The tokens' end offsets in bytes are two ascending
lists, and everything asked for falls out of their merge: each distinct end closes one
overlap of an A token with a B token (a link), each end that both lists hold closes a group.

1. ``split_path``: diagonals at equal distances cut the merge into pieces of equal work; on
   each diagonal a binary search finds how many ends come from A. All texts of a slice form
   one merge (their lists end at the same byte), so a long text is many pieces and many short
   texts are one piece.
2. ``piece_links``: each piece merges its own ends and emits the overlaps that close in it.
   An end shared by both lists may lie on a cut, A's copy left and B's copy right of it: the
   left piece looks at one end beyond its border, and the right one leaves it out.
3. ``align``: the pieces' group ends are numbered on from piece to piece, which stitches
   groups that cross a border.

Corpus counts (``linked_documents``): a block of documents (about ``BLOCK_BYTES`` of text)
leaves its distinct id pairs with their links, and which document holds which pair how
often. Pairs are added up by a shuffle on the pair (one row a block and pair, however hot),
the highest count of each B id is broadcast (a row for each id of B's vocabulary at most), and
each block gets back the counts of its own pairs, from which its documents' figures are summed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hamper.llm.common import byte_level_alphabet, pack_gaps, stage, trim, unpack_gaps

PIECE = 1 << 16          # ends of both lists that a piece merges
SLICE_BYTES = 1 << 20    # text tokenized and merged at a time
BLOCK_BYTES = 16 << 20   # text of a block: a worker holds about 20 bytes a byte of it
ID_BITS = 20             # a pair's code is a << ID_BITS | b
U = np.uint64


# ---------------------------------------------------------------- merge path
def split_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Cuts (i, j) of the merge of two ascending lists at every ``piece`` elements and at both
    ends; of equal elements A's comes first."""
    diagonal = np.unique(np.r_[np.arange(0, len(a) + len(b), piece), len(a) + len(b)])
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low, diagonal - low
        mid = (low[open_] + high[open_]) >> 1
        left = a[mid] <= b[diagonal[open_] - 1 - mid]
        low[open_[left]] = mid[left] + 1
        high[open_[~left]] = mid[~left]


def piece_links(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """(A token, B token) of each link that closes in a piece, in order, and the A and B
    tokens whose end closes a group."""
    ea, eb = a[i0:i1], b[j0:j1]
    ja = j0 + np.searchsorted(eb, ea)                      # B tokens that end before each A end
    ib = i0 + np.searchsorted(ea, eb)
    reach = b[j0:j1 + 1]                                   # one end beyond the border
    both_a = reach[np.minimum(ja - j0, len(reach) - 1)] == ea if len(reach) else np.zeros(len(ea), bool)
    both_b = (ib < i1) & (ea[np.minimum(ib - i0, len(ea) - 1)] == eb) if len(ea) else np.zeros(len(eb), bool)
    if len(eb) and i0 and a[i0 - 1] == eb[0]:              # its A copy was the left piece's last
        both_b[0] = True
    alone = ~both_b
    order = np.argsort(np.r_[ea, eb[alone]], kind="stable")
    return (np.r_[np.arange(i0, i1), ib[alone]][order], np.r_[ja, np.arange(j0, j1)[alone]][order],
            i0 + np.flatnonzero(both_a), j0 + np.flatnonzero(both_b))


def align(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE):
    """Links (A tokens, B tokens) of two lists of ends over the same bytes, and the group of
    each A and each B token."""
    i, j = split_path(a_ends, b_ends, piece)
    parts = [piece_links(a_ends, b_ends, *cut) for cut in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    groups = []
    for side, n in ((2, len(a_ends)), (3, len(b_ends))):
        closes = np.zeros(n, np.int64)
        for p in parts:
            closes[p[side]] = 1
        groups.append(np.cumsum(closes) - closes)          # groups closed before each token
    cat = lambda k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
    return cat(0), cat(1), groups[0], groups[1]


# ---------------------------------------------------------------- tokenizers
class Spelling:
    """The bytes of a vocabulary's tokens by id."""

    def __init__(self, spelled: dict[int, bytes]):
        n = max(spelled) + 1
        self.length = np.array([len(spelled.get(i, b"")) for i in range(n)], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.chars = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(n)), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.chars, self.start[ids], self.length[ids])


def gather(chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of ``chars`` that begin at ``start``, one after the other."""
    at = np.cumsum(length) - length
    return chars[np.arange(int(length.sum())) + np.repeat(start - at, length)]


class ByteLevel:
    """Tokenizer A. The file's vocabulary and pattern run through ``tiktoken`` (six times the
    speed of ``tokenizers``, same ids: the order of merges is the order of ids there); a file
    for which that doesn't hold is refused when loaded."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, special = byte_level_alphabet(), {t["content"] for t in spec["added_tokens"]}
        vocab = {w: i for w, i in spec["model"]["vocab"].items() if w not in special}
        ranks = {bytes(alphabet[c] for c in w): i for w, i in vocab.items()}
        merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in spec["model"]["merges"]]
        order = [vocab[m] for m in merged]
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") \
                or spec["normalizer"] is not None or order != sorted(order):
            raise ValueError("not a plain byte-level BPE file")
        self.encode = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.spelling = Spelling({i: w for w, i in ranks.items()})


class Pieces:
    """Tokenizer B."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode = lambda texts: sp.encode(texts, num_threads=1)
        self.spelling = Spelling({i: bytes((int(sp.id_to_piece(i)[1:-1], 16),)) if sp.is_byte(i)
                                  else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.vocab_size())})


_TOKENIZERS: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def tokenizers(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    """One pair per Python worker."""
    if (a_path, b_path) not in _TOKENIZERS:
        _TOKENIZERS[a_path, b_path] = ByteLevel(a_path), Pieces(b_path)
    return _TOKENIZERS[a_path, b_path]


# ---------------------------------------------------------------- a slice of documents
@cache
def _numbers(n: int) -> Spelling:
    """The decimal numbers below n, each with a comma."""
    return Spelling({i: b"%d," % i for i in range(n)})


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


class Slice:
    """The aligned tokens of some texts: per text n_a, n_b, n_groups, n_links and its groups as
    text; of all links the text and the pair's code."""

    def __init__(self, texts: list[str], a: ByteLevel, b: Pieces, piece: int = PIECE):
        n = len(texts)
        a_lists, b_lists = [a.encode(" " + t) if t else [] for t in texts], b.encode(texts) if n else []
        want = [(" " + t).encode() if t else b"" for t in texts]
        size = np.array([len(w) for w in want], np.int64)
        exact = np.ones(n, bool)
        for lists, spelling in ((a_lists, a.spelling), (b_lists, b.spelling)):
            ids, counts = _flat(lists)
            total = np.r_[0, np.cumsum(spelling.length[ids])]
            stop = np.cumsum(counts)
            exact &= total[stop] - total[stop - counts] == size
        for lists, spelling in ((a_lists, a.spelling), (b_lists, b.spelling)):
            keep = np.flatnonzero(exact)
            ids, _ = _flat([lists[k] for k in keep])
            differs = np.flatnonzero(spelling.spell(ids) != np.frombuffer(b"".join(want[k] for k in keep), np.uint8))
            exact[keep[np.searchsorted(np.cumsum(size[keep]), differs, side="right")]] = False
        empty = lambda lists: [x if ok else [] for x, ok in zip(lists, exact)]
        (ia, self.n_a), (ib, self.n_b) = _flat(empty(a_lists)), _flat(empty(b_lists))

        la, lb, ga, gb = align(np.cumsum(a.spelling.length[ia]), np.cumsum(b.spelling.length[ib]), piece)
        text_a = np.repeat(np.arange(n), self.n_a)
        self.link_text, self.link_code = text_a[la], (ia[la] << ID_BITS) | ib[lb]
        self.n_links = np.bincount(self.link_text, minlength=n)
        last_a = np.flatnonzero(np.diff(ga, append=-1))       # the last A and B token of each group
        last_b = np.flatnonzero(np.diff(gb, append=-1))
        self.n_groups = np.bincount(text_a[last_a], minlength=n)
        numbers = _numbers(max(len(a.spelling.length), len(b.spelling.length)))
        self.groups = self._write(numbers, ia, ib, ga, gb, last_a, last_b)

    def _write(self, numbers: Spelling, ia, ib, ga, gb, last_a, last_b) -> list[bytes]:
        """Each text's groups: A ids, a bar, B ids; a semicolon between groups."""
        before_b = np.r_[0, last_b + 1][ga] if len(ga) else ga   # B tokens of earlier groups
        upto_a = (last_a + 1)[gb] if len(gb) else gb             # A tokens up to this group
        at_a, at_b = np.arange(len(ia)) + before_b, np.arange(len(ib)) + upto_a
        ids = np.empty(len(ia) + len(ib), np.int64)
        ids[at_a], ids[at_b] = ia, ib
        chars, stop = numbers.spell(ids), np.cumsum(numbers.length[ids])
        chars[stop[at_a[last_a]] - 1] = ord("|")
        chars[stop[at_b[last_b]] - 1] = ord(";")
        ends = np.r_[0, stop][np.cumsum(self.n_a + self.n_b)] if len(ids) else np.zeros(len(self.n_a), np.int64)
        data, out, begin = chars.tobytes(), [], 0
        for end in ends.tolist():
            out.append(data[begin:max(begin, end - 1)])
            begin = end
        return out


def _slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``limit`` characters, across batches."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(i)
            texts.append(t.as_py() if t.is_valid else "")
            held += len(texts[-1])
            if held >= limit:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


# ---------------------------------------------------------------- Spark
ALIGNED = ("block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "codes binary, links binary, held binary, times binary")
_ALIGNED = [f.split()[0] for f in ALIGNED.split(", ")]


class _Block:
    """Pairs of a block's documents, gathered slice by slice."""

    def __init__(self):
        self.name = uuid.uuid4().int >> 65     # two blocks of one name would fail the places below: 63 random bits
        self.n, self.size, self.parts = 0, 0, []

    def add(self, s: Slice, size: int) -> None:
        codes, where = np.unique(s.link_code, return_inverse=True)
        held, times = np.unique(where * len(s.n_a) + s.link_text, return_counts=True)
        self.parts.append((codes[held // len(s.n_a)], (held % len(s.n_a) + self.n).astype(np.int32), times.astype(np.int32)))
        self.n += len(s.n_a)
        self.size += size

    def row(self) -> pa.RecordBatch:
        """One row: distinct codes, their links, and (pair, document) with how often."""
        code, doc, times = (np.concatenate(c) for c in zip(*self.parts))
        codes, pair = np.unique(code, return_inverse=True)
        links = np.bincount(pair, weights=times, minlength=len(codes)).astype(np.uint64)
        key = pair * self.n + doc
        order = np.argsort(key)
        some = lambda kind: pa.nulls(1, kind)
        counts = lambda c: pack_gaps(np.cumsum(c).astype(np.uint64))
        return pa.RecordBatch.from_arrays(
            [pa.array([self.name], pa.int64()), *[some(pa.int32()), *[some(pa.int64())] * 5], some(pa.string()),
             *[pa.array([x], pa.binary()) for x in (pack_gaps(codes.astype(np.uint64)), counts(links),
                                                    pack_gaps(key[order].astype(np.uint64)), counts(times[order]))]],
            names=_ALIGNED)


def _align_batches(a_path: str, b_path: str, block_bytes: int, slice_bytes: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(a_path, b_path)
        block = _Block()
        for ids, texts in _slices(batches, min(slice_bytes, block_bytes)):
            s, n = Slice(texts, a, b, piece), len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.name] * n, pa.int64()), pa.array(np.arange(block.n, block.n + n), pa.int32()),
                 pa.array(ids, pa.int64()), *[pa.array(x, pa.int64()) for x in (s.n_a, s.n_b, s.n_groups, s.n_links)],
                 pa.array(s.groups, pa.binary()).cast(pa.string()), *[pa.nulls(n, pa.binary())] * 4], names=_ALIGNED)
            block.add(s, sum(map(len, texts)))
            if block.size >= block_bytes:
                yield block.row()
                block = _Block()
        if block.n:
            yield block.row()
        trim()
    return run


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
            block_bytes: int = BLOCK_BYTES, slice_bytes: int = SLICE_BYTES, piece: int = PIECE) -> DataFrame:
    """One pass: per document doc_id, n_a, n_b, n_groups, n_links and groups (``a1,a2|b1;a3|b2``),
    and one row per block of documents (doc_id and place null) with the block's pairs.

    Defined cases: a null or empty text, or one that either tokenizer does not spell back byte
    by byte after a space, has no tokens (zeros, groups empty); special tokens' strings are plain
    text; rows are independent, so repeated rows and null ids give a row each; a text of any
    length is aligned whole, as many pieces; other columns take no part, whatever their names; an
    empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_align_batches(a_path, b_path, block_bytes, slice_bytes, piece), ALIGNED)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, code, links) of the blocks' rows."""
    for batch in batches:
        for name, codes, links in zip(*(batch.column(k) for k in range(3))):
            code = unpack_gaps(codes.as_buffer()).astype(np.int64)
            n = np.diff(unpack_gaps(links.as_buffer()).astype(np.int64), prepend=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), name.as_py())), pa.array(code), pa.array(n)],
                                             names=["block", "code", "links"])


LINKED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def _figures(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with the sums over their links."""
    whole = rows.filter(rows["codes"].is_valid())
    docs = rows.filter(rows["codes"].is_null())
    n = docs.num_rows
    counts = counts.sort_by("code")
    key = unpack_gaps(whole["held"][0].as_buffer()).astype(np.int64)
    times = np.diff(unpack_gaps(whole["times"][0].as_buffer()).astype(np.int64), prepend=0)
    pair, doc = key // n, key % n
    best, every = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(key):
        np.add.at(best, doc, times * counts["best"].to_numpy()[pair])
        np.add.at(every, doc, times * counts["count"].to_numpy()[pair])
    place = docs["place"].to_numpy()
    return pa.table([*(docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(best[place]),
                     pa.array(every[place]), docs["groups_sha256"]],
                    names=[f.split()[0] for f in LINKED.split(", ")])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """code, count (links that hold the pair, corpus-wide), best (its B id has no pair of more links)."""
    pairs = stage(blocks.groupBy("code").agg(F.sum("links").alias("count")), "align-pairs")
    b_id = F.col("code").bitwiseAND((1 << ID_BITS) - 1)
    highest = pairs.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))   # one row per id of B's vocabulary
    return (pairs.join(F.broadcast(highest), b_id == F.col("b"))
            .select("code", "count", (F.col("count") == F.col("most")).cast("long").alias("best")))


def linked_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                     **sizes: int) -> DataFrame:
    """Per document the figures of ``aligned``, with groups_sha256 in place of the groups (the
    empty string without tokens), n_best (links whose pair's count is the highest of its B id,
    ties included) and count_sum (counts of all its links' pairs). Defined cases as there."""
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = stage(aligned(docs, a_path, b_path, id_col, text_col, **sizes)
                 .select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", groups.alias("groups_sha256"),
                         "codes", "links", "held", "times"), "align-rows", "zstd")
    blocks = rows.where("codes is not null").select("block", "codes", "links").mapInArrow(
        _pairs, "block long, code long, links long")
    counts = blocks.select("block", "code").join(pair_counts(blocks), "code")
    return (rows.drop("links").groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_figures, LINKED))
