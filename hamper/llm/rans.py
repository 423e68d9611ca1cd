"""Token ids as binary files, coded with a static range asymmetric numeral system.

Writing, in ascending id order of the documents:

1. Documents are range-partitioned and sorted by id; each partition (a shard) tokenizes its
   texts in that order and packs whole documents into blocks of about ``BLOCK_IDS`` ids.
2. Ids are counted over all blocks; the counts, scaled to ``2**PRECISION``, are the one
   frequency table that all blocks share (at most one entry per vocabulary id).
3. Every block is coded on its own: ``LANES`` interleaved coder states, a checkpoint (states
   and word position) every ``CHECKPOINT`` steps, and checksums of the table and the frame.

Reading needs the table and any set of frames: frames decode independently, and within a
frame every checkpointed segment decodes independently, so all segments run side by side.

A file set is a folder with ``table`` (the frequency table) and ``blocks`` (frames, one per
row with their place: shard, block, first id position). Spark's committers write both, so a
lost executor leaves no half-written file. A frame is self-describing bytes, see ``encode_frames``.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hamper.llm.common import byte_level_alphabet, shared_dir, stage, trim

MAGIC = b"RNS1"
PRECISION = 18          # frequencies add up to 2**18
LOWER = 1 << 31         # coder states stay in [2**31, 2**63); 32 bits move at a time
LANES = 32
CHECKPOINT = 256        # steps (of LANES ids each) between checkpoints
BLOCK_IDS = 65_536
CACHE_ENTRIES = 1_000_000   # about 200 bytes each
CACHE_CHUNK = 48        # longer chunks (bytes) are tokenized without the cache
TEXT_BYTES = 8 << 20    # text tokenized at a time: a worker holds about ten bytes a byte of it
GROUP = 32              # blocks coded side by side, or fewer if one is long

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: magic, flags, table crc, documents, ids, first id position, segments, words
HEADER = struct.Struct("<4sIIIQQII")


# ---------------------------------------------------------------- frequency table
def scale_frequencies(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Counts by id, scaled to add up to ``2**precision``; an id that occurs keeps at least 1."""
    total, slots = int(counts.sum()), 1 << precision
    freq = np.zeros(len(counts), np.int64)
    if not total:
        return freq
    seen = counts > 0
    if int(seen.sum()) > slots:
        raise ValueError("more distinct ids than slots; raise the precision")
    spare = slots - int(seen.sum())
    freq[seen] = 1 + (counts[seen].astype(object) * spare // total).astype(np.int64)
    freq[np.argmax(counts)] += slots - freq.sum()
    return freq


class Table:
    """Shared coder tables of one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())


# ---------------------------------------------------------------- frames
def encode_frames(table: Table, blocks: list[tuple[np.ndarray, bytes, int, int]]) -> list[bytes]:
    """Frames of several blocks, coded side by side.

    A block is (ids, document index, documents, first id position). A frame is HEADER, the
    document index, per segment its LANES states and first word (little-endian), the words,
    and the crc32 of all that. Id ``i`` of a block belongs to lane ``i % LANES``.
    """
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i][0]))
    ids = [blocks[i][0] for i in order]
    steps = np.array([-(-len(x) // LANES) for x in ids], np.int64)
    top = int(steps.max(initial=0))
    grid = np.full((top, len(ids), LANES), -1, np.int64)
    for b, x in enumerate(ids):
        padded = np.full(int(steps[b]) * LANES, -1, np.int64)
        padded[: len(x)] = x
        grid[: steps[b], b] = padded.reshape(-1, LANES)
    state = np.full((len(ids), LANES), LOWER, np.uint64)
    words = np.zeros((top, len(ids), LANES), np.uint32)
    moved = np.zeros((top, len(ids), LANES), bool)
    marks = np.zeros((-(-top // CHECKPOINT), len(ids), LANES), np.uint64)
    down, up = np.uint64(32), np.uint64(PRECISION)
    room = np.uint64((LOWER >> PRECISION) << 32)
    for s in range(top - 1, -1, -1):
        n = int(np.searchsorted(-steps, -s, side="left"))  # blocks with more than s steps come first
        sym = grid[s, :n]
        x = state[:n]
        live = sym >= 0
        f = np.where(live, table.freq[sym], np.uint64(1))
        out = live & (x >= room * f)
        words[s, :n] = (x & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        moved[s, :n] = out
        x = np.where(out, x >> down, x)
        q = x // f
        state[:n] = np.where(live, (q << up) + (x - q * f) + table.start[sym], x)
        if s % CHECKPOINT == 0:
            marks[s // CHECKPOINT, :n] = state[:n]
    frames: list[bytes] = [b""] * len(blocks)
    for b, i in enumerate(order):
        n, segments = int(steps[b]), -(-int(steps[b]) // CHECKPOINT)
        used = moved[:n, b]
        payload = words[:n, b][used]
        before = np.r_[0, np.cumsum(used.sum(1))]
        first = before[np.arange(segments) * CHECKPOINT].astype("<u4")
        _, index, n_docs, position = blocks[i]
        body = b"".join([HEADER.pack(MAGIC, 0, table.crc, n_docs, len(ids[b]), position, segments, len(payload)),
                         index, marks[:segments, b].astype("<u8").tobytes(), first.tobytes(),
                         payload.astype("<u4").tobytes()])
        frames[i] = body + struct.pack("<I", zlib.crc32(body))
    return frames


def pack_index(doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """Document index of a block: ids, null flags, lengths."""
    return (np.array([d or 0 for d in doc_ids], "<i8").tobytes()
            + np.array([d is None for d in doc_ids], np.uint8).tobytes() + np.array(lengths, "<u4").tobytes())


def parse_frame(frame: bytes, table: Table) -> dict:
    """Checks a frame's checksums and splits it; raises ValueError on damage."""
    if len(frame) < HEADER.size + 4 or zlib.crc32(frame[:-4]) != struct.unpack("<I", frame[-4:])[0]:
        raise ValueError("damaged frame")
    magic, _, crc, n_docs, n_ids, position, segments, n_words = HEADER.unpack_from(frame)
    if magic != MAGIC or crc != table.crc:
        raise ValueError("the frame belongs to another format or frequency table")
    at, out = HEADER.size, {"n_ids": n_ids, "position": position}
    for name, kind, n in (("doc_ids", "<i8", n_docs), ("nulls", "u1", n_docs), ("lengths", "<u4", n_docs),
                          ("states", "<u8", segments * LANES), ("first", "<u4", segments), ("words", "<u4", n_words)):
        out[name] = np.frombuffer(frame, kind, n, at)
        at += out[name].nbytes
    return out


def decode_frames(table: Table, frames: list[dict]) -> list[np.ndarray]:
    """Ids of parsed frames; every checkpointed segment of every frame decodes in parallel."""
    per_segment = CHECKPOINT * LANES
    sizes, states, at, word_base, base = [], [], [], [], 0
    for f in frames:
        full = np.arange(len(f["first"])) * per_segment
        sizes.append(np.minimum(per_segment, f["n_ids"] - full))
        states.append(f["states"].reshape(-1, LANES))
        at.append(f["first"].astype(np.int64) + base)
        base += len(f["words"])
        word_base.append(f["words"])
    size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    if not len(size):
        return [np.zeros(0, np.uint32) for _ in frames]
    x, ptr = np.concatenate(states).astype(np.uint64), np.concatenate(at)
    words = np.append(np.concatenate(word_base), np.uint32(0)).astype(np.uint64)
    order = np.argsort(-size, kind="stable")
    size, x, ptr = size[order], x[order], ptr[order]
    out = np.zeros((len(size), CHECKPOINT, LANES), np.uint32)
    lane = np.arange(LANES)
    low, up, down = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION), np.uint64(32)
    steps = -(-size // LANES)
    for s in range(int(steps.max())):
        n = int(np.searchsorted(-steps, -s, side="left"))
        live = s * LANES + lane < size[:n, None]
        cur = x[:n]
        slot = cur & low
        sym = table.symbol[slot]
        out[:n, s] = sym
        nxt = table.freq[sym] * (cur >> up) + slot - table.start[sym]
        need = live & (nxt < LOWER)
        rank = np.cumsum(need, axis=1)
        word = words[np.minimum(ptr[:n, None] + rank - 1, len(words) - 1)]
        x[:n] = np.where(live, np.where(need, (nxt << down) | word, nxt), cur)
        ptr[:n] += rank[:, -1]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    result, k = [], 0
    for f in frames:
        n = len(f["first"])
        flat = out[back[k:k + n]].reshape(-1)
        result.append(flat[: f["n_ids"]])
        k += n
    return result


# ---------------------------------------------------------------- tokenizing
class LatinWords:
    """Ids of many Latin words at a time, for byte-level BPE files with an end-of-word suffix.

    A word's symbols are the bytes of its lower-case form, the last one marked by the suffix.
    The Latin-1 letters need fewer than 128 such symbols, so each gets an ASCII character, and
    ``tiktoken`` merges the words, one a line, by the file's own ranks (several times the speed
    of ``tokenizers``; the same ids, as the order of merges is the order of ids).
    """

    BYTES = [*range(0x61, 0x7B), 0x9F, *range(0xA0, 0xB7), *range(0xB8, 0xC0)]   # of a-z, \u00df, \u00e0-\u00ff but \u00f7
    LEAD = 0xC3

    def __init__(self, vocab: dict[str, int], suffix: str):
        import tiktoken

        codes = iter(i for i in range(1, 128) if i != 10)
        self.inner, self.last = np.full(256, 10, np.uint8), np.full(256, 10, np.uint8)
        for b in [*self.BYTES, self.LEAD]:
            self.inner[b] = next(codes)
        for b in self.BYTES:
            self.last[b] = next(codes)
        alphabet, known = byte_level_alphabet(), {*self.BYTES, self.LEAD}
        ranks = {}
        for piece, i in vocab.items():
            ends = piece.endswith(suffix)
            body = [alphabet.get(c, 0) for c in (piece[:-len(suffix)] if ends else piece)]
            if known.issuperset(body) and not (ends and body[-1:] == [self.LEAD]):
                symbols = self.inner[body]
                if ends:
                    symbols[-1] = self.last[body[-1]]
                ranks[symbols.tobytes()] = i
        self.line = max(vocab.values()) + 1
        self.tool = tiktoken.Encoding("words", pat_str=r"[^\n]+|\n", mergeable_ranks={**ranks, b"\n": self.line}, special_tokens={})

    @classmethod
    def of(cls, tokenizer) -> LatinWords | None:
        """For a tokenizer of that kind, else None."""
        spec = json.loads(tokenizer.to_str())
        model, normal = spec["model"], spec.get("normalizer") or {}
        suffix, vocab = model.get("end_of_word_suffix"), model.get("vocab")
        steps = [n["type"] for n in normal.get("normalizers", [normal]) if n]
        if model["type"] != "BPE" or not suffix or "ByteLevel" not in json.dumps(spec.get("pre_tokenizer")) or \
                steps[-1:] != ["Lowercase"] or not set(steps) <= {"NFC", "Replace", "Lowercase"}:
            return None
        order = [vocab[m.replace(" ", "") if isinstance(m, str) else "".join(m)] for m in model["merges"]]
        return cls(vocab, suffix) if order == sorted(order) else None

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, end of each word's ids). Words are UTF-8 of Latin-1 letters."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        chars = np.frombuffer(b"\n".join(words).lower(), np.uint8).copy()   # A-Z alone
        second = np.flatnonzero(chars == self.LEAD) + 1
        chars[second[chars[second] < 0x9F]] += 32                           # capitals of the upper half
        lines = np.flatnonzero(chars == 10)
        ends = np.r_[lines, len(chars)] - 1
        symbols = self.inner[chars]
        symbols[ends] = self.last[chars[ends]]
        ids = np.array(self.tool.encode_ordinary(symbols.tobytes().decode("ascii")), np.int64)
        between = np.flatnonzero(ids == self.line)
        return np.delete(ids, between), np.r_[between - np.arange(len(between)), len(ids) - len(between)]


def _bytes_of(array: pa.LargeBinaryArray) -> list[bytes]:
    """The values of an array without nulls; quicker than one scalar at a time."""
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1].tolist()
    chars = data.to_pybytes() if data is not None else b""
    return [chars[a:b] for a, b in zip(at, at[1:])]


class ChunkTokenizer:
    """Ids of whole texts, by ASCII white space chunks with a bounded cache.

    For tokenizers that drop white space before splitting words: no token spans it, so the
    ids of a text are those of its chunks in order. (``tests/llm`` compares with whole texts.)
    The chunks of many texts are dictionary-encoded together; each distinct one is tokenized
    or looked up once, and the ids are gathered by its number. New chunks that are a Latin
    word, with or without one full stop or comma, go through ``LatinWords`` if the file allows.
    """

    #: a word of Latin-1 letters in UTF-8, and its sign
    PLAIN = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+([.,]?)")

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.limit, self.cache = cache_entries, {}
        self.words = LatinWords.of(self.tokenizer)
        self.signs = {sign.encode(): self._whole([sign])[0] for sign in ("", ".", ",")}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(g.ids, self.dtype).tobytes() for g in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(chunks)
        if self.words:
            match = self.PLAIN.fullmatch
            plain = [(i, m[1]) for i, c in enumerate(chunks) if (m := match(c))]
            ids, ends = self.words.encode([chunks[i][:-1] if sign else chunks[i] for i, sign in plain])
            raw, size, a = ids.astype(self.dtype).tobytes(), self.dtype.itemsize, 0
            for (i, sign), b in zip(plain, (ends * size).tolist()):
                out[i] = raw[a:b] + self.signs[sign]
                a = b
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._whole([chunks[i].decode("utf-8") for i in rest])):
            out[i] = ids
        return out

    def _ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of distinct chunks, kept until the cache is full."""
        found = list(map(self.cache.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            for i, ids in zip(part, self._encode([chunks[i] for i in part])):
                found[i] = ids
                if len(chunks[i]) <= CACHE_CHUNK and len(self.cache) < self.limit:
                    self.cache[chunks[i]] = ids
        return found

    def encode_texts(self, texts: list[bytes], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); ``end`` follows each text."""
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        solid = ~SPACE[raw]
        starts = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1          # of each text, in raw
        upto = np.searchsorted(starts, stops)                       # chunks before each text's end
        chars = raw[solid]
        at = np.cumsum(solid, dtype=np.int64)[starts] - 1 if len(starts) else starts
        offsets = pa.py_buffer(np.r_[at, len(chars)])
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(chars)])
        coded = chunks.dictionary_encode()
        number = coded.indices.to_numpy()
        ids = [*self._ids_of(_bytes_of(coded.dictionary)), end]
        # the end stands behind each text's chunks like one more chunk
        number = np.insert(number, upto, len(ids) - 1)
        width = self.dtype.itemsize
        length = np.array([len(x) // width for x in ids], np.int64)
        pool, start, n = np.frombuffer(b"".join(ids), self.dtype), np.cumsum(length) - length, length[number]
        total = np.r_[0, np.cumsum(n)]
        flat = pool[np.arange(total[-1]) + np.repeat(start[number] - total[:-1], n)]
        return flat, np.diff(total[np.r_[0, upto + np.arange(1, len(texts) + 1)]])

    def __call__(self, text: bytes) -> bytes:
        return self.encode_texts([text])[0].tobytes()


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer and cache per Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


RAW_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("at", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary())])


def _raw_blocks(tokenize: Callable[[], ChunkTokenizer], end: bytes):
    """Blocks of one sorted partition: whole documents until a block holds BLOCK_IDS ids."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number = TaskContext.get().partitionId(), 0
        tokenizer = tokenize()
        docs, lengths, parts, held, at = [], [], [], 0, 0

        def block():
            return pa.RecordBatch.from_pydict({"shard": [shard], "block": [number], "at": [at], "n_ids": [held],
                                               "doc_ids": [docs], "lengths": [lengths], "ids": [b"".join(parts)]},
                                              schema=RAW_SCHEMA)
        for some, texts in _texts(batches):
            ids, counts = tokenizer.encode_texts(texts, end)
            stop = 0
            for doc, n in zip(some, counts.tolist()):
                docs.append(doc)
                lengths.append(n)
                parts.append(ids[stop:stop + n].tobytes())
                stop += n
                held += n
                if held >= BLOCK_IDS:
                    yield block()
                    at += held
                    docs, lengths, parts, held, number = [], [], [], 0, number + 1
        if docs:
            yield block()
        trim()
    return run


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of about TEXT_BYTES, across batches."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc)
            texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
            held += len(texts[-1])
            if held >= TEXT_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _histogram(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                got = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width}"))
                if len(got) > len(counts):
                    got[: len(counts)] += counts
                    counts = got
                else:
                    counts[: len(got)] += got
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(counts[seen], pa.int64())})
    return run


def _encode_blocks(freq: np.ndarray, width: int, group: int = GROUP):
    """Frames of the blocks, coded side by side as long as the longest times their number, which is
    what the coder's arrays hold, stays below ``group`` full blocks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wait = Table(freq), []

        def flush():
            frames = encode_frames(table, [(np.frombuffer(r["ids"], f"<u{width}"), pack_index(r["doc_ids"], r["lengths"]),
                                            len(r["doc_ids"]), r["position"]) for r in wait])
            out = pa.RecordBatch.from_pydict({
                "shard": pa.array([r["shard"] for r in wait], pa.int32()),
                "block": pa.array([r["block"] for r in wait], pa.int64()),
                "position": pa.array([r["position"] for r in wait], pa.int64()),
                "frame": pa.array(frames, pa.binary())})
            wait.clear()
            return out
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                longest = max(r["n_ids"] for r in [row, *wait])
                if wait and (len(wait) + 1) * longest > group * 2 * BLOCK_IDS:
                    yield flush()
                wait.append(row)
                if len(wait) >= group:
                    yield flush()
        if wait:
            yield flush()
    return run


def _token_bytes(path: str) -> int:
    from tokenizers import Tokenizer

    return 4 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) > 1 << 16 else 2


def write_token_files(docs: DataFrame, tokenizer_path: str, root: str, end_id: int = 1, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encode every text and write the file set at ``root``, in ascending id order.

    Defined cases: a null text is empty and yields the end id alone; null ids come first;
    documents with equal ids follow each other in text order; a document longer than a block
    makes that block longer, which is then coded by itself (about 15 bytes an id); other
    columns take no part, whatever their names; an empty table writes an empty file set.
    """
    spark = docs.sparkSession
    width = _token_bytes(tokenizer_path)
    end = int(end_id).to_bytes(width, "little")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "shard int, block long, at long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, ids binary"
    raw = stage(ordered.mapInArrow(_raw_blocks(lambda: chunk_tokenizer(tokenizer_path), end), schema), "ids",
                compression="zstd")
    counted = raw.select("ids").mapInArrow(_histogram(width), "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))
    found = counted.toPandas()  # one row per vocabulary id at most
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    freq = scale_frequencies(counts)
    spark.createDataFrame([(bytearray(freq.astype("<u4").tobytes()),)], "table binary").write.parquet(f"{root}/table")

    # a shard starts after the ids of all shards before it; one row per shard, so one per
    # partition of the range shuffle
    shards = raw.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = stage(shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_at")), "shards")
    (raw.join(F.broadcast(shards), "shard")
     .select("shard", "block", "n_ids", "doc_ids", "lengths", "ids", (F.col("shard_at") + F.col("at")).alias("position"))
     .mapInArrow(_encode_blocks(freq, width), "shard int, block long, position long, frame binary")
     .write.option("compression", "uncompressed").parquet(f"{root}/blocks"))


def _decode(freq: np.ndarray, emit: Callable, group: int = GROUP):
    """Decoded frames, up to ``group`` full blocks at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wait = Table(freq), []

        def flush():
            for f, ids in zip(wait, decode_frames(table, wait)):
                yield emit(f, ids)
            wait.clear()
        for batch in batches:
            for frame in batch.column(0):
                wait.append(parse_frame(frame.as_py(), table))
                if len(wait) >= group or sum(f["n_ids"] for f in wait) >= group * BLOCK_IDS:
                    yield from flush()
        yield from flush()
    return run


def _doc_columns(f: dict) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    lengths = f["lengths"].astype(np.int64)
    ends = np.cumsum(lengths)
    return pa.array(f["doc_ids"], pa.int64(), mask=f["nulls"].astype(bool)), lengths, ends


def _emit_ids(f: dict, ids: np.ndarray) -> pa.RecordBatch:
    doc_ids, lengths, ends = _doc_columns(f)
    offsets = pa.array(np.r_[0, ends], pa.int32())
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(f["position"] + ends - lengths, pa.int64()),
         pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))], names=["doc_id", "start", "ids"])


def _emit_digests(f: dict, ids: np.ndarray) -> pa.RecordBatch:
    doc_ids, lengths, ends = _doc_columns(f)
    raw = memoryview(ids.astype("<u4").tobytes())
    crcs = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends, lengths)]
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(f["position"] + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
         pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _read(spark: SparkSession, root: str, emit: Callable, schema: str) -> DataFrame:
    freq = np.frombuffer(spark.read.parquet(f"{root}/table").first()["table"], "<u4").astype(np.int64)
    return spark.read.parquet(f"{root}/blocks").select("frame").mapInArrow(_decode(freq, emit), schema)


def read_token_files(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (with the end id)."""
    return _read(spark, root, _emit_ids, "doc_id long, start long, ids array<bigint>")


def read_token_digests(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the decoded ids as little-endian unsigned 32-bit integers."""
    return _read(spark, root, _emit_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_root(spark: SparkSession) -> str:
    return shared_dir(spark, "token-files")
