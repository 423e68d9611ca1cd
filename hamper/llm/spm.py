"""SentencePiece encoding and decoding by streaming Viterbi.

The best segmentation of a text is the one whose pieces have the largest sum of the model's
scores. ``StreamingViterbi`` reads the text from left to right. A piece has at most
``longest`` characters, so only the scores of the last ``longest`` positions can still be
extended. Whenever the backpointer paths of all those positions run through one boundary,
every way to go on shares what lies before it: the ids up to that boundary are committed and
the scores and backpointers before it dropped (``Window``). All ids leave by such a commit.

Between two characters that stand side by side in no piece, every path has a boundary; the
place where a word ends is one for models whose pieces carry the word mark only at their
front. What lies between two such boundaries is a span whose ids depend on nothing else, so a
bounded cache keeps the committed ids of short spans and the stream takes them from there
when the span comes again.

A model file with merge ranks (BPE) is scored by those ranks as stored; ties go to the
longer last piece. Characters without a piece become their UTF-8 bytes' pieces at the
library's penalty (smallest score less 10). A word mark that stands in the text itself also
goes by its bytes, so decoding gives back every text exactly.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hamper.llm.common import trim

MARK = "▁"
OWN_MARK = "\udb81"      # stands for a MARK of the text; no UTF-8 text holds a lone surrogate
UNKNOWN_PENALTY = 10.0
CACHE_SPANS = 175_000   # of each of two generations; about 240 bytes each, in a Python worker
CACHE_CHARS = 48        # longer spans are not kept


class Pieces:
    """Score table of a SentencePiece model file with byte fallback and identity normalization."""

    def __init__(self, scores: dict[str, tuple[float, int]], byte_ids: list[int]):
        self.byte_ids = byte_ids
        self.longest = max(map(len, scores), default=1)
        self.unknown = min((s for s, _ in scores.values()), default=0.0) - UNKNOWN_PENALTY
        self.table: dict[str, tuple[float, int] | None] = {}
        for piece in scores:
            for n in range(1, len(piece)):
                self.table.setdefault(piece[:n], None)  # a beginning of a piece, itself none
        self.table.update(scores)
        self.spelled = {i: bytes((b,)) for b, i in enumerate(byte_ids)}   # bytes of each id
        self.spelled.update({i: p.replace(MARK, " ").encode() for p, (_, i) in scores.items()})
        self.marks_first = not any(MARK in p.lstrip(MARK) for p in scores)
        #: pairs of neighbours inside pieces: between two characters that aren't one, every
        #: segmentation has a boundary
        self.inside = {p[i:i + 2] for p in scores for i in range(len(p) - 1)}
        #: the pieces once more by character: {char: [score or None, id as four bytes, next characters]}
        self.trie: dict = {}
        for piece, (score, i) in scores.items():
            level = self.trie
            for char in piece:
                node = level.setdefault(char, [None, b"", {}])
                level = node[2]
            node[0], node[1] = score, i.to_bytes(4, "little")

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "ﬁ a  b"
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model changes texts before encoding; only identity normalization is supported")
        ids = range(sp.vocab_size())
        bytes_ = {int(sp.id_to_piece(i)[1:-1], 16): i for i in ids if sp.is_byte(i)}
        if len(bytes_) != 256:
            raise ValueError("the model has no byte fallback")
        skip = lambda i: sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        return cls({sp.id_to_piece(i): (sp.get_score(i), i) for i in ids if not skip(i)},
                   [bytes_[b] for b in range(256)])

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in (MARK if char == OWN_MARK else char).encode("utf-8")]

    def fallback_bytes(self, char: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.fallback(char)])


class Window:
    """The recurrence over one span. ``feed`` takes characters and gives back the ids (four bytes
    each) that have become certain, ``finish`` the rest; then the window is empty again."""

    TRIM = 4096   # committed characters held before they are cut off
    NEVER = float("-inf")

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.commits = self.peak = 0
        self._clear()

    def _clear(self) -> None:
        self.text, self.at, self.done, self.reach = "", 0, 0, 0    # at: last boundary committed
        self.score, self.start, self.piece = [0.0], [0], [b""]

    def feed(self, chars: str) -> bytes:
        self.text += chars
        new = len(chars)
        self.score += [self.NEVER] * new
        self.start += [0] * new
        self.piece += [b""] * new
        return self._advance(len(self.text) - self.p.longest + 1)

    def finish(self) -> bytes:
        ids = self._advance(len(self.text))
        self._clear()
        return ids

    def _advance(self, stop: int) -> bytes:
        """Try the pieces that begin before ``stop``; commit wherever all paths meet."""
        text, trie, unknown = self.text, self.p.trie, self.p.unknown
        score, start, piece = self.score, self.start, self.piece
        i, reach, longest, n, out = self.done, self.reach, self.p.longest, len(text), []
        while i < stop:
            here, level, k = score[i], trie, i
            while k < n:
                node = level.get(text[k])
                if node is None:   # begins no piece
                    break
                k += 1
                if node[0] is not None:
                    if here + node[0] > score[k]:
                        score[k], start[k], piece[k] = here + node[0], i, node[1]
                    if k > reach:
                        reach = k
                level = node[2]
            i += 1
            if here + unknown > score[i]:
                first = trie.get(text[i - 1])
                if first is None or first[0] is None:   # the character is no piece: its bytes
                    score[i], start[i], piece[i] = here + unknown, i - 1, b""
            if reach <= i:                              # no piece runs over i: all paths meet there
                out.append(self._commit(i))
            elif (i - self.at) % longest == 0:
                meet = self._meeting(i, reach)
                if meet > self.at:
                    out.append(self._commit(meet))
            if i - self.at > self.peak:
                self.peak = i - self.at
            if self.at >= self.TRIM:
                cut = self.at
                self.text = text = text[cut:]
                del score[:cut], piece[:cut]
                self.start = start = [x - cut for x in start[cut:]]
                i, reach, n, stop, self.at = i - cut, reach - cut, n - cut, stop - cut, 0
        self.done, self.reach = i, max(reach, i)
        return b"".join(out)

    def _meeting(self, i: int, reach: int) -> int:
        """The last boundary that the paths of all open positions share."""
        alive = {k for k in range(i, reach + 1) if k == i or self.score[k] > self.NEVER}
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(max(self.start[last], self.at))
        return alive.pop()

    def _commit(self, end: int) -> bytes:
        """The ids of the path from the last committed boundary to this one."""
        start, piece, at, k, ids = self.start, self.piece, self.at, end, b""
        while k > at:
            i = start[k]
            ids = (piece[k] or self.p.fallback_bytes(self.text[i])) + ids   # a commit is some pieces long
            k = i
        self.at = end
        self.commits += 1
        return ids


class Spans:
    """Ids of committed spans, in two generations: when the younger one is full it becomes the older,
    and what is asked for again comes back from there."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def keep(self, span: str, ids: bytes) -> bytes:
        if len(span) <= CACHE_CHARS:
            if len(self.young) >= CACHE_SPANS:
                self.young, self.old = {}, self.young
            self.young[span] = ids
        return ids

    def find(self, span: str) -> bytes | None:
        """Ids of a span that is not in the younger generation."""
        ids = self.old.get(span)
        return self.keep(span, ids) if ids else None


class StreamingViterbi:
    """Feed characters with ``push``; it gives back ids as soon as they are certain. ``finish`` ends.

    ``spans`` is the cache of committed spans; streams over the same pieces may share it."""

    WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, pieces: Pieces, spans: Spans | None = None):
        self.p, self.spans = pieces, spans or Spans()
        self.window = Window(pieces)      # of a span too long to be held
        self.closed = Window(pieces)      # of spans whose end is known
        self.tail, self.open = "", False  # characters behind the last boundary; whether the window has earlier ones

    def _boundaries(self, chars: str) -> list[int]:
        """Places between two characters that are neighbours in no piece."""
        inside = self.p.inside
        return [i for i in range(1, len(chars)) if chars[i - 1:i + 1] not in inside]

    def _run(self, span: str) -> bytes:
        ids = self.spans.find(span)
        return ids or self.spans.keep(span, self.closed.feed(span) + self.closed.finish())

    def _word(self, word: str) -> bytes:
        """A word by its spans."""
        ids = self.spans.find(word)
        if ids:
            return ids
        cuts, get = self._boundaries(word), self.spans.young.get
        if not cuts:
            return self._run(word)
        spans = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]
        return self.spans.keep(word, b"".join([get(x) or self._run(x) for x in spans]))

    def push(self, chars: str) -> bytes:
        text = self.tail + chars
        if self.p.marks_first:
            last = text.rfind(MARK)
            while last > 0 and text[last - 1] == MARK:
                last -= 1
        else:
            last = max(self._boundaries(text), default=0)
        out = []
        if last > 0:
            closed, text = text[:last], text[last:]
            if self.open:          # the long span ends at the first boundary
                first = self.WORDS.match(closed).end() if self.p.marks_first else min([*self._boundaries(closed), last])
                out += [self.window.feed(closed[:first]), self.window.finish()]
                closed, self.open = closed[first:], False
            get, word = self.spans.young.get, self._word
            words = self.WORDS.findall(closed) if self.p.marks_first else [closed] if closed else []
            out += [get(w) or word(w) for w in words]
        if self.open or len(text) > CACHE_CHARS:
            out.append(self.window.feed(text))
            text, self.open = "", True
        self.tail = text
        return b"".join(out)

    def finish(self) -> bytes:
        if self.open:
            ids = self.window.feed(self.tail) + self.window.finish()
        else:
            ids = (self.spans.young.get(self.tail) or self._word(self.tail)) if self.tail else b""
        self.tail, self.open = "", False
        return ids


class Encoder:
    """Ids of whole texts, and back. Holds the piece table and the cache of committed spans."""

    STREAM = 1 << 16   # characters handed to the stream at a time

    def __init__(self, pieces: Pieces):
        self.p, self.spans = pieces, Spans()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text (int32); the empty text has none."""
        if not text:
            return np.zeros(0, np.int32)
        chars = MARK + text.replace(MARK, OWN_MARK).replace(" ", MARK)
        stream = StreamingViterbi(self.p, self.spans)
        parts = [stream.push(chars[i:i + self.STREAM]) for i in range(0, len(chars), self.STREAM)]
        return np.frombuffer(b"".join([*parts, stream.finish()]), "<i4")

    def forget(self) -> None:
        """Drop the spans: the worker may serve other work next."""
        self.spans = Spans()
        trim()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.p.spelled.__getitem__, ids)).decode("utf-8", errors="replace")[1:]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One table per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Pieces.load(path))
    return _ENCODERS[path]


def _rows_of(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` text bytes, so output batches stay small."""
    start, held = 0, 0
    for i, text in enumerate(batch.column(batch.num_columns - 1)):
        held += len(text.as_buffer()) if text.is_valid else 0
        if held >= limit:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _encode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for whole in batches:
            for batch in _rows_of(whole):
                ids = [enc.encode(t.as_py() if t.is_valid else "") for t in batch.column(batch.num_columns - 1)]
                offsets = np.r_[0, np.cumsum([len(x) for x in ids], dtype=np.int64)].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(
                    np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "ids"])
        enc.forget()
    return run


def _decode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            last = batch.column(batch.num_columns - 1)
            texts = [enc.decode(x.as_py()) if x.is_valid else None for x in last]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())],
                                             names=[*batch.schema.names[:-1], "text"])
    return run


def _key_schema(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)


def encode_documents(docs: DataFrame, model_path: str, keys: list[str], text_col: str = "text") -> DataFrame:
    """The ``keys`` columns and ids array<int> of each row's whole text.

    Defined cases: a null or empty text has no ids (an empty array); very long words are
    streamed in bounded memory; rows are independent, so repeated rows give equal ids; other
    columns than the keys take no part; an empty table gives an empty result.
    """
    rows = docs.select(*keys, F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode_batches(model_path), f"{_key_schema(docs, keys)}, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str, keys: list[str], ids_col: str = "ids") -> DataFrame:
    """The ``keys`` columns and the text of each row's ids (null ids: null)."""
    rows = encoded.select(*keys, F.col(ids_col).alias("ids"))
    return rows.mapInArrow(_decode_batches(model_path), f"{_key_schema(encoded, keys)}, text string")


def _check_batches(path: str):
    """Encode and decode each row: number of ids, their crc32, whether the text came back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n, crc, same = [], [], []
            for t in batch.column(1):
                text = t.as_py() if t.is_valid else ""
                ids = enc.encode(text)
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                same.append(enc.decode(ids.tolist()) == text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                                              pa.array(same, pa.bool_())],
                                             names=["doc_id", "n_ids", "ids_crc32", "round_trip"])
    return run


def check_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids_crc32 (ids as little-endian unsigned 32-bit integers), round_trip."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_check_batches(model_path),
                           "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
