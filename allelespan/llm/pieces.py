"""SentencePiece (BPE) encoding with seeded merge-dropout, and lossless decoding.

A text gets a space in front and is cut into chunks, each a run of spaces and what follows up to the next space; no piece
of the vocabulary crosses such a border, which is checked when the vocabulary is read. In a chunk the agenda holds every
adjacent pair whose union is a piece; the best score merges first, the leftmost of equals. A candidate is skipped for good
if the keyed hash of (seed, row's key, the chunk's place in the row, its start, its end) is under `dropout`. Every place of
every row draws for itself, so a word is cut differently from place to place, and a rerun gives the same pieces. Characters
outside the vocabulary, and the space mark itself where a text holds it, become byte pieces.

Chunks of like length merge together in numpy, one merge of each chunk a step; chunks of over LONG characters go through a
heap. Both give the same pieces. Nothing is shared between equal chunks, so common words vary as freely as rare ones.

Memory is bounded by BLOCK characters of text: longer texts are cut between chunks. Decoding for `lossless` puts the pieces'
bytes together in numpy.

Edge cases: null gives null ids and null lossless; empty text gives no ids. Repeated rows with equal keys get equal ids.
Extra columns of the input are dropped; `keep` names those to carry.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelespan.llm._common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BLOCK = 1_000_000
LONG = 256
#: Characters of chunks that are merged at once.
TOGETHER = 1 << 17
NONE = np.int32(2**31 - 1)
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32, 64, 128, LONG)
CHUNK = re.compile(" +[^ ]*")
BORDER = re.compile("(?<! ) ")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeded(seed: int) -> np.uint64:
    return np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))


class Pieces:
    """Vocabulary as arrays; small enough to be sent to the executors, which need no model file."""

    def __init__(self, model: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        normal = [i for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw: list[bytes] = [b""] * len(sp)
        ids = {}
        for i in normal:
            ids[p := sp.id_to_piece(i)] = i
            self.raw[i] = p.replace(MARK, " ").encode()
            if MARK in p.lstrip(MARK):
                raise ValueError(f"piece {p!r} crosses a border of chunks")
        for b, i in enumerate(self.byte):
            self.raw[i] = bytes([b])
        self.single = {" " if p == MARK else p: i for p, i in ids.items() if len(p) == 1}
        order = {i: n for n, i in enumerate(sorted(normal, key=lambda i: (-sp.get_score(i), i)))}
        pairs = sorted((ids[p[:k]] << 20 | ids[p[k:]], order[i], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
        bits = int(len(pairs) + 1).bit_length() + 2
        self.shift, empty = np.uint64(64 - bits), (1 << bits) + 64
        #: Open addressing: pairs of symbols, -1 for none, and the ranks of their unions.
        self.pair, self.rank_of = np.full(empty, -1, dtype=np.int64), np.full(empty, NONE, dtype=np.int32)
        for (key, r, _), slot in zip(pairs, self._slot(np.array([k for k, _, _ in pairs], dtype=np.int64)).tolist()):
            while self.pair[slot] != -1:
                slot += 1
            self.pair[slot], self.rank_of[slot] = key, r
        self.made = np.zeros(len(normal) + 1, dtype=np.int32)  # by rank
        for i, n in order.items():
            self.made[n] = i
        self._start: np.ndarray | None = None
        #: All pieces' bytes one after the other, and where each begins.
        self.pool = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        self.at = np.concatenate(([0], np.cumsum([len(x) for x in self.raw])))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_start": None}

    def start(self) -> np.ndarray:
        """First symbol of each code point; -1: several byte pieces."""
        if self._start is None:
            self._start = np.full(0x110000, -1, dtype=np.int32)
            self._start[:128] = self.byte[:128]
            for c, i in self.single.items():
                self._start[ord(c)] = i
        return self._start

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        slot = self._slot(key)
        found = self.pair[slot]
        other = np.flatnonzero((found != key) & (found != -1))
        while len(other):
            slot[other] += 1
            found = self.pair[slot[other]]
            other = other[(found != key[other]) & (found != -1)]
        return np.where((self.pair[slot] == key) & (left >= 0) & (right >= 0), self.rank_of[slot], NONE)


def _span(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return start.astype(np.uint64) << np.uint64(32) | end.astype(np.uint64)


def _under(x: np.ndarray, dropout: float) -> np.ndarray:
    return (x >> np.uint64(11)) < np.uint64(int(dropout * 2.0**53))


def _skipped(salt: np.ndarray, span: np.ndarray, dropout: float) -> np.ndarray:
    return _under(_mix(salt ^ _mix(span)), dropout)


def salts(keys: np.ndarray, rows: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """A keyed hash of each place: rows are positions in keys, place the chunk's number in its row."""
    own = _mix(keys.astype(np.int64).view(np.uint64) ^ _mix(np.array([_seeded(seed)])))
    return _mix(own[rows] + _mix(place.astype(np.uint64) + np.uint64(1)))


def _many(p: Pieces, code: np.ndarray, size: np.ndarray, salt: np.ndarray, dropout: float) -> np.ndarray:
    """Symbols of chunks, which are rows of code points, each where its first character stands; -2 elsewhere."""
    n, width = code.shape
    where, base = np.arange(width), np.arange(n) * width
    symbol = np.where(where < size[:, None], p.start()[code], np.int32(-2)).ravel()
    after, before = np.tile(where + 1, n), np.tile(where - 1, n)
    ranks = np.full((n, width), NONE, dtype=np.int32)
    flat = ranks.ravel()

    def offer(row: np.ndarray, i: np.ndarray) -> None:
        """The pairs of the symbols at i and those after them."""
        j = after[base[row] + i]
        r = p.rank(symbol[base[row] + i], symbol[base[row] + j])
        may = np.flatnonzero(r != NONE)
        row, i, j, r = row[may], i[may], j[may], r[may]
        if dropout > 0:
            r[_skipped(salt[row], _span(i, after[base[row] + j]), dropout)] = NONE
        flat[base[row] + i] = r

    if width > 1:
        offer(*np.nonzero(where[None, 1:] < size[:, None]))
    rows, open_ = np.arange(n), ranks
    while len(rows):
        i = open_.argmin(axis=1)
        best = open_[np.arange(len(rows)), i]
        live = best != NONE
        rows, i = rows[live], i[live]
        a = base[rows] + i
        j = after[a]
        b = base[rows] + j
        symbol[a], symbol[b] = p.made[best[live]], -2
        after[a] = after[b]
        inner = after[a] < size[rows]
        before[base[rows[inner]] + after[a][inner]] = i[inner]
        h = before[a]
        left = h >= 0
        flat[a] = flat[b] = NONE
        flat[base[rows[left]] + h[left]] = NONE
        offer(rows[inner], i[inner])
        offer(rows[left], h[left])
        open_ = ranks[rows]
    return symbol.reshape(n, width)


def _one(p: Pieces, chunk: str, salt: np.uint64, dropout: float) -> list[tuple[int, int]]:
    """(symbol, start) of a long chunk, by the agenda as a heap."""
    code = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbol, n = p.start()[code].tolist(), len(code)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int]] = []

    def offer(i: np.ndarray) -> None:
        j = np.array([after[x] for x in i], dtype=np.int64)
        i, j = i[j < n], j[j < n]
        if len(i):
            stop = np.array([end[x] for x in j], dtype=np.int64)
            r = p.rank(np.array([symbol[x] for x in i]), np.array([symbol[x] for x in j]))
            r = np.where(_skipped(np.array([salt], dtype=np.uint64), _span(i, stop), dropout), NONE, r)
            for a, b, rank in zip(i.tolist(), stop.tolist(), r.tolist()):
                if rank != NONE:
                    heapq.heappush(agenda, (rank, a, b, end[a]))

    offer(np.arange(n))
    gone = [False] * n
    while agenda:
        rank, i, stop, middle = heapq.heappop(agenda)
        if gone[i] or end[i] != middle or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        symbol[i], end[i], after[i], gone[j] = int(p.made[rank]), stop, after[j], True
        if after[i] < n:
            before[after[i]] = i
        offer(np.array([x for x in (before[i], i) if x >= 0]))
    return [(symbol[i], i) for i in range(n) if not gone[i]]


def _points(chunks: list[str], width: int, size: np.ndarray) -> np.ndarray:
    code = np.zeros((len(chunks), width), dtype=np.uint32)
    code[np.arange(width) < size[:, None]] = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return code


def _ids(p: Pieces, symbols: np.ndarray, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each row, and all ids; characters outside the vocabulary (-1) are written out in bytes."""
    count = (symbols >= 0).sum(axis=1)
    if not (symbols == -1).any():
        return count, symbols[symbols >= 0]
    rows = [_expanded(p, [(x, i) for i, x in enumerate(own) if x != -2], c) for own, c in zip(symbols.tolist(), chunks)]
    return np.array([len(r) for r in rows]), np.array([x for r in rows for x in r], dtype=np.int32)


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] numbers, then of the next."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def segment(p: Pieces, chunks: list[str], salt: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each chunk, and all ids."""
    size = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
    count, parts, low = np.zeros(len(chunks), dtype=np.int64), [], 0
    for width in WIDTHS:
        every, step = np.flatnonzero((size > low) & (size <= width)), TOGETHER // width + 1
        low = width
        for a in range(0, len(every), step):
            own = every[a : a + step]
            some = [chunks[i] for i in own.tolist()]
            count[own], ids = _ids(p, _many(p, _points(some, width, size[own]), size[own], salt[own], dropout), some)
            parts.append((own, ids))
    for i in np.flatnonzero(size > LONG).tolist():
        ids = _expanded(p, _one(p, chunks[i], salt[i], dropout), chunks[i])
        count[i] = len(ids)
        parts.append((np.array([i]), np.array(ids, dtype=np.int32)))
    off, out = np.cumsum(count) - count, np.zeros(count.sum(), dtype=np.int32)
    for own, ids in parts:
        out[_ragged(off[own], count[own])] = ids
    return count, out


def _expanded(p: Pieces, got: list[tuple[int, int]], chunk: str) -> list[int]:
    out = []
    for s, a in got:
        out += [s] if s >= 0 else [p.byte[b] for b in chunk[a].encode("utf-8", "surrogatepass")]
    return out


def _cut(texts: list[str]) -> Iterator[tuple[int, str]]:
    """(number of the text, part): texts with a space in front, in parts of about BLOCK characters that end where a chunk does."""
    for i, t in enumerate(texts):
        t, at = " " + t if t else "", 0
        while at < len(t):
            m = BORDER.search(t, at + BLOCK) if len(t) - at > BLOCK else None
            stop = m.start() if m else len(t)
            yield i, t[at:stop]
            at = stop


def encode(p: Pieces, texts: list[str], keys: np.ndarray, seed: int = 0, dropout: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of the texts; keys: an integer for each text."""
    total, out = np.zeros(len(texts), dtype=np.int64), []
    chunks: list[str] = []
    rows: list[tuple[int, int, int]] = []  # text, place of its first chunk here, number of chunks

    def flush() -> None:
        row, first, size = (np.array(x, dtype=np.int64) for x in zip(*rows))
        place = np.arange(len(chunks)) - np.repeat(np.cumsum(size) - size - first, size)
        which = np.repeat(row, size)
        count, ids = segment(p, chunks, salts(keys, which, place, seed), dropout)
        np.add.at(total, which, count)
        out.append(ids)
        chunks.clear()
        rows.clear()

    held, last, place = 0, -1, 0
    for i, part in _cut(texts):
        place = place if i == last else 0
        found = CHUNK.findall(part)
        if held + len(part) > BLOCK and chunks:
            flush()
            held = 0
        chunks += found
        rows.append((i, place, len(found)))
        held, last, place = held + len(part), i, place + len(found)
    if chunks:
        flush()
    return np.concatenate(([0], np.cumsum(total))), np.concatenate(out) if out else np.zeros(0, np.int32)


def decoded_bytes(p: Pieces, ids: np.ndarray) -> np.ndarray:
    """The bytes of all ids, with the space that is put in front of each text."""
    return p.pool[_ragged(p.at[ids], p.at[ids + 1] - p.at[ids])]


def lossless(p: Pieces, texts: list[str | None], off: np.ndarray, ids: np.ndarray) -> list[bool | None]:
    """Whether each text comes back from its ids, byte for byte; null for null."""
    out: list[bool | None] = []
    for t, a, b in zip(texts, off[:-1].tolist(), off[1:].tolist()):
        want, ok, at = (" " + t if t else t or "").encode("utf-8", "surrogatepass"), True, 0
        for x in range(a, b, BLOCK):
            part = decoded_bytes(p, ids[x : min(b, x + BLOCK)]).tobytes()
            ok, at = ok and want.startswith(part, at), at + len(part)
        out.append(None if t is None else ok and at == len(want))
    return out


def decode(p: Pieces, ids: list[int]) -> str:
    return b"".join([p.raw[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def encoded(df: DataFrame, key: str, text: str, keep: list[str], p: Pieces | None = None, seed: int = 0, dropout: float = 0.1) -> DataFrame:
    """keep, then ids, n_tokens and lossless (whether the whole text comes back from the ids)."""
    p = p or Pieces()
    keep = [c for c in keep if c not in ("ids", "n_tokens", "lossless")]
    cols = [F.col(c) for c in keep]
    rows = df.select(F.xxhash64(key).alias("_key"), F.col(text).alias("_text"), *cols)
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.IntegerType()), T.StructField("lossless", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, size = batch.column(0).to_numpy(), pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            a = 0
            while a < len(size):
                b, held = a, 0
                while b < len(size) and (b == a or held + size[b] <= BLOCK):
                    held += size[b]
                    b += 1
                texts = batch.column(1).slice(a, b - a).to_pylist()  # only the block's texts become strings
                off, ids = encode(p, [t or "" for t in texts], keys[a:b], seed, dropout)
                null = np.array([t is None for t in texts])
                ok = lossless(p, texts, off, ids)
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(null))
                counts = pa.array(np.diff(off), pa.int32(), mask=null)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[2:], lists, counts, pa.array(ok, pa.bool_())], names=[*keep, "ids", "n_tokens", "lossless"])
                a = b

    return rows.mapInArrow(run, schema)


def op7_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), "doc_id", "text", ["doc_id"])


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs, "doc_id", "text", docs.columns)
