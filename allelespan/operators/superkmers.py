"""Saturating k-mer counts by super-k-mers.

Neighbouring k-mers mostly share their minimizer, the canonical m-mer of least hash among theirs, so a run of such k-mers is
sent as one stretch of bases, two bits each, to the bucket of the minimizer: about a byte for each k-mer instead of a string.
A k-mer and its reverse complement have the same minimizer, so all that is equal meets in one bucket. Buckets are sorted in
their partition and counted one after another; a bucket is summed whenever PENDING k-mers have come, so it takes memory for its
distinct k-mers only, however often they stand, and a hot minimizer costs no more than its different k-mers.

Sequences are joined by what is no base, and long ones are cut with k - 1 bases over, so that arrays are about CHUNK bases long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespan.operators.growth import BASES, strands

CHUNK = 1 << 20
PENDING = 1 << 21
LETTERS = np.frombuffer(b"ACGT", np.uint8)
#: Buckets for each shuffle partition, and buckets at least: a bucket's distinct k-mers are held by one task.
SPREAD, BUCKETS = 16, 2048


#: Places that are worked on at a time, so that their arrays of eight bytes stay in the processor's cache.
NEAR = 1 << 14


def _canonical(base: np.ndarray, k: int) -> np.ndarray:
    """Of each place the larger of both strands' k-mers, two bits a base; base: 0 to 3."""
    n = max(0, len(base) - k + 1)
    out = np.empty(n, np.uint64)
    for a in range(0, n, NEAR):
        np.maximum(*strands(base[a : a + NEAR + k - 1].astype(np.uint64), k), out=out[a : a + NEAR])
    return out


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Least of each w values side by side, by windows that double."""
    size = 1
    while 2 * size <= w:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (w - size)], h[w - size :]) if size < w else h


def runs(base: np.ndarray, k: int, m: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base: 0 to 3, 4 for none. Starts, k-mers and buckets of the runs of k-mers with one minimizer and bases only."""
    n = len(base) - k + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    bad = np.concatenate(([0], np.cumsum(base > 3)))
    good = bad[k:] == bad[:-k]
    h = np.empty(n, np.uint64)
    for a in range(0, n, NEAR):
        part = np.maximum(*strands((base[a : a + NEAR + k - 1] & 3).astype(np.uint64), m)) * np.uint64(0x9E3779B97F4A7C15)
        h[a : a + NEAR] = _least(part ^ (part >> np.uint64(29)), k - m + 1)
    cut = np.ones(n, bool)
    cut[1:] = (h[1:] != h[:-1]) | (good[1:] != good[:-1])
    starts = np.flatnonzero(cut)
    size = np.diff(np.append(starts, n))
    kept = good[starts]
    return starts[kept], size[kept], (h[starts[kept]] % np.uint64(buckets)).astype(np.int64)


def _stretch(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all stretches, one after another."""
    return np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _packed(base: np.ndarray, starts: np.ndarray, whole: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bases of the runs (starts, whole: bases) between two cuts each, one after another, four in a byte; each row begins with a byte of its own."""
    size = np.add.reduceat(whole, cuts)
    rows = -(-size // 4)
    ends = np.concatenate(([0], np.cumsum(rows)))
    four = np.zeros(4 * int(ends[-1]), np.uint8)
    own = np.append(cuts[1:], len(whole)) - cuts
    moved = np.repeat(4 * ends[:-1] - (np.cumsum(size) - size), own)  # of each run, by what the rows before are filled up
    at = np.cumsum(whole) - whole + moved
    for a in range(0, len(whole), NEAR // 8):
        part = slice(a, a + NEAR // 8)
        four[_stretch(at[part], whole[part])] = base[_stretch(starts[part], whole[part])]
    four = four.reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(packed)])


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the values between two cuts each."""
    offsets = (np.append(cuts, len(values)) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


#: The four bases in each byte, and their letters, as numbers of four bytes.
FOUR = (np.arange(256)[:, None] >> np.array([6, 4, 2, 0]) & 3).astype(np.uint8)
FOUR, SPELT = FOUR.view(np.uint32).ravel(), LETTERS[FOUR].view(np.uint32).ravel()


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return FOUR[np.frombuffer(packed, np.uint8)].view(np.uint8)[:n]


def parts(df: DataFrame, seq: str, k: int, by: str | None = None, m: int = 11, buckets: int = 1024) -> DataFrame:
    """bucket, by (if given), sizes (k-mers of each run) and bases of the runs of each batch."""
    kind = "" if by is None else f", `{by}` {df.schema[by].dataType.simpleString()}"
    m = min(m, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: dict = {}
            if by is None:
                keys[None] = None
                groups = {None: batch.column(0)}
            else:
                owner = [keys.setdefault(x, len(keys)) for x in batch.column(1).to_pylist()]
                owner = np.array(owner)
                groups = {x: batch.column(0).filter(pa.array(owner == i)) for x, i in keys.items()}
            for key, seqs in groups.items():
                for text in _texts(seqs, k):
                    base = BASES[np.frombuffer(text, np.uint8)]
                    starts, size, bucket = runs(base, k, m, buckets)
                    order = np.argsort(bucket, kind="stable")
                    starts, size, bucket = starts[order], size[order], bucket[order]
                    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                    if len(cuts):
                        cols = [pa.array(bucket[cuts].astype(np.int32))]
                        if by is not None:
                            cols.append(pa.array([key] * len(cuts), batch.schema.field(1).type))
                        cols += [_cut(size.astype(np.int32), cuts), _packed(base, starts, size + k - 1, cuts)]
                        yield pa.RecordBatch.from_arrays(cols, names=["bucket", *([] if by is None else [by]), "sizes", "bases"])

    columns = [F.col(seq).alias("_seq"), *([] if by is None else [F.col(by)])]
    return df.where(F.length(seq) >= k).select(*columns).mapInArrow(run, f"bucket int{kind}, sizes binary, bases binary")


def _texts(seqs: pa.Array, k: int) -> Iterator[bytes]:
    """Sequences joined by N, up to CHUNK bases; longer ones are cut so that every k-mer stands in one part."""
    held: list[bytes] = []
    size = 0
    for s in seqs:
        raw = s.as_py().encode("ascii", "replace")
        for at in range(0, len(raw) - k + 1, CHUNK):
            held.append(raw[at : at + CHUNK + k - 1])
            size += len(held[-1])
            if size >= CHUNK:
                yield b"N".join(held)
                held, size = [], 0
    if held:
        yield b"N".join(held)


def _letters(codes: np.ndarray, k: int) -> pa.Array:
    text = SPELT[np.ascontiguousarray(codes, ">u8").view(np.uint8)].view(np.uint8).reshape(-1, 32)[:, 32 - k :]
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(np.arange(0, (len(codes) + 1) * k, k, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(text)))


def _kmers(rows: list[tuple[bytes, bytes]], k: int) -> np.ndarray:
    """The k-mers of all runs of the rows (sizes, bases); each row's bases begin with a byte of their own."""
    sizes = [np.frombuffer(x, np.int32).astype(np.int64) for x, _ in rows]
    size = np.concatenate(sizes)
    packed = b"".join(x for _, x in rows)
    first = 4 * np.cumsum([0, *(len(x) for _, x in rows[:-1])])
    whole = size + k - 1
    at = np.cumsum(whole) - whole  # of each run, were rows not filled up
    runs_ = np.array([len(x) for x in sizes])
    row_at = at[np.cumsum(runs_) - runs_]
    at += np.repeat(first - row_at, runs_)
    return _canonical(_unpacked(packed, 4 * len(packed)), k)[_stretch(at, size)]


def _tables(batches: Iterator[pa.RecordBatch], k: int, tagged: bool, most: int) -> Iterator[tuple[int, list[tuple[object, np.ndarray, np.ndarray]]]]:
    """Each bucket with its tags, and their distinct k-mers in order with their counts; a tag's are handed on at once where tagged is
    false. batches: rows of parts(), sorted."""
    at, codes, n = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held: list[tuple[bytes, bytes]] = []
    pending = 0

    def add() -> None:
        nonlocal codes, n, pending
        if held:
            # rows are short where there are many buckets and tags, so they are taken together
            fresh, times = np.unique(_kmers(held, k), return_counts=True)
            held.clear()
            pending = 0
            if len(codes):
                fresh, where = np.unique(np.concatenate((codes, fresh)), return_inverse=True)
                times = np.bincount(where, np.concatenate((n, times)))
            codes, n = fresh, np.minimum(times, most).astype(np.int64)

    table: list[tuple[object, np.ndarray, np.ndarray]] = []
    for batch in batches:
        whose = batch.column(1).to_pylist() if batch.num_columns > 3 else [None] * batch.num_rows
        sizes, bases = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        for i, key in enumerate(zip(batch.column(0).to_pylist(), whose)):
            if key != at:
                if at is not None:
                    add()
                    table.append((at[1], codes, n))
                    codes, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                    if not tagged or key[0] != at[0]:
                        yield at[0], table
                        table = []
                at = key
            held.append((sizes[i], bases[i]))
            pending += 4 * len(bases[i])
            if pending >= PENDING:
                add()
    if at is not None:
        add()
        yield at[0], [*table, (at[1], codes, n)]


def _dealt(df: DataFrame, seq: str, k: int, by: str | None, m: int) -> DataFrame:
    if not 0 < k <= 32:
        raise ValueError("k is 1 to 32")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = parts(df, seq, k, by, m, max(BUCKETS, SPREAD * n))
    return found.repartition(n, "bucket").sortWithinPartitions("bucket", *([] if by is None else [by]))


def counts(df: DataFrame, seq: str, k: int, by: str | None = None, cap: int | None = 255, m: int = 11) -> DataFrame:
    """kmer (canonical, upper case) and its saturating count, in each `by`; of k-mers of ACGT in either case, up to 32 bases."""
    kind = "" if by is None else f"`{by}` {df.schema[by].dataType.simpleString()}, "
    most = np.iinfo(np.int64).max if cap is None else cap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal own
            for batch in batches:
                own = batch.schema.field(1).type
                yield batch

        for _, ((key, codes, n),) in _tables(seen(), k, False, most):
            for a in range(0, len(codes), STEP):
                part = codes[a : a + STEP]
                cols = [] if by is None else [pa.array([key] * len(part), own)]
                yield pa.RecordBatch.from_arrays([*cols, _letters(part, k), pa.array(n[a : a + STEP])], names=[*([] if by is None else [by]), "kmer", "cnt"])

    return _dealt(df, seq, k, by, m).mapInArrow(run, f"{kind}kmer string, cnt long")


#: Rows of a batch that is handed to Spark.
STEP = 100_000


def judged(df: DataFrame, seq: str, k: int, by: str, judge: Callable[[list, np.ndarray, np.ndarray, np.ndarray], dict[str, object]], schema: str, m: int = 11) -> DataFrame:
    """What `judge` makes of the k-mers by what has them. All that is equal meets in one bucket, so k-mers are neither written nor sent once
    they are counted. judge gets a bucket's values of `by`, and three arrays: k-mers in order, for each the number of a value that has it,
    and how often. It gives columns; of those, `kmer` is an array of k-mers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _tables(batches, k, True, np.iinfo(np.int64).max):
            codes = np.concatenate([c for _, c, _ in table])
            which = np.repeat(np.arange(len(table)), [len(c) for _, c, _ in table])
            n = np.concatenate([x for _, _, x in table])
            order = np.argsort(codes, kind="stable")
            got = judge([key for key, _, _ in table], codes[order], which[order], n[order])
            for a in range(0, len(next(iter(got.values()))), STEP):
                cut = {c: x[a : a + STEP] for c, x in got.items()}
                yield pa.RecordBatch.from_pydict({c: _letters(x, k) if c == "kmer" else pa.array(x) for c, x in cut.items()})

    return _dealt(df, seq, k, by, m).mapInArrow(run, schema)


def _starts(codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))[: len(codes)])


def of_one_group(keys: list, codes: np.ndarray, which: np.ndarray, n: np.ndarray) -> dict[str, object]:
    """For judged(): kmer, key and n of the k-mers that one value only has; rows without a value are counted, but are none."""
    at = _starts(codes)
    none = np.array([key is None for key in keys])[which]
    low, high = np.minimum.reduceat(np.where(none, len(keys), which), at), np.maximum.reduceat(np.where(none, -1, which), at)
    kept = low == high
    return {"kmer": codes[at][kept], "key": [keys[x] for x in low[kept]], "n": np.add.reduceat(n, at)[kept]}


def of_sets(keys: list, codes: np.ndarray, which: np.ndarray, n: np.ndarray) -> dict[str, object]:
    """For judged(), by a boolean: kmer and excluded of the k-mers of rows that are false; excluded where one that is true has it too."""
    at = _starts(codes)
    true, false = (np.array([key is x for key in keys])[which] for x in (True, False))
    kept = np.logical_or.reduceat(false, at)
    return {"kmer": codes[at][kept], "excluded": np.logical_or.reduceat(true, at)[kept]}


def _selected(keys: list, codes: np.ndarray, which: np.ndarray, n: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """By a part (g or w) and a haplotype: k-mer, haplotype, and both capped counts of each that one of both has."""
    names = sorted({key[1:] for key in keys})
    haplo = np.array([names.index(key[1:]) for key in keys])[which]
    gene = np.array([key[0] == "g" for key in keys])[which]
    order = np.lexsort((haplo, codes))
    codes, haplo, gene, n = codes[order], haplo[order], gene[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (haplo[1:] != haplo[:-1])))[: len(codes)])
    g, w = (np.minimum(np.add.reduceat(np.where(x, n, 0), at), cap) for x in (gene, ~gene))
    return codes[at], haplo[at], g, w, names


def selected_sums(keys: list, codes: np.ndarray, which: np.ndarray, n: np.ndarray, cap: int = 255) -> dict[str, object]:
    """For judged(), by g or w and a haplotype: haplo and the bucket's n_included, n_excluded and sum_diff."""
    codes, haplo, g, w, names = _selected(keys, codes, which, n, cap)
    ok = (g == w) & (g < cap)
    total = lambda x: np.bincount(haplo, x, len(names)).astype(np.int64)
    return {"haplo": names, "n_included": total(ok), "n_excluded": total(~ok), "sum_diff": total(np.where(ok, 0, np.abs(w - g)))}


def combined(keys: list, codes: np.ndarray, which: np.ndarray, n: np.ndarray, cap: int = 255) -> dict[str, object]:
    """For judged(), by g or w and a haplotype: kmer and n_haplo of the k-mers that each haplotype that has them includes."""
    codes, _, g, w, _ = _selected(keys, codes, which, n, cap)
    at = _starts(codes)
    kept = np.logical_and.reduceat((g == w) & (g < cap), at)
    return {"kmer": codes[at][kept], "n_haplo": np.diff(np.append(at, len(codes)))[kept].astype(np.int64)}


def hits(df: DataFrame, seq: str, k: int, listed: DataFrame, *keep: str) -> DataFrame:
    """keep, pos and kmer of the k-mers that the list (kmer) has, which the caller has bounded: it is sent to all tasks, a number a k-mer. Of
    other k-mers no row is made."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = b"".join(x.encode() for x in batch.column(0).to_pylist())
            base = BASES[np.frombuffer(text, np.uint8)].astype(np.uint64).reshape(-1, k)
            code = (base << (2 * np.arange(k - 1, -1, -1)).astype(np.uint64)).sum(axis=1, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], names=["code"])

    known = np.unique(listed.where(F.length("kmer") == k).select("kmer").mapInArrow(packed, "code long").toPandas()["code"].to_numpy(np.int64).view(np.uint64))
    sent = df.sparkSession.sparkContext.broadcast(known)
    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = sent.value
        spot = lambda x: (x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE)).astype(np.intp)
        there = np.zeros(1 << TABLE, bool)
        there[spot(codes)] = True
        for batch in batches:
            for first, offsets, text in _slices(batch.column(0), k):
                base = BASES[np.frombuffer(text, np.uint8)]
                if len(base) < k or not len(codes):
                    continue
                code = _canonical(base & 3, k)
                at = np.concatenate([a + np.flatnonzero(there[spot(code[a : a + NEAR])]) for a in range(0, len(code), NEAR)])
                at = at[codes[np.minimum(np.searchsorted(codes, code[at]), len(codes) - 1)] == code[at]]
                if not len(at):
                    continue
                row = np.searchsorted(offsets, at, "right") - 1
                bad = np.concatenate(([0], np.cumsum(base > 3)))
                good = (at + k <= offsets[row + 1]) & (bad[at + k] == bad[at])
                at, row = at[good], row[good]
                for a in range(0, len(at), STEP):
                    part, own = at[a : a + STEP], row[a : a + STEP]
                    pos = part - offsets[own] + np.where(own == 0, first[1], 0)
                    cols = [batch.column(j + 1).take(pa.array(own + first[0])) for j in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(pos.astype(np.int32)), _letters(code[part], k)], names=[*keep, "pos", "kmer"])

    return df.where(F.length(seq) >= k).select(F.col(seq).alias("_seq"), *keep).mapInArrow(run, f"{kinds}pos int, kmer string")


#: Bits of the places in the table that most k-mers outside the list fail.
TABLE = 24


def _slices(seqs: pa.Array, k: int) -> Iterator[tuple[tuple[int, int], np.ndarray, bytes]]:
    """Row and place that a slice begins at, the offsets of its rows in it, and its text, about CHUNK bases; longer sequences are cut
    with k - 1 bases over."""
    held: list[bytes] = []
    start = size = 0
    for i, s in enumerate(seqs):
        raw = s.as_py().encode("ascii", "replace")
        if len(raw) > 2 * CHUNK:
            if held:
                yield (start, 0), np.cumsum([0, *map(len, held)]), b"".join(held)
            for at in range(0, len(raw) - k + 1, CHUNK):
                part = raw[at : at + CHUNK + k - 1]
                yield (i, at), np.array([0, len(part)]), part
            held, size, start = [], 0, i + 1
            continue
        held.append(raw)
        size += len(raw)
        if size >= CHUNK:
            yield (start, 0), np.cumsum([0, *map(len, held)]), b"".join(held)
            held, size, start = [], 0, i + 1
    if held:
        yield (start, 0), np.cumsum([0, *map(len, held)]), b"".join(held)


#: Stands for a null owner while k-mers are counted; ids are above it.
NOBODY = np.iinfo(np.int64).min
#: Bytes of patterns that a task adds up before it hands them on.
HELD = 32 << 20


def _owned(batch: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """As _texts(), with the places where the parts begin and the parts' owners."""
    held: list[bytes] = []
    ids: list[int] = []
    size = 0

    def joined() -> tuple[np.ndarray, np.ndarray, bytes]:
        return np.cumsum([0, *(len(x) + 1 for x in held[:-1])]), np.array(ids, np.int64), b"N".join(held)

    for s, owner in zip(batch.column(0), batch.column(1).to_pylist()):
        raw = s.as_py().encode("ascii", "replace")
        for at in range(0, len(raw) - k + 1, CHUNK):
            held.append(raw[at : at + CHUNK + k - 1])
            ids.append(owner)
            size += len(held[-1])
            if size >= CHUNK:
                yield joined()
                held, ids, size = [], [], 0
    if held:
        yield joined()


def _counted(codes: np.ndarray, owner: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k-mers and owners in order, each pair once, with its counts added up."""
    order = np.lexsort((owner, codes))
    codes, owner, n = codes[order], owner[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1]))))
    return codes[at], owner[at], np.add.reduceat(n, at)


def patterns(df: DataFrame, seq: str, k: int, by: str, m: int = 11) -> DataFrame:
    """by (long), kmer, cnt, weight: k-mers that stand equally often in the same values of `by`, and in no other, are one row for each value: `kmer`
    is a number for all of them, `weight` how many they are. Sums over k-mers are sums over these rows times the weight. K-mers are sent as runs
    of bases, and a bucket holds its distinct k-mers of each value, but hands on patterns only."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, m = max(BUCKETS, SPREAD * n), min(m, k)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begins, ids, text in _owned(batch, k):
                base = BASES[np.frombuffer(text, np.uint8)]
                starts, size, bucket = runs(base, k, m, buckets)
                order = np.argsort(bucket, kind="stable")
                starts, size, bucket = starts[order], size[order], bucket[order]
                owner = ids[np.searchsorted(begins, starts, "right") - 1]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                if len(cuts):
                    cols = [pa.array(bucket[cuts].astype(np.int32)), _cut(size.astype(np.int32), cuts), _cut(owner, cuts), _packed(base, starts, size + k - 1, cuts)]
                    yield pa.RecordBatch.from_arrays(cols, names=["bucket", "sizes", "owners", "bases"])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """k-mers, owners and counts of each bucket."""
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        at, table = None, none
        held: list[tuple[bytes, bytes]] = []
        whose: list[bytes] = []
        pending = 0

        def add() -> None:
            nonlocal table, pending
            if held:
                fresh = _kmers(held, k)
                owner = np.repeat(np.frombuffer(b"".join(whose), np.int64), np.frombuffer(b"".join(x for x, _ in held), np.int32))
                table = _counted(np.concatenate((table[0], fresh)), np.concatenate((table[1], owner)), np.concatenate((table[2], np.ones(len(fresh), np.int64))))
                held.clear()
                whose.clear()
                pending = 0

        for batch in batches:
            for bucket, sizes, owners, bases in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if bucket != at:
                    add()
                    if len(table[0]):
                        yield table
                    at, table = bucket, none
                held.append((sizes, bases))
                whose.append(owners)
                pending += 4 * len(bases)
                if pending >= max(PENDING, len(table[0])):
                    add()
        add()
        if len(table[0]):
            yield table

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        size = 0
        for codes, owner, times in tables(batches):
            at = _starts(codes)
            end = np.append(at[1:], len(codes))
            both = np.stack((owner, times), axis=1)
            alone = at[end - at == 1]
            if len(alone):  # of one value only: by value and count
                one, count, weight = _counted(owner[alone].view(np.uint64), times[alone], np.ones(len(alone), np.int64))
                found = zip(np.stack((one.view(np.int64), count), axis=1), weight.tolist())
            else:
                found = iter(())
            raw = both.tobytes()
            more = end - at > 1
            for a, b in zip((16 * at[more]).tolist(), (16 * end[more]).tolist()):
                key = raw[a:b]
                if key in seen:
                    seen[key] += 1
                else:
                    seen[key] = 1
                    size += len(key) + 100
            for pair, weight in found:
                key = pair.tobytes()
                if key in seen:
                    seen[key] += weight
                else:
                    seen[key] = weight
                    size += 116
            if size >= HELD:
                yield from _dicts(seen)
                seen, size = {}, 0
        yield from _dicts(seen)

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                members = part.column(0).to_pylist()
                size = np.array([len(x) // 16 for x in members])
                both = np.frombuffer(b"".join(members), np.int64).reshape(-1, 2)
                kmer, weight = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), size) for i in (1, 2))
                own = pa.array(both[:, 0], mask=both[:, 0] == NOBODY)
                yield pa.RecordBatch.from_arrays([own, pa.array(kmer), pa.array(both[:, 1]), pa.array(weight)], names=[by, "kmer", "cnt", "weight"])

    rows = df.where(F.length(seq) >= k).select(F.col(seq).alias("_seq"), F.coalesce(F.col(by).cast("long"), F.lit(NOBODY)).alias("_by"))
    sent = rows.mapInArrow(cut, "bucket int, sizes binary, owners binary, bases binary").repartition(n, "bucket").sortWithinPartitions("bucket")
    found = sent.mapInArrow(judge, "members binary, weight long").groupBy("members").agg(F.sum("weight").alias("weight"))
    return found.select("members", F.monotonically_increasing_id().alias("kmer"), "weight").mapInArrow(spelt, f"`{by}` long, kmer long, cnt long, weight long")


def _dicts(seen: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    keys = list(seen)
    for a in range(0, len(keys), STEP):
        part = keys[a : a + STEP]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([seen[x] for x in part], pa.int64())], names=["members", "weight"])
