"""Token counts of byte-pair encoding by a heap and a linked list, without ids.

A text is cut at added tokens (each one token), what is left into the pieces of the pre-tokenizer's pattern, and a piece into
bytes, its first symbols. The heap holds every adjacent pair that has a rank; the lowest rank merges first, the leftmost of
equals, and the list's neighbours give the new pairs. The count is the number of symbols less the number of merges.

Map only. Counts of short pieces are kept in a task, up to KEPT of them, so a common word is merged once. A long piece is cut
first between bytes that stand together in no token, which no merge can join; the heap sees one such part at a time and takes
about 60 bytes for each of its bytes. Pieces come from the text one after another, so a long text makes no list of them.
The vocabulary (some 50,000 merges, of the file's size) goes to the executors with the task; they need no file.

Edge cases: null and empty texts have no tokens. Repeated rows are counted alike. Extra columns are dropped; `keep` names
those to carry, and those of the names that are added are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelespan.llm._common import table

NAME = "byte_bpe_50k.json"
LIMIT = 512
#: Pieces whose count a task keeps, and the longest of them in characters.
KEPT, SHORT = 400_000, 48
#: Pieces of more bytes are cut where no merge can join.
LONG = 64
#: Longer texts are read piece by piece, without a list of pieces.
LARGE = 1_000_000

# Characters that later versions of Unicode made letters or numbers; the library's version has them as neither.
NEWER = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
# Fixed value: how byte-level vocabularies write bytes as characters.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _pattern(letter: str, number: str, flags: int = 0) -> regex.Pattern:
    both = rf"[^\s{letter}{number}]" if not flags else rf"[[^\s]--[{letter}{number}]]"
    return regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?{both}+|\s+(?!\S)|\s+", flags)


class Merges:
    """Ranks of the merges of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, cut = made["model"], made["pre_tokenizer"]
        plain = model["type"] == "BPE" and not made["normalizer"] and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        if not plain or model.get("ignore_merges") or model.get("dropout") or any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in made["added_tokens"]):
            raise ValueError("not a plain byte-level vocabulary")
        rest = iter(range(256, 512))
        byte = {chr(b if b in PRINTED else next(rest)): b for b in range(256)}
        ids = model["vocab"]
        #: The first symbol of each byte.
        self.first = [0] * 256
        for c, b in byte.items():
            self.first[b] = ids[c]
        #: Rank of a pair of symbols, and the symbol that each rank makes.
        self.rank: dict[int, int] = {}
        self.made = array("i")
        for n, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[ids[a] << 20 | ids[b]] = n
            self.made.append(ids[a + b])
        #: For each byte, those that follow it in some token.
        self.follows = [bytearray(256) for _ in range(256)]
        for token in ids:
            if all(c in byte for c in token):
                for a, b in zip(token, token[1:]):
                    self.follows[byte[a]][byte[b]] = 1
        self.added = sorted((x["content"] for x in made["added_tokens"]), key=len, reverse=True)

    def parts(self, piece: bytes) -> Iterator[bytes]:
        """piece, cut between bytes that no token has side by side."""
        start, follows = 0, self.follows
        for i in range(1, len(piece)):
            if not follows[piece[i - 1]][piece[i]]:
                yield piece[start:i]
                start = i
        yield piece[start:]

    def count(self, part: bytes) -> int:
        """Symbols less merges."""
        n, get, made, pop, push = len(part), self.rank.get, self.made, heapq.heappop, heapq.heappush
        packed = (lambda x: array("i", x)) if n > LONG else list  # lists are quicker, arrays smaller
        symbol = packed(map(self.first.__getitem__, part))
        heap = [r << 32 | i for i in range(n - 1) if (r := get(symbol[i] << 20 | symbol[i + 1])) is not None]
        if not heap:
            return n
        after, before = packed(range(1, n + 1)), packed(range(-1, n - 1))
        heapq.heapify(heap)
        left = n
        while heap:
            top = pop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if j >= n or symbol[i] < 0 or get(symbol[i] << 20 | symbol[j]) != r:
                continue  # one of the two has gone into another symbol
            symbol[i] = x = made[r]
            symbol[j] = -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (y := get(x << 20 | symbol[k])) is not None:
                    push(heap, y << 32 | i)
            h = before[i]
            if h >= 0 and (y := get(symbol[h] << 20 | x)) is not None:
                push(heap, y << 32 | h)
        return left

    def counter(self) -> Callable[[str], int]:
        """Tokens of a text; keeps the counts of short pieces."""
        usual, exact = _pattern(r"\p{L}", r"\p{N}"), _pattern(rf"[\p{{L}}--[{NEWER}]]", rf"[\p{{N}}--[{NEWER}]]", regex.V1)
        high, newer = regex.compile(r"[^\x00-\u0557]"), regex.compile(f"[{NEWER}]")
        added = regex.compile("|".join(map(regex.escape, self.added)))
        count, parts = self.count, self.parts

        class Kept(dict):
            def __missing__(self, piece: str) -> int:
                raw = piece.encode("utf-8", "surrogatepass")
                n = sum(map(count, parts(raw))) if len(raw) > LONG else count(raw)
                if len(piece) <= SHORT:
                    if len(self) >= KEPT:
                        self.clear()
                    self[piece] = n
                return n

        kept = Kept()

        def tokens(text: str) -> int:
            n = 0
            texts = added.split(text) if any(x in text for x in self.added) else [text]
            n = len(texts) - 1
            for t in texts:
                pattern = exact if high.search(t) and newer.search(t) else usual
                n += sum(kept[m.group()] for m in pattern.finditer(t)) if len(t) > LARGE else sum(map(kept.__getitem__, pattern.findall(t)))
            return n

        return tokens


def counted(df: DataFrame, text: str, merges: Merges, keep: list[str], limit: int = LIMIT) -> DataFrame:
    """keep, then n_bytes (UTF-8), n_tokens and over_limit of each row's whole text."""
    names = {"n_bytes", "n_tokens", "over_limit"}
    keep = [c for c in keep if c.lower() not in names]
    rows = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"), *(F.col(f"`{c}`") for c in keep))
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = merges.counter()
        for batch in batches:
            texts = batch.column(0)
            n = [tokens(t.as_py()) for t in texts]
            cols = [pa.compute.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *cols], names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, schema)


def op12_heap_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = spark.conf.get("spark.allelespan.tokens.file", None) or public_tokenizers.path(NAME)
    return counted(table(spark, sf_dir, "documents"), "text", Merges(path), ["doc_id"])
