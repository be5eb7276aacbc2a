"""Best-fit decreasing packing of tokenised documents into sequences of fixed length.

Documents become token ids plus an end id; longer ones are cut into full pieces and a
rest. Best-fit decreasing looks at lengths only, so it runs on the histogram of lengths
(``length`` entries whatever the input) and places equal lengths as one run: a segment tree
over remaining capacities finds the tightest capacity with open bins in logarithmic time.
Bins are kept as ranges of numbers, and every placement is a range of ranks inside one
length. The rows then find their place by rank; no bin, piece or text meets another one.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.llm.common import relieved, staged, text_slices

SALTS = 64
MEMO_WORDS = 600_000
LEARN_AT_ONCE = 20_000
BREAK = "~"

# How a tokenizer normalises and splits whose tokens never span a space,
# whatever the case, and to which a run of letters is one word.
WORDWISE = {
    "normalizer": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "pre_tokenizer": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

# Western text as single bytes. Letters beyond ASCII whose lower case is a byte too; every
# other byte beyond ASCII, and control signs, make a text one for the tokenizer alone.
CODEC = "cp1252"
LETTERS = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞŒŸ"
LETTERS += LETTERS.lower() + "ß"


def _byte_tables() -> tuple[bytes, bytes]:
    """Kinds of bytes (o other, a letter or digit, dot, sign, space), and lower case."""
    kinds, low = bytearray(b"o" * 256), bytearray(range(256))
    for i in range(32, 128):
        sign = chr(i)
        kinds[i] = ord("a" if sign.isalnum() else "." if sign in ".," else " " if sign == " " else "!")
        low[i] = ord(sign.lower())
    for sign in "\n\t\r":
        kinds[ord(sign)] = low[ord(sign)] = ord(" ")
    for letter in LETTERS:
        at = letter.encode(CODEC)[0]
        kinds[at], low[at] = ord("a"), letter.lower().encode(CODEC)[0]
    return bytes(kinds), bytes(low)


KINDS, LOW = _byte_tables()


def _visible_bytes() -> list[str]:
    """The character a byte-level vocabulary writes for each byte: printable ones stand for
    themselves, the others for code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


VISIBLE = _visible_bytes()


class Encoder:
    """Token ids of whole texts as little-endian bytes.

    For a word-wise tokenizer (``WORDWISE``) a text's ids are those of its space-separated
    words, and the ids of words seen before are kept. Case is ignored by it, and a comma or
    full stop after a letter or digit is a token of its own; both are settled before words
    are looked up, so that fewer are distinct. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, words: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = words
        self.known: dict[bytes | str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.wordwise = all(
            ((given.get(part) or {}).get("normalizers") or (given.get(part) or {}).get("pretokenizers")) == steps
            for part, steps in WORDWISE.items()
        )
        self.breaks = self._ids(BREAK)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.wordwise:
            return [self._ids(text).tobytes() for text in texts]
        parts = [self.split(text) for text in texts]
        new = set().union(*parts).difference(self.known) if parts else set()
        if len(self.known) + len(new) > self.words:
            self.known.clear()
            new = set().union(*parts)
        self._learn(new)
        look = self.known.__getitem__
        return [b"".join(map(look, words)) for words in parts]

    @staticmethod
    def split(text: str) -> list:
        """Words as bytes of one code page if the text is Western, else as text."""
        try:
            coded = text.encode(CODEC)
        except UnicodeEncodeError:
            coded = b"\x00"
        kinds = coded.translate(KINDS)
        if b"o" in kinds:
            return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        coded = coded.translate(LOW)
        # A comma or stop that ends a longer run of signs is part of that run's token.
        if b"!. " not in kinds and b".. " not in kinds:
            coded = coded.replace(b", ", b" , ").replace(b". ", b" . ")
        return coded.split(b" ")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, words: set) -> None:
        """Runs of letters go to the vocabulary directly; of the others many are encoded in
        one call, with a sign between them that none of them holds."""
        model, rest = self.tokenizer.model, []
        for word in words:
            text = word.decode(CODEC) if isinstance(word, bytes) else word
            if isinstance(word, bytes) and text.isalpha():
                shown = text if word.isalpha() else "".join([VISIBLE[b] for b in text.encode()])
                ids = [token.id for token in model.tokenize(shown)]
                self.known[word] = np.array(ids, dtype="<u4").tobytes()
            elif BREAK in text:
                self.known[word] = self._ids(text).tobytes()
            else:
                rest.append((text, word))
        for i in range(0, len(rest), LEARN_AT_ONCE):
            part = rest[i : i + LEARN_AT_ONCE]
            ids = self._ids(f" {BREAK} ".join(text for text, _ in part))
            cuts = np.flatnonzero(ids == self.breaks[0])
            coded, start = ids.tobytes(), 0
            for (_, word), cut in zip(part, [*cuts.tolist(), len(ids)], strict=True):
                self.known[word] = coded[4 * start : 4 * cut]
                start = cut + 1


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process, so that words are kept from task to task."""
    return Encoder(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    df: DataFrame, tokenizer: str, length: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of every row: full ones of ``length`` ids, and the rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4").tobytes()
        coder = encoder(tokenizer)
        for batch in relieved(batches):
            owner, number, start, size, crc = [], [], [], [], []
            for first, texts in text_slices(batch.column("text")):
                for i, ids in enumerate(coder.encode([t or "" for t in texts]), first):
                    ids += end
                    for at in range(0, len(ids), 4 * length):
                        run = ids[at : at + 4 * length]
                        owner.append(i)
                        number.append(at // (4 * length))
                        start.append(at // 4)
                        size.append(len(run) // 4)
                        crc.append(zlib.crc32(run))
            yield pa.RecordBatch.from_arrays(
                [
                    pc.take(batch.column("doc_id"), pa.array(owner, pa.int64())),
                    pa.array(number, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (start, size, crc)],
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


class Capacities:
    """Segment tree that counts open bins by remaining capacity."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        at = capacity + self.leaves
        while at:
            self.tree[at] += bins
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= ``least`` with an open bin."""
        at = least + self.leaves
        if self.tree[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit(histogram: dict[int, int], length: int, first_bin: int = 0) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first bin, offset): a bin more for each rank.

    Longest first; every piece goes into the tightest open bin, and else into a new one.
    Equal pieces fill such a bin one after the other, so many bins are filled at a time.
    """
    tree = Capacities(length)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    runs: list[tuple[int, int, int, int, int]] = []
    fresh = first_bin

    def leave(capacity: int, start: int, bins: int) -> None:
        if capacity and bins:
            open_bins.setdefault(capacity, []).append((start, bins))
            tree.add(capacity, bins)

    for size in sorted(histogram, reverse=True):
        rank, count = 0, histogram[size]
        while rank < count:
            capacity = tree.tightest(size)
            if capacity is not None:
                # A bin that took a piece and has room for another is the tightest then.
                each = capacity // size
                start, bins = open_bins[capacity].pop()
                tree.add(capacity, -bins)
                whole = min(bins, (count - rank) // each)
                rest = min(count - rank - whole * each, each) if whole < bins else 0
                used = whole + (rest > 0)
                leave(capacity, start + used, bins - used)
                for layer in range(each):
                    if whole:
                        runs.append((size, rank, rank + whole, start, length - capacity + layer * size))
                        rank += whole
                leave(capacity - each * size, start, whole)
                for layer in range(rest):
                    runs.append((size, rank, rank + 1, start + whole, length - capacity + layer * size))
                    rank += 1
                leave(capacity - rest * size, start + whole, int(rest > 0))
                continue
            # No open bin has room. A new bin is then filled before the next is opened,
            # so new bins are opened many at a time, each with as many pieces as fit.
            each = length // size
            whole, rest = divmod(count - rank, each)
            for layer in range(each):
                if whole:
                    runs.append((size, rank, rank + whole, fresh, layer * size))
                    rank += whole
            leave(length - each * size, fresh, whole)
            fresh += whole
            for layer in range(rest):
                runs.append((size, rank, rank + 1, fresh, layer * size))
                rank += 1
            leave(length - rest * size, fresh, min(rest, 1))
            fresh += min(rest, 1)
    return runs


def pack(
    df: DataFrame,
    tokenizer: str,
    length: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces with sequence_id and offset; sequences are gapless and hold ``length`` ids at most.

    A null text is empty and gives the end id alone. Rows with equal ids are packed one by
    one. An empty input gives no rows. Other columns are not read. The text is read once;
    its pieces (five numbers each) are written to the shared folder.
    """
    cut = staged(pieces(df, tokenizer, length, end_id, id_col, text_col), "pack-pieces")
    salt = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(SALTS)).cast("int")
    salted = cut.withColumn("_salt", salt)
    # length x SALTS rows at most, whatever the input; a frequent length is ranked in parts.
    groups = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")).collect()
    table = np.zeros((length + 1, SALTS), dtype=np.int64)
    for row in groups:
        table[row["length"], row["_salt"]] = row["_n"]
    totals, bases = table.sum(axis=1), np.cumsum(table, axis=1) - table
    runs = np.array(
        sorted(best_fit({int(size): int(totals[size]) for size in np.flatnonzero(totals)}, length)), dtype=np.int64
    ).reshape(-1, 5)
    size_starts = np.searchsorted(runs[:, 0], np.arange(length + 2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy()
            ranks = batch.column("_rank").to_numpy() + bases[sizes, batch.column("_salt").to_numpy()]
            at = np.empty(len(sizes), dtype=np.int64)
            for size in np.unique(sizes):
                lo, hi = size_starts[size], size_starts[size + 1]
                mine = sizes == size
                at[mine] = lo + np.searchsorted(runs[lo:hi, 1], ranks[mine], side="right") - 1
            out = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            places = [pa.array(runs[at, 3] + ranks - runs[at, 1]), pa.array(runs[at, 4])]
            yield pa.RecordBatch.from_arrays([*out.columns, *places], [*out.schema.names, "sequence_id", "offset"])

    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = salted.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
