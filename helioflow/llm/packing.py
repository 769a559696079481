"""Best-fit packing of token sequences, improved by swap-based local search.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt by hash to shards of
about ``SHARD_PIECES`` pieces, a bound on what one task packs; the shards' worst bins are pooled
and packed once more. Inside a shard, best fit of the longest piece first fills the bins; a local
search then empties the least full bin by moves, one-for-one and two-for-one exchanges into
other underfull bins, each of which increases the squared fill.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import arrow_parts, cut

CAPACITY = 4096
END_ID = 1
SHARD_PIECES = 40_000
#: Bytes of text that a worker encodes at a time, and how many words and other chunks it remembers.
PART, CACHED_WORDS = 2_000_000, 600_000
#: Letters that are one word to this tokenizer, and marks that it always parts from letters before them.
LETTERS = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
MARKS = ".,;:!?#$%&*"
#: Bytes that the tokenizer's byte alphabet shows as themselves, as ranges (fixed values); the others are shown, in order, as the code points from 256 on.
SHOWN = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


def byte_alphabet() -> dict[int, int]:
    hidden = [b for b in range(256) if not any(a <= b <= z for a, z in SHOWN)]
    return {b: 256 + k for k, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by a tokenizer file, from those of their distinct words.

    This tokenizer never joins characters across white space, and parts marks from the letters
    before them. So texts are split at blanks into chunks and these into letters and marks, all as Arrow
    arrays; each distinct word goes to the tokenizer's merges directly, in lower case. Chunks that are
    not letters and then marks go through the whole tokenizer. Ids are then gathered by place.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.alphabet = byte_alphabet()
        self.words: dict[str, list[int]] = {}
        self.others: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
            self.words[word] = ids = [t.id for t in self.merges(shown)]
        return ids

    def other(self, chunk: str) -> list[int]:
        ids = self.others.get(chunk)
        if ids is None:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            if len(chunk) < 100:
                self.others[chunk] = ids
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin, with the end of the last."""
        for kept in (self.words, self.others):
            if len(kept) > CACHED_WORDS:
                kept.clear()
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        chunks = split.flatten().dictionary_encode()
        distinct = chunks.dictionary
        letters = pc.utf8_rtrim(distinct, characters=MARKS)
        plain = pc.match_substring_regex(letters, LETTERS).to_numpy(zero_copy_only=False)
        marks = (pc.binary_length(distinct).to_numpy() - pc.binary_length(letters).to_numpy()).astype(np.int64)
        # Each chunk is one or two parts, numbers of what is in `found`; part 0 is none.
        found: list[list[int]] = [[]]
        first, second = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)

        def number(places: np.ndarray, strings: pa.Array, ids: Callable[[str], list[int]], into: np.ndarray) -> None:
            coded = strings.dictionary_encode()
            into[places] = coded.indices.to_numpy() + len(found)
            found.extend(map(ids, coded.dictionary.to_pylist()))

        words = np.flatnonzero(plain)
        number(words, pc.utf8_lower(letters.take(pa.array(words))), self.word, first)
        rest = np.flatnonzero(~plain)
        number(rest, distinct.take(pa.array(rest)), self.other, first)
        for n in np.unique(marks[words]):
            if n:
                own = words[marks[words] == n]
                number(own, pc.utf8_slice_codeunits(distinct.take(pa.array(own)), -int(n), None), self.other, second)

        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum())
        begins = np.cumsum(sizes) - sizes
        at = chunks.indices.to_numpy()
        parts = np.stack([first[at], second[at]], axis=1).ravel()
        lengths = sizes[parts]
        ends = np.cumsum(lengths)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[parts] - ends + lengths, lengths)]
        return ids, np.concatenate([[0], ends])[2 * (split.offsets.to_numpy() - split.offsets[0].as_py())]


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's tokenizer of the file at ``path``, with what it remembers."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids and the end id, cut.

    Null text counts as empty: a piece with the end id alone. Only the text goes through Python.
    """
    end, shape = np.array([end_id], np.uint32), "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"

    def cut_up(texts: pa.Array) -> pa.Array:
        sizes, rows = [0], []
        for part in arrow_parts(texts, PART):
            ids, begins = encoder(tokenizer_path).encode(part)
            for a, b in zip(begins, begins[1:], strict=False):
                own = np.concatenate([ids[a:b], end])
                for k, at in enumerate(range(0, len(own), capacity)):
                    piece = own[at : at + capacity]
                    rows.append((k, at, len(piece), zlib.crc32(piece.astype("<u4").tobytes())))
                sizes.append(len(rows))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        each = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(each, names=["piece", "start", "length", "ids_crc32"]))

    # Else Spark asks first, by a second run, whether there is anything to inline.
    cut = F.arrow_udf(cut_up, shape).asNondeterministic()
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), cut(F.col("text").cast("string")).alias("pieces"))
    return found.select("doc_id", F.inline("pieces"))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item indexes: longest first, each to the fullest bin that has room."""
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g is set if a bin with gap g exists
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        fits = open_gaps >> size
        if fits:
            gap = size + ((fits & -fits).bit_length() - 1)
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
            bins[at].append(i)
        else:
            gap, at = capacity, len(bins)
            bins.append([i])
        gap -= size
        by_gap[gap].append(at)
        open_gaps |= 1 << gap
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empty underfull bins, the least full first, by exchanges that increase the squared fill.

    For each item of the emptiest bin: move it where it fits, else exchange it for a smaller item
    of a bin that has room for the difference, else for two items that together are smaller. A bin
    from which nothing more can be moved is set aside. Every step takes tokens out of that bin, so
    the search ends.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    todo = sorted((k for k in range(len(bins)) if fill[k] < capacity), key=lambda k: fill[k])
    while len(todo) > 1:
        source, others = todo[0], todo[1:]
        if sum(capacity - fill[k] for k in others) < fill[source]:
            break  # no room left for all that it holds: no bin can be emptied
        improved = False
        for item in sorted(bins[source], key=lambda i: -lengths[i]):
            change = _best_exchange(lengths[item], bins, fill, others, lengths, capacity)
            if change:
                target, back = change
                bins[source].remove(item)
                bins[target].append(item)
                for i in back:
                    bins[target].remove(i)
                    bins[source].append(i)
                gain = lengths[item] - sum(lengths[i] for i in back)
                fill[source] -= gain
                fill[target] += gain
                improved = True
                break
        if not improved or not bins[source]:
            todo.pop(0)
        todo = sorted((k for k in todo if 0 < fill[k] < capacity), key=lambda k: fill[k])
    return [b for b in bins if b]


def _best_exchange(
    size: int, bins: list[list[int]], fill: list[int], others: list[int], lengths: list[int], capacity: int
) -> tuple[int, list[int]] | None:
    """The exchange for one item that leaves its target fullest: (bin, items that come back)."""
    best, found = -1, None
    for k in others:
        gap = capacity - fill[k]
        if size <= gap:
            if fill[k] + size > best:
                best, found = fill[k] + size, (k, [])
            continue
        # What comes back must free at least `need` and be smaller than the item.
        need = size - gap
        items = sorted(bins[k], key=lambda i: lengths[i])
        sizes = [lengths[i] for i in items]
        at = bisect_right(sizes, need - 1)
        if at < len(items) and sizes[at] < size and fill[k] + size - sizes[at] > best:
            best, found = fill[k] + size - sizes[at], (k, [items[at]])
        i, j = 0, len(items) - 1
        while i < j:
            both = sizes[i] + sizes[j]
            if both >= need:
                if both < size and fill[k] + size - both > best:
                    best, found = fill[k] + size - both, (k, [items[i], items[j]])
                j -= 1
            else:
                i += 1
    return found


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def _packer(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].tolist()
        sequence, offset, fill = (np.zeros(len(rows), np.int64) for _ in range(3))
        for k, items in enumerate(pack(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = k, at
                at += lengths[i]
            fill[items] = at
        base = int(rows["shard"].iloc[0]) * (SHARD_PIECES * 1000)
        return rows.assign(sequence_id=base + sequence, offset=offset, fill=fill)

    return packed


def pack_sequences(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as it can.

    Returns a row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    Null or empty text: one piece with the end id. Rows with a repeated or null doc_id are packed
    like others. Empty input: no rows. Other columns are not read. A shard whose last bins stay
    underfull pools their pieces with those of all shards; that pool, at most a few bins from each
    shard, is dealt to shards and packed once more.
    """
    names = ["doc_id", "no_id", "piece", "start", "length", "ids_crc32", "place"]
    # Pandas would make floats of ids with nulls among them. The place, fixed by the checkpoint, deals equal rows to different shards.
    marked = {"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0)), "place": F.monotonically_increasing_id()}
    cut_docs = cut(pieces(docs, tokenizer_path, capacity, end_id).withColumns(marked).select(*names))
    shape = "doc_id long, no_id boolean, piece int, start long, length long, ids_crc32 long, place long, shard long, sequence_id long, offset long, fill long"

    def dealt(rows: DataFrame, first: int) -> tuple[DataFrame, int]:
        """Packed shards, numbered from ``first`` on, and the number after the last."""
        shards = max(1, -(-rows.count() // shard_pieces))
        key = F.pmod(F.xxhash64("place"), F.lit(shards)) + first
        return rows.select(*names, key.alias("shard")).groupBy("shard").applyInPandas(_packer(capacity), shape), first + shards

    whole = cut_docs.where(F.col("length") == capacity).select(
        *names, (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    once, shards = dealt(cut_docs.where(F.col("length") < capacity), 0)
    once = cut(once)
    good = F.col("fill") >= F.lit(capacity * 0.98)
    twice, _ = dealt(once.where(~good), shards)
    packed = whole.unionByName(once.where(good).select(*names, "sequence_id", "offset")).unionByName(twice.select(*names, "sequence_id", "offset"))
    return packed.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id", "place")
