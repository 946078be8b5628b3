"""Token ids as ORC files in document order: run-length encoded ids, row indexes, Bloom filters on document ids."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ledgerlight.llm import text
from ledgerlight.session import cut, scratch_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
CACHED = 400_000  # encoded pieces that a worker remembers; a bound on memory only
CACHED_LETTERS = 16  # bytes of them for each, on the whole
LONGEST = 100  # bytes of a piece that is remembered
JOINED = 100  # unknown pieces that are encoded as one string
CHUNK_BYTES = 1_000_000  # text whose pieces are told apart at once
FILE_BYTES = 256_000_000  # text of one file, about
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "5000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


# Two bytes that begin a white space beyond ASCII; others begin with them too, so such texts are looked at again.
WIDE_SPACES = [(0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)]
_SPACES = frozenset([*range(9, 14), *range(28, 33)])
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(_SPACES)] = True
# Kinds of bytes. Bytes beyond ASCII may be of any kind, but for Latin letters with an accent.
_ANY, _BLANK, _LINE, _LETTER, _DIGIT, _MARK, _QUOTE = range(7)
_KIND = np.full(256, _ANY, dtype=np.uint8)
_KIND[33:127] = _MARK
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[9, 10, 13]] = _LINE
_KIND[[32, 39]] = _BLANK, _QUOTE
# Whether a piece begins between a byte of one kind and one of the next, where no white space stands beside other white
# space. What a quote begins depends on the letters behind it, so nothing is parted there.
_BLANKS = np.zeros((8, 8), dtype=bool)
_BLANKS[:, _BLANK] = True
_RUNS = _BLANKS.copy()
_RUNS[_LINE, [_LETTER, _DIGIT, _MARK, _QUOTE]] = True
_RUNS[_LETTER, [_LINE, _DIGIT, _MARK, _QUOTE]] = True
_RUNS[_DIGIT, [_LINE, _LETTER, _MARK, _QUOTE]] = True
_RUNS[_MARK, [_LINE, _LETTER, _DIGIT]] = True


def _white(piece: bytes, at: int) -> bool:
    """Whether a piece's first (0) or last (-1) character is white space."""
    return piece[at] in _SPACES or (piece[at] >= 128 and piece.decode("utf-8", "replace")[at].isspace())


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each run of `sizes` places."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _longer(kept: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """`kept` with `more` behind its first `used` places; it doubles when it is full."""
    if used + len(more) > len(kept):
        kept, old = np.empty(max(2 * len(kept), used + len(more)), dtype=kept.dtype), kept
        kept[:used] = old[:used]
    kept[used : used + len(more)] = more
    return kept


class _Words:
    """Words and their ids in flat arrays, found by the words' hashes in a table with open places."""

    def __init__(self, id_type: np.dtype = np.uint32) -> None:
        self.n = 0
        self.table = np.full(1 << 12, -1, dtype=np.int32)
        self.hashes = np.zeros(1 << 10, dtype=np.uint64)
        self.word_at, self.id_at = np.zeros(1 << 10, dtype=np.int32), np.zeros(1 << 10, dtype=np.int32)
        self.letters, self.ids = np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=id_type)
        self.met = np.zeros(1 << 10, dtype=bool)

    def __len__(self) -> int:
        return self.n

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, -1 where there is none."""
        at = self._first(hashes)
        slots = self.table[at]
        other = np.flatnonzero((slots >= 0) & (self.hashes[slots] != hashes))
        while len(other):
            at[other] = (at[other] + 1) & (len(self.table) - 1)
            slots[other] = self.table[at[other]]
            other = other[(slots[other] >= 0) & (self.hashes[slots[other]] != hashes[other])]
        return slots

    def _enter(self, first: int) -> None:
        """Give the slots from `first` on a place in the table."""
        slots = np.arange(first, self.n, dtype=np.int32)
        at = self._first(self.hashes[first : self.n])
        while len(slots):
            free = self.table[at] < 0
            self.table[at[free]] = slots[free]
            rest = self.table[at] != slots
            slots, at = slots[rest], (at[rest] + 1) & (len(self.table) - 1)

    def add(self, hashes: np.ndarray, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Further words and their hashes, all new; `ids` has `sizes` ids for each of the words."""
        n, word_end, id_end = self.n, int(self.word_at[self.n]), int(self.id_at[self.n])
        self.hashes = _longer(self.hashes, n, hashes)
        self.word_at = _longer(self.word_at, n + 1, word_end + np.cumsum([len(w) for w in words]))
        self.id_at = _longer(self.id_at, n + 1, id_end + np.cumsum(sizes))
        self.letters = _longer(self.letters, word_end, np.frombuffer(b"".join(words), dtype=np.uint8))
        self.ids = _longer(self.ids, id_end, ids)
        self.met = _longer(self.met, n, np.zeros(len(hashes), dtype=bool))
        self.n += len(hashes)
        if 2 * self.n > len(self.table):
            self.table = np.full(1 << (2 * self.n).bit_length(), -1, dtype=np.int32)
            n = 0
        self._enter(n)

    def again(self) -> _Words:
        """Only the words marked in `met`, without their marks."""
        kept = np.flatnonzero(self.met[: self.n])
        begin, end, sizes = self.word_at[kept].tolist(), self.word_at[kept + 1].tolist(), self.id_at[kept + 1] - self.id_at[kept]
        packed, out = self.letters.tobytes(), _Words(self.ids.dtype)
        out.add(self.hashes[kept], [packed[a:b] for a, b in zip(begin, end, strict=True)], self.ids[_spread(self.id_at[kept], sizes)], sizes)
        return out


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct piece encoded once while it is remembered.

    A byte-level vocabulary is applied piece by piece, and where no white space stands next to other white space, a
    single space always begins a piece, as does each change between letters, digits, marks and line ends. So the text's
    ids are those of the parts between such places. Other texts, and those with the string of a special token, go to the
    library whole. Arrow tells a chunk's parts apart; the distinct ones are looked up by hash and compared byte by byte,
    those not yet known are encoded by the library, and the ids are taken by the parts' numbers. Unknown parts are encoded
    many in a string: those that begin with a space one behind the other, the rest with line ends between them; the ids
    of spaces and line ends tell them apart again.
    """

    def __init__(self, vocabulary: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = [s.encode() for s in special]
        self.whole = re.compile("|".join([r"\s\s", *map(re.escape, special)]))
        self.words = _Words(np.uint16 if max(self.library.get_vocab().values(), default=0) < 1 << 16 else np.uint32)
        steps = json.loads(self.library.to_str())
        first = steps["pre_tokenizer"] or {}
        runs = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space") and not steps["normalizer"]
        self.cuts = (_RUNS if runs else _BLANKS).ravel()
        vocabulary = self.library.get_vocab()
        self.blank, self.line = (np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool) for _ in range(2))
        if not any(" " in s for s in special):
            self.blank[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True  # a space, in byte-level vocabularies
        if runs and not any("\n" in s for s in special):
            self.line[[i for t, i in vocabulary.items() if t == "\u010a"]] = True

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and the number of each one's."""
        spaced, plain, alone = [], [], []
        for k, p in enumerate(pieces):
            # White space at a piece's ends would stand beside that between pieces.
            if len(p) > LONGEST or _white(p, -1) or (p[0] != 32 and _white(p, 0)) or any(s in p for s in self.special):
                alone.append(k)
            else:
                (spaced if p[0] == 32 else plain).append(k)
        order, ids, sizes = [], [], []
        for some, before, begins in ((spaced, b"", self.blank), (plain, b"\n", self.line)):
            groups = [some[k : k + JOINED] for k in range(0, len(some), JOINED)] if begins.any() else []
            alone += [] if groups else some
            joined = [before + before.join([pieces[k] for k in g]) for g in groups]
            for group, own in zip(groups, self._apart(joined), strict=True):
                at = np.flatnonzero(begins[own])
                if len(at) != len(group) or at[0] != 0:
                    alone += group
                    continue
                order += group
                size = np.diff(at, append=len(own))
                if before:
                    own, size = np.delete(own, at), size - 1
                ids.append(own)
                sizes.append(size)
        single = self._apart([pieces[k] for k in alone])
        sizes = np.concatenate([*sizes, np.array([len(x) for x in single], dtype=np.int64)])
        ids = np.concatenate([*ids, *single, np.zeros(0, dtype=np.uint32)])
        place = np.argsort(np.array([*order, *alone], dtype=np.int64))  # back into the order of the pieces
        return ids[_spread((np.cumsum(sizes) - sizes)[place], sizes[place])], sizes[place]

    def _apart(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _odd(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows that have to go to the library whole."""
        space = _SPACE[data]
        twice = np.flatnonzero(space[1:] & space[:-1])
        row = np.searchsorted(at, twice, side="right") - 1
        odd = np.zeros(len(at) - 1, dtype=bool)
        odd[row[twice + 1 < at[row + 1]]] = True
        packed, doubtful = data.tobytes(), np.zeros(len(at) - 1, dtype=bool)
        spots = [np.flatnonzero((data[:-1] == a) & (data[1:] == b)) for a, b in WIDE_SPACES] if data.max(initial=0) >= 0xC2 else []
        for s in self.special:
            found = packed.find(s)
            while found >= 0:
                spots.append(np.array([found]))
                # One in a row is enough.
                found = packed.find(s, int(at[np.searchsorted(at, found, side="right")]))
        if spots:
            doubtful[np.searchsorted(at, np.concatenate(spots), side="right") - 1] = True
        for k in np.flatnonzero(doubtful & ~odd):
            odd[k] = self.whole.search(packed[at[k] : at[k + 1]].decode("utf-8", "replace")) is not None
        return odd

    def encode(self, raw: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after another, `end_id` behind each, and each row's first place.

        `at` holds the rows' offsets in the bytes `raw`.
        """
        data, at = raw[int(at[0]) : int(at[-1])], at - at[0]
        places, edges = self._pieces(data, at)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        ids = self._distinct(coded.dictionary, end_id).take(coded.indices)
        return np.asarray(ids.flatten()), np.asarray(ids.offsets)[edges]

    def _pieces(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the pieces, an empty one at the end of each row, and each row's range of pieces."""
        odd = self._odd(data, at)
        kind = _KIND[data]
        lead = np.flatnonzero(data[:-1] == 0xC3) if data.max(initial=0) >= 0xC3 else []
        if len(lead):
            behind = data[lead + 1]
            lead = lead[(behind & 0xC0 == 0x80) & (behind != 0x97) & (behind != 0xB7)]
            kind[lead] = kind[lead + 1] = _LETTER
        begin = np.zeros(len(data), dtype=bool)
        begin[1:] = self.cuts[kind[:-1] * 8 + kind[1:]]
        if odd.any():
            begin[np.repeat(odd, np.diff(at))] = False
        begin[at[:-1][np.diff(at) > 0]] = True
        begins = np.flatnonzero(begin)
        upto = np.searchsorted(begins, at[1:])
        places = np.append(np.insert(begins, upto, at[1:]), len(data))
        return places, np.concatenate(([0], upto + np.arange(1, len(at))))

    def _distinct(self, pieces: pa.Array, end_id: int) -> pa.Array:
        """The ids of each of the distinct pieces; an empty one has `end_id`."""
        _, offsets, letters = pieces.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = np.frombuffer(letters, dtype=np.uint8) if letters else np.zeros(0, dtype=np.uint8)
        packed, first, sizes = data.tobytes(), at[:-1], np.diff(at)
        short = np.flatnonzero((sizes > 0) & (sizes <= LONGEST))
        hashes = text.span_hashes(data, first[short], first[short] + sizes[short] - 1, cased=True)
        if len(self.words) > CACHED or self.words.word_at[len(self.words)] > CACHED * CACHED_LETTERS:
            self.words = self.words.again()
        known = self.words
        slots = known.find(hashes)
        known.met[slots[slots >= 0]] = True
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new, where = np.unique(hashes[missing], return_index=True)
            words = [packed[at[k] : at[k + 1]] for k in short[missing[where]].tolist()]
            known.add(new, words, *self._ids(words))
            slots[missing] = known.find(hashes[missing])
        same = known.word_at[slots + 1] - known.word_at[slots] == sizes[short]
        same[same] = ~self._unlike(data, first[short[same]], known.letters, known.word_at[slots[same]], sizes[short[same]])
        found, slots = short[same], slots[same]
        # Long pieces, and those that have another one's hash.
        other = sizes > 0
        other[found] = False
        ids, n = self._ids([packed[at[k] : at[k + 1]] for k in np.flatnonzero(other).tolist()])
        units = np.ones(len(pieces), dtype=np.int64)
        units[found], units[other] = known.id_at[slots + 1] - known.id_at[slots], n
        upto = np.concatenate(([0], np.cumsum(units)))
        flat = np.full(int(upto[-1]), end_id, dtype=np.uint32)
        flat[_spread(upto[found], units[found])] = known.ids[_spread(known.id_at[slots], units[found])]
        flat[_spread(upto[:-1][other], n)] = ids
        return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat))

    @staticmethod
    def _unlike(data: np.ndarray, first: np.ndarray, letters: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether runs of equal sizes hold other bytes."""
        out = np.zeros(len(sizes), dtype=bool)
        differ = data[_spread(first, sizes)] != letters[_spread(place, sizes)]
        if differ.any():
            out[np.repeat(np.arange(len(sizes)), sizes)[differ]] = True
        return out


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    """The worker's own encoder, which goes on from task to task."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def _writer(vocabulary: str, end_id: int) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, position = _encoder(vocabulary), 0
        for batch in batches:
            raw, at = text.buffers(batch.column("text"))
            for a, b in text.chunks(at, CHUNK_BYTES):
                flat, edges = encoder.encode(raw, at[a : b + 1], end_id)
                place = pa.array(np.arange(position, position + b - a), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), place, lists], names=["doc_id", "position", "ids"])
                position += b - a

    return encode


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID, files: int | None = None) -> None:
    """Encode whole texts, end each document with `end_id`, and write (doc_id, position, ids) as ORC in ascending id order.

    Each file holds a range of ids, in order; `position` counts a file's documents. Stripes can be read in parallel;
    row indexes and the Bloom filter let readers skip stripes by doc_id. Null texts are empty, null ids come first,
    repeated ids stand together, an empty table gives files without rows. `files` is the number of ranges, by default
    one for each shuffle partition and each FILE_BYTES of text; ranges are cut by id and a hash of the text, so rows
    without an id and many texts of one id are spread as well.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if files is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    encoded = rows.mapInArrow(_writer(vocabulary, end_id), "doc_id long, position long, ids array<int>")
    encoded.write.options(**ORC_OPTIONS).orc(path)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        at = np.asarray(lists.offsets)
        values = np.asarray(lists.values)
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("file"), batch.column("position"), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["doc_id", "file", "position", "n_tokens", "ids_crc32"],
        )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, position, ids) of the files, in any order; filters on doc_id skip stripes."""
    return spark.read.schema("doc_id long, position long, ids array<int>").orc(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids of all before it.

    Starts are sums over the files, a row each, and then over a file's own documents.
    """
    rows = read(spark, path).withColumn("file", F.col("_metadata.file_name"))
    rows = cut(rows.mapInArrow(_sum_up, "doc_id long, file string, position long, n_tokens long, ids_crc32 long"), "index")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("position").rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("base") + F.coalesce("inside", F.lit(0))
    return rows.withColumn("inside", inside).join(files, "file").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write the files into the shared folder and return what `index` reads back from them."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "tokens")
    write(docs, path, id_col, text_col, vocabulary, end_id)
    return index(spark, path).withColumnRenamed("doc_id", id_col)
