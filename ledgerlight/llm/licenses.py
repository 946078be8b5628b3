"""License notices with small errors: exact seeds by the pigeonhole principle, then bounded-error matching of what they find."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.llm import text

# The phrases whose exact places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Openings of well-known notices, as words, and labels of our own for them.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd 3 clause license": "bsd",
    "bsd 2 clause license": "bsd",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this program is free software you can redistribute it and or modify": "gpl",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc0 1 0 universal": "cc0",
    "boost software license": "bsl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
ERRORS_PER_LETTER = 0.1
SPANS = "array<struct<label: string, notice: string, start: long, end: long, first_word: long, last_word: long, edits: int, base: boolean>>"
_SPAN = pa.struct(
    [
        ("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
        ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("base", pa.bool_()),
    ]
)


@dataclass(frozen=True)
class Notice:
    """Words to look for, at most `errors` insertions, deletions and substitutions away."""

    words: str
    label: str
    errors: int
    base: bool

    def seeds(self) -> list[tuple[int, str]]:
        """errors + 1 pieces with their places: whoever has at most that many errors leaves one piece whole."""
        cuts = [len(self.words) * i // (self.errors + 1) for i in range(self.errors + 2)]
        return [(a, self.words[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def notices(phrases: dict[str, str] = PHRASES, own: dict[str, str] = NOTICES, rate: float = ERRORS_PER_LETTER) -> list[Notice]:
    """Base phrases and own notices; each may have one error in 1 / rate letters."""
    both = [(w, label, True) for w, label in phrases.items()] + [(w, label, False) for w, label in own.items()]
    return [Notice(w, label, int(len(w) * rate), base) for w, label, base in both]


class _Finder:
    """The seeds of all notices in one automaton, and a pattern for each notice."""

    def __init__(self, wanted: list[Notice]):
        import ahocorasick
        import regex

        self.wanted = wanted
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(wanted):
            for offset, seed in notice.seeds():
                owners.setdefault(seed.encode().decode("latin-1"), []).append((k, offset))
        for seed, places in owners.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()
        # Whole words only: a match begins and ends beside a space or at a row's end.
        plain = [regex.escape(n.words, special_only=True) for n in wanted]
        self.patterns = [regex.compile(rf"(?e)(?<![^ ])(?:{p}){{e<={n.errors}}}(?![^ ])") for p, n in zip(plain, wanted, strict=True)]
        # The pattern stops at a match within the bound, which need not be the least number of edits for its letters.
        self.within = [[regex.compile(f"(?:{p}){{e<={e}}}") for e in range(n.errors + 1)] for p, n in zip(plain, wanted, strict=True)]

    def candidates(self, norm: str) -> Iterator[tuple[int, np.ndarray]]:
        """(notice, starts): where its seeds put its beginning, in bytes; starts near one another come together."""
        spots: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(norm):
            for k, offset in places:
                spots.setdefault(k, []).append(end + 1 - size - offset)
        for k, starts in spots.items():
            at = np.unique(starts)
            apart = np.flatnonzero(np.diff(at) > 2 * _margin(self.wanted[k]) + len(self.wanted[k].words)) + 1
            for run in np.split(at, apart):
                yield k, run

    def matches(self, norm: bytes, k: int, starts: np.ndarray) -> set[tuple[int, int, int]]:
        """(from, to, edits) in bytes: all exact places, and beside them the leftmost near ones that overlap nothing."""
        notice = self.wanted[k]
        words = notice.words.encode()
        size = len(words)
        exact = [int(p) for p in starts if p >= 0 and norm.startswith(words, p) and _outside(norm, p - 1) and _outside(norm, p + size)]
        found = {(p, p + size, 0) for p in exact}
        if notice.errors == 0 or len(exact) == len(starts):
            return found
        a, b = max(0, int(starts[0]) - _margin(notice)), min(len(norm), int(starts[-1]) + size + _margin(notice))
        # On to whole words, so that a cut never looks like a word's end; a letter is never cut either.
        a = max(norm.rfind(b" ", 0, a), norm.rfind(b"\n", 0, a)) + 1
        b = min((x for x in (norm.find(b" ", b), norm.find(b"\n", b)) if x >= 0), default=len(norm))
        for line in norm[a:b].split(b"\n"):
            letters = line.decode()
            for hit in self.patterns[k].finditer(letters):
                x, y = (a + len(letters[:z].encode()) for z in hit.span())
                edits = next(e for e, p in enumerate(self.within[k]) if p.fullmatch(hit.group()))
                if edits and all(q <= x or p >= y for p, q, _ in found):
                    found.add((x, y, edits))
            a += len(line) + 1
        return found


def _margin(notice: Notice) -> int:
    """Bytes that errors may move a match by: a letter has up to four."""
    return 4 * notice.errors + 4


def _outside(norm: bytes, at: int) -> bool:
    return not 0 <= at < len(norm) or norm[at] in b" \n"


_finders: dict[tuple[Notice, ...], _Finder] = {}


def normalised(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as lower-cased words with one space between them, a line feed after each row.

    Also the place in the rows' bytes that each byte comes from, and each row's first byte.
    """
    data, first, last, ranges = text.word_spans(raw, at, text.NO_WORD)
    rows = len(at) - 1
    # A word's bytes and one more for what follows it; a row without words keeps a byte for its line feed.
    sizes = last - first + 2
    counts = np.diff(ranges)
    ends = np.cumsum(sizes)
    before = np.cumsum(counts == 0)
    row = np.repeat(np.arange(rows), counts)
    begin = ends - sizes + before[row] if len(sizes) else ends
    norm = np.full(int(sizes.sum()) + int(before[-1] if rows else 0), 10, dtype=np.uint8)
    source = np.zeros(len(norm), dtype=np.int64)
    if len(sizes):
        step = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
        to = np.repeat(begin, sizes) + step
        take = np.minimum(np.repeat(first, sizes) + step, len(data) - 1)
        norm[to] = text.LOWER[data[take]]
        source[to] = np.repeat(first, sizes) + step
        norm[begin + sizes - 1] = 32
        norm[(begin + sizes - 1)[ranges[1:][counts > 0] - 1]] = 10
    upto = np.concatenate(([0], ends))
    of_rows = np.where(counts > 0, upto[ranges[1:]] - upto[ranges[:-1]], 1)
    return norm, source, np.concatenate(([0], np.cumsum(of_rows)))


def _scanner(wanted: list[Notice]) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finders.setdefault(tuple(wanted), _Finder(wanted))
        for batch in batches:
            raw, at = text.buffers(batch.column("t"))
            for a, b in text.chunks(at):
                norm, source, edges = normalised(raw, at[a : b + 1])
                spaces = np.flatnonzero(norm == 32)
                lines = np.flatnonzero(norm == 10)
                counts = np.searchsorted(spaces, edges[1:]) - np.searchsorted(spaces, edges[:-1])
                counts += np.diff(edges) > 1
                found: list[list[dict]] = [[] for _ in range(b - a)]
                packed = norm.tobytes()
                hits = {(k, *hit) for k, starts in finder.candidates(packed.decode("latin-1")) for hit in finder.matches(packed, k, starts)}
                if hits:
                    data = raw[int(at[a]) : int(at[b])]
                    letters = np.cumsum((data & 0xC0) != 0x80)
                    for k, x, y, edits in hits:
                        row = int(np.searchsorted(lines, x))
                        zero = int(at[a + row] - at[a])
                        base = int(letters[zero - 1]) if zero else 0
                        word = int(np.searchsorted(spaces, x) - np.searchsorted(spaces, edges[row]))
                        notice = finder.wanted[k]
                        found[row].append(
                            {
                                "label": notice.label, "notice": notice.words,
                                "start": int(letters[source[x]]) - 1 - base, "end": int(letters[source[y - 1]]) - base,
                                "first_word": word, "last_word": word + packed.count(b" ", x, y),
                                "edits": edits, "base": notice.base and edits == 0,
                            }
                        )
                for spans in found:
                    spans.sort(key=lambda s: (s["start"], s["end"], s["notice"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.array(counts.astype(np.int64)), pa.array(found, pa.list_(_SPAN))],
                    names=["id", "n_words", "spans"],
                )

    return scan


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", wanted: list[Notice] | None = None) -> DataFrame:
    """One row per input row: id, n_words, spans of notices (label, notice, start, end, first_word, last_word, edits, base).

    Words are runs of ASCII digits, letters and anything beyond ASCII, A-Z lower-cased, compared with one space between
    them. A notice is found where whole words of the text are at most `errors` letters inserted, deleted or replaced away
    from it: cut into errors + 1 pieces, one of them stands there unchanged, so an automaton of all pieces finds every
    candidate and the regex library checks a stretch around it. All
    exact places count; near ones of a notice are leftmost and overlap neither these nor one another.
    Spans with base are exact places of a base phrase. start and end count code points of the text, words count from 0.

    Texts are read once and nothing is shuffled. Null and empty texts have no words and no spans; repeated rows and ids
    are answered row by row, null ids stay null, an empty table gives no rows, further columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    found = rows.mapInArrow(_scanner(notices() if wanted is None else wanted), f"id long, n_words long, spans {SPANS}")
    return found.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: counts and ends of the base places, labels, and the likeness of the best match (1: no error)."""

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"])
    near = F.transform("spans", lambda s: 1 - s["edits"] / F.length(s["notice"]))
    return found.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(near), F.lit(0.0)).alias("score"),
    )
