import zlib

import numpy as np
import pytest

import pyarrow as pa

from ledgerlight.llm import text, token_files


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))


def brute(library, rows):
    start, out = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


TEXTS = [
    "plain words, and some. More\nlines here",
    "two  spaces and   three",
    "tab\tand \n odd",
    " leading and trailing ",
    "<|endoftext|> inside <|endoftext|>",
    "é ñ ü 漢字 😀 emoji",
    "it's they'll don't 123 4567",
    "",
    None,
    "   ",
    "no break   space",
    "one",
    "the same words the same words the same words",
    "a" * 5000,
    "\r\n\r\n",
]


def encoded(encoder, texts):
    raw, at = text.buffers(pa.array(texts, pa.string()))
    flat, edges = encoder.encode(raw, at, 0)
    return [flat[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def whole(library, texts):
    return [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_words_by_themselves_give_the_ids_of_the_text(library):
    encoder = token_files.Encoder(token_files.VOCABULARY)
    assert encoded(encoder, TEXTS * 2) == whole(library, TEXTS * 2)
    assert encoded(encoder, TEXTS[::-1]) == whole(library, TEXTS[::-1])
    assert encoded(encoder, []) == [] and encoded(encoder, [None, ""]) == [[0], [0]]


def test_random_texts(library):
    import random

    rng = random.Random(3)
    parts = ["word", "Word", "é", "ñu", ".", ",", " ", " ", " ", "\n", "\t", "\u00a0", "\u2009", "\u2019s", "\u3000", "\x1c", "12", "it's", "<|endoftext|>", "😀", "a.b", "x,"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(3000)]
    encoder = token_files.Encoder(token_files.VOCABULARY)
    assert encoded(encoder, texts) == whole(library, texts)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED", 5)
    encoder = token_files.Encoder(token_files.VOCABULARY)
    for k in range(0, 3 * len(TEXTS), 4):
        part = (TEXTS * 3)[k : k + 4]
        assert encoded(encoder, part) == whole(library, part)


def test_words_with_equal_hashes_keep_their_own_ids(library, monkeypatch):
    monkeypatch.setattr(text, "span_hashes", lambda data, first, last, cased=False: (last - first).astype(np.uint64) + np.uint64(1))
    encoder = token_files.Encoder(token_files.VOCABULARY)
    texts = ["one two six ten cat dog", "a bb cc dd the dog", "x one cat the"]
    assert encoded(encoder, texts) == whole(library, texts) and encoded(encoder, texts[::-1]) == whole(library, texts[::-1])


def test_runs_are_learnt_apart(library):
    """Marks and line ends between words do not make new words of them."""
    some = [a + b for a in "abcdefg" for b in ("row", "and", "ing", "é")]
    texts = [f"{a}.\n{b} {b},{a} {a}***" for a in some for b in some]
    encoder = token_files.Encoder(token_files.VOCABULARY)
    assert encoded(encoder, texts) == whole(library, texts)
    assert len(encoder.words) <= 2 * len(some) + 10


def test_kinds_of_bytes(library):
    """Every pair of characters up to U+00FF, and quotes, digits and letters of other scripts beside each other."""
    import random

    chars = [chr(c) for c in range(256)]
    encoder = token_files.Encoder(token_files.VOCABULARY)
    pairs = [f"x{a}{b}y" for a in chars for b in chars]
    assert encoded(encoder, pairs) == whole(library, pairs)
    rng = random.Random(7)
    parts = [*"aZ1'.-  \n\r\té×÷ªµ²½Ā漢ж\u0301\u200b\u0085", "'s", "'ll", "'t", "слово", "\u3000", "<|endoftext|>", "<|"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(5000)]
    assert encoded(encoder, texts) == whole(library, texts)


def test_another_vocabulary():
    """One that is not byte-level is only cut at single spaces."""
    encoder = token_files.Encoder("word_bpe_49k.json")
    texts = [t for t in TEXTS if t and "endoftext" not in t]
    assert encoded(encoder, texts) == whole(encoder.library, texts)


def test_words_met_again_are_kept(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED", 50)
    encoder, learnt = token_files.Encoder(token_files.VOCABULARY), []
    encode = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda pieces: [learnt.extend(pieces), encode(pieces)][1])
    for k in range(20):
        texts = ["the same words " + " ".join(f"{'abcdefghij'[j]}{'klmnopqrstuvwxyzabcd'[k]}x" for j in range(10))]
        assert encoded(encoder, texts) == whole(library, texts)
    assert learnt.count(b" same") == 1 and learnt.count(b" akx") == 1
    assert len(encoder.words) <= 50 + 20


def test_many_words_find_their_places(library):
    """The table grows several times, hashes with equal low bits among them."""
    words = token_files._Words()
    low = np.arange(1, 20_001, dtype=np.uint64)
    for hashes in (low, low << np.uint64(40)):
        words.add(hashes, [b"%d" % h for h in hashes], hashes.astype(np.uint32), np.ones(len(hashes), dtype=np.int64))
    slots = words.find(np.concatenate((low << np.uint64(40), low[::-1])))
    assert slots.tolist() == [*range(20_000, 40_000), *range(19_999, -1, -1)]
    assert (words.find(low + np.uint64(1 << 20)) == -1).all()
    at = slots[:9]
    assert [words.letters[words.word_at[k] : words.word_at[k + 1]].tobytes() for k in at] == [b"%d" % (h << 40) for h in range(1, 10)]


def test_memory_of_a_batch():
    """A worker's arrays are small beside the batches that Spark hands over, however many rows these have."""
    import random
    import tracemalloc

    rng = random.Random(5)
    some = ["".join(rng.choices("abcdefghijkl", k=rng.randrange(2, 9))) for _ in range(20_000)]
    texts = [" ".join(rng.choices(some, k=400)) for _ in range(2_500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    encode = token_files._writer(token_files.VOCABULARY, 0)
    assert sum(len(b) for b in encode(iter([batch.slice(0, 100)]))) == 100
    tracemalloc.start()
    try:
        rows = sum(len(b) for b in encode(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < 4 * batch.nbytes


@pytest.mark.parametrize("files", [1, 5])
def test_round_trip(spark, library, tmp_path, files):
    rows = [(i * 5 - 30, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(10_000, "long " * 40_000), (7_777, "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = str(tmp_path / "tokens")
    token_files.write(docs, path, files=files)
    found = sorted(tuple(r) for r in token_files.index(spark, path).collect())
    assert found == brute(library, rows)
    (one,) = token_files.read(spark, path).where("doc_id = 7777").collect()
    assert one["ids"] == [*library.encode("end", add_special_tokens=False).ids, 0]


def test_files_have_ranges_and_indexes(spark, tmp_path):
    import glob

    import pyarrow.orc as orc

    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(400)], "doc_id long, text string")
    path = str(tmp_path / "tokens")
    token_files.write(docs, path, files=4)
    last = -1
    for name in sorted(glob.glob(f"{path}/part-*")):
        table = orc.ORCFile(name).read()
        ids = table.column("doc_id").to_pylist()
        assert ids == sorted(ids) and ids[0] > last
        last = ids[-1]
        with open(name, "rb") as f:
            assert f.read(3) == b"ORC"
    assert last == 399


def test_defined_cases(spark, library):
    rows = [(3, "b"), (3, "b"), (None, "null id"), (1, None), (2, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS position", "'f' AS ids", "2 AS file")
    found = sorted((tuple(r) for r in token_files.tokenised(docs).collect()), key=str)
    assert found == sorted(brute(library, rows), key=str)
    assert token_files.tokenised(docs.limit(0)).count() == 0
