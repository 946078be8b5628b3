"""Each stage of the pipeline on its predecessor's rows, against brute force."""

import pytest

import corpus_pipeline as pipeline
from conftest import SMALL
from ledgerlight.llm import language, mixing
from test_decontaminate import brute as contaminated
from test_minhash import brute as groups


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        made = stage(spark, docs, SMALL)
        path = str(tmp_path_factory.mktemp("stages") / name)
        made.write.parquet(path)
        made = spark.read.parquet(path)
        out.append((docs.collect(), made.collect(), docs.columns, made.columns))
        docs = made
    return dict(zip([name for name, _ in pipeline.STAGES], out, strict=True))


def test_columns_stay(stages):
    for name, (_, _, before, after) in list(stages.items())[:-1]:
        assert before == after, name


def test_language_keeps_clean_documents(stages):
    before, after, _, _ = stages["language_id"]
    gone = set(ids(before)) - set(ids(after))
    assert len(gone) <= 0.01 * len(before)


def test_one_of_each_group_stays(stages):
    before, after, _, _ = stages["near_dedup"]
    assert ids(after) == sorted(d for d, _, _, kept in groups([(r["doc_id"], r["text"]) for r in before], 5, 80) if kept)


def test_contaminated_go(spark, stages):
    before, after, _, _ = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    found = contaminated([(r["doc_id"], r["text"]) for r in before], items)
    assert ids(after) == sorted(r[0] for r in found if not r[5]) and len(after) < len(before)


def test_mix_takes_what_the_operator_says(spark, stages):
    before, after, columns, _ = stages["source_mix"]
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    found = mixing.mixed(spark.createDataFrame(before, schema)).collect()
    assert ids(after) == sorted(r["doc_id"] for r in found for _ in range(r["taken"] // r["size"]))
    assert sum(len(r["text"].split()) for r in after) == pytest.approx(sum(r["size"] for r in found), rel=0.2)


def test_tokens_of_all_documents(stages):
    import public_tokenizers
    from test_token_files import brute as tokens
    from tokenizers import Tokenizer

    before, after, _, _ = stages["token_files"]
    want = tokens(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), [(r["doc_id"], r["text"]) for r in before])
    assert sorted(tuple(r) for r in after) == sorted(want)


def test_null_and_repeated_rows_pass_through(spark):
    rows = [(1, "the same text of some words in a row", "en", "s", 5)] * 2 + [(None, "another text without an id at all", "en", None, 3), (2, None, None, "s", 0), (3, "", "de", "s", 0)]
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    docs = spark.createDataFrame(rows, schema)
    kept = pipeline.deduplicate(spark, docs, SMALL)
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["1", "1", "2", "3", "None"]
    assert pipeline.remove_benchmarks(spark, docs, SMALL).count() == 5
    model = language.fit(docs)
    assert {r["doc_id"] for r in language.accepted(docs, model).collect()} <= {1, None}
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
