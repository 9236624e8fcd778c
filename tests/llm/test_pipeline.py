"""The pipeline over small tables, stage by stage and whole."""

import random

import pytest

import corpus_pipeline
from tidewatch.llm import byte_bpe
from tidewatch.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    draw = random.Random(21)
    prose = "the people of this town have worked with their friends for many years and every day they find new things to read and write about".split()
    text = lambda n: " ".join(draw.choice(prose) + draw.choice(["", "", str(draw.randint(0, 9))]) for _ in range(n))
    out = [(i, text(draw.randint(40, 90)), "en", f"s{i % 4}", 1) for i in range(160)]
    out += [(200 + i, out[i][1] + (" end" if i % 2 else ""), "en", "s1", 1) for i in range(30)]  # copies and near copies
    out += [(300 + i, text(30) + " foulword badword " + text(30), "en", "s2", 1) for i in range(40)]
    out += [(400, None, None, None, None), (401, "", "en", "s1", 0), (402, "short", "en", "s1", 1), (403, "junk junk " * 40, "en", "s1", 1), (None, text(50), "en", None, 1)]
    return [*out, out[0]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(300 <= i < 340)) for i in [*range(160), *range(300, 340)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns
        seen[name] = [r.doc_id for r in result.collect()]
        docs = spark.createDataFrame(result.collect(), result.schema)
    clean = set(range(160))
    assert not set(range(300, 340)) & set(seen["toxicity"]) and clean <= set(seen["toxicity"])
    assert clean <= set(seen["quality"]) and not {400, 401, 402, 403} & set(seen["quality"])
    assert clean == set(seen["near duplicates"]) - {None} and len(seen["near duplicates"]) == 161
    assert len(seen["mixing"]) == len(seen["tokens"]) and set(seen["mixing"]) <= {*clean, None}


def test_run_round_trips(spark, folder):
    result = corpus_pipeline.run(spark, folder)
    texts = {r[0]: r[1] for r in rows()}
    table = byte_bpe.byte_table(byte_bpe.read_file(byte_bpe.vocabulary_path(byte_bpe.MULTI)))
    found = result.collect()
    assert found and all(r.same for r in found)
    for r in found:
        assert byte_bpe.decode_ids(byte_bpe.np.array(r.ids), table).tobytes().decode() == texts[r.doc_id]


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert ORACLES.keys() <= QUERIES.keys()
