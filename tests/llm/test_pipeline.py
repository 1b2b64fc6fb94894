"""The pipeline's stages, each on its own input."""

import duckdb
import pytest

import corpus_pipeline
from tests.llm.conftest import frame

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before and after each stage, with an odd row of each kind in front."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None), (None, "no id"), (10**6, None), (10**6 + 1, ""), (10**6 + 2, "A text said twice."), (10**6 + 2, "A text said twice."), (10**6 + 3, "A  text said\ntwice.")],
        "doc_id long, text string",
    )
    at = odd.unionByName(docs, allowMissingColumns=True).selectExpr("*", "1 AS gone", "true AS kept", "0.5D AS score", "2 AS row")
    found = {"start": at.coalesce(1)}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, found[list(found)[-1]], DATA).write.parquet(path)
        found[name] = spark.read.parquet(path)
    return found


def test_columns_stay(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages["start"].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "clean", "encode"]


def ids(frame):
    return [r.doc_id for r in frame.select("doc_id").collect()]


def test_quality_rejects_labelled_junk(stages):
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/labels.parquet'").fetchall())
    left = set(ids(stages["quality"]))
    right = [(i in left) == bool(q) for i, q in quality.items()]
    assert sum(right) / len(right) > 0.95


def test_exact_keeps_one_of_each_text(stages):
    import re

    own = lambda r: re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
    before = {}
    for r in stages["quality"].collect():
        before.setdefault(own(r), []).append(r.doc_id)
    after = {}
    for r in stages["exact"].collect():
        after.setdefault(own(r), []).append(r.doc_id)
    assert set(after) == set(before) and all(len(x) == 1 for x in after.values())
    assert all(after[t][0] == min((i for i in x if i is not None), default=None) for t, x in before.items())


def test_near_leaves_one_of_each_group_and_the_rest(stages):
    from tessera.llm.simhash import similar_groups

    groups = {r.doc_id: r.component_id for r in similar_groups(stages["exact"]).collect()}
    assert sorted(ids(stages["near"]), key=str) == sorted((i for i in ids(stages["exact"]) if groups[i] == i or i is None), key=str)


def test_near_groups_are_those_of_all_pairs_of_a_given_table(spark):
    from tessera.llm.queries import ORACLES
    from tessera.llm.simhash import similar_groups

    folder = DATA.replace("0.001", "0.01")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = dict(con.execute(ORACLES["op12_minhash"].replace(">= 85 *", ">= 80 *")).df()[["doc_id", "component_id"]].itertuples(index=False))
    got = {r.doc_id: r.component_id for r in similar_groups(spark.read.parquet(f"{folder}/documents.parquet").filter("trim(text) <> ''")).collect()}
    assert len(set(got.values())) < len(got) and got == {i: want[i] for i in got}


def test_clean_drops_leaks_alone(stages):
    from tessera.llm.decontaminate import leaks

    spark = stages["near"].sparkSession
    gone = {r.doc_id for r in leaks(stages["near"], spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}
    assert set(ids(stages["near"])) - set(ids(stages["clean"])) == gone


def test_encode_has_all_that_is_left(stages):
    assert sorted(ids(stages["encode"]), key=str) == sorted(ids(stages["clean"]), key=str)
    assert all(r.n_unlike == 0 for r in stages["encode"].collect())


def test_nothing_in_nothing_out(spark):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, DATA)
        assert found.count() == 0, name


def test_run(spark):
    found = corpus_pipeline.run(spark, DATA)
    assert found.count() > 100 and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(found.columns)
