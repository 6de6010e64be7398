"""The registered text queries and the pipeline on the smallest data."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import differences, open_duckdb  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from tillhouse.llm import language  # noqa: E402
from tillhouse.llm.common import stored, table  # noqa: E402
from tillhouse.llm.queries import ORACLE_SQL, REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(REGISTRY) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_equals_sql(spark, name):
    assert not differences(REGISTRY[name](spark, SF), open_duckdb(SF), ORACLE_SQL[name])


def test_language_of_held_out_documents(spark):
    rows = REGISTRY["op1_language_id"](spark, SF).join(table(spark, SF, "documents"), "doc_id").filter("held_out").collect()
    assert sum(row.lang_pred == row.lang for row in rows) >= 0.98 * len(rows)


@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_languages_that_were_not_learned_are_rejected(spark, left_out):
    documents = table(spark, SF.replace("0.001", "0.01"), "documents").select("doc_id", "text", "lang").repartition(4)
    model = language.train(documents.filter(documents.lang != left_out))
    rows = language.identify(documents, model).join(documents, "doc_id").collect()
    other = [row.rejected for row in rows if row.lang == left_out]
    known = [row.rejected for row in rows if row.lang != left_out]
    assert sum(other) >= 0.9 * len(other) and sum(known) <= 0.02 * len(known)
    kept = {row.doc_id for row in language.keep_known(documents, model).collect()}
    assert kept == {row.doc_id for row in rows if not row.rejected}


def test_stages(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, SF), name)
        assert docs.columns == before.columns
        assert 0 < docs.count() <= before.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_stages_of_nothing(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0
