import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gaugeflow.llm import packing
from gaugeflow.llm.oracles import ORACLES
from gaugeflow.llm.queries import QUERIES
from gaugeflow.llm.secrets import base_spans, confirmed_spans, masked
from tests.compare import connect, differences
from tests.llm import brute
from tests.llm.conftest import as_sorted, pairs


def test_everything_is_registered():
    found = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, medium, name):
    assert differences(QUERIES[name](spark, medium), connect(medium), ORACLES[name]) == ""


def brute_stages(rows, items):
    """Ids that stay and their texts; languages all stay where every text has letters."""
    rows = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    rows = [r for r, (_, name, kept) in zip(rows, brute.near_components(rows, 80)) if kept]
    dirty = {d for d, _ in brute.leaks(rows, items)}
    rows = [(i, t) for i, t in rows if i not in dirty]
    return [(i, masked(t, base_spans(t) + confirmed_spans(t))) for i, t in rows]


def test_run_equals_brute_force(spark, small, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    expected = brute_stages(pairs(docs), items)
    df = spark.createDataFrame(expected, "doc_id long, text string")
    model = public_tokenizers.path("byte_bpe_50k.json")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    out = corpus_pipeline.run(spark, small)
    assert out.columns == [*columns, "sequence_id", "offset"]
    whole = packing.pack_documents(df, model, 2)
    assert as_sorted(out.select(columns).collect()) == as_sorted(whole.select(columns).collect())
    assert out.select("sequence_id").distinct().count() == whole.select("sequence_id").distinct().count()


def test_stages_on_hard_rows(spark, small, hard, empty):
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, hard, small)
        assert out.columns == hard.columns and 0 < out.count() <= hard.count()
        none = stage(spark, empty, small)
        assert none.columns == hard.columns and none.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, small).count() == 0


def test_near_stage_drops_copies_from_four_fifths_on(spark, small):
    words = [f"w{k}" for k in range(100)]
    changed = [f"z{k}" if k in (30, 60) else w for k, w in enumerate(words)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.one_per_group(spark, df, small).collect()] == [1]
