import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snapflow.llm import decontam, secrets, simhash, toxicity
from snapflow.llm.common import fold
from snapflow.session import settled

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, run in corpus_pipeline.STAGES:
        out[name] = (docs, docs := settled(run(spark, docs, SF)))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_order_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "bpe"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(stages[n][1].columns == columns for n in list(stages)[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = stages["toxicity"]
    gone = ids(before) - ids(after)
    bad = "worthless|pathetic|idiot|disgusting|stupid|moron|scum"
    named = ids(before.filter(F.lower("text").rlike(bad)))
    assert len(named & gone) >= 0.9 * len(named)
    model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet").filter(fold("doc_id", 4) != 2))
    assert gone == ids(toxicity.score(before, model).filter("predicted = 1"))


def test_one_document_of_each_component(stages):
    before, after = stages["simhash"]
    rows = simhash.classes(before).collect()
    assert ids(after) == {r["component_id"] for r in rows} and after.count() == len(ids(after))


def test_leaks_go(spark, stages):
    before, after = stages["decontamination"]
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in before.collect() if any(i in words(r["text"]) for i in items)}
    assert leaked and ids(before) - ids(after) == leaked
    assert decontam.find(after, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0


def test_secrets_are_replaced_and_every_document_stays(stages):
    before, after = stages["secrets"]
    assert ids(before) == ids(after) and before.count() == after.count()
    old, new = ({r["doc_id"]: r for r in df.collect()} for df in stages["secrets"])
    changed = [d for d in old if old[d]["text"] != new[d]["text"]]
    assert changed and all("[SECRET]" in new[d]["text"] and not re.search("[0-9a-f]{24,}", new[d]["text"]) for d in changed)
    assert all(new[d]["n_chars"] == len(new[d]["text"]) for d in changed)
    assert all(not re.search(secrets.HEX, new[d]["text"]) for d in new)


def test_tokens_of_the_whole_run(spark, stages):
    _, tokens = stages["bpe"]
    assert tokens.count() == stages["secrets"][1].count()
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, tokens.collect()))


def test_odd_rows_pass_every_stage(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, secrets string, page string"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, "x", "y"), (1, "", "en", "s", 0, "x", "y"), (2, "token = 0123456789abcdef0123456789", None, None, 34, None, None),
            (3, "plain words here", "en", "s", 16, None, None)]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0 if name == "benchmark" else 50).write.parquet(f"{tmp_path}/{name}.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, run in corpus_pipeline.STAGES[:-1]:
            docs = settled(run(spark, docs, str(tmp_path)))
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        if data:
            texts = {r["text"] for r in docs.collect()}
            assert "[SECRET]" in texts and "plain words here" in texts
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
