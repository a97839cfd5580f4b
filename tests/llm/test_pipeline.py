"""The pipeline keeps its contract at each stage."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from chatlog.llm import toxicity
from chatlog.session import settled
from fixtures import docs, prose

SF = "/root/testdata/sf0.001"


def test_stages_on_given_tables(spark):
    start = spark.read.parquet(f"{SF}/documents.parquet")
    rows = start
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = settled(stage(spark, rows, SF))
        assert new.columns == start.columns, name
        assert new.count() <= rows.count()
        rows = new
    last = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
    assert sorted(r["doc_id"] for r in last.collect()) == sorted(r["doc_id"] for r in rows.collect())
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, last.collect()))


def test_decisions_take_effect(spark, tmp_path):
    rng = random.Random(8)
    clean = [prose(rng, 80, 2000) for _ in range(30)]
    line = "a line that is shared by many documents of the corpus"
    passage = prose(rng, 25, 5000)
    rows = [(i, t) for i, t in enumerate(clean)] + [(40 + i, f"{line}\n{t}") for i, t in enumerate(prose(rng, 50, 3000) for _ in range(4))]
    rows += [(50, clean[3]), (51, clean[3] + " end"), (60, f"{clean[5][:100]} {passage} more"), (70, None), (71, "")]
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = docs(spark, rows, extra=True)
    lined = corpus_pipeline.drop_shared_lines(spark, df, str(tmp_path))
    texts = {r["doc_id"]: r["text"] for r in lined.collect()}
    assert all(line not in texts[i] for i in (40, 41, 42)) and line in texts[43] and lined.columns == df.columns
    one = corpus_pipeline.drop_near_copies(spark, settled(lined), str(tmp_path))
    ids = {r["doc_id"] for r in one.collect()}
    assert 3 in ids and not ids & {50, 51} and len(ids) == len(rows) - 2
    left = corpus_pipeline.drop_contaminated(spark, settled(one), str(tmp_path))
    assert {r["doc_id"] for r in left.collect()} == ids - {60}
    last = {r["doc_id"]: r for r in corpus_pipeline.encode(spark, left, str(tmp_path)).collect()}
    assert set(last) == ids - {60} and last[70]["n_tokens"] == 0 and last[0]["n_tokens"] * 4 == len(last[0]["ids"])


def test_toxic_documents_go(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        w = prose(rng, 60, 300).split()
        if i % 4 == 0:
            w[10] = w[40] = "vlumpkin"
        rows.append((i, " ".join(w)))
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = docs(spark, rows, extra=True)
    kept = corpus_pipeline.drop_toxic(spark, df, str(tmp_path))
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == df.columns
    held = [r["doc_id"] for r in df.filter(toxicity.held_out()).select("doc_id").collect()]
    assert sum((i in ids) == (i % 4 != 0) for i in held) >= 0.97 * len(held)


def test_rows_without_labels_are_kept(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs(spark, [(1, "a b"), (2, None)]), str(tmp_path)).count() == 2
    assert corpus_pipeline.drop_near_copies(spark, docs(spark, []).select("*", F.lit(1).alias("x")), str(tmp_path)).count() == 0
