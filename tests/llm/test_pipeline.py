import __spark_entry__ as entry
import corpus_pipeline as P
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def test_stages(spark, tmp_path):
    bench = prose(40, 77)
    rows = edge_rows() + [doc(100 + i, prose(120, i)) for i in range(30)] + [doc(200 + i, prose(120, i)) for i in range(5)]
    rows += [doc(300, prose(60, 500) + " " + bench + " " + prose(60, 501)), doc(301, "spam spam spam " * 30)]
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r for r in P.run(spark, str(tmp_path)).collect()}
    assert set(range(100, 130)) <= set(got)
    assert not set(got) & {1, 2, 3, 4, 9, 200, 201, 202, 203, 204, 300, 301} and 5 in got and 6 not in got
    assert sum(r["taken"] for r in got.values()) > 0
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
    assert P.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_run_on_an_empty_table_and_repeated_rows_with_odd_columns(spark, tmp_path):
    spark.createDataFrame([(1, prose(40, 77))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i // 2, prose(80, i // 4), "en", None if i % 3 else "s", 5, 0.5, 7, "z") for i in range(40)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Score double, keepers long, lang_pred string")
    for name, docs in (("none", odd.limit(0)), ("some", odd)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{tmp_path}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0
    got = [r["doc_id"] for r in P.run(spark, f"{tmp_path}/some").collect()]
    assert sorted(got) == list(range(0, 20, 2))  # four rows a text: two equal ids of two


def test_registered():
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)
