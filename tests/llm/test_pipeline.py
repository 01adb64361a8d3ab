import importlib

import corpus
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from acctpulse.llm import queries
from acctpulse.llm.oracle import statements
from acctpulse.llm.tables import keep

SMALL = "/root/testdata/sf0.001"


def run_all(spark, docs, folder):
    seen = [docs]
    for name, stage in pipeline.STAGES:
        seen.append(keep(stage(spark, seen[-1], folder), name))
    return seen


def test_stages_pass_on_the_columns_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = run_all(spark, docs, SMALL)
    assert all(s.columns == docs.columns for s in seen[:-1])
    n = [s.count() for s in seen]
    assert n[1] >= 0.99 * n[0] and n[1] >= n[2] >= n[3] > 0.7 * n[0] and n[4] == n[5]
    # Copies are gone, contaminated documents are gone, and nothing else is.
    assert seen[2].select("text").distinct().count() == n[2]
    hits = queries.decontaminated(spark, SMALL).where("contaminated").select("doc_id")
    assert seen[3].join(hits, "doc_id").count() == 0
    assert seen[2].join(hits, "doc_id", "left_semi").count() == n[2] - n[3]
    assert seen[5].select("document.*").columns == docs.columns
    assert seen[5].select("document.*").exceptAll(seen[4]).count() == 0


def test_awkward_documents_of_any_columns(spark, tmp_path):
    path = f"{tmp_path}/awkward"
    data = corpus.rows(60, 3) + corpus.awkward()
    corpus.frame(spark, data, clashing=True).write.parquet(path)
    docs = spark.read.parquet(path)
    seen = run_all(spark, docs, SMALL)
    assert all(s.columns == docs.columns for s in seen[:-1])
    assert seen[1].where("text is null or text = ''").count() == 0
    assert seen[2].where("doc_id = 1007").count() == 1 and seen[2].where("doc_id = 1005").count() == 1


def test_empty_documents(spark, tmp_path):
    path = f"{tmp_path}/none"
    corpus.frame(spark, []).write.parquet(path)
    assert [s.count() for s in run_all(spark, spark.read.parquet(path), SMALL)] == [0] * 6


def test_run_is_its_stages(spark):
    first, again = (pipeline.run(spark, SMALL).select("shard", "slot", "doc_id").collect() for _ in range(2))
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


@pytest.mark.parametrize("name", sorted(statements()))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(statements()[name])
    columns = [c[0] for c in want.description]
    got = queries.registry()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(
        map(str, want.fetchall()))


@pytest.mark.parametrize("name", ["op1_language_id", "op3_toxicity", "op9_line_quality"])
def test_classifiers_never_see_what_is_held_out(spark, name, tmp_path):
    rows = queries.registry()[name](spark, SMALL).collect()
    held = {r["doc_id"] for r in rows if r["held_out"]}
    assert len(rows) == 200 and 20 < len(held) < 110
    for t in ("documents", "labels"):
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        odd = F.col("doc_id").isin(list(held))
        if t == "documents":
            df = df.withColumn("lang", F.when(odd, "xx").otherwise(F.col("lang")))
        else:
            df = df.withColumns({c: F.when(odd, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    again = queries.registry()[name](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_entry_lists_the_corpus_queries():
    entry = importlib.import_module("__spark_entry__")
    names = [k for k in entry.queries() if k.startswith("op")]
    assert len(names) == 10 and "pipeline" in entry.queries()
