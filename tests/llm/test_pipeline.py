from collections import Counter

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from spillway.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import documents


def tables(spark, folder, docs):
    documents(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int("badword" in (t or ""))) for i, t, *_ in docs if i is not None], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"item{i}" for i in range(20)))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_in_order(spark, scratch):
    text = lambda n: " ".join(f"w{(n * 31 + j * j) % 701}" for j in range(60))
    docs = [(i, text(i), "en", f"s{i % 3}", 0) for i in range(400)]
    docs += [(2000 + i, text(i + 500) + " badword", "en", "s0", 0) for i in range(150)]      # toxic
    docs += [(3000 + i, text(i), "en", "s1", 0) for i in range(5)]                                # copies
    docs += [(4000 + i, text(i).replace("w", "v", 1), "en", "s2", 0) for i in range(5)]            # near copies
    docs += [(5000 + i, text(40) + " " + " ".join(f"item{j}" for j in range(20)) + f" {text(900 + i)}", "en", "s0", 0) for i in range(3)]
    docs += [(6000, None, None, None, None), (6001, "", "en", "s0", 0), (None, text(690), "en", "s1", 0)]
    folder = tables(spark, f"{scratch}/in", docs)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    now, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder)
        assert out.columns == now.columns + ["shard"] * (name == "sharding")
        out.write.parquet(f"{scratch}/{name}")
        now = spark.read.parquet(f"{scratch}/{name}")
        seen.append(Counter(r["doc_id"] for r in now.collect()))
    toxic, near, clean, mixed, sharded = seen
    assert not any(2000 <= i < 3000 for i in toxic if i is not None) and sum(toxic.values()) >= len(docs) - 160
    assert not any(3000 <= i < 5000 for i in near if i is not None)
    assert set(near) - set(clean) == {5000, 5001, 5002}
    assert set(mixed) <= set(clean) and mixed == sharded
    assert {6000, 6001, None} <= set(clean)
    run = corpus_pipeline.run(spark, folder)
    assert Counter(r["doc_id"] for r in run.collect()) == sharded


def test_empty_tables(spark, scratch):
    assert corpus_pipeline.run(spark, tables(spark, f"{scratch}/in", [])).count() == 0


def test_registered():
    assert {f"op{n}_" for n in range(1, 11)} == {k.split("_")[0] + "_" for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) and corpus_pipeline.ORACLE_SQL is None


def test_sql_gives_the_same_rows(spark):
    from tools.oracle_check import compare, duck
    sf = "/root/testdata/sf0.01"
    for name, sql in ORACLE.items():
        result = compare(spark, duck(sf), name, QUERIES[name], sql, sf)
        assert result["ok"] and "type_differences" not in result, result
