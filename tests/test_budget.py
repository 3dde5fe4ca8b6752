import random

from spillway.operators.budget import budget_trips, over_budget


def test_trips_at_max_plus_one(spark):
    rnd = random.Random(1)
    rows = [(f"s{rnd.randint(0, 20)}", i) for i in range(600)]
    df = spark.createDataFrame(rows, "scope string, seq long")
    got = {r.scope: (r.seq, r.nth) for r in budget_trips(df, ["scope"], "seq", 10).collect()}
    expect = {}
    for s in {s for s, _ in rows}:
        seqs = sorted(q for ss, q in rows if ss == s)
        if len(seqs) > 10:
            expect[s] = (seqs[10], 11)
    assert got == expect


def test_over_budget_is_strict():
    assert not over_budget(10, 10)
    assert over_budget(11, 10)


def test_each_client_of_a_stream_has_its_own_budget(spark, scratch):
    """One client trips at its 11th, in the second run; the other goes on; a third holds most of the records."""
    from spillway.streaming.budgets import client_budgets
    schema = "client string, id long"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{scratch}/in")
        (client_budgets(spark.readStream.schema(schema).parquet(f"{scratch}/in"), "client", "id").writeStream
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).format("parquet").start(f"{scratch}/out").awaitTermination())
        return sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/out").collect())
    hot = [("hot", i) for i in range(1000, 31_000)]
    assert run([("a", i) for i in range(10)] + [("b", i) for i in range(4)] + hot + [(None, 1)] * 30) == [("hot", 1010, 11)]
    assert run([("a", 40 - i) for i in range(3)] + [("b", i) for i in range(10, 16)]) == [("a", 38, 11), ("hot", 1010, 11)]
    assert run([("a", 50), ("b", 60), ("hot", 70)]) == [("a", 38, 11), ("b", 60, 11), ("hot", 1010, 11)]
