import random

from acctpulse.llm.components import components
from acctpulse.llm.tables import running_sums
from pyspark.sql import functions as F


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(200, 201), (201, 202), (202, 200), (300, 300), (400, 401), (400, 401)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
    want |= {200: 200, 201: 200, 202: 200, 400: 400, 401: 400}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_sums_over_groups_of_any_size(spark):
    rng = random.Random(4)
    data = [(rng.choice(["hot", "hot", "a", None]), i, rng.randint(-5, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, i long, x long").repartition(5)
    got = running_sums(df, ["g"], [F.col("i")], {"s": F.col("x"), "n": F.lit(1)}).collect()
    sums = {}
    want = {}
    for g, i, x in data:
        s, n = sums.get(g, (0, 0))
        sums[g] = want[i] = (s + x, n + 1)
    assert {r["i"]: (r["s"], r["n"]) for r in got} == want
