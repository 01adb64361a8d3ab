import collections
import zlib

import corpus
import pytest
from pyspark.sql import functions as F

from acctpulse.llm import sharding
from acctpulse.llm.tables import with_row_key


def sharded(spark, data, **how):
    docs = with_row_key(corpus.frame(spark, data, clashing=True).repartition(3))
    return sharding.kd_shards(sharding.light_rows(docs, ["doc_id"]), **(how or {"n_shards": 16})).collect()


def check(rows, data, n=16):
    assert len(rows) == len(data)
    facts = collections.Counter((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                                for i, t, *_ in data)
    assert collections.Counter((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"])
                               for r in rows) == facts
    slots = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    weight = collections.Counter()
    for r in rows:
        weight[r["shard"]] += r["size"]
    return weight


def test_shards_are_near_equal_in_bytes(spark):
    data = corpus.rows(1500, 6)
    weight = check(sharded(spark, data), data)
    mean = sum(weight.values()) / 16
    assert len(weight) == 16 and max(abs(w - mean) for w in weight.values()) < 0.05 * mean


def test_any_number_of_shards_or_bytes(spark):
    data = corpus.rows(400, 7)
    assert len(check(sharded(spark, data, n_shards=7), data, 7)) == 7
    total = sum(len(r[1].encode()) + 1 for r in data)
    assert len(check(sharded(spark, data, target_bytes=total // 5 + 1), data, 5)) == 5
    assert len(check(sharded(spark, data, n_shards=1), data, 1)) == 1


def test_copies_stay_together_unless_they_are_too_many(spark):
    few = corpus.rows(1500, 8)
    few += [(9000 + i, "short copy", "en", f"src{i % 4}", 10) for i in range(10)]
    hot = [(20_000 + i, few[0][1] + " hot", "en", "src1", 10) for i in range(700)]
    rows = sharded(spark, few + hot)
    weight = check(rows, few + hot)
    mean = sum(weight.values()) / 16
    assert max(abs(w - mean) for w in weight.values()) < 0.06 * mean
    homes = collections.defaultdict(set)
    for r in rows:
        homes[r["doc_id"] // 1000].add(r["shard"])
    assert len(homes[9]) == 1 and len(homes[20]) > 2


def test_awkward_rows_and_empty_tables(spark):
    data = corpus.rows(40, 9) + corpus.awkward()
    check(sharded(spark, data), data)
    assert sharded(spark, []) == []
    check(sharded(spark, [(1, None, None, None, None)]), [(1, None, None, None, None)])


def test_names_have_their_dense_rank(spark):
    long = "https://example.org/a/very/long/beginning/"
    names = ["", "a", "ab", "b", "src1", "src10", "src2", "é", long + "1", long + "2", None]
    df = spark.createDataFrame([(n,) for n in names * 3], "s string")
    got = {r.s: (r._acct_rank, r._acct_rows) for r in sharding.name_ranks(df, "s").collect()}
    known = sorted((n for n in names if n is not None), key=lambda n: n.encode())
    assert got == {n: (i + 1, 3) for i, n in enumerate(known)}
    placed = {r.s: r.d for r in sharding.with_places(df.selectExpr("s", "s as t"), {"t": "d"}).collect()}
    assert placed == {n: float(i + 1) for i, n in enumerate(known)} | {None: -1.0}


def brute_tree(points, n_leaves):
    """Leaves of (order key, weight, coordinates) points: cut at the weighted median of the widest dimension."""
    dims = len(points[0][2])
    scale = [max(p[2][d] for p in points) - min(p[2][d] for p in points) for d in range(dims)]
    out = {}

    def split(own, first, n):
        if n == 1 or not own:
            out.update({p[0]: first for p in own})
            return
        span = [(max(p[2][d] for p in own) - min(p[2][d] for p in own)) / scale[d] if scale[d] else 0 for d in range(dims)]
        d = span.index(max(span))
        own = sorted(own, key=lambda p: (p[2][d], p[0]))
        goal, upto, gaps = sum(p[1] for p in own) * (n // 2) / n, 0, []
        for i, p in enumerate(own):
            upto += p[1]
            gaps.append((abs(upto - goal), i))
        cut = min(gaps)[1] + 1
        split(own[:cut], first, n // 2)
        split(own[cut:], first + n // 2, n - n // 2)

    split(points, 0, n_leaves)
    return out


@pytest.mark.parametrize("n", [2, 5, 16])
def test_leaves_are_those_of_a_tree_built_in_memory(spark, n):
    import random

    rng = random.Random(3)
    rows = [(i % 7, i, i * 31 % 1000, 0, rng.randint(1, 50), 1, float(rng.randint(0, 9)), rng.random()) for i in range(600)]
    df = spark.createDataFrame(
        rows, "size long, text_crc32 long, _acct_hash long, _acct_piece long, w long, node int, a double, b double")
    got = {(r.size, r.text_crc32, r._acct_hash, r._acct_piece): r.leaf for r in sharding.kd_leaves(df.repartition(4), ["a", "b"], n).collect()}
    assert got == brute_tree([(r[:4], r[4], r[6:]) for r in rows], n)
