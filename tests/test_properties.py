"""Property checks: batches partition the input, thresholds grow
with sigma, both similarity implementations equal a plain LCS programme."""

import random

from pyspark.sql import functions as F

from strata.operators import batches, linkage

SF_SMOKE = "/root/testdata/sf0.001"


def test_ntile_batches_partition_the_input(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("v"))
    for n in (1, 3, 7, 13):
        b = batches.batches(df, n, ["v", "id"])
        sizes = sorted(r["c"] for r in b.groupBy("batch").agg(F.count(F.lit(1)).alias("c")).collect())
        assert sum(sizes) == 1000 and len(sizes) == n and sizes[-1] - sizes[0] <= 1
        assert b.select("id").distinct().count() == 1000


def test_fixed_batches_cover_in_order(spark):
    df = spark.range(0, 250).select(F.col("id"))
    b = batches.batches_fixed(df, 100, ["id"]).groupBy("batch").agg(F.min("id").alias("lo"), F.count(F.lit(1)).alias("n"))
    assert sorted((r["batch"], r["lo"], r["n"]) for r in b.collect()) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]


def test_thresholds_monotone_in_sigma(spark):
    from strata.plans.catalog import load_all

    th = load_all()["threshold_table"].run(spark, SF_SMOKE).collect()
    by_seg = {}
    for r in th:
        by_seg.setdefault(r["segment"], []).append(r)
    for rows in by_seg.values():
        rows.sort(key=lambda r: r["std_level"])
        for t in ("math", "verbal"):
            ranges = [r[f"{t}_threshold_range"] for r in rows]
            within = [r[f"{t}_pct_within_threshold"] for r in rows]
            assert ranges == sorted(ranges)
            assert within == sorted(within)


def _lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


def test_similarity_matches_plain_lcs(spark):
    rnd = random.Random(7)
    alphabet = "abcde éü"
    pairs = [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))),
              "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", linkage.lcs_length("a", "b").alias("l"),
                    linkage.similarity_ratio("a", "b").alias("r1"),
                    linkage.similarity_ratio_arrow("a", "b").alias("r2")).collect()
    for row in got:
        a, b = row["a"], row["b"]
        want = _lcs(a, b)
        assert row["l"] == want
        ratio = 0 if not a or not b else int(round(100.0 * ((2.0 * want) / float(len(a) + len(b)))))
        assert row["r1"] == ratio and row["r2"] == ratio
