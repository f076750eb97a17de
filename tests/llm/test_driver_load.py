"""The driver keeps something of every job: how many the join of near copies takes is held here."""

import random

from docweave.llm import ngram_join, shared


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        got = work()
        return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def near_copies(spark):
    some, rows = random.Random(3), []
    for group in range(6):
        base = [f"w{group}x{i}" for i in range(120)]
        for copy in range(8):
            text = list(base)
            text[some.randrange(120)] = f"c{copy}"
            rows.append((group * 100 + copy, " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_jobs_of_the_join(spark):
    got, jobs = jobs_of(spark, lambda: ngram_join.ngram_components(near_copies(spark)).collect())
    assert all(r.component_id == r.doc_id // 100 * 100 for r in got)
    assert jobs <= 145  # 161 before


def test_components_of_repeated_edges(spark):
    some = random.Random(4)
    edges = [(some.randrange(300), some.randrange(300)) for _ in range(220)] + [(5, 5), (7, None), (8, 9), (9, 8), (8, 9)]
    got = shared.components(spark.createDataFrame(edges, "a long, b long")).collect()
    real = [e for e in edges if e[1] is not None and e[0] != e[1]]
    low = {n: n for e in real for n in e}
    for _ in low:
        for a, b in real:
            low[a] = low[b] = min(low[a], low[b])
    assert len(got) == len(low) and {r.node: r.component for r in got} == low
