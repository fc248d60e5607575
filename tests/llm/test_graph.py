import random

from llm_data import components

from stockgap.llm.graph import connected_components


def test_chains_stars_and_random_graphs(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 90)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    want = components(200, links)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links + [(7, 7), (None, 3), (4, None)], "a long, b long")).collect()}
    for x in {y for a, b in links if a != b for y in (a, b)}:
        assert got[x] == want[x]


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_staged_tables_are_removed_on_cleanup(spark):
    import glob

    from stockgap.llm.common import checkpoint_dir, cleanup, staged
    df = staged(spark.range(3))
    assert df.count() == 3
    own = f"{checkpoint_dir(spark).removeprefix('file:')}/stockgap-llm/{spark.sparkContext.applicationId}"
    assert glob.glob(f"{own}/*")
    cleanup(spark)
    assert not glob.glob(own)
    assert staged(spark.range(2)).count() == 2
