"""The cells that a query does not visit first hold answers too."""

import numpy as np

from kontor.llm import graph_search


def test_queries_find_what_lies_beyond_the_cells_they_visit_first(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "SHARD_VECTORS", 60)
    monkeypatch.setattr(graph_search, "CELL_SAMPLE", 16)
    monkeypatch.setattr(graph_search, "PROBED", 1)
    points = np.random.default_rng(3).normal(size=(600, 4))
    df = spark.createDataFrame(
        [(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>"
    )
    got = graph_search.search_graph(df, df.where("vec_id % 20 = 0")).collect()
    for query in range(0, 600, 20):
        apart = np.sqrt(((points - points[query]) ** 2).sum(axis=1))
        near = [int(i) for i in np.argsort(apart) if i != query][:10]
        mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == query)
        assert [i for _, i in mine] == near


def test_a_cell_is_left_out_only_if_all_of_it_lies_too_far_away():
    random = np.random.default_rng(5)
    points = random.normal(size=(500, 3)) * 10
    found = np.concatenate([points[:12], points[:1]])  # One middle comes twice.
    apart = np.sqrt(((found[:, None] - found[None]) ** 2).sum(axis=2))
    cell = graph_search.nearest_of(points, found, 1)[:, 0]
    left_out = 0
    for point in random.normal(size=(40, 3)) * 10:
        away = np.sqrt(((points - point) ** 2).sum(axis=1))
        reach = float(np.sort(away)[9])
        near = graph_search.within_reach(point, reach, found, apart)
        assert near[cell[away <= reach]].all()
        left_out += (~near).sum()
    assert left_out > 40
    assert graph_search.within_reach(points[0], float("inf"), found, apart).all()


def test_pruning_chooses_what_picking_one_by_one_does(monkeypatch):
    """Distances between proposals come at once, in batches of bounded size."""
    monkeypatch.setattr(graph_search, "DEGREE", 5)
    random = np.random.default_rng(9)
    graph = graph_search.Graph(random.normal(size=(80, 6)) + 1000)
    nodes = np.arange(40)
    proposed = random.integers(-1, 80, (40, 30))
    proposed[7], proposed[8] = -1, 8
    sizes = []
    plain = graph_search._diverse
    monkeypatch.setattr(graph_search, "_PAIRS", 8 * 30 * 30)
    monkeypatch.setattr(
        graph_search, "_diverse", lambda rows, *rest: sizes.append(len(rows)) or plain(rows, *rest)
    )
    got = graph._pruned(nodes, proposed, 1.2)
    assert max(sizes) <= 9 and sum(sizes) == 40
    for node, mine, line in zip(nodes.tolist(), got.tolist(), proposed.tolist(), strict=True):
        apart = lambda a, b: ((graph.vectors[a] - graph.vectors[b]) ** 2).sum()
        left = sorted(set(line) - {-1, node}, key=lambda i: (apart(node, i), i))
        wanted = []
        while left and len(wanted) < 5:
            wanted.append(left.pop(0))
            left = [i for i in left if 1.2**2 * apart(wanted[-1], i) > apart(node, i)]
        assert mine == wanted + [-1] * (5 - len(wanted))


def test_shards_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "SHARD_VECTORS", 60)
    monkeypatch.setattr(graph_search, "CELL_SAMPLE", 16)
    points = np.random.default_rng(3).normal(size=(900, 4))
    df = spark.createDataFrame(
        [(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>"
    )
    index, _, _ = graph_search.build_index(df)
    shards = index.select("shard").distinct().count()
    written = index.selectExpr("input_file_name() as file", "shard").distinct().groupBy("file").count()
    assert shards > 12 and written.agg({"count": "max"}).first()[0] <= 2
