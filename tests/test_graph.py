import time

import pytest
from pyspark.sql import functions as F

from textgraph import (
    TableScope,
    attach_links,
    dedupe_adjacency,
    links_of,
    node_count,
    page_table,
    pagerank,
    pagerank_links,
    pagerank_step,
    prepare_graph,
    rank_contributions,
)
from textgraph.operators.graph import fit_in_hashes, hot_sources, hub_degree, split_sources
from textgraph_checks.tables import spread


def adj(spark, **lines):
    return spark.createDataFrame([(p, links) for p, links in lines.items()], "page string, links array<string>")


def brute(lines, iterations, n, start=1.0):
    """Ranks by the definition; mere targets send nothing on."""
    ranks = {page: start for page in lines}
    for _ in range(iterations):
        credit = {}
        for page, links in lines.items():
            for target in links:
                credit[target] = credit.get(target, 0) + ranks[page] / len(links)
        ranks = {page: 0.85 * credit.get(page, 0) + 0.15 / n for page in {*lines, *credit}}
    return ranks


def as_dict(df):
    return {r["page"]: r["rank"] for r in df.collect()}


WEB = {
    "a": ["b", "c", "b"],
    "b": ["c", "d"],
    "c": ["a"],
    "e": [],
    "hub": ["a", "b", "c", "d", "e", "x1", "x2", "x3", "x4"],
    "d": ["hub", "hub", "a"],
}


def test_prepare_and_count(spark, rows):
    graph = adj(spark, a=["b"], b=[])
    assert rows(prepare_graph(graph)) == [("a", 1.0, ["b"]), ("b", 1.0, [])]
    assert node_count(graph.unionAll(graph)).first()["n"] == 4


def test_target_only_page(spark):
    assert as_dict(pagerank(adj(spark, a=["b"]), 1)) == pytest.approx({"a": 0.15, "b": 1.0})


def test_page_without_links(spark):
    assert as_dict(pagerank(adj(spark, a=[]), 1)) == pytest.approx({"a": 0.15})


def test_repeated_links_count_each_time(spark):
    links = links_of(adj(spark, a=["b", "b", "c"]))
    nodes = page_table(links).withColumn("rank", F.lit(1.0))
    sent = rank_contributions(nodes, links)
    assert sorted(tuple(r) for r in sent.collect()) == [("b", 1 / 3), ("b", 1 / 3), ("c", 1 / 3)]


@pytest.mark.parametrize("floor", [100_000, 1])
@pytest.mark.parametrize("steps", [1, 3, 7])
def test_ranks_with_and_without_hot_pages(spark, steps, floor):
    graph = adj(spark, **WEB)
    assert as_dict(pagerank(graph, steps, hot_floor=floor)) == pytest.approx(brute(WEB, steps, 6))
    links = links_of(graph)
    lines = graph.select("page")
    assert as_dict(pagerank_links(links, steps, lines=lines, hot_floor=floor)) == pytest.approx(brute(WEB, steps, 6))


def test_count_given_and_start_ranks_given(spark):
    graph = adj(spark, **WEB)
    assert as_dict(pagerank(graph, 2, n=1458)) == pytest.approx(brute(WEB, 2, 1458))
    ranked = graph.withColumn("rank", F.lit(0.25))
    assert as_dict(pagerank(ranked, 2, initial_rank=None)) == pytest.approx(brute(WEB, 2, 6, 0.25))
    assert as_dict(pagerank(ranked, 2)) == pytest.approx(brute(WEB, 2, 6))


def test_links_without_lines_count_sources(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "src string, dst string")
    assert as_dict(pagerank_links(links, 2)) == pytest.approx(brute({"a": ["b"], "b": ["a", "c"]}, 2, 2))


def test_steps_one_by_one_equal_the_whole(spark):
    links = links_of(adj(spark, **WEB))
    nodes = page_table(links, adj(spark, **WEB)).withColumn("rank", F.lit(1.0))
    for _ in range(3):
        nodes = pagerank_step(nodes, links, 6)
    assert as_dict(nodes) == pytest.approx(brute(WEB, 3, 6))


def test_repeated_lines_leave_one_list(spark, rows):
    graph = spark.createDataFrame([("a", ["b"]), ("a", ["c", "d"]), ("z", [])], "page string, links array<string>")
    assert rows(dedupe_adjacency(graph)) == [("a", ["c", "d"]), ("z", [])]
    assert rows(dedupe_adjacency(prepare_graph(graph))) == [("a", 1.0, ["c", "d"]), ("z", 1.0, [])]
    assert as_dict(pagerank(graph, 2)) == pytest.approx(brute({"a": ["c", "d"], "z": []}, 2, 3))


def test_each_step_is_saved(spark, tmp_path):
    path = f"{tmp_path}/ranks"
    last = pagerank(adj(spark, **WEB), 3, save_each=path)
    for i in range(3):
        assert as_dict(spark.read.parquet(f"{path}{i}")) == pytest.approx(brute(WEB, i + 1, 6))
    assert as_dict(last) == pytest.approx(brute(WEB, 3, 6))


def test_saving_over_a_folder_fails(spark, tmp_path):
    pagerank(adj(spark, a=["b"]), 1, save_each=f"{tmp_path}/r")
    with pytest.raises(Exception, match="already exists"):
        pagerank(adj(spark, a=["b"]), 1, save_each=f"{tmp_path}/r")


def test_result_can_start_another_run(spark):
    graph = adj(spark, **WEB)
    halfway = attach_links(pagerank(graph, 2), graph)
    assert set(halfway.columns) == {"page", "rank", "links"}
    assert as_dict(pagerank(halfway, 1, n=6, initial_rank=None)) == pytest.approx(brute(WEB, 3, 6))


def test_no_steps_is_an_error(spark):
    with pytest.raises(ValueError):
        pagerank(adj(spark, a=["b"]), 0)


def test_hot_source_is_cut_into_pieces(spark):
    links = spark.range(1000).select(F.lit("hub").alias("src"), F.col("id").cast("string").alias("dst"))
    pages = page_table(links)
    assert hot_sources(pages) is None
    hot = hot_sources(pages, floor=100)
    # The table names a hot page by its hash, so that no page is too long for it.
    of_hub = spark.range(1).select(F.xxhash64(F.lit("hub"))).first()[0]
    assert [tuple(r) for r in hot.collect()] == [(of_hub, 10)]
    sizes = [r["count"] for r in split_sources(links, hot).groupBy("piece").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text


def test_a_step_shuffles_only_ranks(spark):
    """Within a plan the links are shuffled once, whatever the number of steps."""
    final = final_plan(pagerank_links(links_of(adj(spark, **WEB)), 4))
    assert final.count("Exchange hashpartitioning(src") - final.count("ReusedExchange [src") <= 1


@pytest.mark.parametrize("floor", [100_000, 1])
@pytest.mark.parametrize("fits", [True, False])
def test_links_that_stream_past_pages_are_not_sorted(spark, floor, fits, monkeypatch):
    """Where the pages fit in hash tables no step sorts; elsewhere joins can spill."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if not fits:
            monkeypatch.setattr("textgraph.plans.graph.fit_in_hashes", lambda pages: fit_in_hashes(pages, 1))
        ranks = pagerank_links(links_of(adj(spark, **WEB)), 3, hot_floor=floor)
        final = final_plan(ranks)
        assert ("ShuffledHashJoin" in final, "SortMergeJoin" in final, "Sort [src" in final) == (fits, not fits, not fits)
        assert as_dict(ranks) == pytest.approx(brute({k: v for k, v in WEB.items() if v}, 3, 5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_of_long_or_no_names_in_hashes(spark):
    pages = spark.createDataFrame([("a" * 1000,), (None,)], "page string")
    # Two pages of some 100 bytes each and a name of 1,000, in 4 partitions.
    assert fit_in_hashes(pages, 300) and not fit_in_hashes(pages, 299) and fit_in_hashes(pages.limit(0), 0)


@pytest.mark.parametrize("floor", [100_000, 1])
def test_plans_after_the_cut_shuffle_no_links(spark, floor):
    """Links come from buckets: no exchange holds their targets, and each link stands there once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = {**WEB, "d": ["hub"] * 300 + ["a"]}
        with TableScope(spark) as scope:
            ranks = pagerank(adj(spark, **many), 7, hot_floor=floor, scope=scope)
            final = final_plan(ranks)
            assert as_dict(ranks) == pytest.approx(brute(many, 7, 6))
            assert "Bucketed: true" in final and "cnt" in final
            for line in (x for x in final.splitlines() if "Exchange" in x):
                assert "dst" not in line and "cnt" not in line
            links = spark.table(scope.names[-1])
            assert links.count() == sum(len({*t}) for t in many.values())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_scope_removes_its_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("textgraph.scratch.scratch_path", lambda spark: f"{tmp_path}/t{len(list(tmp_path.iterdir()))}-{time.time_ns()}")
    graph = adj(spark, **WEB)
    with TableScope(spark) as scope:
        ranks = pagerank(graph, 50, scope=scope, unique=True)
        # Lines, pages, links and the last ranks.
        assert len(list(tmp_path.iterdir())) == len(scope.paths) == 4
        assert as_dict(ranks) == pytest.approx(brute(WEB, 50, 6))
        name = scope.names[0]
        assert spark.catalog.tableExists(name)
    assert not list(tmp_path.iterdir()) and not spark.catalog.tableExists(name)


def test_saved_ranks_are_not_joined_back(spark, tmp_path):
    last = pagerank(adj(spark, **WEB), 2, save_each=f"{tmp_path}/r")
    assert "Join" not in final_plan(last) and spark.read.parquet(f"{tmp_path}/r0").columns == ["page", "rank", "out_degree"]


def test_lines_are_chosen_without_sorting_all_lists(spark, rows):
    """Lists that agree in their first bytes, empty and null ones, long and non-ASCII texts, null pages."""
    lists = [None, [], [""], [None], ["a"], ["a", "b"], ["a\0"], ["abcdefgh"], ["abcdefgi"], ["abcdefg"], ["é"], ["漢字漢字"], ["z", "a"], ["z", "b"]]
    given = [(f"p{i}{j}", x) for i, a in enumerate(lists) for j, b in enumerate(lists) for x in (a, b)]
    given += [("alone", ["q"]), ("same", ["q"]), ("same", ["q"]), (None, ["a"]), (None, ["b"])]
    graph = spark.createDataFrame(given, "page string, links array<string>")
    best = rows(graph.groupBy("page").agg(F.max("links")).selectExpr("coalesce(page, '-')", "cast(`max(links)` AS string)"))
    got = dedupe_adjacency(graph)
    assert rows(got.selectExpr("coalesce(page, '-')", "cast(links AS string)")) == best
    assert "SortAggregate" not in final_plan(got) and "SortAggregate" not in final_plan(pagerank(graph.where("page IS NOT NULL"), 2))


@pytest.mark.parametrize("floor", [100_000, 2])
def test_links_are_shuffled_once_into_their_buckets(spark, monkeypatch, floor):
    dealt = []
    bucketed = TableScope.bucketed

    def seen(scope, df, keys, buckets):
        dealt.append(df.repartition(buckets, *keys)._jdf.queryExecution().executedPlan().toString())
        return bucketed(scope, df, keys, buckets)

    monkeypatch.setattr(TableScope, "bucketed", seen)
    rows = [("a", "b"), ("a", "b"), ("a", "c"), ("a", "d"), ("b", "a"), ("c", "a")]
    table = spark.createDataFrame(rows, "src string, dst string")
    got = {r["page"]: r["rank"] for r in pagerank_links(table, 7, hot_floor=floor).collect()}
    assert [text.count("Exchange hashpartitioning(src") for text in dealt] == [1]
    ranks = dict.fromkeys("abcd", 1.0)
    for _ in range(7):
        sent = dict.fromkeys("abcd", 0.0)
        for src, dst in rows:
            sent[dst] += ranks[src] / sum(s == src for s, _ in rows)
        ranks = {page: 0.85 * sent[page] + 0.15 / 3 for page in ranks}
    assert got == pytest.approx(ranks)


def test_a_table_of_many_files_is_not_dealt_again(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for files, exchanges in ((1, 1), (cores, 0)):
        spark.range(100).repartition(files).write.parquet(f"{tmp_path}/{files}")
        table = spread(spark.read.parquet(f"{tmp_path}/{files}"))
        assert table._jdf.queryExecution().executedPlan().toString().count("Exchange") == exchanges
        assert sorted(r["id"] for r in table.collect()) == list(range(100))


@pytest.fixture
def small_hubs(monkeypatch):
    """Pages with three links or more are hubs."""
    for name, value in (("HUB_LINKS", 3), ("HUB_FLOOR", 3)):
        monkeypatch.setattr(f"textgraph.operators.graph.{name}", value)


LINKS = [(page, target) for page, targets in WEB.items() for target in targets]


@pytest.mark.parametrize("fits", [True, False])
def test_credits_of_hubs_are_not_shuffled(spark, small_hubs, monkeypatch, fits, tmp_path):
    """Hubs have links to each other, links that repeat and targets of their own; null pages neither send nor get anything."""
    if not fits:
        monkeypatch.setattr("textgraph.plans.graph.fit_in_hashes", lambda pages: False)
    monkeypatch.setattr("textgraph.scratch.scratch_path", lambda spark: f"{tmp_path}/t{time.time_ns()}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    steps = []
    step = pagerank_step
    monkeypatch.setattr("textgraph.plans.graph.pagerank_step", lambda *args, **more: steps.append(step(*args, **more)) or steps[-1])
    nulls = [(None, "a"), ("b", None), (None, None)]
    table = spark.createDataFrame(LINKS + nulls, "src string, dst string")
    want = brute({k: v + [None] * (k == "b") for k, v in WEB.items() if v}, 7, 6)
    want[None] = 0.15 / 6
    with TableScope(spark) as scope:
        ranks = pagerank_links(table, 7, scope=scope)
        assert as_dict(ranks) == pytest.approx(want)
        # Pages, links, pages in buckets and the last ranks.
        assert len(scope.paths) == len([*tmp_path.iterdir()]) == 4 and len(scope.names) == 3
        dealt = spark.table(scope.names[0])
        assert {r["other"] for r in dealt.where("pulled").collect()} == {"a", "hub", "d", "b"}
        assert dealt.where("key IS NOT NULL AND other IS NOT NULL").count() == len({*LINKS})
        assert len(steps) == 7
        # Only the credits of other pages are dealt by page: neither links nor ranks nor what hubs send.
        assert plan_of(steps[-1]).count("Exchange hashpartitioning") == 1
        names = [*scope.names]
    assert not [*tmp_path.iterdir()] and not any(spark.catalog.tableExists(name) for name in names)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hubs_with_given_ranks_and_saved_steps(spark, small_hubs, tmp_path):
    lines = adj(spark, **WEB).withColumn("rank", F.lit(2.0))
    last = pagerank(lines, 2, initial_rank=None, save_each=f"{tmp_path}/r")
    want = brute(WEB, 2, 6, start=2.0)
    # A mere target starts from 0, and sends nothing on.
    assert as_dict(last) == pytest.approx(want)
    assert as_dict(spark.read.parquet(f"{tmp_path}/r0")) == pytest.approx(brute(WEB, 1, 6, start=2.0))


def test_hubs_are_as_many_as_a_broadcast_holds(spark, monkeypatch):
    pages = spark.createDataFrame([(f"p{i}", 1 << i, True) for i in range(5, 20)] + [(None, 1 << 30, True), ("x", 0, True)], "page string, out_degree long, is_line boolean")
    assert hub_degree(pages) == 64
    monkeypatch.setattr("textgraph.operators.graph.MAX_HUBS", 2)
    assert hub_degree(pages) is None
    monkeypatch.setattr("textgraph.operators.graph.HUB_FLOOR", 1 << 19)
    assert hub_degree(pages) == 1 << 18
    assert hub_degree(pages.limit(0)) is None


def test_a_large_table_of_few_files_is_not_dealt_again(spark, tmp_path, monkeypatch):
    spark.range(100).repartition(1).write.parquet(f"{tmp_path}/one file")
    table = spark.read.parquet(f"{tmp_path}/one file")
    assert plan_of(spread(table)).count("Exchange") == plan_of(spread(table, "id")).count("Exchange") == 1
    monkeypatch.setattr("textgraph_checks.tables.ROW_GROUP", 1)
    assert plan_of(spread(table)).count("Exchange") == plan_of(spread(table, "id")).count("Exchange") == 0
