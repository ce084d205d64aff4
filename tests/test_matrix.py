import math
import sys

import pytest
from pyspark.sql import functions as F

import textgraph.operators.cells as cells_module
from textgraph import TableScope, cell_product, dedupe_cells, factored_product, fill_cells, ieee_divide, normalize_rows, recommend, sparse_matmul
from textgraph.operators.cells import attach_row_sums, pair_up, partial_products, product_row_sums
from textgraph.scratch import cut_lineage
from textgraph.sources import terms_of
from textgraph_checks.matrix import purchases


def cells(spark, *values):
    return spark.createDataFrame([(r, c, float(v)) for r, c, v in values], "row string, col string, val double")


def items(spark, *ids):
    return terms_of(spark, list(ids), "item")


def as_dict(df):
    got = df.collect()
    values = {(r["row"], r["col"]): r["val"] for r in got}
    assert len(values) == len(got)
    return values


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute(a, b, ids):
    rows, cols = {r for r, _, _ in a}, {c for _, c, _ in b}
    dense = {(r, i): 0.0 for r in rows for i in ids} | {(i, c): 0.0 for i in ids for c in cols}
    sparse = {}
    for r, k, x in a:
        for k2, c, y in b:
            if k == k2 and r in ids and c in ids:
                sparse[r, c] = sparse.get((r, c), 0.0) + x * y
    return sparse, dense | sparse


A = [("i", "k", 2), ("i", "lone", 1), ("j", "lone", 1), ("p0", "lone", 1), ("p2", "lone", 1), ("i", "m", 1), ("j", "k", 4), ("r1", "k", 2)] + [(f"p{n}", "hot", n) for n in range(8)]
B = [("k", "j", 3), ("m", "j", 5), ("k", "c1", 3)] + [("hot", f"p{n}", n + 1) for n in range(8)]
IDS = ["i", "j", "none", *[f"p{n}" for n in range(0, 8, 2)]]


@pytest.mark.parametrize("floor", [100_000, 3])
def test_product_with_and_without_hot_inner_index(spark, floor):
    sparse, dense = brute(A, B, IDS)
    a, b, ids = cells(spark, *A), cells(spark, *B), items(spark, *IDS)
    assert as_dict(cell_product(a, b, ids, floor)) == sparse
    assert as_dict(sparse_matmul(a, b, ids, dense=False, hot_floor=floor)) == sparse
    assert as_dict(sparse_matmul(a, b, ids, dense=True, hot_floor=floor)) == dense
    assert as_dict(fill_cells(cell_product(a, b, ids, floor), a, b, ids)) == dense


@pytest.mark.parametrize("a_hot", [True, False])
def test_inner_index_hot_on_one_side(spark, a_hot):
    many = [(f"p{n}", "hot", n) for n in range(20)]
    a = many if a_hot else [("p1", "hot", 2)]
    b = [("hot", "p2", 3)] if a_hot else [(k, r, v) for r, k, v in many]
    ids = [f"p{n}" for n in range(20)]
    got = cell_product(cells(spark, *a), cells(spark, *b), items(spark, *ids), hot_floor=3)
    assert as_dict(got) == brute(a, b, ids)[0]


def test_item_domain(spark):
    got = as_dict(sparse_matmul(cells(spark, ("r1", "k", 2)), cells(spark, ("k", "c1", 3)), items(spark, "c1"), dense=True))
    assert got == {("r1", "c1"): 0.0, ("c1", "c1"): 0.0}


def test_rows_scaled_and_rows_of_zeros(spark):
    a, b, ids = cells(spark, ("i", "k", 2)), cells(spark, ("k", "j", 3)), items(spark, "i", "j")
    got = as_dict(recommend(a, b, ids, dense=True))
    assert got["i", "j"] == 1.0 and got["i", "i"] == 0.0
    assert math.isnan(got["j", "j"])
    assert as_dict(recommend(a, b, ids)) == {("i", "j"): 1.0}


@pytest.mark.parametrize("floor", [100_000, 3])
@pytest.mark.parametrize("dense", [False, True])
def test_sums_from_factors_are_those_of_the_cells(spark, dense, floor):
    """Rows outside the list, rows without products, and rows whose products cancel out."""
    more = [("none", "k", 2), ("p4", "x", 1), ("p6", "y", 1), ("p6", "z", -1)]
    a, b = A + more, B + [("y", "j", 2), ("z", "c1", 2), ("z", "p2", 2), ("z", "i", 0)]
    ids = items(spark, *IDS)
    sums = {r["row"]: r["row_sum"] for r in product_row_sums(cells(spark, *a), cells(spark, *b), ids).collect()}
    sparse, _ = brute(a, b, IDS)
    assert sums == {row: sum(v for (r, _), v in sparse.items() if r == row) for row in {r for r, _ in sparse}}
    args = cells(spark, *a), cells(spark, *b), ids
    want = as_dict(normalize_rows(sparse_matmul(*args, dense=dense, hot_floor=floor)))
    assert as_dict(recommend(*args, dense=dense, hot_floor=floor)) == pytest.approx(want, nan_ok=True)


def test_no_grid_of_pairs_unless_asked_for(spark):
    args = cells(spark, *A), cells(spark, *B), items(spark, *IDS)
    product = factored_product(*args)
    # The strips of a grid are a list that its keys are copied to.
    many = [plan(df).count("explode(org.apache") for df in (product.cells, recommend(*args), product.dense(), recommend(*args, dense=True))]
    assert many[:2] == [0, 0] and many[2] == many[3] >= 2, many
    assert {r[0] for r in product.rows.collect()} == {r for r, _, _ in A} and {r[0] for r in product.cols.collect()} == {c for _, c, _ in B}
    assert as_dict(product.cells) == brute(A, B, IDS)[0] and as_dict(product.dense()) == brute(A, B, IDS)[1]


def test_the_product_streams_once(spark):
    """The sum by cell is the only aggregate over products, and nothing of them is joined."""
    text = plan(recommend(cells(spark, *A), cells(spark, *B), items(spark, *IDS)))
    above = text[: text.index("(x#")]
    assert above.count("HashAggregate") <= 2 and "Join" not in above


@pytest.mark.parametrize("floor", [100_000, 1])
def test_rows_sum_to_one_or_nan(spark, floor):
    _, dense = brute(A, B, IDS)
    a, b, ids = cells(spark, *A), cells(spark, *B), items(spark, *IDS)
    shares = as_dict(normalize_rows(sparse_matmul(a, b, ids, dense=True), floor))
    assert shares.keys() == dense.keys()
    for row in {r for r, _ in shares}:
        total = sum(v for (r, _), v in shares.items() if r == row)
        assert math.isnan(total) or total == pytest.approx(1.0)


def test_duplicate_cells_leave_one(spark):
    twice = cells(spark, ("r", "c", 1), ("r", "c", 4), ("r", "d", 2))
    assert as_dict(dedupe_cells(twice)) == {("r", "c"): 4.0, ("r", "d"): 2.0}
    got = sparse_matmul(twice, cells(spark, ("c", "r", 2), ("c", "r", 1)), items(spark, "r"), dense=False)
    assert as_dict(got) == {("r", "r"): 8.0}


def test_a_list_beyond_the_bound(spark, monkeypatch):
    sparse, dense = brute(A, B, IDS)
    monkeypatch.setattr("textgraph.operators.cells.is_small", lambda terms: False)
    assert as_dict(sparse_matmul(cells(spark, *A), cells(spark, *B), items(spark, *IDS), dense=True)) == dense


def test_pair_up_makes_every_pair_once(spark, rows):
    left, right = items(spark, *"abcdefg"), terms_of(spark, list("uvwxyz"), "other")
    assert rows(pair_up(left, right)) == sorted((x, y) for x in "abcdefg" for y in "uvwxyz")


def test_ieee_division(spark):
    nan, inf = float("nan"), float("inf")
    cases = [(1.0, 2.0), (0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (nan, 0.0), (nan, 1.0), (1.0, nan), (inf, 0.0), (1.0, inf)]
    want = [0.5, nan, inf, -inf, nan, nan, nan, inf, 0.0]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(cases)], "i int, x double, y double")
        got = [r["q"] for r in df.select("i", ieee_divide(F.col("x"), F.col("y")).alias("q")).orderBy("i").collect()]
        assert got == pytest.approx(want, nan_ok=True)
    spark.conf.set("spark.sql.ansi.enabled", "true")
    null = spark.sql("SELECT CAST(NULL AS DOUBLE) x, 1.0D y").select(ieee_divide(F.col("x"), F.col("y")).alias("q"))
    assert null.first()["q"] is None


def wide(spark, n: int = 40):
    """``n`` x ``n`` cells on each side with few products to a cell."""
    rows = [(f"p{i}", f"k{i * 7 % n}", 1.0 + i) for i in range(n)] + [(f"p{i}", f"k{i * 3 % n}", 2.0) for i in range(n)]
    cols = [(k, r, v) for r, k, v in rows]
    return rows, cols, [f"p{i}" for i in range(n)]


def test_many_products_are_dealt_before_they_are_added(spark, monkeypatch):
    """No aggregate below the shuffle of products, which would only fill its memory; as many tasks as keep few in each."""
    a, b, ids = wide(spark)
    args = dedupe_cells(cells(spark, *a)), dedupe_cells(cells(spark, *b)), items(spark, *ids)
    want = as_dict(cell_product(*args))
    monkeypatch.setattr(cells_module, "TASK_PRODUCTS", 20)
    got = cell_product(*args)
    assert as_dict(got) == want == brute([(r, k, v) for (r, k), v in as_dict(args[0]).items()], [(k, c, v) for (k, c), v in as_dict(args[1]).items()], ids)[0]
    assert partial_products(*args).rdd.getNumPartitions() > 4
    text = plan(got)
    assert "REPARTITION_BY_NUM" in text[: text.index("(x#")]


def test_dense_products_are_added_before_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(cells_module, "TASK_PRODUCTS", 5)
    full = [(f"p{i}", f"k{k}", 1.0) for i in range(3) for k in range(40)]
    args = cells(spark, *full), cells(spark, *[(k, r, v) for r, k, v in full]), items(spark, "p0", "p1", "p2")
    text = plan(cell_product(*args))
    assert "REPARTITION_BY_NUM" not in text[: text.index("(x#")]
    assert set(as_dict(cell_product(*args)).values()) == {40.0}


def test_shares_shuffle_no_cell_where_rows_are_few(spark):
    rows = [("a", "x", 1.0), ("a", "y", 3.0), (None, "x", 2.0), (None, "y", 2.0), ("z", "x", 0.0)]
    table = spark.createDataFrame(rows, "row string, col string, val double")
    got = normalize_rows(table)
    assert "Exchange hashpartitioning" not in plan(got)
    shares = as_dict(got)
    assert math.isnan(shares.pop(("z", "x")))
    assert shares == {("a", "x"): 0.25, ("a", "y"): 0.75, (None, "x"): 0.5, (None, "y"): 0.5}


def test_products_of_a_recommendation_are_dealt(spark, monkeypatch):
    a, b, ids = wide(spark)
    args = cells(spark, *a), cells(spark, *b), items(spark, *ids)
    want = as_dict(recommend(*args))
    monkeypatch.setattr(cells_module, "TASK_PRODUCTS", 20)
    got = recommend(*args)
    text = plan(got)
    assert "REPARTITION_BY_NUM" in text[: text.index("(x#")]
    assert as_dict(got) == pytest.approx(want)
    # With zeros, which are shuffled by cell, the products are not dealt beforehand.
    assert as_dict(recommend(*args, dense=True)) == pytest.approx(as_dict(normalize_rows(sparse_matmul(*args, dense=True))), nan_ok=True)


@pytest.mark.parametrize("listed", [True, False])
@pytest.mark.parametrize("floor", [100_000, 3])
def test_products_of_a_cell_travel_as_arrays(spark, monkeypatch, floor, listed):
    """One row for each cell of the left side crosses the shuffle, not one for each product, with hot rows and lists beyond the bound too."""
    a, b, ids = wide(spark)
    # A row and an inner index with many products.
    a, b = a + [("p0", f"k{i}", 3.0) for i in range(1, 40)], b + [("k5", f"p{i}", 0.5) for i in range(40)]
    monkeypatch.setattr(cells_module, "TASK_PRODUCTS", 20)
    monkeypatch.setattr(cells_module, "PACKED_CELLS", 3)
    if not listed:
        monkeypatch.setattr(cells_module, "is_small", lambda terms: False)
        monkeypatch.setattr(sys.modules["textgraph.plans.recommend"], "is_small", lambda terms: False)
    args = cut_lineage(dedupe_cells(cells(spark, *a))), cut_lineage(dedupe_cells(cells(spark, *b))), items(spark, *ids)
    got = cell_product(*args, floor)
    text = plan(got)
    assert text.index("posexplode(") < text.index("REPARTITION_BY_NUM") < text.index("(x#")
    assert ("piece#" in text) == (floor == 3)
    # The sum by cell needs no shuffle between the dealt rows and itself.
    assert text[: text.index("posexplode(")].count("Exchange hashpartitioning") == 0
    a, b = ([(r, c, v) for (r, c), v in as_dict(df).items()] for df in args[:2])
    assert as_dict(got) == brute(a, b, ids)[0]
    want = as_dict(normalize_rows(got))
    assert as_dict(recommend(*args, hot_floor=floor)) == pytest.approx(want)


def test_cells_with_null_values_and_keys_are_multiplied_alike(spark, monkeypatch):
    a = [("p0", "k", None), ("p0", "m", 2.0), (None, "k", 1.0), ("p1", None, 1.0), ("p1", "k", 4.0)]
    b = [("k", "p0", 3.0), ("k", "p1", None), (None, "p0", 1.0), ("m", "p0", 5.0), ("k", None, 1.0)]
    schema = "row string, col string, val double"
    args = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), terms_of(spark, ["p0", "p1"], "item")
    want = as_dict(cell_product(*args))
    monkeypatch.setattr(cells_module, "TASK_PRODUCTS", 1)
    assert "posexplode(" in plan(cell_product(*args))
    assert as_dict(cell_product(*args)) == want == {("p0", "p0"): 10.0, ("p0", "p1"): None, ("p1", "p0"): 12.0, ("p1", "p1"): None}


def test_few_row_sums_are_broadcast(spark):
    a, sums = cells(spark, *A), spark.createDataFrame([("i", 2.0), ("j", 0.0)], "row string, row_sum double")
    got = attach_row_sums(cut_lineage(a), cut_lineage(sums))
    assert "Exchange hashpartitioning" not in plan(got)
    assert {r["row"]: r["row_sum"] for r in got.collect()} == {r: {"i": 2.0}.get(r, 0.0) for r, _, _ in A}
    assert got.count() == len(A)


def test_purchases_are_dealt_once_by_cell(spark, tmp_path):
    tables = {
        "orders": ([(1, 7), (2, 8), (3, None)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(1, 5, 2.0), (1, 5, 3.0), (2, None, 1.0), (3, 5, 1.0), (9, 5, 1.0)], "l_orderkey long, l_partkey long, l_quantity double"),
        "customer": ([(7,), (8,)], "c_custkey long"),
    }
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    a, b, ids = purchases(spark, str(tmp_path))
    assert plan(dedupe_cells(a)).count("hashpartitioning(row#") == 1 and "hashpartitioning(o_custkey" not in plan(dedupe_cells(a))
    assert as_dict(a) == {("7", "5"): 5.0, ("8", None): 1.0, (None, "5"): 1.0}
    assert as_dict(b) == {("5", "7"): 2.0, (None, "8"): 1.0, ("5", None): 1.0}
    assert {r["item"] for r in ids.collect()} == {"7", "8"}


def test_large_tables_between_stages_are_packed(spark, monkeypatch):
    written = []
    monkeypatch.setattr(sys.modules["textgraph.plans.recommend"], "cut_lineage", lambda *args, **more: written.append(cut_lineage(*args, **more)) or written[-1])
    sparse_matmul(cells(spark, *A), cells(spark, *B), items(spark, *IDS))
    assert len(written) == 2 and all(".zstd." in path for table in written for path in table.inputFiles())
    with TableScope(spark) as scope:
        tables = scope.cut(spark.range(3)), scope.bucketed(spark.range(3), ["id"], 2)
        assert all(".zstd." in path for table in tables for path in table.inputFiles())
