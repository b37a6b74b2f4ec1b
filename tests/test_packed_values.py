import time

import pytest

from correlia.operators.packed_values import Model, best_values, lattice, shape, split_values

PLAIN = Model({}, {}, {}, {})
ROWS = [
    ("f", "1", '["Ann Lee", "Bo, K.", "Zoë Q"]', ["Ann Lee", "Bo, K.", "Zoë Q"]),
    ("f", "2", "Ann Lee; Bo, K.; Zoë Q;", ["Ann Lee", "Bo, K.", "Zoë Q"]),
    ("f", "3", '"Ann Lee", , "The ""Big"" Lab", "Bo, K."', ["Ann Lee", 'The "Big" Lab', "Bo, K."]),
    ("f", "4", "'Ann Lee'; 'Zoë Q'", ["Ann Lee", "Zoë Q"]),
    ("f", "5", "Zoë Q|Zoë Q\tAnn Lee", ["Zoë Q", "Zoë Q", "Ann Lee"]),
    ("f", "6", " - ", []),
    ("f", "7", "NA", []),
    ("f", "8", "[]", []),
    ("f", "9", None, []),
    ("f", "10", "  ", []),
    ("g", "1", "abcD;abcE (X1);xyz(2,4)", ["abcD", "abcE (X1)", "xyz(2,4)"]),
    ("g", "2", "{abcD, abcE}", ["abcD", "abcE"]),
    ("g", "3", "abcD", ["abcD"]),
]


def test_values_and_positions(spark):
    df = spark.createDataFrame([(*r[:3], "x") for r in ROWS] * 2, "campo string, clave string, cell string, valor string")
    got = {}
    for r in sorted(split_values(df).collect(), key=lambda r: r.posicion):
        got.setdefault((r.campo, r.clave), []).append((r.posicion, r.valor))
    for campo, clave, _, expected in ROWS:
        assert got.get((campo, clave), []) == list(enumerate(expected, 1)), (campo, clave)


def test_repeated_key_takes_the_clearest_notation(spark):
    df = spark.createDataFrame([("f", "1", "Bo, K., Ann"), ("f", "1", '["Bo, K.", "Ann"]'), ("f", "1", None)], "campo string, clave string, cell string")
    assert [r.valor for r in sorted(split_values(df).collect(), key=lambda r: r.posicion)] == ["Bo, K.", "Ann"]


def test_empty_table(spark):
    assert split_values(spark.createDataFrame([], "campo string, clave string, cell string")).count() == 0


def test_ambiguous_comma_follows_the_column(spark):
    rows = [("m", str(i), '["Red Gates, In Vitro", "Blue Maps"]') for i in range(20)] + [("m", f"c{i}", "Blue Maps,Green Cells,Blue Maps") for i in range(20)] + [("m", "x", "Blue Maps,Red Gates, In Vitro,Green Cells")]
    got = split_values(spark.createDataFrame(rows, "campo string, clave string, cell string")).where("clave = 'x'").collect()
    assert [r.valor for r in sorted(got, key=lambda r: r.posicion)] == ["Blue Maps", "Red Gates, In Vitro", "Green Cells"]


def test_long_cell_is_cut_whole():
    cell = ";".join(f"val{i}" for i in range(3000))
    assert best_values(cell, PLAIN) == [f"val{i}" for i in range(3000)]


@pytest.mark.parametrize("cell", ["(((", '"open', "a;;b", ";;;", "'", '""', "a(b", "[x", "​", "x\n\n\ny"])
def test_odd_cells_do_not_fail(cell):
    lattice(cell)
    assert all(best_values(cell, PLAIN))


def test_long_values_that_were_seen_stay_whole():
    long = "Study of the very old red gene in the new blue strain"
    model = Model({long: 50.0, "Red gene": 5.0}, {shape(long): 50.0, shape("Red gene"): 5.0}, {w: 50.0 for w in long.split()}, {",": (60.0, 0.1), " *": (3.0, 400.0), " ": (1.0, 1.0)})
    assert best_values(f"Red gene, {long}, Red gene", model) == ["Red gene", long, "Red gene"]


@pytest.mark.parametrize("cell", ['a, "b ' * 30_000, "a, (b " * 30_000, "“" * 100_000, "`a `b" * 20_000])
def test_unclosed_quotes_and_brackets_take_linear_time(cell):
    began = time.perf_counter()
    pieces, _ = lattice(cell)
    assert pieces and time.perf_counter() - began < 20
