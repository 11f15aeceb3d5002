import re
from pathlib import Path

import pytest

from entiledger.operators import hierarchy
from entiledger.sources import files

from .conftest import rows

LEVELS = [f"category{k}" for k in range(6)]
DATA = [
    (0, "-", "Food", "Fruit", "Fruit", "Apple", "Food"),
    (1, "-", "Cars", "Cars", "Cars", "Cars", "Cars"),
    (2, "-", "Food", "Drinks", "Juice", "Apple", "Apple"),
    (3, "-", "Food", "Fruit", "Pear", "Pear", "Pear"),
    (4, "-", "Cars", "Vans", "Vans", "Vans", "Vans"),
    (5, "-", "Food", "Fruit", "Fruit", "Apple", "Apple"),
]


@pytest.fixture(scope="module")
def nodes(spark):
    ddl = "row_no long, " + ", ".join(f"{c} string" for c in LEVELS)
    table = spark.createDataFrame(DATA, ddl).repartition(4)
    return hierarchy.tree_nodes(hierarchy.level_paths(table, LEVELS, "row_no"))


@pytest.fixture(scope="module")
def ordered(nodes):
    return hierarchy.preorder(nodes)


OUTLINE = [
    (0, "Food"),
    (1, "Fruit"),
    (2, "Apple"),
    (2, "Pear"),
    (1, "Drinks"),
    (2, "Juice"),
    (3, "Apple"),
    (0, "Cars"),
    (1, "Vans"),
]


def test_preorder(ordered):
    got = ordered.orderBy("sort_key").collect()
    assert [(r.level, r.name) for r in got] == OUTLINE


def test_preorder_without_broadcast(broadcast_up_to, nodes, ordered):
    want = rows(ordered)
    broadcast_up_to("-1")
    plan = hierarchy.preorder(nodes)
    assert rows(plan) == want


def test_preorder_takes_few_shuffles(broadcast_up_to, nodes):
    broadcast_up_to("-1")
    plan = hierarchy.preorder(nodes)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert len(re.findall(r"[-+ ]Exchange (?:hash|range|single)", final)) <= 12


def test_levels_without_a_value_are_left_out(spark):
    data = [(0, "-", "Food", None, "Fruit", None, None), (1, "-", *[None] * 5)]
    ddl = "row_no long, " + ", ".join(f"{c} string" for c in LEVELS)
    paths = hierarchy.level_paths(spark.createDataFrame(data, ddl), LEVELS, "row_no")
    got = hierarchy.markup(hierarchy.preorder(hierarchy.tree_nodes(paths)))
    pieces = [r.html for r in got.orderBy("sort_key").collect()]
    assert len(pieces) == 2
    assert all(pieces)
    assert "".join(pieces).count("<li>") == "".join(pieces + ["</ul></li>"]).count("</li>") - 2


def test_nodes(nodes):
    got = {tuple(r.path): (r.first_row, tuple(r.parent)) for r in nodes.collect()}
    assert got[("Food", "Fruit", "Apple")] == (0, ("Food", "Fruit"))
    assert got[("Cars",)] == (1, ())
    assert len(got) == 9


def test_duplicates(nodes):
    assert rows(hierarchy.duplicate_nodes(nodes)) == [("Apple", 2)]


def test_outline(ordered):
    got = hierarchy.outline(ordered).orderBy("sort_key").drop("sort_key").collect()
    for row, (level, name) in zip(got, OUTLINE, strict=True):
        assert list(row) == [name if k == level else "" for k in range(6)]


def test_outline_rejects_deep_nodes(ordered):
    with pytest.raises(Exception, match="deeper than the outline: Apple"):
        hierarchy.outline(ordered, levels=3).collect()


def test_indented(ordered):
    lines = [r.line for r in hierarchy.indented(ordered).orderBy("sort_key").collect()]
    assert lines[:3] == [" Food", "    Fruit", "       Apple"]


def nested(children):
    """Expected markup of a list of (name, children)."""
    html = ""
    for name, below in children:
        html += f'<li><span class="tf-nc">{name}</span>'
        html += f"<ul>{nested(below)}</ul>" if below else ""
        html += "</li>"
    return html


def test_html(spark, ordered, tmp_path):
    apple = ("Apple", [])
    tree = [
        (
            "base",
            [
                ("Food", [("Fruit", [apple, ("Pear", [])]), ("Drinks", [("Juice", [apple])])]),
                ("Cars", [("Vans", [])]),
            ],
        )
    ]
    files.write_html(ordered, str(tmp_path / "page"))
    parts = sorted(Path(tmp_path / "page").glob("part-*"))
    page = "".join(p.read_text() for p in parts)
    body = page[page.index("<ul>") + 4 : page.rindex("</ul>")]
    assert re.sub(r"\s*\n\s*", "", body).strip() == nested(tree)
    assert page.startswith("<!DOCTYPE html>") and page.rstrip().endswith("</html>")


def test_outline_sink(spark, ordered, tmp_path):
    files.write_outline(ordered, str(tmp_path / "outline"))
    parts = sorted(Path(tmp_path / "outline").glob("part-*"))
    lines = [line for p in parts for line in p.read_text().splitlines()]
    lines = [x.replace('""', "") for x in lines if not x.startswith("cat_0")]
    assert lines[0] == "Food,,,,," and lines[-1] == ",Vans,,,,"


def test_categories(broadcast_up_to, spark):
    names = spark.createDataFrame(
        [(0, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 9, "b")],
        "row_no int, category_id int, category_name string",
    )
    known = hierarchy.category_names(names, "row_no")
    assert rows(known) == [(1, "c"), (2, "b"), (9, "b")]
    assert rows(hierarchy.category_ids(names, "row_no")) == [("a", 1), ("b", 9), ("c", 1)]
    data = spark.createDataFrame([(0, 1, 2), (1, 2, 2), (2, 7, None)], "r int, x int, y int")
    for size in ("-1", "10m"):
        broadcast_up_to(size)
        got = hierarchy.decode_levels(data, ["x", "y"], known)
        assert rows(got) == [(0, "c", "b"), (1, "b", "b"), (2, None, None)]
