"""Whole outputs on fixtures of the shapes that the audit and the tree page have."""

import random

from entiledger.operators import audit, hierarchy
from entiledger.sources import files

from .conftest import rows

THINGS = ["actor", "brand", "ghost", "venue"]
VENDORS = ["ios", "swan"]
ACTIONS = ["map", "fuzzymatch", "import"]


def test_enumeration_order(spark):
    """Per thing its table, its action tables, then its vendors' by vendor and action."""
    wanted = [
        "actor", "map_actor", "import_actor", "map_actor_ios", "fuzzymatch_actor_ios",
        "import_actor_ios", "map_actor_swan", "brand", "fuzzymatch_brand_swan", "venue",
    ]
    others = ["map_ghost_ios", "actors", "map_actor_bird", "history_brand_ios", "venue_map"]
    names = [f"ontology.{n}" if i % 2 else n for i, n in enumerate(wanted + others)]
    random.Random(1).shuffle(names)
    table = spark.createDataFrame([(n,) for n in names], "table_name string")
    found = audit.enumerate_tables(table, THINGS, VENDORS, ACTIONS)
    place = audit.report_position(found, len(VENDORS), len(ACTIONS)).alias("position")
    got = found.select(place, "table_name", "thing", "action", "vendor")
    ordered = got.orderBy("position").collect()
    assert [r.table_name for r in ordered] == wanted
    assert [tuple(r)[2:] for r in ordered[3:6]] == [
        ("actor", "map", "ios"), ("actor", "fuzzymatch", "ios"), ("actor", "import", "ios"),
    ]


class Node:
    """A tree that is built path by path, to compare with."""

    def __init__(self, name):
        self.name, self.below = name, []

    def add(self, path):
        for name in path:
            known = [n for n in self.below if n.name == name]
            if not known:
                known = [Node(name)]
                self.below.append(known[0])
            self = known[0]

    def lines(self, level=0):
        for node in self.below:
            yield level, node.name
            yield from node.lines(level + 1)

    def page(self):
        item = f'<li>\n<span class="tf-nc">{self.name}</span>\n'
        if not self.below:
            return item + "</li>"
        return item + "<ul>\n" + "".join(n.page() for n in self.below) + "</ul>\n</li>"


def random_rows(seed, n=120):
    rng = random.Random(seed)
    out = []
    for row in range(n):
        depth = rng.randrange(1, 6)
        path = [f"{level}{rng.randrange(2 + level)}" for level in range(depth)]
        # A row fills up with its last value, as a table of levels does.
        out.append((row, "x", *path, *[path[-1]] * (5 - depth)))
    return out


def squeezed(text):
    return "".join(text.split())


def test_outline_and_page(spark, tmp_path):
    levels = [f"level_{k}" for k in range(6)]
    ddl = "row_no long, " + ", ".join(f"{c} string" for c in levels)
    for seed in (1, 2):
        data = random_rows(seed)
        root = Node("base")
        for row in data:
            root.add(list(dict.fromkeys(row[2:])))
        table = spark.createDataFrame(data, ddl).repartition(5)
        nodes = hierarchy.tree_nodes(hierarchy.level_paths(table, levels, "row_no"))
        ordered = hierarchy.preorder(nodes)
        cells = hierarchy.outline(ordered).orderBy("sort_key").drop("sort_key").collect()
        wanted = [
            tuple(name if k == level else "" for k in range(6)) for level, name in root.lines()
        ]
        assert [tuple(r) for r in cells] == wanted

        path = tmp_path / f"page-{seed}"
        files.write_html(ordered, str(path))
        page = "".join(p.read_text() for p in sorted(path.glob("part-*")))
        page = squeezed(page)
        assert squeezed(root.page()) in page
        assert page.startswith("<!DOCTYPEhtml>") and page.endswith("</html>")
        assert page.count("<ul>") == page.count("</ul>")
        assert page.count("<li>") == page.count("</li>")


def test_duplicates_of_a_tree(spark):
    levels = [f"level_{k}" for k in range(4)]
    data = [(0, "x", "a", "b", "c"), (1, "x", "d", "b", "b"), (2, "x", "a", "c", "c")]
    ddl = "row_no long, " + ", ".join(f"{c} string" for c in levels)
    paths = hierarchy.level_paths(spark.createDataFrame(data, ddl), levels, "row_no")
    assert rows(hierarchy.duplicate_nodes(hierarchy.tree_nodes(paths))) == [("b", 2), ("c", 2)]
