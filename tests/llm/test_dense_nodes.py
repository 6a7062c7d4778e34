"""Dense nodes of the near-duplicate join are compared inside tasks."""

from farelane.llm import near_dup


def _opened(spark, component: dict, major: int):
    rest = sum(c != major for c in component.values())
    return spark.createDataFrame([(1, i, c, major, rest, len(component)) for i, c in component.items()], "node long, id long, component long, major long, rest long, all long")


def test_links_of_a_dense_node_are_fewer_than_its_components(spark):
    """Before, every pair of similar members was a row: here 20 * 60 + 190 of them."""
    common = list(range(90))
    sets = spark.createDataFrame([(i, common + [1000 + i]) for i in range(80)], "id long, items array<long>")
    component = {i: 100 if i < 60 else i for i in range(80)}
    links = [(r["a"], r["b"]) for r in near_dup._facing_links(_opened(spark, component, 100), sets, near_dup.THRESHOLD).collect()]
    assert len(links) == 20
    joined = {c: c for c in component.values()}

    def root(c):
        while joined[c] != c:
            c = joined[c]
        return c

    for a, b in links:
        assert a < b
        joined[root(component[a])] = root(component[b])
    assert len({root(c) for c in joined}) == 1


def test_links_of_a_dense_node_are_exact(spark):
    """75 of 100 shingles link, 74 of 100 do not; an id with several texts links by any of them; empty sets link nothing."""
    base = list(range(100))
    rows = [(1, base), (2, base[:75]), (3, base[:74]), (4, [500, 501]), (4, base[:80]), (5, []), (6, [900])]
    sets = spark.createDataFrame(rows, "id long, items array<long>")
    component = {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}
    opened = _opened(spark, component, 2)
    links = {(r["a"], r["b"]) for r in near_dup._facing_links(opened.filter("id in (1, 2, 5, 6)"), sets, near_dup.THRESHOLD).collect()}
    assert links == {(1, 2)}
    links = {(r["a"], r["b"]) for r in near_dup._facing_links(opened.filter("id in (1, 4)"), sets, near_dup.THRESHOLD).collect()}
    assert links == {(1, 4)}
    assert near_dup._facing_links(opened.filter("id in (1, 3)"), sets, near_dup.THRESHOLD).count() == 0
