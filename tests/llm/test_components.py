"""Connected components, against a union-find in plain Python."""

import random

import brute
from tillhouse.llm.components import components, contract


def links_of(kind, rng):
    if kind == "path":
        order = rng.sample(range(1000), 300)
        return list(zip(order, order[1:]))
    if kind == "star":
        return [(500, n) for n in range(400) if n != 500]
    if kind == "mixed":
        return [(rng.randrange(900), rng.randrange(900)) for _ in range(500)] + [(-5, 3), (7, 7), (3, -5)]
    return []


def test_components(spark):
    rng = random.Random(9)
    for kind in ("path", "star", "mixed", "none"):
        links = links_of(kind, rng)
        frame = spark.createDataFrame(links, "a long, b long").repartition(7)
        found = {r.node: r.component for r in components(frame).collect()}
        real = [(a, b) for a, b in links if a != b]
        assert found == brute.roots({n for link in real for n in link}, real)


def test_contraction_keeps_components(spark, monkeypatch):
    monkeypatch.setattr("tillhouse.llm.components.CHUNK", 50)
    rng = random.Random(2)
    links = links_of("mixed", rng)
    frame = spark.createDataFrame(links, "u long, v long").repartition(5)
    after = [(r.u, r.v) for r in contract(frame).collect()]
    nodes = {n for link in links for n in link}
    assert brute.roots(nodes, after) == brute.roots(nodes, links) and all(v < u for u, v in after)
