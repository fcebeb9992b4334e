"""Components of links: contracted in chunks of any size, and in a number of steps that does not grow with small graphs."""

import numpy as np
import pyarrow as pa
import pytest

from tractweave.llm import components

CHAIN = [(int(a), int(b)) for a, b in zip(*np.random.default_rng(5).permutation(400).reshape(2, 200), strict=True)]
LINKS = [
    *CHAIN,
    *[(b, c) for (_, b), (c, _) in zip(CHAIN[:-1], CHAIN[1:], strict=True)],
    *[(1000, 1001 + i) for i in range(80)],
    *[(2000, 2000), (2001, 2001), (2001, 2002), (2002, 2001), (-5, 3000), (3000, 1 << 62)],
]


def brute_roots(links):
    root = {x: x for a, b in links if a != b for x in (a, b)}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_least_reached():
    a, b = np.array(LINKS).T
    apart = a != b
    node, root = components.least_reached(a[apart], b[apart])
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == brute_roots(LINKS)


def test_contract_keeps_what_is_connected():
    batches = [pa.RecordBatch.from_pydict({"a": [x for x, _ in part], "b": [y for _, y in part]}) for part in (LINKS[:7], [], LINKS[7:200], LINKS[200:])]
    batches[1] = batches[0].slice(0, 0)
    for chunk in (1, 50, 1 << 20):
        out = [tuple(r.values()) for x in components.contract(iter(batches), chunk) for r in x.to_pylist()]
        assert brute_roots(out) == brute_roots(LINKS)
    assert list(components.contract(iter([]))) == []
    single = (pa.RecordBatch.from_pydict({"a": [i], "b": [i + 1]}) for i in range(3 * components.HELD + 5))
    (out,) = components.contract(single)
    assert set(out.column("b").to_pylist()) == {0} and len(out) == 3 * components.HELD + 5


@pytest.mark.parametrize("chunk", [1 << 20, 150, 1])
def test_components_of_any_chunk(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK_LINKS", chunk)
    links = spark.createDataFrame([*LINKS, *LINKS[:50]], "a long, b long")
    got = components.connected_components(links).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == brute_roots(LINKS)
    assert components.connected_components(links.filter("a = b")).count() == 0


def test_a_long_chain_is_stored_once(spark, monkeypatch):
    """Each stored step costs a dozen jobs, and the driver's memory for their plans."""
    stored, real = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df, name: stored.append(name) or real(df, name))
    assert {r.root for r in components.connected_components(spark.createDataFrame(CHAIN + [(b, c) for (_, b), (c, _) in zip(CHAIN[:-1], CHAIN[1:], strict=True)], "a long, b long")).collect()} == {0}
    assert len(stored) == 1
