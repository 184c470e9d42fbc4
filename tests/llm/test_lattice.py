import math

import numpy as np
import pytest

from promolens.llm.graph import components
from promolens.llm.lattice import embedding_near_duplicates, nearest_e8

DDL = "vec_id long, embedding array<float>, label int, cell string"


def brute(rows, threshold=0.98):
    def unit(e):
        if e is None or not len(e) or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            return None
        v = np.array(e, np.float32).astype(float)
        return v / np.linalg.norm(v)

    units = [unit(r[1]) if r[2] is not None and r[0] is not None else None for r in rows]
    n = len(rows)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]):
                if units[i] @ units[j] >= threshold:
                    links[i].append(j)
                    links[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for y in links[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        root = min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), root, rows[i][0] is None or root == rows[i][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1024, 7])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 32))
    rows = []
    for i in range(420):
        c = centres[rng.integers(0, 40)] / 5.6
        rows.append((i, (c + rng.standard_normal(32) * rng.choice([0.005, 0.018, 0.03])).astype(np.float32).tolist(), int(rng.integers(0, 3)), "clash"))
    rows += [(500 + i, rows[3][1], rows[3][2], "") for i in range(30)] + [(600, rows[3][1], None, ""), (None, rows[3][1], rows[3][2], "")]
    rows += [(700, None, 1, ""), (701, [], 1, ""), (702, [0.0] * 32, 1, ""), (703, [1.0, None], 1, ""), (704, [1.0, float("nan")], 1, "")]
    rows += [(705, [1.0, float("inf")], 1, ""), (706, [1.0, 0.0], 1, ""), (707, [5.0, -0.0], 1, ""), (708, [-1.0, 0.0], 1, ""), (708, [-1.0, 0.0], 1, "")]
    df = spark.createDataFrame(rows, DDL).repartition(4)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_near_duplicates(df, block=block).collect()), key=str)
    want = brute(rows)
    assert sum(w[1] for w in want) > 500
    assert got == want
    if block == 7:
        assert embedding_near_duplicates(df.limit(0)).count() == 0


def test_e8_points():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 8)) * 2
    near, other = nearest_e8(x)
    for p in (near, other):
        assert np.all((2 * p) == np.rint(2 * p)) and np.all(p.sum(1) % 2 == 0)
    d = ((x - near) ** 2).sum(1)
    assert d.max() <= 1 + 1e-9 and np.all(d <= ((x - other) ** 2).sum(1))


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 9), (9, 8), (5, 5), (300, 301), (301, 300)] + [(1000, 1000 + i) for i in range(50)] + [(None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, 8: 7, 9: 7, 5: 5, 300: 300, 301: 300, **{1000 + i: 1000 for i in range(50)}}
