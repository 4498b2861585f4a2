"""Spanning trees of which neighbour lists decide a part, and bounds of distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import blocks, density, neighbours, spanning
from test_vectors import arrays, brute_tree, planted


@pytest.mark.parametrize("few", [64, 0])
def test_lists_decide_part_of_the_tree(spark, monkeypatch, few):
    """What they decide are edges of the tree, and only rows that they leave apart meet in blocks."""
    monkeypatch.setattr(spanning, "FEW", few)
    shift = 1 << 60  # ids that no float holds
    df = planted(spark, 90).select((F.col("vec_id") + shift).alias("vec_id"), "z")
    # a row with copies, whose lists name rows that are not in the search
    df = df.unionByName(df.where(F.col("vec_id") == shift + 4).select(F.explode(F.array(F.lit(shift + 204), F.lit(shift + 205))).alias("vec_id"), "z"))
    ids, z = arrays(df)
    tree = {(a, b, round(w, 9)) for a, b, w in brute_tree(ids, z, 4)}
    certain, real = [], spanning._certain

    def counting(*args):
        out = real(*args)
        certain.extend((r.a, r.b, round(r.weight, 9)) for r in out[0].collect())
        assert (out[2] is None) == (few == 0)
        return out

    monkeypatch.setattr(spanning, "_certain", counting)
    got = density.reachability(df, 4, 20).collect()
    assert abs(sum(r.weight for r in got) - sum(w for *_, w in tree)) < 1e-6 and len(got) == len(ids) - 1
    # copies may hang on each other elsewhere in a tree of the same weight
    copies = {shift + 4, shift + 204, shift + 205}
    assert len(certain) > 60
    single = {e for e in certain if not copies & set(e[:2])}
    assert few == 64 or single <= tree
    assert {(r.a, r.b, round(r.weight, 9)) for r in got if not copies & {r.a, r.b}} == {e for e in tree if not copies & set(e[:2])}


def test_few_rows_meet_where_lists_decide(spark, monkeypatch):
    """One group of rows: nothing, or next to nothing, is left to be compared all with all."""
    rnd = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [float(x) for x in rnd.normal(size=8)]) for i in range(300)], "vec_id long, z array<double>")
    met, real = [], blocks.by_meeting

    def counting(rows, *args, **more):
        met.append(rows.count())
        return real(rows, *args, **more)

    monkeypatch.setattr(blocks, "by_meeting", counting)
    ids, z = arrays(df)
    got = density.reachability(df, 4, 40).collect()
    assert sorted((r.a, r.b, round(r.weight, 9)) for r in got) == sorted(brute_tree(ids, z, 4))
    assert sum(met) < 100


@pytest.mark.parametrize("size, shift", [(1.0, 0.0), (1e-22, 0.0), (1e25, 0.0), (1e-3, 100.0)])
def test_bounds_hold_in_either_format(size, shift):
    rnd = np.random.default_rng(2)
    a, b = (size * rnd.normal(size=(n, 16)) + shift for n in (300, 70))
    b[:20] = a[:20]
    true = np.array([[float(((x.astype("longdouble") - y) ** 2).sum()) for y in b] for x in a])
    for start, low, (sa, sb) in blocks.squares_below(a, b):
        part = true[start:start + len(low)]
        assert low.dtype == ("float64" if size > 1e20 else "float32")
        assert (low <= blocks.at_least(part.ravel(), low).reshape(part.shape)).all()
        assert (part <= low + 2 * sa[:, None] + 2 * sb[None, :] + 1e-300).all()


def test_spare_neighbours_do_not_change_the_others(spark):
    """Also where an id comes several times and its list is shorter."""
    df = planted(spark, 40)
    df = df.unionByName(df.where("vec_id % 3 = 0")).unionByName(df.where("vec_id = 5").select(F.lit(70).cast("long").alias("vec_id"), "z"))
    plain, more = ([tuple(r) for r in neighbours.knn(df, 4, spare=spare).where("rank <= 4").collect()] for spare in (0, 3))
    assert sorted(plain) == sorted(more) and len(plain) < 4 * df.count()
