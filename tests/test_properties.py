"""Randomised checks against brute-force models of the dplyr semantics (NA keys match, all pairs kept)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from ecospark.operators import joins

KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
LEFT = st.lists(st.tuples(KEY, st.integers(0, 9)), max_size=8)
RIGHT = st.lists(st.tuples(KEY, st.integers(10, 19)), max_size=6)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _sorted(xs):
    return sorted(xs, key=lambda t: tuple((x is not None, x) for x in t))


def brute_full_join(left, right):
    out = []
    for k, v in left:
        partners = [w for k2, w in right if k2 == k]          # None == None: NA matches NA
        out += [(k, v, w) for w in partners] or [(k, v, None)]
    left_keys = {k for k, _ in left}
    out += [(k, None, w) for k, w in right if k not in left_keys]
    return _sorted(out)


@SETTINGS
@given(LEFT, RIGHT)
def test_full_join_matches_brute_force(spark, left, right):
    l = spark.createDataFrame(left, "k string, v int")
    r = spark.createDataFrame(right, "k string, w int")
    expected = brute_full_join(left, right)
    assert rows(joins.full_join(l, r, "k")) == expected
    assert rows(joins.full_join(l, r, "k", strategy="native")) == expected


@SETTINGS
@given(st.lists(st.tuples(KEY, st.one_of(st.none(), st.integers(0, 9))), max_size=8),
       st.dictionaries(KEY, st.one_of(st.none(), st.integers(10, 19)), max_size=4))
def test_patch_matches_brute_force(spark, x, y):
    xd = spark.createDataFrame(x, "k string, v int")
    yd = spark.createDataFrame(list(y.items()), "k string, v int")
    expected = _sorted([(k, v if v is not None else y.get(k)) for k, v in x])
    out = joins.patch(xd, yd, ["k"])
    assert rows(out) == expected
    assert rows(joins.patch(out, yd, ["k"])) == expected      # idempotent


def brute_fill(rows_, direction):
    """tidyr fill per group in order of o; rows_ = [(g, o, v)]."""
    out = []
    groups = {}
    for g, o, v in rows_:
        groups.setdefault(g, []).append((o, v))
    for g, items in groups.items():
        items.sort()
        vals = [v for _, v in items]

        def down(xs):
            last, res = None, []
            for x in xs:
                last = x if x is not None else last
                res.append(last)
            return res

        def up(xs):
            return list(reversed(down(list(reversed(xs)))))

        if direction == "down":
            filled = down(vals)
        elif direction == "up":
            filled = up(vals)
        elif direction == "downup":
            filled = up(down(vals))
        else:
            filled = down(up(vals))
        out += [(g, o, f) for (o, _), f in zip(items, filled)]
    return _sorted(out)


FILL_ROWS = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b"])),
                               st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=30)


@SETTINGS
@given(FILL_ROWS, st.sampled_from(["down", "up", "downup", "updown"]))
def test_fill_matches_brute_force(spark, data, direction):
    from ecospark.operators import windows
    rows_ = [(g, i, v) for i, (g, v) in enumerate(data)]           # unique order key
    df = spark.createDataFrame(rows_, "g string, o int, v int")
    got = rows(windows.fill(df, ["v"], ["g"], ["o"], direction, chunks=3))
    assert got == brute_fill(rows_, direction)
