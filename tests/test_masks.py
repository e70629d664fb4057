import pytest
from pyrelake.operators import masks
from pyrelake.operators.calendar import Refused

SQUARE = masks.SourceGrid(-0.125, 2, -0.125, 1440, 0.25)


def source(spark, codes):
    """Codes by (lat_idx, lon_idx) near the origin."""
    return spark.createDataFrame([(i, j, c, bool(c)) for (i, j), c in codes.items()], "lat_idx int, lon_idx int, code int, burnable boolean")


def node(spark, lat=0.0, lon=0.0):
    return spark.createDataFrame([(1, lat, lon)], "cell_id long, lat double, lon double")


@pytest.mark.parametrize(("yes", "burnable"), [(4, True), (2, True), (1, False), (0, False)])
def test_a_vote_of_four(spark, yes, burnable):
    codes = {k: int(n < yes) for n, k in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)])}
    r = masks.vote(node(spark), source(spark, codes), SQUARE).first()
    assert (r.yes, r.of, r.burnable) == (yes, 4, burnable)


def test_outside_says_no_and_the_date_line_is_crossed(spark):
    all_yes = source(spark, {(i, j): 1 for i in (0, 1) for j in (0, 1, 1439)})
    edge = masks.vote(node(spark, lat=0.25), all_yes, SQUARE).first()
    assert (edge.yes, edge.of, edge.burnable) == (2, 4, True)
    assert masks.vote(node(spark, lat=40.0), all_yes, SQUARE).first().yes == 0
    grid = masks.SourceGrid(-0.125, 2, -179.875, 1440, 0.25)
    seam = masks.vote(node(spark, lon=-180.0), source(spark, {(i, j): 1 for i in (0, 1) for j in (0, 1439)}), grid).first()
    assert (seam.yes, seam.of) == (4, 4)


def test_the_north_west_neighbour(spark):
    codes = source(spark, {(1, 0): 7, (1, 1): 8, (0, 0): 9, (0, 1): 10})
    assert masks.north_west(node(spark), codes, SQUARE).first().code == 7
    assert masks.north_west(node(spark, lat=0.25), codes, SQUARE).first().code == 0


def test_masks_put_together(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 30.0, 0.0, 0.5)], "cell_id long, lat double, lon double, w double")
    classes = source(spark, {(i, j): 10 for i in (0, 1) for j in (0, 1)}).drop("burnable")
    regions = source(spark, {(1, 0): 3}).drop("burnable")
    got = {r.cell_id: (r.burnable, r.region, r.w) for r in masks.masks(nodes, classes, SQUARE, regions, SQUARE, (10,)).collect()}
    assert got == {1: (True, 3, 1.0), 2: (False, 0, 0.5)}
    r = masks.burnable_share(masks.masks(nodes, classes, SQUARE, regions, SQUARE, (10,))).first()
    assert r.n_burnable == 1 and r.share == pytest.approx(2 / 3)


def test_source_grids_are_checked(spark):
    good = spark.createDataFrame([(0, 0, -0.125, -0.125)], "lat_idx int, lon_idx int, lat double, lon double")
    masks.check_source(good, SQUARE)
    with pytest.raises(Refused):
        masks.check_source(spark.createDataFrame([(0, 0, 0.5, -0.125)], good.schema), SQUARE)
    with pytest.raises(ValueError, match="round the globe"):
        masks.check_source(good, masks.SourceGrid(-0.125, 2, -0.125, 700, 0.25))
    with pytest.raises(ValueError, match="ascend"):
        masks.SourceGrid(0, 1, 0, 1, -1)
