import pytest

from parcelpulse.params import Params


def make(**changes):
    return Params(**{"indices": ["NDVI"], "collection": "l2a", **changes})


def test_defaults():
    params = make()
    assert (params.save_cube, params.debug_cloud, params.batch_size_deg) == (False, False, 0.5)
    assert (params.max_cloud, params.min_clear) == (80, 0.5)


def test_accepts_several_indices_and_sizes():
    assert make(indices=["NDVI", "NDWI"], batch_size_deg=1).batch_size_deg == 1
    assert make(save_cube=True).save_cube


@pytest.mark.parametrize(
    "changes, word",
    [
        ({"collection": None}, "collection"),
        ({"collection": 42}, "collection"),
        ({"indices": "NDVI"}, "indices"),
        ({"indices": []}, "empty"),
        ({"indices": ["NDVI", "EVI"]}, "EVI"),
        ({"save_cube": "true"}, "save_cube"),
        ({"debug_cloud": 1}, "debug_cloud"),
        ({"batch_size_deg": 0}, "batch_size_deg"),
        ({"batch_size_deg": -0.5}, "batch_size_deg"),
        ({"batch_size_deg": True}, "batch_size_deg"),
        ({"batch_size_deg": float("nan")}, "batch_size_deg"),
        ({"min_clear": 2}, "min_clear"),
        ({"min_clear": float("nan")}, "min_clear"),
        ({"max_cloud": -1}, "max_cloud"),
    ],
)
def test_rejects(changes, word):
    with pytest.raises(ValueError, match=word):
        make(**changes)


def test_reports_everything_at_once():
    with pytest.raises(ValueError) as info:
        Params(indices=[], collection=1, batch_size_deg=0, save_cube="no")
    for word in ("empty", "collection", "batch_size_deg", "save_cube"):
        assert word in str(info.value)


def test_reports_all_unknown_indices():
    with pytest.raises(ValueError, match="EVI is none of.*GCI is none of"):
        make(indices=["GCI", "EVI", "NDVI"])
