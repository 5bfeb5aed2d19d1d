from shelfcast.operators.lags import all_lag_features
from shelfcast.plans.manifests import BASIC_COLUMNS, base_manifest, encoding_columns, feature_columns, lag_manifest


def test_sizes():
    assert len(set(BASIC_COLUMNS)) == 40
    assert len(set(encoding_columns())) == 66
    assert len(set(base_manifest())) == 107
    assert len(set(all_lag_features())) == 1106


def test_lag_manifest():
    for h in range(1, 29):
        rolls = lag_manifest(h)
        assert len(set(rolls)) == len(rolls) == (65 if h % 7 == 0 else 86)
        assert min(r.shift for r in rolls) == h
        assert max(r.shift for r in rolls if r.fn == "lag") == h + 13
        assert {r.shift for r in rolls if r.fn == "std"} == {h, -(-h // 7) * 7, -(-h // 7) * 7 + 7}
        assert set(rolls) <= set(all_lag_features())
    assert len(feature_columns(1)) == 190 and len(feature_columns(28)) == 169
