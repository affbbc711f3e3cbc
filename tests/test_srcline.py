"""Earlier-line preprocessor flags (E10) and the batch feature groups."""

from foldwise.operators.preprocess import create_all_features, fit_src, transform_src
from foldwise.plans.pax import PAX_ROLES, pax, pax_split


def test_preprocessor_flags_off(spark, sf_dir):
    train, test = pax_split(spark, sf_dir)
    p = fit_src(train, PAX_ROLES, fill_age_by_group=False, encode_categorical=False,
                scale_features=False, extract_deck=False)
    out = transform_src(test, p, PAX_ROLES)
    cols = set(out.columns)
    assert "Deck" not in cols and "sex_encoded" not in cols
    assert {"FamilySize", "IsAlone", "FareBin", "AgeBand", "Title"} <= cols
    # unscaled: class keeps its raw integer values
    assert {r["pclass"] for r in out.select("pclass").distinct().collect()} <= {0, 1, 2, 3, 4}
    assert out.where("fare IS NULL OR embarked IS NULL").count() == 0


def test_feature_groups_optional(spark, sf_dir):
    df = pax(spark, sf_dir)
    out = create_all_features(df, PAX_ROLES, family=False, interactions=False, deck=False)
    cols = set(out.columns)
    assert "FamilySize" not in cols and "Sex_Pclass" not in cols and "Deck" not in cols
    assert {"Title", "FareBin", "AgeBand"} <= cols
    assert out.count() == df.count()
