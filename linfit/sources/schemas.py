"""Fixed table schemas: particle collisions, ad clicks, leaf shapes, song lines."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and their order in the input files.
COLLISION_FEATURES = [f"feature{i}" for i in range(1, 29)]
COLLISION_GROUPS = {
    "low": COLLISION_FEATURES[:21],
    "high": COLLISION_FEATURES[21:],
    "all": COLLISION_FEATURES,
}

CLICK_LABEL = "clicked"
CLICK_WEIGHT = "cpc_in_cent"
CLICK_CATEGORIES = ["channel", "client", "algorithm", "l1"]
CLICK_COLUMNS = """
    channel client position cpc_in_cent algorithm rankscore clicked rankscore2 imps_same_cl_all_ch
    ctr_same_cl_same_ch ctr_diff_cl1_same_ch ctr_diff_cl2_same_ch ctr_same_cl_all_ch
    seller_ctr_same_cl_same_ch seller_ctr_diff_cl1_same_ch seller_ctr_diff_cl2_same_ch
    seller_ctr_same_cl_all_ch ordnung ctrest l1 l2 l1ctr30 l2ctr30 querytokens1 querytokens2
    querytokens3+ stopnum justtitlescore shinglescore noshinglescore noshingleboostscore
    noboostscore titleboostscore phrasescore minosprob simctr
""".split()

LEAF_FEATURES = [f"{part}{i}" for part in ("margin", "shape", "texture") for i in range(1, 65)]

SONG_FIELDS = 91
SONG_TIMBRE_AVERAGE = range(0, 12)
SONG_TIMBRE_COVARIANCE = range(12, 90)


def click_numeric_features() -> list[str]:
    """Every click column that is neither label, weight nor category, in file order."""
    skipped = {CLICK_LABEL, CLICK_WEIGHT, *CLICK_CATEGORIES}
    return [c for c in CLICK_COLUMNS if c not in skipped]


def feature_group(name: str) -> list[str]:
    """Collision columns of a group; ``all`` is every feature and never the label."""
    if name not in COLLISION_GROUPS:
        raise ValueError(f"unknown feature group {name!r}; use one of {sorted(COLLISION_GROUPS)}")
    return list(COLLISION_GROUPS[name])


def collision_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.DoubleType(), True) for c in ["label", *COLLISION_FEATURES]]
    )


def click_schema(labelled: bool = True) -> T.StructType:
    return T.StructType(
        [
            T.StructField(c, T.StringType() if c in CLICK_CATEGORIES else T.DoubleType(), True)
            for c in CLICK_COLUMNS
            if labelled or c != CLICK_LABEL
        ]
    )


def leaf_schema(labelled: bool = True) -> T.StructType:
    head = [T.StructField("id", T.IntegerType(), False)]
    if labelled:
        head.append(T.StructField("species", T.StringType(), False))
    return T.StructType(head + [T.StructField(c, T.DoubleType(), True) for c in LEAF_FEATURES])
