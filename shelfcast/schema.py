"""Names shared by every module: key columns, hierarchy levels, back-test terms.

Fixed values: the twelve levels and their key columns, the four term names, the
horizon of 28 days, the model anchors and the error ranks per tail probability.
"""

KEYS = ("state_id", "store_id", "cat_id", "dept_id", "item_id")

# Level -> key columns, in the order in which they appear in a node label.
LEVELS = {
    "LEVEL1": (),
    "LEVEL2": ("state_id",),
    "LEVEL3": ("store_id",),
    "LEVEL4": ("cat_id",),
    "LEVEL5": ("dept_id",),
    "LEVEL6": ("state_id", "cat_id"),
    "LEVEL7": ("state_id", "dept_id"),
    "LEVEL8": ("store_id", "cat_id"),
    "LEVEL9": ("store_id", "dept_id"),
    "LEVEL10": ("item_id",),
    "LEVEL11": ("state_id", "item_id"),
    "LEVEL12": ("item_id", "store_id"),
}
LEAF = "LEVEL12"
ROOT = "LEVEL1"

# Levels that carry target encodings: every level but the root.
ENCODED_LEVELS = {name: keys for name, keys in LEVELS.items() if keys}

# Most recent term first; each one lies `HORIZON` days before the one above it (M7).
TERMS = ("private", "public", "validation", "semival")
HORIZON = 28

# Horizons for which a back-test model exists (M6).
ANCHORS = (1, 7, 14, 21, 28)

# Tail probability -> 0-based rank among 84 sorted absolute errors and one zero (U4).
TAIL_RANKS = {0.005: 84, 0.025: 80, 0.165: 56, 0.25: 42}
