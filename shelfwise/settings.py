"""Defaults of every operator.

The values below are fixed: they decide which rows a result holds, so they are
kept in one place and every operator takes them as default arguments.
"""

# Markers found in the data.
UNKNOWN_SALE = 2147483647
NEW_USER = "newUser"
HOT = "hot"
POTENTIAL = "potential"
FOCUS_GOODS = "goods"
FOCUS_SHOP = "shop"
FOCUS_TAG = "tag"
FOCUS_CATEGORY = "category"
DEFAULT_PLATFORM = "WISH"
NULL_CATEGORY = "aa"
ROOT_PARENT = "0"

# Sizes, windows and thresholds.
SALE_DAYS = 7
FRESH_DAYS = 60
REPEAT_FREE_DAYS = 2
LIST_LENGTH = 5
KEPT_LENGTH = LIST_LENGTH * (REPEAT_FREE_DAYS + 1)
HOT_POOL_SIZE = 1000
NEW_USER_POOL_SIZE = 100
CATEGORY_RANKS = 49
USER_CATEGORY_RANKS = 2
TAG_RANKS = 49
SHOP_TOP = 3
MIN_SHARED_TAGS = 5
MIN_HOT = 10
MIN_POTENTIAL = 100
POTENTIAL_BONUS = 100

# Ours: places of a block; every long list is divided into blocks of so many values, for all keys alike.
LIST_BLOCK = 100
