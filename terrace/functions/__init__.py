"""Column-level functions (postcodes, keys, dates, flags, numbers)."""

from terrace.functions.scalar import *  # noqa: F401,F403
from terrace.functions.scalar import (  # noqa: F401
    ACCEPTED_PROPERTY_TYPES,
    CATEGORY_TYPE_DESC,
    PROPERTY_TYPE_DESC,
    TENURE_DESC,
)
