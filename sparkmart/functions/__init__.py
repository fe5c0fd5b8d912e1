"""Column-expression helpers (built-in Spark functions only; everything stays in codegen)."""

from sparkmart.functions.text import (  # noqa: F401
    normalise_text, null_if_in, slug, strip_to_decimal, strip_to_digits,
)
from sparkmart.functions.dates import (  # noqa: F401
    first_of_month, month_spine_expr, day_spine_expr, to_date_col,
)
from sparkmart.functions.hashing import unit_hash  # noqa: F401
