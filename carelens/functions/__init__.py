"""Column expressions (built-in Spark functions only) and the one vectorised UDF family."""

from .columns import (  # noqa: F401
    admission_month, age_group, age_group_of_profile, avg_int1, avg_money, cost_per_day,
    length_of_stay, money, round_double, strip_ws,
)
