from ledgerlens.operators.aggregate import (  # noqa: F401
    count_sum_by,
    global_sum,
    ratio,
    sum_by,
)
from ledgerlens.operators.exact import (  # noqa: F401
    as_decimal,
    as_double,
    as_long,
    as_text,
    exact_float_sum,
    exact_sum,
)
from ledgerlens.operators.join import (  # noqa: F401
    join_then_aggregate,
    members_join,
)
from ledgerlens.operators.member_filter import may_be_listed  # noqa: F401
from ledgerlens.operators.order import (  # noqa: F401
    chronological,
    first_n,
    last_n,
    pivot_series,
    top_k,
)
