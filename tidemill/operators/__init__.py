from tidemill.operators.aggregates import (  # noqa: F401
    count_where, distinct_per_kind, distinct_where, exact_median, first_by, last_by, sum_where, zero_filled,
)
from tidemill.operators.changes import diff_results, fold_changelog, update_where, upsert  # noqa: F401
from tidemill.operators.factorised import Factorised, maybe_in  # noqa: F401
from tidemill.operators.frames import lagged, previous, range_frame, running_sum  # noqa: F401
from tidemill.operators.joins import (  # noqa: F401
    asof_join, band_join, band_totals, in_window_counts, net_of_sums, outer_band_join, windows_holding,
)
from tidemill.operators.keyed import key_join  # noqa: F401
from tidemill.operators.latest import earliest_by, latest_by, ordering, page, precedes, top_k, top_n  # noqa: F401
from tidemill.operators.quantiles import exact_quantile  # noqa: F401
from tidemill.operators.windows import hop, tumble  # noqa: F401
