"""Generic relational operators over DataFrames."""

from podium.operators.groupwise import (  # noqa: F401
    best_per_group, first_per_key, top_n_per_group, nth_largest, ordered_concat, leaderboard, leaderboards,
    running_number, segmented_number, chunked_list, chunked_concat,
)
from podium.operators.windows import (  # noqa: F401
    window_membership, window_hull, events_in_period, windows_frame, window_flags,
)
from podium.operators.reshape import pivot_ordinals, unpivot_measures, nest_rows  # noqa: F401
from podium.operators.setops import union_by_name  # noqa: F401
