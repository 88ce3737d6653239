from seasonframe.operators.bins import bucket_agg, period_bins, spine_ratio
from seasonframe.operators.cohorts import (
    bookend_members,
    cohort,
    cohort_conversion,
    distinct_counts,
    group_counts,
    grouped_corr,
    grouped_rank_corr,
    members_of_all,
    single_group_members,
)
from seasonframe.operators.intervals import range_join, range_totals
from seasonframe.operators.ordered import add_ranks, over_neighbours, prefix_sums
from seasonframe.operators.ranking import extreme_row, leader_overlap, peak_in_period, rank_tally, rankings
from seasonframe.operators.totals import (
    entity_totals,
    grouped_totals,
    repeat_threshold,
    success_rate,
    threshold_with_attribute,
    unit_cost,
)
from seasonframe.operators.windows import (
    before_after,
    centered_anomaly,
    next_period_change,
    pace_vs_benchmark,
    repeat_winners,
    running_total,
    streaks,
)

__all__ = [
    "add_ranks",
    "before_after",
    "bookend_members",
    "bucket_agg",
    "centered_anomaly",
    "cohort",
    "cohort_conversion",
    "distinct_counts",
    "entity_totals",
    "extreme_row",
    "group_counts",
    "grouped_corr",
    "grouped_rank_corr",
    "grouped_totals",
    "leader_overlap",
    "members_of_all",
    "next_period_change",
    "over_neighbours",
    "pace_vs_benchmark",
    "peak_in_period",
    "period_bins",
    "prefix_sums",
    "range_join",
    "range_totals",
    "rank_tally",
    "rankings",
    "repeat_threshold",
    "repeat_winners",
    "running_total",
    "single_group_members",
    "spine_ratio",
    "streaks",
    "success_rate",
    "threshold_with_attribute",
    "unit_cost",
]
