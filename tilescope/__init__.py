"""tilescope: Spark-native analytics for event logs placed on a 2-D canvas.

Every function takes and returns DataFrames; the caller owns the session.
"""

from tilescope.config import CANVAS, Columns, materialize
from tilescope.functions.exprs import (
    bin_label,
    block_label,
    count_label,
    hour_of,
    percentage,
    point_label,
    ratio_text,
    share_annotation,
    thousands,
)
from tilescope.functions.ranges import TimeRange, partition_day, time_range
from tilescope.operators.blocks import (
    block_counts,
    block_grid,
    block_intensity,
    block_matrix,
    block_unique_users,
    top_blocks,
)
from tilescope.operators.encoding import dense_codes, encode
from tilescope.operators.frequency import (
    frequency,
    key_concat,
    multi_frequency,
    top_frequencies,
    top_frequency,
    top_k,
    top_summary,
)
from tilescope.operators.histogram import placement_histogram, user_counts, user_histogram
from tilescope.operators.points import at_points, in_cells, top_categories_at, top_points
from tilescope.operators.rollup import frequency_from, hourly_rollup, top_summary_from, write_rollup
from tilescope.operators.series import hourly_counts, hourly_map, hourly_melt, hourly_series, hourly_unmap, hourly_wide, point_labels
from tilescope.operators.sessions import event_gaps, gap_slices, session_stats, sessions
from tilescope.operators.share import category_share, category_share_at
from tilescope.operators.sketches import estimated_users, roll_up, user_sketches
from tilescope.plans.ingest import compact, export, ingest_csv, load_log, parse_raw
from tilescope.sources.canvas import canvas_from_events, read_canvas
from tilescope.sources.commits import commit, committed, read_latest
from tilescope.sources.raw import raw_from_canvas, read_raw_csv, write_raw_csv
from tilescope.sources.sinks import export_parquet, latest_export, stamped_path

__all__ = [name for name in dir() if not name.startswith("_") and name not in {"config", "functions", "operators", "plans", "sources"}]
